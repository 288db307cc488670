"""Each operator against brute force or literal cases, and on odd input: nulls in any
column, empty and very long texts, ties and repeated rows, empty tables and extra
columns whose names clash with an operator's own."""

import hashlib
import re
import time
from collections import Counter
from itertools import combinations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewater.llm import (
    bloom_lm, decontamination, language_id, line_dedup, mixing, ngram_join, pii, quality_classifier, quality_rules, warc,
)
from tidewater.llm.graph import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, size long, spans string, _text string"


def docs_of(spark, rows):
    """Documents with extra columns that clash with internal names."""
    full = [(i, t, lang, src, len(t or ""), "k", 7, "s", "t") for i, t, lang, src in rows]
    return spark.createDataFrame(full, DOCS)


WORDS = ["river", "stone", "green", "window", "table", "orange", "silver", "morning", "paper", "cloud", "garden", "music"]


def sentence(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 13
    for i in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[x % len(WORDS)] + str((x >> 8) % 50 if i % 3 == 0 else ""))
    return " ".join(out)


@pytest.fixture(scope="module")
def odd(spark):
    base = sentence(1, 60)
    return docs_of(spark, [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, base + " tail", "en", None),
        (4, None, None, "b"), (5, "", "en", "b"), (6, " \n\t\n", "en", "b"), (7, "one two", "en", "c"),
        (8, "ONE two", "fr", "c"), (None, base, "en", "a"), (9, sentence(2, 30_000), "fr", "a"),
        (10, "\n".join([sentence(3, 12)] * 3 + [sentence(4, 9)]), None, None), (11, "1 2 3 4 5 6 7 8 9 " * 2000, "en", "d"),
    ])


@pytest.fixture(scope="module")
def empty(spark):
    return docs_of(spark, []).limit(0)


# --- 1 -------------------------------------------------------------------------

def luhn_ok(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute_spans(text):
    text = text or ""
    found = []
    for kind, pattern in (
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(?:\.[0-9]+){3}"),
            ("card", r"[0-9](?:[ -]?[0-9])+"), ("phone", r"\+[0-9][ ().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                  "card": 16 <= len(digits) <= 19 and luhn_ok(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if ok:
                found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


def test_pii_against_python(spark, odd):
    texts = [
        "mail me: a.b+c@ex-am.ple.com_d@e.fr!", "x@y 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255", "é\U0001F600 4539 1488 0343 6467 a",
        "+1 (609) 555-7932 and +123 4", "4539148803436467 4539148803436468", "call 555-123-4567 or 555 123 4567", "+" * 500 + "1", "a" * 5000 + "@",
        "iban DE89 3704 0044 0532 0130 00 not DE89 3704 0044 0532 0130 01", None, "", "9" * 3000, "1 " * 4000, "a@b.c" * 300,
    ]
    rows = docs_of(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    got = {r["doc_id"]: r for r in pii.digest(rows).collect()}
    for i, t in enumerate(texts):
        base = brute_spans(t)
        spans = [s for s in got[i]["spans"].split(",") if s]
        assert [s for s in spans if s.split(":")[0] in pii.BASE_KINDS] == base, (i, t)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
    assert got[5]["n_local_phone"] == 1 and got[8]["n_iban"] == 1
    assert pii.digest(odd).count() == odd.count()


def test_iban_ends_where_its_country_says(spark):
    texts = ["DE89370400440532013000 BIC COBADEFFXXX", "pay DE89 3704 0044 0532 0130 00 EUR 500", "DE89370400440532013000 12 May",
             "GB82 WEST 1234 5698 7654 32 DE89370400440532013000 NO9386011117947", "DE8937040044053201300 0X BIC"]
    got = {r["doc_id"]: r["spans"] for r in pii.digest(docs_of(spark, [(i, t, None, None) for i, t in enumerate(texts)])).collect()}
    ibans = [[s for s in got[i].split(",") if s.startswith("iban:")] for i in range(len(texts))]
    assert ibans == [["iban:0:22"], ["iban:4:31"], ["iban:0:22"], ["iban:0:27", "iban:28:50", "iban:51:66"], []]


def test_pii_of_very_many_spans_in_one_text(spark):
    # Blocks of spans and their borders; time in proportion to the text.
    counts = [0, 1, pii.SPAN_BLOCK - 1, pii.SPAN_BLOCK, pii.SPAN_BLOCK + 1, 64_000]
    texts = [" ".join(f"u{i % 10}@a.de" for i in range(n)) for n in counts]
    begin = time.monotonic()
    got = {r["doc_id"]: r for r in pii.digest(docs_of(spark, [(i, t, None, None) for i, t in enumerate(texts)])).collect()}
    assert time.monotonic() - begin < 60
    for i, n in enumerate(counts):
        want = ",".join(f"email:{8 * j}:{8 * j + 7}" for j in range(n))
        assert got[i]["n_email"] == n and got[i]["spans"] == want


def test_pii_empty(empty):
    assert pii.digest(empty).count() == 0


# --- 2 -------------------------------------------------------------------------

def brute_classes(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").split()
        s = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        sets.setdefault(i, []).append(s)
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
            ra, rb = root(a), root(b)
            up[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in sets}


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_ngram_join_against_all_pairs(spark, k, percent):
    rows = []
    for g in range(12):
        words = sentence(g, 20 + 37 * g).split()
        for c in range(9):
            w = list(words)
            for e in range(c):
                w[(e * 31 + c * 7) % len(w)] = f"edit{g}{c}{e}"
            rows.append((g * 100 + c, " ".join(w)))
    rows += [(5000 + i, "the common passage of many words " * 2 + sentence(100 + i, 40)) for i in range(150)]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.link_classes(
        docs_of(spark, [(i, t, None, None) for i, t in rows]), k, percent).collect()}
    assert got == brute_classes(rows, k, percent)


def test_ngram_join_deals_tokens_once(spark, monkeypatch):
    """Prefix tokens cross one shuffle, and what is left of them is written."""
    plans, written = {}, ngram_join.written

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return written(df, name)

    monkeypatch.setattr(ngram_join, "written", noted)
    base = sentence(5, 60)
    # Sets of the same tokens in part, of sizes that can and can't link; more than 64 copies that differ at the end.
    rows = [(i, base + f" end{i}", None, None) for i in range(80)] + [(80, base[:60], None, None), (81, sentence(6, 9), None, None)]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.link_classes(docs_of(spark, rows), 3, 90).collect()}
    assert got == {i: 0 if i < 80 else i for i in range(82)}
    assert plans["shared-tokens"].count("hashpartitioning(token") == 1


def test_ngram_join_odd_rows(odd, empty):
    got = ngram_join.link_classes(odd, 3, 90).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got}
    assert by[1]["component_id"] == by[2]["component_id"] == by[3]["component_id"] == 1
    assert by[4]["component_id"] == 4 and by[4]["n_shingles"] == 0 and by[None]["component_id"] is None
    assert by[8]["component_id"] == 7 and by[7]["n_shingles"] == 1
    assert ngram_join.link_classes(empty).count() == 0
    kept = [r["doc_id"] for r in ngram_join.keep_one(odd, 3, 90).collect()]
    assert 1 in kept and 2 not in kept and None in kept and 8 not in kept


def test_large_cluster_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CLUSTER_BLOCK", 8)
    monkeypatch.setattr(ngram_join, "GROUP_BLOCK", 8)
    words = sentence(3, 200).split()
    rows = []
    for c in range(60):
        w = list(words)
        for e in range(c % 12):
            w[(e * 17 + c * 5) % 200] = f"e{c}{e}"
        rows.append((c, " ".join(w)))
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.link_classes(
        docs_of(spark, [(i, t, None, None) for i, t in rows]), 3, 90).collect()}
    assert got == brute_classes(rows, 3, 90)


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (30, 30)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in (1, 2, 3, 7, 8, 9)} == {1} and got[21] == 20 and {got[100 + i] for i in range(41)} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 3 -------------------------------------------------------------------------

def test_mixing_meets_targets(spark, odd, empty):
    rows = docs_of(spark, [(i, sentence(i, 1 + i % 90), "en", ["a", "b", None, "c"][i % 4] if i % 3 else "a") for i in range(600)])
    got = mixing.mix(rows).collect()
    per = {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        s = per.setdefault(r["source"], [0, r["target"], r["source_size"]])
        s[0] += r["taken"]
    total = sum(s[2] for s in per.values())
    assert abs(sum(s[1] for s in per.values()) - total) < 1e-6
    for taken, target, size in per.values():
        assert abs(taken - target) <= 1 and target <= 3 * size
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(rows.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}
    assert mixing.mix(odd).count() == odd.count() and mixing.mix(empty).count() == 0
    whole = mixing.mix_documents(rows)
    assert whole.columns[:len(rows.columns)] == rows.columns
    assert {r["doc_id"]: r["mix_taken"] for r in whole.collect()} == {i: n for i, n in again.items() if n}


# --- 4 -------------------------------------------------------------------------

def test_repeated_words(spark, odd, empty):
    rows = quality_rules.apply_rules(odd).collect()
    assert len(rows) == odd.count()
    for r, t in ((r, t) for r in rows for t in [x["text"] for x in odd.collect() if x["doc_id"] == r["doc_id"]][:1]):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        n = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        covered = {j for i in range(len(w) - 7) if n[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        assert (r["n_words"], r["n_repeat_words"]) == (len(w), len(covered))
    assert quality_rules.apply_rules(empty).count() == 0


def test_host_verdict_is_shrunk(spark):
    good, bad = sentence(1, 80), "### *** %% " * 30
    rows = [(i, good + f" {i}", "en", f"h{i % 20}") for i in range(400)]
    rows += [(1000 + i, bad + sentence(i, 5) + " &&&" * 9 + f" {i}", "en", "spam") for i in range(200)]
    rows += [(2000, "### " * 25 + sentence(9, 21), "en", "tiny")]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.apply_rules(docs_of(spark, rows)).collect()}
    assert all(got[i] for i in range(400)) and not any(got[1000 + i] for i in range(200))


# --- 5 -------------------------------------------------------------------------

def test_containment_against_all_pairs(spark, odd, empty):
    bench = [(i, sentence(500 + i, n)) for i, n in enumerate([3, 4, 6, 9, 14, 25, 40, 70, 130])] + [(99, None), (98, "")]
    rows = [(i, sentence(i, 300), None, None) for i in range(30)]
    for i, (_, t) in enumerate(bench[:9]):
        rows.append((100 + i, sentence(700 + i, 4000) + " " + t.upper() + ", " + sentence(800 + i, 3000), None, None))
        w = t.split()
        rows.append((200 + i, sentence(900 + i, 50) + " " + " ".join(w[: max(1, len(w) // 2)]), None, None))
    table = spark.createDataFrame(bench, "item_id long, text string")
    docs = docs_of(spark, rows)

    def sets(t, k):
        w = re.findall(r"[^\W_]+", (t or "").lower())
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}

    want = set()
    for i, t, _, _ in rows:
        for j, b in bench:
            n = len(re.findall(r"[^\W_]+", (b or "").lower()))
            k = min(5, n)
            if n and len(sets(t, k) & sets(b, k)) * 100 >= 80 * len(sets(b, k)):
                want.add((i, j))
    assert {(100 + i, i) for i in range(9)} <= want
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, table).collect()}
    assert got == want
    in_blocks = decontamination.contaminated(docs, table, item_block=4).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in in_blocks) == sorted(want)
    left = {r["doc_id"] for r in decontamination.without_benchmark(docs, table).collect()}
    assert left == {r[0] for r in rows} - {i for i, _ in want}
    assert decontamination.contaminated(odd, table).count() >= 0 and decontamination.contaminated(empty, table).count() == 0
    assert decontamination.contaminated(docs, table.limit(0)).count() == 0


# --- 6 -------------------------------------------------------------------------

def test_language_model(spark, odd, empty):
    import math
    import zlib

    rows = [(i, sentence(i % 40, 50) + f" only{i}", None, None) for i in range(300)]
    got = {r["doc_id"]: r for r in bloom_lm.score_texts(docs_of(spark, rows), head_words=20).collect()}
    counts = Counter()
    for i, t, _, _ in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*t.lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    for i, t, _, _ in rows:
        tokens = [*t.lower().split(), None]
        r = got[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(c in counts for c in tokens), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[c] + 1) / (n + v + 1)) for c in tokens))
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert bloom_lm.score_texts(odd).count() == odd.count() and bloom_lm.score_texts(empty).count() == 0


def test_filter_never_reads_low():
    import numpy as np

    keys = np.arange(1, 5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.arange(1, 5000) % 700 + 1
    size, n_bits = 1 << 20, 0
    bits = np.zeros(size, np.uint8)
    low = keys >> np.uint64(32)
    top = bloom_lm.levels(counts)
    for level in range(1, int(top.max()) + 1):
        for probe in range(bloom_lm.PROBES):
            bits[bloom_lm.places(low[top >= level], level, probe, size)] = 1
    table = bloom_lm.LogFrequencyFilter(n_bits, size, np.packbits(bits, bitorder="little"))
    read = table.level(keys)
    assert (read >= top).all() and (read == top).mean() > 0.9


def test_filter_past_the_broadcast_bound(spark):
    import math
    import zlib

    import numpy as np

    rows = [(i, " ".join(f"w{(i * 31 + j * j * 7) % (60 + i * 5)}" for j in range(60)), None, None) for i in range(400)]
    docs = docs_of(spark, rows)
    got = {r["doc_id"]: r["score"] for r in bloom_lm.score_texts(docs, max_bytes=4096).collect()}
    assert got == pytest.approx({r["doc_id"]: r["score"] for r in bloom_lm.score_texts(docs).collect()})
    words, pairs = Counter(), Counter()
    for i, t, _, _ in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            tokens = [*t.split(), None]
            words.update(tokens)
            pairs.update(zip(["", *tokens], tokens, strict=False))
    n, v, m = sum(words.values()), len(words), bloom_lm.PRIOR_WEIGHT

    def count(c):
        return float(bloom_lm.level_count(bloom_lm.levels(np.array([c])))[0])

    off = []
    for i, t, _, _ in rows:
        tokens, score, last = [*t.split(), None], 0.0, ""
        for w in tokens:
            word, context = count(words[w]), count(words[last or None])
            pair = min(count(pairs[last, w]), context, word)
            score += math.log10((pair + m * (word + 1) / (n + v + 1)) / (context + m))
            last = w
        off.append(abs(got[i] - score) / len(tokens))
    assert sum(off) / len(off) < 0.02 and max(off) < 0.1


def test_packed_numbers():
    import numpy as np

    for values in ([], [0], [7, 7, 300], [5, 1 << 40, (1 << 63) + 9], range(0, 1 << 52, 1 << 42)):
        values = np.array(values, np.uint64)
        assert (bloom_lm.unpacked_sorted(bloom_lm.packed_sorted(values)) == values).all()
        assert (bloom_lm.unpacked_ints(bloom_lm.packed_ints(values[::-1])) == values[::-1]).all()


def test_filter_in_parts_moves_texts_once(spark, monkeypatch):
    """Texts are not written again, and are dealt only by chunk."""
    import zlib

    rows = [(i, " ".join(f"w{(i * 31 + j * j * 7) % 999}" for j in range(60)), None, None) for i in range(400)]
    plans, written = {}, bloom_lm.written

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return written(df, name)

    monkeypatch.setattr(bloom_lm, "written", noted)
    got = {r["doc_id"]: r for r in bloom_lm.score_texts(docs_of(spark, rows), max_bytes=2048).collect()}
    assert set(plans) == {"word-counts", "filter", "scored-texts"}
    assert "FlatMapCoGroupsInArrow" in plans["scored-texts"]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2) for i, r in got.items()) and len(got) == 400
    whole = {r["doc_id"]: r["score"] for r in bloom_lm.score_texts(docs_of(spark, rows)).collect()}
    assert {i: r["score"] for i, r in got.items()} == pytest.approx(whole)


# --- 7 -------------------------------------------------------------------------

def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_edit_distance():
    for a, b in [("", ""), ("", "abc"), ("kitten", "sitting"), ("abc" * 50, "abd" * 48), ("é" * 70 + "x", "e" + "é" * 69),
                 ("aab", "ab"), ("abab", "ab"), ("xaby", "xby"), ("aaa", "aa")]:
        assert line_dedup.edit_distance(a, b) == plain_distance(a, b)


def test_simhash_and_places_plainly():
    """Of lines around the 127 words whose votes one byte counts, and of empty lines and texts."""
    import numpy as np
    import pyarrow as pa

    from tidewater.llm.hashing import mix, sorted_distinct

    texts = ["", "\n" + " ".join(["same"] * 400) + "\n\n", None, sentence(3, 126) + "\n" + sentence(4, 127) + "\nshort\n" + sentence(5, 255)]
    found = line_dedup.line_rows(pa.record_batch([pa.array([1, 2, 3, 4]), pa.array(texts)], names=["doc_id", "text"])).to_pylist()
    assert [(r["doc_id"], r["place"]) for r in found] == [(2, 1), (4, 0), (4, 1), (4, 3)]
    hashes = mix(np.arange(700, dtype=np.uint64), 5)
    counts = np.array([1, 126, 127, 128, 318])
    first = np.cumsum(counts) - counts
    for got, at, n in zip(line_dedup.simhash(hashes, first, counts), first, counts, strict=True):
        own = hashes[at:at + n]
        grams = [int(h) for h in mix(own, 11)] + [int(h) for h in line_dedup.combine([own[:-1], own[1:]], 12)]
        assert int(got) == sum(1 << b for b in range(64) if 2 * sum(g >> b & 1 for g in grams) > len(grams))
    # Sorting names the same values as np.unique, without a hash table.
    values = np.concatenate((hashes, hashes[::3]))
    assert (sorted_distinct(values) == np.unique(values)).all() and not len(sorted_distinct(values[:0]))


@pytest.mark.parametrize("limits", [{}, {"part_rows": 50, "most": 40}, {"part_rows": 50, "block": 20}])
def test_near_sims_against_all_pairs(spark, limits):
    import random

    rng = random.Random(5)
    values = set()
    for family in range(12):
        start = rng.getrandbits(64)
        for _ in range(3 if family else 90):
            values.add(start ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 2))))
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)

    def classes(links):
        up = {v: v for v in values}

        def root(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in links:
            up[max(root(a), root(b))] = min(root(a), root(b))
        return {v: root(v) for v in values}

    near = [(a, b) for a, b in combinations(values, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= line_dedup.MAX_BITS]
    sims = spark.createDataFrame([(v,) for v in values], "sim long").repartition(3)
    got = [tuple(r) for r in line_dedup.near_sims(sims, len(values), **limits).collect()]
    assert {tuple(sorted(r)) for r in got} <= {tuple(sorted(r)) for r in near}
    assert classes(got) == classes(near)
    assert line_dedup.near_sims(sims.limit(0), 0, **limits).count() == 0


def test_similar_against_plain_distance():
    import random

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    rng = random.Random(8)
    found = Counter()
    for _ in range(3000):
        words = [rng.choice(["a", "tea", "lamp", "seven", "7", "of"]) for _ in range(rng.randrange(0, 9))]
        other = list(words)
        for _ in range(rng.randrange(0, 3)):
            at = rng.randrange(len(other) + 1)
            other[at:at + rng.randrange(2)] = [rng.choice(["tee", "lamb", "x", "seventy"])] * rng.randrange(2)
        a, b = " ".join(words), " ".join(other)
        d, longest = distance(a, b), max(len(a), len(b))
        assert line_dedup.edit_distance(a, b) == d
        want = d <= longest * 20 // 100
        assert line_dedup.similar(a, b, 80) == want, (a, b)
        found[want] += 1
    assert min(found.values()) > 500


def test_folded_hashes_are_those_of_the_folded_text():
    from tidewater.llm.hashing import run_hashes, text_bytes

    for text in ("tea 12 a7b 9", "no digits here", "7", "0 00 x0y é5 9é"):
        data, offsets = text_bytes(pa.array([text]))
        starts, ends = line_dedup.word_runs(data, offsets)
        folded, at = text_bytes(pa.array([re.sub("[1-9]", "0", text)]))
        assert (line_dedup.folded_hashes(data, starts, ends, run_hashes(data, starts, ends)) == run_hashes(folded, starts, ends)).all()


def test_lines_against_all_pairs(spark, odd, empty):
    import pyarrow as pa

    base = [sentence(i, 25) for i in range(30)]
    rows, lines = [], []
    for d in range(25):
        own = [base[(d * 3 + j) % 30] for j in range(4)] + [sentence(1000 + d, 18), "Short line."]
        if d % 2:
            own[0] = own[0].upper().replace(" ", " - ") + "!"
            own[1] = own[1].replace("river", "rivers", 1)
        rows.append((d, "\n".join(own), None, None))
    docs = docs_of(spark, rows)
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["doc_id", "text"])
    found = line_dedup.line_rows(batch).to_pylist()
    for r in found:
        lines.append((r["doc_id"], r["place"], line_dedup.normal_form(rows[r["doc_id"]][1].split("\n")[r["place"]])))
    assert len(lines) == 25 * 5
    up = list(range(len(lines)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, y in combinations(range(len(lines)), 2):
        a, b = lines[x], lines[y]
        if 1 - plain_distance(a[2], b[2]) / max(len(a[2]), len(b[2])) >= 0.8:
            rx, ry = root(x), root(y)
            up[max(rx, ry)] = min(rx, ry)
    want = {}
    for x, (d, p, _) in enumerate(lines):
        if min((lines[y][:2] for y in range(len(lines)) if root(y) == root(x))) != (d, p):
            want.setdefault(d, []).append(p)
    got = {r["doc_id"]: r["places"] for r in line_dedup.repeated_lines(docs).collect()}
    assert got == {d: sorted(p) for d, p in want.items()}
    left = {r["doc_id"]: r["text"] for r in line_dedup.remove_lines(docs).collect()}
    for d, t, _, _ in rows:
        assert left[d] == "\n".join(x for p, x in enumerate(t.split("\n")) if p not in want.get(d, []))
    assert line_dedup.digest(odd).count() == odd.count() and line_dedup.digest(empty).count() == 0


LENGTHS = (5, 6, 7, 8, 9, 10, 12, 20, 21, 40, 60, 100)
EDITS = ("replace", "insert", "delete", "replace two", "replace three", "replace a tenth")


def edited(words, edit, rng):
    out = list(words)
    new = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(len(words))]
    if edit == "insert":
        out.insert(rng.randint(0, len(out)), new[0])
    elif edit == "delete":
        del out[rng.randrange(len(out))]
    else:
        n = {"replace": 1, "replace two": 2, "replace three": 3}.get(edit, max(1, len(out) // 10))
        for i in rng.sample(range(len(out)), min(n, len(out))):
            out[i] = new[i]
    return out


def test_recall_of_near_lines(spark):
    """Of planted pairs, told by edit similarity alone, the share found by length and by edit."""
    import random

    rng = random.Random(11)
    rows, near = [], {}
    for n in LENGTHS:
        for edit in EDITS:
            for _ in range(25):
                words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n)]
                other = edited(words, edit, rng)
                a, b = " ".join(words), " ".join(other)
                doc = len(rows)
                rows += [(doc, a, None, None), (doc + 1, b, None, None)]
                if len(other) >= line_dedup.MIN_WORDS:
                    near[doc + 1] = (n, edit, 1 - plain_distance(a, b) / max(len(a), len(b)) >= 0.8)
    got = {r["doc_id"] for r in line_dedup.repeated_lines(docs_of(spark, rows)).collect()}
    assert got <= {d for d, (_, _, is_near) in near.items() if is_near}
    shares = {}
    for n in LENGTHS:
        for edit in EDITS:
            own = [d in got for d, (m, e, is_near) in near.items() if (m, e) == (n, edit) and is_near]
            shares[n, edit] = sum(own) / len(own) if own else None
    print({k: v for k, v in shares.items() if v is not None})
    for n in LENGTHS:
        for edit in EDITS[:3]:
            assert shares[n, edit] in (1.0, None), (n, edit)
        if n >= 10:
            assert shares[n, "replace two"] in (1.0, None), n


def test_word_buckets_in_pieces(spark):
    """Parts larger than a task's bound give the same links as whole ones."""
    import numpy as np

    rng = np.random.default_rng(3)
    lines = [(int(h), rng.integers(0, 40, 3).astype(np.uint64).tobytes()) for h in range(200)]
    frame = spark.createDataFrame(lines, "h1 long, keys binary").repartition(3)

    def pairs(rows):
        groups = {}
        for bucket, h in rows:
            groups.setdefault(bucket, set()).add(h)
        return {p for g in groups.values() for p in combinations(sorted(g), 2)}

    want = {}
    for h, keys in lines:
        for k in np.frombuffer(keys, np.uint64).tolist():
            want.setdefault(k, set()).add(h)
    want = {p for g in want.values() for p in combinations(sorted(g), 2)}
    for limits in ({}, {"part_keys": 200}, {"part_keys": 200, "most": 30}):
        assert pairs(line_dedup.word_buckets(frame, 200, **limits).collect()) == want
    assert line_dedup.word_buckets(frame.limit(0), 0).count() == 0


def test_many_repeated_lines_in_one_text(spark):
    """Linear in the lines of a text (every pair of a line and a place would take minutes)."""
    import time

    line = sentence(3, 8)
    docs = docs_of(spark, [(1, "\n".join([line] * 250_000 + ["the end"]), None, None)])
    at = time.time()
    assert [r["text"] for r in line_dedup.remove_lines(docs).collect()] == [line + "\nthe end"]
    assert time.time() - at < 150


def test_lines_of_scripts_without_spaces(spark):
    han = "我们在春天的早晨沿着河边散步，看见许多花开了。" * 4
    thai = "ภาษาไทยเขียนโดยไม่เว้นวรรคระหว่างคำ"
    plain = "Ils ont trouvé des œufs bleus là-bas"
    rows = [(0, "\n".join([han, thai, plain, "好"]), None, None),
            (1, "\n".join([han, thai, plain.replace(" ", "\u3000— "), "好"]), None, None),
            (2, han.replace("，", "、").replace("花", "草", 1) + "\nquite another line of text", None, None)]
    got = {r["doc_id"]: r["places"] for r in line_dedup.repeated_lines(docs_of(spark, rows)).collect()}
    assert got[1] == [0, 1, 2] and set(got) <= {1, 2}
    assert line_dedup.normal_form(rows[1][1].split("\n")[2]) == line_dedup.normal_form(plain) == "ils ont trouvé des œufs bleus là bas"


def test_lines_that_differ_in_digits(spark):
    rows = [(0, "12 34 56 78 90\nPosted on 12 March 2020 by the admin of this site", None, None),
            (1, "98 76 54 32 10\nPosted on 13 March 2020 by the admin of this site", None, None),
            (2, "12 34 56 78 90\n12 34 56 78 91\n55 66 11 00 33", None, None)]
    got = {r["doc_id"]: r["places"] for r in line_dedup.repeated_lines(docs_of(spark, rows)).collect()}
    assert got == {1: [1], 2: [0, 1]}


# --- 8 -------------------------------------------------------------------------

def test_classifier_separates_held_out_rows(spark, odd, empty):
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        rows.append((i, " ".join(w + "###" for w in sentence(i, 60).split()) if bad else sentence(i, 60) + ".", "en", "s"))
        labels.append((i, 0 if bad else 1))
    table = spark.createDataFrame([*labels, (1, None), (None, 1), (9999, 1)], "doc_id long, quality int")
    docs = docs_of(spark, rows)
    got = quality_classifier.classify(docs, table).collect()
    assert len(got) == 400 and any(r["held_out"] for r in got)
    assert all(r["predicted"] == dict(labels)[r["doc_id"]] == (r["score"] >= 0.3) for r in got)
    few = quality_classifier.train(docs, table, max_rows=20)
    assert few.weights.any()
    none = quality_classifier.classify(odd, table.limit(0)).collect()
    assert len(none) == odd.count() and {r["score"] for r in none} == {0.5}
    assert all(0 <= r["score"] <= 1 for r in quality_classifier.classify(odd, spark.createDataFrame([(1, 1), (4, 0), (7, 0)], "doc_id long, quality int")).collect())
    assert quality_classifier.classify(empty, table).count() == 0


# --- 9 -------------------------------------------------------------------------

def test_archives_round_trip(spark, tmp_path):
    long = "<p>é\r\n\r\nWARC/1.1</p>" * 40
    rows = [(3, "http://a/ü\r\nX: y", long), (1, None, long), (2, "u", long), (2, "u", long), (4, "u", "short"), (5, "u", "short"),
            (6, "u", None), (None, "u", "x" * 200), (7, "u", "x" * 200), (8, "u", sentence(1, 90_000))]
    pages = spark.createDataFrame([(*r, "z", "w") for r in rows], "page_id long, url string, html string, digest string, payload string")
    uri = f"file://{tmp_path}/warc"
    index = warc.write_archives(pages, uri, bundle_bytes=200_000).collect()
    got = sorted((r["page_id"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.read_archives(spark, uri).collect())
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        ids = [x[0] for x in rows if x[2] == h and x[0] is not None]
        first = min(ids, default=None)
        revisit = len(b) >= 100 and i is not None and i > first
        want.append((i or 0, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    assert got == sorted(want, key=lambda r: tuple(str(x) if x is None else x for x in r[:4]))
    for r in index:
        headers, block = warc.read_record(uri, r["bundle"], r["frame"], r["offset"], r["length"])
        assert headers["WARC-Record-ID"] == f"<{r['record_id']}>"
    assert warc.read_archives(spark, uri).where("not intact").count() == 0
    assert warc.round_trip(pages.limit(0)).count() == 0


# --- 10 ------------------------------------------------------------------------

def test_language_id_on_held_out_rows(spark, odd, empty):
    import random

    def text(seed, parts):
        r = random.Random(seed)
        return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(40))

    kinds = {"xa": ["ka", "lo", "mi", "ter"], "xb": ["éu", "ran", "oi", "que"], "xc": ["sch", "un", "ei", "ter"]}
    rows = [(i, text(i, kinds[lang]), lang, None) for i, lang in enumerate(list(kinds) * 60)]
    docs = docs_of(spark, [*rows, (900, "12 34 !", "xa", None), (901, None, "xb", None)])
    got = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    right = [got[i]["lang_pred"] == lang for i, _, lang, _ in rows if got[i]["held_out"]]
    assert len(right) > 30 and sum(right) / len(right) > 0.97
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == "und"
    assert language_id.identify(odd).count() == odd.count() and language_id.identify(empty).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_kneser_ney_sums_to_one():
    import numpy as np
    import pandas as pd

    counts = Counter()
    for w in ["abra", "cadabra", "barbar"]:
        s = language_id.normalised(w)
        for i in range(1, len(s)):
            counts["x", s[max(0, i - 3):i + 1]] += 1
    model = language_id.build(pd.DataFrame([(a, g, n) for (a, g), n in counts.items()], columns=["lang", "gram", "n"]))
    letters = sorted({g[-1] for _, g in counts})
    for context in ("abr", "a", "rba"):
        total = sum(2.0 ** -(model.entropies([f"{context}{c}"])[0, 0] * len(context) - (model.entropies([context])[0, 0] * max(len(context) - 1, 1))) for c in letters)
        assert total + 2.0 ** (model.floor[0]) == pytest.approx(1.0, abs=0.1)
    assert np.isfinite(model.entropies(["zzz"])).all()

"""Spelling variants, SentencePiece encoding and the conversation trie against brute force
and the library, on odd input too."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tidewater.llm import prefix_trie, sentence_pieces, spelling

DOCS = "doc_id long, text string, id long, word string, ident string, ids string, n long"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def docs_of(spark, rows):
    """Documents with extra columns that clash with internal names."""
    return spark.createDataFrame([(i, t, 5, "w", "x", "y", 6) for i, t in rows], DOCS)


# --- 11 ------------------------------------------------------------------------------

def variants(rows):
    """word -> (form, root, n, n_near, form_n), comparing all words."""
    counts = Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 2}

    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    out = {}
    for w, n in words.items():
        near = [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(v, w)]
        top = min(near, key=lambda v: (-words[v], v), default=None)
        out[w] = [top if top and words[top] >= 10 * n else None, w, n, len(near)]
    for w in out:
        at = w
        while out[at][0]:
            at = out[at][0]
        out[w][1] = at
    return {w: (f, r, n, k, words[f] if f else None) for w, (f, r, n, k) in out.items()}


def found_variants(docs):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.group_variants(docs).collect()}


def test_variants_against_all_pairs(spark):
    random.seed(3)
    stems = ["window", "garden", "Élégance", "morning", "aaaaaaa", "çouelle"]
    rows = []
    for i in range(600):
        words = []
        for _ in range(8):
            w = random.choice(stems) + random.choice(["ing", "ung", "", "aa"])
            if random.random() < 0.15:
                at = random.randrange(len(w))
                w = w[:at] + random.choice(["", "x", "é", w[at] * 2]) + w[at + 1:]
            words.append(w.upper() if random.random() < 0.1 else w)
        rows.append((i, random.choice([" ", "1", "\n", "-"]).join(words)))
    rows += [(None, "morning mornings"), (None, "morning mornings"), (7, None), (8, ""), rows[0], rows[0]]
    want = variants(rows)
    assert found_variants(docs_of(spark, rows)) == want
    assert sum(1 for v in want.values() if v[0]) > 20 and max(v[3] for v in want.values()) > 5


def test_chain_ties_and_rare_words(spark):
    # Ids whose hash deletes nothing from these words.
    text = lambda n, w: [(i, w) for i in range(10**6) if zlib.crc32(f"{i}:{w}".encode()) % 31][:n]
    rows = text(200, "kitchena") + text(20, "kitchenb") + text(2, "kitchenbb") + text(1, "kitchenx") + text(20, "kitchenc")
    got = found_variants(docs_of(spark, rows))
    assert got["kitchenb"] == ("kitchena", "kitchena", 20, 3, 200)
    assert got["kitchenbb"] == ("kitchenb", "kitchena", 2, 1, 20)
    assert "kitchenx" not in got
    tied = found_variants(docs_of(spark, text(30, "kitchenb") + text(30, "kitchena") + text(2, "kitchenc")))
    assert tied["kitchenc"] == ("kitchena", "kitchena", 2, 2, 30)


def test_very_long_runs_and_empty_tables(spark):
    base = "abcdefghij" * 5000
    rows = [(1, base), (1, base), (2, base[:777] + "z" + base[778:] + " tail"), (2, base[:777] + "z" + base[778:])]
    got = found_variants(docs_of(spark, rows))
    assert sorted(v[3] for v in got.values()) == [1, 1]
    assert found_variants(docs_of(spark, []).limit(0)) == {}
    assert found_variants(docs_of(spark, [(1, None), (2, "")])) == {}


def test_node_numbers_name_paths():
    words = ["abcabca", "abcabcb", "xabcabc"]
    got = spelling.cuts(words, np.arange(3))
    rows = list(zip(*(c.to_pylist() for c in got.columns), strict=True))
    skips = Counter((p, s) for p, s, k, _ in rows if k)
    assert [n for n in skips.values() if n > 1] == [2]
    assert len({p for p, _, k, i in rows if not k and i < 2}) == 8 + 1  # seven letters, one differs


# --- 12 ------------------------------------------------------------------------------

ODD_TEXTS = [
    None, "", " ", "  a  ", "▁", "▁▁ a▁", "\n\n", "a\x00b", "日本語のテスト。", "é" * 50, "a" * 5000, " " * 1000 + "x", "\t\tx",
    "<s> </s> <unk> <0x0A>", "﻿hi", "😀😀 a", "the quick  brown\nfox" * 400, "⁇", "x" + " " * 17 + "y",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def pieces():
    with open(MODEL, "rb") as f:
        return sentence_pieces.PieceModel(f.read())


def test_pieces_of_random_texts(pieces, library):
    random.seed(5)
    names = list(pieces.ids)
    for k in range(6000):
        if k % 3 == 0:
            text = "".join(random.choice(names).replace("▁", " ") for _ in range(random.randint(1, 8)))
        elif k % 3 == 1:
            text = "".join(random.choice("  abe\nthing▁é日") for _ in range(random.randint(1, 30)))
        else:
            text = "".join(random.choice(names)[:random.randint(1, 5)] for _ in range(random.randint(1, 8)))
        ids = np.frombuffer(pieces.encode(text), "<u4").tolist()
        assert ids == library.encode(text, add_bos=True, add_eos=True), text
        assert pieces.decode(ids) == library.decode(ids), text


def test_search_steps_back(pieces):
    # A text on which the longest piece first is wrong and a taken piece has to go.
    def greedy(text):
        out = []
        while text:
            n = next(n for n in range(min(len(text), pieces.longest_name), 0, -1) if n == 1 or text[:n] in pieces.ids)
            out.append(text[:n])
            text = text[n:]
        return out

    random.seed(6)
    texts = ["".join(random.choice("theniongra") for _ in range(12)) for _ in range(300)]
    assert sum(pieces.cut(t) != greedy(t) for t in texts) > 50
    assert all(pieces.cut(t) == pieces.merged(t) for t in texts)


def test_any_ids_decode_as_in_the_library(pieces, library):
    random.seed(7)
    for _ in range(3000):
        ids = [random.choice([random.randrange(32_000), random.randrange(263)]) for _ in range(random.randint(0, 12))]
        assert pieces.decode(ids) == library.decode(ids), ids


def test_tables_of_texts(spark, library):
    rows = list(enumerate(ODD_TEXTS)) + [(None, "no id"), (3, "twice"), (3, "twice")]
    docs = docs_of(spark, rows)
    want = Counter((i, tuple(library.encode(t or "", add_bos=True, add_eos=True))) for i, t in rows)
    encoded = sentence_pieces.encode(docs, MODEL)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in encoded.collect()) == want
    decoded = sentence_pieces.decode(encoded, MODEL)
    assert Counter(tuple(r) for r in decoded.collect()) == Counter((i, library.decode(list(ids))) for i, ids in want.elements())
    for r in sentence_pieces.digest(docs.where("doc_id <> 3"), MODEL).collect():
        ids = library.encode(ODD_TEXTS[r["doc_id"]] or "", add_bos=True, add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    for out in (sentence_pieces.digest(docs.limit(0), MODEL), sentence_pieces.decode(encoded.limit(0), MODEL)):
        assert out.collect() == []


def test_one_very_long_text(pieces, library):
    random.seed(8)
    text = "".join(random.choice("abcdehiorst") for _ in range(300_000))
    assert np.frombuffer(pieces.encode(text), "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True)


# --- 13 ------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, pos long, f1 long, words string, block long, total long"


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "w", 3, 4) for r in rows], TURNS)


def trie_of(sequences):
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(list)
    for conv, seq in sequences.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(conv)
        ends[seq].append(conv)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved, out = {}, {}, []
    for path in sorted(members, key=len, reverse=True):
        n = len(members[path])
        leaves[path] = sum(leaves[c] for c in children[path]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        saved[path] = sum(saved[c] for c in children[path]) + (n - 1) * words
        digest = hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest()
        parent = min(members[path[:-1]]) if path else None
        out.append((min(members[path]), len(path), parent, n, len(children[path]), leaves[path], saved[path], digest))
    return Counter(out)


def sequences_of(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            sha = hashlib.sha256((text or "").encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, role or "", sha, text or ""))
    return {c: tuple((r[2], r[4]) for r in sorted(v)) for c, v in own.items()}


def rebuilt_of(sequences):
    out = {}
    for c, seq in sequences.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = sequences.get(c - c % 20, ())[:h] + seq[h:]
    return out


def shared_rows(seed, n):
    """Conversations that often begin like others, some equal, some very short."""
    random.seed(seed)
    rows = []
    for conv in random.sample(range(3 * n), n):
        common = random.choice([0, 1, 3, 9])
        for turn in range(random.randint(1, 10)):
            text = f"common {turn % 3} words" if turn < common else random.choice(["yes", "no", f"only {conv}", " "])
            rows.append((conv, turn, ["user", "assistant"][turn % 2], text))
    return rows


@pytest.mark.parametrize("segment", [1024, 2])
def test_trie_against_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(prefix_trie, "SEGMENT_TURNS", segment)
    rows = shared_rows(1, 300) + [
        (None, 1, "user", "nobody's"), (900, None, "user", "second"), (900, 0, None, None), (900, 0, None, None), (900, None, "a", "first"),
        (901, 5, "user", "tie b"), (901, 5, "user", "tie a"), (902, None, None, None)]
    got = Counter(tuple(r) for r in prefix_trie.conversation_trie(turns_of(spark, rows)).collect())
    assert got == trie_of(sequences_of(rows))
    got = Counter(tuple(r) for r in prefix_trie.rebuilt_trie(turns_of(spark, rows)).collect())
    assert got == trie_of(rebuilt_of(sequences_of(rows)))


def test_trie_of_a_very_long_conversation(spark):
    rows = [(1, t, "user", f"turn {t}") for t in range(3000)] + [(2, t, "user", f"turn {t}") for t in range(2500)]
    rows += [(3, 0, "user", "turn 0"), (4, 0, "user", "x" * 100_000)]
    got = Counter(tuple(r) for r in prefix_trie.conversation_trie(turns_of(spark, rows)).collect())
    assert sum(got.values()) == 1 + 3000 + 1
    by = {(r[0], r[1]): r for r in got}
    words = 2  # of each turn
    assert by[1, 0][3:7] == (4, 2, 2, (2 + 2499) * words)
    assert by[1, 2500][3:7] == (2, 1, 1, words) and by[1, 2501][3:7] == (1, 1, 1, 0)
    assert by[1, 3000][7] == hashlib.sha256(b"1").hexdigest() and by[1, 2500][7] == hashlib.sha256(b"2").hexdigest()
    assert by[4, 1][2] == 1


def test_trie_without_turns(spark):
    rows = [(24, 0, "user", "a")]  # crc32("24") % 4 decides; its base is absent
    got = Counter(tuple(r) for r in prefix_trie.rebuilt_trie(turns_of(spark, rows)).collect())
    assert got == trie_of(rebuilt_of(sequences_of(rows)))
    turnless = next(c for c in range(21, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4)
    got = prefix_trie.rebuilt_trie(turns_of(spark, [(turnless, 0, "user", "a")])).collect()
    assert [tuple(r)[:7] for r in got] == [(turnless, 0, None, 1, 0, 1, 0)]
    assert prefix_trie.rebuilt_trie(turns_of(spark, []).limit(0)).collect() == []
    assert prefix_trie.conversation_trie(turns_of(spark, [(None, 1, "a", "b")])).collect() == []

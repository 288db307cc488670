"""Fuzzy line deduplication.

Lines are compared in a normal form: ASCII letters in lower case, everything but letters, marks and numbers of any alphabet between words.  Each character of a script
written without spaces (``NO_SPACES``) is a word.  Lines of at least ``MIN_WORDS`` words
take part; shorter ones, and lines without words, are always kept.

1. Equal normal forms are one line (two 64-bit hashes, grouped with partial sums).
2. Each line has a 64-bit SimHash over its words and word pairs, digits as 0: lines that
   differ in digits only are candidates as well, and no more than that.  Two lines are near if
   their SimHashes differ in at most ``MAX_BITS`` (3) bits: of 5 blocks of bits at
   least 2 are then equal (pigeonhole), so SimHashes are joined on the 10 pairs of
   blocks.  Only different SimHashes are joined; they travel packed, many to a row, and
   a bucket gives a spanning forest of its near pairs (a bucket of up to 16 its pairs).
   Buckets and parts too large for a task are dealt again as pairs of blocks.
3. A changed word moves most SimHashes of a line of usual length by far more bits, so
   lines also meet by a pigeonhole on their words (``word_keys``): two lines are
   candidates if they agree in all but one word (under ``SHORT`` words), in a half,
   or in two neighbouring fifths (the last and the first are neighbours, too).  So
   any one word replaced, put in or left out is found, and so are replaced words in up
   to two fifths of a line.
4. Inside the components of step 2 and the buckets of step 3, candidates are verified: edit
   similarity of the normal forms, 1 - distance / length of the longer, of at least
   ``percent``.  Buckets of the same lines are one; large ones are dealt as pairs of blocks.
5. Components of the verified links are the groups; with equal lines they make a
   class, and the first line of a class (smallest doc_id, then place) is kept.

Edge cases: a null text has no lines and stays null; a null id's lines take part in
nothing and are kept; rows with the same id are told apart by nothing, so of the lines
at the first place of a class every row's is kept; repeated rows are treated alike; an
empty table gives an empty result; extra columns are kept as they are.  Texts are
processed whole, in slices of an Arrow batch.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import cache
from itertools import combinations
from operator import ne

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import broadcast_if_counted, free_name, written
from tidewater.llm.graph import Forest, components, in_blocks, per_block_pair, row_codes
from tidewater.llm.hashing import _P, _P_INV, U, _power_table, combine, lower_ascii, mix, run_hashes, runs, slices, sorted_distinct, text_bytes

MIN_WORDS = 5
MAX_BITS = 3
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # first bit, bits
PERCENT = 80
KEYS = 10
# SimHashes of a task's packed rows; a part of a key on average, and at most; a bucket's block.
PACK_ROWS = 1_000_000
PART_ROWS = 100_000
PART_MOST = 4_000_000
BUCKET_BLOCK = 1024
# Buckets of up to this many rows are compared all at once.
SMALL = 16
GROUP_BLOCK = 128
# Lines of fewer words meet by all words but one, longer ones by halves and fifths.
SHORT = 10
# Lines of a task's packed rows of word keys; keys of a part on average, and at most.
PACK_LINES = 100_000
PART_KEYS = 500_000
PART_KEYS_MOST = 8_000_000
# Bytes of text whose words are worked on at once: arrays of eight bytes a byte stay near the processor.
LINE_SLICE = 1 << 19
# Lines to fetch are broadcast up to this many: rows of an id, a place and two hashes.
FEW_LINES = 500_000

# Thai, Lao, Tibetan, Myanmar, Khmer, kana, bopomofo, Han, and Yi: first, last.
NO_SPACES = (
    (0x0E00, 0x0EFF), (0x0F00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x19E0, 0x19FF), (0x3005, 0x3007), (0x3021, 0x312F),
    (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA9E0, 0xA9FF), (0xAA60, 0xAA7F), (0xF900, 0xFAFF),
    (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF))


@cache
def _kinds() -> np.ndarray:
    """Of each code point: 0 between words, 1 in a word, 2 a word of its own."""
    kinds = np.array([unicodedata.category(chr(c))[0] in "LMN" for c in range(0x110000)], np.uint8)
    for first, last in NO_SPACES:
        kinds[first:last + 1] *= 2
    return kinds


class _Form(dict):
    """Code points to themselves in lower case (ASCII), or a space between words."""

    def __missing__(self, c: int) -> int:
        self[c] = (c + 32 if 65 <= c <= 90 else c) if _kinds()[c] else 32
        return self[c]


_FORM = _Form()


def normal_form(line: str) -> str:
    """The compared form of a line (ASCII letters in lower case)."""
    return " ".join(line.translate(_FORM).split())


def word_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the words of texts (UTF-8 bytes, lower-cased)."""
    word = ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57))
    cuts = [offsets]
    leads = np.flatnonzero(data >= 0xC0)
    if len(leads):
        lead = data[leads]
        length = 2 + (lead >= 0xE0) + (lead >= 0xF0).astype(np.int64)
        code = lead.astype(np.int64) & np.array([0x1F, 0x0F, 0x07])[length - 2]
        for i in range(1, 4):
            more = length > i
            code[more] = (code[more] << 6) | (data[leads[more] + i] & 0x3F)
        kinds = _kinds()[code]
        for i in range(4):
            word[leads[(kinds > 0) & (length > i)] + i] = True
        own = kinds == 2
        cuts += [leads[own], leads[own] + length[own]]
    return runs(word, np.concatenate(cuts))


def word_keys(words: np.ndarray, first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pigeonhole keys of runs of words (hashes): the run's number and the key, by run.

    Under ``SHORT`` words: the run, and the run without each of its words.  From one
    word less: the first and the last half, of both sizes if the words are odd (so runs that
    differ by a word put in share one).  From ``SHORT``: the five pairs of neighbouring
    fifths in a ring, with the number of words; two changed fifths leave a pair.
    """
    n = len(words)
    sums = np.zeros(n + 1, U)
    powers, inverse = _power_table(_P, n + 1), _power_table(_P_INV, n + 1)
    with np.errstate(over="ignore"):
        np.cumsum(mix(words, 51) * powers[:n], out=sums[1:])

        def span(start: np.ndarray, end: np.ndarray) -> np.ndarray:
            return (sums[end] - sums[start]) * inverse[start]

        last = first + counts
        short = np.flatnonzero(counts < SHORT)
        found = [(short, mix(span(first[short], last[short]), 60))]
        for i in range(SHORT - 1):
            own = short[counts[short] > i]
            at = first[own] + i
            found.append((own, mix(span(first[own], at) + powers[i] * span(at + 1, last[own]), 60)))
        for odd in (0, 1):
            own = np.flatnonzero((counts >= SHORT - 1) & (counts % 2 >= odd))
            half = (counts[own] + odd) // 2
            found.append((own, mix(span(first[own], first[own] + half), 61)))
            found.append((own, mix(span(last[own] - half, last[own]), 62)))
        own = np.flatnonzero(counts >= SHORT)
        start, size = first[own], counts[own]
        fifths = [span(start + i * size // 5, start + (i + 1) * size // 5) for i in range(5)]
        for i in range(5):
            found.append((own, combine([size.astype(U), fifths[i], fifths[(i + 1) % 5]], 64 + i)))
    own, keys = (np.concatenate(v) for v in zip(*found, strict=True))
    order = np.argsort(own, kind="stable")
    return own[order], keys[order]


def line_rows(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """doc_id, place, two hashes, SimHash, packed word keys of the lines that take part."""
    data, offsets = text_bytes(batch.column(1))
    if not len(data):
        return None
    data = lower_ascii(data)
    starts, ends = word_runs(data, offsets)
    if not len(starts):
        return None
    hashes = run_hashes(data, starts, ends)
    # Lines: cut after each line feed and at each text's start.
    line_starts = sorted_distinct(np.concatenate((offsets[:-1], np.flatnonzero(data == 10) + 1)))
    of_line = np.searchsorted(line_starts, starts, side="right") - 1
    first = np.flatnonzero(np.concatenate(([True], of_line[1:] != of_line[:-1])))
    counts = np.diff(np.append(first, len(starts)))
    big = counts >= MIN_WORDS
    if not big.any():
        return None
    place_in_line = np.arange(len(starts)) - np.repeat(first, counts)
    with np.errstate(over="ignore"):
        h1 = np.add.reduceat(mix(hashes + mix(place_in_line.astype(U), 21), 3), first)
        h2 = np.add.reduceat(mix(hashes ^ mix(place_in_line.astype(U), 22), 4), first)
    sims = simhash(folded_hashes(data, starts, ends, hashes), first, counts)
    key_line, keys = word_keys(hashes, first[big], counts[big])
    key_cuts = np.searchsorted(key_line, np.arange(int(big.sum()) + 1)) * 8
    packed = pa.Array.from_buffers(
        pa.binary(), len(key_cuts) - 1, [None, pa.py_buffer(key_cuts.astype(np.int32)), pa.py_buffer(keys)])
    lines = of_line[first][big]
    doc = np.searchsorted(offsets, line_starts[lines], side="right") - 1
    # Place of a line in its text: the text's lines before it.
    place = lines - np.searchsorted(line_starts, offsets[doc])
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(pa.array(doc)), pa.array(place, pa.int32()), pa.array(h1[big].view(np.int64)),
         pa.array(h2[big].view(np.int64)), pa.array(sims[big].view(np.int64)), packed],
        names=["doc_id", "place", "h1", "h2", "sim", "keys"])


def folded_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Hashes of the words with every digit as 0, from ``hashes`` of the words as they are: only words
    with a digit are hashed again."""
    digits = np.flatnonzero((data >= 49) & (data <= 57))
    if not len(digits):
        return hashes
    own = np.searchsorted(starts, digits, side="right") - 1
    own = own[np.concatenate(([True], own[1:] != own[:-1]))]
    sizes = ends[own] - starts[own]
    new_ends = np.cumsum(sizes)
    new_starts = new_ends - sizes
    part = data[np.arange(new_ends[-1]) + np.repeat(starts[own] - new_starts, sizes)]
    part[(part >= 49) & (part <= 57)] = 48
    out = hashes.copy()
    out[own] = run_hashes(part, new_starts, new_ends)
    return out


# A byte's bits as eight bytes of 0 or 1.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(U).ravel()


def simhash(hashes: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """64-bit SimHash of each run of words: a bit is set if it is set in more than
    half of the hashes of the run's words and word pairs."""
    pairs = np.zeros_like(hashes)
    if len(hashes) > 1:
        pairs[:-1] = combine([hashes[:-1], hashes[1:]], 12)
    # The last word's pair would cross into the next line.
    pairs[first + counts - 1] = 0
    # Runs are summed in parts of up to 127 words and as many pairs: eight counters of a byte each in
    # one 64-bit sum per byte of the hashes.
    parts = np.flatnonzero((np.arange(len(hashes)) - np.repeat(first, counts)) % 127 == 0)
    run_parts = np.searchsorted(parts, first)
    words, pairs = (h.view(np.uint8).reshape(-1, 8) for h in (mix(hashes, 11), pairs))
    sums = np.empty((len(parts), 64), np.uint8)
    for b in range(8):
        lanes = np.add.reduceat(_LANES[words[:, b]] + _LANES[pairs[:, b]], parts)
        sums[:, 8 * b:8 * b + 8] = lanes.view(np.uint8).reshape(-1, 8)
    total = np.add.reduceat(sums.astype(np.int32), run_parts, axis=0)
    return np.packbits(total * 2 > (2 * counts - 1)[:, None], axis=1, bitorder="little").reshape(-1).view(U)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, size=LINE_SLICE):
            out = line_rows(part)
            if out is not None:
                yield out


def bucket(sims: np.ndarray, key: int) -> np.ndarray:
    """Pigeonhole key ``key`` (of ten) of each SimHash: two blocks' bits and the number."""
    (x, m), (y, n) = list(combinations(BLOCKS, 2))[key]
    first, second = (sims >> U(x)) & U((1 << m) - 1), (sims >> U(y)) & U((1 << n) - 1)
    return (first << U(17)) | (second << U(4)) | U(key)


def _packed(parts: int):
    """SimHashes by key and by the bucket's hash modulo ``parts``, packed as bytes."""
    def pack(sims: np.ndarray) -> pa.RecordBatch:
        rows: list[tuple[int, int, bytes]] = []
        for key in range(KEYS):
            part = mix(bucket(sims, key), 31) % U(parts)
            order = np.argsort(part, kind="stable")
            part, ordered = part[order], sims[order]
            cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
            rows += [(int(part[at]), key, ordered[at:to].tobytes()) for at, to in zip(cuts, cuts[1:], strict=False)]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["part", "key", "sims"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy().view(U))
            n += len(held[-1])
            if n >= PACK_ROWS:
                yield pack(np.concatenate(held))
                held, n = [], 0
        if n:
            yield pack(np.concatenate(held))

    return run


def _links(a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.nulls(len(a), pa.int64())], names=["a", "b", "bucket"])


def _left_over(sims: np.ndarray, key: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(sims.view(np.int64)), pa.nulls(len(sims), pa.int64()), pa.array(bucket(sims, key).view(np.int64))],
        names=["a", "b", "bucket"])


def near_in_part(sims: np.ndarray, key: int, block: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b) that connect the near SimHashes of every bucket of up to ``block``
    rows; rows (a, null, bucket) of the larger buckets, left for dealing."""
    buckets = bucket(sims, key)
    order = np.lexsort((sims, buckets))
    sims, buckets = sims[order], buckets[order]
    first = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1])))
    counts = np.diff(np.append(first, len(sims)))
    # Small buckets: neighbours at each distance, all buckets at once.
    small = np.flatnonzero(np.repeat((counts > 1) & (counts <= SMALL), counts))
    for step in range(1, SMALL):
        small = small[small + step < len(sims)]
        small = small[buckets[small + step] == buckets[small]]
        if not len(small):
            break
        near = small[np.bitwise_count(sims[small] ^ sims[small + step]) <= MAX_BITS]
        if len(near):
            yield _links(sims[near], sims[near + step])
    for at, n in zip(first[counts > SMALL].tolist(), counts[counts > SMALL].tolist(), strict=True):
        if n > block:
            yield _left_over(sims[at:at + n], key)
        else:
            links = forest_links(sims[at:at + n])
            if links is not None:
                yield _links(*links)


def forest_links(sims: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """A spanning forest of the SimHashes within ``MAX_BITS`` bits."""
    forest = Forest(len(sims))
    for x in range(len(sims) - 1):
        for y in np.flatnonzero(np.bitwise_count(sims[x + 1:] ^ sims[x]) <= MAX_BITS).tolist():
            forest.join(x, x + 1 + y)
    if not forest.links:
        return None
    a, b = zip(*forest.links, strict=True)
    return sims[list(a)], sims[list(b)]


def near_sims(sims: DataFrame, n: int, part_rows: int = PART_ROWS, most: int = PART_MOST, block: int = BUCKET_BLOCK) -> DataFrame:
    """Links (a, b) whose components are those of all near pairs of the distinct
    SimHashes ``sims`` (column ``sim``, about ``n`` rows).

    A SimHash goes, packed, to one part per key.  A part that turns out larger than
    ``most`` and a bucket larger than ``block`` are not worked on where they are read:
    their rows are dealt again, as pairs of blocks.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held, over, last = [], 0, False, None

        def finish() -> Iterator[pa.RecordBatch]:
            if held and over:
                yield _left_over(np.concatenate(held), last[1])
            elif held:
                yield from near_in_part(np.concatenate(held), last[1], block)

        for batch in batches:
            for part, key, packed in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (part, key) != last:
                    yield from finish()
                    held, n_held, over, last = [], 0, False, (part, key)
                held.append(np.frombuffer(packed, U))
                n_held += len(held[-1])
                if n_held > most:
                    over = True
                    yield from finish()
                    held, n_held = [], 0
        yield from finish()

    parts = max(1, -(-n // part_rows))
    dealt = sims.select("sim").mapInArrow(_packed(parts), "part long, key int, sims binary")
    found = written(
        dealt.repartition("part", "key").sortWithinPartitions("part", "key").mapInArrow(work, "a long, b long, bucket long"), "near-sims")
    left = found.where(F.col("bucket").isNotNull()).select(F.col("a").alias("sim"), "bucket")
    rest = per_block_pair(
        in_blocks(left, "bucket", "sim", block).select("sim", "_group", "_i", "_j"), near_work, "a long, b long")
    return found.where(F.col("bucket").isNull()).select("a", "b").unionByName(rest)


def near_work(table: pa.Table) -> pa.RecordBatch | None:
    """Of a bucket's block pair: a spanning forest of the near SimHashes."""
    links = forest_links(sorted_distinct(table.column("sim").to_numpy().view(U)))
    if links is None:
        return None
    a, b = (v.view(np.int64) for v in links)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _packed_keys(parts: int):
    """(h1, keys) of lines to rows of a part: 32 bits of the different keys (with the part they
    tell nearly all apart, and what meets by chance is verified), and their lines."""
    def pack(h1: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
        h1, keys = _distinct(keys, h1)[::-1]
        part = mix(keys, 32) % U(parts)
        order = np.argsort(part, kind="stable")
        part, keys, h1 = part[order], keys[order].astype(np.uint32), h1[order]
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        spans = list(zip(cuts, cuts[1:], strict=False))
        return pa.RecordBatch.from_arrays(
            [pa.array(part[cuts[:-1]].astype(np.int64)), pa.array([keys[a:b].tobytes() for a, b in spans], pa.binary()),
             pa.array([h1[a:b].tobytes() for a, b in spans], pa.binary())], names=["part", "keys", "lines"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = pc.binary_length(batch.column(1)).to_numpy() // 8
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), U)
            held.append((np.repeat(batch.column(0).to_numpy().view(U), sizes), keys))
            n += batch.num_rows
            if n >= PACK_LINES:
                yield pack(*(np.concatenate(v) for v in zip(*held, strict=True)))
                held, n = [], 0
        if n:
            yield pack(*(np.concatenate(v) for v in zip(*held, strict=True)))

    return run


def _distinct(keys: np.ndarray, h1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different (key, line), sorted."""
    order = np.lexsort((h1, keys))
    keys, h1 = keys[order], h1[order]
    new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (h1[1:] != h1[:-1])))
    return keys[new], h1[new]


def shared_in_part(part: int, keys: np.ndarray, h1: np.ndarray, whole: bool) -> pa.RecordBatch:
    """(bucket, h1) of the lines that share a key.  A whole part's buckets are named by their
    lines, so that those of the same lines are one; in a piece of a part, every row is given."""
    keys, h1 = _distinct(keys, h1)
    if whole:
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        counts = np.diff(np.append(first, len(keys)))
        with np.errstate(over="ignore"):
            names = np.repeat(mix(np.add.reduceat(mix(h1, 33), first), 34), counts)
        several = np.repeat(counts > 1, counts)
        names, h1 = names[several], h1[several]
    else:
        names = combine([np.full(len(keys), part, U), keys.astype(U)], 35)
    return pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(h1.view(np.int64))], names=["bucket", "h1"])


def word_buckets(lines: DataFrame, n: int, part_keys: int = PART_KEYS, most: int = PART_KEYS_MOST) -> DataFrame:
    """(bucket, h1): the lines (h1, keys), about ``n`` different ones, that share a word key.

    A part that turns out larger than ``most`` is passed on in pieces, with every row; buckets of
    one line among these are for the reader to leave out.
    """
    parts = max(1, -(-n * 8 // part_keys))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held, over, last = [], 0, False, None

        def finish() -> Iterator[pa.RecordBatch]:
            if held:
                yield shared_in_part(last, *(np.concatenate(v) for v in zip(*held, strict=True)), not over)

        for batch in batches:
            for part, keys, h1 in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if part != last:
                    yield from finish()
                    held, n_held, over, last = [], 0, False, part
                held.append((np.frombuffer(keys, np.uint32), np.frombuffer(h1, U)))
                n_held += len(held[-1][0])
                if n_held > most:
                    over = True
                    yield from finish()
                    held, n_held = [], 0
        yield from finish()

    dealt = lines.select("h1", "keys").mapInArrow(_packed_keys(parts), "part long, keys binary, lines binary")
    found = dealt.repartition("part").sortWithinPartitions("part").mapInArrow(work, "bucket long, h1 long")
    return written(found.distinct(), "word-buckets")


def _common(most: int, same: Callable[[int], bool]) -> int:
    """The largest length up to ``most`` that is ``same``, which shorter ones are then as well."""
    least = 0
    while least < most:
        n = (least + most + 1) // 2
        if same(n):
            least = n
        else:
            most = n - 1
    return least


def edit_distance(a: str, b: str, most: int | None = None) -> int:
    """Levenshtein distance by bit-parallel columns (Myers, Hyyro), without the
    common start and end; some number above ``most`` as soon as it is above."""
    if len(a) > len(b):
        a, b = b, a
    at = _common(len(a), lambda n: a[:n] == b[:n])
    rest = _common(len(a) - at, lambda n: a[len(a) - n:] == b[len(b) - n:])
    a, b = a[at:len(a) - rest], b[at:len(b) - rest]
    if not a:
        return len(b)
    n = len(a)
    full, top = (1 << n) - 1, 1 << (n - 1)
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | (1 << i)
    plus, minus, score = full, 0, n
    # The score falls by at most one a column.
    above = (2 * len(b) if most is None else most) + len(b)
    for c in b:
        eq = places.get(c, 0)
        zero = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | (full & ~(zero | plus))
        down = plus & zero
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = ((up << 1) | 1) & full
        down = (down << 1) & full
        plus = down | (full & ~(zero | up))
        minus = up & zero
        above -= 1
        if score > above:
            break
    return score


def similar(a: str, b: str, percent: int) -> bool:
    """Whether the edit similarity of two strings is at least ``percent``."""
    longest = max(len(a), len(b))
    most = longest * (100 - percent) // 100
    if abs(len(a) - len(b)) > most:
        return False
    # Bounds from above decide most near pairs: changed characters, then changed words, each at its place.
    if len(a) == len(b) and sum(map(ne, a, b)) <= most:
        return True
    x, y = a.split(" "), b.split(" ")
    if len(x) == len(y) and sum(max(len(v), len(w)) for v, w in zip(x, y, strict=True) if v != w) <= most:
        return True
    return edit_distance(a, b, most) <= most


def verified_links(lines: list[str | None], sims: list[int], by_sim: bool, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the verified candidates among the lines of a block pair of a cluster of
    SimHashes (``by_sim``) or of a bucket of words: pairs of their places."""
    forms = [normal_form(t or "") for t in lines]
    forest = Forest(len(forms))
    words = np.array(sims, np.int64).view(U) if by_sim else None
    for x in range(len(forms) - 1):
        others = range(x + 1, len(forms))
        if by_sim:
            others = (np.flatnonzero(np.bitwise_count(words[x + 1:] ^ words[x]) <= MAX_BITS) + x + 1).tolist()
        for y in others:
            if forest.root(x) != forest.root(y) and similar(forms[x], forms[y], percent):
                forest.join(x, y)
    return forest.links


def verify(dealt: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of the verified candidates of each block pair of ``dealt`` (``in_blocks`` of node, sim, line,
    by_sim).  Most block pairs have two or three rows, so a batch's rows are read as lists once."""
    by = ["_group", "_i", "_j"]
    together = dealt.repartition(*by).sortWithinPartitions(*by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, ([], [], [], [])
        found: list[tuple[str, str]] = []

        def finish() -> None:
            nodes, sims, lines, by_sim = held
            if len(nodes) > 1:
                found.extend((nodes[x], nodes[y]) for x, y in verified_links(lines, sims, by_sim[0], percent))

        def flush() -> pa.RecordBatch:
            a, b = zip(*found, strict=True)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            keys = table.select(by)
            code = row_codes(keys)
            cuts = [0, *(np.flatnonzero(code[1:] != code[:-1]) + 1).tolist(), table.num_rows]
            columns = [table.column(c).to_pylist() for c in ("node", "sim", "line", "by_sim")]
            for at, to in zip(cuts, cuts[1:], strict=False):
                # Only a batch's first rows may go on with the block pair of the batch before.
                if at or keys.slice(0, 1).to_pylist() != last:
                    finish()
                    held = ([], [], [], [])
                for own, column in zip(held, columns, strict=True):
                    own.extend(column[at:to])
            last = keys.slice(table.num_rows - 1, 1).to_pylist()
            if found:
                yield flush()
        finish()
        if found:
            yield flush()

    return together.mapInArrow(run, "a string, b string")


def repeated_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, places): places (from 0) of each document's lines to remove."""
    kind = dict(docs.dtypes)["doc_id"]
    texts = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    lines = written(texts.mapInArrow(_lines, f"doc_id {kind}, place int, h1 long, h2 long, sim long, keys binary"), "lines")
    forms = written(lines.groupBy("h1", "h2").agg(
        F.min(F.struct("doc_id", "place")).alias("first"), F.min("sim").alias("sim"), F.count(F.lit(1)).alias("n")), "line-forms")

    # Components of near SimHashes; a SimHash of several forms is one as well.
    sims = forms.groupBy("sim").agg(F.count(F.lit(1)).alias("n_forms"))
    n_forms = forms.count()
    near = near_sims(sims, n_forms)
    clusters = components(near)
    grouped = sims.join(clusters, F.col("sim") == F.col("node"), "left").where(
        F.col("component").isNotNull() | (F.col("n_forms") > 1)).select(
        F.col("sim").alias("near_sim"), F.coalesce("component", "sim").alias("cluster"))

    # Texts of the forms in clusters or buckets, from their first places.
    buckets = word_buckets(lines, n_forms)
    node = F.concat(F.hex("h1"), F.lit("-"), F.hex("h2"))
    in_cluster = forms.join(broadcast_if_counted(grouped), F.col("sim") == F.col("near_sim")).select("h1", "h2")
    in_bucket = forms.join(buckets.select("h1").distinct(), "h1", "left_semi").select("h1", "h2")
    wanted = written(
        forms.join(in_cluster.unionByName(in_bucket).distinct(), ["h1", "h2"]).select(
            "h1", "h2", "sim", F.col("first.doc_id").alias("at_id"), F.col("first.place").alias("at_place")), "near-lines")
    found = written(
        texts.select("doc_id", F.posexplode(F.split("text", "\n")).alias("place", "line"))
        .join(broadcast_if_counted(wanted, FEW_LINES), (F.col("doc_id") == F.col("at_id")) & (F.col("place") == F.col("at_place")))
        .select("h1", node.alias("node"), "sim", "line")
        .dropDuplicates(["node"]), "near-texts")
    together = found.join(grouped, F.col("sim") == F.col("near_sim")).select(
        "node", "sim", "line", F.lit(True).alias("by_sim"), F.col("cluster").alias("near"))
    together = together.unionByName(found.join(buckets, "h1").select(
        "node", "sim", "line", F.lit(False).alias("by_sim"), F.col("bucket").alias("near")))
    together = together.withColumn("near", F.struct("by_sim", "near"))
    links = verify(
        in_blocks(together, "near", "node", GROUP_BLOCK).select("node", "sim", "line", "by_sim", "_group", "_i", "_j"), percent)
    linked = components(links)

    # First place of every class of more than one line.
    classes = forms.join(
        broadcast_if_counted(linked.withColumnRenamed("node", "linked_node")), node == F.col("linked_node"), "left")
    firsts = written(classes.where(F.col("component").isNotNull()).groupBy("component").agg(
        F.min("first").alias("class_first"), F.count(F.lit(1)).alias("size")), "class-firsts")
    # Classes of more than a thousandth of the forms, so under a thousand rows: their lines stay where they are, and
    # neither they nor lines without a class meet in one task.
    hot = firsts.where(F.col("size") * 1000 > n_forms).select(
        F.col("component").alias("hot_component"), F.col("class_first").alias("hot_first"))
    told = classes.where((F.col("n") > 1) | F.col("component").isNotNull()).join(
        F.broadcast(hot), F.col("component") == F.col("hot_component"), "left").withColumn(
        "class_key", F.coalesce(F.when(F.col("hot_component").isNull(), F.col("component")), node))
    several = told.join(
        firsts.select(F.col("component").alias("class_key"), "class_first"), "class_key", "left").select(
        "h1", "h2", F.coalesce("hot_first", "class_first", "first").alias("kept"))
    gone = lines.join(several, ["h1", "h2"]).where(F.struct("doc_id", "place") != F.col("kept"))
    return gone.groupBy("doc_id").agg(F.sort_array(F.collect_set("place")).alias("places"))


def remove_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with repeated lines taken out of the texts, and two columns of counts at the
    end, ``_lines`` and ``_removed`` (with an underscore behind a name that ``docs`` has already)."""
    ident, places, parts, n_lines, n_removed = (free_name(docs, c) for c in ("_id", "places", "_parts", "_lines", "_removed"))
    gone = written(repeated_lines(docs, percent), "repeated-lines").select(
        F.col("doc_id").alias(ident), F.col("places").alias(places))
    # One plan at every size: most inputs have too many removals to broadcast.
    joined = docs.join(gone.hint("merge"), F.col("doc_id") == F.col(ident), "left")
    joined = joined.withColumn(parts, F.split("text", "\n"))
    # What is left is the lines between neighbouring places: linear in the lines, as ``parts``, read twice, is
    # a column of its own (rows that share an id may have places past their end).
    cuts = F.filter(places, lambda p: p < F.size(parts))
    left = F.flatten(F.zip_with(
        F.concat(F.array(F.lit(-1)), cuts), F.concat(cuts, F.array(F.size(parts))),
        lambda after, until: F.slice(parts, after + 2, until - after - 1)))
    return joined.withColumn(n_lines, F.coalesce(F.size(parts), F.lit(0)).cast("long")).withColumn(
        "text", F.when(F.col(places).isNotNull(), F.array_join(left, "\n")).otherwise(F.col("text"))).withColumn(
        n_removed, F.coalesce(F.size(places), F.lit(0)).cast("long")).drop(ident, places, parts)


def digest(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """op7: per document doc_id, n_lines, n_removed, and the length and SHA-256 of
    what is left."""
    left = remove_lines(docs.select("doc_id", "text"), percent)
    return left.select(
        "doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.col("_lines")).cast("long").alias("n_lines"),
        F.col("_removed").alias("n_removed"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("kept_chars"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))

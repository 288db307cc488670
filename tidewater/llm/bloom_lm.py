"""Language-model scores from a log-frequency Bloom filter.

The filter holds the counts of all words and word pairs of the training texts, as
quantised logarithms: an n-gram with count c is stored with each of the levels 1 ..
1 + floor(log2 c).  A count is read back by probing levels 1, 2, ... until one is
missing; an n-gram is never read too low, and too high only by a false positive.
Probabilities are smoothed from these: p(w | v) = (c(v w) + M p(w)) / (c(v) + M) with
p(w) = (c(w) + 1) / (N + V + 1), where a level stands for the middle of its range.

Counting is distributed.  Tasks send their n-grams as sorted arrays, a row per
segment (a part of the hash space); a segment's rows are merged and give the
bits of that segment of the filter, sized for the keys (n-gram, level) counted in it:
``BITS_PER_KEY`` bits each, so a probe for a missing key is wrong in about 1.4 % of
cases at every input size.  A filter of up to ``MAX_FILTER_BYTES`` is broadcast.  A
larger one stays a table: texts are packed into chunks and cross one shuffle, by chunk;
a chunk's different n-grams go packed to the parts of the filter (up to ``PART_BYTES``
each), are read there, and their levels go back to the chunk, which is then scored in
the same way.

Exact counts of the words (for ``base_score``) are a table.  The most frequent
``HEAD_WORDS`` are broadcast; a document's other words are summed in the document,
joined with the table, and summed back by document.

Edge cases: a null text counts as empty: one token, the end; a null id is not held
out; without training texts all counts are 0; repeated rows are counted and scored each
(rows that share an id share their rare words' sums, so they are numbered by the
hash of their text too); an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import written
from tidewater.llm.hashing import U, combine, mix, slices, sorted_distinct, words_of
from tidewater.llm.quality_classifier import held_out

MAX_FILTER_BYTES = 1 << 20
PART_BYTES = 4 << 20
BITS_PER_KEY = 16
# Texts of a chunk, where the filter is read in parts.
CHUNK_BYTES = 8 << 20
# Bytes of text whose tokens are worked on at once.
TOKEN_SLICE = 1 << 20
HEAD_WORDS = 300_000
PROBES = 2
MAX_LEVEL = 40
PRIOR_WEIGHT = 50.0
END = U(0x51ED270B0A1F39C1)  # the end's hash, in place of a word's
START = U(0x2545F4914F6CDD1D)
# A task's counts are sent on when they have this many different n-grams.
FLUSH = 3_000_000
# N-grams that are read from a part of the filter at once.
READ_AT_ONCE = 1_000_000


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of the texts (words, then the end) and offsets."""
    words = words_of(column)
    n = words.texts()
    offsets = words.offsets + np.arange(n + 1)
    tokens = np.full(offsets[-1], END, U)
    is_word = np.ones(len(tokens), bool)
    is_word[offsets[1:] - 1] = False
    tokens[is_word] = words.hashes
    return tokens, offsets


def pair_hashes(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it (the start before the first)."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[offsets[:-1]] = START
    return combine([before, tokens], 31)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, sorted, and the sums of their counts."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts[order], first).astype(np.int64) if len(first) else np.zeros(0, np.int64)


def packed_ints(values: np.ndarray) -> bytes:
    """Numbers from 0, compressed byte by byte: all lowest bytes, then all next ones."""
    width = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 1
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return struct.pack("<BI", width, len(values)) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked_ints(data: bytes) -> np.ndarray:
    width, n = struct.unpack_from("<BI", data)
    out = np.zeros((n, 8), np.uint8)
    planes = pa.decompress(data[5:], decompressed_size=width * n, codec="zstd", asbytes=True)
    out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.view("<u8").ravel()


def packed_sorted(values: np.ndarray) -> bytes:
    """Sorted numbers as their differences."""
    return packed_ints(np.diff(values, prepend=U(0)))


def unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked_ints(data), dtype=U)


def _counted(
    batches: Iterator[pa.RecordBatch], keys_of: Callable[[pa.Array], np.ndarray],
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Different keys of a task's texts and their counts, in one lot or, past ``FLUSH`` keys, several."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        for part in slices(batch, size=TOKEN_SLICE):
            parts.append(np.unique(keys_of(part.column(0)), return_counts=True))
            size += len(parts[-1][0])
            if size > FLUSH:
                parts = [_summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))]
                size = len(parts[0][0])
                if size > FLUSH // 2:
                    yield parts[0]
                    parts, size = [], 0
    if parts:
        yield _summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to (word, n): token hashes and counts, summed over parts of a task."""
    for keys, counts in _counted(batches, lambda texts: tokens_of(texts)[0]):
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["word", "n"])


def _segments(n_bits: int):
    """Texts to (segment, keys, counts): n-grams by segment, packed."""
    shift = U(64 - n_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in _counted(batches, lambda texts: _ngrams(*tokens_of(texts))):
            cuts = np.searchsorted(keys >> shift, np.arange((1 << n_bits) + 1)) if n_bits else np.array([0, len(keys)])
            # 32 bits after the segment's: together they tell n-grams apart.
            keys, counts = (keys >> (shift - U(32))) & U(0xFFFFFFFF), np.minimum(counts, 0xFFFFFFFF)
            rows = [(s, a, b) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            for at in range(0, len(rows), 64):
                part = rows[at:at + 64]
                yield pa.RecordBatch.from_arrays([
                    pa.array([s for s, _, _ in part], pa.int32()),
                    pa.array([packed_sorted(keys[a:b]) for _, a, b in part], pa.binary()),
                    pa.array([packed_ints(counts[a:b]) for _, a, b in part], pa.binary()),
                ], names=["segment", "keys", "counts"])

    return run


def levels(counts: np.ndarray) -> np.ndarray:
    """Quantised log frequency: 1 + floor(log2 count)."""
    return np.minimum(np.frexp(counts.astype(np.float64))[1], MAX_LEVEL)


def level_count(level: np.ndarray) -> np.ndarray:
    """The count a level stands for: the middle of its range, 0 for level 0."""
    return np.where(level > 0, 0.75 * np.exp2(level.astype(np.float64)), 0.0).clip(0) * (level != 1) + (level == 1)


def places(keys: np.ndarray, level: int | np.ndarray, probe: int, size: int | np.ndarray) -> np.ndarray:
    """Bit places of 32-bit keys at a level in a segment of ``size`` bits."""
    with np.errstate(over="ignore"):
        h = mix(keys.astype(U) + (np.asarray(level).astype(U) << U(33)), 40 + probe)
    return ((h >> U(32)) * np.asarray(size).astype(U) >> U(32)).astype(np.int64)


def _filter_bits():
    """Rows of segments, together and sorted, to (segment, bits)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, counts = None, [], []

        def segment() -> pa.RecordBatch:
            k, c = _summed(np.concatenate(keys), np.concatenate(counts))
            top = levels(c)
            size = -(-int(top.sum()) * BITS_PER_KEY // 64) * 64
            bits = np.zeros(size, np.uint8)
            for level in range(1, int(top.max()) + 1):
                own = k[top >= level]
                for probe in range(PROBES):
                    bits[places(own, level, probe, size)] = 1
            packed = np.packbits(bits, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([packed], pa.binary())], names=["segment", "bits"])

        for batch in batches:
            for s, k, c in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if now is not None and s != now:
                    yield segment()
                    keys, counts = [], []
                now = s
                keys.append(unpacked_sorted(k))
                counts.append(unpacked_ints(c))
        if keys:
            yield segment()

    return run


@dataclass(frozen=True)
class LogFrequencyFilter:
    n_bits: int  # segments: 2**n_bits
    size: int | np.ndarray  # bits in a segment, or in each
    bits: np.ndarray  # all segments, packed
    first: int = 0  # the first segment, if these are a part of the filter

    def has(self, keys: np.ndarray, level: int) -> np.ndarray:
        shift = U(64 - self.n_bits)
        segment = (keys >> shift).astype(np.int64) - self.first if self.n_bits else np.zeros(len(keys), np.int64)
        low = (keys >> (shift - U(32)) if self.n_bits else keys >> U(32)) & U(0xFFFFFFFF)
        if np.ndim(self.size):
            start, size = (np.cumsum(self.size) - self.size)[segment], self.size[segment]
        else:
            start, size = segment * self.size, self.size
        out = np.ones(len(keys), bool) & (size > 0)
        if not len(self.bits):
            return out & False
        for probe in range(PROBES):
            # A segment without keys has no bits: any place does.
            at = np.minimum(start + places(low, level, probe, size), len(self.bits) * 8 - 1)
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out

    def level(self, keys: np.ndarray) -> np.ndarray:
        """Levels of n-gram hashes, by repeated probes."""
        out = np.zeros(len(keys), np.int8)
        left = np.arange(len(keys))
        for level in range(1, MAX_LEVEL + 1):
            left = left[self.has(keys[left], level)]
            if not len(left):
                break
            out[left] = level
        return out


def filter_rows(train: DataFrame, n_tokens: int) -> tuple[DataFrame, int]:
    """The filter of all words and pairs of ``train`` (text) as a table (segment, bits),
    and the number of its segments as a power of two; segments without keys have no row."""
    n_bits = int(min(max(np.ceil(np.log2(max(n_tokens, 1) / (1 << 17))), 4), 20))
    rows = train.select("text").mapInArrow(_segments(n_bits), "segment int, keys binary, counts binary")
    made = rows.repartition("segment").sortWithinPartitions("segment").mapInArrow(_filter_bits(), "segment int, bits binary")
    return written(made, "filter"), n_bits


def build_filter(table: DataFrame, n_bits: int) -> LogFrequencyFilter:
    """The whole filter from its table."""
    rows = {row["segment"]: row["bits"] for row in table.toLocalIterator()}
    return _joined(rows, n_bits, 0, 1 << n_bits)


def _joined(rows: dict[int, bytes], n_bits: int, first: int, n: int) -> LogFrequencyFilter:
    parts = [rows.get(s, b"") for s in range(first, first + n)]
    sizes = np.array([len(b) * 8 for b in parts], np.int64)
    return LogFrequencyFilter(n_bits, sizes, np.frombuffer(b"".join(parts), np.uint8), first)


def _ngrams(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashes of the words, then of the pairs."""
    return np.concatenate((mix(tokens, 30), pair_hashes(tokens, offsets)))


def _chunk_keys(rows: pa.RecordBatch, column: int) -> np.ndarray:
    """The different n-grams of a chunk, sorted."""
    return sorted_distinct(np.concatenate(
        [sorted_distinct(_ngrams(*tokens_of(part.column(column)))) for part in slices(rows, size=TOKEN_SLICE)]))


def _packed(rows: pa.RecordBatch) -> bytes:
    """Rows as a compressed Arrow stream: half of what the texts take in a shuffle otherwise."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(docs: pa.Scalar) -> pa.RecordBatch:
    return pa.ipc.open_stream(docs.as_buffer()).read_next_batch()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, held_out, text, text_key) to chunks of whole rows, each a number and the packed rows."""
    chunk = TaskContext.get().partitionId() << 32
    for batch in batches:
        for rows in slices(batch, size=CHUNK_BYTES):
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([_packed(rows)], pa.binary())], names=["chunk", "docs"])
            chunk += 1


def _asked(n_bits: int, part_bits: int):
    """A chunk (chunk, docs) to its different n-grams by part of the filter: (part, chunk, keys),
    of each n-gram the bits of the segment in the part and the 32 that follow."""
    low, in_part = U(32 - n_bits), U(32 + n_bits - part_bits)

    def run(chunk: pa.Table) -> pa.Table:
        keys = _chunk_keys(_unpacked(chunk.column("docs")[0]), 2) >> low
        part = keys >> in_part
        own = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        keys &= (U(1) << in_part) - U(1)
        cuts = [*own.tolist(), len(keys)]
        return pa.table([
            pa.array(part[own].astype(np.int32)), pa.array([chunk.column("chunk")[0].as_py()] * len(own), pa.int64()),
            pa.array([packed_sorted(keys[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())],
            names=["part", "chunk", "value"])

    return run


def _read_levels(n_bits: int, part_bits: int):
    """Rows (part, segment, null, bits) of the filter, then (part, null, chunk, keys), by
    part, to (chunk, part, levels)."""
    n = 1 << (n_bits - part_bits)
    low, in_part = U(32 - n_bits), U(32 + n_bits - part_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, table = None, {}, None
        held: list[tuple[int, np.ndarray]] = []

        def read() -> Iterator[pa.RecordBatch]:
            """The levels of a part's n-grams, of several chunks at once."""
            nonlocal table, rows
            if not held:
                return
            if table is None:
                table, rows = _joined(rows, n_bits, now * n, n), {}
            keys = np.concatenate([k for _, k in held])
            found = table.level((keys | (U(now) << in_part)) << low)
            cuts = np.cumsum([0, *(len(k) for _, k in held)]).tolist()
            yield pa.RecordBatch.from_arrays([
                pa.array([c for c, _ in held], pa.int64()), pa.array([now] * len(held), pa.int32()),
                pa.array([packed_ints(found[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())],
                names=["chunk", "part", "levels"])
            held.clear()

        for batch in batches:
            size = 0
            for i, part in enumerate(batch.column(0).to_pylist()):
                if part != now:
                    yield from read()
                    now, rows, table, size = part, {}, None, 0
                chunk, value = batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
                if chunk is None:
                    rows[batch.column(1)[i].as_py()] = value
                else:
                    held.append((chunk, unpacked_sorted(value)))
                    size += len(held[-1][1])
                    if size > READ_AT_ONCE:
                        yield from read()
                        size = 0
            yield from read()

    return run


def _score_chunk(shared):
    """A chunk (chunk, docs) and its levels (chunk, part, levels) to what ``_document_rows`` gives."""
    def run(chunk: pa.Table, levels: pa.Table) -> pa.Table:
        rows = _unpacked(chunk.column("docs")[0])
        read = levels.column("levels").to_pylist()
        found = np.concatenate([unpacked_ints(read[i]).astype(np.int8) for i in np.argsort(levels.column("part").to_numpy())])
        keys = _chunk_keys(rows, 2)
        return pa.Table.from_batches([
            _scored(part, *shared.value, lambda k: found[np.searchsorted(keys, k)]) for part in slices(rows, size=TOKEN_SLICE)])

    return run


def scored_in_parts(texts: DataFrame, table: DataFrame, n_bits: int, n_bytes: int, part_bytes: int, shared, schema: str) -> DataFrame:
    """``texts`` scored with a filter that stays a table of ``n_bytes``."""
    part_bits = int(min(max(np.ceil(np.log2(n_bytes / part_bytes)), 1), n_bits))
    # The texts' one shuffle, by chunk: n-grams are taken behind it, and it is read again to score.
    chunks = texts.mapInArrow(_chunks, "chunk long, docs binary").groupBy("chunk")
    asked = chunks.applyInArrow(_asked(n_bits, part_bits), "part int, chunk long, value binary")
    bits = table.select(
        F.shiftright("segment", n_bits - part_bits).alias("part"), "segment", F.lit(None).cast("long").alias("chunk"), F.col("bits").alias("value"))
    # The filter's rows (null chunk) come first.
    together = bits.unionByName(asked.select("part", F.lit(None).cast("int").alias("segment"), "chunk", "value"))
    read = together.repartition("part").sortWithinPartitions("part", "chunk").mapInArrow(
        _read_levels(n_bits, part_bits), "chunk long, part int, levels binary")
    return chunks.cogroup(read.groupBy("chunk")).applyInArrow(_score_chunk(shared), schema)


def _scored(part: pa.RecordBatch, head, head_counts, n: int, v: int, level_of) -> pa.RecordBatch:
    """(doc_id, held_out, text, text_key) to the document's sums and its rare words;
    ``level_of`` gives the levels of n-gram hashes."""
    tokens, offsets = tokens_of(part.column(2))
    at = np.searchsorted(head, tokens)
    at[at == len(head)] = 0
    known = head[at] == tokens if len(head) else np.zeros(len(tokens), bool)
    logs = np.where(known, np.log10(head_counts[at] + 1.0) if len(head) else 0.0, 0.0)
    word = level_count(level_of(mix(tokens, 30)))
    first = np.zeros(len(tokens), bool)
    first[offsets[:-1]] = True
    context = np.concatenate(([0.0], word[:-1]))
    # The start was seen once a training text, as often as the end.
    context[first] = level_count(level_of(mix(np.array([END], U), 30)))[0]
    pair = np.minimum(level_count(level_of(pair_hashes(tokens, offsets))), np.minimum(context, word))
    unigram = (word + 1) / (n + v + 1)
    score = np.log10((pair + PRIOR_WEIGHT * unigram) / (context + PRIOR_WEIGHT))
    sums = [np.add.reduceat(x, offsets[:-1]) for x in (logs, known.astype(np.int64), score)]
    rare = [np.unique(tokens[a:b][~known[a:b]], return_counts=True) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    lists = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum([len(r[0]) for r in rare]))), pa.int32()),
        pa.StructArray.from_arrays(
            [pa.array(np.concatenate([r[0] for r in rare]).view(np.int64)),
             pa.array(np.concatenate([r[1] for r in rare]).astype(np.int64))], names=["word", "n"]))
    return pa.RecordBatch.from_arrays(
        [part.column(0), part.column(1), part.column(3), pa.array(np.diff(offsets)), pa.array(sums[0]), pa.array(sums[1]),
         pa.array(sums[2]), lists],
        names=["doc_id", "held_out", "text_key", "n_tokens", "logs", "known", "score", "rare"])


def _document_rows(shared, table):
    """Texts scored with a broadcast filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, size=TOKEN_SLICE):
                yield _scored(part, *shared.value, table.value.level)

    return run


def score_texts(docs: DataFrame, max_bytes: int = MAX_FILTER_BYTES, head_words: int = HEAD_WORDS) -> DataFrame:
    """op6: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    texts = docs.select(
        "doc_id", held_out(F.col("doc_id"), 7, 2).alias("held_out"), "text", F.xxhash64("text").alias("text_key"))
    train = texts.where(~F.col("held_out")).select("text")
    counts = written(
        train.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # The head: words above a count that at most ``head_words`` words reach.
    steps = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n"))
    floor, size = None, 0
    for row in steps.limit(head_words).toLocalIterator():
        if size + row["words"] > head_words:
            break
        size, floor = size + row["words"], row["n"]
    head = counts.where(F.col("n") >= floor) if floor is not None else counts.limit(0)
    pdf = head.toPandas().sort_values("word")
    keys, values = pdf["word"].to_numpy(np.int64).view(U), pdf["n"].to_numpy(np.int64)
    sort = np.argsort(keys)
    context = spark.sparkContext
    shared = context.broadcast((keys[sort], values[sort], n, v))
    table, n_bits = filter_rows(train, n)
    n_bytes = table.agg(F.coalesce(F.sum(F.octet_length("bits")), F.lit(0))).first()[0]
    schema = (f"doc_id {kind}, held_out boolean, text_key long, n_tokens long, logs double, known long, score double, "
              "rare array<struct<word:long,n:long>>")
    texts = texts.select("doc_id", "held_out", "text", "text_key")
    if n_bytes <= max_bytes:
        scored = texts.mapInArrow(_document_rows(shared, context.broadcast(build_filter(table, n_bits))), schema)
    else:
        scored = scored_in_parts(texts, table, n_bits, n_bytes, min(PART_BYTES, max_bytes), shared, schema)
    rows = written(scored, "scored-texts")

    tail = counts if floor is None else counts.where(F.col("n") < floor)
    rare = rows.select("doc_id", "text_key", F.inline("rare").alias("rare_word", "rare_n"))
    found = rare.distinct().join(tail, F.col("rare_word") == F.col("word")).groupBy("doc_id", "text_key").agg(
        F.sum(F.col("rare_n") * F.log10(F.col("n") + 1.0)).alias("more_logs"), F.sum("rare_n").alias("more_known"))
    found = found.select(F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key"), "more_logs", "more_known")
    lengths = F.lit(float(np.log10(float(n + v + 1))))
    return rows.drop("rare").join(
        found, F.col("doc_id").eqNullSafe(F.col("found_id")) & F.col("text_key").eqNullSafe(F.col("found_key")), "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * lengths).alias("base_score"), "score")

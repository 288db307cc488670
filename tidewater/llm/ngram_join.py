"""N-gram Jaccard join with multiple global orders.

A document's set is its distinct word shingles.  Two documents link when
100 * |A & B| >= percent * |A | B|.  The operator returns each document's class
under these links, exactly; no link is found by chance or lost by a cap.

1. Equal sets are collapsed: one representative each goes on.
2. Tokens (shingle hashes) get several global orders: by a frequency class first,
   then by a hash of the order's own.  The class is one bit, rare or frequent,
   from a counting sketch over all tokens of all documents; any order serves for
   exactness, this one keeps frequent tokens out of prefixes.  Its bitmap is the
   only thing broadcast: 2**``MAX_SKETCH_BITS`` bits, 4 MB, at most.
3. If two sets link, they share a token in their prefixes (the first n - ceil(t n)
   + 1 tokens) under every order.  Representatives are joined on the prefix tokens
   of the first order.  Inside a token's group, sizes and an odd sketch are
   compared (bits of the parity of tokens; two sets that link differ in at most
   (n1 + n2)(1 - t)/(1 + t) bits), and a spanning forest of the pairs that pass
   is kept, so a group of m near copies gives m - 1 rows, not m squared.
4. Components of that forest are candidate clusters.  In a cluster, pairs must share
   prefix tokens under every one of the orders (the filters are intersected);
   those left are verified by exact intersection.  Large clusters and large token
   groups are worked on as pairs of blocks.
5. Components of the verified links are the classes.

Comparisons inside one cluster of m different near copies grow with m squared over
the tasks; they are bit operations and set intersections on blocks, and links that
add nothing (already connected) are skipped.

Edge cases: null and empty texts have the empty set and link with nothing; with
fewer words than a shingle the whole sequence is one; a null id links with
nothing and has a null class; rows with the same id are one document with several
texts (each row gets its own text's class; links through either join it);
repeated rows give repeated results; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import broadcast_if_counted, free_name, written
from tidewater.llm.graph import Forest, components, in_blocks, per_block_pair
from tidewater.llm.hashing import U, mix, shingles, slices, text_shingles, words_of

ORDERS = 3
MIN_SKETCH_BITS, MAX_SKETCH_BITS = 12, 25
# A sketch cell this many times as full as the average marks frequent tokens.
FREQUENT = 3
CELLS_PER_BLOCK = 1 << 12
GROUP_BLOCK = 512
CLUSTER_BLOCK = 192
MAX_ODD_BITS = 1 << 14


def prefix_length(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1 if n else 0


def most_different(n1, n2, percent: int):
    """Largest symmetric difference of two sets that link."""
    return (n1 + n2) * (100 - percent) // (100 + percent)


class Rarity:
    """One bit per cell: whether tokens that hash to it count as frequent."""

    def __init__(self, bits: int, frequent: bytes):
        self.bits = bits
        self.frequent = frequent

    def __call__(self, tokens: np.ndarray) -> np.ndarray:
        cell = (tokens & U((1 << self.bits) - 1)).astype(np.int64)
        table = np.frombuffer(self.frequent, np.uint8)
        return ((table[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1).astype(bool)

    def order(self, tokens: np.ndarray, k: int) -> np.ndarray:
        """Sort keys of the k-th global order."""
        return (mix(tokens, 100 + k) >> U(1)) | (self(tokens).astype(U) << U(63))

    def prefix(self, tokens: np.ndarray, k: int, percent: int) -> np.ndarray:
        p = prefix_length(len(tokens), percent)
        if p >= len(tokens):
            return tokens
        return tokens[np.argpartition(self.order(tokens, k), p - 1)[:p]]


def token_rarity(docs: DataFrame, k: int) -> Rarity:
    """Counts the tokens of all documents in a sketch and marks its full cells.

    The sketch has about one cell per 128 tokens; tasks send their cells as
    compressed blocks, which are summed block by block.
    """
    total = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / 6
    bits = int(min(max(np.ceil(np.log2(max(total, 1) / 128)), MIN_SKETCH_BITS), MAX_SKETCH_BITS))
    limit = max(64.0, FREQUENT * total / (1 << bits))
    n_cells = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(n_cells, np.uint32)
        for batch in batches:
            for part in slices(batch):
                words = words_of(part.column(part.schema.get_field_index("text")))
                # Windows over two texts are counted too: they only shift classes.
                tokens = shingles(words.hashes, k)
                cells += np.bincount((tokens & U(n_cells - 1)).astype(np.int64), minlength=n_cells).astype(np.uint32)
        if cells.any():
            for at in range(0, n_cells, CELLS_PER_BLOCK):
                block = cells[at:at + CELLS_PER_BLOCK]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at // CELLS_PER_BLOCK], pa.int32()), pa.array([zlib.compress(block.tobytes(), 1)], pa.binary())],
                    names=["block", "cells"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cells = None, None

        def marks() -> pa.RecordBatch:
            packed = np.packbits(cells > limit, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([packed], pa.binary())], names=["block", "bits"])

        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if now is not None and block != now:
                    yield marks()
                    cells = None
                now = block
                add = np.frombuffer(zlib.decompress(packed), np.uint32)
                cells = add.astype(np.uint64) if cells is None else cells + add
        if cells is not None:
            yield marks()

    counts = docs.select("text").mapInArrow(count, "block int, cells binary")
    marked = counts.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block int, bits binary")
    frequent = bytearray(n_cells // 8)
    size = CELLS_PER_BLOCK // 8
    for row in marked.collect():
        frequent[row["block"] * size:(row["block"] + 1) * size] = row["bits"]
    return Rarity(bits, bytes(frequent))


def odd_bits(n: int, percent: int) -> int:
    """Width of a set's odd sketch.  Sketches of unlike sets differ in half their
    bits, those of sets that link in 2 n (100 - percent) / (100 + percent) at most;
    four times as many bits as that keep the two apart."""
    enough = 8 * n * (100 - percent) / (100 + percent)
    return int(min(max(64, 1 << max(0, int(np.ceil(np.log2(max(enough, 1)))))), MAX_ODD_BITS))


def odd_sketch(tokens: np.ndarray, percent: int) -> bytes:
    width = odd_bits(len(tokens), percent)
    at = (mix(tokens, 50) & U(width - 1)).astype(np.int64)
    parity = (np.bincount(at, minlength=width) & 1).astype(np.uint8)
    return np.packbits(parity, bitorder="little").tobytes()


def signatures(docs: DataFrame, rarity, k: int, percent: int) -> DataFrame:
    """doc_id, n, two fingerprints of the set, its first order's prefix and sketch."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = rarity.value
        for batch in batches:
            for part in slices(batch):
                words = words_of(part.column(part.schema.get_field_index("text")))
                n, f1, f2, prefix, sketch = [], [], [], [], []
                for i in range(words.texts()):
                    tokens = text_shingles(words.hashes[words.offsets[i]:words.offsets[i + 1]], k)
                    n.append(len(tokens))
                    f1.append(mix(tokens, 1).sum(dtype=U).astype(np.int64))
                    f2.append(np.bitwise_xor.reduce(mix(tokens, 2)).astype(np.int64) if len(tokens) else np.int64(0))
                    prefix.append(order.prefix(tokens, 0, percent).astype(np.int64))
                    sketch.append(odd_sketch(tokens, percent))
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index("doc_id")), pa.array(n, pa.int32()), pa.array(f1, pa.int64()),
                     pa.array(f2, pa.int64()), pa.array(prefix, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                    names=["doc_id", "n", "f1", "f2", "prefix", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n int, f1 long, f2 long, prefix array<long>, sketch binary")


def _bit_rows(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint64).reshape(len(values), -1)


def _links(table: pa.Table, forest: Forest) -> pa.RecordBatch | None:
    if not forest.links:
        return None
    ids = table.column("doc_id").combine_chunks()
    a, b = zip(*forest.links, strict=True)
    return pa.RecordBatch.from_arrays([ids.take(pa.array(a)), ids.take(pa.array(b))], names=["a", "b"])


def candidate_work(percent: int):
    """Of a token's group: a spanning forest of the pairs that pass the size and
    odd sketch filters."""
    def work(table: pa.Table) -> pa.RecordBatch | None:
        n = table.column("n").to_numpy().astype(np.int64)
        sketches = table.column("sketch").to_pylist()
        forest = Forest(len(n))
        width = np.array([len(s) for s in sketches])
        by_width = {}
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            at = at[np.argsort(n[at], kind="stable")]
            by_width[int(w)] = at, n[at], _bit_rows([sketches[i] for i in at])

        def compare(x: int, bits: np.ndarray, at: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> None:
            to = np.searchsorted(sizes, n[x] * 100 // percent, side="right")
            if to:
                far = np.bitwise_count(rows[:to] ^ bits).sum(axis=1, dtype=np.int64)
                for y in at[:to][far <= most_different(n[x], sizes[:to], percent)]:
                    forest.join(x, int(y))

        for w, (at, sizes, rows) in by_width.items():
            wider = by_width.get(2 * w)
            if wider:
                half = wider[2].shape[1] // 2
                folded = wider[2][:, :half] ^ wider[2][:, half:]
            for i, x in enumerate(at.tolist()):
                compare(x, rows[i], at[i + 1:], sizes[i + 1:], rows[i + 1:])
                if wider:
                    compare(x, rows[i], wider[0], wider[1], folded)
        return _links(table, forest)

    return work


def share_tokens(sets: list[np.ndarray]) -> np.ndarray:
    """Which pairs of sets have a token in common (a square of booleans)."""
    m = len(sets)
    out = np.zeros((m, m), bool)
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    sort = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[sort], owner[sort]
    cuts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1], [True])))
    for at, to in zip(cuts[:-1], cuts[1:], strict=True):
        if to - at > 1:
            rows = owner[at:to]
            out[rows[:, None], rows[None, :]] = True
    return out


def verify_work(rarity, k: int, percent: int):
    """Of a cluster's block pair: a spanning forest of the links.  Pairs share
    prefix tokens under every order; then the sets are intersected."""
    def work(table: pa.Table) -> pa.RecordBatch | None:
        words = words_of(table.column("text"))
        sets = [text_shingles(words.hashes[words.offsets[i]:words.offsets[i + 1]], k) for i in range(words.texts())]
        n = np.array([len(s) for s in sets], np.int64)
        m = len(sets)
        forest = Forest(m)
        near = (n[:, None] * 100 >= n[None, :] * percent) & (n[None, :] * 100 >= n[:, None] * percent)
        near &= np.triu(np.ones((m, m), bool), 1)
        for order in range(ORDERS):
            if not near.any():
                return None
            near &= share_tokens([rarity.value.prefix(s, order, percent) for s in sets])
        ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
        starts = np.concatenate(([0], np.cumsum(n)))
        seen = np.zeros(int(ids.max()) + 1, bool)
        for x in np.flatnonzero(near.any(axis=1)).tolist():
            partners = np.flatnonzero(near[x])
            root = forest.root(x)
            partners = [y for y in partners.tolist() if forest.root(y) != root]
            if not partners:
                continue
            own = ids[starts[x]:starts[x + 1]]
            seen[own] = True
            for y in partners:
                both = int(np.count_nonzero(seen[ids[starts[y]:starts[y + 1]]]))
                if 100 * both >= percent * (int(n[x]) + int(n[y]) - both):
                    forest.join(x, y)
            seen[own] = False
        return _links(table, forest)

    return work


def link_classes(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by
    links) of every document of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    texts = docs.select("doc_id", "text")
    rarity = spark.sparkContext.broadcast(token_rarity(texts, k))
    signed = written(signatures(texts, rarity, k, percent), "shingle-signatures")
    sets = ["n", "f1", "f2"]
    classes = written(
        signed.where((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy(*sets).agg(
            F.min("doc_id").alias("rep"), F.min_by("prefix", "doc_id").alias("prefix"), F.min_by("sketch", "doc_id").alias("sketch")),
        "shingle-classes")

    # Prefix tokens with a neighbour of a size that could link in their token's group: the others link nothing through it.
    # One shuffle and one sort of the tokens; few are left, which are kept.
    by_size = Window.partitionBy("token").orderBy("n")
    token_rows = classes.select(F.explode("prefix").alias("token"), F.col("rep").alias("doc_id"), "n")
    close = (F.coalesce(F.lag("n").over(by_size) * 100 >= F.col("n") * percent, F.lit(False))
             | F.coalesce(F.col("n") * 100 >= F.lead("n").over(by_size) * percent, F.lit(False)))
    shared = written(token_rows.withColumn("_close", close).where("_close").select("token", "doc_id"), "shared-tokens")
    dealt = in_blocks(shared, "token", "doc_id", GROUP_BLOCK)
    rows = dealt.join(classes.select(F.col("rep"), "n", "sketch"), F.col("doc_id") == F.col("rep"))
    links_schema = f"a {kind}, b {kind}"
    forest = per_block_pair(
        rows.select("doc_id", "n", "sketch", "_group", "_i", "_j"),
        candidate_work(percent), links_schema)
    clusters = written(components(forest), "shingle-clusters")

    members = broadcast_if_counted(clusters.select(F.col("node").alias("member"), F.col("component").alias("cluster")))
    cluster_texts = texts.join(members, F.col("doc_id") == F.col("member")).select("doc_id", "text", "cluster")
    links = per_block_pair(
        in_blocks(cluster_texts, "cluster", "doc_id", CLUSTER_BLOCK).select("doc_id", "text", "_group", "_i", "_j"),
        verify_work(rarity, k, percent), links_schema)
    linked = components(links)

    # Representative of every document, then the representative's component.
    reps = classes.select(*sets, "rep").join(linked, F.col("rep") == F.col("node"), "left").select(
        *sets, F.coalesce("component", "rep").alias("component_id"))
    ids = signed.select("doc_id", *sets)
    alone = ids.where((F.col("n") == 0) | F.col("doc_id").isNull()).select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    named = ids.where((F.col("n") > 0) & F.col("doc_id").isNotNull()).join(reps, sets).select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
    return named.unionByName(alone)


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest id.
    Documents with a null id stay."""
    classes = link_classes(docs, k, percent)
    name = free_name(docs, "_gone")
    gone = classes.where(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias(name))
    return docs.join(broadcast_if_counted(gone.distinct()), F.col("doc_id") == F.col(name), "left_anti")

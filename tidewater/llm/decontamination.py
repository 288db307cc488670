"""Benchmark decontamination: size-partitioned MinHash containment search.

Finds benchmark items that stand inside documents, however long these are.  A
document is contaminated by an item if it has at least ``percent`` of the item's
distinct word shingles.

Items are partitioned by size: partition u holds items with u/2 < shingles <= u.
For each partition that has items, a document is cut into windows of 2u shingles,
u apart, so any passage of an item's length lies whole in one of them, and window
and item are of like size: their Jaccard similarity is then about percent/5 at
least, whatever the document's length.  Window and item have MinHashes of
``PERMUTATIONS`` permutations; any equal pair makes a candidate, so a window as
similar as that is missed with probability (1 - J)**128, under 1e-9.  MinHashes of a
window of 2u shingles are minima of those of its chunks.  Candidates are verified by
exact containment in the whole document.

Items are the stated query set: they are read in blocks of ``ITEM_BLOCK``, each
block's signatures broadcast (a bounded size) and searched in one pass over the
documents, without a shuffle.

Texts are compared as lower-cased runs of letters and digits.  Shingles have
``k`` words; an item with fewer words is one shingle of all its words, searched
among windows of as many words.

Edge cases: null, empty or word-less texts and items match nothing; a null item
id is an id like any other; repeated rows give repeated results (repeated items
with one id and text count once); an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.hashing import U, mix, run_hashes, shingles, slices

PERMUTATIONS = 128
ITEM_BLOCK = 20_000
SMALLEST = 4
_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def word_hashes(found: list[str]) -> np.ndarray:
    """64-bit hashes of words."""
    data = np.frombuffer("".join(found).encode("utf-8", "surrogatepass"), np.uint8)
    ends = np.cumsum([len(w) if w.isascii() else len(w.encode("utf-8", "surrogatepass")) for w in found], dtype=np.int64)
    return run_hashes(data, np.concatenate(([0], ends[:-1])).astype(np.int64), ends) if found else np.zeros(0, U)


def permuted(h: np.ndarray, i: int) -> np.ndarray:
    """The i-th random permutation of hashes."""
    with np.errstate(over="ignore"):
        return (h ^ mix(np.array([i], U), 7)[0]) * U(0x9E3779B97F4A7C15 + 2 * i * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF | 1)


def partition_of(n: int) -> int:
    """Size partition: a power of two, at least the number of shingles."""
    return max(SMALLEST, 1 << (n - 1).bit_length())


@dataclass(frozen=True)
class Item:
    item_id: object
    tokens: np.ndarray  # distinct shingle hashes, sorted
    width: int  # words in a shingle
    partition: int


class Index:
    """Signatures of a block of items: by shingle width and size partition, the
    sorted MinHash values of each permutation and the items that have them."""

    def __init__(self, rows: list[tuple[object, str | None]], k: int, percent: int):
        self.k, self.percent = k, percent
        self.items: list[Item] = []
        groups: dict[tuple[int, int], list[int]] = defaultdict(list)
        for item_id, text in rows:
            h = word_hashes(words(text))
            if not len(h):
                continue
            width = min(k, len(h))
            tokens = np.unique(shingles(h, width))
            groups[width, partition_of(len(tokens))].append(len(self.items))
            self.items.append(Item(item_id, tokens, width, partition_of(len(tokens))))
        self.groups = {}
        for key, members in sorted(groups.items()):
            tables = []
            for i in range(PERMUTATIONS):
                least = np.array([permuted(self.items[m].tokens, i).min() for m in members], U)
                sort = np.argsort(least, kind="stable")
                tables.append((least[sort], np.array(members)[sort]))
            self.groups[key] = tables

    def search(self, docs: list[np.ndarray]) -> list[tuple[int, int, int]]:
        """(document, item, shared shingles) of documents given by word hashes."""
        found: set[tuple[int, int]] = set()
        for width in sorted({w for w, _ in self.groups}):
            parts = [shingles(h, width) for h in docs]
            self._candidates(parts, {u: t for (w, u), t in self.groups.items() if w == width}, found)
        out = []
        own: dict[tuple[int, int], np.ndarray] = {}
        for d, m in sorted(found):
            item = self.items[m]
            if (d, item.width) not in own:
                own = {(d, item.width): np.unique(shingles(docs[d], item.width))}
            tokens = own[d, item.width]
            at = np.searchsorted(tokens, item.tokens)
            at[at == len(tokens)] = 0
            n = int((tokens[at] == item.tokens).sum())
            if n * 100 >= self.percent * len(item.tokens):
                out.append((d, m, n))
        return out

    def _candidates(self, parts: list[np.ndarray], tables: dict, found: set[tuple[int, int]]) -> None:
        """Adds (document, item) where a window and an item share a MinHash.

        All documents' shingles are one array.  It is cut into chunks of the
        smallest partition's size, never across documents; chunks of the next
        partitions are pairs of chunks.
        """
        sizes = np.array([len(p) for p in parts], np.int64)
        if not sizes.any():
            return
        tokens = np.concatenate(parts)
        offsets = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        steps = []  # per partition: starts in the array before it, and documents
        u, top = min(tables), max(tables)
        lengths, starts = sizes, offsets
        while u <= top:
            step = u if not steps else 2
            n = -(-lengths // step)
            doc = np.repeat(np.arange(len(n)), n)
            first = np.cumsum(n) - n
            place = np.arange(int(n.sum())) - np.repeat(first, n)
            steps.append((u, np.repeat(starts, n) + place * step, doc))
            lengths, starts = n, first
            u *= 2
        for i in range(PERMUTATIONS):
            chunk = permuted(tokens, i)
            for u, at, doc in steps:
                chunk = np.minimum.reduceat(chunk, at)
                if u not in tables:
                    continue
                window = chunk.copy()
                same = doc[1:] == doc[:-1]
                window[:-1][same] = np.minimum(chunk[:-1], chunk[1:])[same]
                values, members = tables[u][i]
                where = np.searchsorted(values, window)
                where[where == len(values)] = 0
                for w in np.flatnonzero(values[where] == window).tolist():
                    lo, hi = where[w], np.searchsorted(values, window[w], side="right")
                    found.update((int(doc[w]), int(m)) for m in members[lo:hi])


def contaminated(docs: DataFrame, benchmark: DataFrame, k: int = 5, percent: int = 80,
                 item_block: int = ITEM_BLOCK) -> DataFrame:
    """(doc_id, item_id, item_shingles, shared_shingles) for every document and
    item it holds.  ``docs``: doc_id, text; ``benchmark``: item_id, text."""
    spark = docs.sparkSession
    doc_kind, item_kind = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    schema = f"doc_id {doc_kind}, item_id {item_kind}, item_shingles long, shared_shingles long"
    items = benchmark.select("item_id", "text").distinct()
    n_blocks = max(1, -(-items.count() // item_block))
    out = None
    for block in range(n_blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).collect()
        rows = sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is not None, r[0], r[1] or ""))
        found = docs.select("doc_id", "text").mapInArrow(_search(spark.sparkContext.broadcast(Index(rows, k, percent))), schema)
        out = found if out is None else out.unionByName(found)
    return out


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for part in slices(batch):
                hashes = [word_hashes(words(t)) for t in part.column(1).to_pylist()]
                hits = index.search(hashes)
                if hits:
                    docs, items, shared_shingles = zip(*hits, strict=True)
                    items = [index.items[m] for m in items]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(docs)), pa.array([x.item_id for x in items]),
                         pa.array([len(x.tokens) for x in items], pa.int64()), pa.array(shared_shingles, pa.int64())],
                        names=["doc_id", "item_id", "item_shingles", "shared_shingles"])

    return run


def without_benchmark(docs: DataFrame, benchmark: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without those that hold an item (null ids stay: they can't be named)."""
    from tidewater.llm.common import broadcast_if_counted, free_name, written

    name = free_name(docs, "_leaked")
    leaked = written(contaminated(docs, benchmark, k, percent).select(F.col("doc_id").alias(name)).distinct(), "leaked")
    return docs.join(broadcast_if_counted(leaked), F.col("doc_id") == F.col(name), "left_anti")

"""Connected components, and pairwise work inside groups of any size.

Both stay distributed: labels and links are tables, and a group larger than a
block is worked on as pairs of blocks, each a task's worth of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import written

BLOCK_ROWS = 512


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; component is the
    smallest node that can be reached.  Nodes are of any type with an order.

    Rounds of contraction: every node points to its smallest neighbour (or itself),
    the pointers are followed to their roots, and links between roots are the
    next round's.  Every root that has a link left merges, so the links left
    shrink by at least half their nodes each round; a node with very many
    links is only ever a grouped minimum (partial before the shuffle).
    """
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where(F.col("a") != F.col("b"))
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while labels is None or not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root"))
        up = _to_roots(written(up, "pointers"))
        if labels is None:
            labels = up
        else:
            nxt = up.select(F.col("node").alias("root"), F.col("root").alias("new"))
            labels = written(
                labels.join(nxt, "root", "left").select("node", F.coalesce("new", "root").alias("root")), "labels")
        left = up.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = up.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = edges.join(left, "a").join(right, "b").where(F.col("ra") != F.col("rb"))
        edges = written(moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
    return labels.select("node", F.col("root").alias("component"))


def _to_roots(up: DataFrame) -> DataFrame:
    """Follows pointers, doubling, until every node points to a root.  A pointer
    never goes to a larger node, so there are no cycles."""
    while True:
        nxt = up.select(F.col("node").alias("root"), F.col("root").alias("far"))
        jumped = written(
            up.join(nxt, "root", "left").select(
                "node", F.coalesce("far", "root").alias("root"), (F.coalesce("far", "root") != F.col("root")).alias("moved")),
            "pointers")
        if jumped.where("moved").isEmpty():
            return jumped.select("node", "root")
        up = jumped.select("node", "root")


def in_blocks(rows: DataFrame, group: str, ident: str, block: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` of groups of at least two, dealt so that any two rows of a group
    meet in some task of bounded size: columns ``_group``, ``_i``, ``_j`` (the pair of
    blocks) and ``_own`` (this row's block).

    A group of up to ``block`` rows is one block; a larger one has as many as it
    needs, rows falling into them by the hash of ``ident``, and each row goes to
    every pair its block is in.
    """
    sizes = rows.groupBy(F.col(group).alias("_group")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    joined = rows.join(sizes, F.col(group) == F.col("_group"))
    n_blocks = F.ceil(F.col("_n") / block).cast("int")
    dealt = joined.withColumn("_blocks", n_blocks).withColumn(
        "_own", F.pmod(F.xxhash64(F.col(ident)), F.col("_blocks")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return dealt.select(
        *rows.columns, "_group", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), "_own")


def per_block_pair(dealt: DataFrame, work: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Applies ``work`` to the rows of each (``_group``, ``_i``, ``_j``).

    Rows are brought together by those columns and sorted, then read as runs, so
    very many small groups cost no more than their rows.
    """
    by = ["_group", "_i", "_j"]
    together = dealt.repartition(*by).sortWithinPartitions(*by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            code = row_codes(table.select(by))
            cuts = [0, *(np.flatnonzero(code[1:] != code[:-1]) + 1).tolist(), table.num_rows]
            for at, to in zip(cuts, cuts[1:], strict=False):
                key = tuple(table.column(c)[at].as_py() if c != "_group" else _plain(table.column(c)[at]) for c in by)
                if held and key != last:
                    out = _finish(work, held)
                    held = []
                    if out is not None:
                        yield out
                held.append(table.slice(at, to - at))
                last = key
        if held:
            out = _finish(work, held)
            if out is not None:
                yield out

    return together.mapInArrow(run, schema)


def _plain(value: pa.Scalar):
    out = value.as_py()
    return tuple(out.items()) if isinstance(out, dict) else out


def row_codes(table: pa.Table) -> np.ndarray:
    """Numbers that differ between neighbouring rows where any column does."""
    changed = np.zeros(table.num_rows, bool)
    for column in table.columns:
        column = column.combine_chunks()
        columns = column.flatten() if pa.types.is_struct(column.type) else [column]
        for c in columns:
            v = c.to_numpy(zero_copy_only=False)
            changed[1:] |= v[1:] != v[:-1]
    return np.cumsum(changed)


def _finish(work, held: list[pa.Table]):
    table = pa.concat_tables(held) if len(held) > 1 else held[0]
    return work(table.combine_chunks()) if table.num_rows > 1 else None


class Forest:
    """Union-find over the rows of a block pair; remembers the joining pairs."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        rx, ry = self.root(x), self.root(y)
        if rx != ry:
            self.up[max(rx, ry)] = min(rx, ry)
            self.links.append((x, y))

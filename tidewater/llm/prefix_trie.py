"""Prefix trie of conversations, from vertical bitmaps.

A node is a distinct sequence of first turns, named by the exclusive or of a 128-bit number
for each (position, turn) on its way, so any task can name it.

1. Turns are sorted by conversation in ranges and numbered there; a conversation that
   spans ranges goes on counting from the rows before (one row a range).  From
   here on a turn is a number and a word count; texts are not shuffled.
2. Conversations are cut into segments of ``SEGMENT_TURNS`` positions, sorted, and read as
   shards of at most ``SHARD_SEGMENTS`` segments or ``SHARD_TURNS`` turns.  In a shard every
   (position, turn) has a bitmap of the segments that hold it.  From the bitmap of
   a node, intersections with the postings of the next position give its children, one
   intersection a child: the first segment not yet covered names the posting.  Depth
   first, a node yields its popcount, its smallest conversation and the list of those
   that end there.  What is left of a single segment is written down at once.
3. Nodes of all shards are added up by name.  Only counts, smallest ids and end lists
   travel.  End lists of a node are joined in order of their conversations and hashed
   as a stream.
4. Sums over subtrees are taken by doubling over the nodes that several conversations
   share: round k adds the sums of nodes 2^k below, so rounds grow with the logarithm of
   the depth.  Nodes of one conversation need none.

A conversation that holds a third of all turns is sorted in ranges and worked on in
segments; a first turn that a third of the conversations share is one row a shard.

Edge cases: rows without a conversation id are left out (they name no conversation); a null
role or text is empty; a null turn number comes first; turns with equal numbers are
ordered by role, then by the SHA-256 of the text; repeated rows are turns of their own; an
empty table has no nodes, not even a root; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import word_count, written

SEGMENT_TURNS = 1024
SHARD_SEGMENTS = 4096
SHARD_TURNS = 200_000
NO_ENDS = hashlib.sha256(b"").hexdigest()
_TURN = ["t1", "t2", "words"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), t1, t2 (the turn's number) and words of every turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.sha2(text, 256).alias("sha"),
        word_count(text).alias("words"))
    by = ["conv_id", F.col("turn").asc_nulls_first(), "role", "sha"]
    numbered = rows.repartitionByRange(*by).sortWithinPartitions(*by).select(
        "conv_id", F.xxhash64("role", "sha").alias("t1"), F.xxhash64(F.lit(1), "sha", "role").alias("t2"), "words")
    rows = written(numbered.mapInArrow(_count_on, "conv_id long, t1 long, t2 long, words long, range int, at long"), "turns")
    return _across_ranges(rows)


def _count_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the range's number and each row's place among its conversation's rows in it."""
    part = TaskContext.get().partitionId()
    last, seen = None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv = batch.column(0).to_numpy()
        new = np.ones(n, bool)
        new[1:] = conv[1:] != conv[:-1]
        starts = np.flatnonzero(new)
        at = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        if last == conv[0]:
            until = int(starts[1]) if len(starts) > 1 else n
            at[:until] += seen
        last, seen = conv[-1], int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(at.astype(np.int64))],
            ["conv_id", "t1", "t2", "words", "range", "at"])


def _across_ranges(rows: DataFrame) -> DataFrame:
    """Positions in the whole conversation.  A conversation is cut only at the ends of a range, so
    at most two rows a range are broadcast."""
    sizes = rows.groupBy("range").agg(F.min("conv_id").alias("lo"), F.max("conv_id").alias("hi"))
    edge = rows.join(F.broadcast(sizes), "range").where("conv_id = lo or conv_id = hi")
    edge = edge.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.withColumn("before", F.sum("n").over(before)).where("before > 0").select("conv_id", "range", "before")
    pos = F.col("at") + F.coalesce("before", F.lit(0))
    return rows.join(F.broadcast(edge), ["conv_id", "range"], "left").select("conv_id", pos.alias("pos"), *_TURN)


def rebuilt(turns: DataFrame, every: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first turns of another: (conv_id, total) of each, and
    its turns.  ``c`` takes the first ``crc32(c) % heads`` turns of ``c - c % every`` in place of as many
    of its own."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads))
    base = F.col("conv_id") - F.col("conv_id") % every
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("h", h).withColumn("base", base)
    head = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") < heads - 1))
    head = head.groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", *_TURN))).alias("head"))  # at most heads - 1 turns
    taken = F.slice(F.coalesce("head", F.array().cast("array<struct<pos:bigint,t1:bigint,t2:bigint,words:bigint>>")), F.lit(1), F.col("h").cast("int"))
    convs = written(sizes.join(head, "base", "left").select(
        "conv_id", "h", "n", taken.alias("head")).withColumn("k", F.size("head").cast("long")), "conversations")
    shared = convs.select("conv_id", F.explode("head").alias("x")).select("conv_id", "x.pos", *[f"x.{c}" for c in _TURN])
    own = turns.join(convs.select("conv_id", "h", "k"), "conv_id").where("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), *_TURN)
    total = F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return convs.select("conv_id", total.cast("long").alias("total")), shared.unionByName(own)


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    shards = written(_shard_nodes(convs, turns), "shard-nodes")
    name = ["f1", "f2"]
    nodes = written(shards.groupBy(*name).agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("depth").alias("depth"), F.sum("n").alias("n_convs"),
        F.min("conv_id").alias("conv_id"), F.min("words").alias("words")), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("f1"), F.col("p2").alias("f2")).agg(
        F.count(F.lit(1)).alias("n_children"), F.count(F.when(F.col("n_convs") == 1, 1)).alias("alone"))
    parents = nodes.select(F.col("f1").alias("p1"), F.col("f2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    # The root's own parent columns are 0, the root's name: it has none.
    full = nodes.join(children, name, "left").join(parents, ["p1", "p2"], "left").join(_end_digests(shards), name, "left")
    full = written(full.select(
        *name, "p1", "p2", "depth", "conv_id", "n_convs", "words",
        F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), F.coalesce("alone", F.lit(0)).cast("long").alias("alone"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")), "trie")
    sums = _subtree_sums(full.where("n_convs > 1"))
    alone = F.col("n_convs") == 1
    return full.join(sums, name, "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        F.when(alone, F.lit(1)).otherwise(F.col("leaves")).cast("long").alias("n_leaves"),
        F.when(alone, F.lit(0)).otherwise(F.col("saved")).cast("long").alias("saved_tokens"), "ends_sha256")


def _shard_nodes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Nodes of each shard, from its bitmaps."""
    g1 = F.xxhash64("pos", "t1", "t2").alias("g1")
    g2 = F.xxhash64(F.lit(2), "t2", "pos", "t1").alias("g2")
    block = F.floor(F.col("pos") / SEGMENT_TURNS).cast("long")
    rows = turns.select("conv_id", block.alias("block"), "pos", g1, g2, "words")
    # A head row a segment: the node it starts from; words hold the conversation's length.
    heads = convs.select(
        "conv_id", F.lit(0).cast("long").alias("block"), F.lit(-1).cast("long").alias("pos"), F.lit(0).cast("long").alias("g1"),
        F.lit(0).cast("long").alias("g2"), F.col("total").alias("words"))
    long = convs.where(F.col("total") > SEGMENT_TURNS)
    # A conversation may end with its segment, so the next one is started from its last.
    ways = rows.join(long, "conv_id").groupBy("conv_id", "block", "total").agg(
        F.bit_xor("g1").alias("x1"), F.bit_xor("g2").alias("x2"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    later = ways.select(
        "conv_id", "block", (F.col("block") * SEGMENT_TURNS - 1).alias("pos"), F.bit_xor("x1").over(before).alias("g1"),
        F.bit_xor("x2").over(before).alias("g2"), F.col("total").alias("words")).where("block > 0")
    by = ["conv_id", "block"]
    dealt = heads.unionByName(later).unionByName(rows).repartitionByRange(*by).sortWithinPartitions(*by, "pos")
    return dealt.mapInArrow(
        _walk_shards, "f1 long, f2 long, p1 long, p2 long, depth long, n long, conv_id long, words long, ends string")


class _Shard:
    """Segments in order of their conversations, and their nodes."""

    NAMES = ["f1", "f2", "p1", "p2", "depth", "n", "conv_id", "words", "ends"]

    def __init__(self):
        self.conv: list[int] = []
        self.total: list[int] = []
        self.start: list[tuple[int, int, int]] = []  # depth and name of the node it starts from
        self.rows: list[list[tuple[int, int, int]]] = []
        self.turns = 0
        self.nodes: list[tuple] = []

    def add_head(self, conv: int, pos: int, g1: int, g2: int, total: int) -> None:
        self.conv.append(conv)
        self.total.append(total)
        self.start.append((pos + 1, g1, g2))
        self.rows.append([])

    def add_turn(self, g1: int, g2: int, words: int) -> None:
        self.rows[-1].append((g1, g2, words))
        self.turns += 1

    def full(self) -> bool:
        return len(self.conv) >= SHARD_SEGMENTS or self.turns >= SHARD_TURNS

    def _ends(self, bits: int) -> str | None:
        """Decimal ids of a bitmap's conversations, in order."""
        if not bits:
            return None
        out = []
        while bits:
            low = bits & -bits
            out.append(str(self.conv[low.bit_length() - 1]))
            bits ^= low
        return ",".join(out)

    def batch(self) -> pa.RecordBatch:
        postings: dict[tuple[int, int, int], int] = {}
        going: dict[int, int] = {}  # depth -> segments with a turn after it
        ending: dict[int, int] = {}  # depth -> conversations that end with it
        roots: dict[tuple[int, int, int], int] = {}
        for s, (depth, g1, g2) in enumerate(self.start):
            bit = 1 << s
            roots[depth, g1, g2] = roots.get((depth, g1, g2), 0) | bit
            for d, (a, b, _) in enumerate(self.rows[s], depth):
                postings[d, a, b] = postings.get((d, a, b), 0) | bit
                going[d] = going.get(d, 0) | bit
            to = depth + len(self.rows[s])
            if to == self.total[s]:
                ending[to] = ending.get(to, 0) | bit
        out = self.nodes
        for (depth, f1, f2), bits in roots.items():
            if depth == 0:
                first = (bits & -bits).bit_length() - 1
                out.append((f1, f2, 0, 0, 0, bits.bit_count(), self.conv[first], 0, self._ends(bits & ending.get(0, 0))))
            stack = [(depth, f1, f2, bits)]
            while stack:
                depth, f1, f2, bits = stack.pop()
                rest = bits & going.get(depth, 0)
                while rest:
                    s = (rest & -rest).bit_length() - 1
                    g1, g2, words = self.rows[s][depth - self.start[s][0]]
                    child = rest & postings[depth, g1, g2]
                    rest ^= child
                    n = child.bit_count()
                    if n == 1:
                        self._alone(s, depth, f1, f2)
                        continue
                    c1, c2 = f1 ^ g1, f2 ^ g2
                    out.append((c1, c2, f1, f2, depth + 1, n, self.conv[s], words, self._ends(child & ending.get(depth + 1, 0))))
                    stack.append((depth + 1, c1, c2, child))
        columns = list(zip(*out, strict=True)) or [()] * len(self.NAMES)
        arrays = [pa.array(c, pa.int64()) for c in columns[:-1]] + [pa.array(columns[-1], pa.string())]
        return pa.RecordBatch.from_arrays(arrays, self.NAMES)

    def _alone(self, s: int, depth: int, f1: int, f2: int) -> None:
        """What is left of a segment that no other one shares."""
        conv, at = self.conv[s], depth - self.start[s][0]
        for g1, g2, words in self.rows[s][at:]:
            depth += 1
            c1, c2 = f1 ^ g1, f2 ^ g2
            self.nodes.append((c1, c2, f1, f2, depth, 1, conv, words, str(conv) if depth == self.total[s] else None))
            f1, f2 = c1, c2


def _walk_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard = _Shard()
    key = None
    for batch in batches:
        for conv, block, pos, g1, g2, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (conv, block) != key:  # its head row is the first
                if shard.full():
                    yield shard.batch()
                    shard = _Shard()
                key = (conv, block)
                shard.add_head(conv, pos, g1, g2, words)
            else:
                shard.add_turn(g1, g2, words)
    if shard.conv:
        yield shard.batch()


def _end_digests(shards: DataFrame) -> DataFrame:
    """f1, f2, ends_sha256: the end lists of a node in order, hashed piece by piece."""
    name = ["f1", "f2"]
    lists = shards.where("ends is not null").select(*name, "ends", F.substring_index("ends", ",", 1).cast("long").alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            out: list[tuple] = []
            for f1, f2, ends in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if key == (f1, f2):
                    sha.update(b"," + ends.encode())
                    continue
                if key:
                    out.append((*key, sha.hexdigest()))
                key, sha = (f1, f2), hashlib.sha256(ends.encode())
            yield _digest_batch(out)
        if key:
            yield _digest_batch([(*key, sha.hexdigest())])

    return lists.repartition(*name).sortWithinPartitions(*name, "first").drop("first").mapInArrow(
        run, "f1 long, f2 long, ends_sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
        ["f1", "f2", "ends_sha256"])


def _subtree_sums(shared: DataFrame) -> DataFrame:
    """f1, f2, leaves, saved over the subtrees of nodes that several conversations share.

    ``up`` is the node 2^k above; a round adds what the nodes 2^k below have gathered."""
    name = ["f1", "f2"]
    root = F.col("depth") == 0
    sums = written(shared.select(
        *name, F.when(~root, F.col("p1")).alias("u1"), F.when(~root, F.col("p2")).alias("u2"),
        (F.col("alone") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "subtrees")
    while not sums.where("u1 is not null").isEmpty():
        below = sums.where("u1 is not null").groupBy(F.col("u1").alias("f1"), F.col("u2").alias("f2")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = sums.select(F.col("f1").alias("u1"), F.col("f2").alias("u2"), F.col("u1").alias("n1"), F.col("u2").alias("n2"))
        sums = written(sums.join(below, name, "left").join(above, ["u1", "u2"], "left").select(
            *name, F.col("n1").alias("u1"), F.col("n2").alias("u2"),
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "subtrees")
    return sums.select(*name, "leaves", "saved")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations as they are."""
    turns = written(ordered_turns(conversations), "ordered")
    return prefix_trie(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("total")), turns)


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    turns = written(ordered_turns(conversations), "ordered")
    return prefix_trie(*rebuilt(turns))

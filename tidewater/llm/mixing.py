"""Mixing sources to target weights.

Every document gets a hash-random key; inside its source it stands at a place in
the order of these keys.  A source's budget in words is met by whole epochs over
the source plus the documents up to a cut in that order; the document on the cut
gives only the words still missing, so a source's mix is its budget to the word.

Distributed prefix sums: a source's documents are dealt into ranges of the key
space, about as many as a range has rows (a hot source has more of both), each
range is sorted and summed on its own, and the ranges' totals are summed over
the source.  Only ids, sizes and keys are shuffled, never texts.

Edge cases: a null text has size 0; a null source is a source of its own, last in
order; a null id is an id like any other.  Rows with the same id share a
place: the one whose place is on the cut shares the missing words among its
rows in proportion to their sizes (rounded down).  Sources without words have
target 0; an empty table gives an empty result.  The result depends only on
ids, sizes and sources, so reruns and lost executors give the same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import broadcast_if_counted, free_name, word_count, written

MAX_EPOCHS = 3
# Fixed values of the contract: weights by order of the sources, repeating.
WEIGHTS = (1, 2, 3)


def random_key(doc_id: Column, seed: int = 0) -> Column:
    """Hash-random key of a document: hexadecimal, uniform, same in every run."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def sized(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Id, source, size in words and key of every document."""
    return docs.select(
        F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"),
        random_key(F.col("doc_id"), seed).alias("key"),
    )


def source_sizes(rows: DataFrame) -> DataFrame:
    """Per source: words, places, weight.  One row per source."""
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    # Sources in code point order, null last.  The window runs over one row
    # per source, after the aggregation.
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (((place - 1) % len(WEIGHTS)) + 1).cast("int"))
    return per.withColumn("weight", weight.cast("long"))


def with_targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets in words: a share of all words by weight, at most ``max_epochs``
    times the source; what a source can't take is shared again by weight.

    A source is at its limit if its share at the common rate is above it; taking
    the sources at their limits out only raises the rate, so repeating this
    until none is above ends after at most one round per source.  Each round is
    one aggregate of a table with a row per source.
    """
    cap = F.col("source_size") * max_epochs
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    fixed = F.lit(False)
    n_fixed = -1
    while True:
        left, weights, n = sources.agg(
            F.lit(total) - F.coalesce(F.sum(F.when(fixed, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~fixed, F.col("weight"))), F.lit(0)),
            F.count(F.when(fixed, 1)),
        ).first()
        if n == n_fixed:
            break
        n_fixed = n
        # weight * left / weights > cap, in whole numbers
        above = F.lit(weights > 0) & (
            (F.col("weight") * F.lit(left)).cast("decimal(38,0)") > (cap * F.lit(weights)).cast("decimal(38,0)"))
        fixed = fixed | above
    share = F.col("weight").cast("double") * F.lit(float(left)) / F.lit(float(max(weights, 1)))
    return sources.withColumn("target", F.when(fixed, cap.cast("double")).otherwise(share))


def cuts(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: whole epochs, and the key, words before and words of the place
    on the cut (null key: no place is cut, nothing beyond whole epochs)."""
    small = broadcast_if_counted(targets.select(
        "source", "n_rows", F.floor(F.col("target")).cast("long").alias("budget"),
        F.when(F.col("source_size") > 0, F.floor(F.floor(F.col("target")) / F.col("source_size"))).otherwise(0)
        .cast("long").alias("epochs"), "source_size"))
    part = F.col("budget") - F.col("epochs") * F.col("source_size")
    # Ranges of the key space: the first eight hex digits as a fraction of it.
    share = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    n_ranges = F.ceil(F.sqrt("n_rows"))
    dealt = (
        rows.alias("r").join(small.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")))
        .select(F.col("s.source").alias("source"), "epochs", part.alias("part"), "key", "size",
                F.floor(share * n_ranges / F.lit(float(1 << 32))).cast("long").alias("range"))
    )
    places = dealt.groupBy("source", "range", "key", "epochs", "part").agg(F.sum("size").alias("words"))
    totals = places.groupBy("source", "range", "part").agg(F.sum("words").alias("range_words"))
    so_far = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("before", F.coalesce(F.sum("range_words").over(so_far), F.lit(0)))
    # Only the range that holds the cut is sorted.
    held = offsets.where((F.col("before") < F.col("part")) & (F.col("before") + F.col("range_words") >= F.col("part")))
    inside = Window.partitionBy("source", "range").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        places.alias("p").join(
            broadcast_if_counted(held.select("source", "range", "before")).alias("h"),
            F.col("p.source").eqNullSafe(F.col("h.source")) & (F.col("p.range") == F.col("h.range")))
        .select("p.source", "p.range", "key", "words", "part", "before")
        .withColumn("cut_before", F.col("before") + F.coalesce(F.sum("words").over(inside), F.lit(0)))
        .where((F.col("cut_before") < F.col("part")) & (F.col("cut_before") + F.col("words") >= F.col("part")))
        .select("source", F.col("key").alias("cut_key"), "cut_before", F.col("words").alias("cut_words"), "part")
    )
    return targets.alias("t").join(cut.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")), "left").select(
        "t.source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.floor(F.col("target")) / F.col("source_size"))).otherwise(0)
        .cast("long").alias("epochs"),
        "cut_key", (F.col("part") - F.col("cut_before")).alias("cut_take"), "cut_words")


def take(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (size, key, source and any others) with what the mix takes of each:
    ``copies`` whole ones, ``part_words`` of one more, ``taken`` words in all."""
    one_more = F.col("key") < F.col("cut_key")
    on_cut = F.col("key") == F.col("cut_key")
    copies = F.col("epochs") + F.when(one_more, 1).otherwise(0)
    share = F.floor(F.col("cut_take").cast("decimal(38,0)") * F.col("size") / F.col("cut_words"))
    part = F.coalesce(F.when(on_cut & (F.col("cut_words") > 0), share.cast("long")), F.lit(0)).cast("long")
    plan = broadcast_if_counted(plan.withColumnRenamed("source", "plan_source"))
    return (
        rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source")), "left")
        .withColumn("copies", copies.cast("long")).withColumn("part_words", part)
        .withColumn("taken", (F.col("copies") * F.col("size") + F.col("part_words")).cast("long"))
        .drop("plan_source", "epochs", "cut_key", "cut_take", "cut_words")
    )


def mix(docs: DataFrame, seed: int = 0, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, part_words and taken of
    every document of ``docs`` (doc_id, text, source; other columns ignored)."""
    rows = written(sized(docs, seed), "mix-sizes")
    targets = written(with_targets(written(source_sizes(rows), "mix-sources"), max_epochs), "mix-targets")
    return take(rows, cuts(rows, targets)).drop("key")


def mix_documents(docs: DataFrame, seed: int = 0, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The documents the mix takes words of, whole and with all their columns, and
    ``mix_size``, ``mix_target``, ``mix_copies``, ``mix_part_words``, ``mix_taken`` (with an
    underscore behind a name that the documents have already).  Only the plan, a row per
    source, meets the texts: they are not shuffled."""
    rows = written(sized(docs, seed), "mix-sizes")
    targets = written(with_targets(written(source_sizes(rows), "mix-sources"), max_epochs), "mix-targets")
    whole = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), F.col("source"),
        word_count(F.col("text")).alias("size"), random_key(F.col("doc_id"), seed).alias("key"))
    taken = take(whole, cuts(rows, targets)).where("taken > 0")
    return taken.select("doc.*", *[F.col(c).alias(free_name(docs, f"mix_{c}")) for c in ("size", "target", "copies", "part_words", "taken")])

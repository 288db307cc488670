"""Keyword search over the sale-detail table: hits, relevance, paging,
facets and the age/gender shares of the dashboard.

The reference sends a bool query (date filter + all-terms match on the sku
name) with two terms facets and a page to a search index.  Here the table is
a DataFrame: the filter is a ``where``, relevance is BM25 computed from
DataFrame counts, facets are grouped counts with a top-k, and the page is an
ordered offset/limit (a per-partition top-k, never a global collect).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import (
    age_band, all_tokens_match, remainder_percent, token_list, tokens, truncated_percent,
)
from tidewater.functions import metrics as m

# Fixed values that must equal the reference's: facet sizes.
AGE_FACET_SIZE = 100
GENDER_FACET_SIZE = 2
# Our relevance choice (the reference's analyzer and scorer are outside it).
BM25_K1 = 1.2
BM25_B = 0.75
SCORE_DIGITS = 6
# Parts of an answer.
PART_TOTAL, PART_AGE, PART_GENDER, PART_HIT = "total", "age", "gender", "hit"


def hits(sales: DataFrame, dt: str, keyword: str, text_col: str = "sku_name") -> DataFrame:
    """Rows of day ``dt`` whose text contains every token of ``keyword``."""
    return sales.where((F.col("dt") == dt) & all_tokens_match(text_col, keyword))


def total(found: DataFrame) -> DataFrame:
    return found.agg(F.count(F.lit(1)).alias("total"))


def top_terms(found: DataFrame, field: str, size: int, drop_null: bool = False) -> DataFrame:
    """Terms facet: the ``size`` most frequent values (ties by value)."""
    src = found.where(F.col(field).isNotNull()) if drop_null else found
    counts = src.groupBy(field).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy(F.desc("cnt"), F.asc(field)).limit(size)


def facet_age(found: DataFrame) -> DataFrame:
    return top_terms(found, "user_age", AGE_FACET_SIZE)


def facet_gender(found: DataFrame) -> DataFrame:
    return top_terms(found, "user_gender", GENDER_FACET_SIZE, drop_null=True)


def facets(found: DataFrame, age_size: int = AGE_FACET_SIZE, gender_size: int = GENDER_FACET_SIZE) -> DataFrame:
    """``(part, pos, user_age, user_gender, cnt)``: the total and both facets' buckets from one
    pass over the hits (grouping sets, so each hit is counted under its age, its gender
    and the total).  The counts, at most distinct ages and genders, are ranked
    afterwards; a null gender takes no place.  No rows when nothing was found."""
    sets = found.groupingSets([["user_age"], ["user_gender"], []], "user_age", "user_gender").agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("cnt"))
    # Bits of the grouping id: a column that is not grouped by.
    part = F.when(F.col("gid") == 1, PART_AGE).when(F.col("gid") == 2, PART_GENDER).otherwise(PART_TOTAL)
    parts = sets.withColumn("part", part).where((F.col("part") != PART_GENDER) | F.col("user_gender").isNotNull())
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("cnt"), F.asc("user_age"), F.asc("user_gender")))
    size = F.when(F.col("part") == PART_AGE, age_size).when(F.col("part") == PART_GENDER, gender_size).otherwise(1)
    return parts.withColumn("pos", place).where(F.col("pos") <= size).select("part", "pos", "user_age", "user_gender", "cnt")


def answer_parts(scored: DataFrame, page: int, size: int) -> DataFrame:
    """The whole answer of a search as rows ``(part, pos, name, value)``: total, both facets and the
    page of hits by score.  ``scored`` should be a written frame: it is read for the counts and
    for the page."""
    counts = facets(scored).where(F.col("part") != PART_TOTAL).select(
        "part", "pos", F.coalesce(F.col("user_age").cast("string"), "user_gender").alias("name"), F.col("cnt").cast("double").alias("value"))
    # Grouping sets give no total of no rows.
    whole = total(scored).select(F.lit(PART_TOTAL).alias("part"), F.lit(1).alias("pos"), F.lit(None).cast("string").alias("name"),
                                 F.col("total").cast("double").alias("value"))
    first = (page - 1) * size
    # At most one page of rows, so the window holds no more.
    order = Window.orderBy(F.desc("score"), F.asc("doc_id"))
    hits_ = ranked_page(scored, page, size).select(
        F.lit(PART_HIT).alias("part"), (F.row_number().over(order) + first).alias("pos"), F.col("doc_id").alias("name"),
        F.round("score", SCORE_DIGITS).alias("value"))
    return whole.unionByName(counts).unionByName(hits_)


def age_gender_shares(found: DataFrame) -> DataFrame:
    """The ``stat`` part of the answer as rows ``(pos, title, name, value)``.

    Age shares come from the top-100 age facet folded into bands; the last
    band is the remainder ``100 - a - b``, so ages outside the facet land
    there.  Female share is from the top-2 gender facet (0 when absent); male
    is the remainder, so a missing gender counts as male.  No rows when
    nothing was found.

    Both facets and the total are one pass over the hits (:func:`facets`), folded to
    one row.
    """
    parts = facets(found)
    cnt, age = F.col("cnt"), F.col("user_age")
    of_age = F.col("part") == PART_AGE

    def of(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, cnt)), F.lit(0))

    folded = parts.agg(
        F.sum(F.when(F.col("part") == PART_TOTAL, cnt)).alias("total"),
        of(of_age & (age < 20)).alias("under20"),
        of(of_age & (age >= 20) & (age < 30)).alias("from20"),
        of((F.col("part") == PART_GENDER) & (F.col("user_gender") == "F")).alias("female"),
    ).where(F.col("total") > 0)
    shares = folded.select(
        truncated_percent("under20", "total").alias("a"),
        truncated_percent("from20", "total").alias("b"),
        truncated_percent("female", "total").alias("f"),
    )

    def option(pos: int, title: str, name: str, value: Column) -> Column:
        return F.struct(
            F.lit(pos).alias("pos"), F.lit(title).alias("title"), F.lit(name).alias("name"),
            value.cast("double").alias("value"),
        )

    rows = F.array(
        option(1, m.AGE_TITLE, m.AGE_UNDER_20, F.col("a")),
        option(2, m.AGE_TITLE, m.AGE_20_TO_29, F.col("b")),
        option(3, m.AGE_TITLE, m.AGE_30_PLUS, remainder_percent("a", "b")),
        option(4, m.GENDER_TITLE, m.MALE, remainder_percent("f")),
        option(5, m.GENDER_TITLE, m.FEMALE, F.col("f")),
    )
    return shares.select(F.inline(rows))


def age_band_counts(found: DataFrame) -> DataFrame:
    """Counts per age band over all hits (a helper view of the facet)."""
    return found.groupBy(age_band("user_age").alias("band")).agg(F.count(F.lit(1)).alias("cnt"))


# --- relevance -----------------------------------------------------------------

def bm25_scores(corpus: DataFrame, found: DataFrame, keyword: str, text_col: str = "sku_name",
                k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """Add a BM25 ``score`` to ``found`` with statistics of the whole corpus.

    Corpus size, mean length and the document frequency of each query term
    come from one global aggregate (partial per partition, no shuffle of
    rows) that enters the per-hit expression as a single scalar subquery.
    The sum over query terms is unrolled: the terms are a parameter.
    """
    q_terms = _keyword_tokens(keyword)
    if not q_terms:
        return found.withColumn("score", F.lit(0.0)).where(F.lit(False))
    doc_tokens = tokens(text_col)
    stats_cols = [F.count(F.lit(1)).cast("double").alias("n"), F.avg(F.size(token_list(text_col))).alias("avgdl")]
    stats_cols += [
        F.sum(F.when(F.array_contains(doc_tokens, F.lit(t)), 1).otherwise(0)).cast("double").alias(f"df{i}")
        for i, t in enumerate(q_terms)
    ]
    stats = corpus.agg(F.struct(*stats_cols).alias("s")).scalar()

    dl = F.size(token_list(text_col)).cast("double")
    norm_len = F.lit(1.0 - b) + F.lit(b) * dl / stats.getField("avgdl")
    score = F.lit(0.0)
    for i, t in enumerate(q_terms):
        df = stats.getField(f"df{i}")
        idf = F.log(F.lit(1.0) + (stats.getField("n") - df + F.lit(0.5)) / (df + F.lit(0.5)))
        tf = F.size(F.filter(token_list(text_col), _equals(t))).cast("double")
        score = score + idf * tf * F.lit(k1 + 1.0) / (tf + F.lit(k1) * norm_len)
    return found.withColumn("score", score)


def _equals(term: str):
    """One-argument predicate for ``filter`` (a two-argument lambda would get
    the element index as its second argument)."""
    return lambda x: x == F.lit(term)


def _keyword_tokens(keyword: str) -> list[str]:
    seen: list[str] = []
    for t in re.split(r"[\W_]+", keyword.lower()):
        if t and t not in seen:
            seen.append(t)
    return seen


def ranked_page(scored: DataFrame, page: int, size: int) -> DataFrame:
    """Page ``page`` (1-based) of ``size`` hits by score, ties by doc id."""
    offset = (page - 1) * size
    return scored.orderBy(F.desc("score"), F.asc("doc_id")).offset(offset).limit(size)


def sale_detail_answer(shares: DataFrame, page: DataFrame, found: DataFrame) -> DataFrame:
    """The reference's JSON answer ``{"total", "stat": [{title, options:
    [{name, value}]}], "detail": [...]}`` as one row; ``{}`` when nothing
    was found.

    Only bounded inputs are folded into the row: five share rows and one
    page of hits, in the page's order; the total is a count.
    """
    stat = (
        shares.groupBy("title").agg(
            F.min("pos").alias("pos"),
            F.array_sort(F.collect_list(F.struct("pos", "name", "value"))).alias("opts"),
        )
        .agg(F.array_sort(F.collect_list(F.struct("pos", "title", "opts"))).alias("stat"))
        .select(F.transform("stat", lambda s: F.struct(
            s["title"].alias("title"),
            F.transform(s["opts"], lambda o: F.struct(o["name"].alias("name"), o["value"].alias("value"))).alias("options"),
        )).alias("stat"))
    )
    # The page's order (score if there is one, then id) is restored from a key of its own.
    place = -F.col("score") if "score" in page.columns else F.lit(0.0)
    row = F.struct(*[F.round(c, SCORE_DIGITS).alias(c) if c == "score" else F.col(c) for c in page.columns])
    placed = F.array_sort(F.collect_list(F.struct(place.alias("place"), F.col("doc_id"), row.alias("row"))))
    detail = page.agg(F.transform(placed, lambda x: x["row"]).alias("detail"))
    n = total(found).scalar()
    answer = stat.select(
        F.when(n > 0, F.to_json(F.struct(n.alias("total"), F.col("stat"), detail.select("detail").scalar().alias("detail"))))
        .otherwise(F.lit("{}")).alias("json")
    )
    return answer

"""Quality rules with verdicts on hosts.

Document rules are counted inside the row with SQL functions.  Rule failures
are summed per host (``source`` of ``documents``); a host's failure rate is shrunk
towards all hosts with a beta prior fitted to them (method of moments), so a
host with three documents is not judged by them alone; the hosts' verdicts are
joined back to the documents.

``base_failed`` documents go.  The others go if their host's shrunk failure rate
is above ``HOST_LIMIT``: then most of what the host publishes is rejected.

Edge cases: a null or empty text has no words and fails the base rule; a null
host is a host of its own; repeated rows are counted and returned each; an empty
table gives an empty result; other columns are ignored, whatever their names.
Without spread between hosts the prior falls back to ``PRIOR_WEIGHT`` documents at
the mean rate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import SPACE, WORD, broadcast_if_counted, without, word_array, written

# Fixed values of the contract.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"

HOST_LIMIT = 0.5
PRIOR_WEIGHT = 20.0
MAX_SYMBOLS_PERCENT = 10  # symbols per hundred words
MAX_DUP_LINE_PERCENT = 30
MEAN_WORD_CHARS = (3, 10)


def with_repeated_words(rows: DataFrame, words: str, into: str) -> DataFrame:
    """Adds the number of words that lie in a window found at least twice, the
    first time included.

    A window is first known by the hash of four of its words: if these all differ
    (the usual case) the answer is 0.  Else hash and place are sorted and the
    places whose neighbour has the same hash are marked; the same over the
    whole windows of the marked places leaves the repeated ones.  The union of
    these windows is measured: a marked place adds the words since the last
    marked place, ``WINDOW`` at most.  Each step is a column of its own, so that
    no lambda evaluates an array per element.
    """
    def some_words(w: Column, i: Column) -> Column:
        return F.xxhash64(w, *[F.get(F.col(words), i + d) for d in (2, 5, WINDOW - 1)])

    def all_words(p: Column) -> Column:
        return F.struct(F.xxhash64(F.slice(F.col(words), p["at"] + 1, F.lit(WINDOW))).alias("h"), p["at"].alias("at"))

    n = F.size(words)
    first = F.slice(F.transform(words, some_words), F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(0)))
    rows = rows.withColumn("_hashes", F.when(n > WINDOW, first))
    rows = rows.withColumn("_placed", F.when(
        F.size(F.array_distinct("_hashes")) < F.size("_hashes"),
        F.array_sort(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))))
    rows = _twice(rows.drop("_hashes"), "_placed")
    rows = rows.withColumn("_placed", F.array_sort(F.transform("_placed", all_words)))
    rows = _twice(rows, "_placed")
    rows = rows.withColumn("_marks", F.array_sort(F.transform("_placed", lambda p: p["at"]))).drop("_placed")

    def cover(acc: Column, at: Column) -> Column:
        return F.struct((acc["words"] + F.least(F.lit(WINDOW), at - acc["last"])).alias("words"), at.alias("last"))

    zero = F.struct(F.lit(0).alias("words"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate("_marks", zero, cover, lambda acc: acc["words"])
    return rows.withColumn(into, F.coalesce(covered, F.lit(0)).cast("long")).drop("_marks")


def _twice(rows: DataFrame, pairs: str) -> DataFrame:
    """Keeps the (h, at) pairs whose neighbour in the sorted array has the same h."""
    def keep(p: Column, i: Column) -> Column:
        before, after = F.get(F.col(pairs), i - 1)["h"], F.get(F.col(pairs), i + 1)["h"]
        return F.coalesce(before == p["h"], F.lit(False)) | F.coalesce(after == p["h"], F.lit(False))

    return rows.withColumn(pairs, F.filter(pairs, keep))


def measure(docs: DataFrame) -> DataFrame:
    """Id, host, the counts and ``base_failed`` of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id"), F.col("source").alias("host"), text.alias("text"))
    rows = rows.withColumn("words", word_array(F.col("text")))
    rows = with_repeated_words(rows, "words", "n_repeat_words")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    rows = rows.select(
        "doc_id", "host", F.size("words").cast("long").alias("n_words"),
        F.length(without(F.col("text"), SPACE)).cast("long").alias("word_chars"),
        F.length(without(F.col("text"), "^" + SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("lines"), "n_repeat_words",
    ).withColumn("n_lines", F.size("lines").cast("long"))
    rows = rows.withColumn("n_dup_lines", F.col("n_lines") - F.size(F.array_distinct("lines"))).drop("lines")
    return rows.withColumn("base_failed", base_failed())


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def rule_failed() -> Column:
    """Whether a document fails any rule that counts against its host."""
    low, high = MEAN_WORD_CHARS
    return (
        F.col("base_failed")
        | (F.col("n_symbols") * 100 > F.col("n_words") * MAX_SYMBOLS_PERCENT)
        | (F.col("n_dup_lines") * 100 > F.col("n_lines") * MAX_DUP_LINE_PERCENT)
        | (F.col("word_chars") < F.col("n_words") * low) | (F.col("word_chars") > F.col("n_words") * high)
    )


def host_rates(measured: DataFrame) -> DataFrame:
    """Per host: documents, failures, shrunk failure rate and verdict."""
    hosts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(rule_failed().cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    m, v, inverse_n = hosts.agg(F.avg(rate), F.coalesce(F.var_samp(rate), F.lit(0.0)), F.avg(1.0 / F.col("n_docs"))).first()
    alpha, beta = beta_prior(m or 0.0, v or 0.0, inverse_n or 0.0)
    shrunk = (F.col("n_failed") + F.lit(alpha)) / (F.col("n_docs") + F.lit(alpha + beta))
    return hosts.withColumn("host_rate", shrunk).withColumn("host_rejected", shrunk > HOST_LIMIT)


def beta_prior(mean: float, variance: float, mean_inverse_n: float) -> tuple[float, float]:
    """Beta prior of the hosts' true rates by moments: the variance of observed
    rates less what sampling alone adds is the prior's variance."""
    mean = min(max(mean, 1e-6), 1 - 1e-6)
    between = variance - mean * (1 - mean) * mean_inverse_n
    weight = mean * (1 - mean) / between - 1 if between > 0 else PRIOR_WEIGHT
    weight = min(max(weight, 2.0), 1e4)
    return mean * weight, (1 - mean) * weight


def apply_rules(docs: DataFrame) -> DataFrame:
    """Counts, ``base_failed``, the host's shrunk rate and ``kept`` of every document."""
    measured = written(measure(docs), "rule-counts")
    hosts = broadcast_if_counted(host_rates(measured).select(F.col("host").alias("rated_host"), "host_rate", "host_rejected"))
    judged = measured.join(hosts, F.col("host").eqNullSafe(F.col("rated_host")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.col("host_rejected")).alias("kept"))

"""Quality classifier: Bradley-Terry scores learned from preference pairs.

Every document is described by a dozen ratios of its whole text, computed with
SQL functions.  A labelled good document is preferred to a labelled bad one of
the training rows; the weights minimise the logistic loss of the pairs' feature
differences (Bradley-Terry: P(a over b) = sigmoid(w . (a - b))).  The raw score
w . x is only known up to a shift, so the threshold is a quantile of the
training scores: the one that separates the classes best, counting both alike.
Scores are mapped to 0..1 so that this quantile becomes ``THRESHOLD``.

The fit is the only step on the driver: it takes at most ``MAX_FIT_ROWS`` labelled
rows per class (those with the smallest hash of their id) of a dozen numbers
each.  Scoring is one SQL expression over any number of documents: no shuffle.

Edge cases: a null text counts as empty and gets a score; labels that are null
or neither 0 nor 1 are left out, and an id with both labels counts for both;
without both classes all weights are 0 and every score is 0.5; repeated rows are
scored alike; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import WORD, without

THRESHOLD = 0.3
# Bound of the sample that the classifier is fitted on, per class.
MAX_FIT_ROWS = 10_000
# Preference pairs drawn from it (each good row meets several bad ones).
MAX_PAIRS = 200_000
RIDGE = 1e-3

FEATURES = (
    "log_words", "word_length", "upper", "digits", "symbols", "bangs", "bars",
    "end_marks", "distinct_words", "distinct_pairs", "dup_lines", "long_words", "short_words", "marked_words",
)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` when divided by ``parts``
    (a null id is not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def with_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the array ``features`` (doubles, as in ``FEATURES``)."""
    rows = docs.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    rows = rows.withColumn("_words", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))
    rows = rows.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD)))
    rows = rows.withColumn("_chars", F.greatest(F.length("_text"), F.lit(1)).cast("double"))
    rows = rows.withColumn("_n", F.greatest(F.size("_words"), F.lit(1)).cast("double"))

    def share(chars: str) -> Column:
        return F.length(without(F.col("_text"), "^" + chars)) / F.col("_chars")

    def words_like(pattern: str) -> Column:
        return F.size(F.filter("_words", lambda w: w.rlike(pattern))) / F.col("_n")

    pairs = F.transform("_words", lambda w, i: F.xxhash64(w, F.get(F.col("_words"), i + 1)))
    values = {
        "log_words": F.log(F.col("_n")),
        "word_length": F.least(F.length(F.array_join("_words", "")) / F.col("_n"), F.lit(30.0)),
        "upper": share(r"\p{Lu}"),
        "digits": share("0-9"),
        "symbols": share("#*$%&<>@=/\\\\_~^"),
        "bangs": share("!?"),
        "bars": share("|"),
        "end_marks": share(".,;:"),
        "distinct_words": F.size(F.array_distinct("_words")) / F.sqrt(F.col("_n") * F.greatest(F.least(F.col("_n"), F.lit(100.0)), F.lit(1.0))),
        "distinct_pairs": F.size(F.array_distinct(pairs)) / F.col("_n"),
        "dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))) / F.greatest(F.size("_lines"), F.lit(1)),
        "long_words": words_like("^.{16}"),
        "short_words": words_like("^.{1,3}$"),
        "marked_words": words_like(r"[^\p{L}\p{N}]{2}$"),
    }
    features = F.array(*[values[name].cast("double") for name in FEATURES])
    return rows.withColumn("features", features).drop("_text", "_words", "_lines", "_chars", "_n")


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float  # raw score that becomes THRESHOLD
    slope: float

    def raw(self, features: Column) -> Column:
        """w . x of standardised features, each within four deviations."""
        out = F.lit(0.0)
        for i, (m, s, w) in enumerate(zip(self.mean, self.scale, self.weights, strict=True)):
            z = (F.get(features, F.lit(i)) - F.lit(float(m))) / F.lit(float(s))
            out = out + F.greatest(F.least(z, F.lit(4.0)), F.lit(-4.0)) * F.lit(float(w))
        return out

    def score(self, features: Column) -> Column:
        """0..1, ``THRESHOLD`` at the cut."""
        if not np.any(self.weights):
            return F.lit(0.5)
        at = float(np.log(THRESHOLD / (1 - THRESHOLD)))
        z = (self.raw(features) - F.lit(self.cut)) * F.lit(self.slope) + F.lit(at)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(z, F.lit(40.0)), F.lit(-40.0))))


def bradley_terry(good: np.ndarray, bad: np.ndarray, max_pairs: int = MAX_PAIRS, rounds: int = 30) -> np.ndarray:
    """Weights that minimise the mean logistic loss of the differences good - bad
    (Newton steps with a small ridge).  Pairs: rows of one class against rotated
    rows of the other, so each row is in about as many pairs."""
    n = max(len(good), len(bad))
    turns = max(1, min(max_pairs // n, min(len(good), len(bad))))
    at = np.arange(n)
    diffs = np.concatenate([
        good[(at + t * 7919) % len(good)] - bad[(at * 31 + t) % len(bad)] for t in range(turns)])
    w = np.zeros(diffs.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(diffs @ w, -40, 40)))
        gradient = diffs.T @ (p - 1) / len(diffs) + RIDGE * w
        curvature = (diffs * (p * (1 - p))[:, None]).T @ diffs / len(diffs) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curvature, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(features: np.ndarray, labels: np.ndarray) -> Model:
    """Bradley-Terry weights and the score quantile that separates best."""
    k = features.shape[1] if features.size else len(FEATURES)
    good, bad = labels == 1, labels == 0
    if not good.any() or not bad.any():
        return Model(np.zeros(k), np.ones(k), np.zeros(k), 0.0, 1.0)
    mean, scale = features.mean(axis=0), features.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    x = np.clip((features - mean) / scale, -4, 4)
    w = bradley_terry(x[good], x[bad])
    raw = x @ w
    # Quantiles between neighbouring scores: bad rows below, good rows at or above.
    order = np.argsort(raw, kind="stable")
    bad_below = np.concatenate(([0], np.cumsum(bad[order]))) / bad.sum()
    good_below = np.concatenate(([0], np.cumsum(good[order]))) / good.sum()
    gain = bad_below - good_below
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    at = int(best[len(best) // 2])
    s = raw[order]
    cut = float(s[0] - 1e-9 if at == 0 else s[-1] + 1e-9 if at == len(s) else (s[at - 1] + s[at]) / 2)
    spread = float(np.median(raw[good]) - np.median(raw[bad]))
    return Model(mean, scale, w, cut, 6.0 / spread if spread > 1e-9 else 1.0)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_FIT_ROWS) -> Model:
    """Fit on labelled rows that are not held out.  ``docs``: doc_id, text."""
    marks = labels.select(F.col("doc_id").alias("label_id"), F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.col("label_id").isNotNull() & ~held_out(F.col("label_id"), 5, 0)).distinct()
    counts = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}
    # A hash sample of a fixed size per class: the bound holds but for chance,
    # the sort below makes it strict.
    place = F.xxhash64("label_id").bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30))
    keep = F.lit(False)
    for value, n in counts.items():
        keep = keep | ((F.col("label") == value) & (place < min(1.0, 1.2 * max_rows / n)))
    sample = F.broadcast(marks.where(keep).withColumn("place", place))
    rows = with_features(docs.select("doc_id", "text").join(sample, F.col("doc_id") == F.col("label_id")))
    picked = rows.select("features", "label", "place", "doc_id").toPandas()
    picked = picked.sort_values(["label", "place", "doc_id"], kind="stable").groupby("label").head(max_rows)
    if not len(picked):
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    return fit(np.stack(picked["features"].to_numpy()), picked["label"].to_numpy())


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``quality_score``."""
    rows = with_features(docs)
    return rows.withColumn("quality_score", model.score(F.col("features"))).drop("features")


def passing(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """``columns`` of the documents whose score is at least ``THRESHOLD``.

    A plain filter on the score is pushed below the features, which are then
    evaluated inside the condition, the words anew for each word; a filter on
    generated rows stays above.  Columns travel as one, so their names may be any.
    """
    rows = scored(docs.select(F.struct(*columns).alias("_row"), "text"), model)
    one = rows.select("_row", F.explode_outer(F.array("quality_score")).alias("_score"))
    return one.where(F.col("_score") >= THRESHOLD).select("_row.*")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document (op8)."""
    model = train(docs, labels)
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))

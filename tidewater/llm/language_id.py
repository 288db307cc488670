"""Language identification with Kneser-Ney character models.

One interpolated Kneser-Ney model of order ``ORDER`` per language.  A text is
lower-cased, everything but letters becomes a single space, and each character is
predicted from up to ``ORDER - 1`` before it; the language with the lowest
cross-entropy per character wins.  Rejection is calibrated on the training texts:
a text is marked ``rejected`` if its cross-entropy is above the ``REJECT_QUANTILE``
quantile of the training texts' own (its language is still reported).

Storage: per order one sorted array of the 64-bit hashes of all n-grams of all
languages, and beside it a row of log probabilities per language (of the n-gram's
last character) and one of log back-off weights (of the n-gram as a context).  A
character costs one binary search at the highest order, and one more at each
lower order only where that finds nothing.

Every language that has a training text is learned.  The models are fitted on about
``MAX_FIT_CHARS`` characters of texts per language (whole texts, those with the smallest
hash of their id and text, the first of them always), so the model that is broadcast
grows with the languages and not with the table; counting is distributed.
Prediction covers every document, whole, in slices of an Arrow batch: no shuffle.

Edge cases: a null text or one without a letter is ``und`` with score 0; languages
that are null are not learned; without any learned language everything is
``und``; ties go to the language first in code point order; repeated rows get the
same answer; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.hashing import U, mix
from tidewater.llm.quality_classifier import held_out

ORDER = 4
MAX_FIT_CHARS = 4_000_000
REJECT_QUANTILE = 0.999
DISCOUNT = 0.75
UNKNOWN = "und"
SLICE_CHARS = 1 << 20
# Marks stay with their letters; numbers of any kind are no letters.
_NOT_LETTER = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def normalised(text: str | None) -> str:
    """Letters in lower case, anything between them one space, a space around."""
    return " " + _NOT_LETTER.sub(" ", (text or "").lower()).strip() + " "


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts one after another, and offsets (n + 1)."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32), offsets


def ngram_hashes(chars: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` characters that end at each place from ``n - 1`` on."""
    size = len(chars) - n + 1
    if size <= 0:
        return np.zeros(0, U)
    with np.errstate(over="ignore"):
        h = np.full(size, n, U)
        for i in range(n):
            h = h * U(0x100000001B3) + chars[i:i + size].astype(U)
        return mix(h)


def _ends_ok(offsets: np.ndarray, size: int, n: int) -> np.ndarray:
    """Whether the n-gram ending at each place from n - 1 on is inside one text."""
    start_of = np.zeros(size, np.int64)
    starts = offsets[:-1][np.diff(offsets) > 0]
    start_of[starts] = starts
    start_of = np.maximum.accumulate(start_of)
    at = np.arange(n - 1, size)
    return at - start_of[n - 1:] >= n - 1


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) rows to (lang, gram, n): character n-grams of order ``ORDER``
    (shorter at a text's start), summed over the task."""
    sums: dict[tuple[str, str], int] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            s = normalised(text)
            for i in range(1, len(s)):
                key = (lang, s[max(0, i - ORDER + 1):i + 1])
                sums[key] = sums.get(key, 0) + 1
    if sums:
        langs, grams = zip(*sums, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(grams, pa.string()), pa.array(list(sums.values()), pa.int64())],
            names=["lang", "gram", "n"])


@dataclass(frozen=True)
class Model:
    languages: list[str]
    hashes: list[np.ndarray]  # per order 1..ORDER, sorted
    log_p: list[np.ndarray]  # per order, (n-grams, languages), float32
    back_off: list[np.ndarray]  # per order, weight of the n-gram as a context
    floor: np.ndarray  # log probability of an unseen character
    limit: float = np.inf  # cross-entropy beyond which a text is rejected

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Cross-entropy in bits per character, (texts, languages)."""
        out = np.zeros((len(texts), len(self.languages)))
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to]) <= SLICE_CHARS):
                size += len(texts[to])
                to += 1
            out[at:to] = self._slice(texts[at:to])
            at = to
        return out

    def _slice(self, texts: list[str]) -> np.ndarray:
        chars, offsets = code_points(texts)
        size, langs = len(chars), len(self.languages)
        total = np.zeros((size, langs), np.float32)
        open_ = np.ones(size, bool)  # places not yet predicted
        open_[offsets[:-1][np.diff(offsets) > 0]] = False  # the leading space
        for n in range(ORDER, 0, -1):
            grams = ngram_hashes(chars, n)
            if not len(grams):
                continue
            inside = _ends_ok(offsets, size, n)
            at = np.flatnonzero(open_[n - 1:] & inside)
            found, where = lookup(self.hashes[n - 1], grams[at])
            total[at[found] + n - 1] += self.log_p[n - 1][where]
            open_[at[found] + n - 1] = False
            if n > 1:
                # What is still open backs off: times the weight of its context.
                left = at[~found]
                context = ngram_hashes(chars, n - 1)
                known, where = lookup(self.hashes[n - 2], context[left])
                total[left[known] + n - 1] += self.back_off[n - 2][where]
        total[open_] += self.floor
        ends = np.concatenate((np.zeros((1, langs)), np.cumsum(total, axis=0, dtype=np.float64)))
        lengths = np.maximum(np.diff(offsets) - 1, 1)[:, None]
        return -(ends[offsets[1:]] - ends[offsets[:-1]]) / lengths


def lookup(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are in the sorted table, and where those are."""
    if not len(table):
        return np.zeros(len(keys), bool), np.zeros(0, np.int64)
    where = np.searchsorted(table, keys)
    where[where == len(table)] = 0
    found = table[where] == keys
    return found, where[found]


def _one_hash(gram: str) -> int:
    return int(ngram_hashes(np.frombuffer(gram.encode("utf-32-le", "surrogatepass"), np.uint32), len(gram))[0])


def build(counts: pd.DataFrame, order: int = ORDER) -> Model:
    """Kneser-Ney models from (lang, gram, n).

    The highest order uses counts, lower ones the number of different characters
    seen before the n-gram (its counts where it only begins a text).  P(c | h) =
    max(k(hc) - D, 0) / k(h) + D * types(h) / k(h) * P(c | h without its first).
    Where hc was not seen the first term is 0, so only the back-off weights of
    seen contexts and the probabilities of seen n-grams are stored.
    """
    languages = sorted(counts["lang"].unique())
    probabilities: list[dict[str, np.ndarray]] = [{} for _ in range(order)]
    weights: list[dict[str, np.ndarray]] = [{} for _ in range(order)]
    floor = np.zeros(len(languages), np.float32)
    for j, lang in enumerate(languages):
        own = counts[counts["lang"] == lang]
        k: list[dict[str, int]] = [{} for _ in range(order + 1)]
        for gram, n in zip(own["gram"], own["n"], strict=True):
            k[len(gram)][gram] = k[len(gram)].get(gram, 0) + int(n)
        for m in range(order - 1, 0, -1):  # continuation counts of shorter ones
            for gram in k[m + 1]:
                k[m][gram[1:]] = k[m].get(gram[1:], 0) + 1
        lower: dict[str, float] = {}
        base = 1.0 / (len(k[1]) + 1)
        for m in range(1, order + 1):
            total: dict[str, int] = {}
            types: dict[str, int] = {}
            for gram, n in k[m].items():
                h = gram[:-1]
                total[h] = total.get(h, 0) + n
                types[h] = types.get(h, 0) + 1
            here: dict[str, float] = {}
            for gram, n in k[m].items():
                h = gram[:-1]
                rest = DISCOUNT * types[h] / total[h]
                here[gram] = max(n - DISCOUNT, 0) / total[h] + rest * (lower.get(gram[1:], base) if m > 1 else base)
            for gram, p in here.items():
                probabilities[m - 1].setdefault(gram, np.full(len(languages), np.nan, np.float32))[j] = np.log2(p)
            for h in total:
                w = np.log2(DISCOUNT * types[h] / total[h])
                if m == 1:
                    floor[j] = w + np.log2(base)
                else:
                    weights[m - 2].setdefault(h, np.zeros(len(languages), np.float32))[j] = w
            lower = here
    return _stored(languages, probabilities, weights, floor)


def _stored(languages, probabilities, weights, floor) -> Model:
    """Sorted hash arrays.  An n-gram that one language has seen and another has
    not gets the other's value by backing off, here and once for all."""
    def value(gram: str, j: int) -> float:
        row = probabilities[len(gram) - 1].get(gram)
        if row is not None and not np.isnan(row[j]):
            return float(row[j])
        if len(gram) == 1:
            return float(floor[j])
        context = weights[len(gram) - 2].get(gram[:-1])
        return (float(context[j]) if context is not None else 0.0) + value(gram[1:], j)

    for table in probabilities:
        for gram, row in table.items():
            for j in np.flatnonzero(np.isnan(row)):
                row[j] = value(gram, int(j))
    hashes, log_p, back_off = [], [], []
    none = np.zeros(len(languages), np.float32)
    for m, table in enumerate(probabilities):
        # Contexts are stored with the n-grams of their length.
        grams = list(dict.fromkeys([*table, *weights[m]]))
        h = np.array([_one_hash(g) for g in grams], U)
        sort = np.argsort(h)
        hashes.append(h[sort])
        rows = [table[g] if g in table else np.array([value(g, j) for j in range(len(languages))], np.float32) for g in grams]
        shape = (len(grams), len(languages))
        log_p.append(np.array(rows, np.float32).reshape(shape)[sort])
        back_off.append(np.array([weights[m].get(g, none) for g in grams], np.float32).reshape(shape)[sort])
    return Model(languages, hashes, log_p, back_off, floor)


def train(docs: DataFrame, max_chars: int = MAX_FIT_CHARS) -> Model:
    """Fit on the documents (doc_id, text, lang) that are not held out."""
    rows = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"), 3, 1))
    sizes = rows.groupBy("lang").agg(F.sum(F.length("text")).alias("chars")).orderBy(F.desc("chars"), "lang")
    langs = sizes.collect()
    if not langs:
        return Model([], [np.zeros(0, U)] * ORDER, [np.zeros((0, 0), np.float32)] * ORDER,
                     [np.zeros((0, 0), np.float32)] * ORDER, np.zeros(0, np.float32))
    # Ids and texts, so rows without an id spread too.
    place = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30))
    placed = rows.where(F.length("text") > 0).withColumn("place", place)
    first = {r["lang"]: r["first"] for r in placed.groupBy("lang").agg(F.min("place").alias("first")).collect()}
    # A language's first document is always taken, however long.
    upto = F.create_map(*[x for r in langs for x in (
        F.lit(r["lang"]), F.lit(float(max(max_chars / max(r["chars"], 1), first.get(r["lang"], 0.0)))))])
    sample = placed.where(F.col("place") <= F.element_at(upto, F.col("lang"))).select("lang", "text")
    grams = sample.mapInArrow(_count_batches, "lang string, gram string, n long")
    model = build(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    return _calibrated(model, sample, docs)


def _calibrated(model: Model, sample: DataFrame, docs: DataFrame) -> Model:
    """The rejection limit: a quantile of the sampled training texts' lowest
    cross-entropies."""
    rows = sample.select(F.lit(None).cast("long").alias("doc_id"), "text")
    scored = predict(rows, model).where(F.col("lang_pred") != UNKNOWN)
    limit = scored.agg(F.percentile_approx("entropy", REJECT_QUANTILE, 10_000)).first()[0]
    return Model(model.languages, model.hashes, model.log_p, model.back_off, model.floor,
                 float(limit) if limit is not None else np.inf)


def predict(docs: DataFrame, model: Model, id_type: str | None = None) -> DataFrame:
    """doc_id, lang_pred, score (the winner's posterior over half of a text's
    characters, at most 100 of them), entropy (bits per character of the
    winner) and rejected, for every document (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = id_type or dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [normalised(t) for t in batch.column(1).to_pylist()]
            n = len(texts)
            lang, score = np.full(n, UNKNOWN, object), np.zeros(n)
            entropy, rejected = np.full(n, np.nan), np.zeros(n, bool)
            some = np.array([_LETTER.search(t) is not None for t in texts], bool)
            if model.languages and some.any():
                picked = [t for t, ok in zip(texts, some, strict=True) if ok]
                bits = model.entropies(picked)
                best = bits.argmin(axis=1)
                weight = np.minimum(np.array([len(t) for t in picked]) / 2, 100)[:, None]
                odds = np.exp2(-(bits - bits.min(axis=1, keepdims=True)) * weight)
                lang[some] = np.array(model.languages, object)[best]
                score[some] = 1 / odds.sum(axis=1)
                entropy[some] = bits.min(axis=1)
                rejected[some] = entropy[some] > model.limit
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(entropy), pa.array(rejected)],
                names=["doc_id", "lang_pred", "score", "entropy", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, lang_pred string, score double, entropy double, rejected boolean")


def identify(docs: DataFrame) -> DataFrame:
    """op10: doc_id, held_out, lang_pred, score and rejected of every document."""
    model = train(docs)
    return predict(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score", "rejected")

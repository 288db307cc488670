"""Spelling variants: words one edit apart, by pairs of trie nodes.

Words are the paths of a forward trie, and of one of the reversed words.  A word cut at
a place is a pair (node of its prefix, node of its suffix).  Two words differ by
a replaced code point exactly if they share the pair around it, and by an inserted
one exactly if the pair around that code point in the longer word is a cut of the
shorter one.  So each word gives

* a *skip* pair for each of its code points, and
* a *whole* pair for each place between, before and behind them,

and neighbours are the words that meet in a pair.  At most one word is whole and at most
one word for each letter skips there, so a meeting is bounded by the alphabet, whatever
the number of words, and every pair of words in it is a true link.

Nodes are numbered by a 64-bit number of their path, which needs no shared counter or
shuffle of prefixes and is linear in a word's length; links are verified on the words
themselves, so a clash of numbers adds nothing.

Counting reads every text once, sums runs per task before the shuffle and sends
only words and counts.  The pairs are integers.  Forms are followed to their roots by
doubling; counts grow tenfold along a chain, so rounds are few.

Edge cases: a null text has no words; a null id counts as an empty one; repeated rows
count again; equal counts are decided by the code-point order of the words; an empty table
gives an empty result; a run of any length is one word; extra columns are ignored,
whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import written
from tidewater.llm.hashing import U, mix, slices

RUN = re.compile("[A-Za-zÀ-ÿ]+")
MIN_LETTERS = 7
MIN_COUNT = 2
# A form is at least this many times as common as its variant.
TIMES = 10
# A run whose hash this divides loses a code point.
DROP_EVERY = 31
# Counts of a task leave for the shuffle at this many distinct words.
HELD_WORDS = 200_000
# Cuts of words are made for about this many code points at a time.
CUT_LETTERS = 1 << 18
_LOWER = {c: c + 32 for c in range(65, 91)}
_FORWARD = U(0x9E3779B97F4A7C15)
_BACKWARD = U(0xC2B2AE3D27D4EB4F)


def _counted(docs: DataFrame) -> DataFrame:
    """(word, n) of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for whole in batches:
            for batch in slices(whole):
                for ident, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    start = zlib.crc32(f"{'' if ident is None else ident}:".encode())
                    for word, n in Counter(RUN.findall((text or "").translate(_LOWER))).items():
                        if len(word) < MIN_LETTERS:
                            continue
                        h = zlib.crc32(word.encode(), start)
                        if h % DROP_EVERY == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < MIN_LETTERS:
                                continue
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield out()
        yield out()

    parts = docs.select(F.col("doc_id").alias("ident"), F.col("text").alias("text")).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def node_numbers(letters: np.ndarray, offsets: np.ndarray, base: np.uint64) -> np.ndarray:
    """The number of the trie node before every letter of every word and behind its last:
    words of ``offsets[i + 1] - offsets[i]`` letters have one number more."""
    n = len(offsets) - 1
    with np.errstate(over="ignore"):
        powers = np.full(int((offsets[1:] - offsets[:-1]).max(initial=0)) + 1, base, U)
        powers[0] = U(1)
        powers = np.cumprod(powers, dtype=U)
        word = np.repeat(np.arange(n), offsets[1:] - offsets[:-1])
        depth = np.arange(len(letters)) - offsets[word]
        sums = np.zeros(len(letters) + 1, U)
        np.cumsum(mix(letters.astype(U)) * powers[depth], out=sums[1:])
        place_word = np.repeat(np.arange(n), offsets[1:] - offsets[:-1] + 1)
        place = np.arange(len(letters) + n) - place_word
        return mix(sums[place] - sums[offsets[place_word]])


def cuts(words: list[str], idents: np.ndarray) -> pa.RecordBatch:
    """All pairs (prefix node, suffix node) of words: ``skips`` is 1 where a code point is
    left out, 2 where it is also the first of a run of equal ones, 0 for whole cuts."""
    lengths = np.array([len(w) for w in words], np.int64)
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    prefix = node_numbers(letters, offsets, _FORWARD)
    # Reversed as a whole, words are in reverse order too.
    suffix = node_numbers(letters[::-1], offsets[-1] - offsets[::-1], _BACKWARD)[::-1]
    word = np.repeat(np.arange(len(words)), lengths)
    at = np.arange(len(letters)) + word  # place before each letter
    first = np.ones(len(letters), bool)
    first[1:] = (letters[1:] != letters[:-1]) | (word[1:] != word[:-1])
    place_word = np.repeat(np.arange(len(words)), lengths + 1)
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate((prefix[at], prefix)).view(np.int64)),
        pa.array(np.concatenate((suffix[at + 1], suffix)).view(np.int64)),
        pa.array(np.concatenate((1 + first.astype(np.int8), np.zeros(len(prefix), np.int8)))),
        pa.array(np.concatenate((idents[word], idents[place_word])))], ["prefix", "suffix", "skips", "id"])


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(a, b) ids of all words (``id``, ``word``) exactly one edit apart, each pair once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "word", CUT_LETTERS):
                yield cuts(batch.column(1).to_pylist(), batch.column(0).to_numpy())

    pairs = vocabulary.select("id", "word").mapInArrow(run, "prefix long, suffix long, skips byte, id long")
    met = pairs.groupBy("prefix", "suffix").agg(
        F.collect_list(F.struct("skips", "id")).alias("met")).where(F.size("met") > 1)
    one = met.select("met", F.explode("met").alias("x"))
    both = one.select("x", F.explode("met").alias("y")).where(
        # a replaced code point: two skips, once; a left out one: a first skip against a whole cut
        ((F.col("x.skips") > 0) & (F.col("y.skips") > 0) & (F.col("x.id") < F.col("y.id")))
        | ((F.col("x.skips") == 2) & (F.col("y.skips") == 0)))
    return both.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def _verified(pairs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Pairs with both words and counts, those not one edit apart left out."""
    a = vocabulary.select(F.col("id").alias("a"), F.col("word").alias("word_a"), F.col("n").alias("n_a"))
    b = vocabulary.select(F.col("id").alias("b"), F.col("word").alias("word_b"), F.col("n").alias("n_b"))
    return pairs.join(a, "a").join(b, "b").where(F.levenshtein("word_a", "word_b", 1) == 1)


def group_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the documents."""
    vocabulary = written(
        _counted(docs).select(F.monotonically_increasing_id().alias("id"), "word", "n"), "spelling-words")
    links = _verified(written(near_pairs(vocabulary), "spelling-links"), vocabulary)
    ways = links.select(F.col("a").alias("id"), F.struct((-F.col("n_b")).alias("minus_n"), F.col("word_b").alias("word"), F.col("b").alias("to")).alias("near"))
    ways = ways.unionByName(links.select(
        F.col("b").alias("id"), F.struct((-F.col("n_a")).alias("minus_n"), F.col("word_a").alias("word"), F.col("a").alias("to")).alias("near")))
    best = ways.groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), F.min("near").alias("best"))
    common = -F.col("best.minus_n") >= TIMES * F.col("n")
    joined = vocabulary.join(best, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(common, F.col("best.to")).alias("form_id"), F.when(common, F.col("best.word")).alias("form"),
        F.when(common, -F.col("best.minus_n")).alias("form_n"))
    words = written(joined, "spelling-forms")
    roots = _roots(words.where("form_id is not null").select("id", F.col("form_id").alias("up"), F.col("form").alias("root")))
    return words.join(roots.select("id", "root"), "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(id, up, root): every word with a form, and the last of its chain.  Counts grow
    along a chain, so there are no cycles."""
    while True:
        further = forms.select(F.col("id").alias("up"), F.col("up").alias("up2"), F.col("root").alias("root2"))
        forms = written(
            forms.join(further, "up", "left").select(
                "id", F.coalesce("up2", "up").alias("up"), F.coalesce("root2", "root").alias("root"),
                F.col("up2").isNotNull().alias("moved")), "spelling-roots")
        if forms.where("moved").isEmpty():
            return forms.drop("moved")
        forms = forms.drop("moved")

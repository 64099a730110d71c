"""Language ID (operator 7): known words first, character n-grams for the others.

A word that the model knows is scored by its log frequency in each language. An unseen word falls back to its character
n-grams, of four characters first, then three, two and one: the longest length at which any of its n-grams is known
decides, by the mean over them. A text gets the language of the largest sum over its words, the logarithm of the language's
share of training texts included; the score is that language's share of the posterior.

Every word and n-gram of the training texts is known; none is dropped. Their counts are a stored table that grows with the
corpus. Tasks receive the most frequent ones, at most ``WORDS`` words and ``GRAMS`` n-grams of each length, and score with them
what they can. Where the model has more, the other distinct words of a text are given back with the sums: they are looked up
by joins, each distinct word once, unseen ones by the n-grams that tasks do not have, and added to their texts. Which way
a word takes changes no score.

Cases: null texts and texts without a letter are ``und`` with score 0, as is everything if no language could be
learned. Texts of any length are read whole, in slices. Ties go to the first language in alphabetical order. Equal rows are
treated alike and repeated ids do not matter; an empty table gives no rows. Other columns are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.common import (
    distinct_words, documents, in_training_fold, is_held_out, map_texts, released, ship, slices, stored, strings, summed,
    unpacked,
)
from lakestrata.llm.words import mix, window_hashes

NOT_LETTERS = r"[^\p{L}]+"
LENGTHS = (4, 3, 2, 1)
WORDS, GRAMS = 200_000, 100_000  # the most frequent ones, n-grams of each length, that are sent to the tasks
SMOOTH = 0.5
SLICE = 4 << 20
UNKNOWN = "und"


def grams_of(words: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, hash) of the character n-grams of words with a mark before and after."""
    points = np.frombuffer("".join(f"\n{w}\n" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), sizes)
    if len(points) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = owner[: len(owner) - n + 1] == owner[n - 1 :]
    if n == 1:
        inside &= points != 10
    return owner[: len(inside)][inside], window_hashes(mix(points), n)[inside].view(np.int64)


@dataclass
class Frequent:
    """The part of the model that tasks receive. ``whole``: the sizes (0: words) of which it has all entries."""

    languages: list[str]
    words: dict[str, int]
    word_logs: np.ndarray  # a row for each word, a column for each language
    grams: dict[int, tuple[np.ndarray, np.ndarray]]  # by length: sorted hashes, rows of logarithms
    whole: frozenset[int]

    def known(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(scores, whether it has the word) of distinct words."""
        rows = np.fromiter((self.words.get(w, -1) for w in words), np.int64, len(words))
        out = np.zeros((len(words), len(self.languages)))
        out[rows >= 0] = self.word_logs[rows[rows >= 0]]
        return out, rows >= 0

    def of_grams(self, words: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(sums, number) of the n-grams of each word that it has, and (word, hash) of those that it does not have."""
        known, logs = self.grams[n]
        owner, found = grams_of(words, n)
        at = np.minimum(np.searchsorted(known, found), max(len(known) - 1, 0))
        has = known[at] == found if len(known) else np.zeros(len(found), bool)
        sums = np.zeros((len(words), len(self.languages)))
        for j in range(len(self.languages)):
            sums[:, j] = np.bincount(owner[has], logs[at[has], j], len(words)) if has.any() else 0.0
        return sums, np.bincount(owner[has], minlength=len(words)), owner[~has], found[~has]

    def scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(log scores, whether they are final) of distinct words, by language."""
        out, done = self.known(words)
        if 0 not in self.whole:
            return out, done
        open_ = np.flatnonzero(~done)
        for n in LENGTHS:
            if not len(open_):
                break
            sums, count, _, _ = self.of_grams([words[i] for i in open_.tolist()], n)
            if n not in self.whole:
                return out, done  # another n-gram of this length may be known
            some = count > 0
            out[open_[some]] = sums[some] / count[some, None]
            done[open_[some]] = True
            open_ = open_[~some]
        done[open_] = True  # nothing of these words is known
        return out, done


@dataclass
class Model:
    """Languages and their shares, the counts of all words and n-grams as a table, and the part for the tasks.

    counts: (size, word, gram, n0, n1, ...); totals and kinds: occurrences by language and entries, for each size.
    """

    languages: list[str]
    prior: list[float]
    frequent: Frequent
    counts: DataFrame | None
    totals: dict[int, list[int]]
    kinds: dict[int, int]

    def logs(self, size: int) -> list[Column]:
        """The log frequency in each language of an entry of ``counts``."""
        totals, kinds = self.totals[size], self.kinds[size]
        return [F.log((F.col(f"n{j}") + SMOOTH) / (t + SMOOTH * kinds)) for j, t in enumerate(totals)]


def _counts(languages: list[str]):
    places = {name: i for i, name in enumerate(languages)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_l = len(languages)

        def rows(n: int, words, hashes, owner, counts):
            table = [np.bincount(owner, counts[:, j], len(words if n == 0 else hashes)) for j in range(n_l)]
            keys = [pa.array([n] * len(table[0]), pa.int32())]
            keys += [words, pa.nulls(len(words), pa.int64())] if n == 0 else [pa.nulls(len(hashes), pa.string()), pa.array(hashes)]
            counted = pa.FixedSizeListArray.from_arrays(pa.array(np.stack(table, 1).astype(np.int64).ravel()), n_l)
            return pa.RecordBatch.from_arrays([*keys, counted.cast(pa.list_(pa.int64()))], ["size", "word", "gram", "n"])

        for batch in batches:
            for lo, size in slices(batch.column(0), SLICE):
                words, at, bounds = distinct_words(batch.column(0).slice(lo, size), NOT_LETTERS)
                if not len(words):
                    continue
                language = np.array([places[x] for x in batch.column(1).slice(lo, size).to_pylist()])
                of_place = np.repeat(language, np.diff(bounds))
                counts = np.stack([np.bincount(at[of_place == j], minlength=len(words)) for j in range(n_l)], 1)
                yield rows(0, words.cast(pa.string()), None, np.arange(len(words)), counts)
                names = strings(words)
                for n in LENGTHS:
                    owner, found = grams_of(names, n)
                    hashes, back = np.unique(found, return_inverse=True)
                    yield rows(n, None, hashes, back, counts[owner])

    return work


def fit(docs: DataFrame, words: int = WORDS, grams: int = GRAMS) -> Model:
    """Learn from the texts with a language in the training fold of ``docs``; one pass over them, one shuffle of counts.

    The driver receives the languages, totals and the most frequent ``words`` words and ``grams`` n-grams of each length.
    """
    ship(docs.sparkSession)
    known = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.filter(in_training_fold() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    shares = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(shares)
    if not languages:
        return Model([], [], Frequent([], {}, np.zeros((0, 0)), {}, frozenset()), None, {}, {})
    counted = known.select("text", "lang").mapInArrow(
        released(_counts(languages)), "size int, word string, gram long, n array<bigint>"
    )
    each = [f"n{j}" for j in range(len(languages))]
    sums = counted.groupBy("size", "word", "gram").agg(*[F.sum(F.col("n")[j]).alias(c) for j, c in enumerate(each)])
    table = stored(sums, "language-counts")
    # Entries by the power of two of their count: with these few rows, the least power that keeps within the limits.
    power = F.floor(F.log2(F.greatest(*map(F.col, each), F.lit(1)))).cast("int")
    levels = table.groupBy("size", power.alias("power")).agg(F.count(F.lit(1)).alias("k"), *[F.sum(c).alias(c) for c in each]).collect()
    sizes = (0, *LENGTHS)
    kinds = {size: sum(r["k"] for r in levels if r["size"] == size) for size in sizes}
    totals = {size: [sum(r[c] for r in levels if r["size"] == size) for c in each] for size in sizes}
    least, whole = {}, set()
    for size in sizes:
        left, least[size] = (words if size == 0 else grams), 64
        for r in sorted((r for r in levels if r["size"] == size), key=lambda r: -r["power"]):
            left -= r["k"]
            if left < 0:
                break
            least[size] = r["power"]
        else:
            whole.add(size)
    model = Model(languages, [float(np.log(shares[x] / sum(shares.values()))) for x in languages], None, table, totals, kinds)
    parts = {}
    for size in sizes:
        entry = F.col("word") if size == 0 else F.col("gram")
        logs = F.array(*model.logs(size))
        parts[size] = table.filter((F.col("size") == size) & (power >= least[size])).select(entry.alias("entry"), logs.alias("logs")).toArrow()

    def rows(part: pa.Table) -> np.ndarray:
        flat = part["logs"].combine_chunks().flatten().to_numpy(zero_copy_only=False) if len(part) else np.zeros(0)
        return flat.reshape(-1, len(languages))

    by_length = {}
    for n in LENGTHS:
        hashes = parts[n]["entry"].to_numpy()
        order = np.argsort(hashes)
        by_length[n] = (hashes[order], rows(parts[n])[order])
    names = {w: i for i, w in enumerate(parts[0]["entry"].to_pylist())}
    model.frequent = Frequent(languages, names, rows(parts[0]), by_length, frozenset(whole))
    return model


def _local(shared):
    """The sums of the words that a task can score, and the distinct other words of each text with their counts."""

    def make():
        def fn(texts: pa.Array) -> dict:
            frequent = shared.value
            words, at, bounds = distinct_words(texts, NOT_LETTERS)
            each, done = frequent.scores(strings(words)) if len(words) else (np.zeros((0, len(frequent.languages))), np.zeros(0, bool))
            sums = summed(each[at], bounds)
            owner, open_ = np.repeat(np.arange(len(texts)), np.diff(bounds)), ~done[at]
            key, n = np.unique(owner[open_] * max(len(words), 1) + at[open_], return_counts=True)
            text, word = key // max(len(words), 1), key % max(len(words), 1)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(texts)))]).astype(np.int32)
            pair = pa.StructArray.from_arrays([words.cast(pa.string()).take(pa.array(word)), pa.array(n, pa.int32())], ["word", "n"])
            flat = pa.array(sums.ravel())
            return {
                "sums": pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * sums.shape[1]), flat),
                "n_places": pa.array(np.diff(bounds)),
                "rest": pa.ListArray.from_arrays(pa.array(offsets), pair),
            }

        return fn

    return make


def _backed_off(shared, whole: frozenset[int]):
    """Of unseen words and each length: what the tasks' n-grams give, and the other n-grams, to be looked up."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["word", "size", "gram", "times", "sums"]
        for batch in batches:
            words = batch.column(0).cast(pa.string())
            for n in LENGTHS:
                sums, count, owner, hashes = shared.value.of_grams(strings(words), n)
                some = np.flatnonzero(count)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * sums.shape[1]), pa.array(sums[some].ravel()))
                yield pa.RecordBatch.from_arrays(
                    [words.take(pa.array(some)), pa.array(np.full(len(some), n, np.int32)), pa.nulls(len(some), pa.int64()), pa.array(count[some]), lists], names
                )
                if n not in whole and len(owner):
                    yield pa.RecordBatch.from_arrays(
                        [words.take(pa.array(owner)), pa.array(np.full(len(owner), n, np.int32)), pa.array(hashes), pa.array(np.ones(len(owner), np.int64)), pa.nulls(len(owner), pa.list_(pa.float64()))],
                        names,
                    )

    return work


def word_scores(asked: DataFrame, model: Model, shared) -> DataFrame:
    """(word, logs) of distinct words by the whole model, looked up by joins; words of which nothing is known are left out."""
    entries = model.counts.filter("size = 0").select("word", F.array(*model.logs(0)).alias("logs"))
    known = asked.join(entries, "word")
    unseen = asked.join(entries, "word", "left_anti")
    parts = stored(
        unseen.mapInArrow(released(_backed_off(shared, model.frequent.whole)), "word string, size int, gram long, times long, sums array<double>"),
        "unseen-words",
    )
    logs = F.coalesce(*[F.when(F.col("size") == n, F.array(*model.logs(n))) for n in LENGTHS])
    grams = model.counts.filter("size > 0").select("size", "gram", logs.alias("logs"))
    looked_up = parts.filter("gram IS NOT NULL").join(grams, ["size", "gram"])
    scaled = F.transform("logs", lambda x: x * F.col("times")).alias("sums")
    both = parts.filter("gram IS NULL").select("word", "size", "times", "sums").unionByName(looked_up.select("word", "size", "times", scaled))
    columns = range(len(model.languages))
    sizes = both.groupBy("word", "size").agg(F.sum("times").alias("times"), *[F.sum(F.col("sums")[j]).alias(f"s{j}") for j in columns])
    longest = sizes.groupBy("word").agg(F.max(F.struct("size", "times", *[f"s{j}" for j in columns])).alias("m"))
    return known.unionByName(longest.select("word", F.array(*[F.col(f"m.s{j}") / F.col("m.times") for j in columns]).alias("logs")))


def predict(docs: DataFrame, model: Model, text: str = "text", keep=None) -> DataFrame:
    """``row`` (the kept columns), ``lang_pred`` and ``score``; no shuffle unless the model has more than the tasks receive."""
    if not model.languages:
        made = map_texts(docs, lambda: lambda texts: {"n": [0] * len(texts)}, "n int", text, keep)
        return made.select("row", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model.frequent)
    schema = "sums array<double>, n_places long, rest array<struct<word: string, n: int>>"
    found = map_texts(docs, _local(shared), schema, text, keep, arrow=True)
    columns = range(len(model.languages))
    if model.frequent.whole != {0, *LENGTHS}:
        found = stored(found.withColumn("id", F.monotonically_increasing_id()), "language-sums")
        pairs = found.select("id", F.inline("rest"))
        asked = stored(pairs.select("word").distinct(), "asked-words")
        scores = stored(word_scores(asked, model, shared), "word-scores")
        more = pairs.join(scores, "word").groupBy("id")
        more = more.agg(F.array(*[F.sum(F.col("n") * F.col("logs")[j]) for j in columns]).alias("more"))
        sums = F.zip_with("sums", F.coalesce("more", F.array(*[F.lit(0.0)] * len(columns))), lambda a, b: a + b)
        found = found.join(more, "id", "left").withColumn("sums", sums)
    total = F.zip_with("sums", F.array(*map(F.lit, model.prior)), lambda a, b: a + b)
    found = found.select("row", "n_places", total.alias("total")).withColumn("most", F.array_max("total"))
    best = F.element_at(F.array(*map(F.lit, model.languages)), F.array_position("total", F.col("most")).cast("int"))
    share = 1 / F.aggregate("total", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("most")))
    some = F.col("n_places") > 0
    return found.select("row", F.when(some, best).otherwise(UNKNOWN).alias("lang_pred"), F.when(some, share).otherwise(0.0).alias("score"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = predict(docs, fit(docs), keep=["doc_id"])
    return unpacked(found, is_held_out("row.doc_id").alias("held_out"), "lang_pred", "score")

"""LM scoring (operator 4): cross-entropy difference of two matched n-gram models.

A target model (of the documents that a condition names) and a background model (of all documents) have the
same vocabulary, order, smoothing and pruning. Each token's loss under one model less that under the other is averaged over
the document: low scores read like the target. The models are word bigrams, interpolated by Witten-Bell with
unigrams with add-``ALPHA`` smoothing; words outside the vocabulary are one unknown word, and a text starts
after a start mark.

``fit`` and ``score`` are for models that are applied to other documents. The documents that the models were made of are scored by
``lm_corpus``, with the same losses and without stored models.

All words and all pairs of all documents are kept, so both models grow with the corpus and each distribution sums to 1. They
are stored tables, keyed by the words themselves. A document's distinct pairs are joined with the table of pairs; only
the pairs that make up ``HOT_PAIR`` of the background or of the target (so at most 500,000) are sent to the tasks, which
then leave them out of the join. Pairs and words that the models have not seen take further joins, made only if there are any.
``fit`` can be given shares of all tokens below which words and pairs are dropped; none are by default. Pairs dropped
in this way still count in the totals of their first word and are scored by the unigram part.

Cases: null texts and texts without words have no tokens, and losses and score 0. Without target documents both
models are the background. Repeated rows count and are scored each. Ids do not matter to a score, and neither do ties, as nothing is
ranked. Texts of any length are read whole; a text's distinct pairs are one list. An empty table gives no rows. Other columns
are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.common import bounded, distinct_words, documents, named, released, ship, slices, stored, summed, unpacked
from lakestrata.llm.lm_corpus import ALPHA, score_corpus

SLICE = 16 << 20
HOT_PAIR = 4e-6  # share of all tokens from which a pair is sent to the tasks
HOT_WORD = 1e-4  # share of all tokens from which a word's totals are broadcast
BROADCAST_ROWS = 200_000
START, UNKNOWN = "", " "  # no word is empty or a blank
MODELS = ("target", "background")


class Pairs:
    """The pairs of words at each place of some texts: a word and the one before it, or the start mark."""

    def __init__(self, texts: pa.Array):
        words, now, self.bounds = distinct_words(texts)
        self.words = pa.concat_arrays([words.cast(pa.string()), pa.array([START], pa.string())])
        self.size = len(self.words)
        before = np.concatenate([[self.size - 1], now[:-1]])[: len(now)]
        before[self.bounds[:-1][np.diff(self.bounds) > 0]] = self.size - 1
        self.codes = before * self.size + now

    def named(self, codes: np.ndarray) -> tuple[pa.Array, pa.Array]:
        return self.words.take(pa.array(codes // self.size)), self.words.take(pa.array(codes % self.size))


def pair_counts(docs: DataFrame) -> DataFrame:
    """(a, b, n, n_target) over all texts of ``docs`` (text, target): how often word b comes after word a."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, size in slices(batch.column(0), SLICE):
                pairs = Pairs(batch.column(0).slice(lo, size))
                target = batch.column(1).slice(lo, size).to_numpy(zero_copy_only=False).astype(bool)
                which, back = np.unique(pairs.codes, return_inverse=True)
                n = np.bincount(back, minlength=len(which))
                n_target = np.bincount(back[np.repeat(target, np.diff(pairs.bounds))], minlength=len(which))
                for first in range(0, len(which), 1 << 16):
                    cut = slice(first, first + (1 << 16))
                    columns = [*pairs.named(which[cut]), pa.array(n[cut]), pa.array(n_target[cut])]
                    yield pa.RecordBatch.from_arrays(columns, ["a", "b", "n", "n_target"])

    found = docs.select("text", "target").mapInArrow(released(work), "a string, b string, n long, n_target long")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target"))


def looked_up(rows: DataFrame, key: str, other: str, table: DataFrame, hot: Column) -> DataFrame:
    """Left join on a word. Rows of a ``hot`` word are met by broadcast, and are dealt out by their ``other`` word after that."""
    columns = [c for c in table.columns if c != key]
    few = table.filter(hot).select(F.col(key), F.struct(*columns).alias("few"))
    most = table.filter(~hot).select(F.col(key).alias("at"), F.struct(*columns).alias("most"))
    at = F.when(F.col("few").isNull(), F.col(key)).otherwise(F.concat(F.lit(" "), key, F.lit(" "), other))
    met = rows.join(F.broadcast(few), key, "left").withColumn("at", at).join(most, "at", "left")
    return met.select(*rows.columns, F.coalesce("few", "most").alias("met")).select(*rows.columns, "met.*")


@dataclass
class HotPairs:
    """Losses of the most frequent pairs, in order of their code."""

    words: pa.Array
    codes: np.ndarray
    losses: np.ndarray

    def find(self, pairs: Pairs, codes: np.ndarray) -> np.ndarray:
        """The place of each pair of words, or -1."""
        number = pc.fill_null(pc.index_in(pairs.words, self.words), -1).to_numpy().astype(np.int64)
        a, b = number[codes // pairs.size], number[codes % pairs.size]
        code = np.where((a >= 0) & (b >= 0), a * len(self.words) + b, -1)
        if not len(self.codes):
            return np.full(len(codes), -1)
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, at, -1)


def hot_pairs(table: pa.Table) -> HotPairs:
    a, b = (table[c].combine_chunks() for c in "ab")
    words = pc.unique(pa.concat_arrays([pa.array(x, pa.string()) for x in (a, b)]))
    codes = pc.index_in(a, words).to_numpy().astype(np.int64) * len(words) + pc.index_in(b, words).to_numpy()
    losses = np.stack([table[f"{m}_loss"].to_numpy() for m in MODELS], axis=1)
    order = np.argsort(codes)
    return HotPairs(words, codes[order], losses[order])


@dataclass
class Models:
    """Both models as stored tables.

    words: (b, n, n_target) of the vocabulary; contexts: (a, tokens, tokens_target, kinds, kinds_target), what comes after each
    word; pairs: (a, b, target_loss, background_loss). ``totals``: tokens of the background and of the target.
    """

    words: DataFrame
    contexts: DataFrame
    pairs: DataFrame
    hot: HotPairs
    totals: tuple[int, int]
    size: int
    unknown: tuple[int, int]

    def losses(self, rows: DataFrame) -> DataFrame:
        """``rows`` (a, b, n, n_target, the counts of each pair, and more) with both losses of a pair."""
        return _with_losses(rows, self.words, self.contexts, self.totals, self.size, self.unknown)


def _with_losses(
    rows: DataFrame, words: DataFrame, contexts: DataFrame, totals: tuple[int, int], size: int, unknown: tuple[int, int]
) -> DataFrame:
    kept = rows.columns
    singles = words.withColumnsRenamed({"n": "single", "n_target": "single_target"})
    rows = looked_up(rows, "a", "b", contexts, F.col("tokens") >= HOT_WORD * totals[0])
    rows = looked_up(rows, "b", "a", singles, F.col("single") >= HOT_WORD * totals[0])

    def loss(after: str, total: int, rest: int) -> Column:
        tokens, kinds = (F.coalesce(c + after, F.lit(0)) for c in ("tokens", "kinds"))
        single = (F.coalesce("single" + after, F.lit(rest)) + ALPHA) / (total + ALPHA * (size + 1))
        every = F.greatest(tokens + kinds, F.lit(1))
        return -F.log(F.col("n" + after) / every + F.when(tokens > 0, kinds / every).otherwise(1.0) * single)

    background = loss("", totals[0], unknown[0])
    target = loss("_target", totals[1], unknown[1]) if totals[1] else background
    return rows.select(*kept, target.alias("target_loss"), background.alias("background_loss"))


def _in_vocabulary(rows: DataFrame, words: DataFrame, total: int) -> DataFrame:
    """``rows`` with words outside the vocabulary as the unknown word."""
    for key, other in ("ab", "ba"):
        known = words.select(F.col("b").alias(key), "n", F.lit(True).alias("known")).withColumnRenamed("n", "often")
        met = looked_up(rows, key, other, known, F.col("often") >= HOT_WORD * total)
        word = F.when(F.col("known") | (F.col(key) == START), F.col(key)).otherwise(UNKNOWN)
        rows = met.withColumn(key, word).select(*rows.columns)
    return rows


def fit(docs: DataFrame, word_share: float = 0.0, pair_share: float = 0.0) -> Models:
    """Both models from ``docs`` (text, target). One pass over the texts; counts meet by pair, then by word.

    The driver receives totals and the hot pairs. Words and pairs of less than a share of all tokens are dropped.
    """
    ship(docs.sparkSession)
    counts = [F.sum("n").alias("n"), F.sum("n_target").alias("n_target")]
    pairs = stored(pair_counts(docs), "pair-counts")
    words = stored(pairs.groupBy("b").agg(*counts), "word-counts")
    n, n_target, size = words.agg(F.sum("n"), F.sum("n_target"), F.count(F.lit(1))).first()
    n, n_target = n or 0, n_target or 0

    def often(share: float) -> Column:
        return (F.col("n") >= share * n) | (F.lit(n_target > 0) & (F.col("n_target") >= share * n_target))

    unknown = (0, 0)
    if word_share:
        words = stored(words.filter(often(word_share)), "vocabulary")
        *known, size = words.agg(F.sum("n"), F.sum("n_target"), F.count(F.lit(1))).first()
        unknown = (n - (known[0] or 0), n_target - (known[1] or 0))
        pairs = stored(_in_vocabulary(pairs, words, n).groupBy("a", "b").agg(*counts), "pair-counts")
    contexts = pairs.groupBy("a").agg(
        F.sum("n").alias("tokens"), F.sum("n_target").alias("tokens_target"),
        F.count(F.lit(1)).alias("kinds"), F.count_if(F.col("n_target") > 0).alias("kinds_target"),
    )
    contexts = stored(contexts, "contexts")
    kept = pairs.filter(often(pair_share)) if pair_share else pairs
    hot = often(HOT_PAIR) & (F.col("a") != UNKNOWN) & (F.col("b") != UNKNOWN)
    kept = _with_losses(kept, words, contexts, (n, n_target), size, unknown)
    kept = stored(kept.select("a", "b", "target_loss", "background_loss", hot.alias("hot")), "pair-losses")
    sent = hot_pairs(kept.filter("hot").drop("hot").toArrow())
    return Models(words, contexts, kept.drop("hot"), sent, (n, n_target), size, unknown)


def _scorer(shared):
    """Tokens, the sums of the losses of hot pairs, and the other distinct pairs with their counts, of each text."""
    pair = pa.struct([("a", pa.string()), ("b", pa.string()), ("n", pa.int32())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, size in slices(batch.column(1), SLICE >> 2):
                part = batch.slice(lo, size)
                pairs = Pairs(part.column(1))
                which, back = np.unique(pairs.codes, return_inverse=True)
                at = shared.value.find(pairs, which)[back]
                table = np.concatenate([shared.value.losses, np.zeros((1, len(MODELS)))])
                sums = summed(table[at], pairs.bounds)
                owner = np.repeat(np.arange(size), np.diff(pairs.bounds))
                cold = owner[at < 0] * len(which) + back[at < 0]
                cold, n = np.unique(cold, return_counts=True)
                bounds = np.concatenate([[0], np.cumsum(np.bincount(cold // max(len(which), 1), minlength=size))]).astype(np.int32)
                columns = [*pairs.named(which[cold % max(len(which), 1)]), pa.array(n.astype(np.int32))]
                values = pa.StructArray.from_arrays(columns, fields=list(pair))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.diff(pairs.bounds)),
                        *[pa.array(np.ascontiguousarray(sums[:, i])) for i in range(len(MODELS))],
                        pa.ListArray.from_arrays(pa.array(bounds), values),
                    ],
                    ["row", "n_tokens", *MODELS, "cold"],
                )

    return work


def score(docs: DataFrame, models: Models, text: str = "text", keep=None) -> DataFrame:
    """``row`` (the kept columns), ``n_tokens``, the losses per token and ``score``, their difference."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(models.hot)
    kept = [named(c) for c in (docs.columns if keep is None else keep)]
    rows = docs.select(F.struct(*kept).alias("row"), F.col(text).cast("string").alias("text"))
    made = "n_tokens long, target double, background double, cold array<struct<a: string, b: string, n: int>>"
    out = type(rows.schema)([rows.schema["row"], *type(rows.schema).fromDDL(made).fields])
    found = stored(rows.mapInArrow(released(_scorer(shared)), out).withColumn("id", F.monotonically_increasing_id()), "scored")
    cold = found.select("id", F.explode("cold").alias("p")).select("id", "p.a", "p.b", F.col("p.n").alias("times"))
    pairs = models.pairs.withColumn("has", F.lit(True))
    sums = [F.sum(F.col("times") * F.col(f"{m}_loss")).alias(m) for m in MODELS]
    missed = F.count_if(F.col("has").isNull()).alias("missed")
    parts = stored(cold.join(pairs, ["a", "b"], "left").groupBy("id").agg(*sums, missed), "sums")
    if not parts.filter("missed > 0").isEmpty():
        new = cold.join(models.pairs.select("a", "b"), ["a", "b"], "left_anti")
        new = _in_vocabulary(new, models.words, models.totals[0])
        # As a pair with the unknown word it may be known; otherwise it has no count of its own.
        met = new.join(pairs, ["a", "b"], "left")
        rest = models.losses(
            met.filter("has IS NULL").select("id", "a", "b", "times", F.lit(0).alias("n"), F.lit(0).alias("n_target"))
        )
        columns = ["id", "times", *(f"{m}_loss" for m in MODELS)]
        both = met.filter("has").select(*columns).unionByName(rest.select(*columns))
        parts = parts.drop("missed").unionByName(both.groupBy("id").agg(*sums))
        parts = parts.groupBy("id").agg(*(F.sum(m).alias(m) for m in MODELS))
    more = parts.select("id", *(F.col(m).alias(f"{m}_cold") for m in MODELS))
    losses = [
        ((F.col(m) + F.coalesce(f"{m}_cold", F.lit(0.0))) / F.greatest("n_tokens", F.lit(1))).alias(f"{m}_loss") for m in MODELS
    ]
    result = found.drop("cold").join(more, "id", "left").select("row", "n_tokens", *losses)
    return result.withColumn("score", F.col("target_loss") - F.col("background_loss"))


def with_target(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` as (doc_id, text, target): whether the id is among ``ids``. Broadcast only if a count shows that they are few."""
    ids = stored(ids.select("doc_id").distinct().withColumn("target", F.lit(True)), "target-ids")
    joined = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(bounded(ids, BROADCAST_ROWS), "doc_id", "left")
    return joined.select("doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled as of good quality and not toxic. Background: all documents."""
    docs = documents(spark, sf_dir)
    good = documents(spark, sf_dir, "labels").filter("quality = 1 AND toxic = 0")
    found = score_corpus(with_target(docs, good), keep=["doc_id"])
    return unpacked(found, "n_tokens", "target_loss", "background_loss", "score")

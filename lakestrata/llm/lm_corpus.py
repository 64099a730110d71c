"""LM scoring (operator 4) of a corpus by the models of that corpus itself, without storing the models.

The models and losses are those of ``lm_score``, with all words and pairs kept. Texts are cut into slices; words are local numbers
inside a slice, and 64-bit hashes between slices. Each slice sends every bucket of words one row: its words of the bucket with their
counts, and its distinct pairs whose first word is there with theirs. A bucket adds up the counts of all slices and sends each slice
what it asked about, in the order in which it asked; the slice then has all counts that its losses need. So a pair goes through one
shuffle as the hash of its second word, and back through one as its counts. Words of ``HOT_WORD`` of all tokens (at most 1,000) and
the start mark have their pairs in the buckets of the second words instead, so no bucket holds all that comes after a frequent word.
Buckets are made for ``BUCKET_TOKENS`` tokens each, so their number grows with the corpus and a task's memory does not.

Words are told apart by 64 bits of hash: of n different words, two are taken for one with a probability of n * n / 4e19.

Cases are those of ``lm_score``. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.llm.common import arrow_type, distinct_words, give_back, named, released, ship, slices, stored, summed
from lakestrata.llm.words import Words

ALPHA = 0.1
SLICE = 8 << 20
HOT_WORD = 1e-3
BUCKET_TOKENS = 2_000_000
LEAST_BUCKETS = 12
NO_SLICE = -1  # the row in which a bucket tells its number of words, and of words after each hot one


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of 64-bit numbers as compressed bytes: all first bytes, then all second bytes, and so on."""
    joined = np.concatenate([np.asarray(x, np.int64) for x in arrays])
    sizes = np.array([len(x) for x in arrays], np.uint32).tobytes()
    return sizes + pa.Codec("zstd").compress(joined.view(np.uint8).reshape(-1, 8).T.tobytes(), asbytes=True)


def unpack(data: bytes, n: int) -> list[np.ndarray]:
    sizes = np.frombuffer(data, np.uint32, n).astype(np.int64)
    raw = pa.Codec("zstd").decompress(data[4 * n :], decompressed_size=8 * int(sizes.sum()), asbytes=True)
    joined = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.int64).ravel()
    return np.split(joined, np.cumsum(sizes)[:-1])


def _hashes(words: pa.Array) -> np.ndarray:
    return Words(words.cast(pa.binary()).to_pylist()).hashes().view(np.int64)


def _spread(target: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.repeat(target.astype(bool), sizes)


def _cut(kind: pa.DataType):
    """Texts to slices: the kept columns, tokens by text, and all tokens as numbers of the slice's words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, size in slices(batch.column(1), SLICE):
                part = batch.slice(lo, size)
                words, codes, bounds = distinct_words(part.column(1))
                sizes = np.diff(bounds)
                target = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
                hashes = _hashes(words)
                n = np.bincount(codes, minlength=len(hashes))
                often = np.flatnonzero(n >= HOT_WORD * max(len(codes), 1))
                hot = [{"hash": int(hashes[w]), "n": int(n[w])} for w in often]
                columns = {
                    "rows": pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), part.column(0)),
                    "texts": pa.array([pack(sizes, target)], pa.binary()),
                    "words": pa.array([pack(hashes)], pa.binary()),
                    "tokens": pa.array([pack(codes)], pa.binary()),
                    "totals": pa.array([[len(codes), int(sizes[target].sum()), int((sizes > 0).sum()), int((sizes[target] > 0).sum())]]),
                    "hot": pa.array([hot], kind),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return work


class Slice:
    """What a slice asks of each bucket, in the same order whenever it is made of the slice."""

    def __init__(self, texts: bytes, words: bytes, tokens: bytes, hot: np.ndarray, buckets: int):
        self.sizes, self.target = unpack(texts, 2)
        (hashes,) = unpack(words, 1)
        (codes,) = unpack(tokens, 1)
        order = np.argsort(hashes.view(np.uint64))
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        self.hashes, self.now = hashes[order], rank[codes]
        self.size = size = len(hashes) + 1  # the last one is the start mark
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)])
        filled = self.sizes > 0
        self.ends = self.bounds[1:][filled] - 1
        before = np.concatenate([[size - 1], self.now[:-1]])[: len(self.now)]
        before[self.bounds[:-1][filled]] = size - 1
        self.places = before * size + self.now
        self.pairs, self.n = np.unique(self.places, return_counts=True)
        self.a, self.b = self.pairs // size, self.pairs % size
        # The number of a hot word; the start mark comes after them. -1: not hot.
        at = np.minimum(np.searchsorted(hot, self.hashes), max(len(hot) - 1, 0))
        found = hot[at] == self.hashes if len(hot) else np.zeros(len(self.hashes), bool)
        self.hot = np.append(np.where(found, at, -1), len(hot))
        self.in_bucket = ((self.hashes.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        is_hot = self.hot[self.a] >= 0
        home = self.in_bucket[np.where(is_hot, self.b, self.a)] if len(self.a) else self.a
        # By bucket: pairs after other words by these, then those after hot words.
        order = np.argsort(2 * home + is_hot, kind="stable")
        edges = np.searchsorted((2 * home + is_hot)[order], np.arange(2 * buckets + 1))
        self.word_edges = np.searchsorted(self.in_bucket, np.arange(buckets + 1))
        self.parts = [
            (order[edges[2 * i] : edges[2 * i + 1]], order[edges[2 * i + 1] : edges[2 * i + 2]]) for i in range(buckets)
        ]

    def words_of(self, bucket: int) -> slice:
        return slice(self.word_edges[bucket], self.word_edges[bucket + 1])

    def questions(self) -> Iterator[tuple[int, bytes]]:
        here = _spread(self.target, self.sizes)
        n, n_target = (np.bincount(x, minlength=self.size - 1) for x in (self.now, self.now[here]))
        ends, ends_target = (np.bincount(self.now[x], minlength=self.size - 1) for x in (self.ends, self.ends[here[self.ends]]))
        of_target = np.zeros(len(self.pairs), np.int64)
        which, times = np.unique(self.places[here], return_counts=True)
        of_target[np.searchsorted(self.pairs, which)] = times
        for i, (cold, hot) in enumerate(self.parts):
            w = self.words_of(i)
            if w.start < w.stop:
                after = np.bincount(self.a[cold] - w.start, minlength=w.stop - w.start)
                yield i, pack(
                    self.hashes[w], n[w], n_target[w], ends[w], ends_target[w],
                    after, self.hashes[self.b[cold]], self.n[cold], of_target[cold],
                    self.hot[self.a[hot]], self.b[hot] - w.start, self.n[hot], of_target[hot],
                )


QUESTION, ANSWER, TOTALS = 13, 10, 3


def _total(groups: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(groups, values, size).astype(np.int64)  # exact up to 2 ** 53


def _answered(hot_words: int):
    """A bucket's rows of all slices to the answers to each slice."""

    def work(table: pa.Table) -> pa.Table:
        asked = [unpack(q, QUESTION) for q in table["data"].to_pylist()]
        column = [np.concatenate(x) for x in zip(*asked)]
        hashes, n, n_target, ends, ends_target, after, second, times, times_target, hot, b, hot_times, hot_times_target = column
        known, word = np.unique(hashes, return_inverse=True)
        size = len(known)
        words = [_total(word, x, size) for x in (n, n_target, ends, ends_target)]

        a = np.repeat(word, after)
        order = np.lexsort((second, a))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(a[order]) != 0) | (np.diff(second[order]) != 0)
        pair = np.empty(len(order), np.int64)
        pair[order] = np.cumsum(new) - 1
        first = a[order[new]]
        pairs = [_total(pair, x, len(first)) for x in (times, times_target)]
        words += [np.bincount(first, minlength=size), np.bincount(first[pairs[1] > 0], minlength=size)]

        offsets = np.cumsum([0, *(len(q[0]) for q in asked)])
        at = np.repeat(offsets[:-1], [len(q[9]) for q in asked]) + b
        which, hot_pair = np.unique(hot * size + word[at], return_inverse=True)
        hot_pairs = [_total(hot_pair, x, len(which)) for x in (hot_times, hot_times_target)]
        kinds = [np.bincount(x // size, minlength=hot_words) for x in (which, which[hot_pairs[1] > 0])]

        cuts = [np.cumsum([0, *(len(q[i]) for q in asked)]) for i in (0, 6, 9)]
        data = []
        for i in range(len(asked)):
            w, p, h = (x[c[i] : c[i + 1]] for x, c in zip((word, pair, hot_pair), cuts))
            data.append(pack(*(x[w] for x in words), *(x[p] for x in pairs), *(x[h] for x in hot_pairs)))
        bucket = table["bucket"][0].as_py()
        give_back()
        return pa.table(
            {
                "slice": pa.array([*table["slice"].to_pylist(), NO_SLICE], pa.int64()),
                "bucket": pa.array([bucket] * (len(data) + 1), pa.int32()),
                "data": pa.array([*data, pack([size], *kinds)], pa.binary()),
            }
        )

    return work


def _scored(hot: np.ndarray, buckets: int, totals: list[int], vocabulary: int, kinds: np.ndarray):
    """A slice and the answers of all buckets to the losses of its texts."""

    def work(cut: pa.Table, answers: pa.Table) -> pa.Table:
        results = []
        by_bucket = dict(zip(answers["bucket"].to_pylist(), answers["data"].to_pylist()))
        for rows, *made in zip(cut["rows"].combine_chunks(), *(cut[c].to_pylist() for c in ("texts", "words", "tokens"))):
            part = Slice(*made, hot, buckets)
            words = np.zeros((6, part.size), np.int64)
            counts = np.zeros((2, len(part.pairs)), np.int64)
            for i, (cold, often) in enumerate(part.parts):
                w = part.words_of(i)
                if w.start < w.stop:
                    answer = unpack(by_bucket[i], ANSWER)
                    words[:, w], counts[:, cold], counts[:, often] = answer[:6], answer[6:8], answer[8:]
            singles, tokens, after = words[:2], words[:2] - words[2:4], words[4:]
            tokens[:, -1] = totals[2:]
            frequent = part.hot >= 0
            after[:, frequent] = kinds[:, part.hot[frequent]]

            def losses(m: int) -> np.ndarray:
                single = (singles[m][part.b] + ALPHA) / (totals[m] + ALPHA * (vocabulary + 1))
                n, k = tokens[m][part.a], after[m][part.a]
                every = np.maximum(n + k, 1)
                return -np.log(counts[m] / every + np.where(n > 0, k / every, 1.0) * single)

            background = losses(0)
            both = np.stack([losses(1) if totals[1] else background, background], axis=1)
            sums = summed(both[np.searchsorted(part.pairs, part.places)], part.bounds) / np.maximum(part.sizes, 1)[:, None]
            columns = [pa.array(part.sizes), *(pa.array(np.ascontiguousarray(sums[:, i])) for i in range(2))]
            results.append(pa.table([rows.values, *columns], ["row", "n_tokens", "target_loss", "background_loss"]))
        give_back()
        return pa.concat_tables(results)

    return work


_SLICES = "texts binary, words binary, tokens binary, totals array<bigint>, hot array<struct<hash: bigint, n: bigint>>"
_LOSSES = "n_tokens long, target_loss double, background_loss double"


def _questions(hot: np.ndarray, buckets: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, *made in zip(*(batch.column(i).to_pylist() for i in range(4))):
                for bucket, data in Slice(*made, hot, buckets).questions():
                    columns = [pa.array([number], pa.int64()), pa.array([bucket], pa.int32()), pa.array([data], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["slice", "bucket", "data"])

    return work


def score_corpus(docs: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """``row`` (the kept columns), ``n_tokens``, the losses per token and ``score`` of ``docs`` (text, target, and more): what
    ``lm_score.score(docs, lm_score.fit(docs))`` gives.

    The driver receives totals and, for each hot word, a few numbers.
    """
    ship(docs.sparkSession)
    kept = [named(c) for c in (docs.columns if keep is None else keep)]
    texts = docs.select(F.struct(*kept).alias("row"), F.col("text").cast("string").alias("text"), "target")
    cut = T.StructType([T.StructField("rows", T.ArrayType(texts.schema["row"].dataType)), *T.StructType.fromDDL(_SLICES).fields])
    made = texts.mapInArrow(released(_cut(arrow_type(cut["hot"].dataType))), cut)
    made = stored(made.withColumn("slice", F.monotonically_increasing_id()), "lm-slices")
    totals = [x or 0 for x in made.agg(*(F.sum(F.col("totals")[i]) for i in range(4))).first()]
    often = made.select(F.inline("hot")).groupBy("hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= HOT_WORD * totals[0])
    hot = np.sort(np.array([r["hash"] for r in often.select("hash").collect()], np.int64))
    buckets = max(LEAST_BUCKETS, -(-totals[0] // BUCKET_TOKENS))

    parts = made.select("slice", "texts", "words", "tokens")
    asked = parts.mapInArrow(released(_questions(hot, buckets)), "slice long, bucket int, data binary")
    answers = asked.groupBy("bucket").applyInArrow(_answered(len(hot) + 1), "slice long, bucket int, data binary")
    answers = stored(answers, "lm-answers")
    vocabulary, kinds = 0, np.zeros((2, len(hot) + 1), np.int64)
    for r in answers.filter(F.col("slice") == NO_SLICE).select("data").toLocalIterator():
        size, *found = unpack(r["data"], TOTALS)
        vocabulary, kinds = vocabulary + int(size[0]), kinds + np.stack(found)

    left = made.select("slice", "rows", "texts", "words", "tokens").groupBy("slice")
    right = answers.filter(F.col("slice") != NO_SLICE).groupBy("slice")
    row = made.schema["rows"].dataType.elementType  # as it was read again: any field may be null
    out = T.StructType([T.StructField("row", row), *T.StructType.fromDDL(_LOSSES).fields])
    result = left.cogroup(right).applyInArrow(_scored(hot, buckets, totals, vocabulary, kinds), out)
    return result.withColumn("score", F.col("target_loss") - F.col("background_loss"))

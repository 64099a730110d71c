"""Quality classifier (operator 8): a factorisation machine over words, structure and metadata of a text.

Features are hashed words (square root of their count, scaled to length one), the bin of each structure statistic
and the bins of the text's size in bytes and characters a byte. A score is the logistic of a bias, a weight for each feature
and, for each pair of features, the product of their low-rank vectors; the sum over all pairs is computed in linear time
as half of (the square of the sum minus the sum of squares) for each factor.

It is fitted by Adagrad in one task, on at most ``SAMPLE`` labelled documents, a documented bound; scoring covers
every document without a shuffle. Labels, language, source and id are never inputs.

Cases: null and empty texts are scored by their structure (all zero). Without labels of both kinds the score is 0.5.
Repeated rows are scored alike, and as one document when they are learned from. Of labelled documents with equal hashes of
the id the smaller id is taken first. Texts of any length are scored whole. An empty table gives no rows. Other columns are
carried along, whatever their names.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.common import (
    as_bytes, documents, is_held_out, labelled_sample, map_texts, released, ship, slices, unpacked,
)
from lakestrata.llm.quality_rules import _statistics
from lakestrata.llm.words import Words

SAMPLE = 8_000  # labelled documents that the model is fitted on, at most
BUCKETS, FACTORS, BINS = 1 << 14, 8, 12
THRESHOLD = 0.7


def structure(texts: list[bytes | None]) -> np.ndarray:
    """The structure statistics and sizes of each text, a row for each text."""
    s = {k: np.asarray(v, float) for k, v in _statistics()(texts).items()}
    words, size, lines = np.maximum(s["n_words"], 1), np.maximum(s["n_bytes"], 1), np.maximum(s["n_lines"], 1)
    columns = [
        s["n_symbols"] / words, s["n_repeat_words"] / words, s["n_distinct"] / words, s["n_marks"] / words,
        s["word_chars"] / words, s["n_upper"] / size, s["n_digits"] / size, s["n_dup_lines"] / lines,
        words / lines, np.log1p(s["n_words"]), np.log1p(s["n_bytes"]), s["word_chars"] / size,
    ]
    return np.stack(columns, 1)


def word_features(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, value) of the hashed words, in order of text."""
    words = Words([t and t.lower() for t in texts])
    bucket = (words.hashes() >> np.uint64(40)).astype(np.int64) % BUCKETS
    pairs, counts = np.unique(words.owner * BUCKETS + bucket, return_counts=True)
    owner = pairs // BUCKETS
    length = np.bincount(owner, counts, len(texts))
    return owner, pairs % BUCKETS, np.sqrt(counts / length[owner])


class Machine:
    """Weights, factors and the bins of the structure columns."""

    def __init__(self, cuts: np.ndarray, seed: int = 11):
        self.cuts = cuts
        size = BUCKETS + cuts.shape[0] * (cuts.shape[1] + 1)
        random = np.random.default_rng(seed)
        self.bias, self.w = 0.0, np.zeros(size)
        self.v = random.normal(0, 0.02, (size, FACTORS))

    def features(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bounds of each text's features, feature, value)."""
        owner, at, value = word_features(texts)
        s = structure(texts)
        n, k = s.shape
        bins = np.stack([np.searchsorted(self.cuts[j], s[:, j], "right") for j in range(k)], 1)
        place = BUCKETS + np.arange(k) * (self.cuts.shape[1] + 1) + bins
        owner = np.concatenate([owner, np.repeat(np.arange(n), k)])
        order = np.argsort(owner, kind="stable")
        at = np.concatenate([at, place.ravel()])[order]
        value = np.concatenate([value, np.full(n * k, k**-0.5)])[order]
        return np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]), at, value

    def margins(self, bounds: np.ndarray, at: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The margin of each text and the sums of its features' vectors."""
        xv = self.v[at] * value[:, None]
        starts = bounds[:-1]
        sums = np.add.reduceat(xv, starts)
        squares = np.add.reduceat((xv * xv).sum(axis=1), starts)
        linear = np.add.reduceat(self.w[at] * value, starts)
        return self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def fit(self, bounds, at, value, labels, epochs: int = 8, batch: int = 128, rate: float = 0.1, decay: float = 1e-5):
        random = np.random.default_rng(5)
        gw, gv, gb = np.full(len(self.w), 1e-6), np.full(self.v.shape, 1e-6), 1e-6
        for _ in range(epochs):
            order = random.permutation(len(labels))
            for lo in range(0, len(order), batch):
                rows = order[lo : lo + batch]
                sizes = bounds[rows + 1] - bounds[rows]
                ends = np.cumsum(sizes)
                take = np.repeat(bounds[rows] - (ends - sizes), sizes) + np.arange(ends[-1])
                a, x = at[take], value[take]
                margin, sums = self.margins(np.concatenate([[0], ends]), a, x)
                error = (1 / (1 + np.exp(-margin)) - labels[rows]) / len(rows)
                gb += float(error.sum()) ** 2
                self.bias -= rate * float(error.sum()) / gb**0.5
                e = np.repeat(error, sizes)
                which, back = np.unique(a, return_inverse=True)
                dw = np.bincount(back, e * x, len(which)) + decay * self.w[which]
                dense = e[:, None] * (x[:, None] * np.repeat(sums, sizes, axis=0) - self.v[a] * (x * x)[:, None])
                dv = np.stack([np.bincount(back, dense[:, f], len(which)) for f in range(FACTORS)], 1) + decay * self.v[which]
                gw[which] += dw * dw
                gv[which] += dv * dv
                self.w[which] -= rate * dw / np.sqrt(gw[which])
                self.v[which] -= rate * dv / np.sqrt(gv[which])
        return self

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        margin, _ = self.margins(*self.features(texts))
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine | None:
    """The machine fitted in one task on at most ``sample`` labelled documents; None without both labels."""
    ship(docs.sparkSession)
    # Whole rows in one order, so that the fit does not depend on the order of the input.
    chosen = labelled_sample(docs, labels, "quality", sample).repartition(1).sortWithinPartitions(F.xxhash64("doc_id", "text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels_, words, stats = [], [], []
        for batch in batches:
            for lo, n in slices(batch.column(0)):
                texts = as_bytes(batch.column(0).slice(lo, n))
                owner, at, value = word_features(texts)
                words.append((owner + len(labels_), at.astype(np.int32), value.astype(np.float32)))
                stats.append(structure(texts))
                labels_ += batch.column(1).slice(lo, n).to_pylist()
        if len(set(labels_)) < 2:
            return
        s = np.concatenate(stats)
        cuts = np.quantile(s, np.arange(1, BINS) / BINS, axis=0).T
        machine = Machine(cuts)
        k, n = s.shape[1], len(s)
        bins = np.stack([np.searchsorted(cuts[j], s[:, j], "right") for j in range(k)], 1)
        place = BUCKETS + np.arange(k) * (cuts.shape[1] + 1) + bins
        owner = np.concatenate([*(w[0] for w in words), np.repeat(np.arange(n), k)])
        order = np.argsort(owner, kind="stable")
        at = np.concatenate([*(w[1] for w in words), place.ravel()])[order]
        value = np.concatenate([*(w[2] for w in words), np.full(n * k, k**-0.5, np.float32)])[order]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
        machine.fit(bounds, at, value, np.array(labels_, float))
        machine.w, machine.v = machine.w.astype(np.float32), machine.v.astype(np.float32)
        state = pickle.dumps((machine.cuts, machine.bias, machine.w, machine.v))
        yield pa.RecordBatch.from_arrays([pa.array([state], pa.binary())], ["model"])

    row = chosen.select("text", "label").mapInArrow(released(work), "model binary").first()
    if row is None:
        return None
    cuts, bias, w, v = pickle.loads(bytes(row["model"]))
    machine = Machine(cuts)
    machine.bias, machine.w, machine.v = bias, w, v
    return machine


def score(docs: DataFrame, machine: Machine | None, text: str = "text", keep=None) -> DataFrame:
    """``row`` (the kept columns) and ``score``, the probability of label 1; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def make():
        m = shared.value
        return lambda texts: {"score": np.full(len(texts), 0.5) if m is None else m.scores(texts)}

    return map_texts(docs, make, "score double", text, keep)


def op8_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = score(docs, fit(docs, documents(spark, sf_dir, "labels")), keep=["doc_id"])
    return unpacked(
        found, is_held_out("row.doc_id").alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted")
    )

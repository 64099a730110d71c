"""Helpers that the operators of this folder share: texts in slices, row keys, stored intermediate tables.

All operators take a table with a document id and a text. The id may be null or repeated and the text may be
null, empty or very long; other columns may have any name, dots and backticks included: operators take columns by
their quoted names and put those they only carry into one struct.
"""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.session import scratch_path

# Texts are worked on in slices of about this size, so that a task's memory does not follow the batch size.
SLICE_BYTES = 1 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the Python workers import this package, as ``--py-files`` does, where nothing else provides it."""
    root = Path(__file__).resolve().parents[2]
    app = spark.sparkContext.applicationId
    if app in _shipped or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or not root.is_dir():
        return
    package = __name__.split(".")[0]
    folder = tempfile.mkdtemp(prefix=f"{package}-")  # the driver's own; executors fetch the archive from the driver
    atexit.register(shutil.rmtree, folder, True)
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{package}", "zip", root, package))
    _shipped.add(app)


def named(column: str) -> Column:
    """A top-level column, whatever characters its name has."""
    return F.col(f"`{column.replace('`', '``')}`")


def released(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``work`` for mapInArrow that gives the memory of its task back to the system when the task ends.

    Python workers are kept for later tasks; without this each of them holds the most that any task has needed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here, and any executor can be lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, rows) of runs with at most max_bytes of text; a longer text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, first, n = np.cumsum(sizes), 0, len(sizes)
    while first < n:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + max_bytes, "right")))
        yield first, last - first
        first = last


def valid(column: pa.Array) -> pa.Array:
    """The texts with null as empty; bytes that are not UTF-8 become replacement characters."""
    try:
        column.validate(full=True)
    except pa.ArrowInvalid:
        column = pa.array([None if t is None else t.decode("utf-8", "replace") for t in as_bytes(column)], pa.string())
    return pc.fill_null(column, "")


def strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def map_texts(
    docs: DataFrame,
    make: Callable[[], Callable[[list[bytes | None]], dict]],
    schema: str,
    text: str | Column = "text",
    keep: Sequence[str] | None = None,
    arrow: bool = False,
) -> DataFrame:
    """One row out for each row in: ``row``, a struct of the kept columns, and the fields of ``schema``.

    ``make`` runs once in each task and returns the function that turns the texts of a slice (UTF-8, or
    None; as an Arrow array with ``arrow``, which takes larger slices) into one list or array per field. No shuffle.
    """
    ship(docs.sparkSession)
    found = T.StructType.fromDDL(schema)
    kept = [named(c) for c in (docs.columns if keep is None else keep)]
    column = named(text) if isinstance(text, str) else text
    rows = docs.select(F.struct(*kept).alias("row"), column.cast("string").alias("text"))
    out = T.StructType([rows.schema["row"], *found.fields])
    kinds = [(f.name, arrow_type(f.dataType)) for f in found.fields]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for first, n in slices(batch.column(1), SLICE_BYTES * (4 if arrow else 1)):
                part = batch.slice(first, n)
                values = fn(part.column(1) if arrow else as_bytes(part.column(1)))
                arrays = [v if isinstance(v := values[name], pa.Array) else pa.array(v, kind) for name, kind in kinds]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], ["row", *(name for name, _ in kinds)])

    return rows.mapInArrow(released(work), out)


def unpacked(df: DataFrame, *more: str | Column) -> DataFrame:
    """The kept columns of ``map_texts`` beside further ones."""
    return df.select("row.*", *more)


def in_training_fold(doc_id: str | Column = "doc_id") -> Column:
    """Rows a model may learn from: crc32 of the id as text, modulo 4, is not 2. A null id is not learned from."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def is_held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """At most ``limit`` labelled training documents: those with the smallest hash of the id, then of the text.

    Only ids and hashes go through the choice: one pass over the labels and one over the texts. Equal rows are one document, and
    the limit holds for documents when ids are repeated. A document that has several
    labels takes the largest; labels other than 0 and 1 are ignored.
    """
    marked = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label"))
    marked = marked.filter(F.col("label").isin(0, 1) & in_training_fold())
    few = marked.groupBy("doc_id").agg(F.max("label").alias("label"))
    few = few.filter(in_share(F.xxhash64("doc_id"), 4 * limit, few.count()))
    ids = few.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    texts = texts.withColumn("f", F.xxhash64("text"))
    keys = texts.select("doc_id", "f").join(ids, "doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "f").limit(limit)
    chosen = texts.join(keys, ["doc_id", "f"]).groupBy("doc_id", "f", "label").agg(F.min("text").alias("text"))
    return chosen.select("doc_id", "text", "label")


def in_share(key: Column, wanted: int, rows: int) -> Column:
    """Whether a row's 64-bit hash is among the smallest of which about ``wanted`` of so many rows have one.

    Put before an order with a limit, it keeps what the tasks send for the last choice independent of their number.
    """
    if wanted >= rows:
        return F.lit(True)
    return key < F.lit(-(1 << 63) + (wanted * (1 << 64)) // rows)


class Recent(dict):
    """A bounded cache of two generations: when the younger one is full it becomes the older one, which is dropped.

    What is in use moves back to the younger one, so frequent keys stay.
    """

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.older = limit, {}

    def absent(self, keys: set) -> set:
        """The keys of a batch that must be learned; all others are in the younger generation afterwards."""
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()
        new = keys.difference(self)
        for key in new.intersection(self.older):
            self[key] = self.older[key]
        return new.difference(self.older)


def distinct_words(column: pa.Array, pattern: str | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, number of the word at each place, bounds of each text's places) of lower-cased texts.

    Words are runs without ASCII white space, or what lies between matches of ``pattern``.
    """
    lower = pc.utf8_lower(valid(column))
    split = pc.split_pattern_regex(lower, pattern) if pattern else pc.ascii_split_whitespace(lower)
    bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
    flat = split.flatten()
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)  # a text that begins or ends with white space
    if not full.all():
        bounds = np.concatenate([[0], np.cumsum(full)])[bounds]
        flat = flat.filter(pa.array(full))
    coded = flat.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), bounds.astype(np.int64)


def summed(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the values between neighbouring bounds."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """The (stored) table, marked for broadcast if a count shows no more than ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df

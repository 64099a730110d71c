"""Centroid clustering over a VA-file: compressed vectors decide most assignments, full vectors are fetched for the rest.

Each component becomes a whole number, and each of those a cell of one byte: a quarter of a vector of floats. The edges of
a component's cells lie evenly within a few standard deviations of its mean; the outer cells reach to its least and largest value,
so that every cell is an exact interval. From them a task makes lookup tables, for each component, cell and centroid the least and
largest part of the squared distance. The part that all centroids share, the vector's own length and its product with
the mean centroid, is left out, which narrows the intervals. A vector whose least interval overlaps no other one is
assigned by its cells alone. Only vectors with overlapping intervals, and those that change their centroid and so
its sum, are fetched and compared exactly. All arithmetic is in whole numbers, so results do not depend on the order of work.

Full vectors are stored once, in buckets by a row number, and never shuffled again: what is fetched meets them there.
Assignments are stored after each round, in tables of one byte a component. Sums come from the differences
of a round and are added up in each task first. The driver receives centroids and sums alone: ``k`` times the number of
components. No key is shared by many rows, so equal vectors and repeated ids are spread like any others.

Results: vectors that are null, of another length, or with a null, NaN or infinite component are left out. With fewer vectors
than ``k`` there are that many centroids; an empty table gives no rows. Equal distances go to the smaller number. Among
equal hashes (repeated or null ids, a null id counting as no digits) the smaller vector comes first. Every row has a row
of its own in the result. Scaled components beyond 2^27 count as 2^27, so that distances fit a long; a sum of distances
that does not fit is null. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.common import documents, ship, stored
from lakestrata.session import scratch_path

CENTROIDS, ROUNDS, DIMENSIONS, SCALE, SEED = 40, 5, 64, 256, "2"
CELLS = 256
SPREAD = 4.0  # standard deviations on both sides of the mean that the cells divide evenly
LARGEST = 1 << 27
_ROWS = 4096  # vectors that a task compares at once


def whole_vectors(vectors: DataFrame, id: str, vector: str, dimensions: int, scale: float) -> DataFrame:
    """``id, vec``: the vectors that count, in whole numbers."""
    quoted = [F.col(f"`{c.replace('`', '``')}`") for c in (id, vector)]
    values = F.transform(quoted[1], lambda x: x.cast("double"))
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    bounded = lambda x: F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), x * float(scale)))
    whole = F.transform(values, lambda x: F.floor(bounded(x)).cast("int"))
    return vectors.filter((F.size(quoted[1]) == dimensions) & finite).select(quoted[0].alias("id"), whole.alias("vec"))


def in_buckets(df: DataFrame, label: str) -> DataFrame:
    """Store a table in buckets by ``key``, sorted by it: joins on it need no shuffle of this side."""
    spark, n = df.sparkSession, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    path, name = scratch_path(spark, label), f"{label}_{uuid.uuid4().hex}"
    writer = df.repartition(n, "key").write.bucketBy(n, "key").sortBy("key")
    writer.option("path", path).saveAsTable(name)
    return spark.table(name)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of arrays or of bytes, all of one width, with a row for each."""
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
        if not len(column):
            return np.zeros((0, width), np.uint8)
        ends = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]
        return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(-1, width)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, _ROWS):
            yield batch.slice(first, _ROWS)


class Cells:
    """The cells of every component: inner edges, least and largest values."""

    def __init__(self, n: np.ndarray, total: np.ndarray, squares: np.ndarray, least: np.ndarray, most: np.ndarray):
        mean = total / n
        spread = np.sqrt(np.maximum(squares / n - mean**2, 0.0))
        steps = np.linspace(-SPREAD, SPREAD, CELLS + 1)[1:-1]
        self.inner = np.floor(mean[:, None] + spread[:, None] * steps).astype(np.int64)
        self.least = np.concatenate([least[:, None], self.inner], 1)
        self.most = np.concatenate([self.inner - 1, most[:, None]], 1)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        out = np.empty(vectors.shape, np.uint8)
        for d, inner in enumerate(self.inner):
            out[:, d] = np.searchsorted(inner, vectors[:, d], "right")
        return out

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By component and cell, the bounds of each centroid's part of the distance."""
        shift = centroids - np.round(centroids.mean(0)).astype(np.int64)
        a = -2 * self.least[:, :, None] * shift.T[:, None, :]
        b = -2 * self.most[:, :, None] * shift.T[:, None, :]
        low, high = np.minimum(a, b), np.maximum(a, b)
        own = (centroids * centroids).sum(1)
        low[0] += own
        high[0] += own
        return low, high


def exact(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, a row for each vector."""
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for k, c in enumerate(centroids):
        gap = vectors - c
        out[:, k] = np.einsum("ij,ij->i", gap, gap)
    return out


def _each(fn, name: str, dimensions: int):
    """An aggregate of arrays, place by place."""
    return F.array(*[fn(F.col(name)[d]) for d in range(dimensions)]).alias(name)


def _cells(vectors: DataFrame, dimensions: int) -> Cells:
    """The spread of each component, added up in each task first."""

    def partial(batches):
        n, total, squares = 0, np.zeros(dimensions), np.zeros(dimensions)
        least, most = np.full(dimensions, LARGEST), np.full(dimensions, -LARGEST)
        for batch in _slices(batches):
            v = _matrix(batch.column(0), dimensions)
            n, total, squares = n + len(v), total + v.sum(0), squares + (v.astype(float) ** 2).sum(0)
            least, most = np.minimum(least, v.min(0)), np.maximum(most, v.max(0))
        if n:
            arrays = [pa.array([n])] + [pa.array([list(c)]) for c in (total, squares, least, most)]
            yield pa.RecordBatch.from_arrays(arrays, ["n", "total", "squares", "least", "most"])

    names = "n long, total array<double>, squares array<double>, least array<long>, most array<long>"
    parts = vectors.select("vec").mapInArrow(partial, names)
    by = {"total": F.sum, "squares": F.sum, "least": F.min, "most": F.max}
    row = parts.agg(F.sum("n").alias("n"), *[_each(fn, name, dimensions) for name, fn in by.items()]).first()
    return Cells(np.array(row["n"]), *[np.array(row[name]) for name in by])


def _first_centroids(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The vectors with the smallest hashes of their ids, in order.

    A bound from the row count keeps all but a few vectors out of the sort; if it lets too few through it is dropped.
    """
    hashed = vectors.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256).alias("h"), "vec")
    share = (8 * k + 64) / max(1, vectors.count())
    bound = "g" if share >= 1 else f"{int(share * 16**12):012x}"
    for most in (bound, "g"):
        rows = hashed.filter(F.col("h") < most).orderBy("h", "vec").limit(k).collect()
        if len(rows) == k:
            break
    return np.array([r["vec"] for r in rows], np.int64)


def _located(state: DataFrame, cells: Cells, centroids: np.ndarray, dimensions: int) -> DataFrame:
    """``key, code, old, cluster`` by the lookup tables; cluster is -1 where intervals overlap."""

    def locate(batches):
        low, high = cells.tables(centroids)
        for batch in _slices(batches):
            code = _matrix(batch.column(1), dimensions)
            least, most = low[0][code[:, 0]], high[0][code[:, 0]]
            for d in range(1, dimensions):
                least += low[d][code[:, d]]
                most += high[d][code[:, d]]
            able = least <= most.min(1)[:, None]
            found = np.where(able.sum(1) == 1, able.argmax(1), -1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], ["key", "code", "old", "cluster"])

    return state.select("key", "code", F.col("cluster").alias("old")).mapInArrow(
        locate, "key long, code binary, old int, cluster int"
    )


def _settled(fetched: DataFrame, centroids: np.ndarray, dimensions: int) -> DataFrame:
    """Exact assignments of fetched vectors and, from each task, what they change in the sums of the centroids.

    Rows with a key are assignments; those without are ``n`` and ``sums`` to add to a centroid.
    """
    k = len(centroids)

    def settle(batches):
        n, sums = np.zeros(k + 1, np.int64), np.zeros((k + 1, dimensions), np.int64)
        names, ints = ["key", "code", "cluster", "n", "sums"], pa.list_(pa.int64())
        for batch in _slices(batches):
            v, old = _matrix(batch.column(4), dimensions), _numbers(batch.column(2))
            now = _numbers(batch.column(3)).copy()
            open_ = np.flatnonzero(now < 0)
            now[open_] = exact(v[open_], centroids).argmin(1)
            moved = np.flatnonzero(now != old)
            # A vector without a centroid so far is taken from the place after the last, which is not read.
            for place, sign in ((now[moved], 1), (old[moved], -1)):
                np.add.at(n, place, sign)
                np.add.at(sums, place, sign * v[moved])
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(now, pa.int32()), pa.nulls(rows, pa.int64()), pa.nulls(rows, ints)],
                names,
            )
        changed = np.flatnonzero((n[:k] != 0) | (sums[:k] != 0).any(1))
        arrays = [pa.nulls(len(changed), pa.int64()), pa.nulls(len(changed), pa.binary()), pa.array(changed, pa.int32())]
        arrays += [pa.array(n[changed]), pa.array(list(sums[changed]), ints)]
        yield pa.RecordBatch.from_arrays(arrays, names)

    rows = fetched.select("key", "code", "old", "cluster", "vec")
    return rows.mapInArrow(settle, "key long, code binary, cluster int, n long, sums array<long>")


def clusters(
    vectors: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    id: str = "vec_id",
    vector: str = "embedding",
    dimensions: int = DIMENSIONS,
    scale: float = SCALE,
    seed: str = SEED,
) -> tuple[DataFrame, list[list[int]]]:
    """``id, cluster, distance`` of every vector, stored, and the final centroids."""
    spark = vectors.sparkSession
    ship(spark)
    numbered = whole_vectors(vectors, id, vector, dimensions, scale).select(F.monotonically_increasing_id().alias("key"), "id", "vec")
    full = in_buckets(numbered, "va_vectors")
    centroids = _first_centroids(full, k, seed)
    if not len(centroids):
        return full.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    cells = _cells(full, dimensions)

    def encode(batches):
        for batch in _slices(batches):
            code = cells.codes(_matrix(batch.column(1), dimensions))
            ends = np.arange(0, code.size + 1, dimensions, dtype=np.int32)
            packed = pa.Array.from_buffers(pa.binary(), len(code), [None, pa.py_buffer(ends), pa.py_buffer(code.tobytes())])
            none = pa.array(np.full(len(code), -1, np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), packed, none], ["key", "code", "cluster"])

    state = stored(full.select("key", "vec").mapInArrow(encode, "key long, code binary, cluster int"), "va-codes")
    count, total = np.zeros(len(centroids), object), np.zeros((len(centroids), dimensions), object)
    for step in range(rounds):
        located = stored(_located(state, cells, centroids, dimensions), f"va-located-{step}")
        open_ = (F.col("cluster") < 0) | (F.col("cluster") != F.col("old"))
        settled = stored(_settled(located.filter(open_).join(full, "key"), centroids, dimensions), f"va-settled-{step}")
        change = settled.filter("key IS NULL").groupBy("cluster")
        for row in change.agg(F.sum("n").alias("n"), _each(F.sum, "sums", dimensions)).collect():
            total[row["cluster"]] += np.array(row["sums"], object)
            count[row["cluster"]] += row["n"]
        centroids = centroids.copy()
        for c in np.flatnonzero(count):
            centroids[c] = [x // int(count[c]) for x in total[c]]
        state = located.filter(~open_).select("key", "code", "cluster").unionByName(
            settled.filter("key IS NOT NULL").select("key", "code", "cluster")
        )
    final = _located(state, cells, centroids, dimensions).select("key", "cluster").join(full, "key")

    def measure(batches):
        for batch in _slices(batches):
            v, now = _matrix(batch.column(2), dimensions), _numbers(batch.column(1)).copy()
            open_ = np.flatnonzero(now < 0)
            now[open_] = exact(v[open_], centroids).argmin(1)
            gap = v - centroids[now]
            far = np.einsum("ij,ij->i", gap, gap)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(now, pa.int32()), pa.array(far)], ["id", "cluster", "distance"]
            )

    kind = full.schema["id"].dataType.simpleString()
    measured = final.select("id", "cluster", "vec").mapInArrow(measure, f"id {kind}, cluster int, distance long")
    return stored(measured, "va-clusters"), [[int(x) for x in c] for c in centroids]


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertia of every vector, and the digest of its centroid."""
    found, centroids = clusters(documents(spark, sf_dir, "embeddings"))
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.try_sum("distance").alias("s")).collect()}
    every = None if None in sums.values() or sum(sums.values()) >= 2**63 else sum(sums.values())
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    rows = [(c, sums.get(c), every, text) for c, text in enumerate(digest)]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    # One row for each centroid.
    each = F.broadcast(spark.createDataFrame(rows, schema))
    return found.join(each, "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", *each.columns[1:])


def _oracle() -> str:
    gap = "list_sum(list_transform(list_zip(q, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id,
          list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
          FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}
            AND len(embedding) = {DIMENSIONS})""",
        f"""c0 AS MATERIALIZED (SELECT * FROM (SELECT
          row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')), q) - 1 AS k, q AS c FROM v)
          WHERE k < {CENTROIDS})""",
    ]
    for i in range(ROUNDS + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (SELECT row, any_value(vec_id) AS vec_id, any_value(q) AS q,
              arg_min(k, (d, k)) AS k, min(d) AS d FROM (SELECT row, vec_id, q, k, {gap} AS d FROM v, c{i}) GROUP BY row)"""
        )
        if i < ROUNDS:
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (SELECT k, coalesce(m.c, o.c) AS c FROM c{i} AS o LEFT JOIN (
                  SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY d) AS c FROM (
                    SELECT k, d, sum(x) AS s, count(*) AS n FROM (
                      SELECT k, unnest(q) AS x, unnest(range({DIMENSIONS})) AS d FROM a{i}) GROUP BY k, d)
                  GROUP BY k) AS m USING (k))"""
            )
    last = ROUNDS
    return f"""WITH {", ".join(steps)}
      SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
        CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
        sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{last} JOIN c{last} USING (k)"""


ORACLE = _oracle()

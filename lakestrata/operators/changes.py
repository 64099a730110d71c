"""What changed between two snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_COPIES, _CHUNK = "_copies", "_chunk"
COPIES_PER_CHUNK = 10_000


def _net_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Each distinct row with how many more copies ``new`` has than ``old``, where not zero.

    One union and one aggregation over both snapshots. Copies are counted before the shuffle, so a
    row repeated many times costs no more than any other.
    """
    both = old.withColumn(_COPIES, F.lit(-1).cast("bigint")).unionByName(
        new.withColumn(_COPIES, F.lit(1).cast("bigint"))
    )
    return both.groupBy(*old.columns).agg(F.sum(_COPIES).alias(_COPIES)).filter(F.col(_COPIES) != 0)


def _with_copies(net: DataFrame) -> DataFrame:
    """Repeat each row as often as its count says.

    Rows are repeated where they are. Only a count above COPIES_PER_CHUNK is cut into chunks that are spread over
    the tasks first, so no task writes all copies of one row. Both parts read the same shuffle of the counts. The
    chunks are few and small until their rows are repeated, so adaptive execution must not join them by size: they
    go to as many tasks as the session's shuffles have.
    """
    one, count = F.lit(1).cast("bigint"), F.abs(F.col(_COPIES))
    few = net.filter(count <= COPIES_PER_CHUNK).withColumn(_CHUNK, F.explode(F.sequence(one, count)))
    chunks = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(abs({_COPIES}) - 1) div {COPIES_PER_CHUNK}"))
    in_chunk = F.least(F.lit(COPIES_PER_CHUNK).cast("bigint"), count - F.col(_CHUNK) * COPIES_PER_CHUNK)
    tasks = int(net.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = net.filter(count > COPIES_PER_CHUNK).withColumn(_CHUNK, F.explode(chunks)).repartition(tasks)
    many = many.withColumn(_CHUNK, F.explode(F.sequence(one, in_chunk)))
    return few.unionByName(many).drop(_COPIES, _CHUNK)


def snapshot_changes(old: DataFrame, new: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """The rows that differ, with ``_change_type``; columns come in the order of ``old``.

    Without a key, rows are compared as a bag: copies beyond those in ``old`` are ``insert``,
    missing copies are ``delete``. With a key, a key found on both sides gives
    ``update_preimage`` and ``update_postimage`` in place of delete and insert. Nulls and NaN
    equal themselves.
    """
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError("the snapshots have different columns")
    net = _net_rows(old, new)
    added = F.col(_COPIES) > 0
    plain = F.when(added, "insert").otherwise("delete")
    if key is None:
        return _with_copies(net.withColumn("_change_type", plain))

    # Both sides of a changed row share its key; only changed rows take part from here on.
    sides = net.groupBy(*key).agg((F.max(added) & ~F.min(added)).alias("_updated"))
    sides = sides.filter("_updated").select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(key)], "_updated")
    same_key = [net[k].eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(key)]
    updated = F.when(added, "update_postimage").otherwise("update_preimage")
    marked = net.join(sides, same_key, "left").withColumn(
        "_change_type", F.when(F.col("_updated"), updated).otherwise(plain)
    )
    return _with_copies(marked.select(*net.columns, "_change_type"))

import os

import pytest
from helpers import rows

from lakestrata.operators.rules import expectation_metrics
from lakestrata.session import scratch_path
from lakestrata.sources import ExpectationsNotMet, ensure_namespaces, publish, publish_audited
from lakestrata.sources import staged
from lakestrata.sources.catalog import external_path

RULES = {"positive": "id >= 0", "small": "id < 100"}


@pytest.fixture(scope="module")
def space(spark):
    ensure_namespaces(spark, {"audited": "Audited tables"}, scratch_path(spark, "audited"))
    return "audited"


@pytest.mark.parametrize("how", [{}, {"path": True}, {"partition_by": ["p"]}, {"path": True, "partition_by": ["p"], "fmt": "orc"}])
def test_a_failing_run_leaves_the_old_table(spark, space, how):
    name = f"{space}.t{abs(hash(str(how))) % 10**8}"
    if how.get("path"):
        how = {**how, "path": scratch_path(spark, "own")}
    frame = lambda n: spark.range(n).selectExpr("id", "id % 3 AS p")
    publish_audited(frame(5), name, RULES, properties={"quality": "silver"}, **how)
    with pytest.raises(ExpectationsNotMet, match=r"small \(20 of 120 rows\)"):
        publish_audited(frame(120), name, RULES, **how)
    assert rows(spark.table(name), "id") == [(i,) for i in range(5)]
    publish_audited(frame(7), name, RULES, **how)
    assert rows(spark.table(name), "id") == [(i,) for i in range(7)]
    assert rows(spark.table(name).filter("p = 1"), "id") == [(1,), (4,)]
    assert [t.name for t in spark.catalog.listTables(space) if name.split(".")[1] in t.name] == [name.split(".")[1]]
    if "path" in how:  # the rows of the runs before are gone
        place = external_path(spark, name).split(":", 1)[-1]
        parent, base = os.path.split(how["path"])
        assert [os.path.join(parent, x) for x in os.listdir(parent) if x.startswith(base)] == [place]


def test_rows_are_computed_once(spark, space):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(50, numPartitions=2).mapInArrow(counted, "id long")
    publish_audited(df, f"{space}.once", RULES)
    assert seen.value == 50


def test_a_run_that_ended_between_the_renames_is_put_right(spark, space):
    name = f"{space}.between"
    publish(spark.range(3), name)
    staged.stage(spark.range(4), name)
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old")
    staged.recover(spark, name)
    assert rows(spark.table(name)) == [(0,), (1,), (2,), (3,)]  # it had passed its audit
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old")
    publish_audited(spark.range(2), name, RULES)
    assert rows(spark.table(name)) == [(0,), (1,)]
    assert not spark.catalog.tableExists(f"{name}__old") and not spark.catalog.tableExists(f"{name}__next")


def test_an_audit_of_ones_own_and_a_tolerance(spark, space):
    def audit(stored):
        if stored.count() > 3:
            raise ValueError("too many")

    name = f"{space}.own"
    publish_audited(spark.range(3), name, audit)
    with pytest.raises(ValueError):
        publish_audited(spark.range(4), name, audit)
    publish_audited(spark.range(101), name, staged.audit_rules(RULES, tolerance=0.01))
    assert spark.table(name).count() == 101
    assert expectation_metrics(spark.table(name), RULES).filter("failed > 0").count() == 1

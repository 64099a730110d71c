"""Helpers of the tests. They are not in conftest.py, since a folder below has one of its own."""

from contextlib import contextmanager


def rows(df, *columns):
    """Rows as sorted tuples, null first."""
    found = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in found), key=lambda r: [(v is not None, str(v)) for v in r])


@contextmanager
def sql_conf(spark, settings):
    """Hold SQL settings for the length of a block, then put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)

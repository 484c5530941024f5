from __future__ import annotations

import sys
from contextlib import contextmanager
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from residualkit.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("residualkit-tests", cpus=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@contextmanager
def settings(spark, **values):
    """Set session settings for a while; ``__`` in a name stands for a dot."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def many_blocks(spark):
    """Keep small shuffles in several partitions, so that groups do cross block edges."""
    return settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false")


def no_broadcast(spark):
    return settings(spark, spark__sql__autoBroadcastJoinThreshold="-1")


def rows(df, *order):
    """Rows as tuples, sorted by the given columns or by everything."""
    collected = df.collect()
    key = (lambda r: [r[c] for c in order]) if order else (lambda r: [(v is not None, v) for v in r])
    return [tuple(r) for r in sorted(collected, key=key)]

"""Session defaults for scripts and tests. Library code never builds a session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "residualkit", cpus: int | None = None) -> SparkSession:
    """A local session with the settings the benchmark and the tests use.

    On a cluster, submit with the cluster's own settings instead; the library
    reads ``spark.checkpoint.dir`` and ``spark.sql.autoBroadcastJoinThreshold``
    from whatever session it is given.
    """
    cores = cpus or os.cpu_count() or 4
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )

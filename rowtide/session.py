"""Session defaults for local runs; a cluster brings its own settings."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str = "8", partitions: int = 8, app: str = "rowtide") -> SparkSession:
    """A session for tests and the bench. AQE stays on, times are UTC."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("ROWTIDE_DRIVER_MEMORY", "8g"))
        # Recording a call site per column costs more than planning these queries.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_MADE: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Read from ``spark.checkpoint.dir``. Only a session on one machine (a local test) gets
    one of its own if that is unset; on a cluster it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
    app = spark.sparkContext.applicationId
    if app not in _MADE:
        _MADE[app] = tempfile.mkdtemp(prefix="rowtide-", dir="/tmp")
    return _MADE[app]

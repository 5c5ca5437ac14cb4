"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(app: str = "proofmark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; on a cluster ``master`` comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; a cluster must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _own_dir().name


@cache
def _own_dir() -> tempfile.TemporaryDirectory:
    """A folder of this process, which goes with it."""
    return tempfile.TemporaryDirectory(prefix="proofmark-", ignore_cleanup_errors=True)

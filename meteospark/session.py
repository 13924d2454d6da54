"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build(app: str = "meteospark", master: str | None = None, **conf) -> SparkSession:
    """A session with UTC time and adaptive execution. Cluster settings win over defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # call sites on every expression cost round trips while a plan is built
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    require_utc(settings["spark.sql.session.timeZone"])
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(zone: str) -> None:
    """Times are UTC wall times; casts in a session of another zone would shift them without a word."""
    if zone.upper() not in ("UTC", "GMT", "Z", "ETC/UTC", "ETC/GMT", "+00:00", "UTC+0", "GMT+0"):
        raise ValueError(f"the session time zone is {zone}; set spark.sql.session.timeZone to UTC")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def run_folder(spark: SparkSession) -> str:
    """A new folder for the tables of one run inside the shared folder."""
    return f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"

"""Session helpers: sane defaults for local runs and tests, and the shared
checkpoint folder taken from the cluster's ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def get_session(app: str = "tidemark", master: str | None = None, shuffle_partitions: int = 8, **conf) -> SparkSession:
    """Active session if any, else a local one (UI off, AQE on, UTC)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = (
        SparkSession.builder.appName(app)
        .master(master or "local[*]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate results: the one the session names
    in ``spark.checkpoint.dir``, else the one its context was given. Only for
    a local master without either (tests, local runs) a fresh temporary folder
    is set; on a cluster that is an error, never a machine-local fallback."""
    context = spark.sparkContext
    given = context._jsc.sc().getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not given.isDefined():
            context.setCheckpointDir(named)
        return named
    if given.isDefined():
        return given.get()
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    spark.conf.set("spark.checkpoint.dir", folder)
    context.setCheckpointDir(folder)
    return folder

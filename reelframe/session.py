"""Session factory and the shared scratch area of a cluster."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "reelframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume (UTC, AQE on)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all executors share.

    Where a session of one machine (a local master, as in tests) names none, a temporary folder is set for it; elsewhere that is an
    error, since executors would each write to a folder of their own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    jsc = spark.sparkContext._jsc.sc()
    if not d:
        now = jsc.getCheckpointDir()
        d = now.get() if now.isDefined() else None
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        own = os.path.join(tempfile.gettempdir(), f"reelframe-{uuid.uuid4().hex}")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        d = f"file://{own}"
    if not jsc.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage (survives lost executors)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows by a hash of ``keys`` in two partitions a core: for work in Python, which takes long for few bytes, so that partitions must not be merged by their size."""
    return df.repartition(max(2, 2 * df.sparkSession.sparkContext.defaultParallelism), *keys)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/reelframe-{name}-{uuid.uuid4().hex}"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")

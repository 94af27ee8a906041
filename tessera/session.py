"""Session factory and shared-folder materialisation.

Iterative operators cut their lineage by writing Parquet tables below the folder
that the cluster names in ``spark.checkpoint.dir``.  A written table is computed
once (a reliable RDD checkpoint computes its last stage twice), keeps columnar
compression, and survives the loss of any executor.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "tessera", **conf: str) -> SparkSession:
    """A session with the settings the engine is tuned for; keyword arguments override them."""
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    builder = SparkSession.builder.appName(app)
    for key, value in (defaults | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is ``spark.checkpoint.dir``.  Only a single-process local master, where
    driver and executors are one JVM, may fall back to a temporary folder.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return "file://" + os.path.join(tempfile.gettempdir(), "checkpoints", "tessera")
    raise ValueError("set spark.checkpoint.dir to a folder shared by the driver and all executors")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table", keep: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table; ``keep`` collects its path for ``discard``."""
    spark = df.sparkSession
    path = new_path(spark, label)
    # What was shuffled for a written table is of no further use; by default it stays on the executors' disks until the
    # driver's garbage is collected.
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    if keep is not None:
        keep.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete intermediate tables that no later plan reads."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    paths.clear()

"""Session settings the jobs rely on, and lineage cuts that survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTINGS = {
    # Offset-less timestamps in change records mean UTC.
    "spark.sql.session.timeZone": "UTC",
    # A JSON member given twice: the last one counts.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Hot keys are split, small sides are broadcast, by measured size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles a method of more bytecode than this. A stage of long expressions in one such method is
    # interpreted for good; beyond the limit Spark generates small methods per expression instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
_BROADCAST_MEASURED = "spark.sql.adaptive.autoBroadcastJoinThreshold"
_SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in _SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if spark.conf.get(_BROADCAST, None) is None:
        # A few columns of a packed Parquet table are millions of rows in a megabyte of the file, and
        # the driver holds all of them to broadcast them. Before a run only files that are small in any
        # case count as small; whatever else is small is found by its rows in memory while it runs.
        spark.conf.set(_BROADCAST, "256k")
        spark.conf.set(_BROADCAST_MEASURED, "2m")
    return spark


def build_session(app_name: str = "weftline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    # Recording a Python call site for every expression costs more than building it.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="weftline-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut_lineage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read on from there.

    A stage that several later stages use is computed once, outlives lost executors, is
    read column by column, and has a known size, so joins with it are planned on facts.
    What was shuffled to make it is deleted then: nothing else reads it. ``compression`` is
    the session's if not given; joins are planned by the size of the files.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/weftline/{uuid.uuid4().hex}"
    before = spark.conf.get(_SHUFFLES_END, None)
    spark.conf.set(_SHUFFLES_END, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.set(_SHUFFLES_END, before) if before else spark.conf.unset(_SHUFFLES_END)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def once(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with ``columns`` computed once: a filter on them is not moved below and does not compute them again.

    The outer form: the inner one is preceded by a test of the array, which would compute them too.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline_outer(F.array(F.struct(*columns))))


def spread_small_input(df: DataFrame) -> DataFrame:
    """Deal the rows of a table with fewer files than cores out to all cores.

    Worth it before work that is heavy per row. A table of many files is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df

"""Entity tables laid out in hash buckets of the id, of which a batch rewrites only those it touches.

A table folder holds one partition folder per bucket; plain Parquet, readable by anything. A batch
reads the buckets its changes fall into, merges them, writes the merged rows to a journal and then
replaces those buckets by dynamic partition overwrite. All other files stay as they are. A job
that dies while it replaces buckets leaves a finished journal, and the next one replays it before
anything else; a batch that was applied before is left alone. One writer at a time.

The number of buckets is chosen when the table is made: so many that one is a task's worth of rows
(about 1 GB). It cannot change later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.catalog import Catalog
from weftline.operators.merge import merge_entity
from weftline.sources.sinks import finished_versions, write_version

BUCKET = "_bucket"
_LAYOUT = "id_column string, buckets int"


def bucket_of(id_: Column, buckets: int | Column) -> Column:
    """Bucket of a record; ids are one in any case."""
    return F.pmod(F.xxhash64(F.lower(id_.cast("string"))), F.lit(buckets) if isinstance(buckets, int) else buckets).cast("int")


def _folder(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{name}"


def make_table(frame: DataFrame, path: str, id_column: str, buckets: int) -> None:
    """Lay ``frame`` out in ``buckets`` under ``path``, which must not exist yet."""
    spark = frame.sparkSession
    rows = frame.withColumn(BUCKET, bucket_of(F.col(id_column), buckets))
    _replace(rows.repartition(BUCKET), path, "errorifexists")
    spark.createDataFrame([(id_column, buckets)], _LAYOUT).coalesce(1).write.parquet(_folder(path, "_layout"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table as it is, after finishing what a dead writer began."""
    _recover(spark, path)
    return _rows(spark, path).drop(BUCKET)


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(_folder(path, "rows"))


def _replace(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the buckets that ``rows`` have and leave all others."""
    writer = rows.write.mode(mode).partitionBy(BUCKET).option("partitionOverwriteMode", "dynamic")
    writer.parquet(_folder(path, "rows"))


def _recover(spark: SparkSession, path: str) -> None:
    """Replace buckets from journals that are finished but not marked as applied."""
    applied = set(finished_versions(spark, _folder(path, "_applied")))
    for version in finished_versions(spark, _folder(path, "_journal")):
        if version not in applied:
            _apply(spark, path, version)


def _apply(spark: SparkSession, path: str, version: int) -> None:
    journal = spark.read.parquet(_folder(path, f"_journal/version={version}"))
    _replace(journal.repartition(BUCKET), path)
    write_version(journal.groupBy(BUCKET).agg(F.count("*").alias("rows")), _folder(path, "_applied"), version)


def merge_changes(changes: DataFrame, path: str, catalog: Catalog, entity: str, version: int) -> None:
    """Merge the folded ``changes`` of one batch into the table; ``version`` names the batch.

    Only the numbers of touched buckets reach the driver, as many as the table has at most.
    """
    spark = changes.sparkSession
    _recover(spark, path)
    if version in finished_versions(spark, _folder(path, "_applied")):
        return
    layout = spark.read.schema(_LAYOUT).parquet(_folder(path, "_layout")).first()
    own = changes.where(F.col("entity_name") == entity)
    bucket = bucket_of(F.col("id"), layout["buckets"])
    touched = sorted(r[0] for r in own.select(bucket).distinct().collect())
    if not touched:
        return
    table = _rows(spark, path)
    # A filter on the partition column: files of other buckets are not opened.
    rows = table.where(F.col(BUCKET).isin(touched)) if len(touched) < layout["buckets"] else table
    merged = merge_entity(rows.drop(BUCKET), own, catalog, entity)
    merged = merged.withColumn(BUCKET, bucket_of(F.col(layout["id_column"]), layout["buckets"]))
    write_version(merged, _folder(path, "_journal"), version)
    _apply(spark, path, version)


def applied_buckets(spark: SparkSession, path: str, version: int) -> DataFrame:
    """(_bucket, rows) of the buckets that a batch replaced."""
    if version not in finished_versions(spark, _folder(path, "_applied")):
        return spark.createDataFrame([], T.StructType([T.StructField(BUCKET, T.IntegerType()), T.StructField("rows", T.LongType())]))
    return spark.read.parquet(_folder(path, f"_applied/version={version}"))

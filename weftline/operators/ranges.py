"""Order within keys without gathering a key: rows in ranges, sums and last values carried between them.

Rows are dealt out by ranges of (keys, order), so a key that a third of all rows have is spread
over many partitions. A window runs inside each (range, key); what the earlier ranges of the key
add is found from one row per range and key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.session import cut_lineage

_PART = "_range"


def _in_ranges(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``rows`` with the number of their range, written so that the numbers stay."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(rows.repartitionByRange(parts, *keys, *order).withColumn(_PART, F.spark_partition_id()))


def number_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str) -> DataFrame:
    """``rows`` with their number from 0 under ``keys`` in ``order``, as ``name``. Null keys are one key."""
    placed = _in_ranges(rows, keys, order)
    local = Window.partitionBy(_PART, *keys).orderBy(*order)
    counts = placed.groupBy(*keys, _PART).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    # A row per range and key, so as many of a key as there are ranges.
    starts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).where(F.col("_before") > 0)
    starts = starts.select(F.col(_PART).alias("_p"), F.struct(*keys).alias("_k"), "_before")
    numbered = placed.withColumn(name, F.row_number().over(local).cast("bigint") - 1)
    joined = numbered.join(starts, (F.col(_PART) == F.col("_p")) & F.struct(*keys).eqNullSafe(F.col("_k")), "left")
    return joined.withColumn(name, F.col(name) + F.coalesce("_before", F.lit(0))).drop(_PART, "_p", "_k", "_before")


def last_before(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """``rows`` with the last ``value`` that is not null among earlier rows of the same ``keys``, as ``name``."""
    placed = _in_ranges(rows, keys, order)
    local = Window.partitionBy(_PART, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    known = placed.where(F.col(value).isNotNull()).groupBy(*keys, _PART).agg(F.max_by(value, F.struct(*order)).alias("_last"))
    spans = placed.groupBy(*keys, _PART).agg(F.count("*").alias("_n")).join(known, [*keys, _PART], "left")
    earlier = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier)).where(F.col("_carried").isNotNull())
    joined = placed.withColumn(name, F.last(value, ignorenulls=True).over(local)).join(
        carried.select(*keys, _PART, "_carried"), [*keys, _PART], "left"
    )
    return joined.withColumn(name, F.coalesce(name, "_carried")).drop(_PART, "_carried")

"""Keys that many rows share: found with a frequent-items sketch, joined under salts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key of fewer rows is never worth salting.
LEAST_ROWS = 1000
#: Items the sketch follows: it is exact up to so many keys and overlooks no key with more than 1/7500 of the rows.
_TRACKED = 10_000

_KEY = ["entity_name", "identity"]


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _hash() -> Column:
    return F.xxhash64(*_KEY)


def hot_keys(requests: DataFrame) -> list[int]:
    """Hashes of the (entity_name, identity) that would fill more than half a partition alone.

    At most twice as many as there are partitions, whatever the rows.
    """
    many = min(2 * _partitions(requests), _TRACKED)
    found = (
        requests.where(F.col("identity").isNotNull())
        .select(_hash().alias("h"))
        .agg(F.count("*").alias("rows"), F.expr(f"approx_top_k(h, {many}, {_TRACKED})").alias("top"))
        .first()
    )
    least = max(LEAST_ROWS, found["rows"] / many)
    return sorted(t["item"] for t in found["top"] or [] if t["count"] > least)


def join_unique(rows: DataFrame, found: DataFrame, hot: Sequence[int], spread_by: Sequence[str], on: Sequence[str] = _KEY) -> DataFrame:
    """Left join of ``rows`` with ``found``, which is unique on the key; rows of ``hot`` keys are dealt to all partitions.

    Only the few hot rows of ``found`` are repeated, once per partition. ``on`` names the key's
    columns in both.
    """
    if not hot:
        return rows.join(found, list(on), "left")
    salts, h = _partitions(rows), F.xxhash64(*on)
    one = F.array(F.lit(0).cast("bigint"))
    salted = rows.withColumn("_salt", F.when(h.isin(list(hot)), F.pmod(F.xxhash64(*spread_by), F.lit(salts))).otherwise(F.lit(0).cast("bigint")))
    repeated = found.withColumn("_salt", F.explode(F.when(h.isin(list(hot)), F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).otherwise(one)))
    return salted.join(repeated, [*on, "_salt"], "left").drop("_salt")

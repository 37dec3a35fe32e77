"""Shards of near equal size by histogram sort: probe, count, refine, exchange once.

A row's key is (hash of its text, hash of its id and text). Candidate splitters are probed by
counting, over all rows, the exact bytes whose key lies below each; the interval around every
wanted boundary shrinks until a probe meets the tolerance. Then rows move once.

Equal texts have neighbouring keys, and probes lie between texts as long as the tolerance can
be met so; only a group too large for that is cut, by the second hash. The last ``_TIE_BITS``
bits of that tell rows of one id and text apart by their place in the table, so repeated rows are
cut like others. Rows are written once with their keys and everything else reads what was
written. If rows are too coarse for the tolerance, the nearest possible boundary is taken.

A null text has no bytes; a null id is an id like any other. Columns of ``docs`` that are
named like one of the result's or ``_high``, ``_low``, ``_slice``, ``_at``, ``_before``, ``_rows``
are replaced or dropped. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.llm.common import text_or_empty
from weftline.session import cut_lineage

SHARDS = 24
#: What a row takes besides its text.
ROW_BYTES = 8
#: Largest miss of a boundary as a share of a shard.
TOLERANCE = 0.01
#: Probes per boundary and round.
PROBES = 64
#: A shard is numbered in slices of about so many rows.
SLICE_ROWS = 200_000

_TIE_BITS = 24

_HALF = 1 << 63
_LOW = (1 << 64) - 1


def size_of(text: str = "text") -> Column:
    return F.octet_length(text_or_empty(text)).cast("bigint") + F.lit(ROW_BYTES)


def _keys(docs: DataFrame, text: str) -> DataFrame:
    own = F.shiftleft(F.shiftright(F.xxhash64("doc_id", text_or_empty(text)), _TIE_BITS), _TIE_BITS)
    place = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - _TIE_BITS)
    return docs.withColumns({
        "size": size_of(text),
        "_high": F.xxhash64(text_or_empty(text)),
        "_low": own.bitwiseOR(place),
    })


def _rank(high: np.ndarray, low: np.ndarray, probe_high: np.ndarray, probe_low: np.ndarray) -> np.ndarray:
    """How many probes are at or below each key."""
    first, last = np.searchsorted(probe_high, high, "left"), np.searchsorted(probe_high, high, "right")
    rank = last.copy()
    for at in np.unique(first[first != last]):
        own = np.flatnonzero((first == at) & (last != at))
        rank[own] = at + np.searchsorted(probe_low[at : last[own[0]]], low[own], "right")
    return rank


def _histogram(keys: DataFrame, probes: list[int]) -> dict[int, tuple[int, int, int, int]]:
    """Exact bytes and rows between neighbouring probes, with the smallest and largest first hash.

    One row per probe and task is shuffled; as many as there are probes reach the driver.
    """
    probe_high = np.array([(p >> 64) - _HALF for p in probes], np.int64)
    probe_low = np.array([(p & _LOW) - _HALF for p in probes], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        least = np.full(len(probes) + 1, np.iinfo(np.int64).max)
        most = np.full(len(probes) + 1, np.iinfo(np.int64).min)
        for batch in batches:
            high, low, own = (c.to_numpy() for c in batch.columns)
            at = _rank(high, low, probe_high, probe_low)
            np.add.at(size, at, own)
            rows += np.bincount(at, minlength=len(rows))
            np.minimum.at(least, at, high)
            np.maximum.at(most, at, high)
        bins = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (bins, size[bins], rows[bins], least[bins], most[bins])], ["bin", "size", "rows", "least", "most"])

    parts = keys.select("_high", "_low", "size").mapInArrow(run, "bin bigint, size bigint, rows bigint, least bigint, most bigint")
    found = parts.groupBy("bin").agg(F.sum("size"), F.sum("rows"), F.min("least"), F.max("most")).collect()
    return {r[0]: tuple(r[1:]) for r in found}


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE, probes: int = PROBES) -> list[int]:
    """Keys at which shards 1, 2, ... begin, as 128-bit numbers."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    allowed = tolerance * total / shards
    # Per boundary: wanted bytes below it, interval, bytes below either end.
    open_ = {i: (i * total / shards, 0, 1 << 128, 0, total) for i in range(1, shards)}
    done: dict[int, int] = {i: 1 << 128 for i in open_} if not total else {}
    while open_ and total:
        grid: set[int] = set()
        for _, low, high, _, _ in open_.values():
            step = max(1, (high - low) // (probes + 1))
            # Between texts while the interval is wide: groups of equal texts stay whole.
            align = (lambda x: x >> 64 << 64) if step >> 64 else (lambda x: x)
            grid.update(x for k in range(1, probes + 1) if low < (x := align(low + k * step)) < high)
            grid.update((low, high - 1) if high - low <= probes + 1 else (low,))
        points = sorted(grid)
        bins = _histogram(keys, points)
        below, run = {}, bins.get(0, (0,))[0]
        for n, p in enumerate(points):
            below[p] = run
            run += bins.get(n + 1, (0,))[0]
        place = {p: n for n, p in enumerate(points)}
        for i, (want, low, high, low_bytes, high_bytes) in list(open_.items()):
            ends = {low: low_bytes, high: high_bytes} | {p: b for p, b in below.items() if low <= p <= high}
            best = min(ends, key=lambda p: (abs(ends[p] - want), p & _LOW != 0, p))
            left = max((p for p in ends if ends[p] <= want), default=low)
            right = min((p for p in ends if p > left and ends[p] > want), default=high)
            rows = bins.get(place[left] + 1, (0, 0, 0, 0)) if left in place else None
            if abs(ends[best] - want) <= allowed or right - left <= 1 or (rows and rows[1] <= 1 and right in place):
                done[i] = best
                del open_[i]
                continue
            bounds = ends[left], ends[right]
            if rows and rows[1] and (right in place or right == 1 << 128):
                # Nothing lies outside what was seen between the two probes.
                left = max(left, (rows[2] + _HALF) << 64)
                right = min(right, (rows[3] + _HALF + 1) << 64)
            open_[i] = (want, left, right, *bounds)
    return [done[i] for i in range(1, shards)]


def _shard_column(points: list[int]) -> Column:
    shard = F.lit(0)
    for p in points:
        if p >> 128:
            continue
        high, low = (p >> 64) - _HALF, (p & _LOW) - _HALF
        shard = shard + ((F.col("_high") > F.lit(high)) | ((F.col("_high") == F.lit(high)) & (F.col("_low") >= F.lit(low)))).cast("int")
    return shard


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, text: str = "text") -> DataFrame:
    """``docs`` with size, shard (from 0) and slot (from 0 without gaps in each shard).

    Inside a shard rows are ordered by a hash, that is, mixed.
    """
    keyed = cut_lineage(_keys(docs.drop("shard", "slot", "_slice", "_at", "_before", "_rows"), text))
    keys = keyed.select("_high", "_low", "size")
    placed = _shard_column(splitters(keys, shards, tolerance))
    slices = max(1, -(-keys.count() // (shards * SLICE_ROWS)))
    slot_slice = F.pmod(F.col("_low"), F.lit(slices))
    counts = keys.select(placed.alias("shard"), slot_slice.alias("_slice")).groupBy("shard", "_slice").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard", "_slice").orderBy("_low", "_high")
    numbered = keyed.withColumns({"shard": placed, "_slice": slot_slice}).withColumn("_at", F.row_number().over(inside))
    return (
        numbered.join(offsets, ["shard", "_slice"])
        .withColumn("slot", F.col("_before") + F.col("_at") - 1)
        .drop("_high", "_low", "_slice", "_at", "_before", "_rows")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder of Parquet files per shard, rows in slot order."""
    sharded.repartition("shard", F.floor(F.col("slot") / SLICE_ROWS)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

"""What several operators share: packed batches, links inside keys, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.session import cut_lineage

# What separates words, space and the controls from tab to carriage return.
BLANKS = b" \t\n\x0b\x0c\r"


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8 with A-Z in lower case. Only ASCII white space separates."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def table_partitions(df: DataFrame) -> int:
    """Partitions for an exchange: what the session asks for."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def as_signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64, copy=False).view(np.int64)


def popcount(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values.view(np.uint64))


#: Bytes of one Arrow batch that goes to Python: long texts make fewer rows, not larger batches.
BATCH_BYTES = 8 << 20


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session now bounds what goes to Python at once by bytes, not by rows alone."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``work`` to each Arrow batch of ``df`` where it lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = work(batch)
            if out is not None and out.num_rows:
                yield out

    return in_small_batches(df).mapInArrow(run, schema)


def whole_keys(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Regroup batches that are sorted by ``key`` so that no key is cut between two tables."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        if kept and kept[-1].column(key)[kept[-1].num_rows - 1].as_py() == keys[-1]:
            kept.append(batch)
            continue
        start = int(np.searchsorted(keys, keys[-1], side="left"))
        if start:
            yield pa.Table.from_batches([*kept, batch.slice(0, start)])
            kept = [batch.slice(start)]
        elif kept:
            yield pa.Table.from_batches(kept)
            kept = [batch]
        else:
            kept = [batch]
    if kept:
        yield pa.Table.from_batches(kept)


def forest(values: np.ndarray, errors: int, labels: np.ndarray | None = None, apart: set | None = None) -> list[tuple[int, int]]:
    """Edges of a spanning forest over values that differ in ``errors`` bits at most.

    A breadth-first walk: each value met is compared with those not met yet, so values that
    lie close together cost one comparison each, and there are fewer edges than values.
    Values of one label count as linked already. Pairs in ``apart`` are no links.
    """
    edges: list[tuple[int, int]] = []
    rest = np.arange(len(values))
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            if labels is not None:
                own = labels[rest] == labels[at]
                queue.extend(rest[own])
                rest = rest[~own]
            near = popcount(values[rest] ^ values[at]) <= errors
            if apart:
                near &= np.fromiter(((min(at, r), max(at, r)) not in apart for r in rest), bool, len(rest))
            if near.any():
                edges.extend((int(at), int(x)) for x in rest[near])
                queue.extend(rest[near])
                rest = rest[~near]
    return edges


def key_runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of at least two equal keys in a sorted array."""
    edges = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
    for at in np.flatnonzero(np.diff(edges) > 1):
        yield int(edges[at]), int(edges[at + 1])


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of ``links`` (a, b: bigint), as (node, component).

    Large-star and small-star steps in turn until nothing changes; a step is one aggregate
    and one join, both on nodes, and every step's edges are written to the shared folder.
    Aggregates are partial; the join has one side unique, so a node with very many edges is
    split by adaptive execution.
    """
    edges = cut_lineage(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    state = _state(edges)
    while state[0]:
        edges = cut_lineage(_small_star(_large_star(edges)))
        now = _state(edges)
        if now == state:
            break
        state = now
    heads = edges.select(F.col("v").alias("node")).distinct()
    return (
        edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
        .unionByName(heads.select("node", F.col("node").alias("component")))
        .groupBy("node").agg(F.min("component").alias("component"))
    )


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.join(least, "u").where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    return (
        joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .where(F.col("u") != F.col("v")).distinct()
    )


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit hashes over all bits."""
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


# Odd step of the polynomial hash over bytes.
_BYTE_STEP = 0x9E3779B97F4A7C15


@lru_cache(2)
def _byte_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    found = []
    for step in (_BYTE_STEP, pow(_BYTE_STEP, -1, 1 << 64)):
        factors = np.full(size, step, np.uint64)
        factors[0] = 1
        found.append(np.cumprod(factors))
    return found[0], found[1]


def word_hashes(buf: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, 64-bit hash) of every run of bytes that are ``inside`` a word."""
    edge = np.diff(np.concatenate(([False], inside, [False])).view(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # A power of two, so that few tables are kept.
    forward, back = _byte_powers(1 << max(10, len(buf).bit_length()))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(buf * forward[: len(buf)])))
    return starts, mixed((sums[ends] - sums[starts]) * back[starts])

"""Exact top-k by inner product: a KD-tree per shard, best-first, with a propagated kth score.

Vectors become integers, floor(scale * x). They are dealt to shards of bounded size by a hash
of their id; each shard builds a KD-tree by median splits of the widest dimension, with the
tight bounding box of every node. A box bounds the inner product from above by taking, per
dimension, its better end, so nodes are visited best bound first until the bound falls below
the kth score at hand. Ranks are split at the median row, so equal vectors never make a leaf
larger than it may be.

Queries are every row whose id is divisible by ``every``. They search one shard first; the kth
score they find there is the bar they carry to all other shards. Each (query block, shard) is
one row of work, so neither a shard nor a block of queries is ever held whole with all others.

Null ids are neither queries nor candidates. Vectors that are null, or hold a null or a
non-finite component, take no part. Vectors of different lengths are not compared. A query's
own rows are those of its id. Repeated rows are candidates of their own; a repeated query row
repeats its answers. Scores are exact: where products could outgrow 53 bits, Python's integers
are used, and scores beyond a long are cut to its range. Empty vectors score zero. Empty tables
give empty results. Further columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.session import cut_lineage

SCALE = 256
EVERY = 50
K = 5
#: Rows of a shard, queries of a block, and rows of a leaf.
SHARD_ROWS = 8_192
BLOCK_QUERIES = 256
LEAF_ROWS = 128


_FOUND = "home bigint, part bigint, at bigint, dim int, query_id bigint, vec_id bigint, score bigint"
_LONG = 2**63 - 1


def _unpack(ids: bytes, values: bytes, kind: str, dim: int) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, np.int64)
    return own, np.frombuffer(values, kind).reshape(len(own), dim).astype(np.float64)


class Tree:
    """KD-tree over integer-valued rows; nodes are numbered as in a heap."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF_ROWS):
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.children: list[tuple[int, int] | None] = []
        self.leaves: list[np.ndarray | None] = []
        self.ids, self.rows = ids, rows
        self._add(np.arange(len(rows)), leaf)
        self.low_box, self.high_box = np.array(self.low), np.array(self.high)
        self.largest = float(np.abs(rows).max(initial=0))

    def _add(self, own: np.ndarray, leaf: int) -> int:
        node = len(self.low)
        part = self.rows[own]
        low, high = part.min(axis=0), part.max(axis=0)
        self.low.append(low)
        self.high.append(high)
        self.children.append(None)
        self.leaves.append(None)
        if len(own) <= leaf or not len(low):
            self.leaves[node] = own
        else:
            order = own[np.argpartition(part[:, int(np.argmax(high - low))], len(own) // 2)]
            self.children[node] = (self._add(order[: len(own) // 2], leaf), self._add(order[len(own) // 2 :], leaf))
        return node

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of the score of each query (row) in each node (column)."""
        both = np.maximum(queries, 0) @ self.high_box.T + np.minimum(queries, 0) @ self.low_box.T
        # Sums beyond 53 bits are rounded; a little more keeps them upper bounds.
        return both if self.exact(queries) else both + np.abs(both) * 1e-9 + 1.0

    def exact(self, queries: np.ndarray) -> bool:
        return self.largest * float(np.abs(queries).max(initial=0)) * max(1, queries.shape[1]) < 2.0**53

    def search(self, query: np.ndarray, own: int, bounds: np.ndarray, k: int, bar: int | None, exact: bool) -> list[tuple[int, int]]:
        """(score, -id) of the best ``k`` rows that reach ``bar``, not of id ``own``."""
        best: list[tuple[int, int]] = []
        queue = [(-bounds[0], 0)]
        whole = None if exact else [int(x) for x in query]
        while queue:
            bound, node = heapq.heappop(queue)
            least = best[0][0] if len(best) == k else bar
            if least is not None and -bound < least:
                break
            leaf = self.leaves[node]
            if leaf is None:
                for child in self.children[node]:
                    heapq.heappush(queue, (-bounds[child], child))
                continue
            if exact:
                scores = self.rows[leaf] @ query
                near = np.flatnonzero(scores >= least) if least is not None else range(len(leaf))
            else:
                scores = [max(-_LONG - 1, min(_LONG, sum(a * int(b) for a, b in zip(whole, row)))) for row in self.rows[leaf]]
                near = range(len(leaf))
            for i in near:
                vec_id, score = int(self.ids[leaf[i]]), int(scores[i])
                if vec_id == own or (bar is not None and score < bar):
                    continue
                if len(best) < k:
                    heapq.heappush(best, (score, -vec_id))
                elif (score, -vec_id) > best[0]:
                    heapq.heapreplace(best, (score, -vec_id))
        return best


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tree = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                r = {n: batch.column(n)[row].as_py() for n in batch.schema.names if n not in ("ids", "values")}
                if held != (r["dim"], r["shard"]):
                    tree = Tree(*_unpack(batch.column("ids")[row].as_py(), batch.column("values")[row].as_py(), r["kind"], r["dim"]))
                    held = (r["dim"], r["shard"])
                own, queries = _unpack(r["q_ids"], r["q_values"], r["q_kind"], r["dim"])
                bars = r["bars"] or [None] * len(own)
                bounds, exact = tree.bounds(queries), tree.exact(queries)
                out: list[tuple[int, int, int, int]] = []
                for at in range(len(own)):
                    found = tree.search(queries[at], int(own[at]), bounds[at], k, bars[at], exact)
                    out.extend((at, int(own[at]), -v, s) for s, v in found)
                if out:
                    at, query, vec, score = (pa.array(c, pa.int64()) for c in zip(*out))
                    n = len(out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["home"]] * n, pa.int64()), pa.array([r["part"]] * n, pa.int64()), at, pa.array([r["dim"]] * n, pa.int32()), query, vec, score],
                        ["home", "part", "at", "dim", "query_id", "vec_id", "score"],
                    )

    return run


def _pack(rows: DataFrame, scale: int, *keys: str) -> DataFrame:
    """One row per key: ids and scaled vectors as bytes."""

    def pack(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        flat = np.asarray(table.column("embedding").combine_chunks().flatten(), np.float64)
        values = np.floor(flat * scale)
        kind = "<i2" if np.abs(values).max(initial=0) < 1 << 15 else "<f8"
        return pa.table({
            **{k: table.column(k).slice(0, 1).cast(pa.int32() if k == "dim" else pa.int64()) for k in keys},
            "ids": pa.array([table.column("vec_id").to_numpy().astype("<i8").tobytes()], pa.binary()),
            "values": pa.array([values.astype(kind).tobytes()], pa.binary()),
            "kind": [kind],
        }) if dim is not None else None

    columns = ", ".join(f"{k} {'int' if k == 'dim' else 'bigint'}" for k in keys)
    return rows.groupBy(*keys).applyInArrow(pack, f"{columns}, ids binary, values binary, kind string")


def top_products(vectors: DataFrame, every: int = EVERY, k: int = K, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best inner products of each query."""
    sound = F.col("vec_id").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(sound).select(
        F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>").alias("embedding"), F.size("embedding").alias("dim")
    )
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    parts = max(1, -(-SHARD_ROWS // (every * BLOCK_QUERIES)))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shards)))
    packed = cut_lineage(_pack(dealt, scale, "dim", "shard"))
    asked = dealt.where(F.col("vec_id") % every == 0).withColumnsRenamed({"shard": "home"}).withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(parts)))
    blocks = cut_lineage(_pack(asked, scale, "dim", "home", "part").withColumnsRenamed({"ids": "q_ids", "values": "q_values", "kind": "q_kind"}))

    no_bars = F.lit(None).cast("array<bigint>")
    first = cut_lineage(
        packed.join(blocks.withColumn("shard", F.col("home")).withColumn("bars", no_bars), ["dim", "shard"]).mapInArrow(_search(k), _FOUND)
    )
    # A query with fewer than k rows in its first shard has no bar yet.
    key = ["dim", "home", "part"]
    bars = first.groupBy(*key, "at").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    bars = bars.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("at", F.when(F.col("n") >= k, F.col("least"))))).alias("by_place"))
    places = F.sequence(F.lit(0), (F.octet_length("q_ids") / 8).cast("int") - 1)
    carried = blocks.join(bars, key, "left").withColumn(
        "bars", F.transform(places, lambda at: F.try_element_at(F.coalesce("by_place", F.expr("map(0L, cast(null as bigint))")), at.cast("bigint")))
    ).drop("by_place")
    # Every other shard is one row of work for each block of stated queries.
    spread = carried.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint")))).where(F.col("shard") != F.col("home"))
    rest = packed.join(spread, ["dim", "shard"]).mapInArrow(_search(k), _FOUND)
    ranked = Window.partitionBy(*key, "at").orderBy(F.desc("score"), "vec_id")
    return (
        first.unionByName(rest).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

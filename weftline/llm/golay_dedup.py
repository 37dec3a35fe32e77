"""Near-duplicate documents: 64-bit SimHash fingerprints, Golay-code keys, connected groups.

A fingerprint is cut into three segments. Two fingerprints with four differing bits at most
have two segments with two differing bits between them at most (the pigeonhole rule: were it
three, the third segment would have two or more, five in all). A segment is looked up in the
perfect (23, 12) Golay code: it and its neighbours at one bit decode to at most a few
codewords, and two segments that differ in two bits at most share one, since the word between
them is a neighbour of both. So each pair of segments gives keys (codeword, codeword), and
linked fingerprints share a key in at least one pair. Inside a key fingerprints are compared
exactly; nothing that shares no key can be linked, so the result is exact.

Copies and documents of equal fingerprints are one node. Inside a key only a spanning forest
is emitted, never all pairs; its links join up to the same groups.

All this is the query's contract. ``keep_one`` takes the same links as candidates, verifies them by
shingle similarity, and finds the similar texts whose fingerprints are farther apart besides.

Nulls and texts without words have fingerprint zero. Null ids take part, and a group's id is
the smallest id that is not null. Repeated rows come out as often as they come in. An empty
table gives an empty result. Further columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import as_signed, components, forest, key_runs, map_batches, mixed, popcount, table_partitions, whole_keys, word_hashes, words_of
from weftline.session import cut_lineage

SEED = 42
ERRORS = 4
#: (lowest bit, width) of the segments of a fingerprint.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fixed value: generator polynomial of the perfect binary Golay code, x^11+x^9+x^7+x^6+x^5+x+1.
GENERATOR = 0b101011100011
#: A segment and its neighbours at one bit decode to so many codewords at most.
_NEAR = 6
#: Jaccard similarity of shingles that links the documents of a table that is to keep one of each group.
SIMILARITY = 0.8
#: Shingles that more sets begin with come last in the common order; bits of the map that
#: marks them; neighbours under a key that are judged first.
FREQUENT = 16
MAP_BITS = 26
STEPS = 2
# Odd step of the hash over the words of a shingle.
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def fingerprint(text: str | None, width: int = 4) -> int:
    """Majority bits of the hashes of all ``width``-word shingles, repeats included."""
    words = words_of(text)
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-width])).tolist()
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())], "<u8")
    # A very long text is counted in slices, so memory stays bounded.
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 4, text: str = "text") -> DataFrame:
    """``docs`` as (doc_id, fp): the fingerprint as a signed number."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column(1)), np.uint64, batch.num_rows)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(as_signed(fps))], ["doc_id", "fp"])

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), F.col(text).cast("string")), work, "doc_id bigint, fp bigint")


@cache
def _decoder() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low and high halves of a word, and the error pattern of each syndrome."""

    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    single = [remainder(1 << b) for b in range(23)]

    def halves(bits: list[int]) -> np.ndarray:
        table = np.zeros(1 << len(bits), np.int32)
        for i, s in enumerate(bits):
            table[1 << i : 2 << i] = table[: 1 << i] ^ s
        return table

    errors = np.zeros(1 << 11, np.int32)
    for a in range(23):
        for b in range(a, 23):
            for c in range(b, 23):
                # Equal bits count once: patterns of one, two and three bits.
                bits = {a, b, c}
                pattern = sum(1 << x for x in bits)
                syndrome = 0
                for x in bits:
                    syndrome ^= single[x]
                errors[syndrome] = pattern
    return halves(single[:12]), halves(single[12:]), errors


def codeword_index(words: np.ndarray) -> np.ndarray:
    """Number of the codeword nearest to each 23-bit word."""
    low, high, errors = _decoder()
    words = words.astype(np.int32)
    return ((words ^ errors[low[words & 4095] ^ high[words >> 12]]) >> 11).astype(np.int32)


def near_indices(words: np.ndarray, width: int) -> np.ndarray:
    """Codewords that each word or a neighbour at one of its ``width`` bits decodes to; -1 fills up."""
    flips = np.concatenate(([0], 1 << np.arange(width))).astype(np.int32)
    found = np.sort(codeword_index(words.astype(np.int32)[:, None] ^ flips[None, :]), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = 1 << 20
    found = np.sort(found, axis=1)[:, :_NEAR]
    return np.where(found == 1 << 20, -1, found)


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, row of ``fps``) for every pair of segments and codewords."""
    near = []
    for low, width in SEGMENTS:
        near.append(near_indices((fps.view(np.uint64) >> np.uint64(low)) & np.uint64((1 << width) - 1), width))
    keys, rows = [], []
    for pair, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        left, right = near[a][:, :, None].astype(np.int64), near[b][:, None, :].astype(np.int64)
        both = np.where((left < 0) | (right < 0), -1, (pair << 24) | (left << 12) | right).reshape(len(fps), -1)
        at, column = np.nonzero(both >= 0)
        keys.append(both[at, column])
        rows.append(at)
    return np.concatenate(keys), np.concatenate(rows)


def links_inside_keys(keyed: DataFrame, errors: int = ERRORS) -> DataFrame:
    """(a, b) of fingerprints under a common key that differ in ``errors`` bits at most: a forest per key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_keys(batches, "key"):
            keys, fps = table.column("key").to_numpy(), table.column("fp").to_numpy()
            found = [np.zeros((0, 2), np.int64)]
            for step in range(1, 9):
                near = np.flatnonzero((keys[step:] == keys[:-step]) & (popcount(fps[step:] ^ fps[:-step]) <= errors))
                found.append(np.stack([fps[near], fps[near + step]], axis=1))
            for start, end in key_runs(keys):
                if end - start > 9:
                    own = fps[start:end]
                    linked = forest(own, errors)
                    if linked:
                        found.append(own[np.array(linked)])
            pairs = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
            pairs = pairs[pairs[:, 0] != pairs[:, 1]]
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    sorted_keys = keyed.repartition(table_partitions(keyed), "key").sortWithinPartitions("key")
    return sorted_keys.mapInArrow(run, "a bigint, b bigint")


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """(a, b) of fingerprints in ``distinct`` (fp, ...) that join up to the groups of all that are linked."""

    def expand(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = batch.column(0).to_numpy()
        keys, rows = golay_keys(fps)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[rows])], ["key", "fp"])

    return links_inside_keys(map_batches(distinct.select("fp"), expand, "key bigint, fp bigint"))


def fingerprint_groups(prints: DataFrame) -> DataFrame:
    """(fp, component_id) of every fingerprint in ``prints`` (doc_id, fp)."""
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    grouped = components(fingerprint_links(distinct))
    head = F.coalesce("component", "fp")
    named = distinct.join(grouped, distinct["fp"] == grouped["node"], "left").select("fp", "least", head.alias("head"))
    heads = named.groupBy("head").agg(F.min("least").alias("component_id"))
    return named.join(heads, "head").select("fp", "component_id")


def hex_of(fp: str | Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, width: int = 4, text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``."""
    prints = cut_lineage(fingerprints(docs, width, text))
    groups = fingerprint_groups(prints)
    return prints.join(groups, "fp", "left").select("doc_id", hex_of("fp").alias("fingerprint"), "component_id")


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``width``-word shingles; a shorter text is one shingle."""
    buf = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    words = word_hashes(buf, (buf != 32) & ((buf < 9) | (buf > 13)))[1] if len(buf) else np.zeros(0, np.uint64)
    size = max(min(len(words), 1), len(words) - width + 1)
    hashes = np.zeros(size, np.uint64)
    for at in range(min(len(words), width)):
        hashes = mixed(hashes * _STEP + words[at : at + size])
    return np.unique(hashes)


def _set_id(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED)


def _needed(size: int) -> int:
    """Shingles that a set must share at least with a set that is similar enough."""
    return math.ceil(SIMILARITY * size - 1e-9)


def _ordered(hashes: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The set in the order common to all sets: shingles that are marked as frequent come last."""
    place = hashes & np.uint64((1 << MAP_BITS) - 1)
    marked = (often[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1
    return hashes[np.argsort(marked, kind="stable")]


def _frequent(texts: DataFrame, width: int):
    """Broadcast bit map, of fixed size, of shingles that many sets begin with."""

    def begin(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.zeros(0, np.uint64)]
        for text in batch.column(0):
            own = shingle_set(text.as_py(), width)
            found.append(own[: 2 * (len(own) - _needed(len(own)) + 1)])
        return pa.RecordBatch.from_arrays([pa.array(as_signed(np.concatenate(found)))], ["key"])

    counts = map_batches(texts.select("text"), begin, "key bigint").groupBy("key").count().where(F.col("count") > FREQUENT)
    bits = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    for row in counts.select(F.col("key").bitwiseAND(F.lit((1 << MAP_BITS) - 1)).alias("bit")).distinct().toLocalIterator():
        bits[row["bit"] >> 3] |= 1 << (row["bit"] & 7)
    return texts.sparkSession.sparkContext.broadcast(bits.tobytes())


_KEYED = "key bigint, node bigint, size int, place int, parity bigint"


def prefix_keys(texts: DataFrame, width: int) -> DataFrame:
    """The shingles each set of ``texts`` (node, text) begins with, so many that similar sets share one."""
    often = _frequent(texts, width)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        marked = np.frombuffer(often.value, np.uint8)
        keys, sizes, parities = [np.zeros(0, np.uint64)], [], []
        for text in batch.column(1):
            own = shingle_set(text.as_py(), width)
            keys.append(_ordered(own, marked)[: len(own) - _needed(len(own)) + 1] if len(own) else own)
            sizes.append(len(own))
            parities.append(np.bitwise_xor.reduce(np.uint64(1) << (own & np.uint64(63)), initial=np.uint64(0)))
        counts = [len(k) for k in keys[1:]]
        row = np.repeat(np.arange(batch.num_rows), counts)
        place = np.concatenate([np.zeros(0, np.int64), *[np.arange(c) for c in counts]])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(as_signed(np.concatenate(keys))), batch.column(0).take(pa.array(row)), pa.array(np.array(sizes, np.int32)[row]),
                pa.array(place.astype(np.int32)), pa.array(as_signed(np.array(parities, np.uint64)[row])),
            ],
            [c.split()[0] for c in _KEYED.split(", ")],
        )

    return map_batches(texts.select("node", "text"), work, _KEYED)


def _pairs_under_keys(keyed: DataFrame, steps: int | None) -> DataFrame:
    """(a, b): nodes of different ``label`` under a common key that may be similar enough.

    Compared are neighbours up to ``steps`` places apart in the order of size, or all of a key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_keys(batches, "key"):
            keys, nodes, labels, parity = (table.column(c).to_numpy() for c in ("key", "node", "label", "parity"))
            size, place = (table.column(c).to_numpy().astype(np.int64) for c in ("size", "place"))
            at, step = np.arange(len(keys)), 0
            while steps is None or step < steps:
                step += 1
                at = at[at + step < len(keys)]
                # Sizes grow inside a key: what is too large now is so at every further step.
                at = at[(keys[at + step] == keys[at]) & (size[at] + 1e-9 >= SIMILARITY * size[at + step])]
                if not len(at):
                    break
                to = at + step
                both = size[at] + size[to]
                # At the first shingle they share, no more than what follows it can be shared;
                # shingles that only one has leave at least the bits in which the parities differ.
                shared = np.minimum(size[at] - place[at], size[to] - place[to])
                near = (labels[at] != labels[to]) & ((1 + SIMILARITY) * shared + 1e-9 >= SIMILARITY * both)
                near &= (1 + SIMILARITY) * popcount(parity[at] ^ parity[to]) <= (1 - SIMILARITY) * both + 1e-9
                if near.any():
                    pairs = np.unique(np.sort(np.stack([nodes[at[near]], nodes[to[near]]], axis=1), axis=1), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    dealt = keyed.repartition(table_partitions(keyed), "key").sortWithinPartitions("key", "size", "node")
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def _similar(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose shingle sets have a Jaccard similarity of ``SIMILARITY`` or more."""

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(t.as_py(), width).tobytes() for t in batch.column(1)], pa.binary())], ["node", "hashes"])

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        holds = []
        for x, y in zip(batch.column(2), batch.column(3)):
            a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            shared = len(np.intersect1d(a, b, assume_unique=True))
            holds.append(shared + 1e-9 >= SIMILARITY * (len(a) + len(b) - shared))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(holds, pa.bool_()))

    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    found = cut_lineage(map_batches(texts.join(ends, "node", "left_semi").select("node", "text"), sets, "node bigint, hashes binary"))
    left = found.select(F.col("node").alias("a"), F.col("hashes").alias("left"))
    right = found.select(F.col("node").alias("b"), F.col("hashes").alias("right"))
    return map_batches(pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right"), judge, "a bigint, b bigint")


def fingerprint_pairs(texts: DataFrame, width: int) -> DataFrame:
    """(a, b): nodes of ``texts`` (node, text) with linked fingerprints, by Golay keys.

    Of the nodes of one fingerprint the least stands for all, and is paired with each.
    """
    prints = cut_lineage(fingerprints(texts.select(F.col("node").alias("doc_id"), "text"), width))
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    same = prints.join(distinct, "fp").select(F.col("least").alias("a"), F.col("doc_id").alias("b"))
    ends = [distinct.select(F.col("fp").alias(c), F.col("least").alias(f"node_{c}")) for c in "ab"]
    linked = fingerprint_links(distinct).join(ends[0], "a").join(ends[1], "b").select("node_a", "node_b")
    both = same.where(F.col("a") != F.col("b")).union(linked)
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def similar_groups(texts: DataFrame, width: int) -> DataFrame:
    """(node, component) of the nodes of ``texts`` (node, text; one row per shingle set) that are similar to another.

    Nodes with linked fingerprints and neighbours under a key are judged first, so that a large
    group is one before all pairs of what is still apart are judged.
    """
    keyed = cut_lineage(prefix_keys(texts, width))
    beside = _pairs_under_keys(keyed.withColumn("label", F.col("node")), STEPS)
    first = cut_lineage(fingerprint_pairs(texts, width).union(beside).distinct())
    links = cut_lineage(_similar(first, texts, width))
    grouped = cut_lineage(components(links)).withColumnRenamed("component", "label")
    labelled = keyed.join(grouped, "node", "left").withColumn("label", F.coalesce("label", "node"))
    rest = cut_lineage(_pairs_under_keys(labelled, None).join(first, ["a", "b"], "left_anti"))
    return components(links.unionByName(_similar(rest, texts, width)))


def keep_one(docs: DataFrame, width: int = 4) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the smallest id, then text.

    Texts are linked if the Jaccard similarity of their ``width``-word shingles is
    ``SIMILARITY`` or more. Candidates are texts whose fingerprints the Golay keys link. Those
    miss similar texts more than ``ERRORS`` bits apart, so every other such pair is found too:
    two sets that similar share a shingle among those they begin with, in any order common to
    all. All candidates are verified on whole sets. Texts without words are alike.
    Rows without an id are compared by text like the others; the columns stay as they are.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    # The hash of the whole row tells rows of one id apart, and is the same when a task runs again.
    tagged = rows.select(F.col("row.doc_id").cast("bigint").alias("doc_id"), F.xxhash64("row").alias("tie"), "row")
    text = F.col("row.text").cast("string").alias("text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        nodes = np.fromiter((_set_id(shingle_set(t.as_py(), width)) for t in batch.column(2)), np.uint64, batch.num_rows)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(as_signed(nodes))], ["doc_id", "tie", "node"])

    named = cut_lineage(map_batches(tagged.select("doc_id", "tie", text), work, "doc_id bigint, tie bigint, node bigint"))
    # A group's first row: smallest id, nulls last, then the row's hash.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie")).alias("first")
    by_node = cut_lineage(named.groupBy("node").agg(first))

    def of(firsts: DataFrame) -> DataFrame:
        own = firsts.select(F.col("first.doc_id").alias("_id"), F.col("first.tie").alias("_tie"), *[c for c in firsts.columns if c != "first"])
        alike = tagged["doc_id"].eqNullSafe(own["_id"]) & (tagged["tie"] == own["_tie"])
        return tagged.join(own, alike).dropDuplicates(["doc_id", "tie"])

    texts = cut_lineage(of(by_node).select("node", text))
    grouped = similar_groups(texts, width)
    heads = by_node.join(grouped, "node", "left").groupBy(F.coalesce("component", "node").alias("head"))
    return of(heads.agg(F.min("first").alias("first"))).select("row.*")

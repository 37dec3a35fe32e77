"""Benchmark passages in documents, with edits: exact pieces by the pigeonhole rule, then Myers.

Texts and items are compared in lower case, with ASCII punctuation and white space as single
blanks, byte by byte of UTF-8. An item of n bytes is cut into n // 10 pieces of ten bytes or
more and may have one error less than pieces, so at least one piece is there unchanged. Pieces
are found by their first eight bytes at every offset of a text. From a piece the search climbs
a binary tree over the item's pieces: a part of c pieces must match with c - 1 errors at most,
which Myers' bit-parallel distance decides, so most chance hits end at the first step.

Documents stay where they are. Items reach the tasks in slices of ``SLICE_BYTES``, one pass
over the documents per slice, so a benchmark of any size is searched whole.

Items under ten bytes must occur unchanged as whole words; empty or null items occur nowhere.
Null or empty texts hold nothing. Ids may be null. A repeated document or item row is reported
as often as it is there. Empty tables give empty results. Further columns are not looked at;
``drop_leaks`` passes all columns on.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import in_small_batches

PIECE = 10
SLICE_BYTES = 8 << 20
#: Bytes of text that are searched at a time.
BLOCK_BYTES = 1 << 20
_SLOTS = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_GAP = b"\0" * 8
_BLANKED = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def normal_form(text: str | None) -> bytes:
    return b" ".join((text or "").lower().encode("utf-8", "surrogatepass").translate(_BLANKED).split())


def edit_search(pattern: bytes, masks: dict[int, int], text: bytes) -> tuple[int, int]:
    """(fewest errors of ``pattern`` anywhere in ``text``, where that match ends first)."""
    size = len(pattern)
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, errors = full, 0, size
    best, end = size, 0
    get = masks.get
    for at, byte in enumerate(text):
        eq = get(byte, 0)
        level = eq | down
        same = ((((eq & up) + up) ^ up) | eq) & full
        plus = (down | ~(same | up)) & full
        minus = up & same
        if plus & top:
            errors += 1
        elif minus & top:
            errors -= 1
            if errors < best:
                best, end = errors, at + 1
        plus = (plus << 1) & full
        up = ((minus << 1) | ~(level | plus)) & full
        down = plus & level
    return best, end


def masks_of(pattern: bytes) -> dict[int, int]:
    found: dict[int, int] = {}
    for at, byte in enumerate(pattern):
        found[byte] = found.get(byte, 0) | 1 << at
    return found


class Item:
    """A benchmark item, its pieces, and the tree over them."""

    def __init__(self, item_id: int | None, text: bytes):
        self.item_id, self.text = item_id, text
        self.count = max(1, len(text) // PIECE)
        self.cuts = [j * len(text) // self.count for j in range(self.count + 1)]
        self._masks: dict[tuple[int, int], dict[int, int]] = {}

    @property
    def errors(self) -> int:
        return self.count - 1

    def path(self, piece: int) -> list[tuple[int, int]]:
        """Parts of the item that hold a piece, from two pieces up to the whole."""
        low, high, found = 0, self.count, []
        while high - low > 1:
            found.append((low, high))
            middle = (low + high) // 2
            low, high = (low, middle) if piece < middle else (middle, high)
        return found[::-1]

    def matches(self, low: int, high: int, text: bytes, at: int, piece: int) -> tuple[int, int, int] | None:
        """(errors, start, end) of pieces ``low`` to ``high`` around a hit of ``piece`` at ``at``."""
        allowed = high - low - 1
        begin, end = self.cuts[low], self.cuts[high]
        start = max(0, at - (self.cuts[piece] - begin) - allowed)
        window = text[start : at + (end - self.cuts[piece]) + allowed]
        pattern = self.text[begin:end]
        masks = self._masks.get((low, high))
        if masks is None:
            masks = self._masks[low, high] = masks_of(pattern)
        errors, stop = edit_search(pattern, masks, window)
        return None if errors > allowed else (errors, start, start + stop)


class Finder:
    """All items of a slice."""

    def __init__(self, items: list[tuple[int | None, bytes]]):
        self.items = [Item(i, t) for i, t in items if t]
        self.short = [(n, b" " + i.text + b" ") for n, i in enumerate(self.items) if len(i.text) < PIECE]
        rows = [(int.from_bytes(i.text[c : c + 8], "little"), n, j) for n, i in enumerate(self.items) if len(i.text) >= PIECE for j, c in enumerate(i.cuts[:-1])]
        rows.sort()
        self.heads = np.array([r[0] for r in rows], np.uint64)
        self.places = [(n, j) for _, n, j in rows]
        self.marked = np.zeros(_SLOTS, bool)
        self.marked[self._slot(self.heads)] = True
        # The piece beside, in the tree, a piece that has one: errors are one at most in both.
        self.beside = [self._sibling(n, j) for n, j in self.places]
        self.sizes = np.array([self.items[n].cuts[j + 1] - self.items[n].cuts[j] for n, j in self.places], np.int64)
        tails = [self.items[n].text[self.items[n].cuts[j + 1] - 8 : self.items[n].cuts[j + 1]] for n, j in self.places]
        self.tails = np.array([int.from_bytes(t, "little") for t in tails], np.uint64)
        halves = [self._halves(n, j, k) for (n, j), k in zip(self.places, self.beside)]
        self.lone = np.array([h is None for h in halves])
        self.half_at = np.array([[h[0] for h in own] if own else [0, 0] for own in halves], np.int64).reshape(-1, 2)
        self.half_is = np.array([[h[1] for h in own] if own else [0, 0] for own in halves], np.uint32).reshape(-1, 2)

    @staticmethod
    def _slot(heads: np.ndarray) -> np.ndarray:
        return ((heads * _MIX) >> np.uint64(44)).view(np.int64)

    def _sibling(self, n: int, j: int) -> int | None:
        item = self.items[n]
        path = item.path(j)
        if not path or path[0][1] - path[0][0] != 2:
            return None
        return path[0][0] if path[0][1] - 1 == j else path[0][1] - 1

    def _halves(self, n: int, j: int, k: int | None) -> list[tuple[int, int]] | None:
        """Where the halves of piece ``k`` begin, seen from piece ``j``, and their first four bytes."""
        if k is None:
            return None
        item = self.items[n]
        begin, middle = item.cuts[k], (item.cuts[k] + item.cuts[k + 1]) // 2
        return [(b - item.cuts[j], int.from_bytes(item.text[b : b + 4], "little")) for b in (begin, middle)]

    def _likely(self, whole: bytes, heads: np.ndarray, at: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Hits whose piece ends right, and beside which half a piece begins right, one byte off at most."""
        ends = at + self.sizes[k] - 8
        good = (ends < len(heads)) & (heads[np.minimum(ends, len(heads) - 1)] == self.tails[k])
        at, k = at[good], k[good]
        fours = np.ndarray((len(whole) - 3,), "<u4", whole, strides=(1,))
        near = self.lone[k]
        for half in (0, 1):
            for shift in (-1, 0, 1):
                place = np.clip(at + self.half_at[k, half] + shift, 0, len(fours) - 1)
                near |= fours[place] == self.half_is[k, half]
        kept = np.flatnonzero(good)
        return kept[near]

    def _near(self, text: bytes, at: int, n: int, j: int, k: int) -> bool:
        """Could piece ``k`` be beside piece ``j`` at ``at`` with one error? One half must be unchanged."""
        item = self.items[n]
        begin, end = item.cuts[k], item.cuts[k + 1]
        middle = (begin + end) // 2
        start = at + begin - item.cuts[j]
        around = text[max(0, start - 1) : start + end - begin + 1]
        return item.text[begin:middle] in around or item.text[middle:end] in around

    def search(self, texts: list[bytes]) -> list[tuple[int, int | None, int, int, int]]:
        """(row, item_id, errors, start, end): the best match of each item in each text."""
        whole = _GAP.join([*texts, b""])
        begins = np.cumsum([0] + [len(t) + 8 for t in texts])
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        if len(whole) > 8 and len(self.heads):
            heads = np.ndarray((len(whole) - 7,), "<u8", whole, strides=(1,))
            at = np.flatnonzero(self.marked[self._slot(heads)])
            found = heads[at]
            first = np.searchsorted(self.heads, found, "left")
            last = np.searchsorted(self.heads, found, "right")
            count = last - first
            hit_at = np.repeat(at, count)
            hit_k = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
            likely = self._likely(whole, heads, hit_at, hit_k)
            hit_at, hit_k = hit_at[likely], hit_k[likely]
            rows = np.searchsorted(begins, hit_at, "right") - 1
            for place, k, row in zip((hit_at - begins[rows]).tolist(), hit_k.tolist(), rows.tolist()):
                n, j = self.places[k]
                self._climb(texts[row], place, n, j, self.beside[k], row, best)
        for n, pattern in self.short:
            for row, text in enumerate(texts):
                start = (b" " + text + b" ").find(pattern)
                if start >= 0:
                    best[row, n] = (0, start, start + len(pattern) - 2)
        return [(row, self.items[n].item_id, *match) for (row, n), match in sorted(best.items())]

    def _climb(self, text: bytes, at: int, n: int, j: int, beside: int | None, row: int, best: dict) -> None:
        item = self.items[n]
        known = best.get((row, n))
        if known and (known[0] == 0 or known[1] <= at < known[2]):
            return
        if text[at : at + item.cuts[j + 1] - item.cuts[j]] != item.text[item.cuts[j] : item.cuts[j + 1]]:
            return
        if beside is not None and not self._near(text, at, n, j, beside):
            return
        match: tuple[int, int, int] | None = (0, at, at + len(item.text))
        for low, high in item.path(j):
            match = item.matches(low, high, text, at, j)
            if match is None:
                return
        if match and (known is None or match[0] < known[0]):
            best[row, n] = match


@lru_cache(2)
def _finder(items: tuple[tuple[int | None, bytes], ...]) -> Finder:
    return Finder(list(items))


def _blocks(texts: pa.Array) -> Iterator[list[bytes]]:
    block: list[bytes] = []
    size = 0
    for text in texts:
        own = normal_form(text.as_py())
        if block and size + len(own) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append(own)
        size += len(own)
    if block:
        yield block


def _slices(benchmark: DataFrame) -> Iterator[tuple[tuple[int | None, bytes], ...]]:
    """Items in normal form, ``SLICE_BYTES`` of them at a time or little more."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where(F.length("text") > 0)
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // SLICE_BYTES)
    for n in range(count):
        own = items.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(count)) == n).orderBy("item_id", "text").collect()
        yield tuple((r["item_id"], normal_form(r["text"])) for r in own)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, errors, start, end) for each item in each document; places are bytes of the normal form.

    ``start`` is where the window of the match begins, ``end`` where its best match ends.
    """
    schema = "doc_id bigint, item_id bigint, errors int, start bigint, end bigint"
    texts = in_small_batches(docs).select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    found = docs.sparkSession.createDataFrame([], schema)
    for items in _slices(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            finder = _finder(shared.value)
            for batch in batches:
                begin, rows = 0, []
                for block in _blocks(batch.column(1)):
                    rows.extend((begin + r, *rest) for r, *rest in finder.search(block))
                    begin += len(block)
                if rows:
                    at, *columns = zip(*rows)
                    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at)), *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["doc_id", "item_id", "errors", "start", "end"]
                    )

        found = found.unionByName(texts.mapInArrow(_one_argument(run), schema))
    return found


def _one_argument(run):
    return lambda batches: run(batches)


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any benchmark item, as they are."""
    at = docs.columns.index("text")
    schema = docs.schema
    for items in _slices(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            finder = _finder(shared.value)
            for batch in batches:
                begin, leaks = 0, set()
                for block in _blocks(batch.column(at)):
                    leaks.update(begin + r[0] for r in finder.search(block))
                    begin += len(block)
                yield batch.filter(pa.array([n not in leaks for n in range(batch.num_rows)], pa.bool_()))

        docs = in_small_batches(docs).mapInArrow(_one_argument(run), schema)
    return docs

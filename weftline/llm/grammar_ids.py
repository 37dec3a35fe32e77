"""Token ids of a document table as grammar-compressed shards with random access.

Documents are sorted by id across partitions; each task encodes its rows and closes a shard
about every ``SHARD_IDS`` ids. A shard is compressed by Re-Pair: in each round the most
frequent pairs of neighbouring symbols are replaced by new symbols, their rules, until no pair
is left that pays for a rule. A shard is one row of a Parquet table: rules, expansion length of
each rule, the reduced sequence, and the ids and lengths of its documents. Lengths tell which
symbols, and which halves of a rule, hold a wanted range, so a document is decoded without its
neighbours.

Pairs are counted exactly. Equal doc_ids lie next to each other in the order of their
texts' hashes, null ids come first. A null text is empty, and has its end id alone. Strings of
special tokens are those tokens, as in the library. An empty table gives no shards. Further
columns are not looked at.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from weftline.llm.common import in_small_batches, table_partitions, text_or_empty

END_ID = 0
SHARD_IDS = 1 << 20
#: How often a pair must occur: a rule takes 12 bytes with its length, a replaced pair gives back 4.
LEAST = 4
#: A round replaces the pairs that occur at least as often as the most frequent one divided by this.
SPREAD = 4
PIECE_CHARS = 4_000_000
CACHE_PIECES = 300_000
#: Places of the table that sorts out rare pairs, and multipliers of its hash.
_SLOT_BITS = 20
_MARKS = ".,!?;:"
# Fixed value: how the byte-level form cuts what holds no white space.
_CUT = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+")
#: Characters below this have had their classes since long, so any two libraries cut them alike.
_SETTLED = "\u0250"
_LEFT, _RIGHT = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)

_SCHEMA = (
    "part int, shard int, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, base int, width int, "
    "rules binary, rule_lengths binary, symbols binary"
)


def _byte_marks() -> list[str]:
    """The character that stands for each byte: its own if it can be seen, else one from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (256 + n for n in range(256))
    return [chr(b) if b in seen else chr(next(hidden)) for b in range(256)]


def _is_plain_byte_level(tokenizer: Tokenizer) -> bool:
    """Does the file cut and mark bytes in the common form, and merge without options?"""
    file = json.loads(tokenizer.to_str())
    cut, model = file["pre_tokenizer"] or {}, file["model"]
    usual = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")
    return bool(usual) and file["normalizer"] is None and model["type"] == "BPE" and not any(model.get(o) for o in options)


class ByteEncoder:
    """Ids of whole texts, each distinct piece between blanks encoded once.

    In a text without two blanks in a row every blank belongs to the piece after it, so pieces
    can be encoded alone. Other texts, and texts with special tokens, are encoded whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = "<u2" if self.size <= 1 << 16 else "<u4"
        self._pieces: dict[str, bytes] = {}
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self._line = line[0] if len(line) == 1 else None
        self._merge = self.tokenizer.model.tokenize if _is_plain_byte_level(self.tokenizer) else None
        self._bytes = {b: c for b, c in enumerate(_byte_marks()) if b not in (9, 10)}

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _encoded_pieces(self, pieces: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids of pieces with a blank before each, many at a time with line feeds between.

        A line feed before a blank is a token of its own, so its id tells the pieces apart;
        pieces with white space inside are encoded one by one. Letters and the marks after them
        are never in one token, so a word with marks is the word and the marks.
        """
        plain: set[str] = set()
        odd: list[str] = []
        marked: list[tuple[str, str, str]] = []
        for p in pieces:
            word = p.rstrip(_MARKS)
            if word != p and word.isalpha():
                marked.append((p, word, p[len(word) :]))
            elif self._line is not None and p.split() == [p]:
                plain.add(p)
            else:
                odd.append(p)
        known = self._pieces
        plain.update([word for _, word, _ in marked if word not in known])
        found = dict(self._encoded_plain(list(plain)))
        marks = sorted({m for _, _, m in marked})
        ends = dict(zip(marks, self._encoded(marks)))
        yield from found.items()
        yield from zip(odd, self._encoded([" " + p for p in odd]))
        for p, word, m in marked:
            yield p, (found.get(word) or known[word]) + ends[m]

    def _merged(self, pieces: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids of pieces of settled characters with a blank before each, asked of the model alone.

        All are marked in one go. Pieces hold no white space, so line feeds and tabs tell pieces
        and their parts apart.
        """
        cuts = ["\t".join(_CUT.findall(" " + p)) if not p.isalpha() else " " + p for p in pieces]
        marked = "\n".join(cuts).encode().decode("latin-1").translate(self._bytes).split("\n")
        code, merge = np.dtype(self.kind).char, self._merge
        for piece, parts in zip(pieces, marked):
            yield piece, array(code, [t.id for part in parts.split("\t") for t in merge(part)]).tobytes()

    def _encoded_plain(self, plain: list[str]) -> Iterator[tuple[str, bytes]]:
        if self._merge is not None:
            settled = [p for p in plain if p.isascii() or max(p) < _SETTLED]
            yield from self._merged(settled)
            if len(settled) == len(plain):
                return
            plain = [p for p in plain if max(p) >= _SETTLED]
        if self._line is None:
            yield from zip(plain, self._encoded([" " + p for p in plain]))
            return
        for at in range(0, len(plain), 4096):
            some = plain[at : at + 4096]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + "\n ".join(some)], add_special_tokens=False)[0].ids, self.kind)
            ends = np.flatnonzero(ids == self._line).tolist()
            if len(ends) != len(some) - 1:
                yield from zip(some, self._encoded([" " + p for p in some]))
                continue
            raw, width = ids.tobytes(), ids.itemsize
            for piece, a, b in zip(some, [0, *[e + 1 for e in ends]], [*ends, len(ids)]):
                yield piece, raw[a * width : b * width]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian numbers of ``kind``."""
        whole = [t for t in texts if "  " in t or any(s in t for s in self.special)]
        done = dict(zip(whole, self._encoded(whole)))
        cut = [None if t in done else (" " + t).split(" ")[1:] if t[:1] == " " else t.split(" ") for t in texts]
        first = {c[0] for c in cut if c}
        rest: set[str] = set()
        for c in cut:
            if c:
                rest.update(c[1:])
        new = [p for p in rest if p not in self._pieces]
        found = list(self._encoded_pieces(new))
        if len(self._pieces) + len(found) > CACHE_PIECES:
            self._pieces = {p: b for p, b in self._pieces.items() if p in rest}
        self._pieces.update(found)
        heads = list(first)
        heads = dict(zip(heads, self._encoded(heads)))
        known = self._pieces
        for text, own in zip(texts, cut):
            yield done[text] if own is None else heads[own[0]] + b"".join([known[p] for p in own[1:]])


@lru_cache(2)
def _encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


@dataclass
class Grammar:
    """Symbols from ``base`` on stand for the pairs in ``rules``, which hold earlier symbols only.

    ``lengths`` are the rules' expansions'; they are found from the rules if not given.
    """

    base: int
    rules: np.ndarray
    symbols: np.ndarray
    lengths: np.ndarray | None = None

    def __post_init__(self) -> None:
        if self.lengths is None:
            found: list[int] = []
            for pair in self.rules.tolist():
                found.append(sum(1 if s < self.base else found[s - self.base] for s in pair))
            self.lengths = np.array(found, np.int64)

    def sizes(self, symbols: np.ndarray) -> np.ndarray:
        """Expansion length of each symbol."""
        found = np.ones(len(symbols), np.int64)
        ruled = symbols >= self.base
        found[ruled] = self.lengths[symbols[ruled] - self.base]
        return found

    def expand(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop``; symbols and halves of rules outside are never expanded."""
        sizes = self.sizes(self.symbols)
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        stop = total if stop is None else min(stop, total)
        if stop <= start:
            return np.zeros(0, np.uint32)
        out = np.empty(stop - start, np.uint32)
        low, high = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
        own, at = self.symbols[low:high], (ends - sizes)[low:high] - start
        while len(own):
            leaf = own < self.base
            out[at[leaf]] = own[leaf]
            pairs, at = self.rules[own[~leaf] - self.base], at[~leaf]
            middle = at + self.sizes(pairs[:, 0])
            own, at, end = pairs.T.ravel(), np.concatenate((at, middle)), np.concatenate((middle, middle + self.sizes(pairs[:, 1])))
            inside = (end > 0) & (at < len(out))
            own, at = own[inside], at[inside]
        return out


def _frequent(codes: np.ndarray, slot: np.ndarray, least: int) -> np.ndarray:
    """Pairs to replace in this round, in order, each of them ``least`` times there or more."""
    crowd = np.bincount(slot, minlength=1 << _SLOT_BITS)
    wanted = max(least, int(crowd.max()) // SPREAD)
    while True:
        # A pair is as frequent as its place at most, so what lies in rare places need not be sorted.
        ordered = np.sort(codes[crowd[slot] >= wanted])
        heads = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, np.int64)
        counts = np.diff(np.append(heads, len(ordered)))
        most = int(counts.max()) if len(counts) else 0
        if most >= wanted or wanted == least:
            return ordered[heads[counts >= wanted]]
        wanted = max(least, wanted // SPREAD)


def compress(ids: np.ndarray, base: int, least: int = LEAST) -> Grammar:
    """Grammar of a sequence of ids below ``base`` in which no pair is left ``least`` times."""
    seq = ids.astype(np.uint32)
    grammar = Grammar(base, np.zeros((0, 2), np.uint32), seq, np.zeros(0, np.int64))
    while len(seq) >= 2 * least:
        left, right = seq[:-1], seq[1:]
        codes = left.astype(np.uint64) << np.uint64(32) | right
        slot = (left * _LEFT + right * _RIGHT) >> np.uint32(32 - _SLOT_BITS)
        chosen = _frequent(codes, slot, least)
        if not len(chosen):
            break
        open_slots = np.zeros(1 << _SLOT_BITS, bool)
        halves = np.stack([chosen >> np.uint64(32), chosen & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32)
        open_slots[(halves[:, 0] * _LEFT + halves[:, 1] * _RIGHT) >> np.uint32(32 - _SLOT_BITS)] = True
        at = np.flatnonzero(open_slots[slot])
        which = np.minimum(np.searchsorted(chosen, codes[at]), len(chosen) - 1)
        hit = chosen[which] == codes[at]
        at, which = at[hit], which[hit]
        # Of pairs that overlap, every second one counted from the left is replaced.
        heads = np.concatenate(([True], np.diff(at) != 1))
        run = np.maximum.accumulate(np.where(heads, np.arange(len(at)), 0))
        taken = (np.arange(len(at)) - run) % 2 == 0
        at, which = at[taken], which[taken]
        used, number = np.unique(which, return_inverse=True)
        seq[at] = (base + len(grammar.rules) + number).astype(np.uint32)
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[keep]
        rules = halves[used]
        lengths = grammar.sizes(rules[:, 0]) + grammar.sizes(rules[:, 1])
        grammar = Grammar(base, np.concatenate((grammar.rules, rules)), seq, np.concatenate((grammar.lengths, lengths)))
    return grammar


def _shards(path: str, end_id: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(path)
        base = max(own.size, end_id + 1)
        end = np.array([end_id], own.kind).tobytes()
        part, number = TaskContext.get().partitionId(), 0
        docs: list[int | None] = []
        texts: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal docs, texts, size, number
            lengths = np.array([len(t) for t in texts]) // np.dtype(own.kind).itemsize
            grammar = compress(np.frombuffer(b"".join(texts), own.kind), base)
            kind = "<u2" if base + len(grammar.rules) <= 1 << 16 else "<u4"
            row = [
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([int(lengths.sum())]),
                pa.array([docs], pa.list_(pa.int64())), pa.array([lengths.tolist()], pa.list_(pa.int64())),
                pa.array([base], pa.int32()), pa.array([np.dtype(kind).itemsize], pa.int32()),
                pa.array([grammar.rules.astype("<u4").tobytes()]), pa.array([grammar.lengths.astype("<u4").tobytes()]),
                pa.array([grammar.symbols.astype(kind).tobytes()]),
            ]
            docs, texts, size, number = [], [], 0, number + 1
            return pa.RecordBatch.from_arrays(row, [c.split()[0] for c in _SCHEMA.split(", ")])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                some, chars = [], 0
                while at + len(some) < batch.num_rows and (not some or chars < PIECE_CHARS):
                    some.append(batch.column(1)[at + len(some)].as_py())
                    chars += len(some[-1])
                for doc, ids in zip(batch.column(0).slice(at, len(some)).to_pylist(), own.encode(some)):
                    docs.append(doc)
                    texts.append(ids + end)
                    size += len(texts[-1]) // np.dtype(own.kind).itemsize
                    if size >= shard_ids:
                        yield close()
                at += len(some)
        if docs:
            yield close()

    return run


def compressed_shards(docs: DataFrame, path: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Shards in the order of (part, shard), documents in ascending order of doc_id."""
    rows = docs.select(F.col("doc_id").cast("bigint"), text_or_empty("text").alias("text"), F.xxhash64("text").alias("tie"))
    ordered = rows.repartitionByRange(table_partitions(docs), "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    return in_small_batches(ordered).mapInArrow(_shards(path, end_id, shard_ids), _SCHEMA)


def write_shards(docs: DataFrame, path: str, folder: str, end_id: int = END_ID) -> None:
    compressed_shards(docs, path, end_id).write.parquet(folder)


def grammar_of(row: dict) -> Grammar:
    """Grammar of a shard's row."""
    rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
    lengths = np.frombuffer(row["rule_lengths"], "<u4").astype(np.int64)
    return Grammar(row["base"], rules, np.frombuffer(row["symbols"], f"<u{row['width']}"), lengths)


def read_document(row: dict, at: int) -> np.ndarray:
    """Ids of the document at a place of a shard's row, its end id included."""
    lengths = row["lengths"]
    start = sum(lengths[:at])
    return grammar_of(row).expand(start, start + lengths[at])


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the shards of a folder."""
    shards = spark.read.parquet(folder)
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = shards.select("part", "shard", "n_ids")
    # One row per task of the writing job; the window over them holds nothing else.
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    parts = parts.select("part", F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    starts = sizes.withColumn("own", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part").select("part", "shard", (F.col("own") + F.col("before")).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = grammar_of(row).expand().astype("<u4")
                ends = np.cumsum(row["lengths"])
                begins = ends - row["lengths"]
                sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(begins + row["start"]), pa.array(row["lengths"], pa.int64()), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    columns = ["part", "shard", "doc_ids", "lengths", "base", "width", "rules", "rule_lengths", "symbols"]
    placed = shards.select(*columns).join(starts, ["part", "shard"]).drop("part", "shard")
    return placed.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")

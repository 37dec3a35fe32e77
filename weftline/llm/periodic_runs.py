"""Periodic runs of words, found in a grammar of the texts.

A run is a stretch of words with smallest period q (words q apart are identical) that is at least
``EXPONENT`` periods and ``LEAST_WORDS`` words long, and that neither neighbour prolongs.

The words of some megabytes of documents are compressed by Re-Pair: pairs of neighbouring symbols
that repeat become nonterminals, the most frequent first, until no pair repeats. What is left of
a document is read as a balanced tree of further nonterminals. A run lies in the expansion of the
lowest nonterminal that holds all of it and crosses the border of its two halves, so the runs that
cross a border are computed once for every nonterminal, inside its expansion; copies of a passage,
in whatever documents, share that work. What was found is then carried to all positions where the
nonterminal is derived, and of the intervals of one period those inside others are merged into
them: the longest are the runs.

Inside an expansion the periods that can cross its border are those whose square begins or ends at
the border (a run of four periods has two on one side). They are the places where the words at
the border occur again, which takes time linear in the expansion; expansions of one round of
Re-Pair, and of one level of the trees, do not overlap.

Documents are compressed where they lie, a batch of ``BATCH_BYTES`` at a time, a document never
cut; nothing is exchanged. Which documents share a batch changes the work, not the result.

A null text has no words. Rows are independent: repeated rows and null ids have their own results.
An empty table gives no rows. Of the input, ``doc_id`` and ``text`` are read; further columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import mixed

#: Periods and words of a run at least. The search rests on two periods to one side of a border.
EXPONENT = 4
LEAST_WORDS = 6
#: How often a pair must occur to become a nonterminal.
LEAST_PAIRS = 2
#: Bytes of text that are compressed together; a longer text is alone.
BATCH_BYTES = 8 << 20

_SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
#: Words compared at a possible period before its stretch is measured.
_PROBES = 12


@dataclass
class Round:
    """Nonterminals of one round: their two symbols, and one place where each is expanded."""

    left: np.ndarray
    right: np.ndarray
    begin: np.ndarray
    border: np.ndarray
    end: np.ndarray


@dataclass
class Grammar:
    """Re-Pair of a sequence. Symbols from ``base`` on are nonterminals, in the order of rounds."""

    base: int
    rounds: list[Round] = field(default_factory=list)
    symbols: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    begins: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


def _repeated(pairs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """How often the pair at each place occurs without overlap, 0 if less than ``least``; the first places count."""
    n = len(pairs)
    # In a row of one symbol every second pair counts.
    same = np.concatenate(([False], pairs[1:] == pairs[:-1]))
    at = np.arange(n)
    usable = (at - np.maximum.accumulate(np.where(same, 0, at))) % 2 == 0
    # Most pairs are alone in their place of a table of counts and need no sorting.
    bits = max(8, min(24, n.bit_length() + 1))
    place = (mixed(pairs.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
    often = np.flatnonzero(usable & (np.bincount(place[usable], minlength=1 << bits)[place] >= least))
    counts = np.zeros(n, np.int64)
    if len(often):
        order = often[np.argsort(pairs[often])]
        heads = np.flatnonzero(np.concatenate(([True], pairs[order[1:]] != pairs[order[:-1]])))
        sizes = np.diff(np.concatenate((heads, [len(order)])))
        counts[order] = np.repeat(np.where(sizes >= least, sizes, 0), sizes)
    return counts, place


def compress(words: np.ndarray, least: int = LEAST_PAIRS) -> Grammar:
    """Re-Pair of ``words`` until no pair occurs ``least`` times.

    A round replaces every pair that is more frequent than both pairs that overlap it, which
    the sequence of single replacements by falling frequency would replace too.
    """
    symbols = words.astype(np.int64)
    begins = np.arange(len(symbols))
    free = int(symbols.max()) + 1 if len(symbols) else 0
    grammar = Grammar(free)
    while len(symbols) >= 2 * least:
        pairs = symbols[:-1] * free + symbols[1:]
        counts, place = _repeated(pairs, least)
        # Frequency first, ties by the pair itself.
        rank = np.where(counts > 0, counts.astype(np.float64) + place / (1 << 25), 0.0)
        before = np.concatenate(([0.0], rank[:-1]))
        after = np.concatenate((rank[1:], [0.0]))
        # Different pairs of one rank: the left one.
        at = np.flatnonzero((rank > before) & (rank >= after) & (counts > 0))
        if not len(at):
            break
        order = at[np.argsort(pairs[at], kind="stable")]
        heads = np.flatnonzero(np.concatenate(([True], pairs[order[1:]] != pairs[order[:-1]])))
        sizes = np.diff(np.concatenate((heads, [len(order)])))
        paid = sizes >= least
        if not paid.any():
            # No pair keeps two places beside more frequent ones: the most frequent pair goes alone.
            at = np.flatnonzero(pairs == pairs[np.argmax(rank)])
            at = at[counts[at] > 0]
            order, heads, sizes, paid = at, np.array([0]), np.array([len(at)]), np.array([True])
        one = order[heads[paid]]
        ends = np.concatenate((begins[1:], [len(words)]))
        grammar.rounds.append(Round(symbols[one], symbols[one + 1], begins[one], begins[one + 1], ends[one + 1]))
        chosen = order[np.repeat(paid, sizes)]
        symbols[chosen] = free + np.repeat(np.arange(int(paid.sum())), sizes[paid])
        keep = np.ones(len(symbols), bool)
        keep[chosen + 1] = False
        symbols, begins = symbols[keep], begins[keep]
        free += int(paid.sum())
    grammar.symbols, grammar.begins = symbols, begins
    return grammar


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, number from 1) for ``counts`` items of each owner."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(1, len(owner) + 1) - np.repeat(np.cumsum(counts) - counts, counts)


def _reach(words: np.ndarray, at: int, period: int, step: int, room: int) -> int:
    """How many words from ``at`` on equal those a period further, in the direction ``step``."""
    done, size = 0, 64
    while done < room:
        size = min(size, room - done)
        a = at + step * done
        low = a if step > 0 else a - size + 1
        same = words[low : low + size] == words[low + period : low + period + size]
        if not same.all():
            return done + int(np.argmin(same if step > 0 else same[::-1]))
        done, size = done + size, 4 * size
    return done


def crossing(words: np.ndarray, begin: np.ndarray, border: np.ndarray, end: np.ndarray) -> np.ndarray:
    """(owner, start, end, period) of stretches of ``EXPONENT`` periods that cross the borders of intervals."""
    long = np.flatnonzero(end - begin >= LEAST_WORDS)
    begin, border, end = begin[long], border[long], end[long]
    most = (end - begin) // EXPONENT
    found: list[tuple[int, int, int, int]] = []
    for ahead in (True, False):
        # The square lies behind the border, or before it.
        owner, q = _spread(np.minimum(most, (end - border if ahead else border - begin) // 2))
        c = border[owner]
        # words[i] and words[i + q] on both sides of the border.
        first = c - 1 if ahead else c - q
        ok = (words[first] == words[first + q]) & (words[c] == words[c + q] if ahead else words[c - 1 - q] == words[c - 1])
        owner, q, first = owner[ok], q[ok], first[ok]
        for j in range(1, _PROBES):
            at = first + 1 + j if ahead else first - 1 - j
            ok = (j >= q) | (words[np.where(j < q, at, first)] == words[np.where(j < q, at, first) + q])
            if ok.all():
                continue
            owner, q, first = owner[ok], q[ok], first[ok]
        cuts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1], [True]))) if len(owner) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            low, high = int(begin[owner[a]]), int(end[owner[a]])
            rest, starts = q[a:b], first[a:b]
            while len(rest):
                period, at = int(rest[0]), int(starts[0])
                stop = at + period + _reach(words, at, period, 1, high - period - at)
                start = at - _reach(words, at - 1, period, -1, at - low)
                if stop - start >= max(LEAST_WORDS, EXPONENT * period):
                    found.append((int(long[owner[a]]), start, stop, period))
                # Multiples of the period inside the stretch say nothing new.
                new = (rest % period != 0) | (EXPONENT * rest > stop - start)
                new[0] = False
                rest, starts = rest[new], starts[new]
    return np.array(found, np.int64).reshape(-1, 4)


def _derived(grammar: Grammar, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nonterminal, position) of every place where a ``wanted`` nonterminal, numbered from 0, is derived."""
    base = grammar.base
    firsts = np.cumsum([0, *[len(r.left) for r in grammar.rounds]])
    above = np.concatenate((np.zeros(base, bool), wanted))
    for r, first in zip(grammar.rounds, firsts):
        above[base + first : base + first + len(r.left)] |= above[r.left] | above[r.right]
    at = np.flatnonzero(above[grammar.symbols])
    waiting = [(grammar.symbols[at], grammar.begins[at])]
    symbols, places = [], []
    for k in range(len(grammar.rounds) - 1, -1, -1):
        r, first = grammar.rounds[k], base + firsts[k]
        nodes = np.concatenate([n for n, _ in waiting])
        spots = np.concatenate([p for _, p in waiting])
        now = nodes >= first
        waiting = [(nodes[~now], spots[~now])]
        nodes, spots = nodes[now], spots[now]
        hit = wanted[nodes - base]
        symbols.append(nodes[hit] - base)
        places.append(spots[hit])
        own = nodes - first
        for child, shift in ((r.left[own], 0), (r.right[own], (r.border - r.begin)[own])):
            need = above[child]
            waiting.append((child[need], (spots + shift)[need]))
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(symbols or empty), np.concatenate(places or empty)


def runs_in(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(start, end, period) of all runs, by start, then period, in documents at ``starts`` to ``ends`` of ``words``.

    Between two documents ``words`` has a number of its own.
    """
    grammar = compress(words)
    pieces = []
    # Inside nonterminals, once each, then wherever they are derived.
    firsts = np.cumsum([0, *[len(r.left) for r in grammar.rounds]])
    inside = [crossing(words, r.begin, r.border, r.end) for r in grammar.rounds]
    inside = [np.column_stack((f[:, 0] + a, f[:, 1:3] - r.begin[f[:, 0], None], f[:, 3])) for f, r, a in zip(inside, grammar.rounds, firsts)]
    inside = np.concatenate(inside) if inside else np.zeros((0, 4), np.int64)
    if len(inside):
        wanted = np.zeros(int(firsts[-1]), bool)
        wanted[inside[:, 0]] = True
        nodes, places = _derived(grammar, wanted)
        inside = inside[np.argsort(inside[:, 0], kind="stable")]
        low, high = np.searchsorted(inside[:, 0], nodes, "left"), np.searchsorted(inside[:, 0], nodes, "right")
        owner, number = _spread(high - low)
        own = inside[low[owner] + number - 1]
        pieces.append(np.column_stack((own[:, 1] + places[owner], own[:, 2] + places[owner], own[:, 3])))
    # Over what is left of each document: a balanced tree, level by level.
    begins = grammar.begins
    doc = np.searchsorted(starts, begins, "right") - 1
    first, last = np.searchsorted(begins, starts, "left"), np.searchsorted(begins, ends, "left")
    number = np.arange(len(begins)) - first[doc] if len(begins) else begins
    bounds = np.concatenate((begins, [len(words)]))
    width = 1
    while len(begins) and width < int((last - first).max()):
        at = np.flatnonzero((number % (2 * width) == width) & (begins < ends[doc]))
        right = np.minimum(at + width, last[doc[at]])
        found = crossing(words, begins[at - width], begins[at], np.minimum(bounds[right], ends[doc[at]]))
        pieces.append(found[:, 1:])
        width *= 2
    return _merged(np.concatenate(pieces) if pieces else np.zeros((0, 3), np.int64))


def _merged(pieces: np.ndarray) -> np.ndarray:
    """The longest intervals of each period; one period for each interval, its smallest."""
    pieces = pieces[np.lexsort((-pieces[:, 1], pieces[:, 0], pieces[:, 2]))]
    kept, period, reach = [], -1, -1
    for start, end, q in pieces.tolist():
        if q != period:
            period, reach = q, -1
        if end > reach:
            kept.append((start, end, q))
            reach = end
    smallest: dict[tuple[int, int], int] = {}
    for start, end, q in kept:
        smallest[start, end] = min(q, smallest.get((start, end), q))
    return np.array(sorted((s, e, q) for (s, e), q in smallest.items()), np.int64).reshape(-1, 3)[:, :3]


def _described(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in batch.column("text").to_pylist()]
    sizes = np.array([len(t) for t in texts], np.int64)
    flat = [w for t in texts for w in t]
    coded = pa.array(flat, pa.binary()).dictionary_encode()
    ends = np.cumsum(sizes) + np.arange(len(sizes))
    starts = ends - sizes
    words = np.full(len(flat) + len(sizes), -1, np.int64)
    words[ends] = len(coded.dictionary) + np.arange(len(sizes))
    words[words < 0] = coded.indices.to_numpy(zero_copy_only=False)
    runs = runs_in(words, starts, ends)
    drop = np.zeros(len(words) + 1, np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 1], -1)
    keep = np.cumsum(drop) == 0
    low, high = np.searchsorted(runs[:, 0], starts, "left"), np.searchsorted(runs[:, 0], ends, "left")
    found, collapsed = [], []
    for text, a, b, i, j in zip(texts, starts.tolist(), ends.tolist(), low.tolist(), high.tolist()):
        found.append([{"start": s - a, "length": e - s, "period": q} for s, e, q in runs[i:j].tolist()])
        kept = text if i == j else [text[k] for k in np.flatnonzero(keep[a:b]).tolist()]
        collapsed.append(b" ".join(kept))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(sizes), pa.array(found, pa.list_(_RUN)), pa.array(collapsed, pa.binary()).cast(pa.string())],
        ["doc_id", "n_words", "runs", "collapsed"],
    )


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``BATCH_BYTES``, a row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = (np.cumsum(sizes) - sizes) // BATCH_BYTES
    cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield batch.slice(a, b - a)


def find_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: runs by start, then period, with word numbers from 0.

    ``collapsed`` has the words that no run contains after its first period, joined by one space.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from map(_described, _pieces(batch))

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, _SCHEMA)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): one document in ten repeats a stretch of itself up to its end, by the hash of its id."""
    hashed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select("doc_id", "text", hashed.alias("_h"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    rows = rows.withColumn("_words", F.when(F.col("_h") % 10 == 0, words))
    n, g = F.nullif(F.size("_words"), F.lit(0)), F.floor(F.col("_h") / 10)
    a = F.pmod(g, n)
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    rows = rows.withColumns({"_a": a.cast("int"), "_p": p.cast("int")})
    planted = F.transform("_words", lambda w, i: F.when(i < F.col("_a"), w).otherwise(F.get("_words", F.col("_a") + F.pmod(i - F.col("_a"), F.col("_p")))))
    return rows.select("doc_id", F.when(F.size("_words") > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def _closer(a: Column, b: Column) -> Column:
    """Order by falling length/period, then start, then period."""
    more = a["length"] * b["period"] - b["length"] * a["period"]
    return F.when(more != 0, -F.sign(more)).when(a["start"] != b["start"], F.sign(a["start"] - b["start"])).otherwise(F.sign(a["period"] - b["period"])).cast("int")


def digests(found: DataFrame) -> DataFrame:
    """What ``find_runs`` returned: the number of runs, the one of the greatest exponent, digests of runs and text."""
    best = F.get(F.array_sort("runs", _closer), 0)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )

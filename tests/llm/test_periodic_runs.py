"""Runs in a grammar against brute force: random, periodic and nested texts, copies, hard texts."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from llm.conftest import HARD, docs_of

from weftline.llm import periodic_runs

SPACE = " \t\n\x0b\x0c\r"


def plain_runs(words):
    """All maximal stretches of four periods and six words, by trying every period."""
    found = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_collapse(words, runs):
    drop = set()
    for start, length, q in runs:
        drop.update(range(start + q, start + length))
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def periodic_text(rng):
    parts = []
    for _ in range(rng.randint(0, 6)):
        own = [rng.choice("abcd") for _ in range(rng.randint(1, 7))]
        times = rng.choice([1, 2, 3, 4, 5, 9])
        block = own * times + own[: rng.randint(0, len(own))]
        if rng.random() < 0.3:
            block = (block + [rng.choice("abx")]) * rng.randint(1, 5)
        parts += block
    return " ".join(parts)


def found_in(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["doc_id", "text"])
    rows = [r for piece in periodic_runs._pieces(batch) for r in periodic_runs._described(piece).to_pylist()]
    return [([(r["start"], r["length"], r["period"]) for r in row["runs"]], row["collapsed"], row["n_words"]) for row in rows]


def test_runs_equal_brute_force(monkeypatch):
    rng = random.Random(3)
    texts = [periodic_text(rng) for _ in range(600)] + [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    texts += ["a " * n for n in (5, 6, 7, 400)] + [" ".join("ab" * 40 + "c" + "ab" * 40), " ".join(("aab" * 5 + "c") * 6)]
    # Copies share nonterminals: what is found in one must be carried to all.
    texts += texts[:150]
    want = [plain_runs(t.split()) for t in texts]
    assert sum(map(len, want)) > 800 and max(q for w in want for _, _, q in w) > 20
    for size in (8 << 20, 300):
        monkeypatch.setattr(periodic_runs, "BATCH_BYTES", size)
        for text, runs, (got, collapsed, n) in zip(texts, want, found_in(texts)):
            assert got == runs, text
            assert (collapsed, n) == (plain_collapse(text.split(), runs), len(text.split()))


def test_grammar_restores_its_input_and_leaves_no_repeated_pair():
    rng = np.random.default_rng(4)
    for size, kinds in ((0, 3), (1, 3), (3000, 2), (3000, 40), (5000, 3000)):
        words = rng.integers(0, kinds, size)
        grammar = periodic_runs.compress(words)
        parts = {}
        symbols = grammar.base
        for r in grammar.rounds:
            for left, right, begin, border, end in zip(r.left.tolist(), r.right.tolist(), r.begin, r.border, r.end):
                own = parts.get(left, [left]) + parts.get(right, [right])
                assert own == words[begin:end].tolist() and len(parts.get(left, [left])) == border - begin
                parts[symbols] = own
                symbols += 1
        assert [w for s in grammar.symbols.tolist() for w in parts.get(s, [s])] == words.tolist()
        counts, last = Counter(), {}
        for i, pair in enumerate(zip(grammar.symbols.tolist(), grammar.symbols.tolist()[1:])):
            if last.get(pair) != i - 1:
                counts[pair] += 1
                last[pair] = i
        assert not counts or max(counts.values()) < 2


def test_hard_and_empty(spark, hard, empty):
    rows = periodic_runs.find_runs(hard).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(d for d, _ in HARD)
    own = {r["doc_id"]: r for r in rows}
    assert [tuple(x) for x in own[5]["runs"]] == [(0, 30_000, 1)] and own[5]["collapsed"] == "word"
    assert all(own[d]["n_words"] == 0 and own[d]["collapsed"] == "" and own[d]["runs"] == [] for d in (2, 3, 4))
    assert periodic_runs.find_runs(empty).count() == 0
    assert periodic_runs.digests(periodic_runs.find_runs(periodic_runs.with_planted_runs(empty))).count() == 0
    assert periodic_runs.digests(periodic_runs.find_runs(periodic_runs.with_planted_runs(hard))).count() == len(HARD)


def test_query_over_planted_runs_equals_brute_force(spark):
    import hashlib
    from fractions import Fraction

    rng = random.Random(8)
    texts = [periodic_text(rng) if i % 3 else " ".join(rng.choice("abcdefghijk") for _ in range(rng.randint(0, 60))) for i in range(500)]
    rows = periodic_runs.digests(periodic_runs.find_runs(periodic_runs.with_planted_runs(docs_of(spark, texts)))).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        words = texts[r["doc_id"]].split()
        h = zlib.crc32(str(r["doc_id"]).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = plain_runs(words)
        best = min(((-Fraction(length, q), s, q, length) for s, length, q in runs), default=None)
        want = (None,) * 4 if best is None else (best[1], best[3], best[2], 1000 * best[3] // best[2])
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(runs), *want)
        assert r["runs_sha256"] == sha("".join(f"{s},{length},{q}\n" for s, length, q in runs))
        assert r["collapsed_sha256"] == sha(plain_collapse(words, runs))
    assert sum(r["n_runs"] > 0 for r in rows) > 150

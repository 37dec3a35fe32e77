"""Encoders, token files, language model, classifier and benchmark passages."""

import hashlib
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm.conftest import HARD, docs_of
from weftline.llm import bpe, decontaminate, grammar_ids, suffix_tree, weak_labels

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", "It's don't I'LL x\ty z<|endoftext|>a<|startoftext|>", "ÉÀ ΑΣ σς İI 你好 123 ½² 'sfoo \x1c\x1f \u00a0\u2003 e\u0301 \u0345a",
    "aaaaaaaaaaaaaaaaa bbbbbbbb", "😀😀  two  blanks   three ", " lead", "trail ", "\n\n a \n b\n", "...,,, a.b,c!!", "x" * 5000,
]


def test_trie_encodes_and_decodes_like_the_library(small_documents):
    library, own = Tokenizer.from_file(WORDS), bpe.TrieEncoder(WORDS)
    texts = [*ODD, *small_documents]
    for text, found in zip(texts, own.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert [int(i) for c in found for i in c[1].split()] == want
        assert own.decode(want) == library.decode(want, skip_special_tokens=False) == " ".join(c[2] for c in found)


def test_texts_with_nulls_and_many_special_tokens_like_the_library():
    library, own = Tokenizer.from_file(WORDS), bpe.TrieEncoder(WORDS)
    special = sorted(own.added)
    rng = random.Random(11)
    bits = ["a", "b1", "é", "\x00", "\x00\x00", " ", "\n", "你", "\x1c", *special[:3]]
    texts = ["a \x00b", "x\x00\x00y z", "\x00", special[0] * 5000, (special[0] + " w\x00 ") * 2000]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(1, 25))) for _ in range(3000)]
    for text, found in zip(texts, own.encode(texts)):
        assert [int(i) for word in found for i in word[1].split()] == library.encode(text, add_special_tokens=False).ids, text[:60]


def test_every_word_of_the_vocabulary_is_its_own_encoding():
    own = bpe.TrieEncoder(WORDS)
    names = random.Random(1).sample([n for n in own.ids if n.endswith("</w>") and len(n) > 5], 500)
    found = own.encode_words([n[:-4] for n in names])
    assert all(found[n[:-4]] == (own.ids[n],) for n in names)


def test_encoding_digests_hard_and_empty(spark, hard, empty):
    library = Tokenizer.from_file(WORDS)
    want = Counter()
    for doc, text in HARD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want[doc, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))] += 1
    assert Counter(tuple(r) for r in bpe.encode_and_decode(hard, WORDS).collect()) == want
    assert {len(r["ids"]) for r in bpe.encode_table(hard, WORDS).collect()} == {n for _, n, *_ in want}
    assert bpe.encode_and_decode(empty, WORDS).count() == 0


def test_byte_ids_like_the_library(small_documents):
    library, own = Tokenizer.from_file(BYTES), grammar_ids.ByteEncoder(BYTES)
    texts = [*ODD, *small_documents]
    for _ in "ab":
        for text, ids in zip(texts, own.encode(texts)):
            assert np.frombuffer(ids, own.kind).tolist() == library.encode(text, add_special_tokens=False).ids


def test_grammar_expands_to_what_it_was_made_of():
    rng = np.random.default_rng(1)
    for size in (0, 1, 2, 30, 5000):
        for values in (2, 50):
            ids = rng.integers(0, values, size)
            grammar = grammar_ids.compress(ids, 60, least=2)
            assert (grammar.expand() == ids).all()
            assert grammar.lengths.tolist() == [len(grammar_ids.Grammar(60, grammar.rules, np.array([60 + r])).expand()) for r in range(len(grammar.rules))]
            for _ in range(20):
                a, b = sorted(rng.integers(0, size + 1, 2))
                assert (grammar.expand(int(a), int(b)) == ids[a:b]).all()
    long = np.tile(np.arange(40), 500)
    assert len(grammar_ids.compress(long, 60).symbols) < len(long) / 10


def test_no_pair_that_pays_for_a_rule_is_left():
    rng = np.random.default_rng(2)
    for ids in (rng.zipf(1.3, 60_000) % 50_000, np.tile(rng.integers(0, 50_000, 700), 30), np.zeros(3000, int)):
        grammar = grammar_ids.compress(ids, 50_000)
        pairs = Counter(zip(grammar.symbols.tolist(), grammar.symbols[1:].tolist()))
        assert max(pairs.values(), default=0) < grammar_ids.LEAST
        assert (grammar.expand() == ids).all()
        assert (grammar.expand(1001, 1010) == ids[1001:1010]).all()


def test_token_shards_round_trip(spark, hard, empty, tmp_path):
    library = Tokenizer.from_file(BYTES)
    folder = str(tmp_path / "ids")
    grammar_ids.compressed_shards(hard, BYTES, shard_ids=20).write.parquet(folder)
    rows = sorted(grammar_ids.read_digests(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted((d for d, _ in HARD), key=lambda d: (d is not None, d or 0))
    start = 0
    for r in rows:
        assert r["start"] == start
        start += r["n_tokens"]
    of = lambda t: [*library.encode(t or "", add_special_tokens=False).ids, 0]
    want = Counter((d, len(of(t)), zlib.crc32(np.array(of(t), "<u4").tobytes())) for d, t in HARD)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want
    # Random access: one document without its neighbours.
    for row in spark.read.parquet(folder).collect():
        row = row.asDict()
        for at, doc in enumerate(row["doc_ids"]):
            assert grammar_ids.read_document(row, at).tolist() in [of(t) for d, t in HARD if d == doc]
    grammar_ids.write_shards(empty, BYTES, str(tmp_path / "none"))
    assert grammar_ids.read_digests(spark, str(tmp_path / "none")).count() == 0


def plain_tree_scores(texts, train):
    """The suffix tree with dictionaries, token by token."""
    tokens = {i: [*t.encode().lower().split(), None] for i, t in enumerate(texts)}
    one = Counter(w for i in train for w in tokens[i])
    total, distinct = sum(one.values()), len(one)
    root = lambda w: (one[w] + 1) / (total + distinct + 1)
    grams = {d: Counter(tuple(tokens[i][k - d : k + 1]) for i in train for k in range(d, len(tokens[i]))) for d in (1, 2)}
    nodes, share = {1: {}, 2: {}}, {1: {}, 2: {}}
    for d, occurrences in ((1, {(w,): n for w, n in one.items()}), (2, grams[1])):
        children = {}
        for gram, n in grams[d].items():
            if n >= suffix_tree.LEAST_PAIR and occurrences.get(gram[:-1], 0) >= suffix_tree.LEAST_CONTEXT and (d == 1 or gram[1:2] in nodes[1]):
                children.setdefault(gram[:-1], {})[gram[-1]] = n
        for context, own in children.items():
            size = occurrences[context]
            before = root if d == 1 else lambda w, c=context: share[1].get((c[1], w), 0.0) + nodes[1][c[1:]] * root(w)
            if sum(n * math.log(n / size / before(w)) for w, n in own.items()) >= suffix_tree.GAIN:
                nodes[d][context] = 1 - sum((n - 1) / size for n in own.values())
                share[d].update({(*context, w): (n - 1) / size for w, n in own.items()})
    scores = {}
    for i, own in tokens.items():
        score = 0.0
        for k, w in enumerate(own):
            chance = root(w)
            if k >= 1 and (own[k - 1],) in nodes[1]:
                chance = share[1].get((own[k - 1], w), 0.0) + nodes[1][(own[k - 1],)] * chance
                if k >= 2 and tuple(own[k - 2 : k]) in nodes[2]:
                    chance = share[2].get((*own[k - 2 : k], w), 0.0) + nodes[2][tuple(own[k - 2 : k])] * chance
            score += math.log10(chance)
        scores[i] = (len(own), sum(one[w] > 0 for w in own), total, sum(math.log10(root(w)) for w in own), score)
    return scores, nodes, share, root, one


def test_scores_equal_a_plain_tree(spark):
    rng = random.Random(3)
    words = ["the", "of", "a", "b", "c", "d", "rare1", "rare2"]
    texts = []
    for _ in range(150):
        own = []
        for _ in range(rng.randint(0, 40)):
            own.append({"the": "a", "of": "b"}.get(own[-1], rng.choice(words)) if own and rng.random() < 0.7 else rng.choice(words))
        texts.append(" ".join(own))
    train = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 7 != 2]
    want, nodes, share, root, one = plain_tree_scores(texts, train)
    assert nodes[1] and nodes[2]
    rows = suffix_tree.score_documents(docs_of(spark, texts)).collect()
    for r in rows:
        n, known, total, base, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(score)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    # In every node the chances of all words and an unknown one add up to one.
    for (context,), left in nodes[1].items():
        assert sum(share[1].get((context, w), 0.0) + left * root(w) for w in [*one, "unknown"]) == pytest.approx(1)


def test_contexts_grow_with_what_the_texts_bear_out(spark):
    # Each of the last four words has its part in what comes next.
    rng = random.Random(4)
    texts = []
    for _ in range(150):
        own = [rng.choice("xy") for _ in range(4)]
        for _ in range(60):
            share = sum(p for p, w in zip((0.3, 0.25, 0.25, 0.2), reversed(own)) if w == "x")
            own.append("x" if rng.random() < share else "y")
        texts.append(" ".join(own))
    train = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 7 != 2]
    tokens = {i: [*t.encode().split(), None] for i, t in enumerate(texts)}
    one = Counter(w for i in train for w in tokens[i])
    total, distinct = sum(one.values()), len(one)
    nodes, depth = {(): None}, 0
    counts = Counter(tuple(tokens[i][k - d : k + 1]) for i in train for d in range(1, 9) for k in range(d, len(tokens[i])))
    following = {}
    for gram, n in counts.items():
        following.setdefault(gram[:-1], {})[gram[-1]] = n

    def chance(past, word):
        if not past:
            return (one[word] + 1) / (total + distinct + 1)
        share, left = nodes[past]
        return share.get(word, 0.0) + left * chance(past[1:], word)

    while any(len(c) == depth for c in nodes):
        depth += 1
        for context, own in following.items():
            size = sum(own.values())
            if len(context) == depth and context[1:] in nodes and size >= suffix_tree.LEAST_CONTEXT:
                own = {w: n for w, n in own.items() if n >= suffix_tree.LEAST_PAIR}
                if sum(n * math.log(n / size / chance(context[1:], w)) for w, n in own.items()) >= suffix_tree.GAIN:
                    nodes[context] = {w: (n - 1) / size for w, n in own.items()}, 1 - sum((n - 1) / size for n in own.values())
    assert 4 <= max(map(len, nodes)) < 8
    for r in suffix_tree.score_documents(docs_of(spark, texts)).collect():
        own, score = tokens[r["doc_id"]], 0.0
        for k, w in enumerate(own):
            d = 0
            while d < k and tuple(own[k - d - 1 : k]) in nodes:
                d += 1
            score += math.log10(chance(tuple(own[k - d : k]), w))
        assert r["score"] == pytest.approx(score)


def test_scores_hard_and_empty(spark, hard, empty):
    rows = suffix_tree.score_documents(hard).collect()
    assert len(rows) == len(HARD) and all(r["score"] <= 0 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (2, 3, 4)} == {1}
    assert suffix_tree.score_documents(empty).count() == 0


def test_labellers_are_told_apart_by_expectation_maximisation():
    rng = random.Random(4)
    right = (0.95, 0.85, 0.7)
    counts, truth = Counter(), 0
    for _ in range(20_000):
        bad = rng.random() < 0.3
        truth += bad
        votes = [weak_labels.NONE if rng.random() < 0.2 else (bad if rng.random() > p else not bad) for p in right]
        counts[weak_labels._pattern([int(v) for v in votes])] += 1
    share, chance = weak_labels.fit_labellers(counts, 3)
    assert share == pytest.approx(truth / 20_000, abs=0.05)
    assert [chance[weak_labels.GOOD, j, weak_labels.GOOD] for j in range(3)] == pytest.approx(right, abs=0.06)


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    learned, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    rows = weak_labels.score_documents(docs, learned).join(held, "doc_id").collect()
    clean = [r["keep"] for r in rows if r["quality"] == 1 and not r["toxic"]]
    junk = [r["keep"] for r in rows if r["quality"] == 0]
    assert sum(clean) >= 0.98 * len(clean)
    assert sum(junk) <= 0.15 * len(junk)


def test_classifier_hard_and_empty(spark, hard, empty):
    assert weak_labels.score_documents(hard).count() == len(HARD)
    kept = weak_labels.keep_good(hard, spark.createDataFrame([(1, 0), (2, 1), (None, 1)], "doc_id bigint, toxic int"))
    assert kept.columns == hard.columns and 0 < kept.count() <= len(HARD)
    assert weak_labels.score_documents(empty).count() == 0 and weak_labels.keep_good(empty).count() == 0


def plain_fewest(pattern, text):
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for j, p in enumerate(pattern):
            new.append(min(row[j + 1] + 1, new[-1] + 1, row[j] + (p != c)))
        row, best = new, min(best, new[-1])
    return best


def test_passages_with_edits_equal_brute_force(small_documents):
    rng = random.Random(6)
    items = [decontaminate.normal_form(t)[: rng.randint(30, 160)] for t in small_documents[:12]]
    finder = decontaminate.Finder(list(enumerate(items)))
    hits = 0
    for _ in range(120):
        n = rng.randrange(len(items))
        text = bytearray(items[n])
        for _ in range(rng.randint(0, len(text) // 10 + 3)):
            at = rng.randrange(len(text))
            text[at : at + rng.randint(0, 1)] = rng.choice([b"", b"x", b"q"])
        text = decontaminate.normal_form(small_documents[20 + n])[:60] + b" " + bytes(text) + b" " + decontaminate.normal_form(small_documents[30 + n])[:60]
        found = {item: errors for _, item, errors, _, _ in finder.search([b"", text])}
        for k, item in enumerate(items):
            fewest = plain_fewest(item, text)
            assert found.get(k) == (fewest if fewest <= max(0, len(item) // 10 - 1) else None)
        hits += len(found)
    assert hits > 50


def test_leaks_hard_and_empty(spark, hard, empty):
    items = [(1, "Quick, brown fox JUMPS over the lazy dog near"), (1, "Quick, brown fox JUMPS over the lazy dog near"), (2, None), (3, ""), (None, "x y"), (4, "last")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.find_leaks(hard, benchmark).collect()
    assert Counter((r["doc_id"], r["item_id"], r["errors"]) for r in rows) == {(1, 1, 0): 4, (7, 1, 0): 2, (6, 4, 0): 1}
    kept = decontaminate.drop_leaks(hard, benchmark)
    assert kept.columns == hard.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [2, 3, 4, 5]
    assert decontaminate.find_leaks(empty, benchmark).count() == 0
    none = benchmark.limit(0)
    assert decontaminate.find_leaks(hard, none).count() == 0 and decontaminate.drop_leaks(hard, none).count() == len(HARD)


def test_a_benchmark_in_slices_finds_the_same(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    docs, benchmark = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    whole = sorted(map(tuple, decontaminate.find_leaks(docs, benchmark).collect()))
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 3000)
    assert sorted(map(tuple, decontaminate.find_leaks(docs, benchmark).collect())) == whole
    plain = duckdb.sql(f"SELECT count(*) FROM '{folder}/documents.parquet' d JOIN '{folder}/benchmark.parquet' b ON contains(lower(d.text), lower(b.text))").fetchall()[0][0]
    assert len(whole) >= plain > 0

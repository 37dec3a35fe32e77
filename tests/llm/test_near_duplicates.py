"""Golay-code near duplicates and fuzzy lines against brute force."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from llm.conftest import HARD, docs_of
from weftline.llm import golay_dedup, line_dedup
from weftline.llm.common import components
from weftline.session import cut_lineage


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [words] if len(words) < 4 else [words[i : i + 4] for i in range(len(words) - 3)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_is_the_majority_of_shingle_hashes(spark, small_documents):
    for text in [*small_documents[:20], "one", "one two three", "a b c d e", *[t for _, t in HARD]]:
        assert golay_dedup.fingerprint(text) == plain_fingerprint(text)
    # One column's hash in the engine is the same function.
    assert spark.range(1).select(F.xxhash64(F.lit("a b"))).first()[0] % 2**64 == plain_fingerprint("a b")


def test_golay_code_corrects_three_errors():
    rng = random.Random(1)
    words = np.array([rng.randrange(1 << 23) for _ in range(200)], np.int64)
    index = golay_dedup.codeword_index(words)
    # A perfect code: every word has exactly one codeword within three bits.
    low, high, errors = golay_dedup._decoder()
    pattern = errors[low[words & 4095] ^ high[words >> 12]]
    assert all(int(p).bit_count() <= 3 for p in pattern)
    code = words ^ pattern
    flips = np.array([sum(1 << b for b in rng.sample(range(23), 3)) for _ in code])
    assert (golay_dedup.codeword_index(code ^ flips) == index).all()


def test_words_two_bits_apart_share_a_codeword():
    rng = random.Random(2)
    for width in (21, 22):
        a = np.array([rng.randrange(1 << width) for _ in range(500)], np.int64)
        b = a ^ np.array([sum(1 << x for x in rng.sample(range(width), rng.randint(0, 2))) for _ in a])
        for x, y in zip(golay_dedup.near_indices(a, width), golay_dedup.near_indices(b, width)):
            assert set(x[x >= 0]) & set(y[y >= 0])


def test_prints_up_to_four_bits_apart_meet_under_a_key():
    rng = random.Random(3)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(1, 4)):
            b ^= 1 << bit
        keys, rows = golay_dedup.golay_keys(np.array([a, b], np.uint64))
        assert set(keys[rows == 0]) & set(keys[rows == 1])


def test_groups_equal_brute_force_on_dense_prints(spark):
    rng = random.Random(4)
    prints = [rng.getrandbits(64) for _ in range(30)]
    for _ in range(400):
        own = rng.choice(prints)
        for bit in rng.sample(range(64), rng.randint(0, 5)):
            own ^= 1 << bit
        prints.append(own)
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    found = golay_dedup.fingerprint_groups(spark.createDataFrame(list(enumerate(signed)), "doc_id bigint, fp bigint")).collect()
    by_print = {r["fp"]: r["component_id"] for r in found}
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    assert [by_print[p] for p in signed] == roots(len(prints), links)


def test_near_duplicates_hard_and_empty(spark, hard, empty):
    rows = golay_dedup.near_duplicates(hard).collect()
    assert len(rows) == len(HARD)
    zero = {r["component_id"] for r in rows if r["fingerprint"] == "0" * 16}
    assert zero == {2}
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 7)} == {1}
    assert golay_dedup.near_duplicates(empty).count() == 0


def test_keep_one_keeps_columns_and_one_row_of_each_group(spark, hard, empty):
    kept = golay_dedup.keep_one(hard)
    assert kept.columns == hard.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 5, 6]
    assert ids.count(None) == 1
    assert golay_dedup.keep_one(empty).count() == 0


def test_keep_one_equals_brute_force_jaccard(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(12)]
    texts = [[rng.choice(words) for _ in range(rng.randint(3, 120))] for _ in range(40)]
    for _ in range(150):
        own = list(rng.choice(texts))
        for _ in range(rng.randint(0, 1 + len(own) // 40)):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts.append(own)
    texts += [[*passage, *[rng.choice(words) for _ in range(rng.randint(1, 60))]] for _ in range(60)]

    def grams(own):
        return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))}

    sets = [grams(t) for t in texts]
    alike = [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    want = sorted({r for r in roots(len(sets), alike)})
    docs = docs_of(spark, [" ".join(t) for t in texts])
    assert sorted(r["doc_id"] for r in golay_dedup.keep_one(docs, 5).collect()) == want
    # Pairs far apart by fingerprint are among them.
    prints = [golay_dedup.fingerprint(" ".join(t), 5) for t in texts]
    assert any((prints[i] ^ prints[j]).bit_count() > 2 * golay_dedup.ERRORS for i, j in alike)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(6, 60)]
    found = components(spark.createDataFrame([*chain, *star, (7, 7)], "a bigint, b bigint")).collect()
    assert {(r["node"], r["component"]) for r in found} == {(i, 100) for i in range(100, 161)} | {(i, 5) for i in range(5, 60)}


def test_edit_distance_against_a_table():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j + 1] + 1, new[-1] + 1, row[j] + (x != y)))
            row = new
        return row[-1]

    rng = random.Random(5)
    for _ in range(300):
        a, b = (bytes(rng.choice(b"ab c") for _ in range(rng.randint(0, 25))) for _ in "xy")
        assert line_dedup.edit_distance(a, b) == plain(a, b)
        allowed = rng.randint(0, 25)
        assert line_dedup.edit_distance(a, b, allowed) in ((plain(a, b),) if plain(a, b) <= allowed else (plain(a, b), None))


def test_lines_equal_brute_force(spark, small_documents):
    first, prints = {}, {}
    for i, text in enumerate(small_documents):
        own = line_dedup.translated(text)
        for at, h, fp in zip(*line_dedup.line_hashes(own)):
            line = line_dedup.normal_line(own.split(b"\n")[at])
            first.setdefault(line, (i, int(at)))
            prints[line] = int(fp)
    lines = list(prints)
    links = [
        (i, j) for i in range(len(lines)) for j in range(i)
        if line_dedup.similar(lines[i], lines[j])
    ]
    root = roots(len(lines), links)
    want = {min(first[lines[i]] for i in range(len(lines)) if root[i] == r) for r in set(root)}
    rows = line_dedup.repeated_lines(docs_of(spark, small_documents)).collect()
    assert {(r["doc_id"], r["line"]) for r in rows if r["kept"]} == want
    assert links and len(want) < len(rows)


def test_lines_leave_tables_with_clashing_columns(spark):
    text = "one line with several words in it"
    rows = [(n, 7, "t", [1], 0, text) for n in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, _id int, _tie string, _lines array<int>, tie int, text string")
    assert [tuple(r) for r in line_dedup.drop_repeated_lines(docs).collect()] == rows[:1]
    assert line_dedup.repeated_lines(docs).where("kept").count() == 1


def test_a_failed_link_does_not_hide_another(spark, monkeypatch):
    # All prints are alike; only the texts tell which lines belong together.
    texts = ["alpha beta gamma delta epsilon", "zeta eta theta iota kappa", "alpha beta gamma delta epsilom", "zeta eta theta iota kappe"]
    docs = docs_of(spark, texts)
    lines = line_dedup.line_table(docs).withColumn("fp", F.lit(0).cast("bigint"))
    rows = line_dedup.line_classes(docs, lines).collect()
    assert sorted(r["first"]["doc_id"] for r in rows) == [0, 0, 1, 1]


def test_repeated_lines_go_and_emptied_documents_too(spark):
    common = "This very line, no. 12, stands in each of the documents."
    docs = docs_of(spark, [common + "\nOnly here is this sentence to be found", common, "short one\n" + common.upper().replace("12", "47")])
    rows = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_lines(docs.withColumn("n_chars", F.length("text"))).collect()}
    assert rows == {0: common + "\nOnly here is this sentence to be found", 2: "short one"}


def test_lines_hard_and_empty(spark, hard, empty):
    kept = line_dedup.drop_repeated_lines(hard)
    assert kept.columns == hard.columns
    rows = kept.collect()
    assert sorted(r["doc_id"] for r in rows if r["doc_id"]) == [1, 1, 2, 3, 4, 5, 6]
    assert sum(r["doc_id"] is None for r in rows) == 2
    assert line_dedup.drop_repeated_lines(empty).count() == 0


def test_short_lines_have_rows_and_repeats_of_them_go(spark):
    docs = docs_of(spark, ["Chapter one\nOnly here is this sentence to be found", "chapter ONE!\nMenu", "menu\n---"])
    rows = {(r["doc_id"], r["line"]): r["kept"] for r in line_dedup.repeated_lines(docs).collect()}
    assert rows == {(0, 0): True, (0, 1): True, (1, 0): False, (1, 1): True, (2, 0): False}


def test_changed_words_are_found_in_lines_of_any_length(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(4, 6))) for _ in range(3000)]
    texts = []
    for size in range(6, 66):
        own = [rng.choice(words) for _ in range(size)]
        changed = list(own)
        for at in rng.sample(range(size), max(1, size // 10)):
            changed[at] = "".join(rng.choice("klmno") for _ in range(len(own[at])))
        texts += [" ".join(own), " ".join(changed)]
    assert all(line_dedup.similar(a.encode(), b.encode()) for a, b in zip(texts[::2], texts[1::2]))
    kept = {r["doc_id"] for r in line_dedup.repeated_lines(docs_of(spark, texts)).collect() if r["kept"]}
    assert kept == set(range(0, len(texts), 2))


def test_the_first_runs_of_a_long_line_are_enough():
    lines = [b"a b", b"a b c", b" ".join(b"%d" % n for n in range(500))]
    row, key, before, counts = line_dedup.line_grams(lines)
    assert np.bincount(row).tolist() == [3, 3, line_dedup.GRAMS] and len(counts) == 3
    assert set(key[row == 0]) & set(key[row == 1])


def test_keep_one_goes_through_golay_keys(spark, monkeypatch):
    """Fingerprints within four bits are candidates by themselves; candidates that are not similar stay apart."""
    words = [f"w{i}" for i in range(400)]
    near = " ".join(words + ["end"])
    docs = spark.createDataFrame([(1, " ".join(words)), (2, near), (3, "quite another text of a few words")], "doc_id bigint, text string")
    none = lambda keyed, steps: spark.createDataFrame([], "a bigint, b bigint")
    monkeypatch.setattr(golay_dedup, "_pairs_under_keys", none)
    assert (golay_dedup.fingerprint(" ".join(words), 5) ^ golay_dedup.fingerprint(near, 5)).bit_count() <= golay_dedup.ERRORS
    assert sorted(r["doc_id"] for r in golay_dedup.keep_one(docs, 5).collect()) == [1, 3]


def test_many_pairs_are_verified_as_one_by_one():
    rng = random.Random(5)
    lefts, rights = [], []
    for size in [0, 1, 2, 5, 63, 64, 65, 127, 128, 129, 300, 700] * 30:
        a = bytearray(rng.choice(b"abcde \x00\xc3\xff") for _ in range(size))
        b = bytearray(a)
        for _ in range(int(size * rng.choice((0, 0.1, 0.19, 0.2, 0.21, 0.3, 0.6)))):
            kind, at = rng.randrange(3), rng.randrange(len(b) + 1)
            b[at : at + (kind > 0)] = bytes([rng.choice(b"abcde ")]) * (kind < 2)
        if rng.random() < 0.1:
            b = bytearray(rng.choice(b"abcde ") for _ in range(size))
        lefts.append(bytes(a))
        rights.append(bytes(b))
    found = line_dedup.all_similar(lefts, rights)
    assert found.tolist() == [line_dedup.similar(a, b) for a, b in zip(lefts, rights)]
    assert 0 < found.sum() < len(found)


def test_candidates_taken_in_parts_give_the_same_classes(spark, small_documents, monkeypatch):
    docs = docs_of(spark, small_documents)
    whole = sorted(line_dedup.repeated_lines(docs).collect())
    monkeypatch.setattr(line_dedup, "LEAST_PAIRS", 1)
    monkeypatch.setattr(line_dedup, "MET_A_LINE", 0.5)
    monkeypatch.setattr(line_dedup, "VERIFIED_A_LINE", 0.2)
    assert sorted(line_dedup.repeated_lines(docs).collect()) == whole


def test_what_a_cut_shuffled_is_deleted(spark):
    def shuffled():
        blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks()
        return {b for b in str(blocks.mkString(" ")).split() if b.startswith("shuffle_")}

    before = shuffled()
    written = cut_lineage(spark.range(1000).repartition(4, "id"))
    left = shuffled() - before
    assert not left
    assert written.distinct().count() == 1000

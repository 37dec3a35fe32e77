"""Shards, top-k search, urls, and the registered queries."""

import random
from collections import Counter, defaultdict

import __spark_entry__ as entry
import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from llm.conftest import HARD, docs_of
from weftline.llm import kd_search, sharding, url_templates


def test_shards_are_near_equal_and_slots_gapless(spark):
    rng = random.Random(1)
    texts = ["x" * rng.randint(0, 60) for _ in range(3000)] + ["the same text over and over"] * 1500
    rows = sharding.shard_by_bytes(docs_of(spark, texts), shards=8).collect()
    size, slots = Counter(), defaultdict(list)
    for r in rows:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        assert r["size"] == len(r["text"]) + 8
    mean = sum(size.values()) / 8
    assert len(rows) == len(texts) and len(size) == 8
    assert all(abs(s - mean) <= 0.03 * mean for s in size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_equal_texts_stay_together_unless_too_many(spark):
    texts = [f"text {i % 300} {'y' * (i % 40)}" for i in range(6000)]
    rows = sharding.shard_by_bytes(docs_of(spark, texts), shards=4, tolerance=0.05).collect()
    shards = defaultdict(set)
    for r in rows:
        shards[r["text"]].add(r["shard"])
    assert sum(len(s) > 1 for s in shards.values()) == 0


def test_equal_rows_are_cut_too(spark):
    rng = random.Random(5)
    rows = [(None, "the same row over and over")] * 2000 + [(i, "x" * rng.randint(0, 20)) for i in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5).withColumn("_at", F.lit("own"))
    found = sharding.shard_by_bytes(frame).collect()
    size, slots = Counter(), defaultdict(list)
    for r in found:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    mean = sum(size.values()) / 24
    assert Counter((r["doc_id"], r["text"]) for r in found) == Counter(rows) and len(size) == 24
    # A row is up to 34 bytes, a shard some 3,200.
    assert all(abs(s - mean) <= 0.03 * mean + 34 for s in size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_hard_and_empty(spark, hard, empty, tmp_path):
    rows = sharding.shard_by_bytes(hard, shards=3).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(d for d, _ in HARD)
    assert {r["size"] for r in rows if r["doc_id"] in (2, 3)} == {8}
    assert sharding.shard_by_bytes(empty).count() == 0
    sharding.write_shards(sharding.shard_by_bytes(hard.select("doc_id", "text"), shards=3), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(HARD)


def plain_top(vectors, every=50, k=5):
    found = []
    for q, a in vectors:
        if q % every == 0:
            scores = sorted((-int(np.dot(a, b)), v) for v, b in vectors if v != q)[:k]
            found += [(q, n + 1, v, -s) for n, (s, v) in enumerate(scores)]
    return sorted(found)


def test_search_equals_brute_force_in_many_shards(spark, monkeypatch):
    monkeypatch.setattr(kd_search, "SHARD_ROWS", 150)
    monkeypatch.setattr(kd_search, "LEAF_ROWS", 8)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 12))
    rows = [(i, (centres[i % 6] + 0.1 * rng.normal(size=12)).tolist()) for i in range(700)] + [(700 + i, [0.25] * 12) for i in range(120)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    whole = [(i, np.floor(256 * np.array(v)).astype(np.int64)) for i, v in rows]
    assert sorted(tuple(r) for r in kd_search.top_products(frame).collect()) == plain_top(whole)


def test_search_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [1e12, 1.0]), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, None), (4, [1.0, None]), (None, [1.0, 1.0]), (5, [3.0, 1.0]), (6, [1.0, 1.0, 1.0]), (5, [3.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns({"shard": F.lit(1), "rank": F.lit(2)})
    found = sorted(tuple(r) for r in kd_search.top_products(frame).collect())
    scale = 256
    dot = lambda a, b: int(a[0] * scale) * int(b[0] * scale) + int(a[1] * scale) * int(b[1] * scale)
    far, five, zero = (1e12, 1.0), (3.0, 1.0), (1.0, 2.0)
    assert found == [
        (0, 1, 50, dot(zero, far)), (0, 2, 5, dot(zero, five)), (0, 3, 5, dot(zero, five)),
        (50, 1, 5, dot(far, five)), (50, 2, 5, dot(far, five)), (50, 3, 0, dot(far, zero)),
    ]
    assert kd_search.top_products(frame.limit(0)).count() == 0


def test_box_bounds_hold():
    rng = np.random.default_rng(3)
    rows = np.floor(rng.normal(size=(500, 8)) * 100)
    tree = kd_search.Tree(np.arange(500), rows, leaf=16)
    queries = np.floor(rng.normal(size=(20, 8)) * 100)
    bounds = tree.bounds(queries)
    for node, leaf in enumerate(tree.leaves):
        if leaf is not None:
            assert len(leaf) <= 16
            assert ((rows[leaf] @ queries.T).max(axis=0) <= bounds[:, node]).all()


URLS = [
    ("http://a.example.NET/en/5?x#y", "a.example.net", "/en/5", "example.net/en/", "allow"),
    ("http://a.example.net/de/5", "a.example.net", "/de/5", "net/", "block"),
    ("https://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
    ("https://notexample.com/de/", "notexample.com", "/de/", None, None),
    ("https://x.org/fr/a", "x.org", "/fr/a", "org/fr/", "allow"),
    ("https://x.org/FR/a", "x.org", "/FR/a", None, None),
    ("http://plain.net", "plain.net", "", None, None),
    ("http://plain.net?q", "plain.net", "", None, None),
    ("no scheme", "", "", None, None),
    (None, "", "", None, None),
    ("", "", "", None, None),
    ("x://net/", "net", "/", "net/", "block"),
    ("http://a.b/c://d.org/fr/", "a.b", "/c://d.org/fr/", None, None),
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u[0], "h") for i, u in enumerate(URLS)], "page_id bigint, url string, host string")
    labels = spark.createDataFrame([], "number bigint, rejected boolean")
    rows = {r["page_id"]: r for r in url_templates.judge_urls(pages, labels).collect()}
    assert len(rows) == len(URLS)
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (rows[i]["host"], rows[i]["path"], rows[i]["rule"]) == (host, path, rule)
        assert rows[i]["verdict"] == (verdict or "allow")
    assert url_templates.judge_urls(pages.limit(0), labels).count() == 0


def test_impure_templates_are_blocked_and_alike_branches_merged(spark):
    pages = [(i, f"http://h.com/{'spam' if i % 2 else ('a', 'b', 'c')[i % 3]}/{i}") for i in range(600)]
    labels = [(i, i % 2 == 1) for i in range(600)]
    rows = url_templates.judge_urls(
        spark.createDataFrame(pages, "page_id bigint, url string"), spark.createDataFrame(labels, "number bigint, rejected boolean")
    ).collect()
    assert all(r["verdict"] == ("block" if r["page_id"] % 2 else "allow") for r in rows)
    # The numbers of pages are variable, and so many children differ from the blocked branch only.
    assert {r["template"] for r in rows if r["page_id"] % 2} == {"/spam/#"}


def test_every_operator_and_the_pipeline_are_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "encoding"]


def test_pipeline_runs_and_its_stages_take_hard_and_empty_tables(spark, hard, empty):
    folder = "/root/testdata/sf0.001"
    assert 0 < corpus_pipeline.run(spark, folder).count() < 200
    for docs in (hard, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, folder).columns == docs.columns
            stage(spark, docs, folder).count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()


def test_branches_part_at_any_depth(spark):
    # Good and bad pages differ at the seventh segment only; one long path is alone.
    deep = "https://a.io/a/b/c/d/e/f/"
    pages = spark.createDataFrame([(n, f"{deep}{'spam' if n % 2 else 'news'}/x/{n}") for n in range(80)] + [(80, "https://b.io" + "/s" * 300), (81, "https://b.io/$/t")], "page_id bigint, url string")
    labels = spark.createDataFrame([(n, n % 2 == 1) for n in range(80)], "number bigint, rejected boolean")
    rows = {r["page_id"]: r for r in url_templates.judge_urls(pages, labels).collect()}
    assert {r["verdict"] for n, r in rows.items() if n < 80 and n % 2} == {"block"}
    assert {r["verdict"] for n, r in rows.items() if n < 80 and n % 2 == 0} == {"allow"}
    assert rows[1]["template"] == "/a/b/c/d/e/f/spam/x/#"
    assert len(rows) == 82 and rows[80]["template"] == "/*/*/*" + "/s" * 297 and rows[81]["template"] == "/*/*"

"""Bucketed tables: what a batch writes, replays, a writer that died."""

import pytest
from conftest import CATALOG, by, make_targets
from pyspark.sql import functions as F

from weftline.operators import merge as M
from weftline.sources import buckets

CHANGE = "entity_name string, id string, seq bigint, exists boolean, values map<string,string>"


def changes(spark, *rows):
    return M.fold_changes(spark.createDataFrame([("account", id_, i, exists, values) for i, (id_, exists, values) in enumerate(rows)], CHANGE))


@pytest.fixture
def laid_out(spark, tmp_path):
    accounts = [{"accountid": f"A{i}", "accountnumber": f"N{i}", "name": "old", "revenue": i} for i in range(2000)]
    frame = make_targets(spark, [{**a, "revenue": None} for a in accounts])["account"]
    path = str(tmp_path / "account")
    buckets.make_table(frame, path, "accountid", 400)
    return path, frame


def files(path):
    import pathlib

    return {str(p): (p.stat().st_ino, p.stat().st_mtime_ns) for p in pathlib.Path(path, "rows").rglob("*.parquet")}


def test_a_batch_writes_only_touched_buckets(spark, laid_out):
    path, frame = laid_out
    before = files(path)
    rows = [(f"A{i * 17}", True, {"name": f"new{i}"}) for i in range(50)] + [(f"fresh{i}", False, {"accountnumber": f"F{i}"}) for i in range(50)]
    batch = changes(spark, *rows)
    buckets.merge_changes(batch, path, CATALOG, "account", 1)
    after = files(path)
    touched = {r["_bucket"] for r in buckets.applied_buckets(spark, path, 1).collect()}
    assert 0 < len(touched) <= 100
    kept = {p: s for p, s in before.items() if int(p.split("_bucket=")[1].split("/")[0]) not in touched}
    assert kept and all(after.get(p) == s for p, s in kept.items())
    want = M.merge_entity(frame, batch, CATALOG, "account").collect()
    assert sorted(map(str, buckets.read_table(spark, path).collect())) == sorted(map(str, want))


def test_replays_change_nothing(spark, laid_out):
    path, _ = laid_out
    batch = changes(spark, ("fresh", False, {"name": "x"}), ("A1", True, {"name": None}))
    buckets.merge_changes(batch, path, CATALOG, "account", 1)
    before = files(path)
    buckets.merge_changes(batch, path, CATALOG, "account", 1)
    assert files(path) == before and buckets.read_table(spark, path).count() == 2001
    buckets.merge_changes(changes(spark), path, CATALOG, "account", 2)
    assert files(path) == before and buckets.applied_buckets(spark, path, 2).count() == 0


def test_a_dead_writer_is_finished_by_the_next(spark, laid_out, monkeypatch):
    path, _ = laid_out

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(buckets, "_replace", dies)
        with pytest.raises(RuntimeError):
            buckets.merge_changes(changes(spark, ("a1", True, {"name": "first"}), ("A1", True, {"name": "first"})), path, CATALOG, "account", 1)
    assert buckets._rows(spark, path).where(F.col("name") == "first").count() == 0
    buckets.merge_changes(changes(spark, ("A2", True, {"name": "second"})), path, CATALOG, "account", 2)
    names = by(buckets.read_table(spark, path).where(F.col("name") != "old").collect(), "accountid")
    assert {k: v["name"] for k, v in names.items()} == {"A1": "first", "A2": "second"}

"""Resolution helpers: the filter of wanted keys, hot keys, order in ranges, keys that change."""

import itertools
import random

from pyspark.sql import functions as F

from weftline import Catalog
from weftline.operators import hot, ranges
from weftline.operators import resolve as R

COLUMNS = [f"k{i}" for i in range(9)]
MANY = Catalog.from_rows([("part", "id", "guid"), *[("part", c, "long") for c in COLUMNS]], ids={"part": "id"})


def test_only_wanted_texts_leave_the_scan(spark):
    sets = [c for n in (3, 4, 5, 6) for c in itertools.combinations(COLUMNS, n)][:300]
    rng = random.Random(1)
    rows = [(str(i), *[rng.randrange(40) if rng.random() > 0.05 else None for _ in COLUMNS]) for i in range(600)]
    target = spark.createDataFrame(rows, "id string, " + ", ".join(f"{c} bigint" for c in COLUMNS))
    asked = []
    for i in range(200):
        own, row = rng.choice(sets), rng.choice(rows)
        values = dict(zip(COLUMNS, row[1:]))
        if all(values[c] is not None for c in own):
            asked.append((own, ",".join(f"{c}={values[c] + (i % 3 == 0)}" for c in own)))
    requests = spark.createDataFrame([("part", text, list(own)) for own, text in asked], "entity_name string, identity string, key_names array<string>")
    want = {}
    texts = {text for _, text in asked}
    for row in rows:
        values = dict(zip(COLUMNS, row[1:]))
        for own in {own for own, _ in asked}:
            text = ",".join(f"{c}={values[c]}" for c in own)
            if text in texts and all(values[c] is not None for c in own):
                want.setdefault(text, []).append(row[0])
    got = R.match_keys(requests, {"part": target}, MANY, R.key_shapes(requests)).collect()
    assert {r["identity"]: (r["match_count"], r["match_id"]) for r in got} == {t: (len(i), min(i)) for t, i in want.items()}
    wanted = requests.select("entity_name", "identity").distinct()
    scanned = R.scan_key_sets(target, MANY, "part", [own for _, own in R.key_shapes(requests)], R.wanted_filter(wanted))
    matches = sum(map(len, want.values()))
    # Of more than 50,000 texts those pass that match, and one in some sixty of the others at most.
    assert matches <= scanned.count() <= matches + 1500


def test_a_hot_key_is_dealt_to_all_partitions(spark):
    n = 60_000
    rows = spark.range(n).select(
        F.col("id").alias("message_id"), F.lit(0).alias("idx"), F.lit("e").alias("entity_name"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"))).alias("identity"),
    )
    found = rows.select("entity_name", "identity").distinct().withColumn("match_id", F.upper("identity"))
    keys = hot.hot_keys(rows)
    assert len(keys) == 1 and hot.hot_keys(rows.where("identity <> 'hot'")) == []
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = hot.join_unique(rows, found, keys, ["message_id", "idx"])
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert joined.where("match_id = upper(identity)").count() == n
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]


def test_numbers_and_last_values_in_ranges(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "a", None]), i, rng.choice([None, None, i])) for i in range(3000)]
    frame = spark.createDataFrame(rows, "k string, n int, v int").repartition(5)
    numbered = ranges.number_rows(frame, ["k"], ["n"], "at").collect()
    want, last, counts = {}, {}, {}
    for k, n, v in rows:
        want[n] = (counts.get(k, 0), last.get(k))
        counts[k] = counts.get(k, 0) + 1
        if v is not None:
            last[k] = v
    assert {r["n"]: r["at"] for r in numbered} == {n: w[0] for n, w in want.items()}
    known = ranges.last_before(frame.where("k is not null"), ["k"], ["n"], "v", "before").collect()
    assert {r["n"]: r["before"] for r in known} == {n: want[n][1] for k, n, _ in rows if k is not None}


def test_rows_after_a_key_change(spark):
    rows = [
        # message_id, idx, identity, id, error, final_id
        (1, 0, "A", None, None, "new"), (1, 1, "A", "x", None, "X"), (1, 2, "A", None, None, "new"),
        (2, 0, "A", "y", "refused", "Y"), (2, 1, "A", None, None, "new"), (3, 0, "A", "z", None, "Z"), (3, 1, "A", None, None, "new"),
        (4, 0, "B", None, None, "b"), (5, 0, None, None, None, "n"),
    ]
    frame = spark.createDataFrame(rows, "message_id int, idx int, identity string, id string, error string, final_id string").withColumn("entity_name", F.lit("e"))
    found = {(r["message_id"], r["idx"]): r["as_of_id"] for r in R.ids_as_of(frame).collect()}
    assert found == {(1, 2): "X", (2, 1): "X", (3, 1): "Z"}


def test_many_key_sets_are_matched_by_compiled_code(spark):
    """What is done for every table row and set has no lambda; nulls and more columns than bits do as before."""
    columns = [f"c{i:02}" for i in range(70)]
    catalog = Catalog.from_rows([("part", "partid", "guid"), *[("part", c, "long") for c in columns]])
    rows = [("a", *range(70)), ("b", None, *range(1, 70))]
    table = spark.createDataFrame(rows, "partid string, " + ", ".join(f"{c} bigint" for c in columns))
    sets = [("c00", "c01"), ("c01", "c69"), ("c63",)]
    found = R.scan_key_sets(table, catalog, "part", sets)
    got = sorted((r["match_id"], r["identity"]) for r in found.collect())
    assert got == [("a", "c00=0,c01=1"), ("a", "c01=1,c69=69"), ("a", "c63=63"), ("b", "c01=1,c69=69"), ("b", "c63=63")]
    asked = R.wanted_filter(spark.createDataFrame([("part", "c63=63")], "entity_name string, identity string"))
    kept = R.scan_key_sets(table, catalog, "part", sets, asked)
    assert {r["identity"] for r in kept.collect()} == {"c63=63"}
    assert "lambda" not in kept._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]

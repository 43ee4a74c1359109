"""Positions and running values equal the plain window, also with a hot key."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from callweave.functions.keys import dataset_digest, digest
from callweave.operators import ranking


def frame(spark, n=3000):
    rng = random.Random(7)
    data = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(50)}", i, rng.randrange(500), rng.random()) for i in range(n)]
    return data, spark.createDataFrame(data, "k string, id int, at int, v double")


def test_positions_equal_the_plain_window_for_hot_and_small_keys(spark):
    data, df = frame(spark)
    got = {(r.k, r.id): (r.position, r.size) for r in ranking.positions(df, ["k"], ["at", "id"], F.floor(F.col("at") / 10), size="size").collect()}
    want = {}
    for key in {d[0] for d in data}:
        mine = sorted((d for d in data if d[0] == key), key=lambda d: (d[2], d[1]))
        want.update({(key, d[1]): (i, len(mine)) for i, d in enumerate(mine, 1)})
    assert got == want


def test_running_sum_and_max(spark):
    data, df = frame(spark)
    sums = ranking.prefix_scan(df, ["k"], ["at", "id"], F.floor(F.col("at") / 10), F.col("v"), "run")
    tops = ranking.prefix_scan(df, ["k"], ["at", "id"], F.floor(F.col("at") / 10), F.col("v"), "run", "max")
    got_sum = {r.id: r.run for r in sums.collect()}
    got_max = {r.id: r.run for r in tops.collect()}
    for key in {d[0] for d in data}:
        total, top = 0.0, 0.0
        for d in sorted((d for d in data if d[0] == key), key=lambda d: (d[2], d[1])):
            total, top = total + d[3], max(top, d[3])
            assert abs(got_sum[d[1]] - total) < 1e-9 and got_max[d[1]] == top


def test_hash_rank_is_the_global_order(spark):
    _, df = frame(spark)
    hashed = df.withColumn("h", digest("s", F.col("id")))
    got = [r.id for r in ranking.hash_rank(hashed, "h", "n").orderBy("n").collect()]
    assert got == [r.id for r in hashed.orderBy("h").collect()]
    per = ranking.hash_rank(hashed, "h", "n", strata=["k"]).filter("k = 'hot'").orderBy("n").collect()
    assert [r.id for r in per] == [r.id for r in hashed.filter("k = 'hot'").orderBy("h").collect()]


def test_no_window_holds_a_whole_hot_key(spark):
    _, df = frame(spark)
    plan = ranking.positions(df, ["k"], ["at", "id"], F.floor(F.col("at") / 10))._jdf.queryExecution().optimizedPlan().toString()
    wide = [line for line in plan.splitlines() if "Window" in line and "id#" in line]
    assert wide and all("__bucket" in line for line in wide)


def test_islands_number_consecutive_runs(spark):
    flags = [0, 1, 1, 0, 1, 0, 0, 1, 1, 1]
    df = spark.createDataFrame([("c", i + 1, bool(f)) for i, f in enumerate(flags)], "call_id string, position int, bad boolean")
    got = {r.position: r.run for r in ranking.islands(df, ["call_id"], "position", F.col("bad"), F.floor(F.col("position") / 3), "run").collect()}
    assert got == {2: 0, 3: 0, 5: 1, 8: 2, 9: 2, 10: 2}


def test_digest_matches_the_json_text_and_dataset_digest_sees_changes(spark):
    import hashlib
    import json
    df = spark.createDataFrame([("12", 3)], "a string, b int")
    assert df.select(digest("seed", F.col("a"))).first()[0] == hashlib.sha256(json.dumps(["seed", "12"]).encode()).hexdigest()
    assert df.select(digest("seed", ("number", F.col("b")), "x")).first()[0] == hashlib.sha256(json.dumps(["seed", 3, "x"]).encode()).hexdigest()
    one = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    same = spark.createDataFrame([("b", 2), ("a", 1)], "k string, v int")
    other = spark.createDataFrame([("a", 1), ("b", 3)], "k string, v int")
    digests = [dataset_digest(d).first()["sha256"] for d in (one, same, other)]
    assert digests[0] == digests[1] != digests[2]


def test_null_keys_and_dates_keep_their_rows(spark, rows):
    """Equals the plain window, nulls included."""
    data = [(k, d, n, v) for n, (k, d, v) in enumerate([("a", "2026-01-01", 3), ("a", None, 5), ("a", "2026-01-02", 1), (None, "2026-01-01", 7), (None, "2026-01-03", 2), (None, None, 4)])]
    df = spark.createDataFrame(data, "k string, d string, n int, v int").withColumn("d", F.col("d").cast("date"))
    w = Window.partitionBy("k").orderBy("d", "n").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("out", F.sum("v").over(w)).withColumn("size", F.sum("v").over(Window.partitionBy("k")))
    assert rows(ranking.prefix_scan(df, ["k"], ["d", "n"], F.col("d"), F.col("v").cast("bigint"), "out", size="size").select(want.columns)) == rows(want)
    placed = ranking.positions(df, ["k"], ["d", "n"], F.col("d"), "at")
    assert placed.count() == 6
    after = ranking.neighbour(placed, ["k"], "at", ["v"], 1, "next_")
    assert rows(after.select("k", "d", "next_v")) == rows(df.select("k", "d", F.lead("v").over(Window.partitionBy("k").orderBy("d", "n"))))

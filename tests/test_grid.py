from collections import Counter

from pyspark.sql import functions as F

from crosslane.operators import grid


def test_a_hot_key_is_dealt_to_many_tasks_and_loses_no_pair(spark, monkeypatch):
    """One molecule holds nearly all rows: no task makes more than 1 in 64 of all pairs."""
    monkeypatch.setattr(grid, "CELL_PAIRS", 100)
    hot, n = spark.range(3000).select(F.col("id"), F.lit("one").alias("k"), (F.col("id") % 7).alias("v")), 3000
    rest = spark.range(3000, 3100).select("id", (F.col("id") % 40).cast("string").alias("k"), F.lit(None).cast("long").alias("v"))
    null = spark.range(4000, 4050).select("id", F.lit(None).cast("string").alias("k"), F.lit(1).cast("long").alias("v"))
    rows = hot.unionByName(rest).unionByName(null).cache()
    got = grid.self_join(rows, ["k"])
    assert sorted(got.columns) == ["id_a", "id_b", "k", "v_a", "v_b"]
    tasks = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    want = Counter(r.k for r in rows.collect() if r.k)
    pairs = sum(x * x for x in want.values())
    assert sum(tasks) == pairs and max(tasks) <= pairs / 64 and n * n < pairs
    assert got.select("id_a", "id_b").distinct().count() == pairs
    assert got.where("k = 'one' and v_a is not null and v_b is not null and v_a = id_a % 7 and v_b = id_b % 7").count() == n * n


def test_without_a_hot_key_it_is_a_plain_join(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, "a", "x"), (3, "b", "y"), (4, None, "z")], "id long, k string, v string")
    got = {tuple(r) for r in grid.self_join(rows, ["k"]).collect()}
    assert got == {("a", 1, None, 1, None), ("a", 1, None, 2, "x"), ("a", 2, "x", 1, None), ("a", 2, "x", 2, "x"), ("b", 3, "y", 3, "y")}
    assert grid.self_join(rows.limit(0), ["k"]).count() == 0

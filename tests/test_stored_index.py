import shutil
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from crosslane.operators import fx, lanes, policy, quality, stored_index
from crosslane.sources import archive

from .test_operators import DAY, record, records


def dated(spark, rows, day):
    return records(spark, rows).withColumn("snapshot_date", F.lit(day).cast("date"))


def profiles(df):
    return quality.plausibility(quality.numeric_profile(df, "price_amount", quality.SNAPSHOT))


def test_a_new_snapshot_is_added_without_the_others(spark, tmp_path):
    semantics = ("ex_factory", "vat_exclusive", "none", "published")
    rules = spark.createDataFrame([(f"p-{c}", c, "list", "ex_factory", DAY(2020, 1, 1), None, None, "high", None, [], ["s"], semantics, []) for c in ("IE", "PL", "FR")], policy.POLICY)
    rates = spark.createDataFrame([("EUR", "PLN", DAY(2024, 1, 1), Decimal(4), "", None), ("EUR", "PLN", DAY(2024, 9, 2), Decimal(5), "", None)], fx.RATE)
    batches = {
        "IE": dated(spark, [record("i1", "IE", "paracetamol", "3.00", 30), record("i2", "IE", "ibuprofen", "4.00", 20)], "2024-09-01"),
        "PL": dated(spark, [record("p1", "PL", "paracetamol", "12.00", 30, "PLN")], "2024-09-02"),
        "FR": dated(spark, [record("f1", "FR", "paracetamol", "0", 30)], "2024-08-01"),  # its only price is zero, so the gate blocks it
    }
    path = f"file://{tmp_path}/index"
    first, rest = dict(list(batches.items())[:1]), dict(list(batches.items())[1:])
    for df in first.values():
        df.write.parquet(f"{tmp_path}/lists/IE")
        stored_index.add(spark.read.parquet(f"{tmp_path}/lists/IE"), rules, profiles(df), path)
    shutil.rmtree(tmp_path / "lists")  # what was added isn't read again
    before = stored_index.read(spark, path, rates)
    assert {r.id: float(r.amount_eur) for r in before.collect()} == {"i1": 3.0, "i2": 4.0}
    for df in rest.values():
        stored_index.add(df, rules, profiles(df), path)
    asked = [("IE", "2024-09-01"), ("PL", "2024-09-02"), ("FR", "2024-08-01"), ("FR", "2024-10-01")]
    assert stored_index.missing(spark, path, asked) == [("FR", "2024-10-01")]
    with pytest.raises(archive.SnapshotExists):
        stored_index.add(batches["FR"], rules, profiles(batches["FR"]), path)
    every = batches["IE"].unionByName(batches["PL"]).unionByName(batches["FR"])
    full = lanes.lane_index(every, rules, profiles(every), rates)
    cols = ["id", "snapshot_date", "lane_key", "identity_key", "product_type", "amount_eur", "eur_per_strength"]
    got = stored_index.read(spark, path, rates)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, full.select(cols).collect()))
    assert {r.id: float(r.amount_eur) for r in got.collect()} == {"i1": 3.0, "i2": 4.0, "p1": 2.4}
    assert [r.id for r in stored_index.read(spark, path, rates, countries=["PL"]).collect()] == ["p1"]


def test_rules_key_follows_the_rows_alone(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, y string")
    same = stored_index.rules_key(df)
    assert stored_index.rules_key(df.orderBy(F.desc("x")).select("y", "x")) == same
    assert stored_index.rules_key(df.withColumn("y", F.lit("b"))) != same and stored_index.rules_key(df.limit(1)) != same


def test_an_empty_index(spark, tmp_path):
    rates = spark.createDataFrame([], fx.RATE)
    assert stored_index.read(spark, f"file://{tmp_path}/none", rates).count() == 0

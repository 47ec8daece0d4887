import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from crosslane.sources import archive

DAY = datetime.date
KIND = "v long, country_code string, snapshot_date date"


def snap(spark, day, country="FR", rows=3):
    return spark.range(rows).select(F.col("id").alias("v"), F.lit(country).alias("country_code"), F.lit(day).cast("date").alias("snapshot_date"))


def counts(spark, path, table="prices"):
    return {(r.country_code, r.snapshot_date): r["count"] for r in archive.read(spark, path, table, "v long").groupBy(*archive.KEYS).count().collect()}


def test_a_second_date_is_added_and_a_date_is_never_replaced(spark, tmp_path):
    path = f"file://{tmp_path}/archive"
    assert counts(spark, path) == {} and archive.snapshots(spark, path) == []
    assert archive.commit({"prices": snap(spark, "2026-05-01"), "raw": snap(spark, "2026-05-01", rows=5)}, path) == ["country_code=FR/snapshot_date=2026-05-01"]
    archive.commit({"prices": snap(spark, "2026-05-02").unionByName(snap(spark, "2026-05-01", "IE", 1))}, path)
    before = sorted(p for p in (tmp_path / "archive").rglob("*") if p.is_file())
    both = snap(spark, "2026-05-03").unionByName(snap(spark, "2026-05-01"))  # one date is new, the other isn't
    with pytest.raises(archive.SnapshotExists, match="2026-05-01"):
        archive.commit({"prices": both}, path)
    assert sorted(p for p in (tmp_path / "archive").rglob("*") if p.is_file()) == before
    assert counts(spark, path) == {("FR", DAY(2026, 5, 1)): 3, ("FR", DAY(2026, 5, 2)): 3, ("IE", DAY(2026, 5, 1)): 1}
    assert counts(spark, path, "raw") == {("FR", DAY(2026, 5, 1)): 5}
    assert archive.read(spark, path, "prices", "v long", ["country_code=IE/snapshot_date=2026-05-01"]).count() == 1


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/archive"
    bad = snap(spark, "2026-05-01").withColumn("v", F.when(F.col("v") == 2, F.raise_error(F.lit("broken"))).otherwise(F.col("v")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        archive.commit({"prices": snap(spark, "2026-05-01"), "raw": bad}, path)
    assert [p for p in (tmp_path / "archive").rglob("*") if p.is_file()] == [] and archive.snapshots(spark, path) == []
    assert archive.commit({"prices": snap(spark, "2026-05-01").limit(0)}, path) == []


def test_a_large_snapshot_has_several_files(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "64k")
    try:
        rows = spark.range(60_000).select(F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("t"), F.lit("FR").alias("country_code"), F.when(F.col("id") < 5, "2026-05-01").otherwise("2026-05-02").cast("date").alias("snapshot_date"))
        archive.commit({"prices": rows}, f"file://{tmp_path}/archive")
    finally:
        spark.conf.unset(size)
    files = {d.name: len(list(d.rglob("*.parquet"))) for d in Path(tmp_path, "archive/country_code=FR").iterdir()}
    assert files["snapshot_date=2026-05-01"] == 1 and files["snapshot_date=2026-05-02"] > 3


def test_raw_records_keep_every_field(spark):
    raw = spark.createDataFrame([(1, "x", None), (2, "", "z")], "row_index int, `a b` string, c string")
    got = {r.row_index: r.raw_fields for r in archive.raw_records(raw, "IE", F.lit("2026-05-01").cast("date"), F.lit("doc")).collect()}
    assert got == {"1": {"a b": "x"}, "2": {"a b": "", "c": "z"}}

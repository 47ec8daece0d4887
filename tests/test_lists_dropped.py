"""Lists leave nothing behind, and one snapshot is added without a shuffle and refused before it is written."""

import os

import pytest
from crosslane.plans import list_queries
from crosslane.sources import archive, tables
from pyspark.sql import functions as F

from .conftest import DATA


def test_lists_are_compressed_and_dropped_when_they_have_been_judged(spark, monkeypatch):
    folders, make = [], tables.shared_path
    monkeypatch.setattr(tables, "shared_path", lambda s, name: folders.append((name, make(s, name))) or folders[-1][1])
    seen, read = [], list_queries._read_back

    def read_back(spark_, code, raw):
        back, path = read(spark_, code, raw)
        seen.append({f.rsplit(".", 1)[-1] for f in os.listdir(path.removeprefix("file://")) if f.startswith("part-")})
        return back, path

    monkeypatch.setattr(list_queries, "_read_back", read_back)
    n = list_queries.canonical_by_country(spark, DATA).count()
    assert n and len(seen) == 8 and all(x == {"gz"} for x in seen)
    left = {name for name, path in folders if os.path.exists(path.removeprefix("file://"))}
    assert not [x for x in left if x.startswith("list-")] and [x for x, _ in folders if x.startswith("list-")]


def test_one_snapshot_is_written_as_it_lies_and_refused_before_it_is_written(spark, tmp_path):
    path = f"file://{tmp_path}/archive"
    rows = spark.range(10).select("id", F.lit("XX").alias("country_code"), F.lit("2026-05-01").cast("date").alias("snapshot_date"))
    assert archive.commit({"raw": rows, "none": rows.where("id < 0")}, path, one=True) == ["country_code=XX/snapshot_date=2026-05-01"]
    assert archive.read(spark, path, "raw", "id long").count() == 10
    fails = rows.withColumn("id", F.when(F.col("id") > 0, F.raise_error(F.lit("written"))).otherwise(F.col("id")))
    with pytest.raises(archive.SnapshotExists):
        archive.commit({"raw": fails}, path, one=True)

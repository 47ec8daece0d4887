"""The archive of dated snapshots: each is committed once, whole, and never changed.

The tables of a snapshot lie together in one folder (country_code=X/snapshot_date=Y/table). They are written to a staging
folder, which no reader sees, and one rename of the dated folder makes a snapshot visible: a reader finds
all of its tables or none, and a write that fails leaves nothing.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import stable_id

KEYS = ["country_code", "snapshot_date"]


class SnapshotExists(ValueError):
    """A dated snapshot is there already."""


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(root.toUri(), spark._jsc.hadoopConfiguration()), lambda p: jvm.org.apache.hadoop.fs.Path(p), root.getFileSystem(spark._jsc.hadoopConfiguration())


def _dated(fs, at, folder: str) -> list[str]:
    """The country_code=X/snapshot_date=Y folders below ``folder``; a name for each snapshot of a batch comes to the driver."""
    found = fs.globStatus(at(f"{folder}/country_code=*/snapshot_date=*")) or []
    return sorted("/".join(s.getPath().toString().rstrip("/").rsplit("/", 2)[1:]) for s in found)


def commit(tables: dict[str, DataFrame], path: str, one: bool = False) -> list[str]:
    """Add the snapshots of ``tables`` (name: rows with country_code and snapshot_date) to the archive; their folders, in order.

    If any of the snapshots is there already, SnapshotExists is raised and nothing is added. A snapshot of very many rows
    becomes several files: Spark splits what is too large and joins what is too small for one. Where ``one`` says that all rows are of one snapshot
    they are written as they lie, by a few tasks, and aren't shuffled. Of two writers of one snapshot
    the second fails at its rename. Empty tables add nothing.
    """
    spark = next(iter(tables.values())).sparkSession
    files, at, fs = _files(spark, path)
    staging = f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    plain = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    if one:  # a snapshot that is there is refused before anything is written, where its first row tells it
        told = [r for r in (rows.select(*[F.col(k).cast("string") for k in KEYS]).first() for rows in tables.values()) if r]
        there = {d for d in ("/".join(f"{k}={r[k]}" for k in KEYS) for r in told) if fs.exists(at(f"{path}/{d}"))}
        if there:
            raise SnapshotExists(f"in the archive already: {', '.join(sorted(there))}")
    try:
        for name, rows in tables.items():
            dealt = rows.coalesce(4 * spark.sparkContext.defaultParallelism) if one else rows.hint("rebalance", *KEYS)
            dealt.write.partitionBy(*KEYS).parquet(f"{staging}/{name}", compression="zstd")
        whole: dict[str, list[str]] = {}
        for name in tables:
            for dated in _dated(fs, at, f"{staging}/{name}"):
                whole.setdefault(dated, []).append(name)
        there = [d for d in whole if fs.exists(at(f"{path}/{d}"))]
        if there:
            raise SnapshotExists(f"in the archive already: {', '.join(sorted(there))}")
        for dated, names in sorted(whole.items()):
            fs.mkdirs(at(f"{staging}/whole/{dated}"))
            for name in names:
                files.rename(at(f"{staging}/{name}/{dated}"), at(f"{staging}/whole/{dated}/{name}"), plain)
            fs.mkdirs(at(f"{path}/{dated}").getParent())
            try:
                files.rename(at(f"{staging}/whole/{dated}"), at(f"{path}/{dated}"), plain)
            except Py4JJavaError as e:
                if "FileAlreadyExists" in str(e.java_exception.toString()):
                    raise SnapshotExists(f"another writer added {dated}") from e
                raise
        return sorted(whole)
    finally:
        fs.delete(at(staging), True)


def snapshots(spark: SparkSession, path: str) -> list[str]:
    """Folders of the snapshots in the archive, from their names alone."""
    _, at, fs = _files(spark, path)
    return _dated(fs, at, path.rstrip("/"))


def read(spark: SparkSession, path: str, table: str, schema: str, only: list[str] | None = None) -> DataFrame:
    """One table of all snapshots, or of the folders named in ``only``, with country_code and snapshot_date from the folders.
    Snapshots without the table have no rows; nor has an empty archive."""
    _, at, fs = _files(spark, path)
    dated = snapshots(spark, path) if only is None else only
    found = [p for p in (f"{path}/{d}/{table}" for d in dated) if fs.exists(at(p))]
    full = f"{schema}, country_code string, snapshot_date date"
    return spark.read.schema(full).option("basePath", path).parquet(*found) if found else spark.createDataFrame([], full)


def raw_records(raw: DataFrame, country: str, snapshot: Column, document: Column) -> DataFrame:
    """The rows of a list as they are: id, source_document_id, row_index and raw_fields, a map of its columns. The ids are those that
    canonical rows and anomalies refer to."""
    fields = [c for c in raw.columns if c != "row_index"]
    one = F.map_filter(F.map_from_arrays(F.array(*[F.lit(c) for c in fields]), F.array(*[F.col(f"`{c}`").cast("string") for c in fields])), lambda _, v: v.isNotNull())
    return raw.select(
        stable_id(F.lit("raw"), F.lit(country), snapshot, F.col("row_index")).alias("id"), document.alias("source_document_id"), F.col("row_index").cast("string").alias("row_index"), one.alias("raw_fields"),
        F.lit(country).alias("country_code"), snapshot.alias("snapshot_date"),
    )


def snapshot_counts(raw: DataFrame, canonical: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Raw, canonical and anomaly counts of each snapshot that has raw rows."""
    counted = [df.groupBy(*KEYS).agg(F.count("*").alias(n)) for df, n in ((raw, "n_raw"), (canonical, "n_canonical"), (anomalies, "n_anomalies"))]
    return counted[0].join(counted[1], KEYS, "left").join(counted[2], KEYS, "left").fillna(0, ["n_canonical", "n_anomalies"])

"""Shared folder, written tables and skew-safe lookups used by the operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of one Arrow batch: texts are long, and a worker holds a batch at a time.
BATCH_ROWS = 1000
#: Bytes that a task gathers before it writes them to an intermediate table.
ROW_GROUP_BYTES = 16 << 20
#: Most keys of dropped rows that are broadcast, of a few dozen bytes each.
MOST_DROPPED = 500_000
#: A group is hot from one in HOT_SHARE rows on, so that fewer than HOT_SHARE groups can be hot.
HOT_SHARE = 512


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only where Spark runs in this process."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not hasattr(spark, "_crosslane_dir"):
        spark._crosslane_dir = "file://" + tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp"))
    return spark._crosslane_dir


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage and outlives executors."""
    path = new_path(df.sparkSession, name)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer splits than there are cores (one file with one row group, say) is dealt to all of them; any other
    is left as it is, so a large table isn't shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def with_row_keys(docs: DataFrame, id_col: str) -> tuple[DataFrame, str]:
    """``docs``, written, with a key for each row that sorts by id (null last) and tells repeated ids apart; the key's name."""
    name = f"_key_{uuid.uuid4().hex[:8]}"
    one = F.col(f"`{id_col}`")
    return written(docs.withColumn(name, F.struct(one.isNull().alias("none"), one.alias("id"), F.monotonically_increasing_id().alias("row"))), "rows"), name


def in_order(rows: DataFrame, groups: list[str], order: list[str], totals: dict[str, str] | None = None) -> DataFrame:
    """Add ``_rank``, each row's place (from 0) in its group by the columns of ``order`` (nulls first), and for each name of
    ``totals`` the running total of its column, this row included. Columns of ``groups`` may not be null.

    Rows are dealt by ranges of groups and order together and only counts of these pieces are added up, so a group of any size is
    spread over many tasks. A piece that continues its group is the first of its partition: fewer of them than partitions.
    """
    totals = totals or {}
    by = [*groups, *order]
    dealt = written(rows.repartitionByRange(*by).sortWithinPartitions(*by).select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), "ordered")
    adds = {"_rank": F.count("*"), **{n: F.sum(c) for n, c in totals.items()}}
    pieces = dealt.groupBy(*groups, "_part").agg(*[x.alias(f"_n{i}") for i, x in enumerate(adds.values())])
    past = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = pieces.select(*groups, "_part", *[F.sum(f"_n{i}").over(past).alias(f"_n{i}") for i in range(len(adds))]).where("_n0 IS NOT NULL")
    inside = Window.partitionBy(*groups, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = dealt.select("*", (F.row_number().over(Window.partitionBy(*groups, "_part").orderBy("_at")) - 1).cast("long").alias("_rank"), *[F.sum(c).over(inside).alias(n) for n, c in totals.items()])
    joined = numbered.join(F.broadcast(before), [*groups, "_part"], "left")
    return joined.select(*rows.columns, *[(F.col(n) + F.coalesce(f"_n{i}", F.lit(0))).alias(n) for i, n in enumerate(adds)])


def without(rows: DataFrame, name: str, dropped: DataFrame) -> DataFrame:
    """``rows`` of ``with_row_keys`` but those whose key is in ``dropped``. Texts stay where they are while the dropped
    rows are counted to be few; else both sides are shuffled."""
    lost = f"_gone_{uuid.uuid4().hex[:8]}"  # no column of the rows has this name
    gone = written(dropped.select(F.col(f"{name}.row").alias(lost)), "dropped")
    few = gone.limit(MOST_DROPPED + 1).count() <= MOST_DROPPED
    return rows.join(F.broadcast(gone) if few else gone, F.col(f"{name}.row") == F.col(lost), "left_anti")


def with_group(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """Left join of ``rows`` with one row of ``groups`` for each key, which holds its number of rows in ``size``.

    Rows of hot keys meet their group in a broadcast table of fewer than HOT_SHARE rows
    (its bound follows from the sizes); all others are joined by a shuffle.
    Both inputs are read twice, so pass written tables.
    """
    least, mark = max(1000, total // HOT_SHARE), f"_hot_{uuid.uuid4().hex[:8]}"
    hot, rest = groups.where(F.col(size) > least), groups.where(F.col(size) <= least)
    marked = rows.join(F.broadcast(hot.select(*keys, F.lit(True).alias(mark))), keys, "left")
    return (
        marked.where(F.col(mark)).drop(mark).join(F.broadcast(hot), keys, "left")
        .unionByName(marked.where(F.col(mark).isNull()).drop(mark).join(rest, keys, "left"))
    )


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each Spark context, and keep the session's Arrow batches small."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    context = spark.sparkContext
    if getattr(context, "_crosslane_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="spark-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._crosslane_shipped = True


def shipped(query: Callable) -> Callable:
    @wraps(query)
    def run(spark: SparkSession, *rest):
        ship(spark)
        return query(spark, *rest)

    return run

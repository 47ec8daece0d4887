"""Exact deduplication against a persistent digest index.

The index has two tables, bucketed by the digest of the normalised text: a main one with one sorted file for each bucket, which a
sort-merge join reads without a shuffle or a sort, and a small one of what came in since. A batch is digested, aggregated to one row for
each digest, anti-joined with both, and what is new is appended to the small table. When that has grown to a part of the main one,
both become a new main table, with as many buckets as its digests ask for; so each digest is rewritten a few times at most. Each digest
carries the batch that brought it: a batch that is judged again, after a failure say, meets its own digests as new ones and appends none twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .work import shared_dir, spread, with_group, with_row_keys, without, written

#: Digests that a bucket is made for, and the fewest and most buckets; the small table is merged from one in MERGE_SHARE of the main one's digests on.
BUCKET_DIGESTS, LEAST_BUCKETS, MOST_BUCKETS, MERGE_SHARE = 2_000_000, 8, 1 << 15, 4


def normalised(text: Column) -> Column:
    """Null as empty; each run of 0x20 and 0x09-0x0D is one space (a lone space is left alone)."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D\x20]{2,}|[\x09-\x0D]", " ")


def digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def _save(rows: DataFrame, table: str, buckets: int, mode: str) -> None:
    """As a table bucketed and sorted by digest, in the shared folder."""
    path = f"{shared_dir(rows.sparkSession)}/{table}-{uuid.uuid4().hex}"
    out = rows.write.mode(mode).bucketBy(buckets, "digest").sortBy("digest").format("parquet")
    (out if rows.sparkSession.catalog.tableExists(table) else out.option("path", path)).saveAsTable(table)


def _told(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}


def _buckets(digests: int) -> int:
    buckets = LEAST_BUCKETS
    while buckets * BUCKET_DIGESTS < digests and buckets < MOST_BUCKETS:
        buckets *= 2
    return buckets


def open_index(spark: SparkSession, index: str, id_type: str) -> tuple[DataFrame, DataFrame]:
    """The main and the small table of ``index``, which are made empty where they don't exist; ``index`` itself is a view of both."""
    # Spark tells the order of a bucket with one file only where it is asked to look.
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    there = spark.catalog.tableExists
    if not there(f"{index}_main") and there(f"{index}_next"):  # a merge that was stopped at its end
        spark.sql(f"ALTER TABLE {index}_next RENAME TO {index}_main")
    for name in (f"{index}_main", f"{index}_new"):
        if not there(name):
            _save(spark.createDataFrame([], f"digest binary, keep_id {id_type}, batch string"), name, LEAST_BUCKETS, "append")
    if not there(index):
        spark.sql(f"CREATE VIEW {index} AS SELECT * FROM {index}_main UNION ALL SELECT * FROM {index}_new")
    return spark.table(f"{index}_main"), spark.table(f"{index}_new")


def unseen(groups: DataFrame, main: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of ``groups`` whose digest neither table has; the main one is read in its own order."""
    return groups.hint("merge").join(main.hint("merge"), "digest", "left_anti").join(new, "digest", "left_anti")


def merge(spark: SparkSession, index: str, digests: int) -> None:
    """Both tables as a new main one of one sorted file for each bucket. A merge that fails leaves the tables as they were; one that is
    stopped between its last steps is ended by the next ``open_index``."""
    buckets, main, new = _buckets(digests), spark.table(f"{index}_main"), spark.table(f"{index}_new")
    _drop(spark, f"{index}_next")
    both = main.unionByName(new.join(main.select("digest"), "digest", "left_anti"))
    # Dealt by the number of the bucket, so that one task has all rows of a bucket and makes one file of them.
    _save(both.repartition(buckets, F.pmod(F.hash("digest"), F.lit(buckets))), f"{index}_next", buckets, "append")
    _drop(spark, f"{index}_main")
    spark.sql(f"ALTER TABLE {index}_next RENAME TO {index}_main")
    _drop(spark, f"{index}_new")


def _drop(spark: SparkSession, table: str) -> None:
    if spark.catalog.tableExists(table):
        place = spark._jvm.org.apache.hadoop.fs.Path(_told(spark, table)["Location"])
        spark.sql(f"DROP TABLE {table}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def deduplicate(docs: DataFrame, index: str, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
    """Judge every row of ``docs`` against the index table named ``index`` and append what is new.

    Returns for each row: the id, keep_id (the row that stays for this text, from this batch or an
    earlier one), group_size (rows of this batch with this text), kept, text_sha256 and _row, which
    tells repeated rows apart.
    In a batch the smallest id stays; null ids come last; of rows that repeat an id, one is kept.
    A null text is an empty one, and all empty texts are equal. An empty batch gives no rows.
    ``batch`` names the batch (a new name by default): judged again under its name it gives the same result.
    """
    spark, batch = docs.sparkSession, batch or uuid.uuid4().hex
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = written(
        docs.select(F.col(id_col), F.unhex(digest(F.col(text_col))).alias("digest"), F.monotonically_increasing_id().alias("_row")),
        "digests",
    )
    first = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("_row").alias("row")))
    groups = written(rows.groupBy("digest").agg(first.alias("first"), F.count("*").alias("group_size")), "groups")
    sums = groups.agg(F.count("*").alias("digests"), F.sum("group_size").alias("rows")).first()
    main, new = open_index(spark, index, id_type)
    fresh = unseen(groups, main, new)
    # Read before the append, so that a digest of an earlier batch keeps its earlier row.
    old = [groups.hint("merge").join(side.where(F.col("batch") != batch), "digest").select("digest", F.col("keep_id").alias("old_id")) for side in (main.hint("merge"), new)]
    earlier = written(old[0].unionByName(old[1]).groupBy("digest").agg(F.min("old_id").alias("old_id")), "earlier")
    _save(fresh.select("digest", F.col("first.id").alias("keep_id"), F.lit(batch).alias("batch")), f"{index}_new", LEAST_BUCKETS, "append")
    have, more = spark.table(f"{index}_main").count(), spark.table(f"{index}_new").count()
    if more * MERGE_SHARE > have:
        merge(spark, index, have + more)
        open_index(spark, index, id_type)
    judged = (
        groups.join(earlier.withColumn("old", F.lit(True)), "digest", "left")
        .where((F.col("group_size") > 1) | F.col("old"))
        .select("digest", "group_size", F.when(F.col("old"), F.col("old_id")).otherwise(F.col("first.id")).alias("keep_id"), F.when(F.col("old").isNull(), F.col("first.row")).otherwise(-1).alias("keep_row"))
    )
    joined = with_group(rows, written(judged, "judged"), ["digest"], "group_size", sums["rows"] or 0)
    alone = F.col("group_size").isNull()
    return joined.select(
        F.col(id_col),
        F.when(alone, F.col(id_col)).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keep_row") == F.col("_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "_row",
    )


def drop_index(spark: SparkSession, table: str) -> None:
    """Remove an index that no later batch will meet. What was judged doesn't read it any more."""
    spark.sql(f"DROP VIEW IF EXISTS {table}")
    for name in (f"{table}_main", f"{table}_new", f"{table}_next"):
        _drop(spark, name)


def kept_rows(docs: DataFrame, index: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is new, with all their columns."""
    numbered, name = with_row_keys(docs, id_col)
    judged = deduplicate(numbered.select(F.col(name), F.col(f"`{text_col}`").alias("_text")), index, name, "_text")
    return without(numbered, name, judged.where("not kept")).select(*[F.col(f"`{c}`") for c in docs.columns])


def new_index_name() -> str:
    return f"digest_index_{uuid.uuid4().hex}"


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, as data comes in: first about half of the ids, from the smallest on, then the rest, which meets their index."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    middle = F.lit(docs.agg(F.percentile_approx("doc_id", 0.5, 1000)).first()[0]).cast("long")
    early = F.coalesce(F.col("doc_id") <= middle, F.lit(False))
    index = new_index_name()
    parts = [deduplicate(docs.where(part), index).drop("_row") for part in (early, ~early)]
    drop_index(spark, index)
    both = written(parts[0].unionByName(parts[1]), "batches")
    # The size of a group counts its rows in either batch.
    sizes = written(both.groupBy("text_sha256").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    total = both.count()
    joined = with_group(both.drop("group_size"), sizes, ["text_sha256"], "n", total)
    return joined.select("doc_id", "keep_id", F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), "kept", "text_sha256")


ORACLE = {
    "op6_exact_dedup": """
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256 FROM d JOIN g USING (text_sha256)
"""
}
QUERIES = {"op6_exact_dedup": op6_exact_dedup}

"""Mixing sources to target weights by capped water-filling.

Shares follow the weights; a source whose share exceeds ``epochs`` times its size is clamped
there and the excess goes to the others by weight until no share is above its cap. A source
then takes each of its rows floor(target / size) times, and a seeded part of them once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .work import in_order as in_order_of_groups
from .work import written

#: Weights of the sources in code point order, repeating; most repetitions of a source.
WEIGHTS, EPOCHS, SEED = (5.0, 2.0, 1.0), 3, 20240901
#: Cells of the seeded order of one source, so that no task ranks a whole source.
CELLS = 1 << 16


def word_count(text: Column) -> Column:
    """Number of runs of characters other than 0x20 and 0x09-0x0D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def in_order(sources: DataFrame, col: str) -> DataFrame:
    """Add ``place``: 0, 1, ... by ``col`` (bytes order is code point order; null last), without gathering rows in one task."""
    spread = written(
        sources.repartitionByRange(F.col(col).isNull(), F.col(col))
        .sortWithinPartitions(F.col(col).isNull(), F.col(col))
        .select("*", F.spark_partition_id().alias("_part")),
        "sources",
    )
    before, counts = 0, []
    for part, n in sorted((r["_part"], r["count"]) for r in spread.groupBy("_part").count().collect()):  # a row for each partition
        counts.append((part, before))
        before += n
    offsets = spread.sparkSession.createDataFrame(counts, "_part int, _before long")
    inside = Window.partitionBy("_part").orderBy(F.col(col).isNull(), F.col(col))
    return spread.join(F.broadcast(offsets), "_part").withColumn("place", F.col("_before") + F.row_number().over(inside) - 1).drop("_part", "_before")


def water_fill(sources: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """Add ``target`` to sources (source, source_size, weight); the targets add up to all sizes.

    Every round clamps the sources whose proportional share is above their cap; only the sums
    over the sources come to the driver. Rounds end when a round clamps none; each clamps one at least.
    """
    cap = F.lit(float(epochs)) * F.col("source_size")
    state = written(sources.withColumn("capped", F.lit(False)), "fill")
    total = float(state.agg(F.sum("source_size")).first()[0] or 0)
    while True:
        sums = state.agg(F.sum(F.when(F.col("capped"), cap)).alias("used"), F.sum(F.when(~F.col("capped"), F.col("weight"))).alias("open")).first()
        used, open_weight = float(sums["used"] or 0.0), float(sums["open"] or 0.0)
        share = F.lit(max(0.0, total - used)) * F.col("weight") / F.lit(open_weight or 1.0)
        over = ~F.col("capped") & (share > cap)
        if not open_weight or not state.where(over).limit(1).count():
            return state.withColumn("target", F.when(F.col("capped"), cap).otherwise(share)).drop("capped")
        state = written(state.withColumn("capped", F.col("capped") | over), "fill")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, epochs: int = EPOCHS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each row of ``docs``: ``doc`` (a struct of its columns, whatever their names), size, source_size, target
    and copies (times taken).

    Whole repetitions are floor(target / source size); the rest goes to rows in a seeded order as long as they fit, then to
    later ones that fit into what is left (see with_fill). Rows are ordered within cells of that order, so a source of any
    size is spread over many tasks. A row without words has size 0 and is taken with the whole repetitions
    only; a source without words has target 0. Rows that repeat an id share its place in the order.
    A null source is a source of its own and comes last. The same seed gives the same mix.
    """
    place = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))), 1, 12), 16, 10).cast("long")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), word_count(F.col(text_col)).alias("_size"), place.alias("_place"), F.col(source_col).cast("string").alias("_source"))
    sizes = written(rows.select("_source", "_size", "_place"), "sizes").withColumn("_cell", (F.col("_place") % CELLS).cast("int"))
    cells = written(sizes.groupBy("_source", "_cell").agg(F.sum("_size").alias("cell_size")), "cells")
    sources = in_order(cells.groupBy("_source").agg(F.sum("cell_size").alias("source_size")), "_source")
    pick = F.array(*[F.lit(float(w)) for w in weights])
    filled = written(water_fill(sources.withColumn("weight", F.element_at(pick, (F.col("place") % len(weights) + 1).cast("int"))), epochs), "targets")
    plan = filled.select(
        "_source", F.col("source_size").alias("_source_size"), F.col("target").alias("_target"),
        F.when(F.col("source_size") > 0, F.least(F.lit(epochs), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("int").alias("_whole"),
    ).withColumn("_rest", F.col("_target") - F.col("_whole") * F.col("_source_size"))
    # A cell is taken whole before the one where the rest ends; there, rows are ranked one by one.
    running = Window.partitionBy("_source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edges = (
        cells.withColumn("_upto", F.sum("cell_size").over(running))
        .join(plan.select("_source", "_rest").withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s")))
        .drop("_s")
        .withColumn("_from", F.col("_upto") - F.col("cell_size"))
    )
    edge = edges.where((F.col("_from") < F.col("_rest")) & (F.col("_upto") >= F.col("_rest"))).select("_source", F.col("_cell").alias("_edge"), F.col("_from"), "_rest")
    inside = sizes.join(edge.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_cell") == F.col("_edge"))).drop("_s")
    by_place = Window.partitionBy("_source").orderBy("_place", "_size")
    # The last place whose rows still fit whole in the edge cell, -1 if none, and the words that are taken up to it.
    run = F.col("_from") + F.sum("_size").over(by_place.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    last = inside.withColumn("_run", run).groupBy("_source", "_edge", "_from").agg(
        F.max(F.when(F.col("_run") <= F.col("_rest"), F.col("_place"))).alias("_last"), F.coalesce(F.max(F.when(F.col("_run") <= F.col("_rest"), F.col("_run"))), F.col("_from")).alias("_filled")
    )
    plan = written(plan.join(last.drop("_from").withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s"), "plan")
    cell = (F.col("_place") % CELLS).cast("int")
    again = (F.col("_rest") > 0) & F.col("_edge").isNotNull() & ((cell < F.col("_edge")) | ((cell == F.col("_edge")) & (F.col("_place") <= F.coalesce("_last", F.lit(-1)))))
    plan = written(with_fill(plan, sizes, again), "filled")
    joined = rows.join(small_side(plan.withColumnRenamed("_source", "_s")), F.col("_source").eqNullSafe(F.col("_s")), "left")
    fills = F.coalesce(F.col("_place") <= F.try_element_at("_fill", F.col("_size")), F.lit(False))
    copies = F.least(F.lit(epochs), F.col("_whole") + F.when((again | fills) & (F.col("_size") > 0), 1).otherwise(0))
    return joined.select("doc", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").cast(T.DoubleType()).alias("target"), copies.cast("int").alias("copies"))


def with_fill(plan: DataFrame, sizes: DataFrame, again: Column) -> DataFrame:
    """Add ``_fill`` to the sources' plan: for sizes of rows behind the cut the last place up to which they are taken as well.

    What the cut leaves open is less than one row. It is filled with the rows that still fit, the largest first and of a size the first
    in order, so what stays open is less than any row that isn't taken. Only counts by size are gathered for a source: at most
    as many as its longest text has words.
    """
    gap = F.floor(F.col("_rest") - F.col("_filled"))
    side = plan.select(F.col("_source").alias("_s"), "_rest", "_edge", "_last", gap.alias("_gap")).where("_gap > 0")
    open_rows = sizes.join(small_side(side), F.col("_source").eqNullSafe(F.col("_s"))).where(~again & (F.col("_size") > 0) & (F.col("_size") <= F.col("_gap")))
    open_rows = open_rows.select(F.coalesce(F.concat(F.lit("="), "_source"), F.lit("")).alias("_key"), "_size", "_place", "_gap")
    counts = open_rows.groupBy("_key", "_size").agg(F.count("*").alias("n"), F.first("_gap").alias("_gap"))
    start = F.struct(F.max("_gap").alias("gap"), F.array().cast("array<struct<size:bigint,n:bigint>>").alias("picks"))

    def take(acc: Column, s: Column) -> Column:
        n = F.least(s["n"], F.floor(acc["gap"] / s["size"]))
        picks = F.when(n > 0, F.concat(acc["picks"], F.array(F.struct(s["size"].alias("size"), n.alias("n"))))).otherwise(acc["picks"])
        return F.struct((acc["gap"] - n * s["size"]).alias("gap"), picks.alias("picks"))

    by_size = F.sort_array(F.collect_list(F.struct(F.col("_size").alias("size"), "n")), asc=False)
    gathered = counts.groupBy("_key").agg(start.alias("start"), by_size.alias("sizes"))
    picks = gathered.select("_key", F.explode(F.aggregate("sizes", F.col("start"), take, lambda a: a["picks"])).alias("p")).select("_key", F.col("p.size").alias("_size"), F.col("p.n").alias("_n"))
    ranked = in_order_of_groups(open_rows.join(picks, ["_key", "_size"]), ["_key", "_size"], ["_place"])
    ends = ranked.where(F.col("_rank") == F.col("_n") - 1).groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("_size", "_place"))).alias("_fill"))
    return plan.join(ends.withColumnRenamed("_key", "_k"), F.coalesce(F.concat(F.lit("="), "_source"), F.lit("")) == F.col("_k"), "left").drop("_k")


def small_side(plan: DataFrame, most: int = 100_000) -> DataFrame:
    """Broadcast the sources' plan only when counted to be small; else the join shuffles and splits hot sources."""
    return F.broadcast(plan) if plan.count() <= most else plan


def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns of ``docs``."""
    return mix(docs, **how).where("copies > 0").select("doc", F.explode(F.sequence(F.lit(1), "copies")).alias("_again")).select("doc.*")


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select(
        F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies"
    )


QUERIES = {"op9_mix_sources": op9_mix_sources}
ORACLE: dict[str, str] = {}

"""Exact quantiles of groups of any size: a sketch tells where they can be, and only what lies there is sorted."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.tables import written

#: Accuracy of the sketch; half widths of the ranges around a quantile, as parts of all values, tried one after another (the last is the whole group).
ACCURACY = 10_000
MARGINS = (3 / ACCURACY, 30 / ACCURACY, 1.0)
#: Most groups whose ranges are broadcast.
MOST_BROADCAST = 100_000


def same(keys: list[str], left: str, right: str) -> Column:
    """Null-safe equality of the keys of two frames with aliases."""
    return reduce(Column.__and__, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def exact_quantiles(rows: DataFrame, keys: list[str], value: str, wanted: tuple[float, ...]) -> DataFrame:
    """(keys, quantiles): for each group the ``wanted`` quantiles of its values (double, nulls left out) with linear interpolation between
    neighbours, as an array; groups without values have no row.

    A mergeable sketch of bounded size gives a range around each quantile. Values in a range are counted by value, those below it counted
    alone; the quantile is read from the running count. So a group is never held in one buffer: one task streams what lies in a
    range, some thousandths of its distinct values. Whether the quantile is in its range is checked; if not, a wider one is taken.
    """
    v = F.col(value).cast("double")
    pairs = rows.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull())
    edges = [(max(0.0, q - m), min(1.0, q + m)) for m in MARGINS for q in wanted]
    sketch = F.percentile_approx("_v", F.array(*[F.lit(x) for e in edges for x in e]), ACCURACY)
    groups = written(pairs.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"), sketch.alias("_at")), "sketch")
    found, left = None, groups
    for m in range(len(MARGINS)):
        at = lambda k, end: F.col("_at")[2 * (m * len(wanted) + k) + end] if MARGINS[m] < 1 else F.col("_least" if end == 0 else "_most")  # noqa: B023, E731
        ranges = left.select(*keys, "_n", F.array(*[F.struct(F.lit(k).alias("k"), at(k, 0).alias("lo"), at(k, 1).alias("hi")) for k in range(len(wanted))]).alias("_ranges"))
        few = ranges.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
        met = pairs.alias("p").join((F.broadcast(ranges) if few else ranges).alias("r"), same(keys, "p", "r")).select(*[F.col(f"p.{k}").alias(k) for k in keys], "_v", "_ranges")
        below = met.groupBy(*keys).agg(*[F.count_if(F.col("_v") < F.col("_ranges")[k]["lo"]).alias(f"_below{k}") for k in range(len(wanted))])
        inside = met.select(*keys, "_v", F.explode(F.filter("_ranges", lambda r: (F.col("_v") >= r["lo"]) & (F.col("_v") <= r["hi"]))["k"]).alias("_k")).groupBy(*keys, "_k", "_v").agg(F.count("*").alias("_c"))
        run = F.sum("_c").over(Window.partitionBy(*keys, "_k").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        counted = inside.withColumn("_upto", run)
        bounds = left.alias("g").join(below.alias("b"), same(keys, "g", "b")).select(*[F.col(f"g.{k}").alias(k) for k in keys], "_n", *[f"_below{k}" for k in range(len(wanted))])
        told = counted.alias("c").join(bounds.alias("b"), same(keys, "c", "b")).select(*[F.col(f"c.{k}").alias(k) for k in keys], "_k", "_v", "_upto", "_n", F.array(*[f"_below{k}" for k in range(len(wanted))])[F.col("_k")].alias("_below"))
        place = (F.col("_n") - 1) * F.array(*[F.lit(q) for q in wanted])[F.col("_k")]
        reached = F.col("_below") + F.col("_upto")
        ends = told.withColumn("_place", place).groupBy(*keys, "_k").agg(
            F.min(F.when(reached > F.floor("_place"), F.col("_v"))).alias("lower"), F.min(F.when(reached > F.ceil("_place"), F.col("_v"))).alias("upper"),
            F.first("_place").alias("_place"), F.first("_below").alias("_below"),
        )
        there = F.col("upper").isNotNull() & (F.col("_below") <= F.floor("_place"))
        one = F.col("lower") + (F.col("upper") - F.col("lower")) * (F.col("_place") - F.floor("_place"))
        done = ends.where(there).groupBy(*keys).agg(F.count("*").alias("_m"), F.transform(F.sort_array(F.collect_list(F.struct("_k", one.alias("q")))), lambda x: x["q"]).alias("quantiles"))
        done = written(done.where(F.col("_m") == len(wanted)).drop("_m"), "quantiles")
        found = done if found is None else found.unionByName(done)
        left = written(left.alias("l").join(done.alias("d"), same(keys, "l", "d"), "left_anti"), "open")
        if left.isEmpty():
            break
    return found

"""As-of lookup by sorting, for any number of events and askers of one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.tables import written


def last_before(asked: DataFrame, events: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """(key, at, value) for each row of ``asked`` (key, at): the value of the last event (key, at, value) at or before it, null if there is none.

    Events and askers are one sorted sequence, dealt by ranges of key and time, in which the last value is carried forward; what a range
    begins with is the last value of the ranges before it. So a key is spread over tasks, however many events or askers it has. Of
    several events at one time the largest value counts; repeated askers are answered each.
    """
    both = events.select(key, at, F.lit(0).alias("_asks"), F.col(value).alias("_value")).unionByName(asked.select(key, at, F.lit(1).alias("_asks"), F.lit(None).cast(events.schema[value].dataType).alias("_value")))
    by = [key, at, "_asks", "_value"]
    dealt = written(both.where(F.col(key).isNotNull() & F.col(at).isNotNull()).repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id()), "sorted")
    inside = Window.partitionBy(key, "_part").orderBy(at, "_asks", "_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = dealt.select("*", F.last("_value", ignorenulls=True).over(inside).alias("_last"))
    ends = dealt.where("_asks = 0").groupBy(key, "_part").agg(F.max_by("_value", F.struct(at, "_value")).alias("_end"))
    # A row for each piece of a key; a piece without events has none of its own, so every part of the askers is there as well.
    pieces = dealt.select(key, "_part").distinct().join(ends, [key, "_part"], "left")
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = pieces.select(key, "_part", F.last("_end", ignorenulls=True).over(before).alias("_begin")).where("_begin is not null")
    return carried.where("_asks = 1").join(begins, [key, "_part"], "left").select(key, at, F.coalesce("_last", "_begin").alias(value))

"""Joining a table with itself on keys of which some may hold very many rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import written

#: Pairs of one cell: at least the first; a key is hot from one in SHARE of all pairs on, so fewer than SHARE keys can be hot.
CELL_PAIRS, SHARE = 4_000_000, 512
#: Most tasks that the cells are dealt to, and the pairs for which a task is named among the other keys.
MOST_TASKS, TASK_PAIRS = 4096, 250_000


def hot_keys(rows: DataFrame, keys: list[str]) -> DataFrame | None:
    """(keys, parts) of the keys with so many rows that their pairs are to be dealt to parts x parts cells; None if there are none.
    Fewer than SHARE rows, so it may be broadcast."""
    return _counted(rows, keys)[0]


def _counted(rows: DataFrame, keys: list[str]) -> tuple[DataFrame | None, float]:
    """``hot_keys``, and the number of all pairs of keys with two rows or more."""
    n = F.col("_n").cast("double")
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    told = sizes.agg(F.sum(n * n).alias("pairs"), F.max(n).alias("most")).first()
    side = max(CELL_PAIRS, (told["pairs"] or 0.0) / SHARE) ** 0.5  # rows of either side that meet in a cell
    if (told["most"] or 0.0) <= side:
        return None, told["pairs"] or 0.0
    return written(sizes.where(n > side).select(*keys, F.ceil(n / side).cast("int").alias("_parts")), "hot"), told["pairs"]


def cells(rows: DataFrame, hot: DataFrame, keys: list[str], across: bool, part: Column) -> DataFrame:
    """The rows of hot keys with _row and _col: each belongs to one part (a hash, ``part``), which is its row, or its column where
    ``across``, and goes to all cells of it."""
    own = F.pmod(part, F.col("_parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    met = rows.join(F.broadcast(hot), keys)
    return met.select(*rows.columns, *([every.alias("_row"), own.alias("_col")] if across else [own.alias("_row"), every.alias("_col")]))


def self_join(rows: DataFrame, keys: list[str], id_col: str = "id") -> DataFrame:
    """Inner join of ``rows`` with itself on ``keys``: other columns as name_a and name_b. Null keys meet nothing.

    Keys are counted first. The rows of a hot key are a grid of cells, each of which joins one part of either side in a
    task of its own, so no task has more than a small share of all pairs; the other keys are joined as they are.
    """
    side = lambda df, s: df.select(*[F.col(c).alias(c if c in (*keys, "_row", "_col") else f"{c}_{s}") for c in df.columns])
    there = rows.na.drop(subset=keys)
    hot, n_pairs = _counted(there, keys)
    # A number of tasks is named, else Spark would put keys together by the bytes that they read, not by the pairs they make.
    n_tasks = min(MOST_TASKS, int(n_pairs // TASK_PAIRS))
    dealt = lambda df: df.repartition(n_tasks, *keys) if n_tasks > 1 else df
    if hot is None:
        return dealt(side(there, "a")).join(dealt(side(there, "b")), keys)
    cold = there.join(F.broadcast(hot.drop("_parts")), keys, "left_anti")
    few = dealt(side(cold, "a")).join(dealt(side(cold, "b")), keys)
    part = F.xxhash64(id_col)
    tasks = min(MOST_TASKS, int(hot.agg(F.sum(F.col("_parts") * F.col("_parts"))).first()[0]))
    on = [*keys, "_row", "_col"]
    a, b = (side(cells(there, hot, keys, across, part), s).repartition(tasks, *on) for s, across in (("a", False), ("b", True)))
    return few.unionByName(a.join(b.hint("shuffle_hash"), on).drop("_row", "_col"))

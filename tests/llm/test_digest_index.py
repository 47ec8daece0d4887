"""The index of exact deduplication over several batches: its plan, its merges and what a stopped merge leaves."""

import pytest
from pyspark.sql import functions as F

from crosslane.llm import exact_dedup


def batch(spark, first, last):
    return spark.range(first, last).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 900).cast("string")).alias("text"))


def judged(rows):
    return {r.doc_id: (r.keep_id, r.kept) for r in rows.collect()}


@pytest.mark.parametrize("small", [True, False])
def test_batches_meet_what_came_before(spark, monkeypatch, small):
    if small:  # so that a merge has to add buckets
        monkeypatch.setattr(exact_dedup, "BUCKET_DIGESTS", 20)
    index = exact_dedup.new_index_name()
    got = {}
    for first, last in ((0, 10), (10, 600), (600, 640), (640, 1000)):
        got |= judged(exact_dedup.deduplicate(batch(spark, first, last), index, batch=str(first)))
    assert got == {i: (i % 900, i < 900) for i in range(1000)}
    tables = [t.name for t in spark.catalog.listTables() if t.name.startswith(index)]
    assert sorted(tables) == [index, f"{index}_main", f"{index}_new"]
    buckets = int(exact_dedup._told(spark, f"{index}_main")["Num Buckets"])
    assert buckets == (64 if small else 8)
    # Judged again under its name a batch gives the same, and adds nothing.
    n = spark.table(index).count()
    assert judged(exact_dedup.deduplicate(batch(spark, 640, 1000), index, batch="640")) == {i: (i % 900, i < 900) for i in range(640, 1000)}
    assert spark.table(index).count() == n == 900
    exact_dedup.drop_index(spark, index)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(index)]


def test_the_main_table_is_read_in_its_own_order(spark):
    """After two batches nothing stands between the scan of the main table and the merge join but a filter."""
    index = exact_dedup.new_index_name()
    for first, last in ((0, 300), (300, 900)):
        exact_dedup.deduplicate(batch(spark, first, last), index)
    main, new = exact_dedup.open_index(spark, index, "bigint")
    groups = main.sparkSession.range(50).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    plan = exact_dedup.unseen(groups, main, new)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    at = next(i for i, x in enumerate(lines) if f"{index}_main[" in x)
    join = next(i for i in range(at, -1, -1) if "SortMergeJoin" in lines[i])
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    between, least = [], depth(lines[at])
    for x in reversed(lines[join + 1 : at]):  # the nodes from the scan up to the join
        if depth(x) < least:
            between.append(x)
            least = depth(x)
    assert between and not [x for x in between if "Exchange" in x or "Sort " in x], plan
    assert "Bucketed: true" in lines[at]
    exact_dedup.drop_index(spark, index)


def test_a_stopped_merge_is_ended(spark):
    index = exact_dedup.new_index_name()
    exact_dedup.deduplicate(batch(spark, 0, 50), index)
    spark.sql(f"ALTER TABLE {index}_main RENAME TO {index}_next")  # as if the driver was lost before the rename
    assert judged(exact_dedup.deduplicate(batch(spark, 890, 950), index)) == {i: (i if i < 900 else i - 900, i < 900) for i in range(890, 950)}
    exact_dedup.drop_index(spark, index)

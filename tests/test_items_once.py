"""Line items meet their parts once, and counts of pairs are added up without a shuffle of the pairs' own columns."""

import pytest
from crosslane.operators import candidates
from crosslane.plans import queries, rule_queries
from crosslane.plans import surrogate as s
from pyspark.sql import functions as F

from .conftest import DATA


def _exchanges(df) -> list[str]:
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]


def test_suppliers_are_broadcast_by_a_count_and_parts_are_too_while_they_are_few(spark, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _exchanges(s.observations(spark, DATA)) == []
        monkeypatch.setattr(s, "MOST_PARTS", 1)
        assert {x.split("hashpartitioning(")[1].split("#")[0] for x in _exchanges(s.observations(spark, DATA))} == {"l_partkey", "p_partkey"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("most", [1_000_000, 1])
def test_lanes_and_texts_are_those_of_the_observations(spark, monkeypatch, most):
    monkeypatch.setattr(s, "MOST_TEXTS", most)
    o = s.observations(spark, DATA)
    assert set(o.select("country_code", "price_type", "snapshot_date").distinct().collect()) <= set(s.lanes(spark, DATA).collect())
    told = s.texts(spark, DATA)
    assert set(o.select("strength", "pack_size").distinct().collect()) <= set(told.collect()) and told.count() == told.distinct().count()


def test_pairs_that_are_not_added_up_give_the_same_sums(spark):
    records = queries._candidate_records(spark, DATA)
    whole, rows = (candidates.counted_pairs(records, same_quarter=True, added=x) for x in (True, False))
    by = ["country_code_a", "country_code_b", "method", (F.col("pack_units_a") == F.col("pack_units_b")).alias("same")]
    assert sorted(candidates.summed(whole, *by).collect()) == sorted(candidates.summed(rows, *by).collect())


def test_caveats_are_added_up_before_any_shuffle_of_pairs(spark):
    """The only exchange by hash behind the pairs is that of the few caveats; joins of classes are the others."""
    for query in (rule_queries.code_pairs, rule_queries.candidate_caveats):
        assert not [x for x in _exchanges(query(spark, DATA)) if "identity_reason" in x or "form_confidence_a" in x]


def test_records_are_not_shuffled_to_meet_their_partners(spark):
    records = queries._candidate_records(spark, DATA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        used = candidates.with_partner(records, same_quarter=True)
        assert _exchanges(used) == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    pairs = candidates.pairs(records, same_quarter=True)
    sides = pairs.select(F.col("id_a").alias("id")).union(pairs.select("id_b")).distinct()
    assert used.count() == sides.count() and used.join(sides, "id", "left_anti").isEmpty()

"""Work that is done once for a record or a key, not for each pair or row that it is in."""

from decimal import Decimal

from pyspark.sql import functions as F

from crosslane.functions.forms import compatibility
from crosslane.operators import candidates, lanes, policy, review
from crosslane.plans import surrogate
from crosslane.sources import html

RECORD = "id string, raw_record_id string, country_code string, canonical_inn string, atc_code string, comparison_category string, form_class string, route string, strength_unit string, strength_value int, snapshot_date string"


def paired(spark, *rows):
    return spark.createDataFrame([(i, i, cc, inn, atc, "ex_factory", "solid", "oral", "mg", 10, "2020-01-01") for i, cc, inn, atc in rows], RECORD)


def joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")


def test_codes_of_one_molecule_arent_joined(spark):
    one = paired(spark, ("a", "AA", "x", "A01AA01"), ("b", "BB", "x", "A01AA01"))
    p = candidates.pairs(one)
    assert [(r.id_a, r.id_b, r.method) for r in p.collect()] == [("a", "b", "molecule")] and joins(p) == 1
    # Two molecules with one code, or one and none, are; two records without a molecule aren't a pair.
    two = paired(spark, ("a", "AA", "x", "A01AA01"), ("b", "BB", "y", "A01AA01"), ("c", "CC", None, "A01AA01"), ("d", "DD", None, "A01AA01"))
    assert sorted(f"{r.id_a}{r.id_b} {r.method}" for r in candidates.pairs(two).collect()) == ["ab code", "ac code", "ad code", "bc code", "bd code"]


def test_report_of_sides_is_that_of_fields(spark):
    fields = "id string, canonical_inn_a string, usability string, price_ratio double"
    side = "id string, raw_record_id string, policy_id string, profile_id string, country_code string, price_amount decimal(18,6), price_currency string, strength_price double"
    sides = spark.createDataFrame([("1", "r1", "p1", None, "AA", None, "EUR", 0.5), ("2", None, "p2", "q2", "BB", Decimal(2), "EUR", None), ("3", "r3", None, "q3", "CC", Decimal(3), "PLN", 0.25)], side)
    said = review.report_sides(sides)
    c = spark.createDataFrame([("c", "x", "usable", 2.0)], fields)
    of = lambda df, s, i: df.where(F.col("id") == i).select(*[F.col(n).alias(f"{n}_{s}") for n in df.columns])
    for a, b in (("1", "2"), ("2", "3"), ("3", "1")):
        plain = c.crossJoin(of(sides, "a", a)).crossJoin(of(sides, "b", b))
        made = c.crossJoin(of(said.select("figures", "chain_a", "chain_b", "id"), "a", a)).crossJoin(of(said.select("figures", "chain_a", "chain_b", "id"), "b", b))
        made = made.withColumns({"country_code_a": F.lit(plain.first().country_code_a), "country_code_b": F.lit(plain.first().country_code_b)})
        assert review.reports(made).first().report == review.reports(plain).first().report


def test_equal_attributes_are_equal_sets(spark):
    df = spark.createDataFrame([(1, ["x", "y"], ["y", "x", "x"]), (2, ["x"], ["y"]), (3, None, []), (4, ["x", None], ["x"])], "k int, a array<string>, b array<string>")
    side = lambda c: {"form_class": F.lit("solid"), "route": F.lit("oral"), "attributes": F.col(c), "confidence": F.lit("strong")}
    got = {r.k: r.cap for r in df.select("k", compatibility(side("a"), side("b"))["cap"].alias("cap")).collect()}
    assert got == {1: "exact", 2: "high", 3: "exact", 4: "high"}


def test_only_derived_rows_are_linked(spark):
    rows = [("o1", "r", "A"), ("o2", "r", "N"), ("r2", "r2", "A"), ("s2", "r2", "N"), ("d1", "r", "derived_A"), ("d2", "r2", "Derived_A"), ("d3", "none", "derived_A"), ("n1", None, None), ("d4", None, "derived_A")]
    df = spark.createDataFrame(rows, "id string, raw_record_id string, price_type string")
    got = {r.id: r.observed_id for r in lanes.link_observed(df).collect()}
    assert got == {"o1": "o1", "o2": "o2", "r2": "r2", "s2": "s2", "d1": "o2", "d2": "s2", "d3": None, "n1": "n1", "d4": None}
    # The observed rows reach the result without a join.
    plan = lanes.link_observed(df)._jdf.queryExecution().optimizedPlan()
    assert plan.toString().lstrip().startswith("Union") and not any(x in plan.children().head().toString() for x in ("Join", "Aggregate"))


def test_records_arent_shuffled_for_their_policy(spark):
    asked = spark.range(1000).select(F.lit("AA").alias("country_code"), F.lit("A").alias("price_type"), F.lit("1999-01-01").cast("date").alias("snapshot_date"), "id")
    got = policy.valid_policy(asked, surrogate.policies(spark))
    assert "hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString() and got.where("policy.id = 'pol-A-AA'").count() == 1000


def test_cohorts_from_one_reading(spark):
    rows = [("l", "i", "AA", 3.0), ("l", "i", "AA", 1.0), ("l", "i", "BB", 2.0), ("l", "j", "AA", 5.0), ("l", "j", "AA", 4.0), ("l", "k", None, 1.0), ("l", "k", "AA", 1.0)]
    index = spark.createDataFrame(rows, "lane_key string, identity_key string, country_code string, eur_per_strength double").withColumn("id", F.lit("x"))
    key = lambda df: sorted((r.cohort_id, r.country_code, r.eur_per_strength) for r in df.collect())
    got = lanes.cheapest_of_cohorts(index, 2)
    assert key(got) == key(lanes.cheapest(lanes.cohorts(index, 2))) and got.count() == 2
    assert "lane_key" in got._jdf.queryExecution().optimizedPlan().toString() and "LogicalRDD" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_value_after_reads_the_nearest_elements(spark):
    pages = [
        ("L:</label><span>one</span><span>two</span>", "one"), ("L:<span> </span><div>two</div><span>three</span>", "two"), ("L:<span> </span><div></div><span>three</span>", "three"), ("L:<div><span>L</span></div><label>x</label>", "x"),
        ("L:<span> <b></b></span>", ""), ("L:<span> </span>text <div>open", ""), ("none", ""), ("L:", ""), ("L:<div><span></span><label>in</label></div><span>after</span>", "in"),
    ]
    df = spark.createDataFrame([(p,) for p, _ in pages], "m string")
    assert [r.v for r in df.select(html.value_after(F.col("m"), "L:").alias("v")).collect()] == [v for _, v in pages]

"""Pairs as counts against pairs one by one."""

from decimal import Decimal

from pyspark.sql import functions as F

from crosslane.operators import candidates, review
from crosslane.plans import surrogate
from crosslane.sources.tables import written

RECORD = (
    "id string, country_code string, snapshot_date date, canonical_inn string, atc_code string, comparison_category string, form_class string, route string, strength_unit string, strength_value int, price_type string, "
    "price_currency string, pack_units int, strength_price decimal(38,20), attributes array<string>, form_confidence string, vat_position string, policy_id string, profile_id string"
)


def _records(spark, n):
    """Records with unread packs, missing codes, a code shared by two molecules, prices missing and so small that a rate makes them zero."""
    pick = lambda k, *v: F.element_at(F.array(*[F.lit(x) for x in v]), (F.floor(F.col("id") / k) % len(v) + 1).cast("int"))
    r = spark.range(n).select(F.col("id").cast("string").alias("id"), pick(1, "AA", "BB", "CC").alias("country_code"), pick(7, "1996-01-01", "1999-01-01").cast("date").alias("snapshot_date"), pick(5, "x", "y", "z").alias("canonical_inn"),
        pick(5, "A01AA01", "A01AA01", None).alias("atc_code"), F.lit("retail").alias("comparison_category"), pick(11, "solid", "liquid").alias("form_class"), F.lit("oral").alias("route"), F.lit("mg").alias("strength_unit"), pick(13, 5, 10).alias("strength_value"),
        F.lit("A").alias("price_type"), pick(1, "EUR", "PLN", "XXX").alias("price_currency"), pick(3, 10, 20, 30, None).alias("pack_units"), pick(17, Decimal("1.5"), None, Decimal("2.5"), Decimal("0.00000000002")).cast("decimal(38,20)").alias("strength_price"),
        pick(19, "film", "").alias("a"), pick(23, "strong", "weak").alias("form_confidence"), pick(29, "in", "ex").alias("vat_position"), pick(31, "p1", "p2").alias("policy_id"), pick(37, "f1", None).alias("profile_id"))
    return r.withColumn("attributes", F.array("a")).select(*[c.split(" ")[0] for c in RECORD.split(", ")])


def test_counts_are_those_of_the_pairs(spark):
    records, rates = _records(spark, 600).cache(), surrogate.rates(spark)
    by = ["country_code_a", "country_code_b", "canonical_inn_a", "canonical_inn_b", "method", "identity_confidence", "identity_reason", "caveats", F.col("price_ratio").isNull().alias("no_ratio"), "profile_id_a", "profile_id_b"]
    for same_quarter in (True, False):
        one = candidates.candidates(records, rates, same_quarter).groupBy(*by).agg(F.count("*").alias("n"))
        counted = candidates.described(candidates.counted_pairs(records, ("canonical_inn", "profile_id"), same_quarter), rates)
        want, got = (sorted(map(str, x.collect())) for x in (one, counted.groupBy(*by).agg(F.sum("n").alias("n"))))
        assert got == want and len(got) > 100


def test_rows_do_not_grow_with_pairs(spark):
    """Ten times the records of the same kinds are a hundred times the pairs, and the same number of rows."""
    rows = [candidates.counted_pairs(_records(spark, n).drop("policy_id", "profile_id")).agg(F.count("*"), F.sum("n")).first() for n in (50_000, 500_000)]
    assert rows[1][0] <= rows[0][0] * 1.05 and 80 < rows[1][1] / rows[0][1] < 120


def test_chains_of_counted_pairs_are_those_of_the_pairs(spark):
    records, rates = _records(spark, 400).withColumns({"raw_record_id": F.concat(F.lit("r"), "id"), "unit_price": F.col("strength_price")}).cache(), surrogate.rates(spark)
    n = F.col("id").cast("long")
    rules, canonical = candidates.derivation_rules(records.where(n % 3 != 0)), records.where(n % 5 != 0)
    lineage = records.where(n % 7 != 0).select("raw_record_id", F.concat(F.lit("d"), n % 4).alias("source_document_id"))
    documents, profiles, policies = (spark.createDataFrame([(x,) for x in xs], "id string") for xs in (["d0", "d1", "d2"], ["f1"], ["p1"]))
    one = written(candidates.candidates(records, rates), "one")
    kept = lambda c: c.where("country_code_a <> 'AA'").select("id")
    want = review.resolution(review.audit_links(one, kept(one), rules, profiles, policies, canonical, lineage, documents)).groupBy("resolved", "n_broken", "broken").agg(F.count("*").alias("n"))
    chains = review.record_chains(records, rules, profiles, policies, canonical, lineage, documents)
    counted = written(candidates.counted_pairs(records.join(written(chains, "chains"), "id"), ("lost",)), "counted")
    got = review.counted_resolution(counted, kept(counted)).groupBy("resolved", "n_broken", "broken").agg(F.sum("n").alias("n"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 50


def test_records_with_a_partner_are_the_sides_of_pairs(spark):
    few = _records(spark, 60)
    alone = few.where("id = '0'").withColumns({"id": F.lit("alone"), "canonical_inn": F.lit("q"), "atc_code": F.lit(None).cast("string")})
    records = few.unionByName(alone).cache()
    for same_quarter in (True, False):
        p = candidates.pairs(records, same_quarter)
        want = {r[0] for r in p.select("id_a").union(p.select("id_b")).distinct().collect()}
        assert {r.id for r in candidates.with_partner(records, same_quarter).collect()} == want and want and "alone" not in want


def test_molecule_of_reviews_that_carry_their_evidence(spark):
    """The same rows as by joins with evidence and reviews, without a shuffle of pairs."""
    rows = spark.createDataFrame([("1", "p", "q", "Gear", "AA", "BB", 1.5, None, 2.0, "usable"), ("2", "p", "r", "bolt", "AA", "CC", 1.0, 3.0, None, "usable")], "id string, id_a string, id_b string, canonical_inn_a string, country_code_a string, country_code_b string, price_amount_a double, price_amount_b double, price_ratio double, usability string")
    e = rows.select(F.col("id").alias("candidate_id"), F.struct(F.struct(F.col("price_amount_a").alias("price_amount")).alias("a"), F.struct(F.col("price_amount_b").alias("price_amount")).alias("b")).alias("bundle"))
    joined, carried = review.for_molecule(rows.drop("usability"), e, rows.select("id", "usability"), "gear"), review.for_molecule(rows, None, None, "gear")
    assert carried.collect() == joined.collect() and carried.count() == 1
    assert "Join" not in carried._jdf.queryExecution().optimizedPlan().toString()


def test_ends_of_ratios_are_those_of_the_pairs(spark):
    """Counts, least and greatest ratio as pairs one by one have them, whatever packs the ends of prices have; and no row for a pair."""
    rates = surrogate.rates(spark)
    records = _records(spark, 600).withColumn("strength_price", F.when(F.col("strength_price") > 1, F.col("strength_price") + F.pmod(F.xxhash64("id"), F.lit(97)) / 7).otherwise(F.col("strength_price")).cast("decimal(38,20)")).cache()
    by = ["country_code_a", "country_code_b", "snapshot_date_a", "snapshot_date_b", "identity_confidence"]
    for same_quarter in (True, False):
        one = candidates.candidates(records, rates, same_quarter).groupBy(*by).agg(F.count("*").alias("n"), F.min("price_ratio").alias("lowest"), F.max("price_ratio").alias("highest"))
        got = candidates.extreme_pairs(records, rates, same_quarter).select(*one.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, one.collect())) and got.count() > 10

"""Profiles of snapshots, plausibility, gates and constraint checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.tables import written
from .policy import small
from .quantiles import exact_quantiles, same

# Thresholds of the plausibility decision.
MIN_POPULATION, SUSPECT_POPULATION, MAX_OUTLIERS, MIN_POSITIVE, MIN_RULES = 0.50, 0.90, 0.05, 0.95, 0.95
SNAPSHOT = ["country_code", "snapshot_date"]


#: Values from which on a group's quartiles are found by ranges; the others' distinct values fit into one buffer.
LARGE = 2_000_000


def _quartiles(records: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Counts, least, median and greatest value and _q, the exact quartiles, of each group."""
    v = F.col(value).cast("double")
    counts = [F.count("*").alias("record_count"), F.count(v).alias("value_count"), F.count_if(v > 0).alias("positive_count"), F.min(v).alias("min_value"), F.max(v).alias("max_value")]
    sorted_whole = lambda rows: rows.groupBy(*keys).agg(*counts, F.percentile(v, 0.5).alias("median_value"), F.percentile(v, F.array(F.lit(0.25), F.lit(0.75))).alias("_q"))
    hot = records.groupBy(*keys).agg(F.count(v).alias("_n")).where(F.col("_n") > LARGE).select(*keys)
    if hot.isEmpty():
        return sorted_whole(records)
    hot = small(written(hot, "large"))
    of = same(keys, "r", "h")
    large = records.alias("r").join(hot.alias("h"), of, "left_semi")
    q = exact_quantiles(large, keys, value, (0.25, 0.5, 0.75))
    cols = ["record_count", "value_count", "positive_count", "min_value", "max_value"]
    ranged = large.groupBy(*keys).agg(*counts).alias("r").join(q.alias("h"), of).select(*[F.col(f"r.{k}").alias(k) for k in [*keys, *cols]], F.col("quantiles")[1].alias("median_value"), F.array(F.col("quantiles")[0], F.col("quantiles")[2]).alias("_q"))
    return sorted_whole(records.alias("r").join(hot.alias("h"), of, "left_anti")).unionByName(ranged)


def numeric_profile(records: DataFrame, value: str, keys: list[str], min_rows: int = 4) -> DataFrame:
    """Per key: counts, rates, min, median, max, exact quartiles and outliers beyond 1.5 times their distance.

    outlier_count adds the values that aren't positive to those outside the band (a value may count twice);
    outlier_distinct counts each once. Groups under ``min_rows`` values have no band.
    """
    v = F.col(value).cast("double")
    base = _quartiles(records, value, keys)
    span = F.col("_q")[1] - F.col("_q")[0]
    base = base.withColumns({"q25": F.col("_q")[0], "q75": F.col("_q")[1], "_low": F.col("_q")[0] - 1.5 * span, "_high": F.col("_q")[1] + 1.5 * span})
    on = records.join(base.select(*keys, "_low", "_high", "value_count"), keys)
    out = (v < F.col("_low")) | (v > F.col("_high"))
    banded = F.col("value_count") >= min_rows
    counts = on.groupBy(*keys).agg(F.count_if(banded & out).alias("_out"), F.count_if(v <= 0).alias("_bad"), F.count_if((banded & out) | (v <= 0)).alias("outlier_distinct"))
    j = base.join(counts, keys).withColumn("outlier_count", F.col("_out") + F.col("_bad"))
    n, some = F.col("record_count"), F.col("value_count")
    return j.withColumns({
        "population_rate": some / n, "positive_rate": F.try_divide(F.col("positive_count"), some), "outlier_rate": F.try_divide(F.col("outlier_count"), some), "null_count": n - some,
    }).drop("_q", "_low", "_high", "_out", "_bad")


def plausibility(profile: DataFrame) -> DataFrame:
    """Add assessment (plausible, suspect or implausible) and issues."""
    issues = F.array_compact(F.array(
        F.when(F.col("population_rate") < MIN_POPULATION, "population below minimum"),
        F.when((F.col("population_rate") >= MIN_POPULATION) & (F.col("population_rate") < SUSPECT_POPULATION), "population below threshold"),
        F.when(F.col("positive_rate") < MIN_POSITIVE, "too few positive values"),
        F.when(F.col("outlier_rate") > MAX_OUTLIERS, "too many outliers"),
    ))
    bad = (F.col("population_rate") < MIN_POPULATION) | (F.coalesce("positive_rate", F.lit(0.0)) < MIN_POSITIVE)
    odd = (F.col("population_rate") < SUSPECT_POPULATION) | (F.col("outlier_rate") > MAX_OUTLIERS)
    return profile.withColumn("issues", issues).withColumn("assessment", F.when(bad, "implausible").when(odd, "suspect").otherwise("plausible"))


def currency_profile(records: DataFrame, keys: list[str] = SNAPSHOT, currency: str = "price_currency") -> DataFrame:
    """Distinct currencies of each snapshot; exactly one is plausible."""
    p = records.groupBy(*keys).agg(F.count_distinct(currency).alias("n_currencies"), F.array_join(F.sort_array(F.collect_set(currency)), ",").alias("currencies"))
    return p.withColumn("assessment", F.when(F.col("n_currencies") == 1, "plausible").otherwise("implausible"))


def date_profile(records: DataFrame, keys: list[str] = SNAPSHOT, date: str = "price_date", today: Column | None = None) -> DataFrame:
    """Whether all rows carry the snapshot's date and none is later than ``today``."""
    now = F.current_date() if today is None else today
    p = records.groupBy(*keys).agg(F.count_if(F.coalesce(F.col(date) != F.col("snapshot_date"), F.lit(True))).alias("off_date"), F.count_if(F.col(date) > now).alias("in_future"))
    return p.withColumn("assessment", F.when(F.col("in_future") > 0, "implausible").when(F.col("off_date") > 0, "suspect").otherwise("plausible"))


def mapping_profile(records: DataFrame, keys: list[str], raw: str, rule: str, confidence: str, most: int = 20) -> DataFrame:
    """Mapping coverage: histogram of confidence, share with a rule, and the first unmapped raw values."""
    hist = records.groupBy(*keys, F.coalesce(confidence, F.lit("none")).alias("_c")).count()
    hist = hist.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("_c", "count")))).alias("confidence_counts"))
    rest = records.where(F.col(rule).isNull()).select(*keys, F.coalesce(F.col(raw), F.lit("")).alias("_raw")).distinct()
    first = rest.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("_raw"))).where(F.col("_r") <= most)
    first = first.groupBy(*keys).agg(F.sort_array(F.collect_list("_raw")).alias("unmapped"))
    share = records.groupBy(*keys).agg(F.count("*").alias("record_count"), (F.count(rule) / F.count("*")).alias("rule_rate"))
    out = share.join(hist, keys).join(first, keys, "left")
    return out.withColumn("unmapped", F.coalesce("unmapped", F.array().cast("array<string>"))).withColumn("assessment", F.when(F.col("rule_rate") < MIN_RULES, "suspect").otherwise("plausible"))


def snapshot_status(profiles: DataFrame, keys: list[str] = SNAPSHOT) -> DataFrame:
    """red with any implausible field, yellow with any suspect one, else green."""
    rank = F.when(F.col("assessment") == "implausible", 2).when(F.col("assessment") == "suspect", 1).otherwise(0)
    return profiles.groupBy(*keys).agg(F.max(rank).alias("_s")).withColumn("status", F.when(F.col("_s") == 2, "red").when(F.col("_s") == 1, "yellow").otherwise("green")).drop("_s")


def data_gate(rate: str = "population_rate", assessment: str = "assessment", exists: Column | None = None) -> Column:
    """struct(blocked, reason) of a left-joined profile."""
    there = F.lit(True) if exists is None else exists
    reason = (
        F.when(F.col(assessment).isNull(), "no data profile").when(~there, "field is absent")
        .when(F.col(rate) < MIN_POPULATION, "population rate below 0.5").when(F.col(assessment) == "implausible", "profile is implausible")
    )
    return F.struct(reason.isNotNull().alias("blocked"), reason.alias("reason"))


def readiness(policy_gate: Column, data: Column, confidence: Column) -> Column:
    return F.when(policy_gate["blocked"] | data["blocked"], "blocked").when(F.coalesce(confidence, F.lit("low")) == "low", "needs_review").otherwise("ready")


def distribution(records: DataFrame, value: str, keys: list[str]) -> DataFrame:
    v = F.col(value).cast("double")
    q = F.percentile(v, F.array(*[F.lit(x) for x in (0.05, 0.25, 0.75, 0.95)]))
    return records.groupBy(*keys).agg(F.avg(v).alias("mean"), F.stddev(v).alias("stddev"), q.alias("_q")).select(*keys, "mean", "stddev", *[F.col("_q")[i].alias(n) for i, n in enumerate(("p5", "p25", "p75", "p95"))])


def categorical(records: DataFrame, value: str, keys: list[str], k: int = 5) -> DataFrame:
    """(keys, value, n, rank, n_distinct) of the k most frequent values, ties by value. The count is made before any window."""
    counts = records.groupBy(*keys, value).agg(F.count("*").alias("n"))
    distinct = counts.groupBy(*keys).agg(F.count(value).alias("n_distinct"))
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), value))).where(F.col("rank") <= k)
    return ranked.join(distinct, keys)


def duplicate_clusters(records: DataFrame, keys: list[str]) -> DataFrame:
    return records.groupBy(*keys).agg(F.count("*").alias("cluster_size")).where("cluster_size > 1")


def duplicate_profile(records: DataFrame, by: list[str] = SNAPSHOT, code: str = "product_code") -> DataFrame:
    """Per snapshot: how many groups of rows share a code, and the verdict: any group makes it suspect."""
    sizes = records.groupBy(*by, code).agg(F.count("*").alias("_n"))
    p = sizes.groupBy(*by).agg(F.count_if(F.col("_n") > 1).alias("duplicate_cluster_count"))
    return p.withColumn("assessment", F.when(F.col("duplicate_cluster_count") > 0, "suspect").otherwise("plausible"))


def unit_plausibility(records: DataFrame, keys: list[str], low: float, high: float) -> DataFrame:
    """Per key: rows whose pack isn't read, whose strength has no digit or whose price isn't in [low, high], rows with any of
    these, and the verdict: suspect beyond the share of outliers that is allowed. Takes ``lanes.parsed`` records."""
    pack = F.coalesce(F.col("pack_units") <= 0, F.lit(True))
    strength = ~F.coalesce(F.col("strength").rlike("[0-9]"), F.lit(False))
    price = ~F.coalesce(F.col("price_amount").between(low, high) & (F.col("price_amount") > 0), F.lit(False))
    p = records.groupBy(*keys).agg(F.count("*").alias("record_count"), F.count_if(pack).alias("bad_packs"), F.count_if(strength).alias("bad_strengths"), F.count_if(price).alias("bad_prices"), F.count_if(pack | strength | price).alias("outlier_count"))
    return p.withColumn("assessment", F.when(F.col("outlier_count") / F.col("record_count") > MAX_OUTLIERS, "suspect").otherwise("plausible"))


def currency_totals(records: DataFrame, keys: list[str], value: str = "price_amount", currency: str = "price_currency") -> DataFrame:
    """Count and sum of a price by the keys and by currency, so that no sum adds up two of them."""
    return records.groupBy(*keys, currency).agg(F.count("*").alias("n"), F.sum(F.col(value).cast("decimal(18,6)")).alias("total"))


def broken(df: DataFrame, rules: dict[str, Column], id_col: str = "id") -> DataFrame:
    """(id, rule) for every rule that holds where it must not; one scan for all rules."""
    return df.select(F.col(id_col), F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))).alias("rule"))


def record_rules() -> dict[str, Column]:
    """Constraints of a price record: what must not hold."""
    return {
        "currency is not an ISO code": ~F.col("price_currency").rlike("^[A-Z]{3}$"),
        "country is not two letters": F.length("country_code") != 2,
        "price is negative": F.col("price_amount") < 0,
        "product name is empty": F.trim("product_name") == "",
    }


def profile_rules() -> dict[str, Column]:
    counts = [F.col(c) < 0 for c in ("record_count", "null_count", "outlier_count")]
    return {"a count is negative": counts[0] | counts[1] | counts[2], "absent field has values": ~F.col("field_exists") & (F.col("population_rate") != 0), "not assessed at a time": F.col("assessed_at").isNull()}


def review_rules() -> dict[str, Column]:
    none = lambda c: F.coalesce(F.size(c), F.lit(0)) <= 0
    weak = (F.col("policy_strength") == "weak") | (F.col("data_strength") == "weak") | (F.col("identity_strength") == "weak")
    return {
        "not comparable without a blocker": (F.col("usability") == "not_comparable") & none("blockers"),
        "caveat without a text": (F.col("usability") == "usable_with_caveat") & none("caveats"),
        "usable with a weak strength": (F.col("usability") == "usable") & weak,
    }


def candidate_rules() -> dict[str, Column]:
    return {"a country against itself": F.col("country_code_a") == F.col("country_code_b")}


def anomaly_rules() -> dict[str, Column]:
    return {"resolved without a resolution": (F.col("status") == "resolved") & F.col("resolution").isNull()}


def conversion_rules() -> dict[str, Column]:
    return {"conversion without a source": (F.col("rule_type") == "currency_conversion") & (F.coalesce("fx_source", F.lit("")) == ""), "conversion without a date": (F.col("rule_type") == "currency_conversion") & F.col("fx_date").isNull()}


def route_anomalies(anomalies: DataFrame) -> DataFrame:
    """Queue and whether a decision is required, by severity."""
    severity = F.col("severity")
    queue = F.when(severity == "blocking", "blocking").when(severity == "high", "review").when(severity == "medium", "review").otherwise("log")
    return anomalies.withColumn("queue", queue).withColumn("needs_decision", severity.isin("blocking", "high"))


READY = "ready_for_country_plan"
EVIDENCE = {"sources": "official_sources", "observed lanes": "observed_price_lanes", "identity fields": "identity_fields", "a comparison basis": "first_comparison_basis"}


def country_readiness(countries: DataFrame) -> DataFrame:
    """(country_code, rule) for countries marked ready that have blockers or lack some of the evidence."""
    ready = F.col("status") == READY
    empty = lambda c: F.coalesce(F.size(c), F.lit(0)) <= 0
    return broken(countries, {"ready with blockers": ready & ~empty("blockers"), **{f"ready without {n}": ready & empty(c) for n, c in EVIDENCE.items()}}, "country_code")


def readiness_counts(countries: DataFrame) -> DataFrame:
    return countries.groupBy("phase", "status").agg(F.count("*").alias("n"))

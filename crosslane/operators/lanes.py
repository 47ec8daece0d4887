"""The multi-country index of comparable lanes and its cohort queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.molecules import product_type
from ..functions.scalars import once, parse_pack, parse_strength, per_strength, per_unit, plain_decimal
from ..sources.tables import written
from .fx import to_base
from .policy import lane_semantics, policy_gate, valid_policy
from .quality import data_gate

LANE, IDENTITY = ["comparison_category", "vat_position", "margin_position"], ["canonical_inn", "strength_value", "strength_unit", "form_class", "route"]


def lane_key() -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in LANE])


def identity_key() -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("canonical_inn", "strength_text", "strength_unit", "form_class", "route")])


def presentation_key() -> Column:
    """The identity key with the pack and the form's attributes."""
    attributes = F.array_join(F.coalesce("form_attributes", F.array().cast("array<string>")), "|")
    return F.concat_ws("|", identity_key(), F.coalesce(F.col("pack_units").cast("string"), F.lit("")), F.nullif(attributes, F.lit("")))


def link_observed(records: DataFrame) -> DataFrame:
    """Derived rows take the id of the observed row of the same raw record (of several the last by id); others their own.

    Only derived rows are looked up. An observed row that is its own raw record is told by its id alone, so its id goes through the shuffle once."""
    derived = F.coalesce(F.lower("price_type").contains("derived"), F.lit(False))
    seen = records.where(~derived & F.col("raw_record_id").isNotNull()).select("id", "raw_record_id")
    own = seen.where("id = raw_record_id").select("raw_record_id").distinct().withColumn("_own", F.lit(True))
    other = seen.where("id <> raw_record_id").groupBy("raw_record_id").agg(F.max("id").alias("_other"))
    linked = records.where(derived).join(own, "raw_record_id", "left").join(other, "raw_record_id", "left")
    linked = linked.withColumn("observed_id", F.greatest("_other", F.when(F.col("_own"), F.col("raw_record_id")))).drop("_own", "_other")
    return records.where(~derived).withColumn("observed_id", F.col("id")).unionByName(linked)


def parsed_texts(records: DataFrame) -> DataFrame:
    """(strength, pack_size, struct _s, struct _p) of the distinct texts of ``records``, parsed once each and written: a list
    of prices has few of them, and the size of what was written decides how the records meet it."""
    texts = records.select("strength", "pack_size").distinct()
    return written(once(texts, _s=parse_strength(F.col("strength")), _p=parse_pack(F.col("pack_size"))), "texts")


def parsed(records: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """Add strength, pack, per-unit and per-strength prices; drops nothing (what can't be read is null)."""
    t = parsed_texts(records) if texts is None else texts
    t = t.select(F.col("strength").alias("_st"), F.col("pack_size").alias("_pt"), F.col("_s.value").alias("strength_value"), F.col("_s.unit").alias("strength_unit"), plain_decimal(F.col("_s.value")).alias("strength_text"), F.col("_p.units").alias("pack_units"))
    r = records.join(t, F.col("strength").eqNullSafe(F.col("_st")) & F.col("pack_size").eqNullSafe(F.col("_pt")), "left").drop("_st", "_pt")
    return r.withColumn("unit_price", per_unit(F.col("price_amount"), F.col("pack_units"))).withColumn("strength_price", per_strength(F.col("unit_price"), F.col("strength_value")))


def snapshot_index(records: DataFrame, policies: DataFrame, profiles: DataFrame) -> DataFrame:
    """The rows of the index before their conversion: policy and data gates, parsed product, keys. Nothing of a row depends on other
    snapshots than its own.

    Records carry canonical_inn, form_class and route (and product_type, where it is known already). Rows that a gate blocks or that can't be parsed are left out.
    """
    texts = parsed_texts(records)
    r = valid_policy(records, policies).withColumn("_g", policy_gate()).where("not _g.blocked")
    keep = ["country_code", "snapshot_date", "price_type"]
    on = [k for k in keep if k in profiles.columns]
    # Written, so that its size decides how the records meet it.
    prof = written(profiles.select(*on, "population_rate", F.col("assessment").alias("plausibility"), F.lit(True).alias("_there")), "gates")
    r = r.join(prof, on, "left").withColumn("_d", data_gate(assessment="plausibility")).where("not _d.blocked")
    r = parsed(r.select(*records.columns, *lane_semantics(), "plausibility"), texts).where("strength_price is not null")
    if "product_type" not in r.columns:
        r = r.withColumn("product_type", product_type(F.col("product_name"), F.col("canonical_inn"))["type"])
    return r.withColumn("lane_key", lane_key()).withColumn("identity_key", identity_key())


def in_euro(index: DataFrame, rates: DataFrame, fx_date: Column) -> DataFrame:
    """The index with amount_eur and eur_per_strength at one date for all countries; rows without a rate are left out."""
    r = to_base(index.withColumn("fx_date", fx_date.cast("date")), rates, amount="price_amount", currency="price_currency", day="fx_date")
    return r.withColumn("eur_per_strength", per_strength(per_unit(F.col("amount_eur"), F.col("pack_units")), F.col("strength_value")))


def lane_index(records: DataFrame, policies: DataFrame, profiles: DataFrame, rates: DataFrame, fx_date: Column | None = None) -> DataFrame:
    """All countries in one plan: ``snapshot_index`` in euro, at the latest snapshot's date if no other is named.
    ``stored_index`` keeps the same rows by snapshot, so that a new snapshot needs no reading of the others."""
    if fx_date is None:
        fx_date = records.agg(F.max("snapshot_date")).scalar()
    return in_euro(snapshot_index(records, policies, profiles), rates, fx_date)


def cohorts(index: DataFrame, min_countries: int = 2, inn: str | None = None, lane: str | None = None, keys: tuple[str, ...] = ("lane_key", "identity_key"), kind: str | None = None) -> DataFrame:
    """Rows of the groups with at least ``min_countries`` countries, with cohort_id and n_countries; of one molecule, lane or
    kind of product (brand or generic) where asked. ``keys`` may have further columns, such as a presentation key.

    The groups are found by an aggregate; rows then meet them by a join, so no group is gathered."""
    i = index
    if inn is not None:
        i = i.where(F.lower("canonical_inn") == inn.strip().lower())
    if lane is not None:
        i = i.where(F.col("lane_key") == lane)
    if kind is not None:
        i = i.where(F.col("product_type") == kind)
    wide = i.groupBy(*keys).agg(F.count_distinct("country_code").alias("n_countries")).where(F.col("n_countries") >= min_countries)
    return i.join(wide, list(keys)).withColumn("cohort_id", F.sha2(F.concat_ws("||", *keys), 256))


def cheapest(rows: DataFrame, by: tuple[str, ...] = ("cohort_id",), price: str = "eur_per_strength") -> DataFrame:
    """Least price of each country in each cohort, and the record that has it (ties: smallest id)."""
    best = F.min_by("id", F.struct(price, "id"))
    return rows.groupBy(*by, "country_code").agg(F.min(price).alias(price), best.alias("record_id"))


def cheapest_of_cohorts(index: DataFrame, min_countries: int = 2, keys: tuple[str, ...] = ("lane_key", "identity_key"), price: str = "eur_per_strength") -> DataFrame:
    """Least price of each country in each of the ``cohorts``, with cohort_id: the index is read once, and only its prices by cohort and
    country, which don't grow with its rows, are counted and kept."""
    best = written(index.groupBy(*keys, "country_code").agg(F.min(price).alias(price)), "cheapest")
    wide = best.groupBy(*keys).agg(F.count("country_code").alias("_n")).where(F.col("_n") >= min_countries).select(*keys)
    return best.join(wide, list(keys)).withColumn("cohort_id", F.sha2(F.concat_ws("||", *keys), 256)).select("cohort_id", "country_code", price)


def summary(best: DataFrame, by: tuple[str, ...] = ("cohort_id",), price: str = "eur_per_strength") -> DataFrame:
    """Per cohort: countries, median over countries, lowest and highest country (ties by code) and their ratio to the median."""
    v = F.col(price).cast("double")
    s = best.groupBy(*by).agg(
        F.count("*").alias("n_countries"), F.percentile(v, 0.5).alias("median_price"), F.min(v).alias("lowest"), F.max(v).alias("highest"),
        F.min_by("country_code", F.struct(v, F.col("country_code"))).alias("lowest_country"), F.min_by("country_code", F.struct(-v, F.col("country_code"))).alias("highest_country"),
    )
    return s.withColumn("lowest_ratio", F.try_divide("lowest", "median_price")).withColumn("highest_ratio", F.try_divide("highest", "median_price"))


def ratio_to_median(best: DataFrame, by: tuple[str, ...] = ("cohort_id",), price: str = "eur_per_strength") -> DataFrame:
    mid = best.groupBy(*by).agg(F.percentile(F.col(price).cast("double"), 0.5).alias("median_price"))
    return best.join(mid, list(by)).withColumn("ratio", F.try_divide(F.col(price).cast("double"), F.col("median_price")))


def coverage(index: DataFrame) -> DataFrame:
    return index.groupBy("lane_key").agg(F.array_join(F.sort_array(F.collect_set("country_code")), ",").alias("countries"), F.count_distinct("country_code").alias("n_countries"), F.count("*").alias("n_rows"))


def top_per_group(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n)

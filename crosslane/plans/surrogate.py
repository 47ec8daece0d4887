"""Price observations projected from the star schema, and the inline dimensions that go with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import stable_id
from ..operators import policy
from ..sources.tables import spread

# Policies: id, price type, category, from, to, confidence, VAT position. The second N policy begins later and replaces the first.
POLICIES = (
    ("pol-A", "A", "ex_factory", "1990-01-01", None, "high", "vat_exclusive"),
    ("pol-N1", "N", "wholesale", "1990-01-01", None, "high", "vat_exclusive"),
    ("pol-N2", "N", "retail", "1998-01-01", None, "medium", "vat_inclusive"),
    ("pol-R", "R", "not_comparable", "1990-01-01", None, "low", "vat_inclusive"),
)
# Rates from EUR: currency, date, rate.
RATES = (("PLN", "1990-01-01", "3.9000000000"), ("PLN", "1998-06-01", "4.2500000000"), ("PLN", "2000-03-01", "4.0000000000"), ("CZK", "1990-01-01", "32.0000000000"), ("CZK", "1999-01-01", "25.6000000000"))
# Codes of the molecules, with names that a dictionary of the tables' words has.
ATC = (("A01AA01", "anvil"), ("B01AA02", "bolt"), ("C01AA03", "gear"), ("D01AA04", "gizmo"), ("G01AA05", "plate"), ("H01AA06", "ring"), ("J01AA07", "rod"), ("L01AA08", "widget"), ("L01", "group"))


#: Most suppliers and parts that are broadcast, of some 80 bytes each: line items aren't shuffled for them.
MOST_SUPPLIERS, MOST_PARTS = 1_000_000, 200_000
#: Most pairs of a strength and a pack that are made of either's texts.
MOST_TEXTS = 1_000_000


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their supplier and its nation, which are met before the parts, by a broadcast where a count shows that they are few."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    places = policy.small(read("supplier").select("s_suppkey", "s_name", "s_nationkey"), MOST_SUPPLIERS)
    return spread(read("lineitem")).join(places, F.col("l_suppkey") == F.col("s_suppkey")).join(F.broadcast(read("nation").select("n_nationkey")), F.col("s_nationkey") == F.col("n_nationkey"))


def _lane(k: Column) -> list[Column]:
    """Country, price type and snapshot of a line item whose nation is ``k``."""
    code = F.concat(F.char((65 + F.floor(k / 5)).cast("int")), F.char((65 + k % 5).cast("int")))
    return [code.alias("country_code"), F.col("l_returnflag").alias("price_type"), F.trunc(F.col("l_shipdate").cast("date"), "year").alias("snapshot_date")]


def lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct (country_code, price_type, snapshot_date) of the line items, for which parts needn't be read; those of the
    observations, and of items whose part isn't there."""
    return _placed(spark, sf_dir).select(*_lane(F.col("n_nationkey"))).distinct()


def _strength() -> Column:
    return F.concat((F.col("p_size") * 10).cast("string"), F.lit(" mg")).alias("strength")


def _pack() -> Column:
    return F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(" tabs")).alias("pack_size")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(strength, pack_size): every pair that an observation may have, of the parts' strengths and the line items' packs; where those would be
    too many, the pairs that there are."""
    strengths, packs = (spark.read.parquet(f"{sf_dir}/{t}.parquet").select(c).distinct() for t, c in (("part", _strength()), ("lineitem", _pack())))
    if strengths.count() * packs.count() > MOST_TEXTS:
        return observations(spark, sf_dir).select("strength", "pack_size").distinct()
    return strengths.crossJoin(packs)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = policy.small(spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_type", "p_size"), MOST_PARTS)
    j = _placed(spark, sf_dir).join(part, F.col("l_partkey") == F.col("p_partkey"))
    k = F.col("n_nationkey")
    country, price_type, snapshot = _lane(k)
    currency = F.when(k % 3 == 0, "EUR").when(k % 3 == 1, "PLN").otherwise("CZK")
    price = F.col("l_extendedprice").cast("decimal(18,6)")
    cents = lambda c: F.round(F.col(c) * 100).cast("long")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    key = stable_id(F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"), cents("l_quantity"), cents("l_extendedprice"), cents("l_discount"), cents("l_tax"), F.col("l_returnflag"), F.col("l_linestatus"), day)
    return j.select(
        key.alias("id"), key.alias("raw_record_id"), country, snapshot, F.col("l_shipdate").cast("date").alias("price_date"), F.col("p_name").alias("product_name"),
        F.split("p_name", " ")[1].alias("inn"), _strength(), _pack(),
        F.col("p_type").alias("dosage_form"), price_type, price.alias("price_amount"), currency.alias("price_currency"), F.col("s_name").alias("manufacturer"),
        F.col("l_partkey").cast("string").alias("product_code"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
    )


#: The same as a common table expression for DuckDB.
OBS = """obs AS (SELECT md.*, 'x' AS _x FROM (SELECT
  {id} AS id, {id} AS raw_record_id, chr(65 + n_nationkey // 5) || chr(65 + n_nationkey % 5) AS country_code, CAST(date_trunc('year', l_shipdate) AS DATE) AS snapshot_date,
  CAST(l_shipdate AS DATE) AS price_date, p_name AS product_name, string_split(p_name, ' ')[2] AS inn, (p_size * 10) || ' mg' AS strength, CAST(l_quantity AS INT) || ' tabs' AS pack_size, p_type AS dosage_form,
  l_returnflag AS price_type, CAST(l_extendedprice AS DECIMAL(18,6)) AS price_amount, CASE n_nationkey % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'PLN' ELSE 'CZK' END AS price_currency, s_name AS manufacturer,
  CAST(l_partkey AS VARCHAR) AS product_code, l_discount AS discount, l_tax AS tax, p_size * 10 AS strength_value, CAST(l_quantity AS INT) AS pack_units
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey) md)""".format(
    id="(WITH h AS (SELECT sha256(concat_ws(':', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(round(l_quantity * 100) AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT), CAST(round(l_discount * 100) AS BIGINT), CAST(round(l_tax * 100) AS BIGINT), l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d'))) AS x) SELECT x[1:8] || '-' || x[9:12] || '-' || x[13:16] || '-' || x[17:20] || '-' || x[21:32] FROM h)"
)


def policies(spark: SparkSession, countries: DataFrame | None = None) -> DataFrame:
    """A policy of every price type for each country: the rows of POLICIES times the 25 country codes."""
    rules = spark.createDataFrame(list(POLICIES), "pid string, price_type string, category string, f string, t string, confidence string, vat string")
    codes = spark.createDataFrame([(chr(65 + k // 5) + chr(65 + k % 5),) for k in range(25)], "country_code string")
    both = rules.withColumn("country_code", F.explode(F.array(*[F.lit(r["country_code"]) for r in codes.collect()])))
    none = F.array().cast("array<string>")
    semantics = F.struct(F.col("category").alias("comparison_category"), F.col("vat").alias("vat_position"), F.lit("none").alias("margin_position"), F.lit("published").alias("derivation_kind"))
    return both.select(
        F.concat_ws("-", "pid", "country_code").alias("id"), "country_code", "price_type", F.col("category").alias("comparison_category"), F.to_date("f").alias("effective_from"), F.to_date("t").alias("effective_to"),
        F.lit(None).cast("string").alias("superseded_by"), "confidence", F.lit("2000-01-01").cast("timestamp").alias("authored_at"), none.alias("caveats"), F.array(F.lit("inline")).alias("source_references"),
        semantics.alias("semantics"), F.array().cast(f"array<{policy.RULE}>").alias("derivation_rules"),
    )


POL = "pol AS (SELECT * FROM (VALUES " + ", ".join(f"('{p[0]}', '{p[1]}', '{p[2]}', DATE '{p[3]}', '{p[5]}', '{p[6]}')" for p in POLICIES) + ") v(pid, price_type, category, since, confidence, vat))"


def rates(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([(c, d, r) for c, d, r in RATES], "to_ccy string, d string, r string")
    return rows.select(F.lit("EUR").alias("from_ccy"), "to_ccy", F.to_date("d").alias("rate_date"), F.col("r").cast("decimal(18,10)").alias("rate"), F.lit("inline").alias("source_url"), F.to_timestamp("d").alias("stored_at"))


FX = "fx AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}', DATE '{d}', CAST({r} AS DOUBLE))" for c, d, r in RATES) + ") v(ccy, since, rate))"


def atc(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ATC), "atc_code string, atc_name string")


ATC_CTE = "atc AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{n}')" for c, n in ATC if len(c) == 7) + ") v(atc_code, atc_name))"
__all__ = ["ATC_CTE", "FX", "OBS", "POL", "atc", "lanes", "observations", "policies", "rates", "texts"]

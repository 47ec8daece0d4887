"""The multi-country index kept by snapshot: a new snapshot is judged by itself and added; nothing else is read again.

Rows are stored before their conversion, so one date for all countries, which changes with every later snapshot, is applied on
reading. Rows depend on the policies and the dictionary as well: an index belongs to one state of them (``rules_key``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.molecules import product_type
from ..sources import archive
from ..sources.tables import by_texts
from .lanes import in_euro, snapshot_index

#: What is kept of a row, and the number of rows that a snapshot had.
ROW = (
    "id string, raw_record_id string, product_name string, canonical_inn string, price_type string, price_amount decimal(18,6), price_currency string, pack_units bigint, strength_value decimal(18,6), strength_unit string, "
    "form_class string, route string, policy_id string, plausibility string, product_type string, lane_key string, identity_key string"
)
JUDGED = "n_records bigint"


def rules_key(*dimensions: DataFrame) -> str:
    """One digest of the rows of policies and dictionaries, whatever their order: sums of hashes, so no row comes to the driver."""
    told = []
    for d in dimensions:
        row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(d.columns)]))
        one = d.select(F.conv(F.substring(F.sha2(row, 256), 1, 15), 16, 10).cast("decimal(38,0)").alias("h")).agg(F.count("*").alias("n"), F.sum("h").alias("s")).first()
        told.append(f"{one['n']}-{one['s']}")
    return "_".join(told)


def _folder(country: str, day: str) -> str:
    return f"country_code={country}/snapshot_date={day}"


def missing(spark: SparkSession, path: str, asked: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Which of the snapshots (country, date) the index doesn't have, from the names of its folders."""
    there = set(archive.snapshots(spark, path))
    return [x for x in asked if _folder(*x) not in there]


def add(records: DataFrame, policies: DataFrame, profiles: DataFrame, path: str, one: bool = False) -> list[str]:
    """Judge the snapshots in ``records`` and add them. A snapshot of which a gate leaves no row is marked as judged as well.
    One that is there already is refused (archive.SnapshotExists). ``one``: all records are of one snapshot."""
    kinds = [x.split() for x in ROW.split(", ")]
    # Brand or generic is told once for each name and molecule.
    kind = product_type(F.col("product_name"), F.col("canonical_inn"))["type"]
    typed = by_texts(records, ["product_name", "canonical_inn"], lambda t: t.withColumn("product_type", kind))
    rows = snapshot_index(typed, policies, profiles).select(*[F.col(n).cast(k) for n, k in kinds], *archive.KEYS)
    return archive.commit({"index": rows, "judged": records.groupBy(*archive.KEYS).agg(F.count("*").alias("n_records"))}, path, one)


def read(spark: SparkSession, path: str, rates: DataFrame, fx_date: Column | None = None, countries: list[str] | None = None) -> DataFrame:
    """The index in euro; of some countries only, where named. The date is that of the latest snapshot, told by the folders' names."""
    folders = archive.snapshots(spark, path)
    if fx_date is None:
        fx_date = F.lit(max((f.rsplit("=", 1)[1] for f in folders), default=None))
    own = folders if countries is None else [f for f in folders if f.split("/")[0].split("=")[1] in countries]
    return in_euro(archive.read(spark, path, "index", ROW, own), rates, fx_date)

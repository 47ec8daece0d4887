"""Exchange rates: as-of join, conversion and ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .ordered import last_before

RATE = "from_ccy string, to_ccy string, rate_date date, rate decimal(18,10), source_url string, stored_at timestamp"
BASE = "EUR"
#: Most rates that are broadcast; a row is held against all rates of its currency.
MOST_BROADCAST = 10_000


def day_rates(rates: DataFrame) -> DataFrame:
    """(to_ccy, rate_date, rate): one rate from the base currency for each day; of several the one stored last counts."""
    return rates.where(F.col("from_ccy") == BASE).groupBy("to_ccy", "rate_date").agg(F.max_by("rate", F.struct("stored_at", "rate")).alias("rate"))


def rate_intervals(rates: DataFrame) -> DataFrame:
    """(to_ccy, rate, since, until): the span of dates for which each rate from the base currency is the latest."""
    w = Window.partitionBy("to_ccy").orderBy("rate_date")
    return day_rates(rates).select("to_ccy", "rate", F.col("rate_date").alias("since"), F.lead("rate_date").over(w).alias("until"))


def as_of(df: DataFrame, rates: DataFrame, currency: str, day: str, out: str) -> DataFrame:
    """Add ``out``: the latest rate of ``currency`` on or before ``day``, 1 for the base currency, null if there is none.

    Up to MOST_BROADCAST rates (counted) are broadcast as intervals. More are met by a sort: each distinct currency and day of ``df`` is
    answered once (``ordered.last_before``), and the rows then meet the answers on both.
    """
    rate = F.when(F.col(currency) == BASE, F.lit(1).cast("decimal(18,10)")).otherwise(F.col("_rate"))
    if rates.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST:
        r = F.broadcast(rate_intervals(rates).select(F.col("to_ccy").alias("_ccy"), F.col("rate").alias("_rate"), "since", "until"))
        on = (F.col(currency) == F.col("_ccy")) & (F.col("since") <= F.col(day)) & (F.col("until").isNull() | (F.col(day) < F.col("until")))
        return df.join(r, on, "left").withColumn(out, rate).drop("_ccy", "_rate", "since", "until")
    asked = df.select(F.col(currency).alias("_ccy"), F.col(day).cast("date").alias("_day")).where(F.col("_ccy") != BASE).distinct()
    known = last_before(asked, day_rates(rates).select(F.col("to_ccy").alias("_ccy"), F.col("rate_date").alias("_day"), F.col("rate").alias("_rate")), "_ccy", "_day", "_rate")
    return df.join(known, (F.col(currency) == F.col("_ccy")) & (F.col(day).cast("date") == F.col("_day")), "left").withColumn(out, rate).drop("_ccy", "_day", "_rate")


def converted(amount: Column, from_ccy: Column, to_ccy: Column, from_rate: Column, to_rate: Column) -> Column:
    """``amount`` in the other currency through the base one, half-even to ten decimals; unchanged in the same one; null without a rate."""
    through = F.try_divide((amount.cast("decimal(24,12)") * to_rate).cast("decimal(30,14)"), from_rate.cast("decimal(18,10)"))
    return F.when(from_ccy == to_ccy, amount.cast("decimal(38,10)")).otherwise(F.bround(through, 10).cast("decimal(38,10)"))


def to_base(df: DataFrame, rates: DataFrame, amount: str = "price_amount", currency: str = "price_currency", day: str = "fx_date") -> DataFrame:
    """Add amount_eur and drop rows without a rate."""
    j = as_of(df, rates, currency, day, "_fx")
    return j.withColumn("amount_eur", converted(F.col(amount), F.col(currency), F.lit(BASE), F.col("_fx"), F.lit(1))).drop("_fx").where("amount_eur is not null")


def ratio(a: Column, b: Column, a_ccy: Column, b_ccy: Column, a_rate: Column, b_rate: Column) -> Column:
    """a divided by b in a's currency; null on a missing rate or zero."""
    return F.try_divide(a.cast("double"), converted(b, b_ccy, a_ccy, b_rate, a_rate).cast("double"))

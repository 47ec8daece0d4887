import bisect
import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from crosslane.operators import fx, ordered

DAY = datetime.date


@pytest.mark.parametrize("most", [10_000, 0])
def test_both_ways_give_the_same_rates(spark, monkeypatch, most):
    monkeypatch.setattr(fx, "MOST_BROADCAST", most)
    rng = random.Random(4)
    stamp = lambda k: datetime.datetime(2020, 1, 1, k)
    rates = [("EUR", c, DAY(2020, 1, 1) + datetime.timedelta(rng.randrange(300)), Decimal(rng.randrange(1, 99)), "", stamp(rng.randrange(3))) for c in ("PLN", "CZK") for _ in range(60)] + [("USD", "PLN", DAY(2020, 1, 5), Decimal(7), "", stamp(1))]
    rows = [(i, rng.choice(["PLN", "CZK", "EUR", "XXX", None]), DAY(2019, 12, 1) + datetime.timedelta(rng.randrange(400)) if i % 9 else None) for i in range(400)]
    got = {r.i: r.rate for r in fx.as_of(spark.createDataFrame(rows, "i int, c string, day date"), spark.createDataFrame(rates, fx.RATE), "c", "day", "rate").collect()}
    for i, c, day in rows:
        known = [(d, s, r) for f, t, d, r, _, s in rates if f == "EUR" and t == c and day and d <= day]
        assert got[i] == (1 if c == "EUR" else max(known)[2] if known else None)


def test_a_million_rates_of_one_currency(spark):
    """Rates of every second day; nothing is broadcast, and the currency is dealt to many tasks."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = 1_000_000
        day = lambda c: F.date_add(F.lit("0001-01-01").cast("date"), c.cast("int"))
        rates = spark.range(n).select(F.lit("EUR").alias("from_ccy"), F.lit("PLN").alias("to_ccy"), day(F.col("id") * 2 + 2).alias("rate_date"), (F.col("id") % 99999).cast("decimal(18,10)").alias("rate"), F.lit("").alias("source_url"), F.lit(None).cast("timestamp").alias("stored_at"))
        rows = spark.range(300_000).select("id", F.lit("PLN").alias("ccy"), day(F.pmod(F.xxhash64("id"), F.lit(2 * n)).cast("int")).alias("day"))
        out = fx.as_of(rows, rates, "ccy", "day", "rate")
        place = F.datediff("day", F.lit("0001-01-01").cast("date"))
        want = F.when(place >= 2, (F.floor((place - 2) / 2) % 99999).cast("decimal(18,10)"))
        assert out.where(~F.col("rate").eqNullSafe(want)).count() == 0 and out.count() == 300_000
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_last_before_carries_over_ranges(spark):
    """Ranges without an event take the last one of an earlier range."""
    events = spark.createDataFrame([("a", 5, 50), ("a", 5, 40), ("a", 900, 60), ("b", 1, 1)], "k string, t int, v int")
    asked = spark.createDataFrame([("a", t) for t in range(1000)] + [("b", 0), ("c", 3), ("b", 7), ("b", 7)], "k string, t int")
    got = sorted((r.k, r.t, r.v) for r in ordered.last_before(asked, events, "k", "t", "v").collect())
    times = [5, 900]
    want = [("a", t, [None, 50, 60][bisect.bisect_right(times, t)]) for t in range(1000)] + [("b", 0, None), ("c", 3, None), ("b", 7, 1), ("b", 7, 1)]
    assert got == sorted(want)
    assert ordered.last_before(asked.limit(0), events, "k", "t", "v").count() == 0

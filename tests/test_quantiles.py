import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from crosslane.operators import quality, quantiles

WANTED = (0.25, 0.5, 0.75)


def exact(spark, rows, wanted=WANTED):
    df = spark.createDataFrame(rows, "k string, v double")
    return {r.k: r.quantiles for r in quantiles.exact_quantiles(df, ["k"], "v", wanted).collect()}


@pytest.mark.parametrize("margins", [quantiles.MARGINS, (0.0, 0.01, 1.0)])
def test_quantiles_equal_linear_interpolation(spark, monkeypatch, margins):
    """With a range of no width most quantiles lie outside at first, and wider ones are taken."""
    monkeypatch.setattr(quantiles, "MARGINS", margins)
    rng = random.Random(2)
    groups = {"one": [7.5], "two": [1.0, 2.0], "same": [3.0] * 50, "ties": [float(rng.randrange(4)) for _ in range(301)], "wide": [10.0 ** rng.uniform(-300, 300) for _ in range(1000)], "neg": [rng.gauss(0, 5) for _ in range(777)], None: [1.0, 5.0, 9.0, 2.0]}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("none", None), ("neg", None)]
    rng.shuffle(rows)
    got = exact(spark, rows, (0.0, *WANTED, 1.0))
    assert set(got) == set(groups)
    for k, vs in groups.items():
        assert got[k] == pytest.approx(np.quantile(vs, (0.0, *WANTED, 1.0)).tolist(), rel=1e-12)


def test_a_group_of_ten_million_distinct_values(spark):
    n = 10_000_000
    df = spark.range(n).select(F.lit("all").alias("k"), (F.pmod(F.col("id") * 7_919_333, F.lit(n)) / 4).cast("double").alias("v"))
    (r,) = quantiles.exact_quantiles(df, ["k"], "v", WANTED).collect()
    assert r.quantiles == pytest.approx([(n - 1) * q / 4 for q in WANTED], rel=1e-12)


def test_profiles_are_the_same_whatever_the_size_of_a_group(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(rng.choice(["AA", "BB", None]), f"2024-01-0{rng.choice('12')}", rng.choice([None, 0.0, rng.gauss(50, 20), 9e5])) for _ in range(900)] + [("CC", "2024-01-01", None)]
    df = spark.createDataFrame(rows, "country_code string, snapshot_date string, v double")
    plain = lambda: sorted((tuple(map(str, r)) for r in quality.numeric_profile(df, "v", quality.SNAPSHOT).select(sorted(cols)).collect()))
    cols = quality.numeric_profile(df, "v", quality.SNAPSHOT).columns
    want = plain()
    monkeypatch.setattr(quality, "LARGE", 50)
    assert plain() == want

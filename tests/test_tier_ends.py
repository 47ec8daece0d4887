"""Prices whose derived amount is the end of a tier, against the SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

from crosslane.registry import ORACLE_SQL, QUERIES

from .conftest import DATA

ENDS = (940.0, 6677.5, 7691.46, 9972.0, 14099.0, 26956.0, 64580.0, 997.2, 1409.9, 2695.6, 6458.0, 14304.0, 26094.64, 57814.64)


@pytest.mark.parametrize("name", ["tiered_prices", "default_lanes"])
def test_ends_of_tiers_are_those_of_the_sql(spark, tmp_path, name):
    line = spark.read.parquet(f"{DATA}/lineitem.parquet")
    price = F.element_at(F.array(*[F.lit(x) for x in ENDS]), (F.col("l_orderkey") % len(ENDS) + 1).cast("int"))
    line.withColumn("l_extendedprice", price).write.parquet(f"{tmp_path}/lineitem.parquet")
    duck = duckdb.connect()
    duck.sql(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    for t in ("part", "supplier", "nation"):
        spark.read.parquet(f"{DATA}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
        duck.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got = QUERIES[name](spark, str(tmp_path))
    want = duck.sql(ORACLE_SQL[name])
    rows = want.fetchall()
    at = [want.columns.index(c) for c in got.columns]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(tuple(r[i] for i in at)) for r in rows) and rows

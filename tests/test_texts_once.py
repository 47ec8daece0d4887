from dataclasses import replace

from pyspark.sql import functions as F

from crosslane.operators import canonical
from crosslane.plans import list_queries
from crosslane.sources import tables
from tests.conftest import DATA

ODD = {"IE": {"Drug Name": None}, "PL": {"Nazwa  postać i dawka": ","}, "BE": {"S_NAM": None, "S_NAM_SPECIF": None}}


def test_texts_of_lists_are_read_once(spark):
    """Rows meet what was made of their distinct texts: their plan has no form rule, and they are those that reading every row gives."""
    lists = list_queries._lists(spark, DATA)
    for code, odd in ODD.items():
        c = canonical.COUNTRIES[code]
        some = tables.written(lists[code].limit(100), "some")
        rows = some.unionByName(some.limit(5).withColumns({k: F.lit(v).cast("string") for k, v in odd.items()}))
        told = canonical.judged(rows, c)
        assert "RLIKE" not in told._jdf.queryExecution().optimizedPlan().toString(), code
        each = canonical.judged(rows, replace(c, texts=None))
        assert set(told.columns) == set(each.columns), code
        assert sorted(map(str, told.collect())) == sorted(map(str, each.select(*told.columns).collect())), code

from pyspark.sql import functions as F

import corpus_pipeline
from crosslane.llm import toxicity
from crosslane.llm.registry import ORACLE_SQL, QUERIES

from ..conftest import DATA
from .test_operators import SPACES, brute


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    cols = docs.columns
    steps = [f for _, f in corpus_pipeline.STAGES]
    clean = steps[0](spark, docs, DATA).cache()
    model = toxicity.train(docs.select("doc_id", "text"), spark.read.parquet(f"{DATA}/labels.parquet"))
    want = {r.doc_id for r in toxicity.score(docs, model).where("score < 0.5").collect()}
    assert {r.doc_id for r in clean.collect()} == want and clean.columns == cols
    single = steps[1](spark, clean, DATA).cache()
    least: dict = {}
    for r in clean.collect():
        k = SPACES.sub(" ", r.text or "")
        least[k] = min(r.doc_id, least.get(k, r.doc_id))
    assert sorted(r.doc_id for r in single.collect()) == sorted(least.values()) and single.columns == cols
    apart = steps[2](spark, single, DATA).cache()
    keep = {d for d, _, c in brute([(r.doc_id, r.text) for r in single.collect()], 5, 80, 100) if c == d}
    assert {r.doc_id for r in apart.collect()} == keep and apart.columns == cols
    mixed = steps[3](spark, apart, DATA)
    assert mixed.columns == cols and mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    tokens = steps[4](spark, mixed, DATA)
    assert tokens.count() == mixed.count() and tokens.where("n_tokens <> size(token_ids)").count() == 0


def test_every_number_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)

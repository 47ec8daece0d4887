"""Torn archives, the mix behind its cut, and the pipeline's stages on columns with the names of their own."""

import gzip
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from crosslane.llm import mixing, warc

from ..conftest import DATA


def archive(pages):
    out = b""
    for i, body in pages:
        for r in warc.records(i, i, f"http://e/{i}", body.encode(), None, None, 400):
            out += r + b"\r\n\r\n"
    return out


def read(spark, folder):
    rows = warc.payloads(warc.reassemble(warc.read_records(spark, f"file://{folder}"))).collect()
    return sorted(int(r.page) for r in rows if r.fault is None), sorted(r.fault for r in rows if r.fault)


def test_a_torn_file_holds_nothing_up(spark, tmp_path):
    good, torn = archive([(1, "a" * 100), (2, "b" * 2000)]), archive([(3, "c" * 50), (4, "d" * 50)])
    (tmp_path / "good.warc").write_bytes(good)
    assert read(spark, tmp_path) == ([1, 2], [])
    (tmp_path / "torn.warc").write_bytes(torn[:-60])
    ids, faults = read(spark, tmp_path)
    assert ids == [1, 2, 3] and len(faults) == 1 and "cut off" in faults[0]
    rng = random.Random(1)
    noise = gzip.compress(archive([(9, "".join(rng.choice("abcdefgh") for _ in range(3000)))]))
    (tmp_path / "half.warc.gz").write_bytes(gzip.compress(archive([(5, "e" * 60)])) + noise[: len(noise) // 2])
    (tmp_path / "other.warc.gz").write_bytes(gzip.compress(archive([(6, "f" * 60)])) + b"no gzip")
    (tmp_path / "length.warc").write_bytes(archive([(7, "g")]) + b"WARC/1.1\r\nContent-Length: -5\r\n\r\nxx\r\n\r\n")
    (tmp_path / "none.warc").write_bytes(b"hello")
    ids, faults = read(spark, tmp_path)
    assert ids == [1, 2, 3, 5, 6, 7] and len(faults) == 6 and "segments are missing" in faults  # of page 9 the first segments are there
    assert sum("gzip" in f for f in faults) == 2
    rows = warc.resolved(warc.payloads(warc.reassemble(warc.read_records(spark, f"file://{tmp_path}")))).collect()
    assert sum(r.type == warc.TORN for r in rows) == 5


@pytest.mark.parametrize("seed", range(3))
def test_the_mix_is_full_up_to_less_than_a_row(spark, monkeypatch, seed):
    """Few rows, some of them very long: what a source takes is short of its target by less than any row that it could still take."""
    monkeypatch.setattr(mixing, "CELLS", 8)
    rng = random.Random(seed)
    rows = [(i, "w " * rng.choice([0, 1, 3, 40, 41, 900, 5000][: 3 + s % 5]), None if s == 6 else f"s{s}") for s in range(7) for i in range(s * 100, s * 100 + rng.randint(1, 60))]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.doc.source].append(r)
    for own in by.values():
        target, taken, total = own[0].target, sum(r.size * r.copies for r in own), own[0].source_size
        whole = min(3, int(target // total)) if total else 0
        assert taken <= target + 1e-6 and {r.copies - whole for r in own} <= {0, 1}
        rest = [r.size for r in own if r.size and r.copies == whole]
        if whole < 3 and rest:
            assert target - taken < min(rest) + 1e-6


NAMES = ("_gone", "_hot", "_score", "score", "_key", "_row", "_part", "_at", "_rank", "_text", "digest", "keep_id", "group_size", "kept", "size", "copies", "target", "source_size", "doc", "_size", "_place", "_source", "token_ids", "n_tokens", "token_offsets", "component_id", "n_shingles", "id", "row", "none", "first", "key")


@pytest.mark.parametrize("rows", [120, 0])
def test_stages_on_columns_of_their_own_names(spark, rows):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").limit(rows)
    docs = docs.withColumns({n: F.lit("clash") for n in NAMES})
    now = docs.unionByName(docs.limit(3).withColumn("doc_id", F.lit(None).cast("long"))).unionByName(docs.limit(2).withColumn("text", F.lit(None).cast("string")))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, DATA)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns and out.where("_gone <> 'clash'").count() == 0
            now = corpus_pipeline.written(out, "stage")
    assert (out.count() > 0) == (rows > 0)

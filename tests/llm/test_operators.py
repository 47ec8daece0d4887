"""The training-data operators against brute force, round trips and edge cases."""

import hashlib
import random
import re
import textwrap
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from crosslane.llm import bpe, chat, exact_dedup, jaccard_join, licenses, mixing, secrets, toxicity, vector_search, warc

DOC = "doc_id long, text string"
SPACES = re.compile(r"[\x20\x09-\x0D]+")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = [None, "", " ", "a", "A b", "a\tb", "é\n", "x" * 3000, "w " * 5000, "don't 'll  \n\n x1２", "　wide space"]


def docs(spark, texts, ids=None):
    return spark.createDataFrame(list(zip(ids or range(len(texts)), texts, strict=True)), DOC)


# --- byte-level BPE


def oracle():
    import public_tokenizers

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.vocabulary(bpe.rank_file()).ranks, special_tokens={})


def test_bpe_matches_the_library(spark):
    rng = random.Random(1)
    parts = ["'s", "'re", "'ll", "'v", "'", "' ", "a", "é", "\n", " ", "  ", "\t", "1", "²", "!", "中文", " ", "The", ".", "'ve", "\x1c", "👍", "ab" * 700]
    texts = EDGES + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 20))) for _ in range(400)]
    enc = oracle()
    got = {r.doc_id: r for r in bpe.token_digests(docs(spark, texts), bpe.rank_file()).collect()}
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_bpe_offsets_decode(spark):
    df = docs(spark, ["don't stop", None, "größe"]).withColumn("token_ids", F.lit("clash"))
    v = bpe.vocabulary(bpe.rank_file())
    for r in bpe.encode(df, bpe.rank_file()).collect():
        raw = (r.text or "").encode()
        assert bpe.decode(np.array(r.token_ids, np.int64), v).tobytes() == raw
        assert [raw[a:b] for a, b in zip(r.token_offsets, [*r.token_offsets[1:], len(raw)][: len(r.token_offsets)], strict=True)] == [v.pieces[i] for i in r.token_ids]
    assert bpe.encode(df.limit(0), bpe.rank_file()).count() == 0


def test_bpe_of_repeated_texts(spark, monkeypatch):
    monkeypatch.setattr(bpe, "OUT_TOKENS", 7)  # many cuts; the value travels with the task
    enc = oracle()
    texts = [t for i, t in enumerate([*EDGES, "so it goes, once more"]) for _ in range(1 + i % 3)] + ["a", None, "so it goes, once more"]
    got = bpe.encode(docs(spark, texts).coalesce(1), bpe.rank_file()).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(texts)))
    for r in got:
        assert r.text == texts[r.doc_id]
        assert r.token_ids == enc.encode_ordinary(r.text or "")
        sizes = [len(enc.decode_single_token_bytes(t)) for t in r.token_ids]
        assert r.token_offsets == [sum(sizes[:i]) for i in range(len(sizes))]


def test_bpe_of_bytes_that_are_no_text(spark):
    raw = [b"ok \xff\xfe then", b"plain", None, b"\xe4\xb8"]
    df = spark.createDataFrame(list(enumerate(raw)), "doc_id long, raw binary").select("doc_id", F.col("raw").cast("string").alias("text"))
    enc, got = oracle(), {r.doc_id: r for r in bpe.token_digests(df, bpe.rank_file()).collect()}
    for i, b in enumerate(raw):
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, enc.encode_ordinary((b or b"").decode("utf-8", "replace")))).encode()).hexdigest()


# --- toxicity


def test_toxicity_learns_and_ignores_groups(spark):
    rng = random.Random(2)
    words = ["the", "house", "runs", "green", "river", "often", "small", "stone"]
    rows, labels = [], []
    for i in range(900):
        text = [rng.choice(words) for _ in range(30)]
        bad = i % 4 == 0
        # Women are named more often in toxic texts: without the penalty, the word would carry weight.
        text.insert(3, "women" if bad or rng.random() < 0.2 else "men")
        if bad:
            text.insert(rng.randint(0, 30), rng.choice(["idiot", "scum"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    df, lab = spark.createDataFrame(rows, DOC), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(df, lab)
    scored = toxicity.score(df.withColumn("score", F.lit("clash")), model).withColumn("h", toxicity.held_out()).join(lab, "doc_id").where("h").collect()
    assert sum((r.score >= 0.5) == bool(r.toxic) for r in scored) >= 0.95 * len(scored)
    plain, swapped = model.scores(pa.array(["the women and the river", "the men and the river"]))
    assert abs(plain - swapped) < 0.1
    edge = toxicity.score(docs(spark, EDGES), model).collect()
    assert all(0 <= r.score <= 1 for r in edge) and len(edge) == len(EDGES)


def test_toxicity_without_labels(spark):
    model = toxicity.train(docs(spark, ["a", None]), spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(docs(spark, ["a"]), model).first().score == pytest.approx(0.5)


def test_fit_matches_a_plain_one():
    """The same loss and steps, written out row by row in double precision."""
    rng = np.random.default_rng(9)
    x = (rng.random((40, 3)) < 0.4).astype(np.float32)
    toxic = (x[:, 0] + rng.random(40) > 0.9).astype(np.int64)
    gap = np.where(rng.random((10, 3)) < 0.3, 1, 0).astype(np.float32)
    w, b = [0.0] * 3, float(np.log(toxic.sum() / (40 - toxic.sum())))
    share = {1: 0.5 / toxic.sum(), 0: 0.5 / (40 - toxic.sum())}
    m, v = [0.0] * 4, [0.0] * 4
    for t in range(1, 61):
        g = [toxicity.RIDGE * k for k in w] + [0.0]
        for row, y in zip(x, toxic, strict=True):
            e = (1 / (1 + np.exp(-(sum(k * float(c) for k, c in zip(w, row, strict=True)) + b))) - y) * share[int(y)]
            g = [q + e * c for q, c in zip(g, [*map(float, row), 1.0], strict=True)]
        for row in gap:
            change = sum(k * float(c) for k, c in zip(w, row, strict=True))
            g = [q + 2 * toxicity.FAIRNESS * change * c / len(gap) for q, c in zip(g, [*map(float, row), 0.0], strict=True)]
        m, v = [0.9 * a + 0.1 * q for a, q in zip(m, g, strict=True)], [0.999 * a + 0.001 * q * q for a, q in zip(v, g, strict=True)]
        step = [0.05 * (a / (1 - 0.9**t)) / (np.sqrt(c / (1 - 0.999**t)) + 1e-8) for a, c in zip(m, v, strict=True)]
        w, b = [k - q for k, q in zip(w, step[:3], strict=True)], b - step[3]
    got, at = toxicity.fit(x, gap, toxic, steps=60)
    assert np.allclose(got, w, atol=1e-3) and at == pytest.approx(b, abs=1e-3)


def test_features_are_chosen_by_chi_square():
    bad, good = np.array([50, 5, 2, 30, 0]), np.array([0, 5, 2, 30, 60])
    n_bad, n_good = 60, 90
    want = []
    for i, (a, g) in enumerate(zip(bad, good, strict=True)):
        e = (a + g) * n_bad / (n_bad + n_good)
        chi = (a - e) ** 2 / (e * (1 - n_bad / 150) * (1 - (a + g) / 150)) if a + g >= 5 else 0
        want += [i] if chi > 3.84 else []
    assert toxicity.chosen_features(bad, good, n_bad, n_good).tolist() == want == [0, 3, 4]


def test_null_ids_are_held_out(spark):
    assert [r[0] for r in docs(spark, ["a", "b"], [None, 3]).select(toxicity.held_out()).collect()][0] is True


def test_counterfactual_swaps_terms():
    assert toxicity.counterfactual("Women and muslim men") == "Men and christian women"


# --- Jaccard join


def shingles(text, k):
    w = WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k, num, den):
    sets = [(i, shingles(t, k)) for i, t in rows]
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            n = len(x & y)
            if x and y and den * n >= num * (len(x) + len(y) - n):
                up[max(find(a), find(b))] = min(find(a), find(b))
    least = defaultdict(lambda: 1 << 60)
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(least[find(i)], d)
    return {(d, len(s), least[find(i)]) for i, (d, s) in enumerate(sets)}


def near_copies(rng, n_groups=12, size=9):
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = []
    for g in range(n_groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 30, 150, 400]))] + (passage if g % 3 == 0 else [])
        for _ in range(size):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
            texts.append(" ".join(t).upper() if rng.random() < 0.2 else "\n".join(t))
    return texts


@pytest.mark.parametrize(("width", "num", "den", "block"), [(4, 85, 100, None), (5, 80, 100, None), (4, 85, 100, 600)])
def test_jaccard_matches_brute_force(spark, monkeypatch, width, num, den, block):
    if block:  # blocks are searched tile by tile
        monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block)
    texts = EDGES + near_copies(random.Random(width * num)) + ["one two three", "one two three", "a b c d e"]
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOC).repartition(5).withColumn("size", F.lit(1)).withColumn("key", F.lit("clash"))
    got = jaccard_join.near_duplicates(df, width, num, den)
    assert {tuple(r) for r in got.collect()} == brute(rows, width, num, den)


def test_jaccard_empty_and_representatives(spark):
    assert jaccard_join.near_duplicates(docs(spark, ["a"]).limit(0)).count() == 0
    t = " ".join(f"v{i}" for i in range(200))
    df = docs(spark, [t, t + " x", t, "other", None], [5, 3, 5, 7, 9]).withColumn("n", F.lit(0))
    kept = jaccard_join.representatives(df, 5, 80, 100)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7, 9] and kept.columns == df.columns


def test_divide_skip_block():
    rng = np.random.default_rng(3)
    base = rng.choice(10_000, 150, replace=False).astype(np.uint64)
    sets = []
    for _ in range(120):
        s = base.copy()
        s[rng.integers(0, 150, rng.integers(0, 14))] = rng.integers(10_000, 1 << 40, 1).astype(np.uint64)
        sets.append(np.unique(s))
    roots = jaccard_join.search_block(sets, 85, 100)
    groups = defaultdict(set)
    for i, r in enumerate(roots):
        groups[r].add(i)
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            n = len(np.intersect1d(sets[a], sets[b]))
            if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
                up[find(a)] = find(b)
    want = defaultdict(set)
    for i in range(len(sets)):
        want[find(i)].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


# --- licences


def test_licenses(spark):
    mit = dict(licenses.LICENSES)["MIT"]
    texts = ["Copyright (c) 2020 Me\n\n" + mit.upper().replace(",", " ,"), mit.replace("sublicense", "sublicence"), "x\nReleased under the MIT licence!\ny\nSPDX-License-Identifier: Apache-2.0", mit + " more", None, "", mit]
    got = {r.doc_id: r for r in licenses.scan(docs(spark, texts).withColumn("license_id", F.lit(1))).collect()}
    assert [got[i].license_id for i in range(7)] == ["MIT", "MIT", None, None, None, None, "MIT"]
    assert got[2].notice_ids == "Apache-2.0,MIT" and got[4].notice_ids == "" and got[5].canonical_chars == 0
    assert licenses.scan(docs(spark, ["a"]).limit(0)).count() == 0


def test_neighbouring_spellings(spark):
    df = spark.createDataFrame([("x programme programme licence licence y",), ("Whilst whilst\nWHILST wilful fulfil",)], "t string")
    assert [r[0] for r in df.select(licenses.canonical(F.col("t"))).collect()] == ["x program program license license y", "while while while willful fulfill"]


def test_license_query_finds_whole_texts(spark, tmp_path):
    mit = dict(licenses.LICENSES)["MIT"]
    docs(spark, ["Copyright 2020 Me\n" + mit, "plain\nReleased under the MIT License.", licenses.whole_texts()[-1][1], None]).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.license_id, r.notice_ids) for r in licenses.op4_license_scan(spark, str(tmp_path)).collect()}
    assert got == {0: ("MIT", ""), 1: (None, "MIT"), 2: (licenses.whole_texts()[-1][0], got[2][1]), 3: (None, "")}


def test_licenses_wrapped(spark):
    wrap = lambda t, n: "\n\n".join(textwrap.fill(p, n) for p in t.split("\n\n"))
    texts = [(i, w) for i, t in licenses.LICENSES for w in (" ".join(t.split()), *[wrap(t, n) for n in (72, 80)], *[wrap(t, n).upper() for n in (40, 60)])]
    isc = dict(licenses.LICENSES)["ISC"].replace("above copyright", "above\ncopyright")
    texts.append(("ISC", "Copyright (c) 2020 Me\n\n" + isc))
    got = {r.doc_id: r.license_id for r in licenses.scan(docs(spark, [t for _, t in texts])).collect()}
    assert [got[i] for i in range(len(texts))] == [i for i, _ in texts]


def test_licenses_of_the_data_files(spark):
    folder = Path(licenses.__file__).parent / "license_texts"
    whole = [(f.stem, f.read_text()) for f in sorted(folder.iterdir())]
    assert {"Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "MPL-2.0", "CC0-1.0"} <= {i for i, _ in whole}
    texts = whole + [(i, t.replace("\n", "\n# ")) for i, t in whole] + [(i, t.replace("https:", "http:").upper()) for i, t in whole]
    texts += [(i, t.split("How to Apply")[0].split("APPENDIX")[0]) for i, t in whole if i in ("Apache-2.0", "GPL-3.0-only")]
    texts += [(None, t + " more") for _, t in whole]
    got = {r.doc_id: r.license_id for r in licenses.scan(docs(spark, [t for _, t in texts])).collect()}
    assert [got[i] for i in range(len(texts))] == [i for i, _ in texts]


COPYRIGHT_NOTICES = [
    "Copyright (c) 2020 Me", "COPYRIGHT (C) ME", "# © Me", "Copyright © Me", "copyright 2020 me", "Copyright: 2019-2020, Me", "(c) 2020 Me", "(C) Copyright 2020 Me", "(c) Me, Inc. and its affiliates.",
    "Copyright [yyyy] [name of copyright owner]", "Copyright <YEAR> <COPYRIGHT HOLDER>", "Copyright Joyent, Inc. and other Node contributors.", "Copyright by The Authors", "Copyright Étienne", "(c) Me and Co 2020", "copyright (c) me", "Copyrighted 2020 by Me",
]
LICENSE_LINES = [
    "copyright notice and this permission notice appear in all copies.", "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM", "copyright owner or by an individual", "* copyright holder nor the names", "copyright", "COPYRIGHT OWNER OR",
    "(c) You must retain, in the Source form of any Derivative Works", "(c) the licenses granted", "(C) YOU MUST RETAIN", "(c)    Representations.", "\"COPYRIGHT\" LINE AND A POINTER", "\"Copyright\" also means copyright-like laws", "copyright license to reproduce", "copyrighted by the Free Software", "Copyright Notice", "copyright. You may", "copyright and related rights",
]


def test_copyright_lines(spark):
    notices, bodies = COPYRIGHT_NOTICES, LICENSE_LINES
    rows = spark.createDataFrame([(t,) for t in notices + bodies], "t string").select("t", licenses.canonical(F.concat(F.lit("a\n"), F.col("t"), F.lit("\nb"))).alias("c")).collect()
    assert {r.t for r in rows if r.c == "a b"} == set(notices)


def test_license_sql_is_the_same_function(spark, tmp_path):
    apache = dict(licenses.whole_texts())["Apache-2.0"]
    isc = dict(licenses.LICENSES)["ISC"].replace("above copyright", "above\ncopyright")
    texts = [apache, "Copyright 2020 Me\n" + apache, isc, "(c) 2020 Me\n" + isc, None, "", "© Me\r\nx", "By copyright by And\ncopyright by Me\ncopyright by é", *[f"a\n{x}\nb" for x in COPYRIGHT_NOTICES + LICENSE_LINES], *[x for x in COPYRIGHT_NOTICES + LICENSE_LINES]]
    docs(spark, texts).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, licenses.op4_license_scan(spark, str(tmp_path)).collect()))
    duck = duckdb.connect()
    duck.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(duck.sql(licenses.oracle()).fetchall())
    assert [r[3] for r in got[:4]] == ["Apache-2.0", "Apache-2.0", "ISC", "ISC"]


# --- vectors


def test_vectors_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "QUERY_BLOCK", 3)
    monkeypatch.setattr(vector_search, "VECTOR_BLOCK", 40)
    monkeypatch.setattr(vector_search, "FAN_IN", 2)
    rng = np.random.default_rng(5)
    m = rng.normal(size=(300, 16)).astype(np.float32)
    m[50:120] = m[50]  # many equal vectors
    m[7] *= 1000
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)] + [(400, None), (450, [0.0] * 16), (500, [float("nan")] + [1.0] * 15), (550, [None] + [1.0] * 15), (600, [float("inf")] + [1.0] * 15)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = defaultdict(list)
    for r in vector_search.nearest(df, df.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    v = m.astype(np.float64)
    assert sorted(got) == list(range(0, 300, 50))
    for q, found in got.items():
        s = vector_search.cosines(np.repeat(v[q : q + 1], 300, 0), v)
        assert found == [(i, s[i]) for i in sorted((i for i in range(300) if i != q), key=lambda i: (-s[i], i))[:5]]
    few = df.where("vec_id < 3")
    assert vector_search.nearest(few, few.where("vec_id = 0")).count() == 2
    assert vector_search.nearest(few.limit(0), few.limit(0)).count() == 0


def test_vectors_of_other_lengths_and_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "STRIP", 2)
    rows = [(i, [float(i + 1), 1.0]) for i in range(6)] + [(100 + i, [1.0, float(i), 2.0]) for i in range(4)] + [(200, [1e200, 1e200]), (201, [3e-200, 1e-200]), (202, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.query_id: r for r in vector_search.nearest(df, df, k=1).collect()}
    assert sorted(got) == [*range(6), 100, 101, 102, 103, 200, 201]
    assert (got[200].vec_id, got[201].vec_id) == (0, 2) and got[200].score == pytest.approx(1) and got[201].score == pytest.approx(1)
    assert all(got[100 + i].vec_id >= 100 for i in range(4))


# --- exact dedup


def test_exact_dedup(spark):
    texts = ["a  b", "a\tb", "a b", "", None, "A b", "c", "c"]
    df = spark.createDataFrame(list(zip([9, 3, 3, 1, 2, 7, None, 5], texts, strict=True)), DOC).withColumn("digest", F.lit("clash"))
    index = exact_dedup.new_index_name()
    got = exact_dedup.deduplicate(df, index).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.keep_id, r.group_size) for r in got if r.doc_id) == sorted([(False, 9, 3, 3), (False, 3, 3, 3), (False, 3, 3, 3), (False, 1, 1, 2), (False, 2, 1, 2), (False, 7, 7, 1), (False, 5, 5, 2)])
    assert sum(r.kept for r in got) == 4  # of the repeated id 3, one row stays
    assert {r.text_sha256 for r in got if r.doc_id == 9} == {hashlib.sha256(b"a b").hexdigest()}
    # A later batch is judged against the index, and only what is new is appended.
    again = {r.doc_id: r for r in exact_dedup.deduplicate(docs(spark, ["a b", "new", "new"], [100, 102, 101]), index).collect()}
    assert [(again[i].keep_id, again[i].kept) for i in (100, 101, 102)] == [(3, False), (101, True), (101, False)]
    assert spark.table(index).count() == 5
    assert exact_dedup.deduplicate(df.limit(0), index).count() == 0
    assert exact_dedup.kept_rows(df, exact_dedup.new_index_name()).columns == df.columns


def test_a_batch_judged_again_gives_the_same(spark):
    index = exact_dedup.new_index_name()
    exact_dedup.deduplicate(docs(spark, ["a", "b"], [1, 2]), index, batch="one").count()
    batch = docs(spark, ["b", "c", "c", None], [3, 5, 4, 6])
    got = [sorted(tuple(r)[:5] for r in exact_dedup.deduplicate(batch, index, batch="two").collect()) for _ in range(3)]
    assert got[0] == got[1] == got[2] and [r[1:4] for r in got[0]] == [(2, 1, False), (4, 2, True), (4, 2, False), (6, 1, True)]
    assert spark.table(index).count() == 4
    exact_dedup.drop_index(spark, index)
    assert not spark.catalog.tableExists(index)


def test_dedup_query_of_two_batches_matches_sql(spark, tmp_path):
    rng = random.Random(8)
    texts = [rng.choice([None, "", " ", "a", "a b", "a\tb", "b", "c  d", "c d", str(rng.random())]) for _ in range(400)]
    docs(spark, texts).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = exact_dedup.op6_exact_dedup(spark, str(tmp_path))
    want = duck.sql(exact_dedup.ORACLE["op6_exact_dedup"])
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(want.fetchall())
    docs(spark, ["a"]).limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert exact_dedup.op6_exact_dedup(spark, f"{tmp_path}/empty").count() == 0


def test_hot_group(spark):
    df = docs(spark, ["same"] * 1500 + [f"t{i}" for i in range(500)])
    got = exact_dedup.deduplicate(df, exact_dedup.new_index_name())
    assert got.where("group_size = 1500 and keep_id = 0").count() == 1500 and got.where("kept").count() == 501


# --- WARC


def test_warc_round_trip(spark):
    big, multi = "<p>" + "x" * 50_000, "é" * 20_000 + "\r\n\r\nWARC/1.1\r\n"
    bodies = [big, big, big, multi, None, "", "s" * 999, "s" * 999, "t" * 1000, "t" * 1000]
    rows = [(i, f"http://e/{i} a\n", b) for i, b in enumerate(bodies)] + [(2, None, big), (None, "u", "n")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("_digest", F.lit("clash"))
    path = warc.new_path(spark, "warc")
    warc.write_archives(df, path)
    parts = warc.read_records(spark, path)
    assert parts.where("segment > 1").count() >= 3
    got = warc.resolved(warc.payloads(warc.reassemble(parts))).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.page].append(r)
    for i, b in enumerate(bodies):
        raw = (b or "").encode()
        for r in by[str(i)]:
            assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
    assert [by[str(i)][0].type for i in (0, 1, 3, 6, 7, 8, 9)] == ["revisit", "revisit", "response", "response", "response", "revisit", "response"]
    assert sorted(r.type for r in by["2"]) == ["response", "revisit"] and by["0"][0].refers_to_page == "2"


def test_missing_segment_is_seen(spark):
    df = spark.createDataFrame([(1, "u", "x" * 60_000)], "page_id long, url string, html string")
    path = warc.new_path(spark, "warc")
    warc.write_archives(df, path)
    parts = warc.read_records(spark, path)
    assert warc.reassemble(parts.where("segment <> 2")).first().complete is False
    assert warc.reassemble(parts.unionByName(parts)).first().complete is True  # captured twice
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nab")


def test_torn_records_are_told_apart(spark):
    df = spark.createDataFrame([(1, "u", "x" * 60_000), (2, "u", "y")], "page_id long, url string, html string")
    path = warc.new_path(spark, "warc")
    warc.write_archives(df, path)
    whole = warc.reassemble(warc.read_records(spark, path).where("segment <> 2"))
    wrong = whole.withColumn("digest", F.when(F.col("page") == "2", "sha1:x").otherwise(F.col("digest")))
    assert {(r.page, r.payload_bytes, r.fault) for r in warc.payloads(whole).collect()} == {("1", None, "segments are missing"), ("2", 1, None)}
    assert {r.fault for r in warc.payloads(wrong).where("page = '2'").collect()} == {"the payload isn't the one that was digested"}


def test_very_long_page(spark):
    import time

    df = spark.createDataFrame([(1, "u", "é<p>" * 8_000_000)], "page_id long, url string, html string")
    path = warc.new_path(spark, "warc")
    warc.write_archives(df, path)
    began = time.perf_counter()
    r = warc.payloads(warc.reassemble(warc.read_records(spark, path))).first()
    assert (r.payload_bytes, r.fault) == (40_000_000, None) and time.perf_counter() - began < 60


# --- chat


def test_preference_pairs(spark):
    cols = "conv_id long, turn long, role string, text string"
    a = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "good"), (2, 0, "user", "q"), (3, 0, "user", None), (4, 0, None, "z"), (5, 0, "user", "a")], cols).withColumn("turns", F.lit(1))
    b = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "bad"), (2, 0, "user", "other"), (3, 0, "user", ""), (4, 0, "", "z"), (4, 1, "assistant", "w"), (6, 0, "user", "b")], cols)
    got = {r.pair_id: r for r in chat.preference_pairs(a, b).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert (got[1].prompt_turns, got[2].prompt_turns, got[3].prompt_turns, got[4].prompt_turns) == (1, 0, 1, 1)
    for r in got.values():
        for text, spans in ((r.chosen, r.chosen_spans), (r.rejected, r.rejected_spans)):
            assert [text[int(x) : int(y)] for x, y in (s.split(":") for s in spans.split(",") if s)] == [m[1] for m in re.finditer(r"<\|assistant\|>\n(.*?<\|end\|>\n)", text)]
    assert got[3].chosen == "" == got[3].rejected and "bad" in got[1].rejected
    assert chat.preference_pairs(a.limit(0), b).count() == 0


# --- mixing


def test_mixing(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), f"s{rng.choice([0] * 8 + [1, 2])}") for i in range(3000)]
    rows += [(5000, "only words here", "tiny"), (5001, None, "none"), (5002, "x y", None), (7, "a b", "s0"), (7, "a b", "s0")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    got = mixing.mix(df).collect()
    again = mixing.mix(df.repartition(7)).collect()
    key = lambda r: (r.doc.doc_id, r.size, r.copies)
    assert sorted(map(key, got)) == sorted(map(key, again)) and len(got) == len(rows)
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        s = r.doc.source
        assert r.size == len(WORDS.findall(r.doc.text or "")) and r.copies <= 3
        size[s] += r.size
        taken[s] += r.size * r.copies
        target[s] = r.target
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    order = sorted([s for s in size if s is not None]) + [None]
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    open_ = set(order)
    want, left = {}, float(sum(size.values()))
    while True:  # water-filling, one source after another
        over = [s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 3 * size[s]]
        if not over:
            break
        for s in over:
            want[s] = 3.0 * size[s]
            open_.discard(s)
        left = sum(size.values()) - sum(want.values())
    for s in open_:
        want[s] = left * weight[s] / sum(weight[x] for x in open_)
    for s in order:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= 40
    assert mixing.mixed_rows(df).columns == df.columns
    assert mixing.mix(df.limit(0)).count() == 0


# --- secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32])


def test_secrets_match_regexes(spark):
    rng = random.Random(6)
    parts = ["password", "Token", "api_key", "APIKEY", "secret", "=", ":", " ", '"', "'", "abc", "deadbeef", "0123456789abcdef", "AKIA", "ABCD1234", "\n", ",", "é", "token = x/token = longvalue12", ".", "-"]
    texts = EDGES + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    names = [r.kind for r in secrets.RULES]
    got = {r.doc_id: r for r in secrets.scan_secrets(docs(spark, texts).withColumn("spans", F.lit(1))).collect()}
    for i, t in enumerate(texts):
        want = base_spans(t or "")
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(k == j for _, k, _ in want) for j in range(3)]
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{names[k]}:{a}:{b}" for a, k, b in want).encode()).hexdigest()
    assert secrets.scan_secrets(docs(spark, ["a"]).limit(0)).count() == 0


def test_added_rules(spark):
    r = secrets.scan_secrets(docs(spark, ["x ghp_" + "A1" * 18 + " -----BEGIN RSA PRIVATE KEY-----"])).first()
    assert r.spans == "hosting:2:42,private:43:74" and r.base_sha256 == hashlib.sha256(b"").hexdigest()


def test_added_rules_match_regexes(spark):
    rng = random.Random(7)
    parts = ["ghp_", "gho_", "A1b2" * 9, "zz", "xoxb-", "-1234567890", "eyJ", "eyJh", ".", "_", "-----BEGIN", " RSA ", "PRIVATE KEY-----", "-----", "\n", " ", "é", "/"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    shapes = {"hosting": "gh[opsu]_[A-Za-z0-9]{36}", "chat": "xox[abprs]-[0-9A-Za-z-]+", "webtoken": r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", "private": "-----BEGIN[ A-Z]*PRIVATE KEY-----"}
    for t, r in zip(texts, secrets.find_spans(pa.array(texts)), strict=True):
        for kind, shape in shapes.items():
            want = [(m.start(), m.end()) for m in re.finditer(shape, t) if kind != "chat" or len(m[0]) >= 15]
            assert [(a, b) for a, k, b in r if secrets.RULES[k].kind == kind] == want, (t, kind)


def test_long_texts_of_false_starts_take_linear_time():
    import time

    for text in ("eyJ" * 350_000 + ".eyJ", "token" * 200_000, "token = " * 120_000, "AKIA" * 250_000, "-----BEGIN " * 90_000, "ghp_" * 250_000, "0" * 1_000_000):
        began = time.perf_counter()
        secrets.find_spans(pa.array([text]))
        assert time.perf_counter() - began < 15, text[:20]


def test_shortest_match_is_known():
    assert secrets.Scanner().shortest == len("eyJx.eyJx.x")
    assert secrets.Scanner(secrets.BASE).shortest == len("token=12345678")
    short = secrets.Scanner((secrets.Rule("pin", "PIN", "[0-9]", 2),))
    data = np.frombuffer(b"x PIN12 PIN1 yPIN3", np.uint8)
    assert short.shortest == 5 and short.spans(data, np.array([0, 16, len(data)])) == [(2, 0, 7)]


# --- preference formatting against its SQL, with nulls and repeated turns


def test_preference_query_matches_sql_with_nulls(spark, tmp_path):
    rng = random.Random(5)
    rows = [(c, rng.choice([None, 0, 1, 1, 2]), rng.choice([None, "", "user", "assistant"]), rng.choice([None, "", "a", "b"])) for c in [None, *range(30)] for _ in range(rng.randint(1, 5))]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    duck = duckdb.connect()
    duck.sql(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    got = chat.op8_preference_pairs(spark, str(tmp_path))
    want = duck.sql(chat.ORACLE["op8_preference_pairs"])
    assert got.columns == want.columns
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())


def test_toxicity_learns_once_from_a_repeated_id(spark):
    texts = [f"vile filth {i}" if i % 2 else f"kind words {i}" for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    once = toxicity.train(docs(spark, texts), labels)
    again = toxicity.train(docs(spark, texts + [texts[7]] * 200, [*range(60), *[7] * 200]), labels)
    assert np.array_equal(once.buckets, again.buckets) and np.allclose(once.weights, again.weights) and once.intercept == again.intercept

"""The Merkle manifest, the prefix trie and the decontamination against brute force and edge cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from crosslane.llm import decontamination, merkle, prefix_trie


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- Merkle manifest


def up(level, fanout):
    return [sha("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]


def plain_manifest(rows, fanout):
    """(tree, id, leaf) to {(tree, place): (leaf, subroot, root, siblings)} by whole levels."""
    trees = defaultdict(list)
    for tree, i, leaf in rows:
        trees[tree].append((i is not None, i, leaf))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    ways, roots = {}, []
    for tree in names:
        level = [x[2] for x in sorted(trees[tree], key=lambda x: (x[0], x[1] or 0, x[2]))]
        at = list(range(len(level)))
        own = [[leaf, []] for leaf in level]
        while len(level) > 1:
            for k, p in enumerate(at):
                first = p - p % fanout
                own[k][1].append(("".join(level[first:p]), "".join(level[p + 1 : first + fanout])))
                at[k] = p // fanout
            level = up(level, fanout)
        roots.append(level[0])
        ways[tree] = own
    tops = [[r, []] for r in roots]
    level, at = roots, list(range(len(roots)))
    while len(level) > 1:
        for k, p in enumerate(at):
            first = p - p % fanout
            tops[k][1].append(("".join(level[first:p]), "".join(level[p + 1 : first + fanout])))
            at[k] = p // fanout
        level = up(level, fanout)
    out = []
    for tree, (subroot, last) in zip(names, tops, strict=True):
        out += [(leaf, subroot, level[0], way + last) for leaf, way in ways[tree]]
    return out


@pytest.mark.parametrize(("fanout", "sizes"), [(2, [1]), (2, [9, 1, 4, 17]), (3, [30, 5, 1, 2, 9]), (2, [64])])
def test_manifest_matches_whole_levels(spark, monkeypatch, fanout, sizes):
    monkeypatch.setattr(merkle, "LEAST_LEAVES", 4)  # so that trees have many blocks, which swap over several rounds
    monkeypatch.setattr(merkle, "MOST_LEAVES", 4)
    names = [None, "", "de", "é", "zz"]
    rows = [(names[t], i if i % 5 else (i or None), sha(f"{t}:{i}")) for t, n in enumerate(sizes) for i in range(n)]
    rows += [(names[0], 2, sha("again"))]  # an id that repeats
    random.Random(5).shuffle(rows)
    want = sorted(plain_manifest(rows, fanout))
    df = spark.createDataFrame([(*r, sha("lie") if r[1] == 1 else r[2]) for r in rows], "tree string, id long, leaf string, claim string")
    got = merkle.manifest(df, fanout).collect()
    assert sorted((r.leaf, r.subroot, r.root, [(s.before, s.after) for s in r.steps]) for r in got) == want
    for r in got:
        assert r.proof_sha256 == sha("".join(s.before + s.after for s in r.steps))
        assert (r.folded_root == r.root) == (r.id != 1)


def test_manifest_leaf_and_edges(spark):
    row = spark.createDataFrame([(None, "é", 3)], "a long, b string, c long").select(merkle.leaf_digest(F.col("a"), F.col("b"), F.col("c"))).first()[0]
    assert row == sha("-2:é1:3")
    df = spark.createDataFrame([], "tree string, id long, leaf string, claim string")
    assert merkle.manifest(df).collect() == []
    odd = spark.createDataFrame([("x", 1, sha("a"), sha("a"), "own")], "tree string, id long, leaf string, claim string, place string")
    (r,) = merkle.manifest(odd).collect()
    assert r.root == r.subroot == r.leaf == r.folded_root and r.steps == [] and r.proof_sha256 == sha("")


# --- prefix trie


def plain_trie(rows, base=20):
    talks = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            talks[c].append((turn is not None, turn or 0, role or "", text or ""))
    talks = {c: [x[2:] for x in sorted(v)] for c, v in talks.items()}
    built = {c: talks.get(c - (abs(c) % base) * (1 if c >= 0 else -1), [])[: zlib.crc32(str(c).encode()) % 4] + own[zlib.crc32(str(c).encode()) % 4 :] for c, own in talks.items()}
    members = defaultdict(list)
    for c, turns in sorted(built.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, own in members.items():
        under = [n for n in members if n[: len(node)] == node]
        childless = [n for n in under if not any(len(x) == len(n) + 1 and x[:-1] == n for x in members)]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in under if n)
        ends = ",".join(str(c) for c in own if len(built[c]) == len(node))
        out.append((own[0], len(node), members[node[:-1]][0] if node else None, len(own), sum(len(x) == len(node) + 1 for x in under), len(childless), saved, sha(ends)))
    return sorted(out, key=str)


def random_talks(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in range(-25, n):
        if c % 3 == 2 and c > 30:
            continue
        for turn in range(rng.choice([1, 1, 2, 3, 4, 7])):
            rows.append((c, turn if rng.random() < 0.95 else None, rng.choice(["user", None, ""]), rng.choice(["hi there", "a b\tc", "", None, "é x"])))
    rows += [(None, 0, "user", "no conversation"), rows[0], (3, 0, "user", "w " * 3000)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_matches_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(prefix_trie, "PIECE", 3)  # so that end lists have several pieces
    rows = random_talks(seed, 130)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit("clash")).withColumn("p1", F.lit(1)).withColumn("conv", F.lit(2))
    got = [tuple(r) for r in prefix_trie.trie(df).collect()]
    assert sorted(got, key=str) == plain_trie(rows)


def test_trie_of_a_long_and_a_common_conversation(spark):
    """A conversation with a third of all turns, and one sequence that most conversations are."""
    rows = [(0, t, "user", f"turn {t}") for t in range(90)] + [(c, t, "user", f"turn {t}") for c in range(1, 60) for t in range(3)] + [(500, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted((tuple(r) for r in prefix_trie.trie(df).collect()), key=str) == plain_trie(rows)


def test_trie_edges(spark):
    kind = "conv_id long, turn long, role string, text string"
    assert prefix_trie.trie(spark.createDataFrame([], kind)).collect() == []
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "user", "x")], kind)).collect() == []
    lone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 1)  # its base is absent, and its only turn is left out
    assert [tuple(r) for r in prefix_trie.trie(spark.createDataFrame([(lone, 1, "user", "x")], kind)).collect()] == [(lone, 0, None, 1, 0, 1, 0, sha(str(lone)))]


# --- benchmark decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_decontamination(docs, items):
    words = lambda t: WORD.findall((t or "").translate(LOWER))
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        for at in range(max(1, len(w) - 9)):
            if w:
                windows[tuple(w[at : at + 10])].add(i)
    out = []
    for d, t in docs:
        w, hit, own = words(t), set(), set()
        for at in range(len(w)):
            for m in range(1, 11):
                if at + m <= len(w) and tuple(w[at : at + m]) in windows:
                    hit |= set(range(at, at + m))
                    own |= windows[tuple(w[at : at + m])]
        listed = sorted(str(i) for i in own if i is not None)
        out.append((d, len(w), len(hit), len(listed), sha(",".join(listed)), bool(hit)))
    return sorted(out, key=str)


def digested(df):
    rows = df.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256), "contaminated").collect()
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("most", [200_000, 0])
def test_decontamination_matches_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(decontamination, "MOST_ROWS", most)  # with 0, every join is a shuffle
    rng = random.Random(3)
    say = lambda n: " ".join(rng.choice(["the", "the", "of", "É", "é", "Cat", "x1", "zebra", "b-c", "日本"]) for _ in range(n))
    items = [(i, say(rng.choice([1, 2, 3, 9, 10, 11, 25]) + (i < 12) * 8)) for i in range(30)] + [(2, "the the the the the the the the the the the the"), (3, None), (4, " .,"), (None, "q r s t u v w x y z"), (5, "only here and nowhere else at all in any of these")]
    texts = [None, "", " - ", "the", say(400), "q R s\tt u v. w x y z", "the " * 3000, "a" * 5000]
    for _ in range(40):
        cut = (rng.choice(items)[1] or "").split()
        texts.append(" ".join([say(rng.randint(0, 20)), *cut[rng.randint(0, 2) :], say(rng.randint(0, 12))]))
    docs = [(i if i % 7 else None, t) for i, t in enumerate(texts)] + [(1, texts[20]), (1, texts[20]), (1, "clean words")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("words", F.lit("clash")).withColumn("token", F.lit(0))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("wid", F.lit("clash"))
    assert digested(decontamination.decontaminate(d, b)) == plain_decontamination(docs, items)


def test_decontamination_edges(spark):
    d = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert digested(decontamination.decontaminate(d, none)) == plain_decontamination([(1, "some text"), (2, None)], [])
    assert decontamination.decontaminate(d.limit(0), none).collect() == []
    one = spark.createDataFrame([(9, "TEXT")], "item_id long, text string")
    assert digested(decontamination.decontaminate(d, one)) == plain_decontamination([(1, "some text"), (2, None)], [(9, "TEXT")])


def test_decontamination_runs_no_python(spark):
    d = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    plan = decontamination.decontaminate(d, spark.createDataFrame([(9, "text")], "item_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowEval", "Arrow")

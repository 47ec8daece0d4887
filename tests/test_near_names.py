import random

import pytest
from pyspark.sql import functions as F

from crosslane.functions import molecules


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, word, letters):
    word = list(word)
    for _ in range(rng.randint(0, 3)):
        at = rng.randrange(1, len(word) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            word.insert(at, rng.choice(letters))
        elif at < len(word):
            word[at : at + 1] = [] if kind == 1 else [rng.choice(letters)]
    return "".join(word)


@pytest.mark.parametrize(("lengths", "letters"), [((1, 9), "abc"), ((8, 14), "abcdé👍"), ((20, 30), "ab"), ((25, 90), "abcdefgh")])
def test_pairs_are_those_of_brute_force(spark, lengths, letters):
    rng = random.Random(sum(lengths))
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(*lengths))) for _ in range(60)]
    names = [edited(rng, w, letters) for w in words for _ in range(3)] + ["", None, words[0]]
    frame = lambda rows: spark.createDataFrame([(x,) for x in rows], "name string")
    got = sorted(tuple(r) for r in molecules.near_pairs(frame(names), frame([*words, None, ""])).collect())
    assert got == sorted((a, b, distance(a, b)) for a in {x for x in names if x} for b in set(words) if a[0] == b[0] and distance(a, b) <= 2)


def test_many_names_meet_many_words_by_keys(spark):
    """10^5 names and 10^5 words, nearly all with one first character and one length: what is compared is what shares a key."""
    hashed = lambda c: F.concat(F.lit("q"), F.substring(F.translate(F.sha2(c.cast("string"), 256), "0123456789", "ghijklmnop"), 1, 11))
    words = spark.range(100_000).select(hashed(F.col("id")).alias("name"))
    names = spark.range(100_000).select(F.when(F.col("id") % 1000 == 0, F.overlay(hashed(F.col("id")), F.lit("zz"), F.lit(5), F.lit(2))).otherwise(hashed(F.col("id") + 500_000)).alias("name"))
    got = molecules.near_pairs(names, words)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    rows = got.collect()
    assert len(rows) >= 100 and all(distance(r.name, r.word) == r.distance <= 2 for r in rows)

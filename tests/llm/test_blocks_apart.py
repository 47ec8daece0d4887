"""Texts that have a passage in common aren't put into a block together, even where the sketch knows nothing of frequencies."""

import numpy as np
from crosslane.llm import jaccard_join as jj
from crosslane.llm.work import ship, written


def test_a_common_passage_makes_no_block(spark, monkeypatch):
    ship(spark)
    words = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n))
    passage = words("p", 120)
    rows = [(k, f"{words(k, 300)} {passage}") for k in range(40)] + [(40, words("y", 300)), (41, words("y", 300) + " one more")]
    blocks = {}

    def seen(df, name):
        out = written(df, name)
        if name == "wanted":
            blocks["sets"] = out.count()
        return out

    monkeypatch.setattr(jj, "written", seen)
    monkeypatch.setattr(jj, "_levels", lambda pieces: np.zeros((jj.ROWS, jj.CELLS), np.uint8))
    out = {r["doc_id"]: r["component_id"] for r in jj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {**{k: k for k in range(41)}, 41: 40}
    assert blocks["sets"] == 2


def test_what_is_kept_back_again_is_never_more_than_the_least_overlap():
    n = np.arange(1, 5000)
    for num, den in ((85, 100), (1, 2), (1, 5), (1, 1)):
        kept = jj.kept_again(n, num, den)
        assert (kept >= 1).all() and (kept <= np.maximum(1, -(-n * num // den))).all() and (np.diff(kept) >= 0).all()

"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

A window of an item occurs in a document only if all of its shingles do, so its rarest one is a sufficient
prefix to join on. Shingles of the benchmark are ordered by how often the corpus has them; a document's
shingles meet the rarest ones; the place of a shingle in its window tells where the window would begin, which has
to lie inside the document; there the words themselves are compared.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .work import spread, written

#: Words of a window of an item; words of a shingle (items of fewer words have shingles of their own length).
WINDOW, SHINGLE = 10, 3
#: Most rows, and most bytes of their strings, of what is broadcast; more is met by a shuffle.
MOST_ROWS, MOST_BYTES = 200_000, 64 << 20
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased: runs of letters and digits of ASCII and of all other characters; none for null."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _NOT_WORD), "")


def windows_of(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, window, wid): every window of every item; an item of fewer words is one window, one without words has none.
    ``wid`` is the digest of the window's words: equal windows, equal wid."""
    items = benchmark.select(F.col(f"`{id_col}`").alias("item"), words_of(F.col(f"`{text_col}`")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    each = items.select("item", "words", F.explode(starts).alias("at")).select("item", F.slice("words", F.col("at"), F.lit(window)).alias("window"))
    return each.withColumn("wid", F.sha2(F.array_join("window", " "), 256))


def _shingle(words: str, first: Column, at: Column, width: int) -> Column:
    return F.xxhash64(first, *[F.get(words, at + k) for k in range(1, width)])


def _shingles(rows: DataFrame, keep: list[str], words: str, width: int) -> DataFrame:
    """``keep``, at (from 0) and token of every shingle of ``width`` words; compiled row by row, without a function on arrays."""
    each = rows.select(*keep, F.posexplode(words).alias("at", "word")) if words in keep else rows.select(*keep, words, F.posexplode(words).alias("at", "word"))
    return each.where(F.col("at") <= F.size(words) - width).select(*keep, "at", _shingle(words, F.col("word"), F.col("at"), width).alias("token"))


def _small(table: DataFrame) -> bool:
    """Whether a written table is small enough to be broadcast, by its rows and the bytes of its strings."""
    texts = [F.array_join(c, "") if t == "array<string>" else F.col(c) for c, t in table.dtypes if t in ("string", "array<string>")]
    told = table.agg(F.count("*").alias("n"), F.sum(reduce(Column.__add__, [F.coalesce(F.octet_length(x), F.lit(0)).cast("long") for x in texts], F.lit(0))).alias("b")).first()
    return told["n"] <= MOST_ROWS and (told["b"] or 0) <= MOST_BYTES


def _met(rows: DataFrame, other: DataFrame, key: str, small: bool) -> DataFrame:
    """Inner join with a table that is broadcast when it is small; else both are shuffled, and a token with many rows is
    split where Spark finds its partition to be skewed."""
    return rows.join(F.broadcast(other) if small else other, key)


def prefixes(docs: DataFrame, windows: DataFrame, width: int) -> DataFrame:
    """(token, wid, offset, window): the shingle of each distinct window that the fewest shingles of ``docs`` equal, the first of
    such. Windows with a shingle that no document has are left out."""
    own = written(_shingles(windows, ["wid", "window"], "window", width), "shingles")
    asked = written(own.select("token").distinct(), "tokens")
    counts = written(_met(_shingles(docs, [], "words", width), asked, "token", _small(asked)).groupBy("token").agg(F.count("*").alias("n")), "rarity")
    ranked = own.join(counts, "token", "left").groupBy("wid").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("at").alias("offset"), "token")).alias("p"), F.first("window").alias("window")
    )
    return written(ranked.where("p.n > 0").select("p.token", "wid", "p.offset", "window"), "prefixes")


def occurrences(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(key, start, end, wid): where distinct ``windows`` (wid, window) occur in the words of ``docs`` (key, words), end exclusive."""
    length = F.least(F.size("window"), F.lit(SHINGLE))
    widths = sorted(r[0] for r in windows.select(length).distinct().collect())  # SHINGLE values at most
    found = []
    for width in widths:
        chosen = prefixes(docs, windows.where(length == width), width)
        start, size = F.col("at") - F.col("offset"), F.size("window")
        if _small(chosen):
            near = _met(_shingles(docs, ["key", "words"], "words", width), chosen, "token", True).where((start >= 0) & (start + size <= F.size("words")))
        else:  # texts stay where they are until the tokens have met
            near = _met(_shingles(docs, ["key"], "words", width), chosen, "token", False).where(start >= 0).join(docs.select("key", "words"), "key").where(start + size <= F.size("words"))
        exact = near.where(F.slice("words", start + 1, size) == F.col("window"))
        found.append(exact.select("key", start.alias("start"), (start + size).alias("end"), "wid"))
    return reduce(DataFrame.unionAll, found) if found else docs.select("key", F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("").alias("wid")).where("false")


def _covered(spans: Column) -> Column:
    """Number of places in sorted (start, end) spans, which may overlap."""

    def step(acc: Column, s: Column) -> Column:
        return F.struct(F.greatest(acc["upto"], s["end"]).alias("upto"), (acc["n"] + F.greatest(s["end"] - F.greatest(acc["upto"], s["start"]), F.lit(0))).alias("n"))

    return F.aggregate(spans, F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")), step, lambda a: a["n"]).cast("long")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row for each row of ``docs``: its id, n_words, n_hit (words inside an occurrence of a window), n_items and items (the ids of
    items with an occurring window, as strings in order) and contaminated.

    Null texts have no words and are clean, as is everything where the benchmark is empty. Rows that repeat an id are judged
    each by itself, null ids too. Items that repeat an id are one item; an item without an id hits words but isn't counted or
    listed. The spans and items of one document are gathered in one row; both are bounded by its words and the benchmark.
    """
    rows = spread(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")))
    words = written(rows.select("id", F.monotonically_increasing_id().alias("key"), words_of(F.col("text")).alias("words")).withColumn("n_words", F.size("words").cast("long")), "words")
    each = written(windows_of(benchmark, item_col, item_text_col, window), "windows")
    distinct = written(each.groupBy("wid").agg(F.first("window").alias("window")), "distinct")
    found = written(occurrences(words.select("key", "words"), distinct), "found")
    hits = found.groupBy("key").agg(_covered(F.sort_array(F.collect_set(F.struct("start", "end")))).alias("n_hit"))
    owners = written(each.select("wid", F.col("item").cast("string").alias("item")).where("item IS NOT NULL").distinct(), "owners")
    items = _met(found.select("key", "wid").distinct(), owners, "wid", _small(owners)).groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    none = F.array().cast("array<string>")
    return (
        words.select("id", "key", "n_words").join(hits, "key", "left").join(items, "key", "left")
        .select(F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                F.coalesce("items", none).alias("items"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))
    )


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate(docs, benchmark).select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = {
    "op13_decontaminate": f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
v AS (SELECT DISTINCT item_id, s.w AS win, CAST(len(s.w) AS BIGINT) AS m FROM (SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1), lambda i: list_slice(w, i, i + {WINDOW} - 1))) AS w FROM b WHERE len(w) > 0) s),
p AS (SELECT k, w, unnest(range(1, len(w) + 1)) AS i FROM d WHERE len(w) > 0),
g AS (SELECT p.k, p.i, z.m, list_slice(p.w, p.i, p.i + z.m - 1) AS win FROM p, (SELECT DISTINCT m FROM v) z WHERE p.i + z.m - 1 <= len(p.w)),
f AS (SELECT g.k, g.i, g.m, v.item_id FROM g JOIN v ON g.m = v.m AND g.win = v.win),
h AS (SELECT k, count(DISTINCT j) AS n_hit FROM (SELECT k, unnest(range(i, i + m)) AS j FROM f) GROUP BY k),
n AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS item FROM f WHERE item_id IS NOT NULL) GROUP BY k)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
       sha256(coalesce(n.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (k) LEFT JOIN n USING (k)
"""
}
QUERIES = {"op13_decontaminate": op13_decontaminate}

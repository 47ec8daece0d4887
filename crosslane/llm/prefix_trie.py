"""Trie of the turn prefixes of conversations, by collapsing whole sequences first.

Conversations with the same turns are one weighted sequence with the list of its ends. A sequence that is a proper prefix of
another one is found by an anti-join, the others are the leaves. Every prefix of every sequence is then a
weighted row; nodes are sums over these rows. A prefix is told by its length and two running sums of 64-bit hashes
of its turns and their places, so sums over pieces can be added and no conversation has to be in one task:
among n distinct prefixes a false match has a chance of about n^2 / 2^129.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .merkle import CRC_TABLE, crc32_sql
from .mixing import word_count
from .work import in_order, spread, with_group, written

#: Conversations in steps of BASE share the first turns of one; most of these turns; members of one piece of an end list.
BASE, HEADS, PIECE = 20, 4, 4096
#: What tells a prefix: its length and two sums.
NODE = ["depth", "p1", "p2"]
_WIDE = "decimal(38,0)"


def ordered_turns(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(conv, at, t1, t2, words): the turns of each conversation from 0 on, by turn (null first), then role and text. Null roles and
    texts are empty; rows without a conversation are left out. t1 and t2 are hashes of role and text."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("long").alias("conv"), "turn", role.alias("role"), text.alias("text"))
    ranked = in_order(rows, ["conv"], ["turn", "role", "text"])
    one = F.struct("role", "text")
    return ranked.select("conv", F.col("_rank").alias("at"), F.xxhash64(F.lit(1), one).alias("t1"), F.xxhash64(F.lit(2), one).alias("t2"), word_count(F.col("text")).alias("words"))


def rebuilt(turns: DataFrame, shared: Column | None = None, base: int = BASE) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv, n) and the turns (conv, depth, m1, m2, words) of the rebuilt ones, depth from 1: the first ``shared`` turns (a
    column of conv) of conversation conv - conv % base, all if it has fewer, then its own turns after as many of its own first.

    Each has at most HEADS - 1 shared turns, and fewer than 2 * base conversations share those of one.
    """
    shared = F.crc32(F.col("conv").cast("string")) % HEADS if shared is None else shared
    convs = written(turns.groupBy("conv").agg(F.count("*").alias("n")), "convs")
    asked = convs.select("conv", "n", shared.cast("int").alias("h"), (F.col("conv") - F.col("conv") % base).alias("from"))
    lengths = convs.select(F.col("conv").alias("from"), F.col("n").alias("there"))
    asked = written(asked.join(lengths, "from", "left").withColumn("taken", F.least(F.col("h"), F.coalesce("there", F.lit(0))).cast("long")), "asked")
    heads = turns.where(F.col("at") < HEADS - 1).withColumnRenamed("conv", "from")
    first = asked.where("taken > 0").select("conv", "from", "taken").join(heads, "from").where(F.col("at") < F.col("taken"))
    total = asked.agg(F.sum("n")).first()[0] or 0
    own = with_group(turns, asked.select("conv", "n", "h", "taken"), ["conv"], "n", total).where(F.col("at") >= F.col("h")).withColumn("at", F.col("at") - F.col("h") + F.col("taken"))
    both = first.select("conv", "at", "t1", "t2", "words").unionByName(own.select("conv", "at", "t1", "t2", "words"))
    depth = (F.col("at") + 1).alias("depth")
    place = lambda c: F.xxhash64("at", "t1", "t2", F.lit(c)).cast(_WIDE).alias(f"m{c}")
    return convs, written(both.select("conv", depth, place(1), place(2), "words"), "rebuilt")


def whole_sequences(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """(conv, depth, p1, p2, words): the whole sequence of each conversation; of one without turns it is the empty one."""
    none = F.lit(0).cast(_WIDE)
    sums = rows.groupBy("conv").agg(F.count("*").alias("depth"), F.sum("m1").cast(_WIDE).alias("p1"), F.sum("m2").cast(_WIDE).alias("p2"), F.sum("words").alias("words"))
    whole = convs.select("conv").join(sums, "conv", "left").select(
        "conv", F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), F.coalesce("p1", none).alias("p1"), F.coalesce("p2", none).alias("p2"), F.coalesce("words", F.lit(0)).cast("long").alias("words")
    )
    return written(whole, "whole")


def end_lists(whole: DataFrame) -> DataFrame:
    """(depth, p1, p2, ends_sha256): digest of the conversations that end with each sequence, ascending, as decimals with commas.

    Members are ranked and joined in pieces; a digest has to be taken in one order, so one task reads the pieces of a sequence as
    a stream, some dozen bytes for each PIECE members in a row, and holds its state only.
    """
    ranked = in_order(whole.select(*NODE, "conv"), NODE, ["conv"])
    pieces = ranked.groupBy(*NODE, F.floor(F.col("_rank") / PIECE).alias("piece")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for *key, piece, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if piece == 0:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield rows_of(done)
        if node is not None:
            yield rows_of([(*node, state.hexdigest())])

    def rows_of(done: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.decimal128(38, 0), pa.decimal128(38, 0), pa.string()]
        cols = list(zip(*done, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[*NODE, "ends_sha256"])

    dealt = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece").select(*NODE, "piece", "ids")
    return dealt.mapInArrow(run, f"depth long, p1 {_WIDE}, p2 {_WIDE}, ends_sha256 string")


def trie(turns: DataFrame, id_col: str = "conv_id", shared: Column | None = None, base: int = BASE) -> DataFrame:
    """One row for each distinct prefix (role and text of each turn) of the rebuilt conversations of ``turns`` (id, turn, role, text), the
    empty one included: conv_id (its smallest conversation), depth, parent_conv_id (of the prefix without its last turn), n_convs,
    n_children, n_leaves (prefixes without children that begin with it), saved_tokens (over the prefixes that begin with it: conversations less one, times the
    words of the last turn) and ends_sha256 (of the conversations that are this prefix).

    A table without conversations has no rows. See ordered_turns for nulls, ties and repeated rows, and rebuilt for the conversations.
    """
    ordered = written(ordered_turns(turns, id_col), "turns")
    convs, rows = rebuilt(ordered, shared, base)
    whole = whole_sequences(convs, rows)
    collapsed = written(whole.groupBy(*NODE).agg(F.count("*").alias("weight"), F.min("conv").alias("conv"), F.first("words").alias("total")), "sequences")
    # Of equal conversations the first stands for all.
    groups = collapsed.select("conv", "weight", "total", F.col("depth").alias("size"))
    count = rows.count()
    chosen = with_group(rows, groups, ["conv"], "size", count).where(F.col("weight").isNotNull())
    running = in_order(chosen.select("conv", "depth", "m1", "m2", "words", "weight", "total", "size"), ["conv"], ["depth"], {"p1": "m1", "p2": "m2", "upto": "words"})
    wide = lambda c: F.col(c).cast(_WIDE)
    # after: words of the sequence from this turn on.
    turns_of = running.select("conv", "depth", wide("p1").alias("p1"), wide("p2").alias("p2"), (wide("p1") - wide("m1")).cast(_WIDE).alias("q1"), (wide("p2") - wide("m2")).cast(_WIDE).alias("q2"), "weight", "size", (F.col("total") - F.col("upto") + F.col("words")).alias("after"))
    zero = F.lit(0).cast(_WIDE)
    top = collapsed.select("conv", F.lit(0).cast("long").alias("depth"), zero.alias("p1"), zero.alias("p2"), zero.alias("q1"), zero.alias("q2"), "weight", F.col("depth").alias("size"), F.col("total").alias("after"))
    prefixes = written(turns_of.unionByName(top), "prefixes")
    # The sequence of a node's smallest conversation owns it; what a sequence owns is all of it from some turn on.
    nodes = prefixes.groupBy(*NODE).agg(F.min(F.struct("conv", "after")).alias("first"))
    owned = nodes.groupBy("first.conv").agg(F.min("depth").alias("own_from"), F.max("first.after").alias("own_words"))
    proper = prefixes.where(F.col("depth") < F.col("size")).select(*NODE).distinct()
    leaves = collapsed.select(*NODE, "conv").join(proper, NODE, "left_anti").select("conv", F.lit(1).alias("leaf"))
    told = collapsed.select("conv", (F.col("depth") + 1).alias("size")).join(owned, "conv", "left").join(leaves, "conv", "left")
    marked = with_group(prefixes.drop("size"), written(told, "told"), ["conv"], "size", count)
    once = F.when(F.col("depth") >= F.col("own_from"), F.col("after")).otherwise(F.coalesce("own_words", F.lit(0)))
    found = marked.groupBy(*NODE).agg(
        F.min("conv").alias("conv_id"), F.first("q1").alias("q1"), F.first("q2").alias("q2"), F.sum("weight").alias("n_convs"),
        F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"), F.sum(F.col("weight") * F.col("after") - once).alias("saved_tokens"),
    )
    found = written(found, "nodes")
    up = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")]
    kids = written(found.where("depth > 0").select(*up).groupBy(*NODE).agg(F.count("*").alias("n_children")), "children")
    nodes = found.join(kids, NODE, "left").join(end_lists(whole), NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = written(nodes, "told")
    parents = nodes.where("n_children > 0").select(F.col("depth").alias("d"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("_kids"))
    below = with_group(nodes.withColumn("d", F.col("depth") - 1), written(parents, "parents"), ["d", "q1", "q2"], "_kids", nodes.count())
    return below.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("n_leaves").cast("long").alias("n_leaves"), F.col("saved_tokens").cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(spread(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")))


ORACLE = {
    "op12_prefix_trie": f"""
WITH {CRC_TABLE},
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % {BASE} AS b, {crc32_sql('conv_id')} % {HEADS} AS h FROM (SELECT DISTINCT conv_id FROM t), crc),
s AS (SELECT c.conv_id, 0 AS own, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.b AND t.i < c.h
      UNION ALL SELECT c.conv_id, 1, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i >= c.h),
u AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, i) AS d, strlen(role) || ':' || role || strlen(text) || ':' || text AS k,
             len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM s),
p AS (SELECT conv_id, d, string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY d) AS node,
             coalesce(string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS prev, words FROM u
      UNION ALL SELECT conv_id, 0, '', '', 0 FROM c),
m AS (SELECT conv_id, max(d) AS n FROM p GROUP BY conv_id),
node AS (SELECT p.d, p.node, any_value(p.prev) AS prev, min(p.conv_id) AS conv_id, count(*) AS n_convs, any_value(p.words) AS words,
                coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (WHERE m.n = p.d), '') AS ends FROM p JOIN m USING (conv_id) GROUP BY p.d, p.node),
kids AS (SELECT d - 1 AS d, prev AS node, count(*) AS n FROM node WHERE d > 0 GROUP BY d, prev),
below AS (SELECT DISTINCT a.d AS ad, a.node AS an, b.d, b.node FROM p a JOIN p b ON a.conv_id = b.conv_id AND a.d <= b.d),
sums AS (SELECT b.ad AS d, b.an AS node, sum((n.n_convs - 1) * n.words) AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves
         FROM below b JOIN node n ON n.d = b.d AND n.node = b.node LEFT JOIN kids k ON k.d = b.d AND k.node = b.node GROUP BY b.ad, b.an)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM node n JOIN sums s ON s.d = n.d AND s.node = n.node LEFT JOIN kids k ON k.d = n.d AND k.node = n.node
     LEFT JOIN node up ON n.d > 0 AND up.d = n.d - 1 AND up.node = n.prev
"""
}
QUERIES = {"op12_prefix_trie": op12_prefix_trie}

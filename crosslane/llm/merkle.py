"""Merkle manifest of a dataset by a butterfly exchange.

Leaves of a tree are dealt to aligned blocks of a power of ``fanout`` leaves, so every block is a whole subtree. In round r
the blocks whose numbers differ in digit r alone (fanout of them) swap the roots of their subtrees, and each of them
hashes the ancestor for itself. After the last round every block has the root and the upper part of
its leaves' proofs, so nothing is sent down the tree again. The roots of the trees are put together the same way.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .work import HOT_SHARE, in_order, spread, written

#: Children of a node.
FANOUT = 2
#: Leaves of a block: at least the first, at most the second, and more than the first only for over BLOCKS blocks.
LEAST_LEAVES, MOST_LEAVES, BLOCKS = 1 << 10, 1 << 16, 1 << 12
#: Rounds after which the state of the exchange is written.
ROUNDS_WRITTEN = 8
_STEPS = "array<struct<before:string,after:string>>"


def leaf_digest(*fields: Column) -> Column:
    """Lower-case hex SHA-256 of the fields: `-` for null, else UTF-8 bytes of the value, `:` and the value."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def exchange(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(tree, place, steps, top) for the nodes (tree, place, root) of a tree, whose places are 0, 1, ... without a gap.

    ``steps`` has the siblings on the way from the node to the top, level by level: those before it and those after it. A
    tree's last group of blocks may be smaller: blocks without leaves fill it up to a power of fanout and swap no root.
    """
    sizes = nodes.groupBy("tree").agg(F.count("*").alias("_size"))
    rounds = reduce(Column.__add__, [F.when(F.col("_size") > fanout**r, 1).otherwise(0) for r in range(62) if fanout**r < 1 << 62])
    sizes = written(sizes.withColumn("_rounds", rounds), "sizes")
    most = sizes.agg(F.max("_rounds")).first()[0] or 0
    full = reduce(lambda x, r: F.when(F.col("_rounds") == r, F.lit(fanout**r)).otherwise(x), range(1, most + 1), F.lit(1)).cast("long")
    empty = sizes.withColumn("_full", full).where("_full > _size").select("tree", F.explode(F.sequence(F.col("_size"), F.col("_full") - 1)).alias("place"), F.lit(None).cast("string").alias("top"))
    state = nodes.select("tree", "place", F.col("root").alias("top")).unionByName(empty).withColumn("steps", F.array().cast(_STEPS))
    state = state.join(sizes, "tree")
    for r in range(most):
        digit = F.floor(F.col("place") / F.lit(fanout**r)) % fanout
        group = Window.partitionBy("tree", F.col("place") - digit * fanout**r)
        met = state.withColumn("_digit", digit).withColumn("_group", F.sort_array(F.collect_list(F.struct(F.col("_digit").alias("digit"), F.coalesce("top", F.lit("")).alias("root"))).over(group)))
        part = lambda keep: F.array_join(F.transform(F.filter("_group", keep), lambda p: p["root"]), "")
        step = F.struct(part(lambda p: p["digit"] < F.col("_digit")).alias("before"), part(lambda p: p["digit"] > F.col("_digit")).alias("after"))
        joined = F.array_join(F.transform("_group", lambda p: p["root"]), "")
        live = F.col("_rounds") > r
        state = met.select(
            "tree", "place", "_size", "_rounds", F.when(live, F.concat("steps", F.array(step))).otherwise(F.col("steps")).alias("steps"),
            F.when(~live, F.col("top")).when(joined != "", F.sha2(joined, 256)).alias("top"),
        )
        if r % ROUNDS_WRITTEN == ROUNDS_WRITTEN - 1:
            state = written(state, "exchange")
    return state.where(F.col("place") < F.col("_size")).select("tree", "place", "steps", "top")


def _sha(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


def levels(leaves: list[str], fanout: int, most: int | None) -> list[list[str]]:
    """The levels of a subtree from the leaves up: ``most`` steps, or up to one node."""
    found = [leaves]
    while len(found[-1]) > 1 if most is None else len(found) <= most:
        below = found[-1]
        found.append([_sha("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return found


def block_leaves(leaves: int, fanout: int) -> int:
    """Steps of a block: it has fanout to this power of leaves."""
    height = 1
    while fanout**height < LEAST_LEAVES or fanout ** (height + 1) <= MOST_LEAVES and leaves > fanout**height * BLOCKS:
        height += 1
    return height


def manifest(leaves: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """One row for each of ``leaves`` (tree, id, leaf, claim): id, leaf, subroot (of its tree), root (of all), steps (the siblings
    on the way to the root, before and after it), proof_sha256 (of the siblings, one after another) and folded_root (the root that
    ``claim`` gives with these siblings).

    A tree's leaves ascend by id (null first), then by leaf, so rows that repeat an id have a fixed order. Null is a tree of its own and the
    first; others follow by the bytes of their name. While a level has several nodes, each ``fanout`` that follow one another
    become their digest, the last ones even if fewer. An empty table has no rows. A tree of any size is dealt to blocks.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col("tree").cast("string")), F.lit(""))
    ranked = written(in_order(leaves.select(tree.alias("tree"), "id", "leaf", "claim"), ["tree"], ["id", "leaf"]), "leaves")
    sizes = written(ranked.groupBy("tree").agg(F.count("*").alias("n")), "trees")
    height = block_leaves(sizes.agg(F.sum("n")).first()[0] or 0, fanout)
    size = fanout**height
    rows = ranked.withColumn("place", F.floor(F.col("_rank") / size))

    def own(table: pa.Table) -> pa.Table:
        """Root of one block, as part of a larger tree and as a tree of its own."""
        nodes = table.sort_by("_rank").column("leaf").to_pylist()
        inner, whole = levels(nodes, fanout, height)[-1][0], levels(nodes, fanout, None)[-1][0]
        return pa.table({"tree": table.column("tree")[:1], "place": table.column("place")[:1], "inner": [inner], "whole": [whole]})

    blocks = rows.select("tree", "place", "_rank", "leaf").groupBy("tree", "place").applyInArrow(own, "tree string, place long, inner string, whole string")
    blocks = written(blocks, "blocks").join(sizes, "tree")
    roots = blocks.select("tree", "place", F.when(F.col("n") > size, F.col("inner")).otherwise(F.col("whole")).alias("root"))
    upper = written(exchange(roots, fanout), "upper")
    tops = in_order(upper.where("place = 0").select(F.col("tree").alias("name"), F.col("top").alias("root"), F.lit("").alias("tree")), ["tree"], ["name"])
    tops = written(tops.withColumnRenamed("_rank", "place"), "tops")
    above = written(tops.select("name", "place").join(exchange(tops.select("tree", "place", "root"), fanout).withColumnRenamed("steps", "last").withColumnRenamed("top", "root"), "place"), "above")
    above = above.select(F.col("name").alias("tree"), "last", "root")
    # A tree with many blocks meets one row; those with the fewest share of blocks are left to a shuffle.
    few = above.limit(HOT_SHARE + 1).count() <= HOT_SHARE
    upper = upper.join(F.broadcast(above) if few else above, "tree").join(sizes, "tree")
    upper = upper.select("tree", "place", F.concat("steps", "last").alias("steps"), F.col("top").alias("subroot"), "root", (F.col("n") <= size).alias("alone"))

    def proofs(table: pa.Table, top: pa.Table) -> pa.Table:
        table = table.sort_by("_rank")
        found, claims = table.column("leaf").to_pylist(), table.column("claim").to_pylist()
        below = levels(found, fanout, None if top.column("alone")[0].as_py() else height)
        last = [(s["before"], s["after"]) for s in top.column("steps")[0].as_py()]
        steps, digests, folded = [], [], []
        for i, node in enumerate(claims):
            way = []
            for level in below[:-1]:
                first = i - i % fanout
                way.append(("".join(level[first:i]), "".join(level[i + 1 : first + fanout])))
                i //= fanout
            way += last
            for before, after in way:
                node = _sha(before + node + after)
            steps.append([{"before": b, "after": a} for b, a in way])
            digests.append(_sha("".join([x for pair in way for x in pair])))
            folded.append(node)
        n = len(found)
        made = {"id": table.column("id"), "leaf": table.column("leaf"), "subroot": [top.column("subroot")[0].as_py()] * n, "root": [top.column("root")[0].as_py()] * n}
        step = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
        return pa.table(made | {"steps": pa.array(steps, step), "proof_sha256": digests, "folded_root": folded})

    kind = leaves.schema["id"].dataType.simpleString()
    return rows.groupBy("tree", "place").cogroup(upper.groupBy("tree", "place")).applyInArrow(
        proofs, f"id {kind}, leaf string, subroot string, root string, steps {_STEPS}, proof_sha256 string, folded_root string"
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text"))
    changed = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    own = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text")]
    leaf = leaf_digest(*own)
    leaves = docs.select(F.col("lang").alias("tree"), F.col("doc_id").alias("id"), leaf.alias("leaf"), F.when(changed, leaf_digest(*tampered)).otherwise(leaf).alias("claim"))
    return manifest(leaves).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


#: A list of the 256 remainders of a byte, as table ``crc``, which the statement has to name beside the column's table.
CRC_TABLE = "crc AS (SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS bytes)"


def crc32_sql(col: str) -> str:
    """Unsigned CRC-32 of the decimal digits of an integer column, in DuckDB."""
    digits = f"list_transform(string_split(CAST({col} AS VARCHAR), ''), lambda ch: CAST(ord(ch) AS BIGINT))"
    return f"xor(4294967295, list_reduce(list_concat([4294967295], {digits}), lambda c, d: xor(c >> 8, crc.bytes[(xor(c, d) & 255) + 1])))"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


ORACLE = {
    "op11_merkle_manifest": f"""
WITH RECURSIVE {CRC_TABLE},
d AS (SELECT coalesce('=' || lang, '') AS tree, doc_id, {_leaf_sql('n_chars')} AS leaf,
             CASE WHEN doc_id IS NOT NULL AND {crc32_sql('doc_id')} % 7 = 0 THEN {_leaf_sql('(n_chars + 1)')} ELSE {_leaf_sql('n_chars')} END AS claim FROM documents, crc),
r AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY tree) AS n FROM d),
node AS (SELECT tree, 0 AS l, p, leaf AS h, n FROM r
         UNION ALL SELECT tree, l + 1, p // 2, sha256(string_agg(h, '' ORDER BY p)), (n + 1) // 2 FROM node WHERE n > 1 GROUP BY tree, l, p // 2, n),
sub AS (SELECT tree, l AS depth, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS q, count(*) OVER () AS m FROM node WHERE n = 1),
top AS (SELECT 0 AS l, q AS p, subroot AS h, m AS n FROM sub
        UNION ALL SELECT l + 1, p // 2, sha256(string_agg(h, '' ORDER BY p)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY l, p // 2, n),
whole AS (SELECT h AS root, l AS rise FROM top WHERE n = 1),
nodes AS (SELECT tree, l, p, h FROM node WHERE n > 1 UNION ALL SELECT s.tree, s.depth + t.l, t.p, t.h FROM sub s, top t WHERE t.n > 1),
way AS (SELECT r.tree, r.p AS at, 0 AS l, r.claim AS h, '' AS proof FROM r
        UNION ALL
        SELECT w.tree, w.at, w.l + 1, CASE WHEN y.p % 2 = 1 THEN sha256(coalesce(x.h, '') || w.h) ELSE sha256(w.h || coalesce(x.h, '')) END, w.proof || coalesce(x.h, '')
        FROM way w JOIN sub s ON s.tree = w.tree JOIN whole g ON w.l < s.depth + g.rise
        JOIN nodes y ON y.tree = w.tree AND y.l = w.l AND y.p = CASE WHEN w.l < s.depth THEN w.at >> w.l ELSE s.q >> (w.l - s.depth) END
        LEFT JOIN nodes x ON x.tree = w.tree AND x.l = w.l AND x.p = xor(y.p, 1))
SELECT r.doc_id, r.leaf, s.subroot, g.root, sha256(w.proof) AS proof_sha256, w.h AS folded_root, w.h = g.root AS verified
FROM r JOIN sub s USING (tree) JOIN whole g ON true JOIN way w ON w.tree = r.tree AND w.at = r.p AND w.l = s.depth + g.rise
"""
}
QUERIES = {"op11_merkle_manifest": op11_merkle_manifest}

"""Exact nearest neighbours by a block matrix join.

Query blocks meet candidate blocks in a grid of tiles. In a tile the product of int8 matrices gives
every cosine up to a known error; pairs that may still be among the nearest are recomputed from the
original vectors in double precision, and the tiles' short lists are merged by heaps.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a tile in either direction; most tiles whose lists meet in one merge; query rows of a tile that are searched at once.
QUERY_BLOCK, VECTOR_BLOCK, FAN_IN, STRIP = 2048, 8192, 64, 128


def usable(vector: str) -> F.Column:
    """Neither null, zero nor with a null or non-finite component."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~odd & F.exists(v, lambda x: x != 0)


def quantise(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of unit length as int8, the scale of each row and the length of what rounding lost."""
    scale = np.abs(m).max(axis=1) / 127.0
    q = np.rint(m / scale[:, None])
    return q.astype(np.int8), scale, np.sqrt(((m - q * scale[:, None]) ** 2).sum(axis=1))


def tile_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows: sums below 2**24 are exact in float32, so BLAS does them."""
    dims, step = q.shape[1], 1024
    out = np.zeros((len(q), len(c)), np.float32 if dims <= step else np.float64)
    for d in range(0, dims, step):
        out += q[:, d : d + step].astype(np.float32) @ c[:, d : d + step].astype(np.float32).T
    return out


def balanced(m: np.ndarray) -> np.ndarray:
    """Rows whose squares would leave the range of doubles, scaled by a power of two (which changes no cosine); others as they are."""
    most = np.abs(m).max(axis=1)
    far = (most > 1e140) | (most < 1e-140)
    if not far.any():
        return m
    out = m.copy()
    out[far] = np.ldexp(m[far], -np.frexp(most[far])[1][:, None])
    return out


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of row pairs, component by component in order, so equal vectors get equal scores."""
    dot, na, nb = (np.zeros(len(a)) for _ in range(3))
    for d in range(a.shape[1]):
        dot += a[:, d] * b[:, d]
        na += a[:, d] * a[:, d]
        nb += b[:, d] * b[:, d]
    return dot / (np.sqrt(na) * np.sqrt(nb))


def search_tile(q_ids: np.ndarray, q: np.ndarray, v_ids: np.ndarray, v: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """The k nearest of each query in one tile: bounds first, then exact scores of the survivors, strip by strip."""
    q, v = balanced(q), balanced(v)
    unit_q, unit_v = q / np.sqrt((q * q).sum(axis=1))[:, None], v / np.sqrt((v * v).sum(axis=1))[:, None]
    (iq, sq, eq), (iv, sv, ev) = quantise(unit_q), quantise(unit_v)
    out = []
    for top in range(0, len(q), STRIP):
        rows = slice(top, top + STRIP)
        near = tile_products(iq[rows], iv).astype(np.float64) * sq[rows, None] * sv[None, :]
        # |q.v - q'.v'| <= |q - q'| |v| + |q'| |v - v'|, and |q'| <= 1 + |q - q'|.
        slack = eq[rows, None] + (1 + eq[rows])[:, None] * ev[None, :] + 1e-9
        own = q_ids[rows, None] == v_ids[None, :]
        low = np.where(own, -np.inf, near - slack)
        some = min(k, low.shape[1])
        least = np.partition(low, low.shape[1] - some, axis=1)[:, low.shape[1] - some]
        i, j = np.nonzero((near + slack >= least[:, None]) & ~own)
        exact = np.concatenate([cosines(q[rows][i[a : a + 65536]], v[j[a : a + 65536]]) for a in range(0, len(i), 65536)]) if len(i) else np.zeros(0)
        edge = np.searchsorted(i, np.arange(len(near) + 1))
        for r in range(len(near)):
            a, b = edge[r], edge[r + 1]
            best = heapq.nsmallest(k, zip((-exact[a:b]).tolist(), v_ids[j[a:b]].tolist(), strict=True))
            out += [(int(q_ids[top + r]), int(w), -s) for s, w in best]
    return out


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest vectors of each query but its own id, nearest first,
    ties to the smaller id; fewer where there are fewer. Nulls and vectors that are zero or not finite take no part.

    A query meets the vectors of its own length only. Rows that repeat an id are candidates each; a query id counts once (of
    rows that repeat it, one).
    The grid has a block for each QUERY_BLOCK queries and VECTOR_BLOCK vectors: a query is sent to every
    column of the grid and a vector to every row, and no task holds more than one tile.
    """
    schema = "query_id long, vec_id long, score double"
    v = vectors.where(F.col(id_col).isNotNull() & usable(vector_col)).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    q = queries.where(F.col(id_col).isNotNull() & usable(vector_col)).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec")).dropDuplicates(["id"])
    n_v, n_q = v.count(), q.count()
    rows, cols = max(1, math.ceil(n_q / QUERY_BLOCK)), max(1, math.ceil(n_v / VECTOR_BLOCK))
    # Vectors are dealt by id and row, so that repeated ids or equal vectors don't fill one block.
    deal = lambda n, *by: F.pmod(F.xxhash64(*by), F.lit(n)).cast("int")
    left = q.withColumn("row", deal(rows, "id")).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))))
    right = v.withColumn("col", deal(cols, F.col("id"), F.monotonically_increasing_id())).withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))

    def tile(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(a) and len(b):
            found = search_tile(a["id"].to_numpy(), np.stack(a["vec"].to_numpy()), b["id"].to_numpy(), np.stack(b["vec"].to_numpy()), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    left, right = left.withColumn("dims", F.size("vec")), right.withColumn("dims", F.size("vec"))
    keys = ["row", "col", "dims"]
    lists = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(tile, schema)
    while cols > FAN_IN:  # lists of very many tiles are merged in steps
        cols = math.ceil(cols / FAN_IN)
        part = F.pmod(F.xxhash64("vec_id"), F.lit(cols))
        lists = lists.withColumn("part", part).groupBy("query_id", "part").applyInPandas(_merge(k), schema)

    def last(rows_of: pd.DataFrame) -> pd.DataFrame:
        got = _merge(k)(rows_of)
        return got.assign(rank=np.arange(1, len(got) + 1, dtype=np.int32))

    return lists.groupBy("query_id").applyInPandas(last, schema + ", rank int").select("query_id", "rank", "vec_id", "score")


def _merge(k: int):
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        best = heapq.nsmallest(k, zip((-rows["score"]).tolist(), rows["vec_id"].tolist(), strict=True))
        return pd.DataFrame({"query_id": np.full(len(best), rows["query_id"].iloc[0]), "vec_id": [w for _, w in best], "score": [-s for s, _ in best]})

    return merge


def op5_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))


ORACLE = {
    "op5_nearest_vectors": """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(c.e, c.e))) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
}
QUERIES = {"op5_nearest_vectors": op5_nearest_vectors}

"""Jaccard self-join on word shingles by T-occurrence search.

Two texts link when their sets of shingles overlap by ``num / den`` of their union at least. A linked
pair shares one of the rarest shingles of either text (as many as may be missing from the overlap, and
one more), so inverted lists of those alone, built by one shuffle, bring every linked pair into one
coarse block. Texts that only have a passage in common would connect blocks that have nothing to do with one
another, the more the larger the table is: the sets that have company in these lists are listed again by half of their
shingles, and only those that keep it there are put into blocks, by lists of their own. Blocks then hold each text's whole set once and are searched with DivideSkip: the
shortest lists of a text are merged by a heap, the longest only probed by binary search for what
the merge left. A text that is in a group already isn't compared with the rest of that group, so
a group of near copies costs far fewer than all its pairs, and only one link for each text is kept.
"""

from __future__ import annotations

import heapq
import math
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scan import mix64, shingle_sets, text_slices
from .work import spread, with_group, with_row_keys, without, written

WIDTH, NUM, DEN = 4, 85, 100
#: Cells and rows of the sketch of shingle frequencies, cells of one stored piece of it.
CELLS, ROWS, PIECE = 1 << 20, 2, 1 << 16
#: Share of a text's shingles that its prefix holds beyond what may be missing from an overlap.
SPARE_NUM, SPARE_DEN = 1, 20
#: The same where sets that have had company are listed again.
AGAIN_NUM, AGAIN_DEN = 7, 20
#: Most sets of blocks that are broadcast, of a few dozen bytes each.
MOST_WANTED = 500_000
#: Most shingles in a block that is searched at once; larger ones are searched tile by tile.
BLOCK_SHINGLES = 4_000_000
#: Bits of the filter of texts that are in a block; set keys that a task remembers.
FILTER_BITS, SEEN = 1 << 27, 1_000_000
#: DivideSkip: weight of the logarithm in the number of long lists; a list from this length on is long.
MU, LONG = 0.0085, 64

_SIGNED = np.int64


def _cells(hashes: np.ndarray) -> list[np.ndarray]:
    return [(hashes >> np.uint64(22 * r)).astype(_SIGNED) & (CELLS - 1) for r in range(ROWS)]


def _set_keys(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit key for each set: the mixed sum of its mixed hashes; 0 for an empty set."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(hashes ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    total = sums[bounds[1:]] - sums[bounds[:-1]]
    sizes = np.diff(bounds)
    return np.where(sizes > 0, mix64(total + sizes.astype(np.uint64)), np.uint64(0)).view(_SIGNED)


def _profiles(docs: DataFrame, width: int) -> DataFrame:
    """(id, n, key) of each text, and with null ids and n the task's counts for the sketch, in pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(CELLS, np.uint32) for _ in range(ROWS)]
        kind, some = None, False
        for batch in batches:
            ids, sizes, keys = batch.column(0), [], []
            kind = ids.type
            for _, data, offsets in text_slices(batch.column(1)):
                hashes, bounds = shingle_sets(data, offsets, width)
                some |= len(hashes) > 0
                for row, cells in zip(counts, _cells(hashes), strict=True):
                    np.add.at(row, cells, 1)
                sizes.append(np.diff(bounds))
                keys.append(_set_keys(hashes, bounds))
            n = len(ids)
            if n:
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(sizes), pa.int64()), pa.array(np.concatenate(keys), pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=["id", "n", "key", "piece", "counts"])
        if some:
            for k, part in _pieces(counts):
                yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([k], pa.int32()), pa.array([part], pa.binary())], names=["id", "n", "key", "piece", "counts"])

    return docs.mapInArrow(run, f"id {docs.schema[0].dataType.simpleString()}, n long, key long, piece int, counts binary")


def _counted_cells(sets: DataFrame, bits) -> DataFrame:
    """(piece, counts): the tasks' counts for the sketch of the sets (key, n, shingles) that the bitmap lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(CELLS, np.uint32) for _ in range(ROWS)]
        for batch in batches:
            hashes, _, _ = _let_through(batch, bits.value)
            for row, cells in zip(counts, _cells(hashes), strict=True):
                np.add.at(row, cells, 1)
        for k, part in _pieces(counts):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part], pa.binary())], names=["piece", "counts"])

    return sets.mapInArrow(run, "piece int, counts binary")


def _pieces(counts: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    """The pieces of a task's counts that aren't all zero."""
    for k in range(ROWS * CELLS // PIECE):
        row, at = divmod(k * PIECE, CELLS)
        part = counts[row][at : at + PIECE]
        if part.any():
            yield k, zlib.compress(part.astype(np.uint64).tobytes(), 1)


def _added(pieces: DataFrame, by: list[str], level: bool) -> DataFrame:
    """(piece, counts) of ``pieces``, added up for each of the keys ``by``; as levels where it is the last step."""

    def done(piece: int, total: np.ndarray) -> pa.RecordBatch:
        if level:
            total = np.minimum(255, np.rint(6 * np.log2(1 + total.astype(float)))).astype(np.uint8)
        return pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["piece", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(0, np.uint64)
        for batch in batches:
            *keys, counts = (c.to_pylist() for c in batch.columns)
            for *key, some in zip(*keys, counts, strict=True):
                if key != now:
                    if now is not None:
                        yield done(now[0], total)
                    now, total = key, np.zeros(PIECE, np.uint64)
                total += np.frombuffer(zlib.decompress(some), np.uint64)
        if now is not None:
            yield done(now[0], total)

    return pieces.select(*by, "counts").repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "piece int, counts binary")


def _levels(pieces: DataFrame) -> np.ndarray:
    """The sketch: for each row and cell a level that grows with the logarithm of its count. ROWS * CELLS bytes.

    Every task has counted some; they are added in two steps, first for each piece and some of the tasks, so that no task
    reads a piece of all the others."""
    parts = max(1, math.isqrt(pieces.rdd.getNumPartitions()))
    some = pieces.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(parts)))
    out = np.zeros(ROWS * CELLS, np.uint8)
    for r in _added(_added(some, ["piece", "part"], False), ["piece"], True).toLocalIterator():  # ROWS * CELLS / PIECE rows at most
        out[r["piece"] * PIECE : (r["piece"] + 1) * PIECE] = np.frombuffer(zlib.decompress(r["counts"]), np.uint8)
    return out.reshape(ROWS, CELLS)


def missing_at_most(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """Of n shingles, how many a linked text may lack: n less the least overlap, which is n * num / den rounded up."""
    return n - -(-n * num // den)


def kept_again(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """``kept_back`` where sets are listed again: at most the least overlap, of which nothing more could be shared."""
    return np.maximum(1, np.minimum(n * AGAIN_NUM // AGAIN_DEN, -(-n * num // den)))


def kept_back(n):
    """Of its rarest shingles, how many a text of n shingles has in its prefix beyond the one that a link needs at least.

    A linked pair then shares so many listed shingles as the smaller of the two keeps back; a text that has company in
    fewer lists than the smallest text it could link with keeps back has no link. A passage in common seldom gives as many."""
    return np.maximum(1, n * SPARE_NUM // SPARE_DEN)


def _postings(docs: DataFrame, width: int, num: int, den: int, levels) -> DataFrame:
    """(token, key, n): the rarest shingles of each set, in the order of level and hash, that the prefix holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = levels.value, set()
        for batch in batches:
            for _, data, offsets in text_slices(batch.column(0)):
                hashes, bounds = shingle_sets(data, offsets, width)
                sizes, keys = np.diff(bounds), _set_keys(hashes, bounds)
                fresh = np.zeros(len(sizes), bool)
                for i, k in enumerate(keys.tolist()):
                    if sizes[i] and k not in seen:
                        fresh[i] = True
                        seen.add(k)
                if len(seen) > SEEN:
                    seen.clear()
                owner = np.repeat(np.arange(len(sizes)), sizes)
                use = fresh[owner]
                yield _prefixes(hashes[use], np.diff(bounds)[fresh], keys[fresh], level, missing_at_most(sizes, num, den)[fresh] + kept_back(sizes)[fresh])

    return docs.select(docs.columns[1]).mapInArrow(run, "token long, key long, n long")


def _prefixes(hashes: np.ndarray, sizes: np.ndarray, keys: np.ndarray, level: np.ndarray, most: np.ndarray) -> pa.RecordBatch:
    """(token, key, n): of each set the ``most`` rarest of its shingles, which follow one another in ``hashes``."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    rank = np.min([row[c] for row, c in zip(level, _cells(hashes), strict=True)], axis=0) if len(hashes) else np.zeros(0, np.uint8)
    order = np.lexsort((hashes, rank, owner))
    hashes = hashes[order]
    head = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) < most[owner]
    return pa.RecordBatch.from_arrays([pa.array(hashes[head].view(_SIGNED)), pa.array(keys[owner[head]]), pa.array(sizes[owner[head]], pa.int64())], names=["token", "key", "n"])


def _let_through(batch: pa.RecordBatch, field: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shingles, sizes and keys of the sets (key, n, shingles) that a bitmap lets through."""
    keys = batch.column(0).to_numpy()
    at = _bit_place(keys)
    want = ((field[at >> 3] >> (at & 7)) & 1).astype(bool)
    blobs = [x for x, w in zip(batch.column(2).to_pylist(), want.tolist(), strict=True) if w]
    return np.frombuffer(b"".join(blobs), np.uint64), batch.column(1).to_numpy()[want], keys[want]


def _set_postings(sets: DataFrame, num: int, den: int, levels, bits, kept) -> DataFrame:
    """``_postings`` of the sets (key, n, shingles) that the bitmap lets through; ``kept`` is what a prefix keeps back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, sizes, keys = _let_through(batch, bits.value)
            yield _prefixes(hashes, sizes, keys, levels.value, missing_at_most(sizes, num, den) + kept(sizes))

    return sets.mapInArrow(run, "token long, key long, n long")


def _chains(postings: DataFrame, num: int, den: int, edges: bool = True) -> DataFrame:
    """(a, b, c): each set of an inverted list with the first one of its stretch (where ``edges`` are asked for), and with null b, in how
    many lists the set has company. A stretch ends where sizes are too far apart to link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # token, size, set, head and length of the stretch so far
        for batch in batches:
            token, key, n = (c.to_numpy() for c in batch.columns)
            again = np.zeros(len(token), bool)  # a set that several tasks have listed
            again[1:] = (token[1:] == token[:-1]) & (key[1:] == key[:-1])
            if last and len(token):
                again[0] = last[0] == token[0] and last[2] == key[0]
            token, key, n = token[~again], key[~again], n[~again]
            if not len(token):
                continue
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (n[:-1] * den < num * n[1:])
            start = np.flatnonzero(new)
            size = np.diff(np.append(start, len(token)))
            head = np.repeat(key[start], size)
            company = np.repeat(size > 1, size)
            single = []
            if last and last[0] == token[0] and last[1] * den >= num * n[0]:
                head[: size[0]], company[: size[0]] = last[3], True
                single = [last[3]] if last[4] == 1 else []
                size[0] += last[4]
            last = (token[-1], n[-1], key[-1], head[-1], size[-1])
            edge = (head != key) & edges
            pairs = np.unique(np.column_stack([key[edge], head[edge]]), axis=0)
            has, times = np.unique(np.concatenate([key[company], np.array(single, key.dtype)]), return_counts=True)
            b = pa.concat_arrays([pa.array(pairs[:, 1]), pa.nulls(len(has), pa.int64())])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([pairs[:, 0], has])), b, pa.array(np.concatenate([np.zeros(len(pairs), np.int64), times]))], names=["a", "b", "c"])

    listed = postings.repartition("token").sortWithinPartitions("token", "n", "key")
    return listed.mapInArrow(run, "a long, b long, c long").groupBy("a", "b").agg(F.sum("c").alias("c"))


def components(edges: DataFrame) -> DataFrame:
    """(key, root) for every key of ``edges`` (a, b): equal roots where edges connect.

    Every round gives each key its least neighbour and contracts the edges to those; the keys left
    at least halve each time. No key's neighbours are gathered: only minima are, combined before the shuffle.
    """
    edges = written(edges, "edges")
    labels = None
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to")), "step")
        moved = step.select(F.col("a").alias("key"), F.col("to").alias("next"))
        if labels is None:
            labels = written(moved.withColumnRenamed("next", "root"), "labels")
        else:
            labels = written(labels.join(moved.withColumnRenamed("key", "root"), "root", "left").select("key", F.coalesce("next", "root").alias("root")), "labels")
        a = edges.join(step.select("a", F.col("to").alias("x")), "a").select("b", "x")
        b = a.join(step.select(F.col("a").alias("b"), F.col("to").alias("y")), "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        edges = written(b.where("a <> b").groupBy("a", "b").agg(F.lit(1).alias("_")).drop("_"), "edges")
    return labels if labels is not None else edges.select(F.col("a").alias("key"), F.col("b").alias("root"))


def _filter(keys: DataFrame) -> np.ndarray:
    """A bitmap of FILTER_BITS over the keys, whatever their number: it lets through every key and few others."""
    at = F.pmod(F.col("key"), F.lit(FILTER_BITS)) + 1  # Spark numbers bits from 1
    parts = keys.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in parts.toLocalIterator():
        bits = np.frombuffer(bytes(r["bits"]), np.uint8)
        begin = (r["k"] - 1) * len(bits)
        out[begin : begin + len(bits)] = bits[: len(out) - begin]
    return out


def _bit_place(keys: np.ndarray) -> np.ndarray:
    return keys % FILTER_BITS


def _sets(docs: DataFrame, width: int, bits) -> DataFrame:
    """(key, n, shingles) of the texts that the bitmap lets through, once for each set and task at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field, seen = bits.value, set()
        for batch in batches:
            for _, data, offsets in text_slices(batch.column(0)):
                hashes, bounds = shingle_sets(data, offsets, width)
                keys = _set_keys(hashes, bounds)
                at = _bit_place(keys)
                want = np.flatnonzero((np.diff(bounds) > 0) & ((field[at >> 3] >> (at & 7)) & 1).astype(bool))
                out = []
                for i in want.tolist():
                    k = int(keys[i])
                    if k not in seen:
                        seen.add(k)
                        out.append((k, int(bounds[i + 1] - bounds[i]), hashes[bounds[i] : bounds[i + 1]].tobytes()))
                if len(seen) > SEEN:
                    seen.clear()
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.binary())], names=["key", "n", "shingles"])

    return docs.select(docs.columns[1]).mapInArrow(run, "key long, n long, shingles binary")


def heap_merge(lists: list[list[int]]) -> list[tuple[int, int]]:
    """(id, number of lists that hold it) over sorted lists."""
    out: list[tuple[int, int]] = []
    last, count = -1, 0
    for x in heapq.merge(*lists):
        if x == last:
            count += 1
        else:
            if count:
                out.append((last, count))
            last, count = x, 1
    if count:
        out.append((last, count))
    return out


def search_block(sets: list[np.ndarray], num: int, den: int) -> list[int]:
    """For each of the sets (sorted, distinct) the place of one set that stands for all connected by links within the block."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sizes = [len(sets[i]) for i in order]
    parent = list(range(len(order)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    flat = np.concatenate([sets[i] for i in order]) if order else np.zeros(0, np.uint64)
    token, count = np.unique(flat, return_inverse=True, return_counts=True)[1:]
    shared = (count > 1)[token]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    lists: dict[int, list[int]] = {}
    for x in range(len(order)):
        own = token[bounds[x] : bounds[x + 1]][shared[bounds[x] : bounds[x + 1]]].tolist()
        mine = [lists[t] for t in own if t in lists]
        n = sizes[x]
        low = bisect_left(sizes, -(-n * num // den))
        # The least overlap with any text that is large enough.
        least = -(-num * (n + sizes[low]) // (num + den)) if low < x else n + 1
        if len(mine) >= least:
            mine.sort(key=len)
            skip = max(int(least / (MU * math.log2(max(2, len(mine[-1]))) + 1)), len(mine) - bisect_left([len(m) for m in mine], LONG))
            skip = min(skip, least - 1)
            short, long = mine[: len(mine) - skip], mine[len(mine) - skip :]
            found = [(c, y) for y, c in heap_merge(short) if c >= least - skip and y >= low]
            for c, y in sorted(found, reverse=True):
                if find(y) == find(x):
                    continue
                need, left = -(-num * (n + sizes[y]) // (num + den)), len(long)
                for m in long:
                    if c >= need or c + left < need:
                        break
                    at = bisect_left(m, y)
                    c += at < len(m) and m[at] == y
                    left -= 1
                if c >= need:
                    parent[max(find(x), find(y))] = min(find(x), find(y))
        for t in own:
            lists.setdefault(t, []).append(x)
    return [order[r] for r in (find(x) for x in np.argsort(order).tolist())]


def _search(blocks: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) for every set of a block: the set and the one that stands for its group. Rows of a block follow one another."""

    def done(keys: list[int], sets: list[bytes]) -> pa.RecordBatch:
        roots = search_block([np.frombuffer(s, np.uint64) for s in sets], num, den)
        pairs = [(keys[i], keys[r]) for i, r in enumerate(roots) if i != r]
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, sets = None, [], []
        for batch in batches:
            for *block, key, shingles in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block != now:
                    if len(keys) > 1:
                        yield done(keys, sets)
                    now, keys, sets = block, [], []
                keys.append(key)
                sets.append(shingles)
        if len(keys) > 1:
            yield done(keys, sets)

    by = ["root", "i", "j"]
    return blocks.select(*by, "key", "shingles").repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "a long, b long")


def _company(chains: DataFrame, size: DataFrame, least) -> DataFrame:
    """(key, n) of the sets that have company in so many lists as ``least`` says of the smallest text that they can link with."""
    return chains.where("b is null").select(F.col("a").alias("key"), "c").join(size, "key").where(F.col("c") >= least).select("key", "n")


def linked_sets(docs: DataFrame, profiles: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(key, root) of the sets that link with another one; ``docs`` has the columns id and text."""
    send = docs.sparkSession.sparkContext.broadcast
    levels = send(_levels(profiles.where(F.col("piece").isNotNull())))
    size = profiles.where("n > 0").groupBy("key").agg(F.max("n").alias("n"))
    # The smallest text that a set of n can link with has n * num / den shingles, rounded up.
    # Only sets with enough company are worth comparing, and only with another such set of their block.
    smallest = F.ceil(F.col("n") * num / den)
    least = F.greatest(F.lit(1), F.floor(smallest * SPARE_NUM / SPARE_DEN))
    able = written(_company(_chains(_postings(docs, width, num, den, levels), num, den, edges=False), size, least), "able")
    sets = written(_sets(docs, width, send(_filter(able))).dropDuplicates(["key"]), "sets")
    # A passage in common gives company in few lists of half of all shingles, whatever the sketch knows of its frequency.
    again = F.greatest(F.lit(1), F.least(F.floor(smallest * AGAIN_NUM / AGAIN_DEN), F.ceil(smallest * num / den)))
    listed = _set_postings(sets, num, den, levels, send(_filter(able)), lambda n: kept_again(n, num, den))
    able = written(_company(_chains(listed, num, den, edges=False), able, again), "able")
    # Blocks come from lists of what is left, by a sketch of its own.
    bits = send(_filter(able))
    levels = send(_levels(_counted_cells(sets, bits)))
    chains = written(_chains(_set_postings(sets, num, den, levels, bits, kept_back), num, den), "chains")
    coarse = components(chains.where("b is not null").select("a", "b"))
    able = written(_company(chains, able, least).join(coarse, "key"), "able")
    blocks = able.groupBy("root").agg(F.count("*").alias("sets"), F.sum("n").alias("all")).where("sets > 1")
    wanted = written(able.join(blocks, "root").select("key", "root", F.ceil(2 * F.col("all") / BLOCK_SHINGLES).cast("int").alias("m"), (F.col("all") > BLOCK_SHINGLES).alias("large")), "wanted")
    few = wanted.limit(MOST_WANTED + 1).count() <= MOST_WANTED
    sets = sets.join(F.broadcast(wanted) if few else wanted, "key")
    if not wanted.where("large").limit(1).count():
        return components(_search(sets.withColumns({"i": F.lit(0), "j": F.lit(0)}), num, den))
    # A large block is dealt to parts; every two parts meet in a tile.
    parts = F.when(F.col("large"), F.col("m")).otherwise(1)
    dealt = sets.withColumn("m", parts).withColumn("p", F.pmod(F.xxhash64("key"), F.col("m")).cast("int"))
    meets = dealt.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    blocks = meets.withColumns({"i": F.least("p", "q"), "j": F.greatest("p", "q")})
    return components(_search(blocks, num, den))


def near_duplicates(docs: DataFrame, width: int = WIDTH, num: int = NUM, den: int = DEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of ``docs``: its id, n_shingles and component_id, the smallest id that links reach from it, its own included.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, in lower case (A-Z). Texts without words, empty and null
    ones link with nothing; shorter texts than ``width`` words are one shingle. Rows with equal sets link. Null ids are
    passed over when the smallest is taken. Sets and shingles are told apart by 64-bit hashes.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    profiles = written(_profiles(source, width), "profiles")
    rows = profiles.where(F.col("piece").isNull()).select("id", "n", "key")
    groups = written(rows.where("n > 0").groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("size")), "groups")
    linked = written(linked_sets(source, profiles, width, num, den), "linked")
    least = linked.join(groups, "key").groupBy("root").agg(F.min("first").alias("least"))
    wide = linked.join(least, "root").select("key", "least")
    known = groups.join(wide, "key", "left").where("size > 1 or least is not null").select("key", "size", F.coalesce("least", "first").alias("component_id"))
    total = rows.count()
    out = with_group(rows, written(known, "known"), ["key"], "size", total)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce(F.when(F.col("n") > 0, F.col("component_id")), F.col("id")).alias("component_id"))


def representatives(docs: DataFrame, width: int, num: int, den: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that have the smallest id of their group of linked texts."""
    numbered, name = with_row_keys(docs, id_col)
    judged = near_duplicates(numbered.select(F.col(name), F.col(f"`{text_col}`").alias("_text")), width, num, den, name, "_text")
    return without(numbered, name, judged.where(F.col(name) != F.col("component_id"))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))


ORACLE = {
    "op3_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
             ELSE list_distinct([array_to_string(ws[i:i+3], ' ') FOR i IN range(1, len(ws) - 2)]) END AS sh FROM w),
u AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS k FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p WHERE 100 * k >= 85 * (na + nb - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, m.component_id FROM s JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) m USING (doc_id)
"""
}
QUERIES = {"op3_jaccard_join": op3_jaccard_join}

"""Byte-level BPE encoding and decoding over whole texts.

Texts are cut as the public pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`` cuts them, without a regex:
each code point has a class, each class is a function from state to state, and composing those
functions gives the state at every place. Distinct slices go through vectorised pair merging once
and are cached; the ids of each text are put together from the slices, whose byte offsets are kept.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .scan import text_slices, word_hashes
from .work import spread

# Classes of code points; an apostrophe that a contraction may follow has a class of its own.
L, N, O, W, SP, Q1, Q2, NEAR = range(8)  # noqa: E741
# States: after white space or nothing, after a space, in letters, in digits, in other signs,
# one or two letters before the end of a contraction, after one.
_W, _SP, _L, _N, _O, _T1, _T2, _D = range(8)
#: State after a code point of the class (row) in each state before it (column).
NEXT = np.array(
    [
        [_L] * 8,
        [_N] * 8,
        [_O] * 8,
        [_W] * 8,
        [_SP] * 8,
        [_T1, _O, _T1, _T1, _O, _T1, _T1, _T1],
        [_T2, _O, _T2, _T2, _O, _T2, _T2, _T2],
        [_L, _L, _L, _L, _L, _D, _T1, _L],  # a letter soon after an apostrophe
    ],
    np.uint8,
)
_FIXED = np.array([len(set(r)) == 1 for r in NEXT.tolist()])
# Code points with the property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Distinct slices kept in a worker's cache, and the longest slice that is kept.
CACHE_SLICES, CACHE_BYTES = 250_000, 256


@lru_cache(maxsize=1)
def code_point_classes() -> np.ndarray:
    kinds = np.full(0x110000, O, np.uint8)
    for c in range(0x110000):
        k = unicodedata.category(chr(c))[0]
        if k == "L":
            kinds[c] = L
        elif k == "N":
            kinds[c] = N
    kinds[WHITE_SPACE] = W
    kinds[0x20] = SP
    return kinds


def scan_states(classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """State before each place. Functions are composed by doubling until each chain has reached a constant one.

    ``first`` marks the places where a text begins: the state there is the start.
    """
    n = len(classes)
    after = NEXT[classes, 0]
    known = _FIXED[classes] | first
    # Only the places behind a function that isn't constant need composing.
    open_at = np.flatnonzero(~known)
    if len(open_at):
        of = np.full(n, -1, np.int64)
        of[open_at] = np.arange(len(open_at))
        table = NEXT[classes[open_at]]  # state before the chain -> state after this place
        behind = open_at - 1  # the place whose state the chain needs
        while True:
            link = of[behind]
            more = link >= 0
            if not more.any():
                break
            at = link[more]
            table[more] = np.take_along_axis(table[more], table[at], axis=1)
            behind[more] = behind[at]
        after[open_at] = table[np.arange(len(open_at)), after[behind]]
    before = np.empty(n, np.uint8)
    before[1:] = after[:-1]
    before[first] = _W
    return before


def slice_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mask of the code points at which a slice begins; ``first`` marks where texts begin."""
    n = len(points)
    kinds = code_point_classes()[points]
    quote = np.flatnonzero(points == 0x27)
    if len(quote):
        end = np.append(np.flatnonzero(first), n)
        stop = end[np.searchsorted(end, quote, "right")]
        padded = np.append(points, [0, 0])
        one = np.where(quote + 1 < stop, padded[quote + 1], 0)
        two = np.where(quote + 2 < stop, padded[quote + 2], 0)
        is1 = np.isin(one, [ord(c) for c in "stmd"])
        is2 = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        kinds[quote[is1]] = Q1
        kinds[quote[is2]] = Q2
        near = np.concatenate([quote[is1 | is2] + 1, quote[is2] + 2, quote[is1] + 2, quote[is2] + 3])
        near = near[near < n]
        kinds[near[kinds[near] == L]] = NEAR
    before = scan_states(kinds, first)
    space = (kinds == W) | (kinds == SP)
    letter = (kinds == L) | (kinds == NEAR)
    other = (kinds == O) | (kinds == Q1) | (kinds == Q2)
    joined = (
        (before == _SP) & ~space
        | letter & ((before == _L) | (before == _T1) | (before == _T2))
        | (kinds == N) & (before == _N)
        | other & (before == _O)
    )
    begins = ~joined
    # Of white space before something else, the last place is cut off; the rest is one slice.
    follows = np.empty(n, bool)
    follows[:-1] = ~space[1:] & ~first[1:]
    follows[-1:] = False
    begins[space] = (((before != _W) & (before != _SP)) | follows)[space]
    begins |= first
    return begins


class Vocabulary:
    """Ranks of a byte-level vocabulary: bytes of each id, and the id of each pair that merges."""

    def __init__(self, lines: bytes) -> None:
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line.strip())}
        self.pieces: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        pairs = {}
        for token, rank in self.ranks.items():
            self.pieces[rank] = token
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.single = np.array([self.ranks[bytes([x])] for x in range(256)], np.int64)
        # Open addressing with steps of one: a pair is found within `reach` places.
        self.bits = 21
        size = 1 << self.bits
        self.keys, self.values, self.reach = np.full(size + 64, -1, np.int64), np.full(size + 64, NONE, np.int64), 1
        home = self._home(np.fromiter(pairs, np.int64, len(pairs)))
        for h, (key, rank) in zip(home.tolist(), pairs.items(), strict=True):
            at = h
            while self.keys[at] >= 0:
                at += 1
            self.keys[at], self.values[at] = key, rank
            self.reach = max(self.reach, at - h + 1)
        self.decimal = [str(i).encode() for i in range(len(self.pieces))]
        self.piece_size = np.array([len(p) for p in self.pieces], np.int64)
        self.piece_start = np.cumsum(self.piece_size) - self.piece_size
        self.piece_bytes = np.frombuffer(b"".join(self.pieces), np.uint8)
        self.forget()

    def forget(self) -> None:
        """Empty the cache: slot k has the ids ``flat[start[k] : start[k] + size[k]]`` and their text ``texts[k]``."""
        self.cache: dict[bytes, int] = {}
        self.texts: list[bytes] = []
        self.flat, self.start, self.size = (np.zeros(0, np.int64) for _ in range(3))

    def _home(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = self._home(key)
        out = np.where(self.keys[at] == key, self.values[at], NONE)
        for k in range(1, self.reach):
            todo = np.flatnonzero((out == NONE) & (self.keys[at + k - 1] >= 0))
            if not len(todo):
                break
            hit = todo[self.keys[at[todo] + k] == key[todo]]
            out[hit] = self.values[at[hit] + k]
        return out

    def merge(self, slices: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the slices (none empty) one after another, and how many each has: in every round the
        leftmost pair of least rank of each slice merges."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        todo = []
        for i, x in enumerate(slices):
            rank = self.ranks.get(x)
            if rank is None and len(x) <= 4 * CACHE_BYTES:
                todo.append(i)
            else:
                got = np.array([rank], np.int64) if rank is not None else self._merge_long(x)
                done.append((np.full(len(got), i), got))
        sizes = np.array([len(slices[i]) for i in todo], np.int64)
        owner = np.repeat(np.array(todo, np.int64), sizes)
        ids = self.single[np.frombuffer(b"".join([slices[i] for i in todo]), np.uint8)]
        best = np.full(len(ids), NONE)
        if len(ids):
            best[:-1] = np.where(owner[1:] == owner[:-1], self.pair_ranks(ids[:-1], ids[1:]), NONE)
        while len(ids):
            start = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            least = np.minimum.reduceat(best, start)
            count = np.diff(np.append(start, len(ids)))
            over = least == NONE
            if over.any():
                stay = np.repeat(~over, count)
                done.append((owner[~stay], ids[~stay]))
                ids, owner, best = ids[stay], owner[stay], best[stay]
                if not len(ids):
                    break
                least, count = least[~over], count[~over]
                start = np.cumsum(count) - count
            at = np.flatnonzero(best == np.repeat(least, count))
            at = at[np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])]  # the leftmost of each slice
            ids[at] = least
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, owner, best = ids[keep], owner[keep], best[keep]
            at -= np.arange(len(at))
            for left in (at - 1, at):  # the pairs at either side of what merged are new
                ok = left[(left >= 0) & (left + 1 < len(ids))]
                same = owner[ok] == owner[ok + 1]
                best[ok] = np.where(same, self.pair_ranks(ids[ok], ids[ok + 1]), NONE)
            last = at[at + 1 >= len(ids)]
            best[last] = NONE
        owner = np.concatenate([np.zeros(0, np.int64), *(d[0] for d in done)])
        ids = np.concatenate([np.zeros(0, np.int64), *(d[1] for d in done)])
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(slices))

    def _merge_long(self, x: bytes) -> np.ndarray:
        """The same for one long slice, with a heap: n log n in its length."""
        import heapq

        ids = self.single[np.frombuffer(x, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        pieces = self.pieces

        def rank(i: int) -> int:
            j = after[i]
            return self.ranks.get(pieces[ids[i]] + pieces[ids[j]], NONE) if j < len(ids) else NONE

        heap = [(r, i) for i in range(len(ids) - 1) if (r := rank(i)) != NONE]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or rank(i) != r:
                continue
            j = after[i]
            ids[i], ids[j] = r, -1
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and (r := rank(k)) != NONE:
                    heapq.heappush(heap, (r, k))
        return np.array([i for i in ids if i >= 0], np.int64)

    def slots(self, slices: list[bytes]) -> np.ndarray:
        """Slots of the slices; new ones are merged and cached."""
        if len(self.texts) > CACHE_SLICES:
            self.forget()
        cache = self.cache
        new = [x for x in slices if x not in cache]
        if new:
            ids, size = self.merge(new)
            first, edge, decimal = len(self.texts), np.cumsum(size), self.decimal
            self.start = np.concatenate([self.start, len(self.flat) + edge - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, ids])
            said = [decimal[i] for i in ids.tolist()]
            self.texts += [b",".join(said[b - n : b]) for b, n in zip(edge.tolist(), size.tolist(), strict=True)]
            cache.update(zip(new, range(first, len(self.texts)), strict=True))
        found = np.array([cache[x] for x in slices], np.int64)
        for x in new:
            if len(x) > CACHE_BYTES:
                del cache[x]
        return found

    def ids_of(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the slots one after another, and where each slot's begin (with the end)."""
        size = self.size[slots]
        return self.flat[_ranges(self.start[slots], size)], np.concatenate([[0], np.cumsum(size)])


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for each start and size in turn."""
    end = np.cumsum(size)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(start - (end - size), size)


NONE = np.int64(1 << 40)


@lru_cache(maxsize=2)
def _read(lines: bytes) -> Vocabulary:
    return Vocabulary(lines)


def vocabulary(path: str) -> Vocabulary:
    with open(path, "rb") as f:
        return _read(f.read())


class Sent:
    """A rank file on its way to the tasks: opened by the driver alone and broadcast; its size is that of the vocabulary."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        with open(path, "rb") as f:
            self.lines = spark.sparkContext.broadcast(f.read())

    def vocabulary(self) -> Vocabulary:
        return _read(self.lines.value)


def encode_slices(column: pa.Array, vocab: Vocabulary) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """For each run of texts: its bytes, the byte starts of the slices, the slices' slots, and the first slice of each text."""
    for _, data, offsets in text_slices(column):
        rows = len(offsets) - 1
        if not len(data):
            yield b"", np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(rows + 1, np.int64)
            continue
        raw = data.tobytes()
        try:
            points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        except UnicodeDecodeError:  # some text isn't UTF-8: its bad bytes count as U+FFFD
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield from encode_slices(pa.array(texts, pa.large_string()), vocab)
            continue
        byte_at = np.flatnonzero((data & 0xC0) != 0x80)
        first = np.zeros(len(points), bool)
        begin = np.searchsorted(byte_at, offsets[:-1])
        first[begin[begin < len(points)]] = True
        starts = byte_at[slice_starts(points, first)]
        ends = np.append(starts[1:], len(data))
        # Equal slices of this run share a 64-bit hash; each distinct one is looked up by its bytes.
        _, one, which = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        distinct = [raw[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist(), strict=True)]
        yield raw, starts, vocab.slots(distinct)[which], np.searchsorted(starts, offsets)


def decode(ids: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """The bytes that ``ids`` stand for."""
    return vocab.piece_bytes[_ranges(vocab.piece_start[ids], vocab.piece_size[ids])]


#: Tokens after which a batch of results is cut.
OUT_TOKENS = 1 << 22

RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` and ``token_ids`` (array<int>), ``token_offsets`` (array<int>, the byte where each token begins).

    Null and empty texts have no tokens; bytes that aren't UTF-8 count as U+FFFD. Columns of these two names are replaced.
    Equal texts of one batch are encoded once. Narrow: no shuffle; rows of a batch may change places.
    """
    docs = docs.drop("token_ids", "token_offsets")
    sent = Sent(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = sent.vocabulary()
        sizes = vocab.piece_size
        for batch in batches:
            # Repeats of a text (the copies that a mix takes lie together) are encoded once in a batch.
            text = batch.column(batch.schema.get_field_index(text_col)).dictionary_encode("encode")
            which, at = text.indices.to_numpy(), 0
            for raw, _, slots, bounds in encode_slices(text.dictionary, vocab):
                n = len(bounds) - 1
                ids, edge = vocab.ids_of(slots)
                edge = edge[bounds]
                begin = np.cumsum(sizes[ids]) - sizes[ids]
                owner = np.repeat(np.arange(n), np.diff(edge))
                head = np.append(begin, len(raw))[edge[:-1]]
                lists = [pa.ListArray.from_arrays(edge.astype(np.int32), x.astype(np.int32)) for x in (ids, begin - head[owner])]
                rows = np.flatnonzero((which >= at) & (which < at + n))
                own = which[rows] - at
                at += n
                # Copies of a long text leave in several batches, so that memory stays bounded.
                step = np.cumsum(np.diff(edge)[own]) // OUT_TOKENS
                for some in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(step)) + 1):
                    kept, mine = batch.take(pa.array(rows[some])), pa.array(own[some])
                    yield pa.RecordBatch.from_arrays([*kept.columns, *(x.take(mine) for x in lists)], names=[*kept.schema.names, "token_ids", "token_offsets"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, token_ids array<int>, token_offsets array<int>")


def token_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: the id, number of tokens, digests of the ids and of what they decode to.

    A null text counts as empty; an empty one has 0 tokens and the digest of no bytes. Every text is
    encoded whole; bytes that aren't UTF-8 count as U+FFFD. Narrow: no shuffle; memory is bounded by the batch and the longest text.
    """
    sent = Sent(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = sent.vocabulary()
        sha = hashlib.sha256
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for _, _, slots, bounds in encode_slices(batch.column(1), vocab):
                ids, edge = vocab.ids_of(slots)
                back = decode(ids, vocab)
                at = np.concatenate([[0], np.cumsum(vocab.piece_size[ids])])[edge[bounds]].tolist()
                counts.append(np.diff(edge[bounds]))
                texts = vocab.texts
                said, cut = [texts[i] for i in slots.tolist()], bounds.tolist()
                ids_sha += [sha(b",".join(said[a:b])).hexdigest() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                text_sha += [sha(back[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([np.zeros(0, np.int64), *counts]), pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=[batch.schema.names[0], "n_tokens", "ids_sha256", "decoded_sha256"])

    source = docs.select(id_col, text_col)
    return source.mapInArrow(run, f"`{id_col}` {source.schema[0].dataType.simpleString()}, {RESULT}")


def rank_file(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")), rank_file())


QUERIES = {"op1_bpe_tokens": op1_bpe_tokens}
ORACLE: dict[str, str] = {}

"""Byte-level BPE encoding and decoding.

Pre-tokenisation has no regex: code points become classes, each class (with its
look-ahead) is a transition function of a small automaton, and functions compose
associatively. The finite monoid they generate is tabulated once, so a scan over
a text is gathers in a composition table: first within rows of a block, then
over the rows' totals, as any associative scan. The state before each character
tells whether a match of the pattern starts there.

The slices found feed pair merging: unseen ones are merged together, one lowest
leftmost pair of each per round (those of over ``SHORT_SLICE`` characters alone, by a
heap), and kept in a bounded cache. Beside its ids a text keeps their offsets: the
byte at which each id starts. Decoding writes each id's bytes at its offset, so any
range of ids decodes alone, and an id that doesn't fill its place is an error.

Defined cases: null and empty texts have no ids; repeated rows each get a row;
null ids decode to no bytes.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .arrow import pieces, with_columns

# The characters of the pattern's white space (Unicode White_Space).
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# What may follow an apostrophe in the pattern's contractions.
SHORT, LONG = "stmd", ("re", "ve", "ll")

# First and last code points of letters and of numbers that Unicode 16 added and Python's own tables (15.1) lack.
NEW_LETTERS = [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)]
NEW_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]

# Symbols of the automaton. END parts texts; _X: white space that is the last of its run before other characters.
LETTER, NUMBER, OTHER, SPACE, WHITES, APOS1, APOS2, END, SPACE_X, WHITES_X = range(10)
# States: what the last character was part of. GLUE: a space that the next character's match takes in;
# LEFT1, LEFT2: so many letters of a contraction are to come; CUT: a contraction has ended.
START, IN_L, IN_N, IN_O, IN_W, GLUE, LEFT1, LEFT2, CUT = range(9)
STATES = 9
#: Longer slices than these characters are merged alone.
SHORT_SLICE = 256


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a match starts at this symbol."""
    if symbol == END:
        return START, False
    if symbol in (SPACE, WHITES):
        return IN_W, state != IN_W
    if symbol in (SPACE_X, WHITES_X):
        return (GLUE if symbol == SPACE_X else IN_W), True
    if symbol == LETTER:
        if state in (LEFT1, LEFT2):
            return (CUT if state == LEFT1 else LEFT1), False
        return IN_L, state not in (IN_L, GLUE)
    if symbol == NUMBER:
        return IN_N, state not in (IN_N, GLUE)
    if state in (IN_O, GLUE):
        return IN_O, False
    return {OTHER: IN_O, APOS1: LEFT1, APOS2: LEFT2}[symbol], True


@lru_cache(1)
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the symbols' transition functions: numbers, composition table, images of START, and starts[state, symbol]."""
    base = [tuple(_step(s, c)[0] for s in range(STATES)) for c in range(10)]
    found = list(dict.fromkeys([tuple(range(STATES)), *base]))
    at = {f: i for i, f in enumerate(found)}
    for f in found:  # grows while it is read
        for g in base:
            h = tuple(g[x] for x in f)
            if h not in at:
                at[h] = len(found)
                found.append(h)
    n = len(found)
    assert n < 256
    table = np.array([[at[tuple(g[x] for x in f)] for g in found] for f in found], np.uint8)
    starts = np.array([[_step(s, c)[1] for c in range(10)] for s in range(STATES)])
    return np.array([at[b] for b in base], np.uint8), table.ravel(), np.array(found, np.uint8), starts.ravel(), n


@lru_cache(1)
def _classes() -> np.ndarray:
    out = np.full(0x110001, OTHER, np.uint8)
    for c in range(0x110000):
        k = unicodedata.category(chr(c))[0]
        if k == "L":
            out[c] = LETTER
        elif k == "N":
            out[c] = NUMBER
    for a, b in NEW_LETTERS:
        out[a : b + 1] = LETTER
    for a, b in NEW_NUMBERS:
        out[a : b + 1] = NUMBER
    out[WHITE] = WHITES
    out[0x20] = SPACE
    out[0x110000] = END
    return out


def scan_states(symbols: np.ndarray, width: int = 64) -> np.ndarray:
    """The automaton's state before each symbol, from START, by an associative scan."""
    number, table, image, _, n = _monoid()
    size = len(symbols)
    rows = -(-size // width) or 1
    f = np.zeros(rows * width, np.uint8)  # 0: identity
    f[:size] = number[symbols]
    f = np.ascontiguousarray(f.reshape(rows, width).T)
    prefix = np.empty_like(f)
    prefix[0] = f[0]
    for j in range(1, width):
        prefix[j] = table[prefix[j - 1].astype(np.uint16) * n + f[j]]
    if rows > width:
        total = _exclusive(prefix[-1], width)
    else:
        total, last = np.zeros(rows, np.uint8), 0
        for i, x in enumerate(prefix[-1].tolist()):
            total[i] = last
            last = int(table[last * n + x])
    state = np.empty_like(f)
    entry = image[total, START]
    state[0] = entry
    for j in range(1, width):
        state[j] = image.ravel()[prefix[j - 1].astype(np.uint16) * STATES + entry]
    return state.T.ravel()[:size]


def _exclusive(f: np.ndarray, width: int) -> np.ndarray:
    """For each function, the composition of all before it."""
    _, table, _, _, n = _monoid()
    size = len(f)
    rows = -(-size // width)
    g = np.zeros(rows * width, np.uint8)
    g[:size] = f
    g = np.ascontiguousarray(g.reshape(rows, width).T)
    prefix = np.empty_like(g)
    prefix[0] = g[0]
    for j in range(1, width):
        prefix[j] = table[prefix[j - 1].astype(np.uint16) * n + g[j]]
    before, last = np.zeros(rows, np.uint8), 0
    if rows > width:
        before = _exclusive(prefix[-1], width)
    else:
        for i, x in enumerate(prefix[-1].tolist()):
            before[i] = last
            last = int(table[last * n + x])
    out = np.empty_like(g)
    out[0] = before
    for j in range(1, width):
        out[j] = table[before.astype(np.uint16) * n + prefix[j - 1]]
    return out.T.ravel()[:size]


def boundaries(points: np.ndarray) -> np.ndarray:
    """Positions where matches start, in code points of texts that 0x110000 parts (and ends)."""
    symbols = _classes()[points]
    nxt = np.empty_like(symbols)
    nxt[:-1] = symbols[1:]
    nxt[-1] = END
    white = (symbols == SPACE) | (symbols == WHITES)
    last = white & (nxt != SPACE) & (nxt != WHITES) & (nxt != END)
    apos = np.flatnonzero(points == 0x27)
    if len(apos):
        padded = np.concatenate([points[apos[-1] :][:3], np.full(3, 0x110000, points.dtype)])
        one = np.where(apos + 1 < len(points), points[np.minimum(apos + 1, len(points) - 1)], padded[1])
        two = np.where(apos + 2 < len(points), points[np.minimum(apos + 2, len(points) - 1)], padded[2])
        symbols[apos[np.isin(one, [ord(c) for c in SHORT])]] = APOS1
        for a, b in LONG:
            symbols[apos[(one == ord(a)) & (two == ord(b))]] = APOS2
    symbols[last] += SPACE_X - SPACE
    states = scan_states(symbols)
    return np.flatnonzero(_monoid()[3][states.astype(np.uint16) * 10 + symbols])


class Vocabulary:
    """Ranks of byte strings, and the ids that each pair of ids merges to."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        # All ids' bytes end to end, and where each has its own.
        self.length = np.zeros(max(self.ranks.values(), default=-1) + 1, np.int64)
        by_id = sorted((i, b) for b, i in self.ranks.items())
        self.length[[i for i, _ in by_id]] = [len(b) for _, b in by_id]
        self.begin, self.flat = np.cumsum(self.length) - self.length, np.frombuffer(b"".join(b for _, b in by_id), np.uint8)
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = [(self.ranks[b[:i]], self.ranks[b[i:]], r) for b, r in self.ranks.items() for i in range(1, len(b)) if b[:i] in self.ranks and b[i:] in self.ranks]
        left, right, rank = np.array(pairs, np.int64).reshape(-1, 3).T
        self.pairs = {(a, b): r for a, b, r in pairs}
        self.shift = max(16, int(max(self.ranks.values(), default=0)).bit_length())
        key = left << self.shift | right
        # Open addressing: slots are filled in rounds, each row at the first free slot after its own.
        self.bits = max(8, int(len(key) * 6).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        todo, step = np.arange(len(key)), 0
        while len(todo):
            slot = self._slot(key[todo], step)
            free = self.keys[slot] == -1
            self.keys[slot[free]] = key[todo[free]]
            done = self.keys[slot] == key[todo]
            self.values[slot[done]] = rank[todo[done]]
            todo, step = todo[~done], step + 1
        self.steps = step

    def _slot(self, key: np.ndarray, step: int) -> np.ndarray:
        return ((key * 0x9E3779B1 >> 7) + step) & ((1 << self.bits) - 1)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id of each pair's merge; a number above all ids where there is none."""
        key = left << self.shift | right
        out = np.full(len(key), np.iinfo(np.int64).max)
        todo = np.arange(len(key))
        for step in range(self.steps):
            slot = self._slot(key[todo], step)
            there = self.keys[slot]
            hit = there == key[todo]
            out[todo[hit]] = self.values[slot[hit]]
            todo = todo[~hit & (there != -1)]
            if not len(todo):
                break
        return out

    def merge_long(self, raw: bytes) -> bytes:
        """As ``merge`` for one slice, by a heap of pairs over a linked list: in proportion to its length but for a logarithm."""
        none = np.iinfo(np.int64).max
        ids = self.single[np.frombuffer(raw, np.uint8)]
        rank = self.merged(ids[:-1], ids[1:])
        at = np.flatnonzero(rank != none)
        heap = list(zip(rank[at].tolist(), at.tolist(), strict=True))
        heapify(heap)
        ids, n = ids.tolist(), len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray([1]) * n
        pairs = self.pairs
        while heap:
            r, i = heappop(heap)
            j = after[i]
            # A pair that has changed since is out of date: what it is now has an entry of its own.
            if not alive[i] or j == n or pairs.get((ids[i], ids[j])) != r:
                continue
            ids[i], alive[j] = r, 0
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (x := pairs.get((r, ids[k]))) is not None:
                    heappush(heap, (x, i))
            h = before[i]
            if h >= 0 and (x := pairs.get((ids[h], r))) is not None:
                heappush(heap, (x, h))
        return np.array([x for x, on in zip(ids, alive, strict=True) if on], "<u4").tobytes()

    def merge(self, slices: list[bytes]) -> list[bytes]:
        """Each slice's ids (little-endian unsigned 32-bit): the lowest, leftmost pair of each merges until none does."""
        none = np.iinfo(np.int64).max
        size = np.fromiter(map(len, slices), np.int64, len(slices))
        ids = self.single[np.frombuffer(b"".join(slices), np.uint8)]
        owner = np.repeat(np.arange(len(slices)), size)
        last = np.zeros(len(ids), bool)
        last[np.cumsum(size) - 1] = True
        rank = np.full(len(ids), none)
        rank[:-1] = np.where(last[:-1], none, self.merged(ids[:-1], ids[1:]))
        done_ids, done_owner = [], []
        while len(ids):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            low = np.minimum.reduceat(rank, first)
            count = np.diff(np.append(first, len(ids)))
            ended = np.repeat(low == none, count)
            if ended.any():
                done_ids.append(ids[ended])
                done_owner.append(owner[ended])
                go = ~ended
                ids, owner, last, rank = ids[go], owner[go], last[go], rank[go]
                if not len(ids):
                    break
                low, count = low[low != none], count[low != none]
                first = np.cumsum(count) - count
            at = np.where(rank == np.repeat(low, count), np.arange(len(ids)), none)
            at = np.minimum.reduceat(at, first)
            ids[at] = low
            last[at] = last[at + 1]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            ids, owner, last, rank = ids[keep], owner[keep], last[keep], rank[keep]
            at = moved[at]
            for i in (at, at[at > 0] - 1):
                i = i[~last[i]]
                rank[i] = self.merged(ids[i], ids[i + 1])
            rank[last] = none
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        ids = ids[order].astype("<u4").tobytes()
        cut = (np.cumsum(np.bincount(owner, minlength=len(slices))) * 4).tolist()
        return [ids[a:b] for a, b in zip([0, *cut[:-1]], cut, strict=True)]


@lru_cache(2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Encodes and decodes lists of texts; holds the cache of merged slices (at most ``cache`` of up to 64 characters)."""

    def __init__(self, path: str, cache: int = 600_000):
        self.vocabulary, self.limit, self.cache = _vocabulary(path), cache, {}

    def encode(self, rows: list[str]) -> tuple[list[bytes], np.ndarray]:
        """Of each text the ids as bytes; and of all texts' slices the first code point of each, with texts parted by one."""
        joined = "\0".join([*rows, ""])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").copy()
        ends = np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)) + 1) - 1
        points[ends] = 0x110000
        start = boundaries(points)
        upto = np.searchsorted(start, ends)
        stop = np.empty_like(start)
        stop[:-1] = start[1:]
        lasts = np.unique(upto)
        lasts = lasts[lasts > 0] - 1
        stop[lasts] = ends[np.searchsorted(ends, start[lasts])]
        words = [joined[a:b] for a, b in zip(start.tolist(), stop.tolist(), strict=True)]
        cache = self.cache
        new = list(set(words).difference(cache.keys()))
        short = [w for w in new if len(w) <= SHORT_SLICE]
        for a in range(0, len(short), 20_000):
            part = short[a : a + 20_000]
            cache.update(zip(part, self.vocabulary.merge([w.encode("utf-8", "surrogatepass") for w in part]), strict=True))
        if len(short) < len(new):
            cache.update((w, self.vocabulary.merge_long(w.encode("utf-8", "surrogatepass"))) for w in new if len(w) > SHORT_SLICE)
        found = list(map(cache.__getitem__, words))
        full = len(cache) > self.limit  # what came first stays: common slices come early
        for w in new:
            if full or len(w) > 64:
                del cache[w]
        cut = upto.tolist()
        return [b"".join(found[a:b]) for a, b in zip([0, *cut[:-1]], cut, strict=True)], start

    def offsets(self, ids: bytes) -> np.ndarray:
        """The byte at which each id starts, and the end of the last."""
        return np.concatenate([[0], np.cumsum(self.vocabulary.length[np.frombuffer(ids, "<u4")])])

    def decode(self, ids: bytes, offsets: np.ndarray, first: int = 0, last: int | None = None) -> bytes:
        """The bytes of the ids from ``first`` up to ``last``, each laid at its offset."""
        vocabulary, at = self.vocabulary, offsets[first : None if last is None else last + 1]
        number = np.frombuffer(ids, "<u4")[first:last]
        size = vocabulary.length[number]
        if len(at) != len(number) + 1 or (np.diff(at) != size).any():
            raise ValueError("the offsets aren't those of the ids")
        start = at[:-1] - at[0]
        return vocabulary.flat[np.repeat(vocabulary.begin[number] - start, size) + np.arange(int(at[-1] - at[0]))].tobytes()


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One for each worker process, so that its cache outlives a task."""
    return Encoder(path)


def encode(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """df's ``keep`` columns (default: all) with ``ids`` (binary, little-endian unsigned 32-bit) and ``offsets`` (each id's first byte, and the end)."""

    def make():
        e = encoder(path)

        def call(rows: list[str]) -> list:
            ids, _ = e.encode(rows)
            return [pa.array(ids, pa.binary()), pa.array([e.offsets(x) for x in ids], pa.list_(pa.int64()))]

        return call

    return with_columns(df, text, [T.StructField("ids", T.BinaryType()), T.StructField("offsets", T.ArrayType(T.LongType()))], make, keep)


def decode(df: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """df's ``keep`` columns (default: all) with ``decoded``: the bytes that columns ``ids`` and ``offsets`` stand for."""
    kept = [c for c in (df.columns if keep is None else keep) if c != "decoded"]
    source = df.select(*[df[c] for c in dict.fromkeys([*kept, "ids", "offsets"])])
    schema = T.StructType([*[source.schema[c] for c in kept], T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for piece in pieces(batches, "ids"):
            out = [e.decode(i or b"", np.array(at if at else [0], np.int64)) for i, at in zip(piece["ids"].to_pylist(), piece["offsets"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*[piece[c] for c in kept], pa.array(out, pa.binary())], names=schema.names)

    return source.mapInArrow(run, schema)


def op4(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")

    def make():
        e = encoder(path)

        def call(rows: list[str]) -> list:
            ids, _ = e.encode(rows)
            return [[len(x) // 4 for x in ids], [hashlib.sha256(x).hexdigest() for x in ids], [hashlib.sha256(e.decode(x, e.offsets(x))).hexdigest() for x in ids]]

        return call

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return with_columns(docs, "text", fields, make, ["doc_id"])


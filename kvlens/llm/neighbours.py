"""Approximate nearest neighbours by cosine: NN-descent and greedy graph search.

The index is a graph of distinct vectors; the ids of equal vectors ride on their
node, so copies cost nothing. Nodes are dealt to blocks of as many vectors as a
task can hold (``HELD``), and each block has a graph of its own; a table that
fits in one has one. A graph starts from random-projection trees: random
projections halve a block down to leaves that are compared within. Then rounds
of NN-descent: a node's forward and reverse neighbours (``degree`` of each at
most) bring theirs, those met over a new edge are compared with it, and the
nearest stay. A block's rounds end when less than ``ENOUGH`` of its edges are
new. Vectors and edges lie in the shared folder: a task reads its block and
writes the lists of its range of the nodes, so rounds shuffle nothing.

Each query searches each block, in a task that holds the block and a file of
queries. Its beam holds the ``beam`` nearest nodes so far, at first from its
leaves in the trees, so that parts of a graph that no edge joins are reached too,
and from its own node, where that is in the block; each hop expands the nearest of the
unexpanded ones (one in ``FRONT`` of the beam, as later finds may push the
others out), scores the neighbours it has not seen and keeps the best. It ends
when nothing is left to expand. The beam grows with the square root of the
block's nodes, and is ``BEAM`` at least. A task gives one packed row for each
query: of the beam, all nodes that could be among the nearest by the exact
score, as the error of rounding is bounded. These are then scored exactly.

The graph and the search use vectors rounded to 16 bits a component; rounding
decides only what is looked at, never a score that is returned.

Defined cases: rows whose id or vector is null, or whose vector is empty, zero
or holds null or non-finite components take no part; a row repeated with the
same id and vector counts once, and a query's own id is never its neighbour;
vectors shorter than the longest count as ending in zeros; equal scores rank by
id; an empty table, or one of a single id, gives no rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrow import each
from .storage import freed, fresh, get, put, remove, written

TREES, LEAF = 4, 1024
DEGREE, ENOUGH = 24, 0.01
BEAM, WIDER, FRONT = 208, 2.5, 4
#: Guards against a fault only: a graph that isn't settled after so many raises.
ROUNDS = 40
#: Components of a block's vectors, held by a task as floats; nodes of a file; tasks of a block's round.
HELD, PIECE, SHARES = 1 << 23, 1 << 13, 16
#: Queries of a task, between these two.
ASKED = 64, 1 << 13


def _pack(x: np.ndarray) -> pa.Array:
    """Rows as two bytes a component and a four-byte scale."""
    scale = np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-30)
    q = np.rint(x / scale * 32767).astype("<i2")
    data = np.concatenate([q.view(np.uint8), (scale / 32767).astype("<f4").view(np.uint8)], axis=1)
    return pa.array([r.tobytes() for r in data], pa.binary())


def _unpack(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of bytes as vectors, and a bound of how far rounding has moved each."""
    scale = np.ascontiguousarray(data[:, -4:]).view("<f4")
    x = np.ascontiguousarray(data[:, :-4]).view("<i2").astype(np.float32)
    x *= scale
    return x, scale[:, 0] * (math.sqrt(x.shape[1]) / 2 + 0.01)


def nodes_of(df: DataFrame, vec_id: str, vector: str, ids: int) -> DataFrame:
    """Distinct vectors: node, vec, its ``ids`` smallest ids, and unit (packed)."""
    rows = df.select(df[vec_id].cast("long").alias("id"), df[vector].cast("array<double>").alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where("id is not null and vec is not null").where(F.coalesce(fine, F.lit(False))).where(F.exists("vec", lambda x: x != 0)).distinct()
    # The limit applies before the shuffle too, so a vector with very many ids sends few.
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("rank") <= ids)
    found = ranked.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    found = written(found.select(F.monotonically_increasing_id().alias("node"), "vec", "ids"), "ann-vectors")
    dim = found.agg(F.max(F.size("vec"))).first()[0] or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.zeros((len(batch), dim))
            size = np.array([len(v) for v in batch["vec"]], np.int64)
            x[np.arange(dim) < size[:, None]] = batch["vec"].flatten().to_numpy(zero_copy_only=False)
            x /= np.abs(x).max(axis=1, keepdims=True)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            yield pa.RecordBatch.from_arrays([batch["node"], _pack(x)], names=["node", "unit"])

    freed(df.sparkSession)
    return found, found.select("node", "vec").mapInArrow(run, "node long, unit binary"), dim


def _tasks(spark: SparkSession, n: int, run: Callable[[int], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What run(i) gives for each i below n, a task each."""

    def each_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch["id"].to_pylist():
                yield from run(i)

    return spark.range(0, n, 1, max(1, n)).mapInArrow(each_task, schema)


def _stored(df: DataFrame, root: str, most: int) -> list[tuple[str, int]]:
    """Rows (node, unit) as files of at most ``most``: where each is and how many it has."""

    def save(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        node, uri = table["node"].to_numpy(), f"{root}/{uuid.uuid4().hex}"
        put(uri, [node.astype("<i8").tobytes(), b"".join(table["unit"].to_pylist())])
        return pa.RecordBatch.from_pylist([{"uri": uri, "n": len(node), "first": int(node[0])}])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while len(batch):
                held.append(batch.slice(0, most - n))
                batch = batch.slice(most - n)
                n += len(held[-1])
                if n == most:
                    yield save(held)
                    held, n = [], 0
        if held:
            yield save(held)

    files = df.select("node", "unit").mapInArrow(run, "uri string, n long, first long").collect()
    return [(r.uri, r.n) for r in sorted(files, key=lambda r: r.first)]


def _vectors(files: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of such files: nodes, their vectors and what rounding may have moved them."""
    nodes, rows = [], []
    for uri, n in files:
        raw = get(uri)
        nodes.append(np.frombuffer(raw, "<i8", n))
        rows.append(np.frombuffer(raw, np.uint8, offset=8 * n).reshape(n, -1))
    return np.concatenate(nodes), *_unpack(np.concatenate(rows))


@dataclass
class Block:
    """Files of a block's vectors, and of its edges by ranges of positions."""

    vectors: list[tuple[str, int]]
    edges: list[str] = field(default_factory=list)
    settled: bool = False

    @property
    def size(self) -> int:
        return sum(n for _, n in self.vectors)

    def ranges(self) -> list[tuple[int, int]]:
        step = max(LEAF, -(-self.size // SHARES))
        return [(a, min(a + step, self.size)) for a in range(0, self.size, step)]


def _blocks(files: list[tuple[str, int]], held: int) -> list[Block]:
    """Blocks of about equal size, ``held`` nodes each and less than a file more."""
    total = sum(n for _, n in files)
    count, out, seen = -(-total // held), [], 0
    for uri, n in files:
        if not out or len(out) < count and seen >= total * len(out) / count:
            out.append(Block([]))
        out[-1].vectors.append((uri, n))
        seen += n
    return out


Edges = tuple[np.ndarray, np.ndarray, np.ndarray]


def _edges(files: list[str], degree: int) -> Edges:
    """Neighbours (positions, -1 for none), similarities and which are new, a row for each node."""
    out = [[], [], []]
    for raw in map(get, files):
        n = len(raw) // 9
        out[0].append(np.frombuffer(raw, "<i4", n))
        out[1].append(np.frombuffer(raw, "<f4", n, offset=4 * n))
        out[2].append(np.frombuffer(raw, bool, n, offset=8 * n))
    return tuple(np.concatenate(x).reshape(-1, degree) for x in out)


def _leaves(x: np.ndarray, leaf: int, seed: int, asked: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each leaf of a tree over x: its rows, and which rows of ``asked`` would fall in it."""
    rng = np.random.default_rng(seed)
    todo = [(np.arange(len(x)), np.arange(0 if asked is None else len(asked)))]
    while todo:
        at, q = todo.pop()
        if len(at) <= leaf:
            yield at, q
            continue
        a, b = rng.choice(at, 2, replace=False)
        along = x[at] @ (x[a] - x[b])
        order = np.argsort(along, kind="stable")
        half = len(at) // 2
        left = asked[q] @ (x[a] - x[b]) < along[order[half]] if len(q) else np.zeros(0, bool)
        todo += [(at[order[:half]], q[left]), (at[order[half:]], q[~left])]


def _first(x: np.ndarray, a: int, b: int, degree: int, leaf: int) -> Edges:
    """First edges of positions a to b: the nearest within their leaves, of each tree."""
    nbr = np.full((b - a, TREES, degree), -1, np.int32)
    sim = np.full(nbr.shape, -9, np.float32)
    for t in range(TREES):
        for at, _ in _leaves(x, leaf, t + 1):
            own = at[(at >= a) & (at < b)]
            k = min(degree, len(at) - 1)
            if not len(own) or not k:
                continue
            near = x[own] @ x[at].T
            near[own[:, None] == at] = -9
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            nbr[own - a, t, :k] = at[best]
            sim[own - a, t, :k] = np.take_along_axis(near, best, 1)
    nbr, sim = nbr.reshape(b - a, -1), sim.reshape(b - a, -1)
    o = np.argsort(nbr, axis=1, kind="stable")
    nbr, sim = np.take_along_axis(nbr, o, 1), np.take_along_axis(sim, o, 1)
    again = np.zeros(nbr.shape, bool)
    again[:, 1:] = nbr[:, 1:] == nbr[:, :-1]
    nbr[again], sim[again] = -1, -9
    o = np.argsort(-sim, axis=1, kind="stable")[:, :degree]
    nbr, sim = np.take_along_axis(nbr, o, 1), np.take_along_axis(sim, o, 1)
    return nbr, sim, nbr >= 0


def _both(nbr: np.ndarray, sim: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node's forward neighbours and as many of the nearest reverse ones (-1 for none), and which are new."""
    n, degree = nbr.shape
    at, k = np.nonzero(nbr >= 0)
    to = nbr[at, k]
    # Similarities lie above -2, so the bits of 3 less one order as it does.
    key = to.astype(np.uint64) << np.uint64(32) | (np.float32(3) - sim[at, k]).view(np.uint32)
    o = np.argsort(key, kind="stable")
    to, at, young = to[o], at[o], new[at, k][o]
    rank = np.arange(len(to)) - np.searchsorted(to, np.arange(n))[to]
    few = rank < degree
    back, fresh_ = np.full((n, degree), -1, np.int32), np.zeros((n, degree), bool)
    back[to[few], rank[few]] = at[few]
    fresh_[to[few], rank[few]] = young[few]
    return np.concatenate([nbr, back], axis=1), np.concatenate([new, fresh_], axis=1)


def _descend(x: np.ndarray, edges: Edges, a: int, b: int) -> Edges:
    """A round for positions a to b: neighbours of neighbours met over a new edge, where they are nearer."""
    both, fresh_ = _both(*edges)
    nbr, sim = edges[0][a:b].copy(), edges[1][a:b].copy()
    new = np.zeros(nbr.shape, bool)
    degree = nbr.shape[1]
    for i in range(b - a):
        members, young = both[a + i], fresh_[a + i]
        old = members[~young & (members >= 0)]
        young = members[young]
        ids = np.sort(np.concatenate([young, both[young].ravel(), both[old][fresh_[old]]]))
        ids = ids[np.flatnonzero(np.diff(ids, prepend=-1))]
        ids = ids[ids >= 0]
        near = x[ids] @ x[a + i]
        good = near > sim[i, -1]
        ids, near = ids[good], near[good]
        good = ~np.isin(ids, nbr[i]) & (ids != a + i)
        if not good.any():
            continue
        ids, near = np.concatenate([nbr[i], ids[good]]), np.concatenate([sim[i], near[good]])
        best = np.lexsort((ids, -near))[:degree]
        nbr[i], sim[i], new[i] = ids[best], near[best], best >= degree
    return nbr, sim, new


def graph(units: DataFrame, dim: int, degree: int = DEGREE, rounds: int = ROUNDS, enough: float = ENOUGH, held: int = HELD, leaf: int = LEAF) -> DataFrame:
    """(node, nbrs): each node's neighbours in its block, forward and reverse. Files as ``written`` has them; ``blocks`` says what they hold."""
    spark = units.sparkSession
    root = fresh(spark, "ann-graph")
    blocks = _blocks(_stored(units, f"{root}/vectors", max(1, min(PIECE, held // dim))), max(1, held // dim))
    for turn in range(rounds + 1):
        todo = [(i, *r) for i, block in enumerate(blocks) if not block.settled for r in block.ranges()]
        if not todo:
            break

        def run(t: int, turn: int = turn, todo: list = todo) -> Iterator[pa.RecordBatch]:
            i, a, b = todo[t]
            _, x, _ = _vectors(blocks[i].vectors)
            nbr, sim, new = _descend(x, _edges(blocks[i].edges, degree), a, b) if turn else _first(x, a, b, degree, leaf)
            uri = f"{root}/edges-{turn}/{uuid.uuid4().hex}"
            put(uri, [nbr.astype("<i4").tobytes(), sim.astype("<f4").tobytes(), new.tobytes()])
            yield pa.RecordBatch.from_pylist([{"t": t, "uri": uri, "new": int(new.sum()), "all": int((nbr >= 0).sum())}])

        done = sorted(_tasks(spark, len(todo), run, "t long, uri string, new long, all long").collect())
        for i, block in enumerate(blocks):
            own = [r for r in done if todo[r.t][0] == i]
            if own:
                for path in block.edges:
                    remove(spark, path)
                block.edges = [r.uri for r in own]
                block.settled = sum(r.new for r in own) < enough * max(1, sum(r["all"] for r in own))
    if not all(block.settled for block in blocks):
        raise RuntimeError(f"graph: not settled after {rounds} rounds")
    parts = [(i, *r) for i, block in enumerate(blocks) for r in block.ranges()]

    def lists(t: int) -> Iterator[pa.RecordBatch]:
        i, a, b = parts[t]
        node = np.concatenate([np.frombuffer(get(uri), "<i8", n) for uri, n in blocks[i].vectors])
        both, _ = _both(*_edges(blocks[i].edges, degree))
        near = [node[np.unique(r[r >= 0])] for r in both[a:b]]
        yield pa.RecordBatch.from_arrays([pa.array(node[a:b]), pa.array(near, pa.list_(pa.int64()))], names=["node", "nbrs"])

    out = _tasks(spark, len(parts), lists, "node long, nbrs array<long>")
    out.written_at, out.blocks, out.degree, out.leaf = root, blocks, degree, leaf
    return out


def width(nodes: int) -> int:
    """The beam for a graph of so many nodes."""
    return max(BEAM, math.ceil(WIDER * math.sqrt(nodes)))


def _greedy(x: np.ndarray, both: np.ndarray, start: np.ndarray, v: np.ndarray, beam: int, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and similarities of the beam that a search for v from ``start`` ends with, nearest first; ``seen`` is false and is left so."""
    front = max(1, -(-beam // FRONT))
    node, sim, open_ = np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(0, bool)
    new, touched = start, []
    while True:
        seen[new] = True
        touched.append(new)
        near = x[new] @ v
        if len(node) >= beam:
            good = near >= sim[-1]
            new, near = new[good], near[good]
        node, sim, open_ = np.concatenate([node, new]), np.concatenate([sim, near]), np.concatenate([open_, np.ones(len(new), bool)])
        best = np.lexsort((node, -sim))[:beam]
        node, sim, open_ = node[best], sim[best], open_[best]
        next_ = np.flatnonzero(open_)[:front]
        if not len(next_):
            break
        open_[next_] = False
        new = both[node[next_]].ravel()
        new = np.unique(new[new >= 0])
        new = new[~seen[new]]
    seen[np.concatenate(touched)] = False
    return node, sim


def _likely(sim: np.ndarray, error: np.ndarray, keep: int | None) -> np.ndarray:
    """Which of a query's nodes may be among its ``keep`` nearest by the exact score."""
    if keep is None or len(sim) <= keep:
        return np.ones(len(sim), bool)
    least = np.partition(sim - error, len(sim) - keep)[len(sim) - keep]
    return sim + error >= least


def search(queries: DataFrame, units: DataFrame, lists: DataFrame, beam: int | None = None, keep: int | None = None) -> DataFrame:
    """Greedy search from each query node (column q) in each block: rows (q, node) of its beam, or of all that may be among its ``keep`` nearest."""
    spark, blocks, degree, leaf, root = lists.sparkSession, lists.blocks, lists.degree, lists.leaf, fresh(lists.sparkSession, "ann-asked")
    own = queries.select("q").distinct()
    each_ = min(max(ASKED[0], -(-own.count() // 24)), ASKED[1])
    asked = _stored(own.join(units, F.col("q") == F.col("node")).select("node", "unit"), root, each_)
    STATE = pa.schema([("q", pa.int64()), *((c, pa.binary()) for c in ("node", "sim", "error"))])

    def row(q: int, node: np.ndarray, sim: np.ndarray, error: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"q": q, "node": node.tobytes(), "sim": sim.tobytes(), "error": error.tobytes()}], STATE)

    def run(t: int) -> Iterator[pa.RecordBatch]:
        block = blocks[t // len(asked)]
        node, x, moved = _vectors(block.vectors)
        both, _ = _both(*_edges(block.edges, degree))
        q, v, q_moved = _vectors([asked[t % len(asked)]])
        order = np.argsort(node)
        at = order[np.minimum(np.searchsorted(node, q, sorter=order), len(node) - 1)]
        start = [[at[i : i + 1][node[at[i : i + 1]] == q[i]]] for i in range(len(q))]
        for seed in range(1, TREES + 1):
            for members, some in _leaves(x, leaf, seed, v):
                for i in some.tolist():
                    start[i].append(members)
        seen, wide = np.zeros(len(node), bool), beam or width(len(node))
        for i in range(len(q)):
            found, sim = _greedy(x, both, np.unique(np.concatenate(start[i])), v[i], wide, seen)
            error = moved[found] + q_moved[i] * (1 + moved[found]) + np.float32(1e-5)
            k = _likely(sim, error, keep)
            yield row(int(q[i]), node[found[k]], sim[k], error[k])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in each(batches, "q"):
            node, sim, error = (np.frombuffer(b"".join(table[c].to_pylist()), t) for c, t in (("node", np.int64), ("sim", np.float32), ("error", np.float32)))
            if keep is None:
                k = np.lexsort((node, -sim))[: beam or len(node)]
            else:
                k = _likely(sim, error, keep)
            yield row(table["q"][0].as_py(), node[k], sim[k], error[k])

    def beams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, raw in zip(batch["q"].to_pylist(), batch["node"].to_pylist(), strict=True):
                node = np.frombuffer(raw, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(node), q)), pa.array(node)], names=["q", "node"])

    schema = "q long, node binary, sim binary, error binary"
    state = _tasks(spark, len(blocks) * len(asked), run, schema)
    if len(blocks) > 1:
        state = state.repartition("q").sortWithinPartitions("q").mapInArrow(merge, schema)
    state = written(state, "ann-beam")
    if asked:
        remove(spark, root)
    return state.select("q", "node").mapInArrow(beams, "q long, node long")


def nearest(df: DataFrame, is_query: Callable, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", beam: int | None = None, degree: int = DEGREE, rounds: int = ROUNDS, held: int = HELD, leaf: int = LEAF) -> DataFrame:
    """For ids with is_query(column): query_id, rank, vec_id and score (cosine, double) of the k nearest found."""
    vectors, units, dim = nodes_of(df, vec_id, vector, k + 1)
    lists = graph(units, dim, degree, rounds, held=held, leaf=leaf)
    # A node that holds a query's id beyond the first k + 1 of its copies is found by its vector.
    rows = df.select(df[vec_id].cast("long").alias("query_id"), df[vector].cast("array<double>").alias("v")).where(F.col("query_id").isNotNull() & is_query(F.col("query_id"))).distinct()
    queries = written(rows.join(vectors, F.col("v") == F.col("vec")).select("query_id", F.col("node").alias("q")), "ann-asked")
    state = search(queries, units, lists, beam, k + 1)
    freed(df.sparkSession, lists)
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: F.coalesce(x, F.lit(0.0)) * F.coalesce(y, F.lit(0.0))), F.lit(0.0), lambda s, x: s + x)
    theirs = vectors.select(F.col("node").alias("n"), "vec", "ids", F.sqrt(dot("vec", "vec")).alias("norm"))
    mine = vectors.select(F.col("node").alias("m"), F.col("vec").alias("qvec"), F.sqrt(dot("vec", "vec")).alias("qnorm"))
    scored = state.select("q", "node").join(theirs, F.col("node") == F.col("n")).join(mine, F.col("q") == F.col("m"))
    scored = scored.select("q", F.explode("ids").alias("vec_id"), (dot("vec", "qvec") / (F.col("norm") * F.col("qnorm"))).alias("score"))
    order = [F.desc("score"), F.asc("vec_id")]
    few = scored.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(*order))).where(F.col("r") <= k + 1).select(F.col("q").alias("asked"), "vec_id", "score")
    found = queries.join(few, F.col("q") == F.col("asked")).where(F.col("vec_id") != F.col("query_id"))
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda c: c % 50 == 0)

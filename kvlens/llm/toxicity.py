"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word's characters pass through one such network and are pooled to a vector;
with the word's own embedding (words seen often in training have one, all others
share one) that is the input of a second one over a window of ``WINDOW`` words,
pooled to a logit. Windows overlap by half; a text is scored by all its windows,
and its score is the largest. Only texts go in.

Training takes at most ``POSITIVES`` toxic and ``NEGATIVES`` other labelled rows,
those with the smallest hash of doc_id among rows that aren't held out. A label
is of a whole text, so each round trains on the window of a toxic text that most
likely shows it (first by how unevenly its words' beginnings are spread over
labels, then by the network itself), and on random and on the highest windows of
other texts.

Defined cases: null and empty texts, and texts without a letter or digit, score
0; labels that are null count as absent; of several labels of a doc_id the
largest counts; without a toxic and a clean training row every score is 0.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import with_columns
from .resident import release, resident

WINDOW, STRIDE, LETTERS = 32, 16, 16
POSITIVES, NEGATIVES = 2000, 3000
WORDS, WORD_DIM, CHAR_DIM, CHAR_HIDDEN, HIDDEN, KEYS = 4096, 6, 8, 8, 8, 8
ROUNDS, STEPS, BATCH, RATE = 3, 110, 128, 0.01
PAD, OTHER = 0, 1


def split(text: str) -> list[str]:
    """Lower-case runs of letters and digits; longer ones than ``LETTERS`` are cut, so none is left out."""
    return _WORD(text.lower())


_WORD = re.compile(r"[^\W_]{1,%d}" % LETTERS).findall


def letters(words: list[str]) -> np.ndarray:
    """(words, LETTERS) numbers of characters, 0 after the end."""
    code = np.zeros((len(words), LETTERS), np.int64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    number = np.where((points >= 97) & (points <= 122), points - 96, 27 + points % 97)
    row = np.repeat(np.arange(len(words)), size)
    code[row, np.arange(len(points)) - np.repeat(np.cumsum(size) - size, size)] = number
    return code


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Pooled:
    """A bidirectional GRU and attention over its states. Inputs (rows, length, dim), mask (rows, length)."""

    def __init__(self, dim: int, hidden: int, keys: int, rng: np.random.Generator):
        normal = lambda *s: (rng.standard_normal(s) / math.sqrt(s[-2])).astype(np.float32)
        self.p = {"W": normal(2, dim, 3 * hidden), "b": np.zeros((2, 3 * hidden), np.float32), "U": normal(2, hidden, 3 * hidden), "A": normal(2 * hidden, keys), "a": np.zeros(keys, np.float32), "v": normal(keys, 1)[:, 0]}
        self.h = hidden

    def project(self, x: np.ndarray) -> np.ndarray:
        """What inputs add to the gates: (2, rows, 3 * hidden)."""
        return np.matmul(x[None], self.p["W"]) + self.p["b"][:, None]

    def states(self, take, length: int, rows: int, keep: bool = False):
        """States (length, rows, 2 * hidden); take(t) gives the gates' inputs of step t for both directions."""
        H, U = self.h, self.p["U"]
        h = np.zeros((2, rows, H), np.float32)
        out = np.empty((length, rows, 2 * H), np.float32)
        saved = []
        for t in range(length):
            x, a = take(t), np.matmul(h, U)
            zr = _sigmoid(x[..., : 2 * H] + a[..., : 2 * H])
            z, r = zr[..., :H], zr[..., H:]
            n = np.tanh(x[..., 2 * H :] + r * a[..., 2 * H :])
            new = n + z * (h - n)
            if keep:
                saved.append((h, z, r, n, a[..., 2 * H :]))
            h = new
            out[t, :, :H] = h[0]
            out[length - 1 - t, :, H:] = h[1]
        return (out, saved) if keep else out

    def attend(self, states: np.ndarray, mask: np.ndarray):
        """Pooled (rows, 2 * hidden), and what the gradient needs; mask (length, rows)."""
        key = np.tanh(states @ self.p["A"] + self.p["a"])
        score = np.where(mask, key @ self.p["v"], np.float32(-1e9))
        weight = np.exp(score - score.max(axis=0))
        weight /= weight.sum(axis=0)
        return np.einsum("lb,lbh->bh", weight, states), (key, weight)

    def forward(self, x: np.ndarray, mask: np.ndarray):
        rows, length, dim = x.shape
        g = self.project(x.transpose(1, 0, 2).reshape(length * rows, dim)).reshape(2, length, rows, -1)
        g[..., : self.h] += np.where(mask.T, np.float32(0), np.float32(30))[None, :, :, None]  # a padded step keeps the state
        states, saved = self.states(lambda t: np.stack([g[0, t], g[1, length - 1 - t]]), length, rows, True)
        pooled, rest = self.attend(states, mask.T)
        self.memory = (x, mask, states, saved, *rest)
        return pooled

    def backward(self, d: np.ndarray):
        """Gradients of the inputs and of the parameters from that of the pooled vectors."""
        x, _, states, saved, key, weight = self.memory
        H, p = self.h, self.p
        length, rows, _ = states.shape
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        dw = np.einsum("bh,lbh->lb", d, states)
        ds = weight * (dw - (weight * dw).sum(axis=0))
        dk = ds[..., None] * p["v"] * (1 - key**2)
        grad["v"] = np.einsum("lb,lbk->k", ds, key)
        grad["A"] = np.einsum("lbh,lbk->hk", states, dk)
        grad["a"] = dk.sum(axis=(0, 1))
        dstates = weight[..., None] * d + dk @ p["A"].T
        dh = np.zeros((2, rows, H), np.float32)
        dg = np.empty((2, length, rows, 3 * H), np.float32)
        for t in range(length - 1, -1, -1):
            h, z, r, n, an = saved[t]
            dh[0] += dstates[t, :, :H]
            dh[1] += dstates[length - 1 - t, :, H:]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * an * r * (1 - r)
            dg[0, t] = np.concatenate([dz[0], dr[0], dn[0]], axis=-1)
            dg[1, length - 1 - t] = np.concatenate([dz[1], dr[1], dn[1]], axis=-1)
            da = np.concatenate([dz, dr, dn * r], axis=-1)
            grad["U"] += np.matmul(h.transpose(0, 2, 1), da)
            dh = dh * z + np.matmul(da, p["U"].transpose(0, 2, 1))
        flat = dg.reshape(2, length * rows, 3 * H)
        xs = x.transpose(1, 0, 2).reshape(length * rows, -1)
        grad["W"] = np.matmul(xs.T[None], flat)
        grad["b"] = flat.sum(axis=1)
        dx = np.matmul(flat, p["W"].transpose(0, 2, 1)).sum(axis=0)
        return dx.reshape(length, rows, -1).transpose(1, 0, 2), grad


class Network:
    def __init__(self, vocabulary: dict[str, int], seed: int = 0):
        rng = np.random.default_rng(seed)
        self.vocabulary = vocabulary
        self.chars = Pooled(CHAR_DIM, CHAR_HIDDEN, KEYS, rng)
        self.words = Pooled(WORD_DIM + 2 * CHAR_HIDDEN, HIDDEN, KEYS, rng)
        self.p = {"letters": (rng.standard_normal((27 + 97, CHAR_DIM)) * 0.3).astype(np.float32), "words": (rng.standard_normal((len(vocabulary) + 2, WORD_DIM)) * 0.1).astype(np.float32), "out": (rng.standard_normal(2 * HIDDEN) * 0.3).astype(np.float32), "bias": np.zeros(1, np.float32)}
        self.adam: dict = {}

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.array([self.vocabulary.get(w, OTHER) for w in words], np.int64)

    def inputs(self, words: list[str]) -> np.ndarray:
        """(words, dim) inputs of the second network."""
        out = np.empty((len(words), WORD_DIM + 2 * CHAR_HIDDEN), np.float32)
        out[:, :WORD_DIM] = self.p["words"][self.numbers(words)]
        order = np.argsort(np.fromiter(map(len, words), np.int64, len(words)), kind="stable")
        for a in range(0, len(words), 4096):
            at = order[a : a + 4096]
            code = letters([words[i] for i in at.tolist()])
            length = max(1, int((code > 0).sum(axis=1).max()))
            code = code[:, :length]
            g = self.chars.project(self.p["letters"])
            g[:, 0, : self.chars.h] += 30
            states = self.chars.states(lambda t, g=g, code=code, length=length: np.stack([g[0][code[:, t]], g[1][code[:, length - 1 - t]]]), length, len(at))
            out[at, WORD_DIM:] = self.chars.attend(states, (code > 0).T)[0]
        return out

    def step(self, windows: list[list[str]], label: np.ndarray) -> float:
        known: dict[str, int] = {}
        place = np.zeros((len(windows), WINDOW), np.int64)
        mask = np.zeros((len(windows), WINDOW), bool)
        for i, w in enumerate(windows):
            place[i, : len(w)] = [known.setdefault(x, len(known)) for x in w]
            mask[i, : len(w)] = True
        unique = list(known)
        code, number = letters(unique), self.numbers(unique)
        present = code > 0
        width = max(1, int(present.sum(axis=1).max()))
        code, present = code[:, :width], present[:, :width]
        vectors = np.concatenate([self.p["words"][number], self.chars.forward(self.p["letters"][code], present)], axis=1)
        pooled = self.words.forward(vectors[place], mask)
        logit = pooled @ self.p["out"] + self.p["bias"]
        chance = _sigmoid(logit)
        d = ((chance - label) / len(label)).astype(np.float32)
        grad = {"out": pooled.T @ d, "bias": d.sum(keepdims=True)}
        dx, wgrad = self.words.backward(d[:, None] * self.p["out"])
        dv = np.zeros_like(vectors)
        np.add.at(dv, place[mask], dx[mask])
        grad["words"] = np.zeros_like(self.p["words"])
        np.add.at(grad["words"], number, dv[:, :WORD_DIM])
        dc, cgrad = self.chars.backward(dv[:, WORD_DIM:])
        grad["letters"] = np.zeros_like(self.p["letters"])
        np.add.at(grad["letters"], code[present], dc[present])
        for part, g in ((self.p, grad), (self.words.p, wgrad), (self.chars.p, cgrad)):
            for k in g:
                self._update(part, k, g[k])
        return float(-np.mean(np.where(label > 0, np.log(chance + 1e-7), np.log(1 - chance + 1e-7))))

    def _update(self, part: dict, k: str, g: np.ndarray) -> None:
        m = self.adam.setdefault((id(part), k), [np.zeros_like(g), np.zeros_like(g), 0])
        m[2] += 1
        m[0] += 0.1 * (g - m[0])
        m[1] += 0.01 * (g * g - m[1])
        part[k] -= (RATE * (m[0] / (1 - 0.9 ** m[2])) / (np.sqrt(m[1] / (1 - 0.99 ** m[2])) + 1e-8)).astype(np.float32)


class Scorer:
    """Scores lists of texts; keeps the gates' inputs of words (at most ``cache``)."""

    def __init__(self, net: Network, cache: int = 200_000):
        self.net, self.limit = net, cache
        self.known: dict[str, int] = {}
        self.gates = np.empty((0, 6 * HIDDEN), np.float32)

    def _gates(self, words: list[str]) -> np.ndarray:
        return np.concatenate(list(self.net.words.project(self.net.inputs(words))), axis=1)

    def logits(self, rows: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All windows' logits, the rows they are of, and their first words."""
        new = list(set().union(*rows).difference(self.known.keys()))
        first = len(self.known)
        self.known.update(zip(new, range(first, first + len(new)), strict=True))
        if first + len(new) > len(self.gates):
            grown = np.empty((max(2 * len(self.gates), first + len(new)), 6 * HIDDEN), np.float32)
            grown[:first] = self.gates[:first]
            self.gates = grown
        if new:
            self.gates[first : first + len(new)] = self._gates(new)
        get = self.known.__getitem__
        size = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.fromiter((x for row in rows for x in map(get, row)), np.int64, int(size.sum()))
        count = np.where(size > 0, np.maximum(1, -(-(size - (WINDOW - STRIDE)) // STRIDE)), 0)
        owner = np.repeat(np.arange(len(rows)), count)
        at = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
        begin = (np.cumsum(size) - size)[owner] + at
        left = size[owner] - at
        out = np.empty(len(owner), np.float32)
        H, H3 = HIDDEN, 3 * HIDDEN
        for a in range(0, len(owner), 2048):
            b = min(a + 2048, len(owner))
            mask = np.arange(WINDOW)[:, None] < left[a:b]
            place = flat[np.where(mask, begin[a:b] + np.arange(WINDOW)[:, None], 0)]
            g = self.gates[place]
            g[..., :H][~mask] += 30
            g[..., H3 : H3 + H][~mask] += 30
            states = self.net.words.states(lambda t, g=g: np.stack([g[t, :, :H3], g[WINDOW - 1 - t, :, H3:]]), WINDOW, b - a)
            pooled, _ = self.net.words.attend(states, mask)
            out[a:b] = pooled @ self.net.p["out"] + self.net.p["bias"]
        if len(self.known) > self.limit:
            for w in new:
                del self.known[w]
            self.gates = self.gates[: self.limit + 1].copy() if len(self.gates) > 2 * self.limit else self.gates
        return out, owner, at

    def scores(self, texts: list[str]) -> np.ndarray:
        logit, owner, _ = self.logits([split(t) for t in texts])
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, owner, logit)
        return np.where(np.isneginf(best), 0.0, 1 / (1 + np.exp(-np.clip(best, -60, 60))))


def train(texts: list[str], labels: list[int], seed: int = 0) -> Network | None:
    """A network from whole texts and their labels; None if one of the two labels is absent."""
    y = np.array(labels) > 0
    rows = [split(t) for t in texts]
    keep = [i for i, r in enumerate(rows) if r]
    rows, y = [rows[i] for i in keep], y[keep]
    if not y.any() or y.all():
        return None
    rng = np.random.default_rng(seed)
    counts, toxic, clean = Counter(), Counter(), Counter()
    for r, t in zip(rows, y, strict=True):
        (toxic if t else clean).update({p for w in set(r) for p in _beginnings(w)})
        counts.update(set(r))
    vocabulary = {w: i + 2 for i, (w, n) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:WORDS]) if n >= 3}
    n1, n0 = int(y.sum()), int((~y).sum())
    odds = {p: math.log((n + 0.5) / (n1 + 1)) - math.log((clean[p] + 0.5) / (n0 + 1)) for p, n in toxic.items() if n >= 3}
    odds = {p: x for p, x in odds.items() if x > 1}
    net = Network(vocabulary, seed)
    windows = [[r[a : a + WINDOW] for a in range(0, max(1, len(r) - (WINDOW - STRIDE)), STRIDE)] for r in rows]
    evidence = {}
    chosen = np.zeros(len(rows), np.int64)
    for i in np.flatnonzero(y).tolist():
        marks = [max((odds.get(p, 0.0) for p in _beginnings(w)), default=0.0) if w not in evidence else evidence[w] for w in rows[i]]
        evidence.update(zip(rows[i], marks, strict=True))
        chosen[i] = int(np.argmax([sum(marks[a : a + WINDOW]) for a in range(0, STRIDE * len(windows[i]), STRIDE)]))
    hard = np.array([rng.integers(len(w)) for w in windows])
    positive, negative = np.flatnonzero(y), np.flatnonzero(~y)
    for k in range(ROUNDS):
        for _ in range(STEPS):
            pos = rng.choice(positive, BATCH // 2)
            neg = rng.choice(negative, BATCH // 2)
            batch = [windows[i][chosen[i]] for i in pos]
            batch += [windows[i][hard[i] if j % 2 else rng.integers(len(windows[i]))] for j, i in enumerate(neg.tolist())]
            net.step(batch, np.repeat([1.0, 0.0], [len(pos), len(neg)]))
        logit, owner, at = Scorer(net).logits(rows)
        order = np.lexsort((at, -logit, owner))
        first = order[np.flatnonzero(np.diff(owner[order], prepend=-1))]
        best = at[first] // STRIDE
        hard = best
        chosen = np.where(y, best, 0)
    top = logit[first]
    # The cut that parts the sample's texts best becomes a chance of one half.
    cut = np.sort(top)
    middle = np.concatenate([[cut[0] - 1], (cut[1:] + cut[:-1]) / 2, [cut[-1] + 1]])
    right = np.array([((top > m) == y).mean() for m in middle[:: max(1, len(middle) // 400)]])
    tied = np.flatnonzero(right == right.max())
    net.p["bias"] -= np.float32(middle[:: max(1, len(middle) // 400)][tied[len(tied) // 2]])
    net.adam = {}
    net.words.memory = net.chars.memory = None
    return net


def _beginnings(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in (4, 5, 6) if len(word) > n)]


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> Network | None:
    """Trains on a bounded sample of labelled rows that aren't held out."""
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("h", F.xxhash64("doc_id"))
    pick = [known.where(w).orderBy("h", "doc_id").limit(n).select("doc_id", "toxic").collect() for w, n in (("toxic > 0", positives), ("toxic <= 0", negatives))]
    chosen = [tuple(r) for part in pick for r in part]  # at most positives + negatives rows
    spark = documents.sparkSession
    if not all(pick):
        return None
    field = documents.schema["doc_id"]
    small = spark.createDataFrame(chosen, T.StructType([T.StructField("d", field.dataType), T.StructField("toxic", T.LongType())]))
    rows = documents.select("doc_id", "text").join(F.broadcast(small), F.col("doc_id") == F.col("d")).select("doc_id", "toxic", F.coalesce("text", F.lit("")).alias("text"))
    # One task trains on the sample, which has a bound; only the network comes to the driver.
    return pickle.loads(rows.repartition(1).mapInArrow(_trained, "net binary").first()[0])


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    rows = sorted(r for b in batches for r in zip(*(b[c].to_pylist() for c in ("doc_id", "toxic", "text")), strict=True))
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train([r[2] for r in rows], [r[1] for r in rows]))], pa.binary())], names=["net"])


def score(df: DataFrame, net: Network | None, text: str = "text", keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """df's ``keep`` columns (default: all) with the score of each whole text."""
    shared = df.sparkSession.sparkContext.broadcast(net)

    def make():
        scorer = _scorer(shared)
        return lambda rows: [scorer.scores(rows) if scorer else np.zeros(len(rows))]

    return with_columns(df, text, [T.StructField(name, T.DoubleType())], make, keep, 1 << 19)


def _scorer(shared) -> Scorer | None:
    """One for each worker process and network, so that its cache outlives a task."""
    key = getattr(shared, "_path", None) or id(shared)
    return resident(("toxicity", key), lambda: Scorer(shared.value) if shared.value is not None else None)


def op2(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    net = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, net, keep=["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))

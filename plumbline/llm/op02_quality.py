"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are embedded, learned filters slide over all of them (width WIDTH, step STEP), their rectified
answers are averaged and max-pooled in half chunks of CHUNK / 2 bytes; each chunk joins two neighbouring halves, so
chunks overlap by half and cover the whole text. A learned layer describes each chunk, its answers are max-pooled and
averaged over all chunks, and combined into one probability. Training (Adam, in one task) uses a bounded sample of
labelled texts; scoring is one pass over all texts in Arrow batches, in blocks of bounded memory.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import key_crc, text_buffers

WIDTH, STEP, DIM, FILTERS, HIDDEN = 6, 2, 6, 16, 16
HALF = 128  # bytes in half a chunk
PER_HALF = HALF // STEP
#: Labelled texts that training uses at most, each whole.
MAX_TRAIN = 3000
THRESHOLD = 0.3


def _halves(raw: np.ndarray) -> np.ndarray:
    """A text as rows of HALF + WIDTH bytes (two rows at least), each with the first bytes of the next; 0 fills the end."""
    k = max(2, -(-len(raw) // HALF))
    pad = np.zeros(k * HALF + WIDTH, np.uint8)
    pad[: len(raw)] = raw
    return np.lib.stride_tricks.as_strided(pad, (k, HALF + WIDTH), (HALF, 1))


class Net:
    """The network's weights, its forward pass and its gradients."""

    names = ("E", "W", "b", "V", "c", "u", "o")

    def __init__(self, seed: int = 0):
        r = np.random.default_rng(seed)
        f = np.float32
        self.E = r.normal(0, 0.5, (256, DIM)).astype(f)
        self.W = (r.normal(0, 1, (WIDTH * DIM, FILTERS)) / np.sqrt(WIDTH * DIM / 2)).astype(f)
        self.b = np.zeros(FILTERS, f)
        self.V = (r.normal(0, 1, (2 * FILTERS, HIDDEN)) / np.sqrt(FILTERS)).astype(f)
        self.c = np.zeros(HIDDEN, f)
        self.u = (r.normal(0, 1, 2 * HIDDEN) / np.sqrt(HIDDEN)).astype(f)
        self.o = np.zeros(1, f)

    def state(self) -> list[np.ndarray]:
        return [getattr(self, k) for k in self.names]

    @classmethod
    def of(cls, state: list[np.ndarray]) -> "Net":
        net = cls.__new__(cls)
        for k, v in zip(cls.names, state):
            setattr(net, k, v)
        return net

    def _conv(self, halves: np.ndarray):
        x = self.E[halves].reshape(len(halves), -1)  # rows of (HALF + WIDTH) * DIM
        win = np.lib.stride_tricks.as_strided(x, (len(halves), PER_HALF, WIDTH * DIM), (x.strides[0], STEP * DIM * 4, 4))
        win = np.ascontiguousarray(win).reshape(-1, WIDTH * DIM)
        z = win @ self.W
        z += self.b
        np.maximum(z, 0, out=z)
        return win, z.reshape(len(halves), PER_HALF, FILTERS)

    def pooled(self, halves: np.ndarray, block: int = 1024) -> np.ndarray:
        """Mean and maximum of the filters in each half chunk, in blocks."""
        out = np.empty((len(halves), 2 * FILTERS), np.float32)
        for i in range(0, len(halves), block):
            _, z = self._conv(halves[i : i + block])
            out[i : i + block, :FILTERS] = z.mean(axis=1)
            out[i : i + block, FILTERS:] = z.max(axis=1)
        return out

    def score(self, halves: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Probabilities of texts whose half chunks are halves[at[i]:at[i + 1]]."""
        p = self.pooled(halves)
        chunks, first = _chunks(p, at)
        h = np.maximum(chunks @ self.V + self.c, 0)
        n = np.diff(np.append(first, len(h)))
        d = np.hstack([np.maximum.reduceat(h, first), np.add.reduceat(h, first) / n[:, None]])
        return 1 / (1 + np.exp(-np.clip(d @ self.u + self.o, -30, 30).astype(np.float64)))

    def gradients(self, halves: np.ndarray, at: np.ndarray, y: np.ndarray, block: int = 1024):
        """Gradients of the loss over whole texts. Filters' answers are kept for one block of half chunks at a time and
        made again on the way back, so a long text costs time, not memory."""
        p = self.pooled(halves, block)
        chunks, first = _chunks(p, at)
        h = np.maximum(chunks @ self.V + self.c, 0)
        n = np.diff(np.append(first, len(h)))
        top = np.maximum.reduceat(h, first)
        d = np.hstack([top, np.add.reduceat(h, first) / n[:, None]])
        prob = 1 / (1 + np.exp(-np.clip(d @ self.u + self.o, -30, 30)))
        g = ((prob - y) / len(y)).astype(np.float32)
        grads = {"u": d.T @ g, "o": g.sum(keepdims=True)}
        gd = g[:, None] * self.u[None, :]
        own = np.repeat(np.arange(len(y)), n)
        is_top = h == top[own]
        share = np.add.reduceat(is_top.astype(np.float32), first)
        gh = is_top * (gd[:, :HIDDEN] / share)[own] + (gd[:, HIDDEN:] / n[:, None])[own]
        gh *= h > 0
        grads |= {"V": chunks.T @ gh, "c": gh.sum(axis=0)}
        gc = gh @ self.V.T
        gp = np.zeros((len(halves), 2 * FILTERS), np.float32)
        pick, wins = _sources(p, at)
        gp[pick] += np.hstack([gc[:, :FILTERS] * 0.5, gc[:, FILTERS:] * (1 - wins)])
        gp[pick + 1] += np.hstack([gc[:, :FILTERS] * 0.5, gc[:, FILTERS:] * wins])
        gW, gb, ge = np.zeros_like(self.W), np.zeros_like(self.b), np.zeros((256, DIM), np.float32)
        for i in range(0, len(halves), block):
            part, gpart = halves[i : i + block], gp[i : i + block]
            win, z = self._conv(part)
            arg = z.argmax(axis=1)
            gz = np.repeat(gpart[:, None, :FILTERS] / PER_HALF, PER_HALF, axis=1)
            old = np.take_along_axis(gz, arg[:, None, :], 1)
            np.put_along_axis(gz, arg[:, None, :], old + gpart[:, None, FILTERS:], 1)
            gz *= z > 0
            gz = gz.reshape(-1, FILTERS)
            gW += win.T @ gz
            gb += gz.sum(axis=0)
            gw = (gz @ self.W.T).reshape(len(part), PER_HALF, WIDTH, DIM)
            for j in range(WIDTH):
                byte = part[:, j : j + STEP * PER_HALF : STEP].ravel()
                for q in range(DIM):
                    ge[:, q] += np.bincount(byte, gw[:, :, j, q].ravel(), 256).astype(np.float32)
        grads |= {"W": gW, "b": gb, "E": ge}
        loss = -np.mean(y * np.log(prob + 1e-7) + (1 - y) * np.log(1 - prob + 1e-7))
        return grads, loss


def _sources(p: np.ndarray, at: np.ndarray):
    """For each chunk the index of its first half, and which maxima come from its second."""
    last = np.zeros(len(p), bool)
    last[np.append(at[1:], len(p)) - 1] = True
    pick = np.flatnonzero(~last)
    return pick, (p[pick + 1, FILTERS:] > p[pick, FILTERS:]).astype(np.float32)


def _chunks(p: np.ndarray, at: np.ndarray):
    """Chunks of two neighbouring halves of one text, and where each text's begin. at: where its halves begin."""
    last = np.zeros(len(p), bool)
    last[np.append(at[1:], len(p)) - 1] = True
    pick = np.flatnonzero(~last)
    out = np.hstack([(p[pick, :FILTERS] + p[pick + 1, :FILTERS]) / 2, np.maximum(p[pick, FILTERS:], p[pick + 1, FILTERS:])])
    return out, at - np.arange(len(at))


def train(texts: list[bytes], labels: np.ndarray, epochs: int = 10, batch: int = 32, rate: float = 3e-3, seed: int = 0) -> list[np.ndarray]:
    """Weights fitted by Adam on whole texts; classes weigh as they occur, so that scores are probabilities. A tenth of the
    texts, taken at random, chooses the epoch whose weights are returned."""
    net, r = Net(seed), np.random.default_rng(seed + 1)
    if len(texts) == 0 or len(set(labels.tolist())) < 2:
        rate_1 = (float(np.sum(labels)) + 1) / (len(labels) + 2)
        net.u[:] = 0
        net.o[:] = np.log(rate_1 / (1 - rate_1))
        return net.state()
    rows = [_halves(np.frombuffer(t, np.uint8)) for t in texts]
    m = {k: np.zeros_like(v) for k, v in zip(net.names, net.state())}
    v2 = {k: np.zeros_like(v) for k, v in m.items()}
    best, at_best = None, np.inf
    held = r.random(len(rows)) < 0.1
    fit, check = np.flatnonzero(~held), np.flatnonzero(held)
    step, steps = 0, max(1, epochs * -(-len(fit) // batch))
    for _ in range(epochs):
        order = r.permutation(fit)
        for i in range(0, len(order), batch):
            own = order[i : i + batch]
            parts = [rows[j] for j in own]
            at = np.concatenate(([0], np.cumsum([len(x) for x in parts])[:-1]))
            grads, _ = net.gradients(np.concatenate(parts), at, labels[own].astype(np.float32))
            step += 1
            now = rate * 0.5 * (1 + np.cos(np.pi * step / steps)) + 1e-5
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v2[k] = 0.999 * v2[k] + 0.001 * g * g
                getattr(net, k)[...] -= (now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        if len(check):
            p = np.concatenate([net.score(rows[j], np.array([0])) for j in check])
            y = labels[check]
            loss = -np.mean(y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))
            if loss < at_best:
                best, at_best = [x.copy() for x in net.state()], loss
    return best or net.state()


def fit_quality(docs: DataFrame, labels: DataFrame, learn_from, max_train: int = MAX_TRAIN) -> list[np.ndarray]:
    """Weights learned from max_train labelled texts at most, taken in the order of a hash of doc_id. learn_from: a
    Column on doc_id that says which rows may be learned from. A document labelled more than once counts with its
    lowest label; labels other than 0 and 1, null labels and null ids don't count; null texts count as empty. Rare labels: half of the sample's
    places go to each, as far as it has rows, and scores are then shifted back to the true rates."""
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("y"))
    known = known.where(learn_from)
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return train([], np.zeros(0))
    half = max_train // 2
    take = {y: min(n, max(half, max_train - sum(min(c, half) for z, c in counts.items() if z != y))) for y, n in counts.items()}
    parts = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in take.items()]
    chosen = parts[0]
    for p in parts[1:]:
        chosen = chosen.unionByName(p)
    got = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text")
    rows = got.groupBy("doc_id").agg(F.first("y").alias("y"), F.max("text").alias("text")).repartition(1).sortWithinPartitions("doc_id")

    def fit(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts, y = [], []
        for p in parts:
            texts += [t.encode() for t in p["text"]]
            y += p["y"].tolist()
        yield pd.DataFrame({"state": [pickle.dumps(train(texts, np.array(y, np.float64)))], "good": [sum(y)], "n": [len(y)]})

    got = rows.mapInPandas(fit, "state binary, good long, n long").first()  # in a task: no text comes to the driver
    if got is None:
        return train([], np.zeros(0))
    state, good, n = pickle.loads(got["state"]), got["good"], got["n"]
    if len(counts) == 2 and 0 < good < n:
        state[-1] = (state[-1] + np.log(counts[1] / counts[0]) - np.log(good / (n - good))).astype(np.float32)
    return state


def quality_scores(docs: DataFrame, state: list[np.ndarray], threshold: float = THRESHOLD) -> DataFrame:
    """docs with score (double, 0 to 1; the whole text decides) and predicted (1 if score >= threshold, else 0).
    Null and empty texts get the score of an empty text. All columns of docs stay; score and predicted replace columns
    of those names. Repeated rows are scored alike; an empty table gives no rows."""

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import pyarrow as pa

        net = Net.of(state)
        for s in parts:
            raw, start, end = text_buffers(pa.array(s, pa.large_string(), from_pandas=True))
            out, i = np.empty(len(s)), 0
            while i < len(s):
                j, size, rows = i, 0, []
                while j < len(s) and (size < 1 << 20 or j == i):
                    rows.append(_halves(raw[start[j] : end[j]]))
                    size += end[j] - start[j] + 2 * HALF
                    j += 1
                at = np.concatenate(([0], np.cumsum([len(x) for x in rows])[:-1]))
                out[i:j] = net.score(np.concatenate(rows), at)
                i = j
            yield pd.Series(out)

    return docs.withColumn("score", score(F.col("text").cast("string"))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    state = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), key_crc(F.col("doc_id"), 5) != 0)
    out = quality_scores(docs, state)
    return out.select("doc_id", F.coalesce(key_crc(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")

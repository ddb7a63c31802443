"""Embedding near-dedup by a forest of random-projection trees.

Trees are fitted on a bounded sample of vectors: each node draws a direction and splits at the sample's median of the
projections; a vector within SPILL of the split goes down both sides. Leaves that hold many vectors of the whole table are split
on, by medians that further samples of each such leaf give, so leaves keep their size however long the table is. All
vectors are sent down all trees, and vectors of one label that share a leaf are compared in double precision. Vectors
with equal components form one class with one member in the trees; their links are counted, not made.

Each vector is shipped once for each of its leaves, in the type that it is stored in. A pair that shares several leaves is
counted in the first. A leaf returns, for each vector, the number of its links and one link of a spanning forest: a group of near
copies of any size costs its vectors, not its pairs. Leaves over BLOCK vectors (as large groups of near copies, which no
split parts) are compared block against block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import connected_components, maybe_broadcast, roots, written

TREES, SPILL, LEAF, SAMPLE, BLOCK = 6, 0.01, 400, 20_000, 512
#: Bytes of the sample that trees are fitted on; vectors looked at for a split within a leaf; splits within a leaf at most.
SAMPLE_BYTES, LEAF_SAMPLE, MAX_SPLITS = 1 << 26, 512, 20
#: Bytes of one step's work in a Python worker. Only speed and memory depend on it.
WORK = 1 << 22
#: Leaf sizes that are looked up by broadcast.
MAX_BROADCAST_ROWS = 100_000
COSINE = 0.98


def _cut(p: np.ndarray) -> float | None:
    """Where projections p are split: at the median, unless more than half of them would go both ways."""
    cut = float(np.median(p))
    left = p < cut
    return cut if 0 < left.sum() < len(p) and (np.abs(p - cut) <= SPILL).mean() <= 0.5 else None


def _directions(r: np.random.Generator, n: int, dims: int) -> np.ndarray:
    d = r.normal(size=(n, dims))
    return d / np.linalg.norm(d, axis=1, keepdims=True)


def fit_forest(sample: np.ndarray, total: int, trees: int, leaf: int, seed: int = 5) -> list[dict]:
    """Trees over unit vectors: arrays of directions, thresholds and children (negative: a leaf's number); `more` are the
    directions of splits within leaves and `cells` their thresholds, by leaf."""
    forest = []
    least = max(8, leaf * max(1, len(sample)) // max(1, total))  # a leaf's share of the sample
    for t in range(trees):
        r = np.random.default_rng([seed, t])
        tree = {"dir": [], "at": [], "kids": [], "leaves": 0}

        def grow(rows: np.ndarray, depth: int) -> int:
            if len(rows) > least and depth < 40:
                for d in _directions(r, 3, sample.shape[1]):
                    p = sample[rows] @ d
                    cut = _cut(p)
                    if cut is not None:
                        me = len(tree["at"])
                        tree["dir"].append(d)
                        tree["at"].append(cut)
                        tree["kids"].append([0, 0])
                        tree["kids"][me] = [grow(rows[p < cut], depth + 1), grow(rows[p >= cut], depth + 1)]
                        return me
            tree["leaves"] += 1
            return -tree["leaves"]

        tree["root"] = grow(np.arange(len(sample)), 0)
        forest.append({"dir": np.array(tree["dir"]), "at": np.array(tree["at"]), "kids": np.array(tree["kids"], np.int64).reshape(-1, 2), "root": tree["root"], "more": _directions(r, MAX_SPLITS, sample.shape[1]), "cells": {}})
    return forest


def leaves(tree: dict, x: np.ndarray, spill: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) for all leaves that each unit vector of x reaches; a leaf that is split on is a number for each cell."""
    rows, nodes, out = np.arange(len(x)), np.full(len(x), tree["root"], np.int64), []
    while len(rows):
        end = nodes < 0
        if end.any():
            out.append((rows[end], -nodes[end]))
            rows, nodes = rows[~end], nodes[~end]
            continue
        far = np.einsum("ij,ij->i", x[rows], tree["dir"][nodes]) - tree["at"][nodes]
        a, b = far < spill, far >= -spill
        rows, nodes = np.concatenate((rows[a], rows[b])), np.concatenate((tree["kids"][nodes[a], 0], tree["kids"][nodes[b], 1]))
    rows, to = (np.concatenate([o[i] for o in out]) if out else np.empty(0, np.int64) for i in (0, 1))
    to <<= MAX_SPLITS
    if tree["cells"]:
        new = [(rows, to)] if not len(to) else []
        order = np.argsort(to, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(to[order])) + 1) if len(to) else []:
            r, c = rows[part], to[part]
            for level, at in enumerate(tree["cells"].get(int(c[0] >> MAX_SPLITS), ())):
                if np.isfinite(at):
                    far = x[r] @ tree["more"][level] - at
                    a, b = far < spill, far >= -spill
                    r, c = np.concatenate((r[a], r[b])), np.concatenate((c[a], c[b] | (1 << level)))
            new.append((r, c))
        rows, to = (np.concatenate([n[i] for n in new]) for i in (0, 1))
    return rows, to


def unit(x: np.ndarray) -> np.ndarray:
    """Rows as unit vectors in double precision; by their largest component first, so that no square is lost."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def linked(x: np.ndarray, y: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(row of x, row of y) whose cosine is `cosine` or more; where a matrix product is too near to say, by its own sum."""
    g = x @ y.T
    r, c = np.nonzero(g >= cosine - 1e-9)
    close = np.flatnonzero(g[r, c] < cosine + 1e-9)
    keep = np.ones(len(r), bool)
    keep[close] = np.einsum("ij,ij->i", x[r[close]], y[c[close]]) >= cosine
    return r[keep], c[keep]


def _padded(codes: pd.Series, below: int, blank: int) -> np.ndarray:
    """The sorted codes of each row that are less than `below`, in a rectangle filled with blank."""
    lists = [np.frombuffer(c, np.int64) for c in codes]
    out = np.full((len(lists), max(map(len, lists))), blank, np.int64)
    for row, c in zip(out, lists):
        row[: len(c)] = np.where(c < below, c, blank)
    return out


def _new(done: np.ndarray, r: np.ndarray, c: np.ndarray):
    """Those pairs (r, c) that share no code of done (-1: none), in blocks of WORK bytes: a table's vectors have the more leaves
    the longer it is."""
    step = max(1, WORK // max(1, done.shape[1]) ** 2)
    for k in range(0, len(r), step):
        a, b = r[k : k + step], c[k : k + step]
        new = ~((done[a][:, :, None] == done[b][:, None, :]) & (done[a] >= 0)[:, :, None]).any(axis=(1, 2))
        yield a[new], b[new]


def _parts(parts, width: int):
    """Batches cut into pieces of WORK bytes at most, width bytes a row, so that long vectors don't fill a worker's memory."""
    step = max(1, WORK // width)
    for p in parts:
        for i in range(0, len(p), step):
            yield p.iloc[i : i + step].reset_index(drop=True)


def similar_vectors(rows: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, sample_rows: int = SAMPLE, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per row of rows: id_col, n_links, component_id, kept.

    Vectors are linked if their labels are equal and not null and their cosine in double precision is `cosine` or more;
    the forest finds nearly all such pairs (see the README for the measured recall), and equal vectors always. Vectors
    that are null, empty, zero or hold null or non-finite components link with nothing, and vectors of different length
    neither. Null ids: no links, a null component, kept. Repeated rows (one id more than once, with equal vectors) are
    each returned; an id links not with itself. Empty tables: no rows. Other columns are ignored."""
    spark = rows.sparkSession
    single = isinstance(rows.schema[vec_col].dataType.elementType, T.FloatType)
    all_rows = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<float>" if single else "array<double>").alias("v"))
    good = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(F.size("v") > 0, F.lit(False))
    good = good & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0)
    known = all_rows.withColumn("ok", F.coalesce(good, F.lit(False)))
    # -0.0 + 0.0 is 0.0: equal vectors get equal keys.
    key = F.md5(F.concat_ws(",", F.transform("v", lambda c: (c + F.lit(0.0)).cast("string"))).cast("binary"))
    known = written(known.select("id", "label", F.when(F.col("ok"), F.concat(F.col("label").cast("string"), F.lit(":"), key)).alias("key"), F.when(F.col("ok"), F.col("v")).alias("v")), "vectors")
    ids = known.where("key is not null").select("key", "id", "label", "v").dropDuplicates(["key", "id"])
    classes = ids.groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("size"), F.first("label").alias("label"), F.first("v").alias("v"))
    # From here on a class is a number, whatever its id is.
    classes = written(classes.select(F.monotonically_increasing_id().alias("node"), "*"), "classes")

    dims = [r["d"] for r in classes.select(F.size("v").alias("d")).distinct().orderBy("d").collect()]
    found = spark.createDataFrame([], "node long, others long, top long")
    for d in dims:
        found = found.unionByName(_found(classes.where(F.size("v") == d), d, np.float32 if single else np.float64, cosine, trees, leaf, sample_rows))
    found = written(found, "found")
    comp = connected_components(found.select(F.col("node").alias("a"), F.col("top").alias("b")).where("a <> b").distinct())
    near = found.groupBy("node").agg(F.sum("others").alias("others"))
    named = classes.select("node", "key", "rep", "size").join(near, "node", "left").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("rep").alias("least"))
    named = named.join(least, "component").select("key", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "least")
    out = known.select("id", "key").join(named, "key", "left")
    component = F.coalesce("least", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.cast("long").alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _sampled(classes: DataFrame, rows: int, total: int) -> DataFrame:
    """About `rows` of total classes, by their keys' hashes."""
    return classes.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < min(1 << 30, (1 << 30) * rows // max(1, total)))


def _split_leaves(classes: DataFrame, forest: list[dict], total: int, leaf: int) -> None:
    """Adds to the forest the cells of leaves that hold over 4 * leaf vectors. What comes to the driver is a few numbers
    for each leaf of the trees, whose number the sample bounds."""

    width = 8 * forest[0]["more"].shape[1]

    def count(parts):
        for p in _parts(parts, width):
            x = unit(np.array(p["v"].tolist()))
            for t, tree in enumerate(forest):
                to, n = np.unique(leaves(tree, x, SPILL)[1] >> MAX_SPLITS, return_counts=True)
                yield pd.DataFrame({"tree": np.full(len(to), t, np.int32), "leaf": to, "n": n})

    large = classes.select("v").mapInPandas(count, "tree int, leaf long, n long").groupBy("tree", "leaf").agg(F.sum("n").alias("n")).where(F.col("n") > 4 * leaf).collect()
    if not large:
        return
    splits = {(r.tree, r.leaf): min(MAX_SPLITS, int(np.ceil(np.log2(r.n / leaf)))) for r in large}
    share = max(LEAF_SAMPLE / min(r.n for r in large), 1e-9)

    def project(parts):
        for p in _parts(parts, width):
            x = unit(np.array(p["v"].tolist()))
            for t, tree in enumerate(forest):
                at, to = leaves(tree, x, SPILL)
                to >>= MAX_SPLITS
                own = np.array([(t, k) in splits for k in to.tolist()], bool)
                if own.any():  # Arrow takes no list column without rows
                    yield pd.DataFrame({"tree": np.full(int(own.sum()), t, np.int32), "leaf": to[own], "p": list(x[at[own]] @ tree["more"].T)})

    def cuts(p: pd.DataFrame) -> pd.DataFrame:
        t, k = int(p["tree"].iloc[0]), int(p["leaf"].iloc[0])
        x = np.stack(p["p"].tolist())
        at = [_cut(x[:, level]) for level in range(splits[t, k])]
        return pd.DataFrame({"tree": [t], "leaf": [k], "at": [[np.inf if a is None else a for a in at]]})

    rows = _sampled(classes, int(total * min(1.0, share)) + 1, total).select("v").mapInPandas(project, "tree int, leaf long, p array<double>")
    for r in rows.groupBy("tree", "leaf").applyInPandas(cuts, "tree int, leaf long, at array<double>").collect():
        forest[r.tree]["cells"][r.leaf] = r.at


def _found(classes: DataFrame, dims: int, kind: type, cosine: float, trees: int, leaf: int, sample_rows: int) -> DataFrame:
    """For classes (node, key, size, label, v) of one length, rows (node, others, top): links of node that were first found
    in some leaf, counted in vectors, and a node that they join it to."""
    total = classes.count()
    most = min(sample_rows, max(100, SAMPLE_BYTES // (8 * dims)))
    sample = _sampled(classes, most + most // 8 + 100, total).orderBy(F.xxhash64("key")).limit(most).select("v").toPandas()
    forest = fit_forest(unit(np.array(sample["v"].tolist())), total, trees, leaf)
    _split_leaves(classes, forest, total, leaf)

    def descend(parts):
        for p in _parts(parts, 8 * dims):
            raw = np.array(p["v"].tolist(), kind)
            x = unit(raw)
            down = [leaves(tree, x, SPILL) for tree in forest]
            at = np.concatenate([a for a, _ in down])
            code = np.concatenate([to | t << 56 for t, (_, to) in enumerate(down)])
            order = np.lexsort((code, at))
            at, code = at[order], code[order]
            ends = np.searchsorted(at, np.arange(len(raw) + 1)).tolist()
            codes, raw = [code[a:b].tobytes() for a, b in zip(ends, ends[1:])], [r.tobytes() for r in raw]
            yield pd.DataFrame({"label": p["label"].to_numpy()[at], "code": code, "node": p["node"].to_numpy()[at], "size": p["size"].to_numpy()[at], "raw": [raw[i] for i in at], "codes": [codes[i] for i in at]})

    group = [T.StructField("label", classes.schema["label"].dataType), T.StructField("code", T.LongType())]
    posted = T.StructType([*group, T.StructField("node", T.LongType()), T.StructField("size", T.LongType()), T.StructField("raw", T.BinaryType()), T.StructField("codes", T.BinaryType())])

    def tally(parts):
        for p in descend(parts):
            yield p.groupby(["label", "code"], as_index=False).agg(n=("node", "size"))

    sent = classes.select("label", "node", "size", "v")
    sizes = sent.mapInPandas(tally, T.StructType([*group, T.StructField("n", T.LongType())])).groupBy("label", "code").agg(F.sum("n").alias("n")).where("n > 1")
    sizes = written(sizes.select("label", "code", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "leaves")
    rows = sent.mapInPandas(descend, posted).join(maybe_broadcast(sizes, MAX_BROADCAST_ROWS), ["label", "code"])
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # Every pair of blocks meets in one group: block i goes to (i, j) for all j.
    pairs = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.select("label", "code", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "size", "raw", "codes")

    def compare(p: pd.DataFrame) -> pd.DataFrame:
        i, j, code = int(p["i"].iloc[0]), int(p["j"].iloc[0]), int(p["code"].iloc[0])
        p = p.sort_values("block", kind="stable")
        n = int((p["block"] == i).sum())
        x = unit(np.frombuffer(b"".join(p["raw"]), kind).reshape(len(p), -1))
        first = 0 if i == j else n
        done = _padded(p["codes"], code, -1)
        size, others, ends = p["size"].to_numpy(), np.zeros(len(p), np.int64), []
        for s in range(0, n, 256):
            r, c = linked(x[s : min(n, s + 256)], x[first:], cosine)
            r, c = r + s, c + first
            if i == j:
                r, c = r[r < c], c[r < c]
            for a, b in _new(done, r, c):
                np.add.at(others, a, size[b])
                np.add.at(others, b, size[a])
                top = roots(a, b, len(p))
                own = np.flatnonzero(top != np.arange(len(p)))
                ends.append((own, top[own]))
        a, b = (np.concatenate([e[q] for e in ends] or [np.empty(0, np.int64)]) for q in (0, 1))
        top, seen, node = roots(a, b, len(p)), others > 0, p["node"].to_numpy()
        return pd.DataFrame({"node": node[seen], "others": others[seen], "top": node[top[seen]]})

    return pairs.groupBy("label", "code", "i", "j").applyInPandas(compare, "node long, others long, top long")


def op5_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

"""Shared pieces: written stages, connected components, word shingles in numpy, native word columns."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------- written stages


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where that is unset, a temporary one, but only if the
    session's executors are in this process (local masters, as in tests); on a cluster a machine's own folder would hold
    a part of each table only, so it is refused."""
    conf = spark.sparkContext.getConf()
    where = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if not conf.get("spark.master", "local").startswith("local") or conf.get("spark.master", "").startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = getattr(spark.sparkContext, "_plumbline_dir", None)
    if own is None:
        own = spark.sparkContext._plumbline_dir = "file://" + tempfile.mkdtemp(prefix="plumbline-")
        atexit.register(__import__("shutil").rmtree, own[len("file://"):], True)
    return own


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/plumbline-{name}-{uuid.uuid4().hex}"


_scopes: list[list[DataFrame]] = []


@contextmanager
def scratch():
    """Deletes the tables that written() makes within, but for kept ones: what comes out of the block must be written with
    keep=True, or collected, before its end."""
    _scopes.append([])
    try:
        yield
    finally:
        for df in _scopes.pop():
            discard(df)


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """The rows of df as a Parquet table in the shared folder: cuts lineage, survives lost executors. The table stays until
    discard(), or the end of the scratch() block around it unless keep is true."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._plumbline_path = path
    if _scopes and not keep:
        _scopes[-1].append(out)
    return out


def discard(df: DataFrame) -> None:
    """Deletes a table made by written() that nothing reads any more."""
    path = getattr(df, "_plumbline_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def small_enough(df: DataFrame, max_rows: int) -> bool:
    """Whether df has max_rows rows at most; stops counting beyond that."""
    return df.limit(max_rows + 1).count() <= max_rows


def dealt(df: DataFrame) -> DataFrame:
    """df marked for a shuffled join, on either side. Spark sizes a table by its files, an array as one element and what explode
    makes of it as one row, so a join left to Spark may broadcast many times what it takes a side for."""
    return df.hint("merge")


def maybe_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """df marked for broadcast if a count proves that it has max_rows rows at most; else for a shuffled join."""
    return F.broadcast(df) if small_enough(df, max_rows) else dealt(df)


def key_crc(doc_id: Column, mod: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(mod)


def let(value: Column, use) -> Column:
    """use(value) with value computed once: as a lambda's variable, it can't be inlined into a loop over an array."""
    return F.element_at(F.transform(F.array(value), use), 1)


# ---------------------------------------------------------------- connected components


#: Links that one task resolves at most (32 MB as pairs of longs); more take rounds of joins. Only speed depends on it.
LOCAL_LINKS = 1 << 21


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the smallest node that links (a, b) reach: roots hook to smaller ones, then all paths are cut."""
    p = np.arange(n)
    while True:
        x, y = p[a], p[b]
        open_ = x != y
        if not open_.any():
            return p
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(p, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(q := p[p], p):
            p = q


def _resolve(batches):
    import pyarrow as pa

    batches = list(batches)
    ends = [np.concatenate([b.column(i).to_numpy() for b in batches] or [np.empty(0, np.int64)]) for i in (0, 1)]
    nodes, at = np.unique(np.concatenate(ends), return_inverse=True)
    top = roots(at[: len(ends[0])], at[len(ends[0]) :], len(nodes))
    for i in range(0, len(nodes), 1 << 16):
        part = slice(i, i + (1 << 16))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[part]), pa.array(nodes[top[part]])], names=["node", "component"])


def connected_components(edges: DataFrame, local_links: int = LOCAL_LINKS) -> DataFrame:
    """(node, component) for each node of edges (a, b), which are longs: component is the smallest node reachable.

    A written table of local_links rows at most, by its count, is resolved in one task. Beyond that, alternating
    large-star and small-star steps: each is a map-side combined minimum and a join, and each round is written to the
    shared folder; they always settle. Self links and repeated or null links count for nothing; without links, no rows.
    """
    e = edges.select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v")).where("a is not null and b is not null and u > v")
    e = written(e, "cc")
    if e.count() <= local_links:
        return e.coalesce(1).mapInArrow(_resolve, "node long, component long")
    last = None
    while True:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(dealt(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.where("m < u").select("u", F.col("m").alias("v"))
        ).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(dealt(low2), "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low2.select("u", F.col("m").alias("v"))
        ).distinct()
        new = written(small, "cc")
        discard(e)
        e = new
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == last:
            break
        last = now
    star = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return star.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


# ---------------------------------------------------------------- words in numpy

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_kept: dict[int, np.ndarray] = {}


def _powers(n: int, base: np.uint64) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64; those of texts up to a few megabytes are kept."""
    have = _kept.get(int(base))
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 14), base, np.uint64)
        out[0] = 1
        have = np.cumprod(out, dtype=np.uint64)
        if n <= _BLOCK:
            _kept[int(base)] = have
    return have[:n]


_INV = np.uint64(pow(int(_P), -1, 2**64))
_BLOCK = 1 << 22


def word_hashes(raw: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words [^\\x20\\x09-\\x0D]+ of one text's UTF-8 bytes, A-Z lower-cased, in order."""
    n = len(raw)
    if n == 0:
        return np.empty(0, np.uint64)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate(([1], space.view(np.int8), [1])))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    low = np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[low] * _powers(n, _P), out=total[1:])
    inverse = _powers(n, _INV)
    return mix64((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def shingle_set(raw: np.ndarray, k: int = 5) -> np.ndarray:
    """The distinct k-word shingles of one text as sorted 64-bit hashes; fewer words: the whole sequence as one."""
    w = word_hashes(raw)
    if len(w) == 0:
        return w
    m = max(1, len(w) - k + 1)
    h = np.zeros(m, np.uint64)
    for j in range(min(k, len(w))):
        h = h * _Q + w[j : j + m]
    h = mix64(h + np.uint64(min(k, len(w))))
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def text_buffers(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An Arrow string column as (bytes, start of each, end of each) without a copy; null: an empty range."""
    import pyarrow as pa

    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    start, end = off[:-1], off[1:].copy()
    if column.null_count:
        end = np.where(np.asarray(column.is_valid()), end, start)
    return raw, start, end

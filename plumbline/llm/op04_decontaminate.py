"""Benchmark decontamination by winnowing, in DataFrame operations only.

Each text's k-word hashes are computed in its row; of every w consecutive ones the smallest is kept as a fingerprint
(the leftmost on ties). Document and item fingerprints are joined; around each match the document's words are cut into
windows and compared, as text, with the items' windows. With k = 5 and w = 6 every shared span of k + w - 1 = 10 words
has a common fingerprint, so no occurring window is lost; items of fewer words get hashes of their own length with
w = 1, which a row looks up in a list while they are few.

The documents are read once and only fingerprints that match an item's leave the scan's stage; one small row goes on
for each document besides.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import let, maybe_broadcast

K, WINDOW = 5, 10
MAX_BROADCAST_ROWS = 100_000
#: Items shorter than a window whose hashes are looked up in each row at most; more go through the join alone.
MAX_SHORT = 1000
#: Keys over which rows that match nothing are dealt, so that none is hot.
LANES = 4096
_POS = 28  # low bits of a fingerprint that hold its place
_OTHER = "".join(chr(i) for i in range(128) if not chr(i).isalnum())


def item_words(text: Column) -> Column:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ with A-Z lower-cased; null: none. Other ASCII characters become spaces."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase + _OTHER, string.ascii_lowercase + " " * len(_OTHER))
    return F.array_remove(F.split(low, " "), "")


def _fingerprints(words: Column, k: int, w: int) -> Column:
    """Hash bits above the place (from 1) in the low bits, of each k-word hash that is least in some w in a row."""
    high, low = F.lit(-(1 << _POS)).cast("long"), (1 << _POS) - 1
    key = lambda h: lambda i: F.xxhash64(*[F.get(h, i + (j - 1)) for j in range(k)]).bitwiseAND(high).bitwiseOR(i.cast("long").bitwiseAND(F.lit(low)))
    keys = let(F.transform(words, lambda x: F.xxhash64(x)), lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - (k - 1)), key(h)))
    if w > 1:
        least = lambda ks: lambda i: F.least(*[F.get(ks, i + j) for j in range(w)])
        keys = let(keys, lambda ks: F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(ks) - w), least(ks))))
    return F.when(F.size(words) >= k + w - 1, keys).otherwise(F.array().cast("array<bigint>"))


def _marked(words: Column, plans: list[tuple[int, int, list[int] | None]]) -> Column:
    """Fingerprints of all plans (k, w, hashes or None for all) as (k, key)."""
    def one(k, w, only):
        keys = _fingerprints(words, k, w)
        keys = keys if only is None else F.filter(keys, lambda x: _hash(x).isin(only))
        return F.transform(keys, lambda x: F.struct(F.lit(k).alias("k"), x.alias("key")))
    return F.concat(*[one(*p) for p in plans])


def _hash(key: Column) -> Column:
    return F.shiftright(key, _POS)


def _windows(words: Column, n: Column, window: int) -> Column:
    """An item's windows as (text, length)."""
    full = F.transform(F.sequence(F.lit(1), n - (window - 1)), lambda i: F.array_join(F.slice(words, i, window), " "))
    return F.when(n >= window, full).when(n > 0, F.array(F.array_join(words, " "))).otherwise(F.array().cast("array<string>"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_words, n_hit, n_items, items (their ids as sorted strings),
    items_sha256, contaminated, against benchmark (item_id, text).

    A window is `window` consecutive words of an item; an item of fewer, but not none, is one window. n_hit counts the
    document's words inside any occurrence of a window; n_items the items with occurring windows. Null and empty texts
    have no words, no hits, and the digest of the empty string. Items with null text or no word have no windows; null
    item ids count as the id ''. Null doc_ids are kept, with their text telling them apart; repeated rows are each
    returned, all alike. Empty docs: no rows; an empty benchmark: no hits. Other columns are ignored."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), item_words(F.col("text")).alias("words"))
    lengths = [r[0] for r in items.select(F.least(F.size("words"), F.lit(window)).alias("n")).where("n > 0").distinct().collect()]
    plans = [(k, window - k + 1, None)] if window in lengths else []
    brief = [(n, 1, None) for n in sorted(lengths) if n < window]
    few = items.where(F.size("words") < window).select(F.explode(_marked(F.col("words"), brief)).alias("f")).where(F.col("f.k") == F.size("words")) if brief else None
    if brief:
        few = few.select(F.col("f.k").alias("k"), _hash(F.col("f.key")).alias("h")).distinct().limit(MAX_SHORT + 1).collect()
        plans += [(n, w, None if len(few) > MAX_SHORT else [r.h for r in few if r.k == n]) for n, w, _ in brief]
    size = F.size("words")

    windows = items.select("item", F.explode(_windows(F.col("words"), size, window)).alias("window")).groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), item_words(F.col("text")).alias("words"))
    if plans:
        known = items.select(F.explode(_marked(F.col("words"), plans)).alias("f")).select(F.col("f.k").alias("k"), _hash(F.col("f.key")).alias("h")).distinct()
        def piece(f):
            p, kk = f["key"].bitwiseAND(F.lit((1 << _POS) - 1)).cast("int"), f["k"]
            first = F.greatest(p + kk - window, F.lit(1))
            return F.struct(kk.alias("k"), _hash(f["key"]).alias("h"), first.alias("first"), F.slice("words", first, p + window - first).alias("near"))
        # A row of its own (k = 0) takes each document's number of words on; no two kinds of rows meet in one hot key.
        lane = F.pmod(F.xxhash64("doc_id", "th"), F.lit(LANES))
        head = F.array(F.struct(F.lit(0).alias("k"), lane.alias("h"), F.lit(0).alias("first"), F.array().cast("array<string>").alias("near")))
        rows = rows.select("doc_id", "th", size.alias("n"), F.explode(F.concat(head, F.transform(_marked(F.col("words"), plans), piece))).alias("f"))
        rows = rows.select("doc_id", "th", "n", F.col("f.k").alias("k"), F.col("f.h").alias("h"), F.col("f.first").alias("first"), F.col("f.near").alias("near"))
        heads = items.sparkSession.range(LANES).select(F.lit(0).alias("k"), F.col("id").alias("h"))
        rows = rows.join(maybe_broadcast(known.unionByName(heads), max_broadcast_rows), ["k", "h"], "left_semi")
        short = sorted({n for n in lengths if n < window})
        def cut(n):
            return F.transform(F.sequence(F.lit(1), F.size("near") - (n - 1)), lambda i: F.struct((F.col("first") + i - 1).alias("at"), F.lit(n).alias("len"), F.array_join(F.slice("near", i, n), " ").alias("window")))
        kind = "array<struct<at:int,len:int,window:string>>"
        cuts = F.concat(*[F.coalesce(F.when(F.size("near") >= n, cut(n)), F.array().cast(kind)) for n in [*short, *([window] if window in lengths else [])]])
        hits = rows.select("doc_id", "th", "n", "k", F.explode_outer(cuts).alias("c"))
        # No window holds the character U+0000.
        hits = hits.select("doc_id", "th", "n", "k", "c.at", "c.len", F.coalesce("c.window", F.concat(F.lit("\0"), F.pmod(F.xxhash64("doc_id", "th"), F.lit(LANES)).cast("string"))).alias("window"))
        hits = hits.join(maybe_broadcast(windows, max_broadcast_rows), "window", "left")
    else:
        hits = rows.select("doc_id", "th", size.alias("n"), F.lit(0).alias("k"), F.lit(0).alias("at"), F.lit(0).alias("len"), F.lit(None).cast("array<string>").alias("items"))
    found = hits.groupBy("doc_id", "th").agg(
        F.max("n").cast("long").alias("n_words"),
        F.count(F.when(F.col("k") == 0, 1)).alias("times"),
        F.sort_array(F.collect_set(F.when(F.col("items").isNotNull(), F.struct("at", "len")))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    union = F.aggregate(
        "spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("sum")),
        lambda a, s: F.struct(F.greatest(a["end"], s["at"] + s["len"]).alias("end"), (a["sum"] + F.greatest(F.lit(0), s["at"] + s["len"] - F.greatest(a["end"], s["at"]))).alias("sum")),
    )["sum"]
    found = found.withColumn("n_hit", union).withColumn("items", F.sort_array("items"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("_copy"),
    ).drop("_copy")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return got.drop("items")


ORACLE = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), b as (
  select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), bw as (
  select item, least(len(w), 10) as n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(list_slice(w, i, i + 9), ' '))) as g from b where len(w) > 0
), lens as (select distinct n from bw
), dw as (
  select doc_id, n, unnest(range(1, len(w) - n + 2)) as pos, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(list_slice(w, i, i + n - 1), ' '))) as g from d, lens where len(w) >= n
), hit as (select dw.doc_id, dw.pos, dw.n, bw.item from dw join bw on dw.g = bw.g and dw.n = bw.n
), words as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(pos, pos + n)) as p from hit) group by doc_id
), its as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as s from (select distinct doc_id, item from hit) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(s, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (doc_id) left join its using (doc_id)
"""

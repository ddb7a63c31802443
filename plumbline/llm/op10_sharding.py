"""Sharding by extendible hashing, in DataFrame operations only.

A key's hash is read as bits. The directory starts as one bucket; a bucket over the byte limit is split on the next
bit, all others stay, until each fits. Sizes are summed map-side by hash prefix first, so deciding the splits costs a
small aggregation; the directory has one slot for each prefix of global depth that occurs, and documents find their
bucket by an equi-join on the slot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import dealt, discard, maybe_broadcast, written

LIMIT = 1 << 20
MAX_DEPTH = 48
MAX_BROADCAST_ROWS = 200_000
#: Prefix bits by which sizes are first summed; buckets that are over the limit at that depth go on with more.
STEP_BITS = 16
#: Bits of a directory whose slots are all written out; pages that one sorted lane of an unsplittable bucket holds.
MAX_SLOT_BITS, LANE_PAGES = 20, 64


def key_bits(key: Column) -> Column:
    """The first 48 bits of the md5 of a key's text, as a number."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 12), 16, 10).cast("long")


def directory(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Buckets (depth, prefix, bytes, n) for rows (bits, bytes): prefix is the first `depth` of 48 bits as a number.
    A bucket exists if it has rows and every shorter prefix of it was over the limit."""
    made: list[DataFrame] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        made.append(written(df, name))
        return made[-1]

    rows = keep(rows.groupBy("bits").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")), "bits")
    out, open_, done = None, rows, 0
    while True:
        deep = min(done + STEP_BITS, MAX_DEPTH)
        leaf = open_.groupBy(F.shiftright("bits", MAX_DEPTH - deep).alias("p")).agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
        leaf = keep(leaf, "prefixes")
        levels = leaf.select(F.explode(F.sequence(F.lit(done if done == 0 else done + 1), F.lit(deep))).alias("depth"), "p", "bytes", "n")
        sums = levels.groupBy("depth", F.expr(f"shiftright(p, {deep} - depth)").alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
        sums = keep(sums, "levels")
        parent = sums.where(F.col("bytes") > limit).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"))
        here = sums.where((F.col("bytes") <= limit) | (F.col("depth") == MAX_DEPTH))
        first = here.where(F.col("depth") == (0 if done == 0 else done + 1))
        rest = here.where(F.col("depth") > (0 if done == 0 else done + 1)).withColumn("up", F.shiftright("prefix", 1)).join(parent, ["depth", "up"], "left_semi").drop("up")
        # A first level below `done` holds only rows of buckets that were over the limit there.
        part = first.select("depth", "prefix", "bytes", "n").unionByName(rest.select("depth", "prefix", "bytes", "n"))
        out = part if out is None else out.unionByName(part)
        over = sums.where((F.col("depth") == deep) & (F.col("bytes") > limit)).select(F.col("prefix").alias("p"))
        if deep == MAX_DEPTH or not over.limit(1).count():
            out = written(out, "directory")
            for x in made:
                discard(x)
            return out
        open_ = open_.withColumn("p", F.shiftright("bits", MAX_DEPTH - deep)).join(over, "p", "left_semi").drop("p")
        done = deep


def slots(buckets: DataFrame, depth: int) -> DataFrame:
    """The directory proper: for each slot of `depth` bits under a bucket, that bucket."""
    under = F.sequence(F.lit(0).cast("long"), F.expr(f"shiftleft(cast(1 as bigint), {depth} - depth) - 1"))
    return buckets.select("depth", "prefix", F.explode(under).alias("low")).select(F.expr(f"shiftleft(prefix, {depth} - depth) + low").alias("slot"), "depth", "prefix")


def shard(docs: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text", max_slot_bits: int = MAX_SLOT_BITS, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """docs with shard (the bucket's bits as text; '' if one holds all), shard_depth, shard_page and text_bytes; columns
    of these names are replaced.

    Every shard's texts sum to `limit` bytes at most. One key's rows have one hash and can't be split by bits: where a
    bucket of one hash is over the limit, its rows go to numbered pages by their running size, and a text beyond the
    limit by itself gets a page alone. Null keys hash as '', and null texts weigh 0. Null or repeated keys, however
    many, are spread over pages; pages are numbered after ordering by text hash, so ties are alike. Empty tables: no
    rows."""
    keep = [c for c in docs.columns if c not in ("shard", "shard_depth", "shard_page", "text_bytes")]
    size = F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long")
    # The input's columns travel in one struct, so that none can clash with those made here.
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.xxhash64(F.col(text_col).cast("string")).alias("th"), size.alias("text_bytes"), key_bits(F.col(id_col)).alias("bits"))
    buckets = directory(docs.select(key_bits(F.col(id_col)).alias("bits"), size.alias("bytes")), limit)
    depths = sorted(r[0] for r in buckets.select("depth").distinct().collect())
    common = max(depths, default=0)
    found = buckets.select("depth", "prefix", F.when(F.col("bytes") > limit, F.ceil(F.col("bytes") / F.lit(limit * LANE_PAGES))).otherwise(0).alias("lanes"))
    if common <= max_slot_bits:
        at = slots(buckets, common).join(dealt(found), ["depth", "prefix"])
        rows = rows.withColumn("slot", F.shiftright("bits", MAX_DEPTH - common)).join(maybe_broadcast(at, max_broadcast_rows), "slot")
    else:  # too deep for a table of all slots: a row probes its prefix of each depth in use
        tried = F.array(*[F.struct(F.lit(d).alias("depth"), F.shiftright("bits", MAX_DEPTH - d).alias("prefix")) for d in depths])
        rows = rows.withColumn("t", F.explode(tried)).select("row", "th", "text_bytes", "t.*").join(maybe_broadcast(found, max_broadcast_rows), ["depth", "prefix"])
    name = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), F.lit("0")))
    rows = rows.withColumn("shard", name).withColumn("shard_depth", F.col("depth").cast("int"))
    out = rows.where("lanes = 0").withColumn("shard_page", F.lit(0).cast("long"))
    if found.where("lanes > 0").limit(1).count():
        out = out.unionByName(_paged(rows.where("lanes > 0"), limit))
    return out.select("row.*", "shard", "shard_depth", "shard_page", "text_bytes")


def _paged(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of buckets that no bit can split, on pages: first dealt to lanes, one for LANE_PAGES limits that the bucket holds,
    by hash and place of reading, then by running size inside each lane, so that no task gets a whole bucket."""
    lane = F.pmod(F.xxhash64("th", F.monotonically_increasing_id()), F.col("lanes"))
    rows = written(rows.withColumn("lane", lane), "lanes")
    order = Window.partitionBy("prefix", "lane").orderBy("th", "text_bytes").rowsBetween(Window.unboundedPreceding, -1)
    # Half pages: a row that begins in half page h ends before h + 2 half pages at most, if it is half a limit or less.
    big = F.col("text_bytes") * 2 > limit
    small_before = F.coalesce(F.sum(F.when(~big, F.col("text_bytes")).otherwise(0)).over(order), F.lit(0))
    big_before = F.coalesce(F.sum(F.when(big, 1).otherwise(0)).over(order), F.lit(0))
    page = F.when(big, F.lit(1) + 2 * big_before).otherwise(2 * F.floor(small_before * 2 / F.lit(limit)))
    return rows.withColumn("shard_page", (page * F.col("lanes") + F.col("lane") + 1).cast("long")).drop("lane")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard(docs).select("doc_id", "shard", "shard_depth", "shard_page", "text_bytes")


ORACLE = """
with r as (select doc_id, cast(coalesce(strlen(text), 0) as bigint) as b,
    lpad(bin(('0x' || left(md5(coalesce(cast(doc_id as varchar), '')), 12))::bigint), 48, '0') as bits from documents),
s as (select d.depth, left(r.bits, d.depth) as p, sum(b) as total from r, (select unnest(range(0, 25)) as depth) d group by all),
m as (select r.doc_id, r.bits, r.b, min(s.depth) as depth from r join s on left(r.bits, s.depth) = s.p where s.total <= 1048576 group by all)
select doc_id, left(bits, depth) as shard, cast(depth as integer) as shard_depth, cast(0 as bigint) as shard_page, b as text_bytes from m
"""

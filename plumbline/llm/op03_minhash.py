"""MinHash near-dedup by a signature-coordinate inverted join.

Plan:
1. One pass over the texts (Arrow batches) gives each document its shingle-set size, a 128-bit digest of the set
   and a signature of `coords` minima. Documents with one set form a class; only one row of it goes on, so copies never
   meet as pairs.
2. Each class is posted under every (coordinate, value). Values that only one class has can't collide and are left
   out. With the rest in order of rising frequency, two signatures that collide in `matches` lists must share
   one of the first coords - matches + 1, so only those lists are merged (prefix); the longest, such as
   those of a line that half of the corpus has, are skipped, and a candidate's collisions in them are found by probing
   its two signatures. Prefix and probe together count a pair's collisions over all lists.
3. Lists are merged by hubs first: each list's members are compared with its most central member. Then members that are
   still in different components are compared with each other, in blocks of a list's members. Pairs inside one component can't
   change a component, so no link between different texts that matters is lost, and a large group of near copies
   costs its size, not its square.
4. Candidates with `matches` collisions are confirmed on full shingle sets; before that, bitmaps of the sets leave out
   pairs that can't reach the threshold. That bound is exact: a bit that differs is a shingle that the other set lacks.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import connected_components, dealt, discard, shingle_set, text_buffers, written

COORDS = 48
MATCHES = 28
#: Bits of a set's bitmap. Only speed depends on it.
BITS = 4096
#: Members of a list that one group compares with as many others. Only speed depends on it.
BLOCK = 512
#: Size of the filter that keeps most texts without a candidate out of a shuffle; only speed depends on it.
FILTER_BITS = 1 << 25
_A = np.random.default_rng(7).integers(1, 2**63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = np.random.default_rng(8).integers(1, 2**63, COORDS, dtype=np.uint64)


def signature(s: np.ndarray) -> np.ndarray:
    """COORDS 32-bit minima over a set of 64-bit hashes, in blocks of bounded memory."""
    out = np.full(COORDS, 2**64 - 1, np.uint64)
    for i in range(0, len(s), 1 << 15):
        part = s[i : i + (1 << 15)]
        h = (part[None, :] ^ _B[:, None]) * _A[:, None]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x9FB21C651E98DF25)
        np.minimum(out, h.min(axis=1), out=out)
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def bitmap(s: np.ndarray) -> np.ndarray:
    """BITS bits as 64-bit numbers, each set if a hash of s falls on it."""
    bits = np.zeros(BITS, np.uint8)
    bits[(s % np.uint64(BITS)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def _describe(batches):
    import pyarrow as pa

    for batch in batches:
        raw, start, end = text_buffers(batch.column(2))
        sizes, keys, sigs = [], [], []
        for s, e in zip(start.tolist(), end.tolist()):
            x = shingle_set(raw[s:e])
            sizes.append(len(x))
            keys.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None)
            sigs.append(signature(x) if len(x) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.list_(pa.int32()))],
            names=["id", "th", "n", "key", "sig"],
        )


def _sets(batches):
    """(rep, items, bits) of (rep, text), a bounded number of items at a time."""
    import pyarrow as pa

    def out(reps, sets):
        off = np.concatenate(([0], np.cumsum([len(x) for x in sets], dtype=np.int64))).astype(np.int32)
        items = pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(sets).view(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), items, pa.array([bitmap(x) for x in sets], pa.list_(pa.int64()))], names=["rep", "items", "bits"])

    for batch in batches:
        raw, start, end = text_buffers(batch.column(1))
        reps, sets, size = [], [], 0
        for rep, s, e in zip(batch.column(0).to_pylist(), start.tolist(), end.tolist()):
            reps.append(rep)
            sets.append(shingle_set(raw[s:e]))
            size += len(sets[-1])
            if size > 1 << 18:
                yield out(reps, sets)
                reps, sets, size = [], [], 0
        if reps:
            yield out(reps, sets)


def collisions(a: Column, b: Column) -> Column:
    """In how many lists two signatures meet."""
    return F.aggregate(F.zip_with(a, b, lambda p, q: (p == q).cast("int")), F.lit(0), lambda s, y: s + y)


def _reachable(a: str, b: str, percent: int) -> Column:
    """Whether sets with sizes n and bitmaps bits can reach percent. Each bit that one bitmap alone has stands for a
    shingle at least that its set alone has, so 2 * intersection <= sizes - differing bits."""
    size = F.col(f"n{a}") + F.col(f"n{b}")
    differ = F.aggregate(F.zip_with(f"bits{a}", f"bits{b}", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, y: s + y)
    return (F.least(f"n{a}", f"n{b}") * 100 >= F.greatest(f"n{a}", f"n{b}") * percent) & ((size - differ) * (100 + percent) >= size * 2 * percent)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of distinct pairs (a, b) that reach percent on full sets. Spark knows the size of pairs from the shuffle that
    brings them, and hashes fill their files, so it may broadcast here."""
    x = pairs.join(sets.select(F.col("rep").alias("b"), F.col("items").alias("ib")), "b")
    x = x.join(sets.select(F.col("rep").alias("a"), F.col("items").alias("ia")), "a")
    x = x.withColumn("both", F.size(F.array_intersect("ia", "ib")))
    return x.where(F.col("both") * 100 >= (F.size("ia") + F.size("ib") - F.col("both")) * percent).select("a", "b")


def _likely(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of texts that a bitmap of FILTER_BITS bits over hashes of (id, th) lets pass: all of ids', and some others.
    Its size is fixed (a few megabytes at most), so it can be broadcast; it spares most other texts a shuffle."""
    place = F.pmod(F.xxhash64("id", "th"), F.lit(FILTER_BITS))
    maps = ids.select(place.alias("p")).groupBy(F.expr("p div 32768").alias("block")).agg(F.bitmap_construct_agg(F.expr("p % 32768")).alias("bits"))
    x = texts.withColumn("p", place).withColumn("block", F.expr("p div 32768")).join(F.broadcast(maps), "block")
    return x.where("shiftright(cast(conv(hex(substring(bits, cast(p % 32768 div 8 as int) + 1, 1)), 16, 10) as int), cast(p % 8 as int)) % 2 = 1").select(*texts.columns)


def _merged(several: DataFrame, node: DataFrame, percent: int, matches: int) -> DataFrame:
    """Distinct pairs (a, b) of different components that some list of several (token, rep, comp, top, k) holds, that meet
    in `matches` lists and can reach percent. Members of each list's largest component (top) aren't compared with each other. Lists
    of more than BLOCK members are dealt into blocks, and each pair of blocks is a group of its own."""
    blocks = F.ceil(F.col("k") / BLOCK).cast("int")
    rows = several.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("rep"), "blocks").cast("int")).join(dealt(node), "rep")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    fields = ("rep", "comp", "n", "sig", "bits")
    left = rows.where("comp <> top").select("token", F.col("own").alias("i"), every.alias("j"), *[F.col(c).alias(f"{c}_a") for c in fields])
    right = rows.select("token", every.alias("i"), F.col("own").alias("j"), *[F.col(c).alias(f"{c}_b") for c in fields], "top")
    once = (F.col("comp_a") != F.col("comp_b")) & ((F.col("comp_b") == F.col("top")) | (F.col("rep_a") < F.col("rep_b")))
    pairs = left.join(dealt(right), ["token", "i", "j"]).where(once & (collisions("sig_a", "sig_b") >= matches) & _reachable("_a", "_b", percent))
    return pairs.select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, coords: int = COORDS, matches: int = MATCHES) -> DataFrame:
    """One row per row of docs: (id_col, n_shingles, component_id, kept).

    Links join documents with 100 * intersection >= percent * union of their 5-word shingle sets; component_id is the
    smallest id reachable and kept says whether that is the row's own. Signatures find a pair at the threshold with
    all but about one chance in 570,000 (48 draws at 0.85, 28 needed); nothing else loses a link.
    Null or empty texts and texts of white space: n_shingles 0, linked with nothing, own component. Null ids: the row
    is returned with a null component_id and kept true, and links nothing. Repeated rows: each is returned, all alike. Rows
    that give one id several texts: each is judged by its own text. Empty tables: no rows. Other columns of docs are
    ignored. percent must leave matches / coords well below percent / 100.
    """
    if matches * 100 > percent * coords * 0.75:
        raise ValueError("matches is too high for this percent: near duplicates would be lost")
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("th", T.LongType()), T.StructField("n", T.LongType()), T.StructField("key", T.BinaryType()), T.StructField("sig", T.ArrayType(T.IntegerType()))])
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).select("id", F.xxhash64("text").alias("th"), "text")
    described = written(texts.mapInArrow(_describe, schema), "described")
    classes = described.where("key is not null and id is not null").groupBy("key").agg(F.min(F.struct("id", "th")).alias("row"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    # From here on a class is a number, whatever its id is.
    classes = written(classes.select(F.monotonically_increasing_id().alias("rep"), "row.id", "row.th", "key", "n", "sig"), "classes")

    posted = classes.select("rep", F.posexplode("sig").alias("c", "v")).select("rep", (F.shiftleft(F.col("c").cast("long"), 32) + F.col("v").cast("long")).alias("token"))
    often = posted.groupBy("token").agg(F.count("*").alias("f")).where("f > 1")
    lists = posted.join(dealt(often), "token").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("f", "token"))).alias("ts")).where(F.size("ts") >= matches)
    prefix = F.lit(coords - matches + 1) - (F.lit(coords) - F.size("ts"))
    lists = lists.select("rep", F.aggregate("ts", F.lit(0).cast("long"), lambda s, t: s + t["f"]).alias("central"), F.slice(F.transform("ts", lambda t: t["token"]), 1, prefix).alias("tokens"))
    members = written(lists.join(dealt(classes.select("rep", "id", "th", "n", "sig")), "rep"), "members")
    # An inner join: Catalyst would move a semi-join below the filter.
    own = _likely(texts.where("id is not null"), members).join(members.select("id", "th", "rep"), ["id", "th"]).dropDuplicates(["id", "th"])
    sets = written(own.select("rep", "text").mapInArrow(_sets, "rep long, items array<long>, bits array<long>"), "sets")

    post = members.select("rep", "central", F.explode("tokens").alias("token"))
    # Lists with the same members say the same: one of each stays.
    same = post.groupBy("token").agg(F.count("*").alias("k"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y"), F.max_by("rep", F.struct("central", "rep")).alias("hub")).where("k > 1")
    same = same.groupBy("k", "x", "y").agg(F.min(F.struct("token", "hub")).alias("list")).select("list.token", "list.hub", "k")
    post = written(post.drop("central").join(dealt(same), "token"), "post")
    pairs = post.where("rep <> hub").select(F.least("hub", "rep").alias("a"), F.greatest("hub", "rep").alias("b")).distinct()
    for end in ("b", "a"):
        pairs = pairs.join(dealt(members.select(F.col("rep").alias(end), F.col("sig").alias(f"sig_{end}"), F.col("n").alias(f"n_{end}"))), end)
    pairs = pairs.where((F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent) & (collisions("sig_a", "sig_b") >= matches)).select("a", "b")
    links = written(_confirmed(pairs, sets, percent), "links")
    comps = written(connected_components(links), "comps")
    # What is left: lists whose members are in several components, those outside the largest against all others.
    now = post.drop("hub").join(dealt(comps.withColumnRenamed("node", "rep")), "rep", "left").select("token", "rep", "k", F.coalesce("component", "rep").alias("comp"))
    parts = now.groupBy("token", "comp").agg(F.count("*").alias("n")).groupBy("token").agg(F.max_by("comp", F.struct("n", "comp")).alias("top"), F.count("*").alias("parts")).where("parts > 1").drop("parts")
    node = members.select("rep", "n", "sig").join(dealt(sets.select("rep", "bits")), "rep")
    last = written(_confirmed(_merged(now.join(dealt(parts), "token"), node, percent, matches), sets, percent), "links")
    if last.limit(1).count():
        comps = written(connected_components(links.unionByName(last)), "comps")
    for x in (sets, post, members, links, last):
        discard(x)
    ids = classes.join(dealt(comps.withColumnRenamed("node", "rep")), "rep", "left").select("key", "id", F.coalesce("component", "rep").alias("component"))
    least = ids.groupBy("component").agg(F.min("id").alias("least"))
    named = ids.join(dealt(least), "component").select("key", "least")
    out = described.select("id", "n", "key").join(dealt(named), "key", "left")
    component = F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("least", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))

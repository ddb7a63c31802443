"""Mixing sources to target weights by soft membership, in DataFrame operations only.

1. A multinomial naive Bayes classifier over hashed words is learned from a labelled table; each document gets a
   posterior over the domains, not one hard source. Counts are summed map-side into BUCKETS rows for each domain.
2. Nonnegative rates r minimize |A^T r - T|^2, where row i of A is n_tokens * posterior of document i and T the target
   tokens of the domains: projected gradient steps r <- max(0, r - step), with the residual's metric and each
   document's step scaled (by the domains' Gram matrix and by 1 / n_tokens), so that few steps do at any size.
   Each iteration is one aggregation of len(domains) sums over a small written table.
3. A rate becomes a whole number of copies: its floor, and one more with the remainder's chance by a hash of doc_id.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import dealt, key_crc, written

BUCKETS = 4096
#: Production targets: shares of tokens by language.
TARGETS = {"en": 0.55, "de": 0.17, "fr": 0.17, "es": 0.11}
MAX_ITERATIONS = 60
#: Share of all tokens by which a domain may miss its target without a warning.
MAX_GAP = 1e-4


def _words(text):
    return F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+", " ")), " ")


def _bucket(word):
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def learn_domains(labelled: DataFrame, domains: list[str]) -> DataFrame:
    """(bucket, w0, w1, ...): each word bucket's log-probability in each domain, from labelled (text, domain); the row
    with bucket -1 holds the log priors. Rows of null or other domains don't count. Unseen domains get uniform words
    and the least prior."""
    spark = labelled.sparkSession
    rows = labelled.where(F.col("domain").isin(domains)).select("domain", F.explode(_words(F.col("text"))).alias("w")).where("w <> ''")
    counts = rows.groupBy("domain", _bucket(F.col("w")).alias("bucket")).agg(F.count("*").alias("k")).collect()  # BUCKETS * domains at most
    docs = {r["domain"]: r["n"] for r in labelled.where(F.col("domain").isin(domains)).groupBy("domain").agg(F.count("*").alias("n")).collect()}
    table = np.ones((BUCKETS, len(domains)))
    for r in counts:
        table[r["bucket"], domains.index(r["domain"])] += r["k"]
    logp = np.log(table) - np.log(table.sum(axis=0))
    prior = np.log(np.array([docs.get(d, 0) + 1.0 for d in domains]) / (sum(docs.values()) + len(domains)))
    logp -= logp.max(axis=1, keepdims=True)  # only differences count
    data = [(-1, *map(float, prior)), *((b, *map(float, logp[b])) for b in range(BUCKETS))]
    return spark.createDataFrame(data, "bucket int, " + ", ".join(f"w{i} double" for i in range(len(domains))))


def posteriors(docs: DataFrame, model: DataFrame, domains: list[str], id_cols: list[str]) -> DataFrame:
    """id_cols, n_tokens and p0, p1, ... (summing to 1) for each distinct key; model has a fixed number of rows."""
    k = len(domains)
    rows = docs.select(*id_cols, F.explode(F.concat(F.array(F.lit(None).cast("string")), _words(F.col("text")))).alias("w"))
    rows = rows.where("w is null or w <> ''").select(*id_cols, F.when(F.col("w").isNull(), -1).otherwise(_bucket(F.col("w"))).alias("bucket"))
    got = rows.join(F.broadcast(model), "bucket")
    sums = got.groupBy(*id_cols).agg(F.count(F.when(F.col("bucket") >= 0, 1)).alias("_words"), F.count(F.when(F.col("bucket") < 0, 1)).alias("times"), *[F.sum(f"w{i}").alias(f"s{i}") for i in range(k)])
    # A key that repeats adds up whole rows; dividing gives one row's sums.
    sums = sums.select(*id_cols, "times", (F.col("_words") / F.col("times")).cast("long").alias("n_tokens"), *[(F.col(f"s{i}") / F.col("times")).alias(f"s{i}") for i in range(k)])
    top = F.greatest(*[F.col(f"s{i}") for i in range(k)]) if k > 1 else F.col("s0")
    e = [F.exp(F.col(f"s{i}") - top) for i in range(k)]
    total = sum(e[1:], e[0])
    return sums.select(*id_cols, "times", "n_tokens", *[(e[i] / total).alias(f"p{i}") for i in range(k)])


def fit_rates(members: DataFrame, shares: list[float], max_iterations: int = MAX_ITERATIONS, tolerance: float = 1e-7):
    """The rate as a Column over members (times, n_tokens, p0, ...), and the reached and target token totals.

    Starts at 1 everywhere; a domain without tokens can't be reached and its share goes to the others in proportion."""
    k = len(shares)
    p = [F.col(f"p{i}") for i in range(k)]
    w = F.col("times") * F.col("n_tokens")

    def look(rate):
        """The domains' totals at a rate, and their Gram matrix over the documents whose rate isn't at its bound."""
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        row = members.withColumn("_r", rate).agg(*[F.sum(w * p[i] * F.col("_r")).alias(f"t{i}") for i in range(k)], *[F.sum(F.when(F.col("_r") > 0, w) * p[i] * p[j]).alias(f"g{i}_{j}") for i, j in pairs]).first()
        gram = np.zeros((k, k))
        for i, j in pairs:
            gram[i, j] = gram[j, i] = row[f"g{i}_{j}"] or 0.0
        return np.array([row[f"t{i}"] or 0.0 for i in range(k)]), gram

    t, gram = look(F.lit(1.0))
    total = t.sum()
    if total == 0:
        return F.lit(1.0), t, t
    share = np.where(t > 1e-9 * total, np.array(shares, float), 0.0)
    target = total * share / share.sum() if share.sum() > 0 else t
    steps: list[np.ndarray] = []
    reached, whole = t, gram
    for _ in range(max_iterations):
        gap = reached - target
        if np.abs(gap).max() <= tolerance * total:
            break
        # The metric of the free documents; where that overshot, the metric of all, in which a step of 1 can't.
        step = np.linalg.pinv(gram / total, rcond=1e-9) @ gap / total
        now, then = look(_rate([*steps, step], k))
        if np.abs(now - target).sum() >= np.abs(gap).sum():
            step = np.linalg.pinv(whole / total, rcond=1e-9) @ gap / total
            now, then = look(_rate([*steps, step], k))
        steps.append(step)
        reached, gram = now, then
    return _rate(steps, k), reached, target


def _rate(steps: list[np.ndarray], k: int):
    """The rate after these projected steps, each r <- max(0, r - sum_j p_j * step_j), folded over a literal array."""
    if not steps:
        return F.lit(1.0)
    table = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps])
    return F.aggregate(table, F.lit(1.0), lambda r, s: F.greatest(F.lit(0.0), r - sum((F.col(f"p{j}") * s[j] for j in range(1, k)), F.col("p0") * s[0])))


def mixture(docs: DataFrame, labelled: DataFrame, targets: dict[str, float]) -> DataFrame:
    """One row per distinct (doc_id, text) of docs (doc_id, text): doc_id, text_hash, n_tokens, posterior (array in the
    order of sorted target names), domain (the likeliest; ties: the first), rate, copies.

    labelled has text and domain; targets maps domains to their shares of tokens (any positive scale). The expected
    domain token totals, sum of rate * n_tokens * posterior, match the targets at the input's total; where no rates reach
    them, the nearest found are used, with a RuntimeWarning that has both. Null and empty
    texts have no tokens, the prior as posterior and rate by it. Null ids are told apart by their texts; repeated rows
    share one result row and all get its rate. Empty docs: no rows; an empty labelled table: uniform posteriors."""
    domains = sorted(d for d, s in targets.items() if s > 0)
    if not domains:
        raise ValueError("targets needs a positive share")
    model = learn_domains(labelled, domains)
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    members = written(posteriors(rows, model, domains, ["doc_id", "text_hash"]), "members")
    rate, reached, target = fit_rates(members, [targets[d] for d in domains])
    gap = np.abs(reached - target).max() / max(1.0, target.sum())
    if gap > MAX_GAP:
        warnings.warn(f"no rates meet these targets: expected tokens of {domains} are {reached.tolist()}, targets {target.tolist()}", RuntimeWarning, stacklevel=2)
    p = F.array(*[F.col(f"p{i}") for i in range(len(domains))])
    best = F.element_at(F.array(*[F.lit(d) for d in domains]), F.array_position(p, F.array_max(p)).cast("int"))
    chance = F.pmod(F.xxhash64(F.lit("mix"), "doc_id", "text_hash"), F.lit(1 << 24)) / F.lit(float(1 << 24))
    got = members.select("doc_id", "text_hash", "n_tokens", p.alias("posterior"), best.alias("domain"), rate.alias("rate"))
    return got.withColumn("copies", (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("int")).cast("int"))


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float]) -> DataFrame:
    """docs with each row as often as its copies (see mixture) say; its columns only, of any names. Rows with null or
    repeated ids go by id and text; null and empty texts have the prior's rate; an empty table gives no rows."""
    got = mixture(docs, labelled, targets).where("copies > 0").select(F.struct("doc_id", "text_hash").alias("key"), "copies")
    rows = docs.select(F.struct("*").alias("row"), F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("key"))
    out = rows.join(dealt(got), "key")  # a struct equals another with nulls in the same places
    return out.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def labelled_domains(docs: DataFrame) -> DataFrame:
    """The labelled table of the query and the pipeline: texts whose language is known, but for a held-out fifth."""
    return docs.where(F.coalesce(key_crc(F.col("doc_id"), 5) != 0, F.lit(False))).select("text", F.col("lang").alias("domain"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    out = mixture(docs, labelled_domains(docs), TARGETS)
    return out.select("doc_id", "n_tokens", "posterior", "domain", F.round("rate", 9).alias("rate"), "copies")

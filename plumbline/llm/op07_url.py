"""URL filters: rules first, gradient-boosted trees on lexical features for the rest, in DataFrame operations only.

Features: lengths, host and path depth, digit ratio, character entropy, parameter counts, fragment, and how often the
labelled URLs of the same host suffix or path ending are blocked. Trees are grown level by level: one aggregation sums
gradients and Hessians by node, feature and bin (a table of fixed size), the best split of each node is chosen from
it, and the finished trees are CASE expressions, so that scoring is one pass without a shuffle.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import discard, maybe_broadcast, written

#: (action, host/path). A rule fits its host and all subdomains, if the path starts with its path; the longest wins.
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
TREES, DEPTH, RATE, BINS, L2, MIN_GAIN = 8, 3, 0.5, 16, 1.0, 1e-6
#: Rules that become one expression at most; parts of the labelled URLs whose rates come from the other parts.
MAX_RULES, FOLDS = 2000, 5
FEATURES = ["f_len", "f_host_len", "f_host_depth", "f_path_depth", "f_digits", "f_entropy", "f_params", "f_query_len", "f_fragment", "f_https", "f_suffix_rate", "f_suffix_n", "f_ending_rate"]


def host_of(url: Column) -> Column:
    u = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(u, r"://([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its action; null where none fits. Rules of one length: the first listed."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        h, _, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, action = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(act)).otherwise(action)
    return rule, action


def with_rules(rows: DataFrame, rules: list[tuple[str, str]], max_expression: int = MAX_RULES) -> DataFrame:
    """rows (page_id, url, host, path) with rule and action: one expression, or beyond max_expression rules a join of each
    url's host suffixes with the list, which is broadcast: it came from the driver."""
    if len(rules) <= max_expression:
        rule, action = rule_of(F.col("host"), F.col("path"), rules)
        return rows.withColumn("rule", rule).withColumn("action", action)
    listed = [(*t.partition("/")[::2], t, a, -i) for i, (a, t) in enumerate(rules)]
    table = rows.sparkSession.createDataFrame(listed, "rule_host string, rule_path string, rule string, action string, first long")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hit = F.col("path").startswith(F.concat(F.lit("/"), F.col("rule_path")))
    urls = rows.select("host", "path").distinct()
    best = urls.withColumn("rule_host", F.explode(suffixes)).join(F.broadcast(table), "rule_host").where(hit)
    best = best.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "first", "rule", "action")).alias("best"))
    return rows.join(best.select("host", "path", "best.rule", "best.action"), ["host", "path"], "left")


def _lexical(rows: DataFrame) -> DataFrame:
    """rows (url, host, path ...) with the features that need no labels, and the keys of those that do."""
    u = F.coalesce(F.col("url").cast("string"), F.lit(""))
    n = F.length(u)
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    chars = F.filter(F.array_distinct(F.split(u, "")), lambda c: c != "")
    share = lambda c: (n - F.length(F.replace(u, c, F.lit("")))).cast("double") / n
    entropy = F.when(n > 0, -F.aggregate(chars, F.lit(0.0), lambda s, c: s + share(c) * F.log(share(c)))).otherwise(0.0)
    return rows.select(
        "*",
        n.cast("double").alias("f_len"),
        F.length("host").cast("double").alias("f_host_len"),
        F.size(F.split("host", r"\.")).cast("double").alias("f_host_depth"),
        (F.length("path") - F.length(F.replace("path", F.lit("/"), F.lit("")))).cast("double").alias("f_path_depth"),
        F.when(n > 0, F.length(F.regexp_replace(u, "[^0-9]", "")).cast("double") / n).otherwise(0.0).alias("f_digits"),
        F.round(entropy, 9).alias("f_entropy"),
        F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")).alias("f_params"),
        F.length(query).cast("double").alias("f_query_len"),
        u.contains("#").cast("double").alias("f_fragment"),
        u.startswith("https").cast("double").alias("f_https"),
        F.regexp_extract("host", r"([^.]*)$", 1).alias("suffix"),
        F.regexp_extract("path", r"(\.[A-Za-z0-9]{1,8}|/)$", 1).alias("ending"),
    )


def _with_rates(rows: DataFrame, labelled: DataFrame, own: bool = False) -> DataFrame:
    """rows with the smoothed block rates of their suffix and ending among the labelled, and the suffix's log count. own:
    rows are the labelled ones; each gets the rates of the other folds, so that no row's label is in its features."""
    n, k = labelled.agg(F.count("*"), F.sum("y")).first()
    base = ((k or 0) + 1.0) / (n + 2.0)
    for key in ("suffix", "ending"):
        t = labelled.groupBy(key, "fold").agg(F.count("*").alias("n"), F.sum("y").alias("k"))
        all_ = t.groupBy(key).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        if own:
            all_ = all_.join(t.select(key, "fold", F.col("n").alias("n1"), F.col("k").alias("k1")), key).select(key, "fold", (F.col("n") - F.col("n1")).alias("n"), (F.col("k") - F.col("k1")).alias("k"))
        on = [key, "fold"] if own else [key]
        t = all_.select(*on, ((F.col("k") + 10 * base) / (F.col("n") + 10)).alias(f"f_{key}_rate"), F.log1p(F.col("n").cast("double")).alias(f"f_{key}_n"))
        rows = rows.join(maybe_broadcast(t, 50_000), on, "left")
        rows = rows.withColumn(f"f_{key}_rate", F.coalesce(f"f_{key}_rate", F.lit(base))).withColumn(f"f_{key}_n", F.coalesce(f"f_{key}_n", F.lit(0.0)))
    return rows


def _bins(cuts: dict[str, list[float]], f: str) -> Column:
    out = F.lit(0)
    for c in cuts[f]:
        out = out + (F.col(f) > c).cast("int")
    return out


def grow(table: DataFrame, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Column:
    """The log-odds of y = 1 as a Column over FEATURES, boosted on table (FEATURES, y 0 or 1)."""
    n, k = table.agg(F.count("*"), F.sum("y")).first()
    k = float(k or 0)
    total = F.lit(math.log((k + 1) / (n - k + 1)))
    if k == 0 or k == n:
        return total
    got = table.agg(*[F.percentile_approx(f, [i / BINS for i in range(1, BINS)], 10_000).alias(f) for f in FEATURES]).first()
    cuts = {f: sorted(set(got[f])) for f in FEATURES}
    binned = written(table.select("y", *FEATURES, *[_bins(cuts, f).alias(f"b_{f}") for f in FEATURES]), "binned")
    for _ in range(trees):
        p = 1 / (1 + F.exp(-total))
        now = written(binned.withColumn("g", p - F.col("y")).withColumn("h", p * (1 - p)), "gradients")
        leaves: dict[int, list[tuple[str, int, bool]]] = {1: []}  # node: the tests on its way
        value: dict[int, float] = {}
        splits: dict[int, tuple[str, int]] = {}
        for level in range(depth + 1):
            open_ = [m for m in leaves if m not in value]
            if not open_:
                break
            node = F.lit(None).cast("int")
            for m in open_:
                test = F.lit(True)
                for f, b, right in leaves[m]:
                    test = test & ((F.col(f"b_{f}") > b) if right else (F.col(f"b_{f}") <= b))
                node = F.when(test, F.lit(m)).otherwise(node)
            cells = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"b_{f}").alias("b")) for i, f in enumerate(FEATURES)]))
            sums = now.select(node.alias("node"), "g", "h", cells.alias("c")).where("node is not null").groupBy("node", "c.f", "c.b").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
            for m in open_:
                own = [r for r in sums if r["node"] == m]
                first = [r for r in own if r["f"] == 0]
                g, h = sum(r["g"] for r in first), sum(r["h"] for r in first)
                best = (MIN_GAIN, None, None)
                for i in range(len(FEATURES)) if level < depth else ():
                    gl = hl = 0.0
                    for r in sorted((r for r in own if r["f"] == i), key=lambda r: r["b"]):
                        gl, hl = gl + r["g"], hl + r["h"]
                        gr, hr = g - gl, h - hl
                        if hl > 1e-3 and hr > 1e-3:
                            gain = gl * gl / (hl + L2) + gr * gr / (hr + L2) - g * g / (h + L2)
                            if gain > best[0] + 1e-9:
                                best = (gain, FEATURES[i], r["b"])
                if best[1] is None:
                    value[m] = -rate * g / (h + L2)
                else:
                    splits[m] = best[1:]
                    way = leaves.pop(m)
                    leaves[2 * m] = [*way, (*best[1:], False)]
                    leaves[2 * m + 1] = [*way, (*best[1:], True)]

        def tree(m: int) -> Column:
            if m in value:
                return F.lit(float(value[m]))
            f, b = splits[m]
            return F.when(F.col(f) > cuts[f][b], tree(2 * m + 1)).otherwise(tree(2 * m)) if b < len(cuts[f]) else tree(2 * m)

        total = total + tree(1)
        discard(now)
    discard(binned)
    return total


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]] = RULES, labelled: DataFrame | None = None) -> DataFrame:
    """One row per row of pages (page_id, url): page_id, host, path, rule, verdict, score.

    labelled (url, y: 1 to block) trains the trees; by default the URLs of pages that a rule decides are the labelled
    ones. verdict is the rule's, else block where score >= 0.5. Null urls and those without '://' have an empty host
    and path, fit no rule and are scored like any other; null ids and repeated rows are returned as they come. Without
    labelled URLs, or with one class only, the score is the smoothed base rate. Other columns are ignored."""
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = _lexical(with_rules(rows, rules))
    if labelled is None:
        known = rows.where("action is not null").withColumn("y", (F.col("action") == "block").cast("int"))
    else:
        known = labelled.select("url", "y", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).where("y is not null")
        known = _lexical(known)
    known = written(known.select("y", F.pmod(F.xxhash64("url"), F.lit(FOLDS)).alias("fold"), "suffix", "ending", *[f for f in FEATURES if f not in ("f_suffix_rate", "f_suffix_n", "f_ending_rate")]), "labelled")
    score = grow(_with_rates(known, known, own=True).select("y", *FEATURES))
    out = _with_rates(rows, known).withColumn("score", 1 / (1 + F.exp(-score)))
    verdict = F.coalesce("action", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.round("score", 9).alias("score"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"))

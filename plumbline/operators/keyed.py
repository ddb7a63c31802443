"""Keyed relational operators: first and last wins, ordinals, top rows, classification, comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in the given order."""
    return _one(df, keys, order)


def last_wins(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The last row of each key in the given order."""
    return _one(df, keys, order, last=True)


def _one(df: DataFrame, keys: list[str], order: list, last: bool = False) -> DataFrame:
    """By a map-side combined minimum or maximum, not a sort of each key's rows."""
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    pick = (F.max_by if last else F.min_by)(F.struct(*rest), by).alias("_r")
    return df.groupBy(*keys).agg(pick).select(*[c if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])


def top_rows(df: DataFrame, keys: list[str], order: list, n: Column | int, name: str = "rn") -> DataFrame:
    """The first n rows of each key; n may differ by key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= n)


def ordinal_names(df: DataFrame, label: str, order: list) -> DataFrame:
    """Repeated labels: the first stays, the k-th gets -{k-1}."""
    k = F.row_number().over(Window.partitionBy(label).orderBy(*order))
    return df.withColumn(label, F.when(k == 1, F.col(label)).otherwise(F.concat(F.col(label), F.lit("-"), (k - 1).cast("string"))))


def duplicate_names(df: DataFrame, primary: str, order: list) -> DataFrame:
    """-dup, -dup2, ... by place within a primary label, with its prefix."""
    k = F.row_number().over(Window.partitionBy(primary).orderBy(*order))
    return df.withColumn("dup_label", F.concat(F.col(primary), F.lit("-dup"), F.when(k > 1, k.cast("string")).otherwise("")))


def roles(df: DataFrame, order: list, n_control: int) -> DataFrame:
    """GCP- for the first n_control rows, CHK- for the rest."""
    rank = F.row_number().over(Window.orderBy(*order))
    return df.withColumn("rank", rank).withColumn("role", F.when(F.col("rank") <= n_control, "GCP-").otherwise("CHK-"))


def renamed(df: DataFrame, names: DataFrame, label: str) -> DataFrame:
    """Labels replaced by names (old, new) where listed."""
    return df.join(names, df[label] == names["old"], "left").withColumn(label, F.coalesce("new", label)).drop("old", "new")


def tier(marks: Column, visible: Column) -> Column:
    """green from 7 marks, amber from 3, each clamped to what is visible; red below."""
    g, a = F.least(F.lit(7), F.coalesce(visible, F.lit(7))), F.least(F.lit(3), F.coalesce(visible, F.lit(3)))
    return F.when(marks >= g, "green").when(marks >= a, "amber").otherwise("red")


TIER_RANK = {"red": 0, "amber": 1, "green": 2}
CONFIDENCE_RANK = {"color": 0, "tri_color": 1, "tri_proj": 2, "projection": 3}


def rank_of(value: Column, ranks: dict[str, int], other: int) -> Column:
    out = F.lit(other)
    for k, v in ranks.items():
        out = F.when(value == k, v).otherwise(out)
    return out


def at_least_confident(df: DataFrame, column: str, threshold: str) -> DataFrame:
    """Rows whose confidence is as good as threshold; unknown rows rank last, an unknown threshold first."""
    return df.where(rank_of(F.col(column), CONFIDENCE_RANK, 99) <= CONFIDENCE_RANK.get(threshold, 0))


def select_images(points: DataFrame, labels: list[str], n: int | dict[str, int], default: int = 7) -> DataFrame:
    """For each listed label, in that order, its first n rows (by seq)."""
    spark = points.sparkSession
    per = [(i, x, n if isinstance(n, int) else n.get(x, default)) for i, x in enumerate(labels)]
    wanted = spark.createDataFrame(per, "pos int, label string, n int")
    return top_rows(points.join(F.broadcast(wanted), "label"), ["label"], ["seq"], F.col("n")).orderBy("pos", "seq")


def missing_labels(points: DataFrame, labels: list[str]) -> DataFrame:
    wanted = points.sparkSession.createDataFrame([(x,) for x in labels], "label string")
    return wanted.join(points.select("label").distinct(), "label", "left_anti")


def compare_taggers(a: DataFrame, b: DataFrame, near: float = 20.0) -> DataFrame:
    """Two taggers' marks (label, image, px, py, seq) by label: counts, matched images, median and largest offset."""
    one = last_wins(a, ["label", "image"], ["seq"]).select("label", "image", F.col("px").alias("ax"), F.col("py").alias("ay"))
    two = last_wins(b, ["label", "image"], ["seq"]).select("label", "image", F.col("px").alias("bx"), F.col("py").alias("by"))
    both = one.join(two, ["label", "image"]).withColumn("off", F.sqrt((F.col("ax") - F.col("bx")) ** 2 + (F.col("ay") - F.col("by")) ** 2))
    stats = both.groupBy("label").agg(F.count("*").alias("n_match"), F.median("off").alias("med_off"), F.max("off").alias("max_off"), F.count_if(F.col("off") <= near).alias("n_near"))
    counts = a.groupBy("label").agg(F.count("*").alias("n_a")).join(b.groupBy("label").agg(F.count("*").alias("n_b")), "label", "full")
    kind = F.when(F.col("n_b").isNull(), "only_a").when(F.col("n_a").isNull(), "only_b").when(F.col("n_match").isNull(), "unmatched").otherwise("matched")
    return counts.join(stats, "label", "left").withColumn("kind", kind)


# Words of a description that tell a monument.
MONUMENT_WORDS = ["brass", "alum cap", "plastic cap", "rebar", "monument", "ngs", "control pt", "control peg", "survey marker", "survey m"]


def monuments(df: DataFrame, near_local: DataFrame, words: list[str] = MONUMENT_WORDS) -> DataFrame:
    """is_monument: Local, or Global near a Local (near_local: tid), or described as one."""
    flagged = df.join(near_local.select("tid").distinct().withColumn("near", F.lit(True)), "tid", "left")
    told = F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(F.lower(F.coalesce("description", F.lit(""))), w)) if "description" in df.columns else F.lit(False)
    return flagged.withColumn("is_monument", (F.col("origin") == "Local") | F.coalesce("near", F.lit(False)) | told).drop("near")


def actionable(checks: DataFrame, points: DataFrame) -> DataFrame:
    """Findings (severity, message) of a quality report: checks (name, severity, detail) that fail or warn, and points
    (label, verified, marked) of which marks were rejected, or that none has."""
    one = checks.where(F.col("severity").isin("fail", "warn")).select("severity", F.concat("name", F.lit(": "), "detail").alias("message"))
    say = lambda *parts: F.concat(F.lit("GCP "), F.col("label"), *[F.lit(x) if not isinstance(x, Column) else x.cast("string") for x in parts])
    v, m = F.col("verified"), F.col("marked")
    rejected = points.where((m > 0) & (v < m)).select(F.lit("warn").alias("severity"), say(": solver verified ", v, "/", m, " marks (rejected ", m - v, " as outliers)").alias("message"))
    untagged = points.where(m == 0).select(F.lit("warn").alias("severity"), say(": 0 marks placed (untagged)").alias("message"))
    return one.unionByName(rejected).unionByName(untagged)


def role_disagreement(points: DataFrame, report: DataFrame) -> DataFrame:
    """Points (label, grp) whose role (GCP: control, else checkpoint) differs from the report's (label, role); a row of the
    report without a role differs too, a point that the report lacks doesn't."""
    own = F.when(F.col("grp") == "GCP", "control").otherwise("checkpoint")
    both = points.withColumn("own_role", own).join(report.select("label", "role"), "label")
    return both.withColumn("disagrees", F.coalesce(F.col("role"), F.lit("")) != F.col("own_role"))

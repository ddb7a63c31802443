"""Aggregates: error statistics, the median variants, consensus, suspects, triangulation sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upper_median(v: Column) -> Column:
    """sorted[n // 2]."""
    return F.element_at(F.sort_array(F.collect_list(v)), (F.count(v) / 2).cast("int") + 1)


def index_percentile(v: Column, share: float) -> Column:
    """sorted[int(share * (n - 1))]."""
    return F.element_at(F.sort_array(F.collect_list(v)), F.floor(share * (F.count(v) - 1)).cast("int") + 1)


def rms(v: Column) -> Column:
    return F.sqrt(F.avg(v * v))


def residuals(df: DataFrame, est=("x", "y", "z"), true=("survey_x", "survey_y", "survey_z")) -> DataFrame:
    """dX, dY, dZ, dH and d3D, rounded half to even to 6 places before they are aggregated."""
    d = [F.col(a) - F.col(b) for a, b in zip(est, true)]
    h = F.sqrt(d[0] * d[0] + d[1] * d[1])
    out = {"dX": d[0], "dY": d[1], "dZ": d[2], "dH": h, "d3D": F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])}
    return df.withColumns({k: F.bround(v, 6) for k, v in out.items()})


def group_stats(df: DataFrame, group: str, groups: list[str]) -> DataFrame:
    """n, RMS of each axis, mean and population deviation of dZ, to 6 places; groups without rows have n 0 and nulls."""
    names = df.sparkSession.createDataFrame([(g,) for g in groups], f"{group} string")
    agg = df.groupBy(group).agg(F.count("*").alias("n"), *[F.bround(rms(F.col(c)), 6).alias(f"rms_{c}") for c in ("dX", "dY", "dZ", "dH", "d3D")], F.bround(F.avg("dZ"), 6).alias("mean_dZ"), F.bround(F.stddev_pop("dZ"), 6).alias("std_dZ"))
    return F.broadcast(names).join(agg, group, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def outliers(df: DataFrame, value: str, ratio: float = 5.0, floor: float = 0.5) -> DataFrame:
    """suspect: value over max(ratio * median, floor). The median is one row, broadcast."""
    m = df.agg(F.median(value).alias("_median"))
    return df.join(F.broadcast(m)).withColumn("suspect", F.col(value) > F.greatest(F.col("_median") * ratio, F.lit(floor))).drop("_median")


def consensus(offsets: DataFrame, anchor_px: float = 10.0, suspect_px: float = 50.0, min_anchors: int = 3) -> DataFrame:
    """Per label of offsets (label, src, dx, dy): consensus offset with its fallbacks, suspects and suspicion score."""
    color = F.col("src").isin("color", "tri_color")
    mag = F.sqrt(F.col("dx") ** 2 + F.col("dy") ** 2)
    anchor = color & (mag < anchor_px)
    pick = lambda cond, c: F.when(cond, F.col(c))
    one = offsets.groupBy("label").agg(
        F.count("*").alias("n_tagged"), F.count_if(color).alias("n_color"), F.count_if(anchor).alias("n_anchor"),
        *[F.avg(pick(anchor, c)).alias(f"a_{c}") for c in ("dx", "dy")], *[F.median(pick(color, c)).alias(f"c_{c}") for c in ("dx", "dy")], *[F.median(c).alias(f"m_{c}") for c in ("dx", "dy")],
    )
    use = F.when(F.col("n_anchor") >= min_anchors, "anchors").when(F.col("n_color") >= 1, "color").otherwise("all")
    chosen = lambda c: F.when(F.col("consensus_src") == "anchors", F.col(f"a_{c}")).when(F.col("consensus_src") == "color", F.col(f"c_{c}")).otherwise(F.col(f"m_{c}"))
    one = one.withColumn("consensus_src", use).withColumns({"consensus_dx": chosen("dx"), "consensus_dy": chosen("dy")}).drop("a_dx", "a_dy", "c_dx", "c_dy", "m_dx", "m_dy")
    far = F.sqrt((F.col("dx") - F.col("consensus_dx")) ** 2 + (F.col("dy") - F.col("consensus_dy")) ** 2)
    two = offsets.where(color).join(one.select("label", "consensus_dx", "consensus_dy"), "label").withColumn("resid", far)
    two = two.groupBy("label").agg(F.count_if(F.col("resid") > suspect_px).alias("n_suspect"), F.max("resid").alias("max_resid"), F.median("resid").alias("med_resid"))
    out = one.join(two, "label", "left").withColumns({"n_suspect": F.coalesce("n_suspect", F.lit(0)), "max_resid": F.coalesce("max_resid", F.lit(0.0)), "med_resid": F.coalesce("med_resid", F.lit(0.0))})
    out = out.withColumn("consensus_mag", F.sqrt(F.col("consensus_dx") ** 2 + F.col("consensus_dy") ** 2))
    share = F.when(F.col("n_color") > 0, F.col("n_anchor") / F.col("n_color")).otherwise(0.0)
    score = F.when(F.col("n_color") > 0, F.col("n_suspect") / F.col("n_color") * 2.0).otherwise(0.0) + F.greatest(F.lit(0.0), 0.3 - share) * 3.33
    return out.withColumn("score", score + F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("consensus_mag") - 20.0) / 80.0))


def side_by_side(stats: DataFrame, group: str, metrics: list[str]) -> DataFrame:
    """One row per metric, one column per group."""
    cells = ", ".join(f"'{m}', cast({m} as double)" for m in metrics)
    return stats.select(group, F.expr(f"stack({len(metrics)}, {cells}) as (metric, value)")).groupBy("metric").pivot(group, ["GCP", "CHK"]).agg(F.first("value"))


def triangulate(rays: DataFrame, key: str = "label") -> DataFrame:
    """The point nearest to all rays (cx, cy, cz, dx, dy, dz) of each key, by least squares.

    I - dd' is a projector, so the normal equations are sums of it: nine map-side combined sums for a key, then Cramer's
    rule. Null for fewer than two rays and where the rays don't fix a point. Sums are taken about each key's mean
    centre."""
    mean = rays.groupBy(key).agg(*[F.avg(f"c{a}").alias(f"m{a}") for a in "xyz"])
    r = rays.join(mean, key)
    d = {a: F.col(f"d{a}") for a in "xyz"}
    c = {a: F.col(f"c{a}") - F.col(f"m{a}") for a in "xyz"}
    m = lambda a, b: (F.lit(1.0) if a == b else F.lit(0.0)) - d[a] * d[b]
    agg = [F.sum(m(a, b)).alias(f"m{a}{b}") for a, b in ("xx", "xy", "xz", "yy", "yz", "zz")] + [F.sum(sum((m(a, b) * c[b] for b in "yz"), m(a, "x") * c["x"])).alias(f"b{a}") for a in "xyz"]
    s = r.groupBy(key).agg(F.count("*").alias("n_rays"), *[F.first(f"m{a}").alias(f"o{a}") for a in "xyz"], *agg)
    g = lambda n: F.col(n)
    rows = [[g("mxx"), g("mxy"), g("mxz")], [g("mxy"), g("myy"), g("myz")], [g("mxz"), g("myz"), g("mzz")]]

    def det(x):
        return x[0][0] * (x[1][1] * x[2][2] - x[1][2] * x[2][1]) - x[0][1] * (x[1][0] * x[2][2] - x[1][2] * x[2][0]) + x[0][2] * (x[1][0] * x[2][1] - x[1][1] * x[2][0])

    full, trace = det(rows), g("mxx") + g("myy") + g("mzz")
    ok = (g("n_rays") >= 2) & (F.abs(full) >= 1e-9 * trace * trace * trace)
    swap = lambda j: [[g(f"b{'xyz'[i]}") if k == j else rows[i][k] for k in range(3)] for i in range(3)]
    return s.select(key, "n_rays", *[F.when(ok, det(swap(j)) / full + g(f"o{a}")).alias(a) for j, a in enumerate("xyz")])


def pca(df: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """Principal axes of each key's points: eigenvalues of the sample covariance, the main angle, coherence."""
    s = df.groupBy(key).agg(F.count("*").alias("n"), F.avg(x).alias("cx"), F.avg(y).alias("cy"), F.var_samp(x).alias("a"), F.covar_samp(x, y).alias("b"), F.var_samp(y).alias("c"))
    mid, half = (F.col("a") + F.col("c")) / 2, F.sqrt(((F.col("a") - F.col("c")) / 2) ** 2 + F.col("b") ** 2)
    s = s.withColumns({"l1": mid + half, "l2": mid - half, "angle": F.atan2(2 * F.col("b"), F.col("a") - F.col("c")) / 2})
    return s.withColumn("coherence", F.when(F.col("l1") + F.col("l2") > 0, (F.col("l1") - F.col("l2")) / (F.col("l1") + F.col("l2")))).drop("a", "b", "c")


def box_consistent(df: DataFrame, key: str, size: str, ratio: float = 1.5, src: str = "src") -> DataFrame:
    """reverted: a `color` detection whose box is more than a ratio off the median of its key's `color` boxes; its src
    becomes projection. Keys with one such box and medians under 1 aren't judged, boxes without a size neither."""
    color = (F.col(src) == "color") & (F.col(size) != 0)
    m = df.where(color).groupBy(key).agg(F.median(size).alias("med"), F.count(size).alias("_k"))
    out = df.join(m, key, "left")
    off = color & (F.col("_k") >= 2) & (F.col("med") >= 1) & ~(F.col(size) / F.col("med")).between(1 / ratio, ratio)
    out = out.withColumn("reverted", F.coalesce(off, F.lit(False))).drop("_k")
    return out.withColumn(src, F.when(F.col("reverted"), "projection").otherwise(F.col(src)))


def overflow_list(df: DataFrame, key: str, item: str, order: str, n: int = 5) -> DataFrame:
    """The n items of highest order, joined, with +k for those left out."""
    first = df.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order), item))).where(F.col("_k") <= n)  # a limit within each task first
    names = first.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_k", F.col(item).cast("string").alias("i")))), lambda x: x["i"]), ",").alias("names"))
    more = df.groupBy(key).agg((F.count("*") - n).alias("more"))
    return names.join(more, key).select(key, F.concat("names", F.when(F.col("more") > 0, F.concat(F.lit(" +"), F.col("more").cast("string"))).otherwise("")).alias("listed"))


def rate(df: DataFrame, keys: list[str], ts: str, value: str, seconds: int, order: str | None = None) -> DataFrame:
    """A counter's rise per second over a trailing window, falls counting as resets; rows of one second are ordered by
    `order`, and all count in each other's window."""
    at = F.col(ts).cast("long")
    rise = F.col(value) - F.lag(value).over(Window.partitionBy(*keys).orderBy(at, *([order] if order else [])))
    df = df.withColumn("_rise", F.when(rise < 0, F.col(value)).otherwise(F.coalesce(rise, F.lit(0.0))))
    return df.withColumn("rate", F.sum("_rise").over(Window.partitionBy(*keys).orderBy(at).rangeBetween(-seconds, 0)) / seconds).drop("_rise")


def idle_runs(df: DataFrame, keys: list[str], order: str, idle: Column, limit: int = 9) -> DataFrame:
    """run: idle rows in a row up to this one, anew after each busy row; kill from `limit` on."""
    w = Window.partitionBy(*keys).orderBy(order)
    df = df.withColumn("_part", F.sum((~idle).cast("int")).over(w))
    run = F.sum(idle.cast("int")).over(Window.partitionBy(*keys, "_part").orderBy(order))
    return df.withColumn("run", run).withColumn("kill", F.col("run") >= limit).drop("_part")

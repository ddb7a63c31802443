"""Tables of survey reports: quality checks, star joins, gate and TIN summaries, tagging rows, orderings, unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.geodesy import US_FOOT
from plumbline.functions.labels import fixed, normalize_label, trimmed

# Limits of the quality checks; metres, units of the survey's grid, counts.
THRESHOLDS = {"residual_h_m": 0.15, "residual_z_m": 0.15, "import_h_m": 0.15, "import_z_m": 0.15, "rms_h_crs_units": 0.10, "rms_v_crs_units": 0.20, "samples_min": 5, "pdop_max": 4.0}
# First cells of a report's summary rows.
SUMMARY = ["Min", "Max", "Mean", "Median", "Sigma"]


def thresholds(own: dict | None = None) -> dict:
    """The limits, with those of own in place of the defaults."""
    return THRESHOLDS | (own or {})


def _over(value: Column, limit: float, name: str, places: int, unit: str = "") -> Column:
    """'name=value > limit' where value is over the limit, else null; null values pass."""
    return F.when(value > limit, F.concat(F.lit(f"{name}="), fixed(value, places), F.lit(f"{unit} > {limit:.2f}")))


def localization_check(pairs: DataFrame, own: dict | None = None) -> DataFrame:
    """Pairs of a control point and its shot (local, global, dist_m, local_elev, global_elev in feet): message, null if
    both differences are within their limits."""
    th = thresholds(own)
    dz = F.abs(F.col("global_elev") - F.col("local_elev")) * US_FOOT
    got = pairs.withColumn("dz_m", dz)
    message = F.concat_ws(", ", _over(F.col("dist_m"), th["residual_h_m"], "ΔH", 3, " m"), _over(F.col("dz_m"), th["residual_z_m"], "ΔZ", 3, " m"))
    return got.select(F.lit("localization").alias("check"), F.concat("local", F.lit("↔"), "global").alias("label"), F.nullif(message, F.lit("")).alias("message"), F.col("dist_m").alias("h_m"), "dz_m")


def import_check(control: DataFrame, locals_: DataFrame, own: dict | None = None) -> DataFrame:
    """.dc points (label, easting, northing, elevation) with the Local points of the same label, in feet; message as
    above. A missing coordinate of the Local counts as 0."""
    th = thresholds(own)
    two = control.select("label", *[F.col(c).alias(f"dc_{c}") for c in ("easting", "northing", "elevation")]).join(locals_.select("label", "easting", "northing", "elevation"), "label")
    d = {c: F.coalesce(c, F.lit(0.0)) - F.col(f"dc_{c}") for c in ("easting", "northing", "elevation")}
    two = two.withColumns({"h_m": F.sqrt(d["easting"] ** 2 + d["northing"] ** 2) * US_FOOT, "dz_m": F.abs(d["elevation"]) * US_FOOT})
    message = F.concat_ws(", ", _over(F.col("h_m"), th["import_h_m"], "ΔH", 2, " m"), _over(F.col("dz_m"), th["import_z_m"], "ΔZ", 2, " m"))
    return two.select(F.lit("import").alias("check"), "label", F.nullif(message, F.lit("")).alias("message"), "h_m", "dz_m")


def rtk_check(targets: DataFrame, own: dict | None = None) -> DataFrame:
    """Targets (label, solution_status, easting_rms, northing_rms, elevation_rms, samples, pdop) with the message of all
    limits that they miss; nulls miss none, a blank status neither."""
    th = thresholds(own)
    status = F.upper(F.coalesce("solution_status", F.lit("")))
    message = F.concat_ws(
        ", ", F.when(~status.isin("", "FIX"), F.concat(F.lit("solu="), status)), _over(F.col("easting_rms"), th["rms_h_crs_units"], "eRMS", 3), _over(F.col("northing_rms"), th["rms_h_crs_units"], "nRMS", 3),
        _over(F.col("elevation_rms"), th["rms_v_crs_units"], "elRMS", 3), F.when(F.col("samples") < th["samples_min"], F.concat(F.lit("samples="), fixed(F.col("samples").cast("double"), 0), F.lit(f" < {th['samples_min']}"))),
        F.when(F.col("pdop") > th["pdop_max"], F.concat(F.lit("PDOP="), fixed(F.col("pdop").cast("double"), 1), F.lit(f" > {th['pdop_max']:.1f}"))),
    )
    return targets.select(F.lit("rtk_quality").alias("check"), "label", F.nullif(message, F.lit("")).alias("message"))


def rtk_summary(targets: DataFrame) -> DataFrame:
    """One row: targets, FIX ones, largest horizontal and vertical RMS (0 without any), fewest samples (null without any)."""
    return targets.agg(
        F.count("*").alias("n"), F.count_if(F.upper("solution_status") == "FIX").alias("n_fix"), F.coalesce(F.greatest(F.max("easting_rms"), F.max("northing_rms"), F.lit(0.0)), F.lit(0.0)).alias("max_rms_h"),
        F.coalesce(F.greatest(F.max("elevation_rms"), F.lit(0.0)), F.lit(0.0)).alias("max_rms_v"), F.min("samples").alias("min_samples"),
    )


def observations(obs: DataFrame, shots: DataFrame, cameras: DataFrame) -> DataFrame:
    """Obs (label, image, px, py) with their shot (image, camera ...) and camera (camera ...); the rest is left out, see
    missing_shots()."""
    return obs.join(shots, "image").join(cameras, "camera")


def missing_shots(obs: DataFrame, shots: DataFrame) -> DataFrame:
    """The observations to warn of, whose image the reconstruction lacks."""
    return obs.join(shots.select("image"), "image", "left_anti")


def with_brown(images: DataFrame, models: DataFrame) -> DataFrame:
    """Images (img_w, img_h ...) with the Brown model of their size, null without one."""
    return images.join(models.select(F.col("width").alias("img_w"), F.col("height").alias("img_h"), "camera_model"), ["img_w", "img_h"], "left")


def unmatched_locals(monuments: DataFrame, matches: DataFrame) -> DataFrame:
    """Local monuments (tid ...) that no shot was matched with (matches: local_tid)."""
    return monuments.where("origin = 'Local'").join(matches.select(F.col("local_tid").alias("tid")), "tid", "left_anti")


def quality_rows(gcps: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """A report's rows (seq, label, dx, dy, dz in feet, verified, marked) by normalised label (norm): role, dH and dZ in metres. Of
    one label the last row stays, checkpoints after controls."""
    every = gcps.withColumns({"role": F.lit("control"), "_s": F.lit(0)}).unionByName(checkpoints.withColumns({"role": F.lit("checkpoint"), "_s": F.lit(1)}))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    dh = F.when(F.col("dx").isNotNull(), F.sqrt(zero("dx") ** 2 + zero("dy") ** 2) * US_FOOT)
    row = F.struct("role", dh.alias("qr_dH_m"), (F.col("dz") * US_FOOT).alias("qr_dZ_m"), "verified", "marked")
    return every.where(F.coalesce("label", F.lit("")) != "").groupBy(normalize_label(F.col("label")).alias("norm")).agg(F.max_by(row, F.struct("_s", "seq")).alias("r")).select("norm", "r.*")


def report_points(points: DataFrame, quality: DataFrame, ortho: DataFrame, counts: DataFrame, tin: DataFrame) -> DataFrame:
    """Points (label ...) with the report's row of their normalised label, their ortho distance (label, ortho_dH), images
    (label, n_images; 0 without) and TIN difference (label, tin_dZ)."""
    out = points.withColumn("norm", normalize_label(F.col("label"))).join(quality, "norm", "left").drop("norm")
    return out.join(ortho, "label", "left").join(counts, "label", "left").join(tin, "label", "left").withColumn("n_images", F.coalesce("n_images", F.lit(0)))


def tin_stats(points: DataFrame) -> DataFrame:
    """RMS and mean of tin_dZ by grp, over the points that have one."""
    d = F.col("tin_dZ")
    return points.groupBy("grp").agg(F.count(d).alias("n"), F.sqrt(F.avg(d * d)).alias("rms_dZ"), F.avg(d).alias("mean_dZ"))


def gate_summary(report: DataFrame) -> DataFrame:
    """One row: targets by outcome of the gate, and sums of promoted images."""
    n = lambda *gates: F.count_if(F.col("gate").isin(*gates))
    return report.agg(F.count("*").alias("n_total"), n("PASS").alias("n_pass"), n("COLOR_INCONSISTENT", "SURVEY_DISAGREES").alias("n_suspect"), n("skipped").alias("n_skipped"), n("failed").alias("n_failed"), F.coalesce(F.sum("n_promoted_proj"), F.lit(0)).alias("promoted_proj"), F.coalesce(F.sum("n_promoted_color"), F.lit(0)).alias("promoted_color"))


def summary_rows(cells: DataFrame, key: list[str]) -> DataFrame:
    """Of extracted table rows (seq, c0 to c7 as text) the summary rows (stat, dx, dy, dz, reproj_px): those named so, the last
    of each name; and as rms rows without a name but with four numbers after such a row, the last of them."""
    name = F.trim(F.coalesce("c0", F.lit("")))
    four = [F.regexp_replace(F.trim(F.col(f"c{i}")), ",", "").try_cast("double").alias(n) for i, n in enumerate(("dx", "dy", "dz", "reproj_px"), 1)]
    rows = cells.select(*key, "seq", name.alias("name"), *four).withColumn("named", F.col("name").isin(*SUMMARY))
    first = rows.where("named").groupBy(*key).agg(F.min("seq").alias("first"))
    rms = (F.col("name") == "") & (F.col("seq") > F.col("first")) & F.col("dx").isNotNull() & F.col("dy").isNotNull() & F.col("dz").isNotNull() & F.col("reproj_px").isNotNull()
    stat = F.when(F.col("named"), F.lower("name")).when(rms, "rms")
    got = rows.join(first, key).withColumn("stat", stat).where("stat is not null")
    return got.groupBy(*key, "stat").agg(F.max_by(F.struct("dx", "dy", "dz", "reproj_px"), "seq").alias("v")).select(*key, "stat", "v.*")


def marks_verified(cell: Column) -> tuple[Column, Column]:
    """'v/m' as two numbers, both null unless both are whole numbers."""
    p = F.split(F.trim(cell), "/", 2)
    v, m = (F.trim(F.try_element_at(p, F.lit(i))).try_cast("int") for i in (1, 2))
    both = v.isNotNull() & m.isNotNull()
    return F.when(both, v), F.when(both, m)


def findings(df: DataFrame, key: str, message: str, order: str) -> DataFrame:
    """The list of each key's messages in order, and their number."""
    return df.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct(order, message))), lambda x: x[message]).alias("messages"), F.count("*").alias("n"))


def tagging_rows(targets: DataFrame, estimates: DataFrame) -> DataFrame:
    """Lines of a tagging file with their place (rank, from 1). targets (label, x, y, z, target_rank, primary_rank: that of the
    target whose near duplicate it is, else null); estimates (label, image, px, py, confidence, marker_bbox, image_rank). Near duplicates stand in order of
    their own rank right after their primary's block (O04). Targets without coordinates or estimates have no line."""
    row = targets.where("x is not null and y is not null and z is not null").join(estimates, "label")
    cells = [*[trimmed(F.col(a), 3) for a in "xyz"], trimmed(F.col("px"), 2), trimmed(F.col("py"), 2), F.col("image"), F.col("label"), F.coalesce("confidence", F.lit("projection")), F.nullif(F.coalesce("marker_bbox", F.lit("")), F.lit(""))]
    block = F.coalesce("primary_rank", "target_rank")
    order = Window.orderBy(block, F.col("primary_rank").isNotNull(), "target_rank", "image_rank")  # one file's lines
    return row.select(F.row_number().over(order).alias("rank"), F.concat_ws("\t", *cells).alias("line"))


def label_lists(df: DataFrame, key: str, label: str) -> DataFrame:
    """The sorted distinct labels of each key."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(label)).alias("labels"))


def point_order(df: DataFrame, point: str) -> DataFrame:
    """The place (rank, from 1) of points whose id is a number by that number, then the others by text. One file's points."""
    n = F.col(point).try_cast("long")
    return df.withColumn("rank", F.row_number().over(Window.orderBy(n.isNull(), n, point)))


def error_order(df: DataFrame, error: str, delta: str, tie: str) -> DataFrame:
    """Places by falling error, nulls last, and by rising delta. One report's rows."""
    return df.withColumns({"error_rank": F.row_number().over(Window.orderBy(F.desc_nulls_last(error), tie)), "delta_rank": F.row_number().over(Window.orderBy(F.asc_nulls_last(delta), tie))})


def worst_order(df: DataFrame, ortho: str, residual: str, tie: str) -> DataFrame:
    """Places by falling ortho error, points without one last, by falling residual. One report's rows."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(F.desc_nulls_last(ortho), F.desc_nulls_last(residual), tie)))


def alias_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (l, r) of rows (id, names) that have a name in common, each once: by a join on the names, not of all pairs."""
    one = lambda df, side: df.select(F.col("id").alias(side), F.explode(F.array_distinct("names")).alias("name"))
    return one(left, "l").join(one(right, "r"), "name").select("l", "r").distinct()


def first_seen(df: DataFrame, label: str, seq: str) -> DataFrame:
    """S01b, S01d: rows with label_order, the place (from 1) of their label by its first row, ties by
    label; rows keep seq within it."""
    first = df.groupBy(label).agg(F.min(seq).alias("_first"))
    first = first.select(label, F.row_number().over(Window.orderBy("_first", label)).alias("label_order"))  # one file's labels
    return df.join(first, label)


def first_tagged(df: DataFrame, label: str = "label", src: str = "src", seq: str = "seq") -> DataFrame:
    """S01f: px and py of the first row of each label that is `tagged`."""
    return df.where(F.col(src) == "tagged").groupBy(label).agg(F.min_by(F.struct("px", "py"), seq).alias("p")).select(label, "p.*")

"""Scans of survey formats into DataFrames, and writers of some.

Bad rows are skipped: casts are try_cast, then filtered. Line order is kept in seq (the file, then the line). Files are
read whole, one row each, where a format needs context across lines; surveys' files are small, and many run in parallel.
"""

from __future__ import annotations

import csv
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.labels import bbox, file_name, number


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, seq, line), seq from 0, without line ends or a byte order mark."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "^﻿", "").alias("value"))
    got = text.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("seq", "line"))
    return got.where(F.col("line") != "")


def header_first(df: DataFrame) -> DataFrame:
    """lines() with the first line of each file as column header."""
    head = df.groupBy("file").agg(F.min_by("line", "seq").alias("header"), F.min("seq").alias("_first"))
    return df.join(head, "file").where(F.col("seq") > F.col("_first")).drop("_first")


def point_file(spark: SparkSession, path: str, tabs_only: bool = False, least: int = 7) -> DataFrame:
    """Tagging files: crs (the header), seq, x, y, z, px, py, image, label, src, bbox. Tab-separated, or by white space in
    lines without a tab; rows of fewer than `least` fields or with bad numbers are skipped."""
    df = header_first(lines(spark, path))
    parts = F.split("line", "\t") if tabs_only else F.when(F.col("line").contains("\t"), F.split("line", "\t")).otherwise(F.split(F.trim("line"), r"\s+"))
    df = df.select("file", "seq", F.trim("header").alias("crs"), parts.alias("p")).where(F.size("p") >= least)
    f = lambda i: F.try_element_at("p", F.lit(i + 1))
    out = df.select("file", "seq", "crs", *[F.trim(f(i)).try_cast("double").alias(n) for i, n in enumerate(("x", "y", "z", "px", "py"))], F.trim(f(5)).alias("image"), F.trim(f(6)).alias("label"), F.coalesce(F.trim(f(7)), F.lit("")).alias("src"), bbox(f(8)).alias("bbox"))
    return out.where("x is not null and y is not null and z is not null and px is not null and py is not null")


# Header words of survey exports, in the order in which they are tried.
SURVEY_COLUMNS = {
    "label": ["name", "point"], "lat": ["latitude"], "lon": ["longitude"], "ellip_alt": ["ellipsoidal"],
    "easting": ["easting", " east"], "northing": ["northing", " north"], "elevation": ["elevation"], "cs_name": ["cs name", "coordinate system"],
    "solution_status": ["solution status", "status"], "origin": ["origin"], "description": ["description"], "easting_rms": ["easting rms"],
    "northing_rms": ["northing rms"], "elevation_rms": ["elevation rms"], "lateral_rms": ["lateral rms"], "samples": ["samples"], "pdop": ["pdop"],
}
TEXT_COLUMNS = {"label", "cs_name", "solution_status", "origin", "description"}


def resolve_headers(headers: list[str], wanted: dict[str, list[str]] = SURVEY_COLUMNS) -> dict[str, str | None]:
    """For each wanted column the header that holds the first of its words that any header holds, regardless of case."""
    low = [(h, h.lower()) for h in headers]
    return {k: next((h for w in words for h, x in low if w in x), None) for k, words in wanted.items()}


def survey_csv(spark: SparkSession, path: str, fallback_crs: str | None = None) -> DataFrame:
    """Survey exports as flat rows; blank labels are named gcp_{n} by the rows kept before; repeated labels get ordinals.

    A lone quote that ends a line is dropped. Rows with a bad number in a coordinate column are skipped, and a blank one
    but for latitude and longitude; a file without rows left raises ValueError. The status is upper-cased. Where latitude is blank, both come from easting and northing by
    the grid that cs_name, or else fallback_crs, names (its name or EPSG number, of geodesy.GRIDS); rows for which that fails
    keep nulls. The ellipsoidal height is in feet; without one it is the elevation in the grid's unit, as no geoid is at hand."""
    from pyspark.sql import Window

    from plumbline.functions.geodesy import GRIDS, US_FOOT, from_grid
    from plumbline.operators.keyed import ordinal_names

    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace(F.regexp_replace("value", "^﻿", ""), r',"(\r?\n)', ",$1").alias("value"))
    # Records end at line ends outside quotes.
    records = text.select("file", F.posexplode(F.split("value", r'\r?\n(?=(?:[^"]*"[^"]*")*[^"]*$)')).alias("seq", "line")).where(F.col("line") != "")
    top = records.orderBy("file", "seq").first()
    headers = [h.strip() for h in next(csv.reader([top["line"]]))] if top else []
    at = resolve_headers(headers)
    place = {h: i for i, h in reversed(list(enumerate(headers)))}
    first = records.groupBy("file").agg(F.min("seq").alias("first"))
    rows = records.join(first, "file").where(F.col("seq") > F.col("first"))
    rows = rows.select("file", "seq", F.from_csv("line", ", ".join(f"c{i} string" for i in range(len(headers))) or "c0 string", {"escape": '"', "lineSep": "\u0001"}).alias("r"))
    col = lambda k: F.col(f"r.c{place[at[k]]}") if at[k] else F.lit(None).cast("string")
    real = lambda k: F.trim(col(k)).try_cast("double")
    df = rows.select("file", "seq", *[(F.coalesce(F.trim(col(k)), F.lit("")) if k in TEXT_COLUMNS else real(k)).alias(k) for k in SURVEY_COLUMNS], *[(F.coalesce(col(k), F.lit("")) != "").alias(f"has_{k}") for k in ("lat", "lon")])
    for k in ("easting", "northing", "elevation", "ellip_alt"):
        if at[k]:
            df = df.where(F.col(k).isNotNull())
    df = df.where("(lat is not null or not has_lat) and (lon is not null or not has_lon)").drop("has_lat", "has_lon")
    if not df.limit(1).count():
        raise ValueError(f"no valid survey rows; headers: {headers}")
    df = df.withColumn("seq", F.row_number().over(Window.orderBy("file", "seq")) - 1).drop("file")  # one survey's rows
    df = df.withColumn("label", F.when(F.col("label") == "", F.concat(F.lit("gcp_"), F.col("seq").cast("string"))).otherwise(F.col("label")))
    df = df.withColumn("solution_status", F.upper("solution_status"))
    is_grid = lambda text, g: (F.lower(text) == g.name.lower()) | text.rlike(rf"(?i)^\s*(epsg:)?{g.epsg}\s*$")
    own, sure = F.when(F.col("cs_name") != "", F.col("cs_name")).otherwise(F.lit(fallback_crs or "")), F.lit(False)
    for g in GRIDS.values():
        sure = sure | is_grid(own, g)
    lat, lon, unit = F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(1.0)
    for g in GRIDS.values():
        here = is_grid(own, g) | (~sure & is_grid(F.lit(fallback_crs or ""), g))
        la, lo = from_grid(F.col("easting"), F.col("northing"), g)
        lat, lon, unit = F.when(here, la).otherwise(lat), F.when(here, lo).otherwise(lon), F.when(here, F.lit(g.unit)).otherwise(unit)
    df = df.withColumns({"lat": F.coalesce("lat", lat), "lon": F.when(F.col("lat").isNull(), lon).otherwise(F.col("lon")), "ellip_alt_m": F.coalesce(F.col("ellip_alt") * US_FOOT, F.col("elevation") * unit)}).drop("ellip_alt")
    return ordinal_names(df, "label", ["seq"])


_SHOT = "struct<camera:string,rotation:array<double>,translation:array<double>>"
_CAMERA = "struct<width:int,height:int,projection_type:string,focal:double,focal_x:double,focal_y:double,c_x:double,c_y:double,k1:double,k2:double,k3:double,p1:double,p2:double>"
#: Points are left out of the schema, so that they are never parsed into columns.
RECONSTRUCTION = f"cameras map<string,{_CAMERA}>, shots map<string,{_SHOT}>, reference_lla struct<latitude:double,longitude:double,altitude:double>"


def reconstruction(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The first reconstruction of each file: shots, cameras, reference."""
    text = spark.read.text(path, wholetext=True)
    first = text.select(F.get(F.from_json("value", f"array<struct<{RECONSTRUCTION.replace(' map<', ':map<').replace(' struct<', ':struct<')}>>"), F.lit(0)).alias("r")).where("r is not null")
    shots = first.select(F.explode("r.shots").alias("image", "s")).select("image", "s.*")
    cameras = first.select(F.explode("r.cameras").alias("camera", "camera_model"))
    return shots, cameras, first.select("r.reference_lla.*")


def brown_cameras(spark: SparkSession, path: str) -> DataFrame:
    """Brown models of a cameras file by (width, height); the last wins."""
    text = spark.read.text(path, wholetext=True)
    every = text.select(F.posexplode(F.map_entries(F.from_json("value", f"map<string,{_CAMERA}>"))).alias("seq", "e")).select("seq", "e.value.*").where("projection_type = 'brown'")
    return every.groupBy("width", "height").agg(F.max_by(F.struct("focal_x", "focal_y", "c_x", "c_y", "k1", "k2", "k3", "p1", "p2"), "seq").alias("camera_model"))


def exif_json(spark: SparkSession, path: str) -> DataFrame:
    """Saved image metadata; images without a position are dropped."""
    raw = spark.read.schema("SourceFile string, GPSLatitude double, GPSLongitude double, AbsoluteAltitude string, RelativeAltitude string, FocalLength double, FocalLengthIn35mmFormat double, ImageWidth int, ImageHeight int, GimbalPitchDegree double, GimbalYawDegree double, GimbalRollDegree double").option("multiLine", True).json(path)
    c = F.col
    return raw.where("GPSLatitude is not null and GPSLongitude is not null").select(file_name(c("SourceFile")).alias("image"), c("GPSLatitude").alias("lat"), c("GPSLongitude").alias("lon"), number(c("AbsoluteAltitude")).alias("abs_alt"), number(c("RelativeAltitude")).alias("rel_alt"), c("FocalLength").alias("focal_mm"), c("FocalLengthIn35mmFormat").alias("focal35_mm"), c("ImageWidth").alias("img_w"), c("ImageHeight").alias("img_h"), c("GimbalPitchDegree").alias("gimbal_pitch"), c("GimbalYawDegree").alias("gimbal_yaw"), c("GimbalRollDegree").alias("gimbal_roll"))


def control_dc(spark: SparkSession, path: str, shift_x: float = 0.0, shift_y: float = 0.0) -> DataFrame:
    """Control (69KI, the first of each id) and observed (81CB, 81KI; plausible coordinates) points of a .dc export, in
    file order; base stations (66..) with latitude and longitude in place of grid coordinates."""
    from pyspark.sql import Window

    df = lines(spark, path)
    slot = lambda s, i: F.trim(F.substring(s, 16 * i + 1, 16)).try_cast("double")
    c = df.where(F.col("line").startswith("69KI")).withColumn("r", F.ltrim(F.substring("line", 5, 1 << 20)))
    c = c.withColumn("pid", F.regexp_extract("r", r"^(\S+)\s+", 1)).withColumn("s", F.regexp_replace("r", r"^\S+\s+", "")).where((F.col("pid") != "") & (F.length("s") >= 48))
    elev = slot(F.col("s"), 2)
    c = c.select("file", "seq", F.col("pid").alias("point_id"), F.round(slot(F.col("s"), 1) - shift_x, 3).alias("easting_ft"), F.round(slot(F.col("s"), 0) - shift_y, 3).alias("northing_ft"), elev.alias("raw"), F.trim(F.substring("s", 49, 1 << 20)).alias("description"), F.lit("control").alias("point_type"))
    c = c.where("easting_ft is not null and northing_ft is not null and raw is not null").withColumn("elevation_ft", F.when((F.col("raw") != 0) & (F.col("raw") > -99999), F.round("raw", 2))).drop("raw")
    c = c.withColumn("k", F.row_number().over(Window.partitionBy("file", "point_id").orderBy("seq"))).where("k = 1").drop("k")
    o = df.where(F.col("line").rlike("^81(CB|KI)")).withColumn("s", F.trim(F.substring("line", 5, 1 << 20))).where(F.length("s") >= 49).withColumn("s", F.substring("s", 2, 1 << 20))
    o = o.select("file", "seq", F.round(slot(F.col("s"), 1) - shift_x, 3).alias("easting_ft"), F.round(slot(F.col("s"), 0) - shift_y, 3).alias("northing_ft"), F.lit("81CB/81KI").alias("description"), F.lit("observed").alias("point_type"), F.round(slot(F.col("s"), 2), 2).alias("elevation_ft"))
    o = o.where("easting_ft > 100000 and northing_ft > 100000 and elevation_ft is not null")
    o = o.withColumn("point_id", F.concat(F.lit("obs_"), F.row_number().over(Window.partitionBy("file").orderBy("seq")).cast("string")))
    pat = r"(\d+\.\d+)(-\d+\.\d+)(\d+\.\d+)(.*)"
    b = df.where(F.col("line").rlike(r"^66(FD|KI|SI)\s")).withColumn("s", F.ltrim(F.substring("line", 7, 1 << 20))).where(F.col("s").rlike(pat))
    b = b.select("file", "seq", F.trim(F.regexp_extract("s", r"^(.*?)\d+\.\d+-\d", 1)).alias("point_id"), F.regexp_extract("s", pat, 1).cast("double").alias("lat"), F.regexp_extract("s", pat, 2).cast("double").alias("lon"), F.round(F.regexp_extract("s", pat, 3).cast("double"), 2).alias("elevation_ft"), F.trim(F.regexp_extract("s", pat, 4)).alias("description"), F.lit("base").alias("point_type")).dropDuplicates(["file", "point_id", "lat", "lon"])
    return c.unionByName(o).unionByName(b, allowMissingColumns=True)


def landxml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Points (pid, x, y, z; the file's north-east order is turned) and faces (fid in file order, p1, p2, p3)."""
    text = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", r"<(/?)\w+:(\w)", "<$1$2").alias("v"))
    pts = text.select(F.explode(F.regexp_extract_all("v", F.lit(r"<P\s[^>]*id=\"[^\"]+\"[^>]*>[^<]*"), F.lit(0))).alias("p"))
    n = F.split(F.trim(F.regexp_extract("p", r">([^<]*)$", 1)), r"\s+")
    points = pts.select(F.regexp_extract("p", r"\sid=\"([^\"]+)\"", 1).alias("pid"), F.try_element_at(n, F.lit(2)).try_cast("double").alias("x"), F.try_element_at(n, F.lit(1)).try_cast("double").alias("y"), F.try_element_at(n, F.lit(3)).try_cast("double").alias("z")).where("x is not null and y is not null and z is not null")
    fs = text.select(F.posexplode(F.regexp_extract_all("v", F.lit(r"<F(?:\s[^>]*)?>([^<]*)"), F.lit(1))).alias("fid", "f")).withColumn("f", F.split(F.trim("f"), r"\s+")).where(F.size("f") >= 3)
    return points, fs.select("fid", *[F.col("f")[i].alias(f"p{i + 1}") for i in range(3)])


def mark_log(spark: SparkSession, path: str) -> DataFrame:
    """Mark and removal blocks of history files, as replay() takes them: seq goes on from file to file, by name."""
    from pyspark.sql import Window

    text = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    ops = text.select("file", F.posexplode(F.regexp_extract_all("value", F.lit(r"(?:MarkTiePoint|RemoveTiePoints)\s*\{(?:[^{}]|\{[^{}]*\})*\}"), F.lit(0))).alias("seq", "b"))
    before = ops.groupBy("file").agg(F.count("*").alias("n")).select("file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # a row for each file
    ops = ops.join(before, "file").select((F.col("seq") + F.col("before")).alias("seq"), "b")
    px = F.split(F.regexp_extract("b", r"pixelPosition\s*:\s*\[([^\]]*)\]", 1), ",")
    got = ops.select("seq", F.regexp_extract("b", r"^(\w+)", 1).alias("op"), F.nullif(file_name(F.regexp_extract("b", r"imagePath\s*:\s*\"([^\"]*)\"", 1)), F.lit("")).alias("image"), F.nullif(F.regexp_extract("b", r"\bname\s*:\s*'([^']*)'", 1), F.lit("")).alias("label"), F.try_element_at(px, F.lit(1)).try_cast("double").alias("px"), F.try_element_at(px, F.lit(2)).try_cast("double").alias("py"), F.regexp_extract_all(F.regexp_extract("b", r"names\s*:\s*\[([^\]]*)\]", 1), F.lit(r"'([^']*)'"), F.lit(1)).alias("names"))
    return got.where("(op = 'MarkTiePoint' and image is not null and label is not null and px is not null and py is not null) or (op = 'RemoveTiePoints' and size(names) > 0)")


def dc_header(spark: SparkSession, path: str) -> DataFrame:
    """Of each .dc file (file) the grid of its first C8NM record with a known zone (crs, null without one) and the job's name
    of its first 10NM record that has one, without a last number, else the file's stem; blanks as underscores."""
    from plumbline.functions.geodesy import fips_epsg
    from plumbline.functions.labels import file_stem

    rows = lines(spark, path)
    epsg = F.when(F.col("line").startswith("C8NM"), fips_epsg(F.col("line")))
    name = F.when(F.col("line").startswith("10NM"), F.nullif(F.trim(F.regexp_replace(F.trim(F.substr("line", F.lit(5))), r"\s+\d+\s*$", "")), F.lit("")))
    first = lambda v: F.min_by(v, F.when(v.isNotNull(), F.col("seq")))
    got = rows.groupBy("file").agg(first(epsg).alias("epsg"), first(name).alias("name"))
    return got.select("file", F.concat(F.lit("EPSG:"), F.col("epsg").cast("string")).alias("crs"), F.replace(F.coalesce("name", file_stem(F.col("file"))), F.lit(" "), F.lit("_")).alias("job"))


# Header names of mark tables, either convention.
MARK_ALIASES = {"image": {"filename", "image_name", "image"}, "label": {"label", "gcp_label", "name"}, "px": {"pixelx", "px", "x"}, "py": {"pixely", "py", "y"}}


def marks_csv(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).csv(path)
    named = {k: next((c for c in raw.columns if c.strip().lower() in a), None) for k, a in MARK_ALIASES.items()}
    if None in named.values():
        raise ValueError(f"no mark table: {raw.columns}")
    c = lambda k: F.col(f"`{named[k]}`")
    return raw.select(file_name(c("image")).alias("image"), F.trim(c("label")).alias("label"), number(c("px")).alias("px"), number(c("py")).alias("py")).where("px is not null and py is not null")


def targets_csv(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).csv(path)
    return raw.select("label", *[number(F.col(a)).alias(a.lower()) for a in "XYZ"]).where("x is not null and y is not null and z is not null")


def report_sections(cells: DataFrame) -> DataFrame:
    """Extracted report tables (page, tbl, row_no, cells) with section: a running count of header rows in reading order."""
    from pyspark.sql import Window

    head = F.exists("cells", lambda c: F.lower(c).rlike("^(gcp|label|name)")) & F.exists("cells", lambda c: F.lower(c).contains("error"))
    return cells.withColumn("is_header", F.coalesce(head, F.lit(False))).withColumn("section", F.sum(F.col("is_header").cast("int")).over(Window.partitionBy("report").orderBy("page", "tbl", "row_no")))


def dxf_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(file, pair_no, code, value); a line where a code should stand but no integer does is passed over alone."""

    def pair(parts):
        import pandas as pd

        for p in parts:
            for name, text in zip(p["file"], p["value"]):
                rows, out, i = text.splitlines(), [], 0
                while i + 1 < len(rows):
                    if re.fullmatch(r"\s*-?\d+\s*", rows[i]):
                        out.append((name, len(out), int(rows[i]), rows[i + 1].strip()))
                        i += 2
                    else:
                        i += 1
                yield pd.DataFrame(out, columns=["file", "pair_no", "code", "value"])

    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return text.mapInPandas(pair, "file string, pair_no long, code int, value string")


def metrics_json(spark: SparkSession, path: str) -> DataFrame:
    """Saved range queries as (metric, ts, value)."""
    kind = "struct<data:struct<result:array<struct<metric:map<string,string>,values:array<array<string>>>>>>"
    text = spark.read.text(path, wholetext=True).select(F.from_json("value", kind).alias("j"))
    rows = text.select(F.explode("j.data.result").alias("r")).select(F.col("r.metric")["__name__"].alias("metric"), F.explode("r.values").alias("v"))
    return rows.select("metric", F.timestamp_seconds(F.col("v")[0].try_cast("double")).alias("ts"), F.col("v")[1].try_cast("double").alias("value"))


def directory_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes under a path, without reading contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    return files.agg(F.count("*").alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def read_config(text: str) -> dict:
    """A job's two-level YAML: top keys to scalars or to maps of scalars; comments and quotes are dropped."""

    def scalar(v: str):
        v = v.strip()
        if v[:1] in "\"'" and v[-1:] == v[:1] and len(v) > 1:
            return v[1:-1]
        v = re.sub(r"\s+#.*$", "", v).strip()
        if v in ("", "null", "~"):
            return None
        if v.lower() in ("true", "false"):
            return v.lower() == "true"
        for kind in (int, float):
            try:
                return kind(v)
            except ValueError:
                pass
        return v

    out: dict = {}
    inside = None
    for line in text.splitlines():
        if not line.strip() or line.lstrip().startswith("#") or ":" not in line:
            continue
        key, _, value = line.partition(":")
        if line[0] in " \t":
            if inside is not None:
                out[inside][key.strip()] = scalar(value)
        elif value.strip() == "" or value.strip().startswith("#"):
            inside = key.strip()
            out[inside] = {}
        else:
            inside, out[key.strip()] = None, scalar(value)
    if "survey_crs" not in out and "field_crs" in out:
        out["survey_crs"] = out["field_crs"]
    return out


def write_config(config: dict) -> str:
    def scalar(v) -> str:
        if v is None:
            return "null"
        if isinstance(v, bool):
            return str(v).lower()
        return str(v) if not isinstance(v, str) or re.fullmatch(r"[A-Za-z_][\w./-]*", v) and v.lower() not in ("true", "false", "null") else f'"{v}"'

    rows = []
    for k, v in config.items():
        rows += [f"{k}:"] + [f"  {a}: {scalar(b)}" for a, b in v.items()] if isinstance(v, dict) else [f"{k}: {scalar(v)}"]
    return "\n".join(rows) + "\n"


def point_lines(points: DataFrame, crs: Column | str) -> DataFrame:
    """Lines of a point file (seq, line): the header, then seven tab-separated columns."""
    from plumbline.functions.labels import fixed, trimmed

    cells = [fixed(F.col(c), 3) for c in ("x", "y", "z")] + [trimmed(F.col(c), 2) for c in ("px", "py")] + [F.col("image"), F.col("label")]
    head = points.sparkSession.createDataFrame([(-1, crs)], "seq long, line string")
    return head.unionByName(points.select(F.col("seq").cast("long").alias("seq"), F.concat_ws("\t", *cells).alias("line")))


def write_lines(rows: DataFrame, path: str) -> None:
    """One text file, in order of seq; such files are a survey's few thousand lines."""
    rows.coalesce(1).sortWithinPartitions("seq").select("line").write.mode("overwrite").text(path)


def write_tagging(rows: DataFrame, crs: str, path: str) -> None:
    """The lines of tagging_rows() under a header, or an empty file if there are none."""
    head = rows.limit(1).select(F.lit(0).alias("rank"), F.lit(crs).alias("line"))
    write_lines(head.unionByName(rows.select("rank", "line")).withColumnRenamed("rank", "seq"), path)


def metric_summary(metrics: DataFrame, keys: list[str]) -> DataFrame:
    """N, min, p50, p95, max and mean of value (ts, value) by keys, to 3 places; p50 and p95 as the reference takes them,
    sorted[int(share * (n - 1))], and NaN values left out."""
    from plumbline.operators.stats import index_percentile

    v = F.col("value")
    one = metrics.where(v.isNotNull() & ~F.isnan(v)).groupBy(*keys).agg(F.count("*").alias("n"), F.min(v).alias("min"), index_percentile(v, 0.5).alias("p50"), index_percentile(v, 0.95).alias("p95"), F.max(v).alias("max"), F.avg(v).alias("mean"))
    return one.select(*keys, "n", *[F.bround(c, 3).alias(c) for c in ("min", "p50", "p95", "max", "mean")])


def write_metric_export(metrics: DataFrame, path: str) -> None:
    """The values by job and metric as JSON, and a summary row for each. metrics: job, metric, ts, value."""
    metrics.repartition("job", "metric").write.mode("overwrite").partitionBy("job", "metric").json(f"{path}/raw")
    metric_summary(metrics, ["job", "metric"]).coalesce(1).write.mode("overwrite").json(f"{path}/summary")


def write_marks(marks: DataFrame, path: str) -> None:
    marks.orderBy("label", "image").coalesce(1).select(F.col("image").alias("Filename"), F.col("label").alias("Label"), F.col("px").alias("PixelX"), F.col("py").alias("PixelY")).write.mode("overwrite").option("header", True).csv(path)


def write_targets(targets: DataFrame, monuments: DataFrame, path: str) -> None:
    both = targets.withColumn("type", F.lit("target")).unionByName(monuments.withColumn("type", F.lit("monument"))).dropna(subset=["label", "x", "y", "z"])
    both.coalesce(1).select("label", *[F.format_string("%.4f", a).alias(a.upper()) for a in "xyz"], "type").write.mode("overwrite").option("header", True).csv(path)

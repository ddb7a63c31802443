"""Labels, file names and number formats as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_label(label: Column) -> Column:
    """Without one CHK-, GCP- or DUP- prefix and a -dup number; letters and digits only, upper case."""
    bare = F.regexp_replace(F.regexp_replace(label, "^(CHK-|GCP-|DUP-)", ""), "-dup[0-9]*$", "")
    return F.upper(F.regexp_replace(bare, "[^A-Za-z0-9]", ""))


def base_label(label: Column) -> Column:
    """Without role prefix and -dup number; case and punctuation stay."""
    return F.regexp_replace(F.regexp_replace(label, "^(CHK-|GCP-|DUP-)", ""), "-dup[0-9]*$", "")


def is_duplicate_label(label: Column) -> Column:
    return label.startswith("DUP-") | label.rlike("-dup[0-9]*$")


def short_image(image: Column) -> Column:
    """The last run of digits of the file's stem; without one, the stem."""
    stem = file_stem(image)
    return F.coalesce(F.try_element_at(F.regexp_extract_all(stem, F.lit(r"\d+"), F.lit(0)), F.lit(-1)), stem)


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/\\]*$", 0)


def file_stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def epsg_number(crs: Column) -> Column:
    """The first run of digits as a number; null without one."""
    return F.regexp_extract(crs, r"(\d+)", 1).try_cast("int")


def fixed(value: Column, decimals: int) -> Column:
    """Text with so many decimals of a double's exact value, halves to even; null stays null.

    format_string() rounds the shortest decimal form, half up. Where that form is a half, the exact product with
    2 * 10 ** decimals, as a double and its error (by Veltkamp's split), says on which side the value lies."""
    value, two = value.cast("double"), float(2 * 10**decimals)
    p, wide = value * two, value * 134217729.0
    high = wide - (wide - value)
    near = F.rint(p)
    rest = (p - near) + ((high * two - p) + (value - high) * two)
    low = F.floor(near / 2)
    up = (rest > 0) | ((rest == 0) & (F.pmod(low, F.lit(2)) == 1))
    half = (F.abs(rest) <= F.abs(p) * 1e-15) & (F.pmod(near, F.lit(2.0)) == 1)
    return F.when(value.isNotNull(), F.format_string(f"%.{decimals}f", F.when(half, (low + up.cast("int")) / F.lit(float(10**decimals))).otherwise(value)))


def trimmed(value: Column, decimals: int) -> Column:
    """As fixed(), without trailing zeros and point."""
    return F.regexp_replace(F.regexp_replace(fixed(value, decimals), r"(\.\d*?)0+$", "$1"), r"\.$", "")


def same_decimals(text: Column, value: Column, least: int = 3) -> Column:
    """value with as many decimals as text has, `least` at least."""
    n = F.greatest(F.length(F.coalesce(F.try_element_at(F.split(text, r"\."), F.lit(2)), F.lit(""))), F.lit(least))
    return F.regexp_replace(F.format_number(value, n), ",", "")


def number(text: Column) -> Column:
    """A number, also with thousands commas; null for blanks and anything else."""
    return F.regexp_replace(F.trim(text), ",", "").try_cast("double")


def bbox(text: Column) -> Column:
    """'x1,y1,x2,y2' as a struct of ints; null unless four numbers."""
    p = F.transform(F.split(text, ","), lambda v: F.trim(v).try_cast("int"))
    ok = (F.size(p) == 4) & F.forall(p, lambda v: v.isNotNull())
    return F.when(ok, F.struct(*[F.try_element_at(p, F.lit(i + 1)).alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))]))


# Phrases of quality reports, case and all.
FAIL_PHRASES = ["more than 2.5 times the average GSD", "more than 20%", "less than 100%"]
WARN_PHRASES = ["percentage of difference between", "Median of fewer than"]


def severity(text: Column) -> Column:
    """fail before warn before ok, by the phrases that a report's detail holds; null for null and empty text."""
    holds = lambda phrases: F.exists(F.array(*[F.lit(x) for x in phrases]), lambda x: F.contains(text, x))
    return F.when(text == "", F.lit(None)).when(holds(FAIL_PHRASES), "fail").when(holds(WARN_PHRASES), "warn").when(text.isNotNull(), "ok")


def survey_tool(application: Column) -> Column:
    low = F.lower(application)
    return F.when(low.contains("pix4d"), "pix4d").when(low.contains("odm") | low.contains("opendrone"), "odm").otherwise("unknown")


def strip_namespaces(xml: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(xml, r'\sxmlns(:\w+)?="[^"]*"', ""), r"<(/?)\w+:", "<$1")


def last_wkt_epsg(wkt: Column) -> Column:
    """The last EPSG authority code in a WKT text."""
    found = F.regexp_extract_all(wkt, F.lit(r'(?:AUTHORITY\["EPSG",\s*"|ID\["EPSG",\s*)(\d+)'), F.lit(1))
    return F.try_element_at(found, F.lit(-1)).try_cast("int")

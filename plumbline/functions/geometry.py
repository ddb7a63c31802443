"""Plane geometry, rasters and tiles as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def barycentric(x: Column, y: Column, p1, p2, p3, eps: float = 1e-9) -> Column:
    """The height at (x, y) in the triangle of three (x, y, z); null outside it and for degenerate triangles."""
    (x1, y1, z1), (x2, y2, z2), (x3, y3, z3) = p1, p2, p3
    d = (y2 - y3) * (x1 - x3) + (x3 - x2) * (y1 - y3)
    ok = F.abs(d) >= 1e-15
    d = F.when(ok, d)
    a = ((y2 - y3) * (x - x3) + (x3 - x2) * (y - y3)) / d
    b = ((y3 - y1) * (x - x3) + (x1 - x3) * (y - y3)) / d
    c = 1.0 - a - b
    return F.when(a.between(-eps, 1 + eps) & b.between(-eps, 1 + eps) & c.between(-eps, 1 + eps), a * z1 + b * z2 + c * z3)


def scale_about(v: Column, anchor: float, factor: float, shift: float) -> Column:
    return anchor + (v - anchor) * factor + shift


def pixel_to_map(col: Column, row: Column, gt: list[float]) -> tuple[Column, Column]:
    return gt[0] + col * gt[1] + row * gt[2], gt[3] + col * gt[4] + row * gt[5]


def map_to_pixel(x: Column, y: Column, gt: list[float]) -> tuple[Column, Column]:
    det = gt[1] * gt[5] - gt[2] * gt[4]
    return ((x - gt[0]) * gt[5] - (y - gt[3]) * gt[2]) / det, ((y - gt[3]) * gt[1] - (x - gt[0]) * gt[4]) / det


def downsize_factor(percent: Column, gsd: Column, target_gsd: Column, size_gb: Column, target_gb: Column) -> Column:
    """Percent first, then ground sample distance, then size, else 0.3 over 20 GB; never above 1."""
    out = F.when(percent.isNotNull(), percent / 100.0).when(target_gsd.isNotNull(), gsd / target_gsd)
    out = out.when(target_gb.isNotNull(), F.sqrt(target_gb / size_gb)).when(size_gb > 20, 0.3).otherwise(1.0)
    return F.least(out, F.lit(1.0))


def grid_cell(v: Column, low: Column, high: Column, n: Column) -> Column:
    """The cell of v in [low, high] cut into n; the upper edge belongs to the last."""
    return F.least(F.floor((v - low) / (high - low) * n), n - 1)


def tiles(width: Column, height: Column, size: int) -> Column:
    """The tiles of a raster as an array of (tx, ty, x, y, w, h), row by row."""
    xs = F.sequence(F.lit(0), F.floor((width - 1) / size).cast("int"))
    ys = F.sequence(F.lit(0), F.floor((height - 1) / size).cast("int"))
    one = lambda tx, ty: F.struct(tx.alias("tx"), ty.alias("ty"), (tx * size).alias("x"), (ty * size).alias("y"), F.least(F.lit(size), width - tx * size).alias("w"), F.least(F.lit(size), height - ty * size).alias("h"))
    return F.flatten(F.transform(ys, lambda ty: F.transform(xs, lambda tx: one(tx, ty))))


def uncertainty(sigma_dtm: Column, off_nadir: Column, sigma_recon: Column) -> Column:
    return sigma_dtm * F.tan(off_nadir) + sigma_recon


def ramp(v: Column, low: float, high: float) -> Column:
    """A share of a colour ramp, 0 to 1."""
    return F.least(F.greatest((v - low) / (high - low), F.lit(0.0)), F.lit(1.0))


def bilinear(v00: Column, v10: Column, v01: Column, v11: Column, fx: Column, fy: Column) -> Column:
    return v00 * (1 - fx) * (1 - fy) + v10 * fx * (1 - fy) + v01 * (1 - fx) * fy + v11 * fx * fy

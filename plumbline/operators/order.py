"""Order-dependent operators over one survey's targets: near-duplicate splitting, structural order, robust fits.

Each survey (group) is a few hundred rows and independent of others, so groups run in parallel as pandas groups.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.geodesy import DEGREE_M


def _metres(lat1, lon1, lat2, lon2) -> np.ndarray:
    mid = np.radians((lat1 + lat2) / 2)
    return np.hypot((lon2 - lon1) * DEGREE_M * np.cos(mid), (lat2 - lat1) * DEGREE_M)


def split_near_duplicates(df: DataFrame, tolerance: float) -> DataFrame:
    """(survey, tid, seq, lat, lon) with main_tid and dist: rows nearer than tolerance to an accepted main, taken in
    order of seq, are demoted to the nearest; mains have nulls."""

    def one(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["seq", "tid"]).reset_index(drop=True)
        lat, lon, main, out = p["lat"].to_numpy(float), p["lon"].to_numpy(float), [], []
        for i in range(len(p)):
            if main:
                d = _metres(lat[i], lon[i], lat[main], lon[main])
                j = int(d.argmin())
                if d[j] < tolerance:
                    out.append((p["tid"][main[j]], float(d[j])))
                    continue
            main.append(i)
            out.append((None, None))
        return pd.DataFrame({"survey": p["survey"], "tid": p["tid"], "main_tid": pd.array([o[0] for o in out], "Int64"), "dist": [o[1] for o in out]})

    return df.groupBy("survey").applyInPandas(one, "survey string, tid long, main_tid long, dist double")


def structural_order(df: DataFrame, z_threshold: float) -> DataFrame:
    """(survey, tid, seq, x, y, z) with rank and z_critical.

    First the farthest from the centroid, then the farthest from it; where heights range over z_threshold times the
    plan's diagonal, the highest and the lowest, each with half weight on distance from those chosen; the most central;
    then whichever is farthest from all chosen. Ties: the first by seq."""

    def one(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["seq", "tid"]).reset_index(drop=True)
        x, y, z = (p[c].to_numpy(float) for c in "xyz")
        n, left, chosen = len(p), np.ones(len(p), bool), []
        diag = math.hypot(np.ptp(x), np.ptp(y)) or 1.0
        steep = n > 1 and np.ptp(z) > z_threshold * diag
        centre = np.hypot(x - x.mean(), y - y.mean())
        near = np.full(n, np.inf)

        def take(score: np.ndarray) -> None:
            i = int(np.where(left, score, -np.inf).argmax())
            left[i] = False
            chosen.append(i)
            np.minimum(near, np.hypot(x - x[i], y - y[i]), out=near)

        take(centre)
        if left.any():
            take(near)
        for rise in (z - z.min(), z.max() - z) if steep else ():
            if left.any():
                take(rise / np.ptp(z) + 0.5 * near / diag)
        if left.any():
            take(-centre)
        while left.any():
            take(near)
        rank = np.empty(n, int)
        rank[chosen] = np.arange(1, n + 1)
        critical = np.zeros(n, bool)
        if steep:
            critical[[int(z.argmax()), int(z.argmin())]] = True
        return pd.DataFrame({"survey": p["survey"], "tid": p["tid"], "rank": rank, "z_critical": critical})

    return df.groupBy("survey").applyInPandas(one, "survey string, tid long, rank int, z_critical boolean")


def fit_similarity(df: DataFrame, key: str) -> DataFrame:
    """Scale, rotation (row by row) and shift that best map (x, y, z) to (tx, ty, tz) for each key; nulls under 3 rows."""

    def one(p: pd.DataFrame) -> pd.DataFrame:
        a, b = p[["x", "y", "z"]].to_numpy(float), p[["tx", "ty", "tz"]].to_numpy(float)
        if len(p) < 3:
            return pd.DataFrame({key: [p[key].iloc[0]], "scale": [None], "rotation": [None], "shift": [None]})
        ma, mb = a.mean(0), b.mean(0)
        u, s, vt = np.linalg.svd((b - mb).T @ (a - ma) / len(p))
        flip = np.diag([1, 1, np.sign(np.linalg.det(u) * np.linalg.det(vt))])
        r = u @ flip @ vt
        scale = float((s * np.diag(flip)).sum() / ((a - ma) ** 2).sum() * len(p))
        return pd.DataFrame({key: [p[key].iloc[0]], "scale": [scale], "rotation": [r.ravel().tolist()], "shift": [(mb - scale * r @ ma).tolist()]})

    return df.groupBy(key).applyInPandas(one, f"{key} string, scale double, rotation array<double>, shift array<double>")


def robust_points(df: DataFrame, key: str, eps: float = 8.0, max_drops: int = 2) -> DataFrame:
    """The point whose projections fit each key's pixels best, by Levenberg-Marquardt from (x0, y0, z0).

    Rows: key, px, py, the 3 x 4 projection matrix (row by row) and w, h; a projection out of frame counts as an error
    of 1e4 pixels. Three rows at least; while the largest residual is over eps and more than three remain, the worst row is
    dropped, max_drops times at most. Columns: x, y, z, max_resid, n_used, status (ok, skipped or failed)."""

    def solve(p: pd.DataFrame):
        m = np.array(p["matrix"].tolist(), float).reshape(-1, 3, 4)
        seen, size = p[["px", "py"]].to_numpy(float), p[["w", "h"]].to_numpy(float)

        def errors(q):
            c = m[:, :, :3] @ q + m[:, :, 3]
            with np.errstate(all="ignore"):
                at = c[:, :2] / c[:, 2:3]
            out = (c[:, 2] <= 0) | ~np.isfinite(at).all(1) | (at < 0).any(1) | (at >= size).any(1)
            return np.where(out[:, None], 1e4, at - seen)

        q, lam = p[["x0", "y0", "z0"]].iloc[0].to_numpy(float), 1e-3
        e = errors(q)
        for _ in range(60):
            j = np.stack([((errors(q + d) - e) / 1e-4).ravel() for d in np.eye(3) * 1e-4], 1)
            h, g = j.T @ j, j.T @ e.ravel()
            try:
                step = np.linalg.solve(h + lam * np.diag(np.diag(h) + 1e-12), -g)
            except np.linalg.LinAlgError:
                return None
            new = errors(q + step)
            if (new**2).sum() < (e**2).sum():
                q, e, lam = q + step, new, lam / 3
                if np.abs(step).max() < 1e-9:
                    break
            else:
                lam *= 4
                if lam > 1e12:
                    break
        return q, np.hypot(e[:, 0], e[:, 1])

    def one(p: pd.DataFrame) -> pd.DataFrame:
        k, got = p[key].iloc[0], None
        if len(p) >= 3:
            got = solve(p)
            drops = 0
            while got is not None and drops < max_drops and len(p) > 3 and got[1].max() > eps:
                p = p.drop(p.index[int(got[1].argmax())])
                got, drops = solve(p), drops + 1
        status = "skipped" if len(p) < 3 else "failed" if got is None else "ok"
        q = got[0] if got is not None else [None] * 3
        return pd.DataFrame({key: [k], "x": [q[0]], "y": [q[1]], "z": [q[2]], "max_resid": [float(got[1].max()) if got is not None else None], "n_used": [len(p)], "status": [status]})

    return df.groupBy(key).applyInPandas(one, f"{key} string, x double, y double, z double, max_resid double, n_used int, status string")


def gate(df: DataFrame, resid_px: float = 120.0, shift_m: float = 15.0) -> DataFrame:
    """gate: skipped, failed, COLOR_INCONSISTENT over resid_px, else SURVEY_DISAGREES over shift_m, else PASS."""
    g = F.when(F.col("status") == "skipped", "skipped").when(F.col("status") == "failed", "failed").when(F.col("max_resid") > resid_px, "COLOR_INCONSISTENT")
    return df.withColumn("gate", g.when(F.col("shift_m") > shift_m, "SURVEY_DISAGREES").otherwise("PASS"))

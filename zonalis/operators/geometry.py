"""Ring arithmetic that needs per-row iteration, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.functions import geo

# Tolerance in degrees by level of detail.
TOLERANCES = {"high_detail": 0.00001, "medium_detail": 0.0001, "low_detail": 0.001, "overview": 0.01}


def _keep_points(pts: np.ndarray, tolerance: float) -> np.ndarray:
    """Points of an open line that stay more than the tolerance from every shortcut."""
    keep = np.zeros(len(pts), bool)
    keep[[0, -1]] = True
    spans = [(0, len(pts) - 1)]
    while spans:
        a, b = spans.pop()
        if b - a < 2:
            continue
        mid = pts[a + 1:b] - pts[a]
        line = pts[b] - pts[a]
        square = float(line @ line)
        # Distance to the segment: the foot of the perpendicular stays on it.
        along = np.clip(mid @ line / square, 0, 1) if square else np.zeros(len(mid))
        away = np.hypot(*(mid - along[:, None] * line).T)
        i = int(np.argmax(away))
        if away[i] > tolerance:
            keep[a + 1 + i] = True
            spans += [(a, a + 1 + i), (a + 1 + i, b)]
    return pts[keep]


def simplified(tolerance: float):
    """Pandas UDF over an array of rings; rings left with fewer than four points go."""

    @F.pandas_udf("array<array<array<double>>>")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out = []
            for rings in s:
                if rings is None:
                    out.append(None)
                    continue
                kept = []
                for ring in rings:
                    pts = np.array([list(p) for p in ring], float)
                    if len(pts) > 4:
                        line = _keep_points(pts[:-1], tolerance)
                        pts = np.vstack([line, line[:1]])
                    if len(pts) >= 4:
                        kept.append(pts.tolist())
                out.append(kept)
            yield pd.Series(out)

    return udf


def simplify(df: DataFrame, rings: str, detail: str = "medium_detail", out: str | None = None) -> DataFrame:
    return df.withColumn(out or rings, simplified(TOLERANCES[detail])(F.col(rings)))


def outline_facts(rings: Column) -> dict[str, Column]:
    """Bounding box, point count and box area of a polygon's rings."""
    box = geo.ring_bbox(F.flatten(rings))
    points = F.aggregate(rings, F.lit(0), lambda a, r: a + F.size(r))
    return {**box, "points": points, "bbox_area_km2": geo.bbox_area_km2(box)}


def multipolygon_facts(polygons: Column) -> dict[str, Column]:
    return outline_facts(F.flatten(polygons))

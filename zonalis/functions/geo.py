"""Coordinates, distances and geometry arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonalis.functions import fixed_values as V

EARTH_KM = 6371.0
EARTH_EQUATOR_KM = 6378.137


def _half_chord(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    s1, s2 = F.sin(dlat / 2), F.sin(dlon / 2)
    return s1 * s1 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * s2 * s2


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_KM) -> Column:
    a = _half_chord(lat1, lon1, lat2, lon2)
    return F.lit(2 * radius) * F.asin(F.least(F.sqrt(a), F.lit(1.0)))


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column,
                    radius: float = EARTH_EQUATOR_KM) -> Column:
    a = _half_chord(lat1, lon1, lat2, lon2)
    return F.lit(2 * radius) * F.atan2(F.sqrt(a), F.sqrt(F.greatest(1 - a, F.lit(0.0))))


def planar_km(x1: Column, y1: Column, x2: Column, y2: Column, units: str = "degrees") -> Column:
    dx, dy = x2 - x1, y2 - y1
    if units == "degrees":
        dx = dx * 111.32 * F.cos(F.radians((y1 + y2) / 2))
        dy = dy * 110.54
    d = F.sqrt(dx * dx + dy * dy)
    if units == "metres":
        return d / 1000.0
    if units not in ("degrees", "kilometres"):
        raise ValueError(f"unsupported units: {units}")
    return d


def bearing_degrees(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    p1, p2, dlon = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    y = F.sin(dlon) * F.cos(p2)
    x = F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dlon)
    d = F.degrees(F.atan2(y, x))
    return F.when(d < 0, d + 360).otherwise(d)


def in_bounds(lon: Column, lat: Column, box: tuple[float, float, float, float]) -> Column:
    return lon.between(box[0], box[1]) & lat.between(box[2], box[3])


def mga_zone(lon: Column, lat: Column) -> Column:
    """Six-degree zone 49-56 inside the territories; null outside."""
    zone = (F.floor((lon - 114) / 6) + 49).cast("int")
    return (
        F.when(~in_bounds(lon, lat, V.BOUNDS["all_territories"]), None)
        .when(lon >= 156, 56).when(lon >= 114, zone)
    )


def state_of_point(lon: Column, lat: Column) -> Column:
    """First state, in code order, whose box holds the point."""
    out = None
    for state, box in V.STATE_BOUNDS.items():
        hit = in_bounds(lon, lat, box)
        out = F.when(hit, state) if out is None else out.when(hit, state)
    return out


def to_gda2020_approx(lon: Column, lat: Column, system: Column) -> tuple[Column, Column, Column]:
    """(longitude, latitude, error) after the approximate datum shift; zone-tagged
    systems keep degrees when the longitude lies in the zone."""
    name = F.upper(system)
    zone = F.regexp_extract(name, r"^MGA_ZONE_(\d+)$", 1)
    zone_ok = (zone != "") & (F.coalesce(zone.try_cast("int"), F.lit(-1)) == F.floor((lon - 114) / 6) + 49)
    dx = dy = None
    for s, (x, y) in V.DATUM_SHIFT.items():
        dx = F.when(name == s, x) if dx is None else dx.when(name == s, x)
        dy = F.when(name == s, y) if dy is None else dy.when(name == s, y)
    dx, dy = dx.when(zone_ok, 0.0), dy.when(zone_ok, 0.0)
    error = F.when(lon.isNull() | lat.isNull(), "missing_coordinate").when(dx.isNull(), "unsupported_system")
    return lon + dx, lat + dy, error


def coordinate_problem(lon: Column, lat: Column, box: tuple[float, float, float, float]) -> Column:
    return (
        F.when(lon.isNull() | lat.isNull(), "invalid_coordinate_format")
        .when(~lon.between(-180, 180), "longitude_out_of_range")
        .when(~lat.between(-90, 90), "latitude_out_of_range")
        .when((lon == 0) & (lat == 0), "null_island")
        .when(~in_bounds(lon, lat, box), "outside_bounds")
        .otherwise("coordinates_valid")
    )


def density_urbanisation(d: Column) -> Column:
    return (F.when(d >= 400, "major_urban").when(d >= 100, "other_urban")
            .when(d >= 10, "bounded_locality").otherwise("rural_balance"))


def density_remoteness(d: Column) -> Column:
    return (F.when(d >= 400, "Major Cities").when(d >= 100, "Inner Regional")
            .when(d >= 10, "Outer Regional").otherwise("Remote"))


def centre_distances(lat: Column, lon: Column) -> dict[str, Column]:
    """Planar km (degrees x 111, one decimal) to each major centre."""
    return {
        city: F.round(F.sqrt(F.pow(lat - a, F.lit(2)) + F.pow(lon - b, F.lit(2))) * 111, 1)
        for city, (a, b) in V.MAJOR_CENTRES.items()
    }


def accessibility_score(nearest_km: Column) -> Column:
    return (
        F.when(nearest_km <= 50, 100.0)
        .when(nearest_km <= 200, 100.0 - (nearest_km - 50) / 150 * 50)
        .otherwise(F.greatest(F.lit(0.0), 50.0 - (nearest_km - 200) / 500 * 50))
    )


def ring_bbox(ring: Column) -> dict[str, Column]:
    """Box of an array of [lon, lat] points."""
    xs, ys = F.transform(ring, lambda p: p[0]), F.transform(ring, lambda p: p[1])
    return {"min_lon": F.array_min(xs), "max_lon": F.array_max(xs),
            "min_lat": F.array_min(ys), "max_lat": F.array_max(ys)}


def bbox_area_km2(box: dict[str, Column]) -> Column:
    mid = (box["min_lat"] + box["max_lat"]) / 2
    return ((box["max_lon"] - box["min_lon"]) * 111.32 * F.cos(F.radians(mid))
            * (box["max_lat"] - box["min_lat"]) * 110.54)


def ring_problems(ring: Column) -> Column:
    """Array of rule ids broken by one ring."""
    n = F.size(ring)
    bad = [
        F.when(n < 4, "too_few_points"),
        F.when((n > 0) & (F.try_element_at(ring, F.lit(1)) != F.try_element_at(ring, F.lit(-1))), "ring_not_closed"),
        F.when(F.exists(ring, lambda p: ~p[0].between(-180, 180) | ~p[1].between(-90, 90)), "coordinate_out_of_range"),
        F.when(F.exists(ring, lambda p: ~in_bounds(p[0], p[1], V.BOUNDS["all_territories"])), "outside_australia"),
    ]
    return F.array_compact(F.array(*bad))


def polygon_wkt(ring: Column) -> Column:
    """POLYGON text of an outer ring."""
    points = F.transform(ring, lambda p: F.concat_ws(" ", p[0].cast("string"), p[1].cast("string")))
    return F.concat(F.lit("POLYGON(("), F.array_join(points, ", "), F.lit("))"))


def rounded_ring(ring: Column, places: int = 6) -> Column:
    return F.transform(ring, lambda p: F.transform(p, lambda v: F.round(v, places)))

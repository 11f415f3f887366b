"""Distances on the globe as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
METRES_PER_DEGREE = EARTH_KM * 1000.0 * 3.141592653589793 / 180.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "m") -> Column:
    """Great-circle distance in metres or kilometres; null if a coordinate is."""
    a1, a2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * (1000.0 if unit == "m" else 1.0) * F.atan2(F.sqrt(h), F.sqrt(1 - h))


def _foot(px: Column, py: Column, qx: Column, qy: Column) -> Column:
    """How far along a segment, from 0 to 1, the point nearest to the origin lies; 0 on a segment of no length."""
    dx, dy = qx - px, qy - py
    along = F.coalesce(F.try_divide(-(px * dx + py * dy), dx * dx + dy * dy), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))


def _length_to(px: Column, py: Column, qx: Column, qy: Column, t: Column) -> Column:
    """Distance from the origin to the place t along a segment."""
    return F.sqrt(F.pow(px + t * (qx - px), 2) + F.pow(py + t * (qy - py), 2))


def segment_distance(lon: Column, lat: Column, lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Metres from a point to one segment, as ``line_distance`` measures."""
    shrink = F.cos(F.radians(lat))
    x = lambda v: (v - lon) * METRES_PER_DEGREE * shrink
    y = lambda v: (v - lat) * METRES_PER_DEGREE
    ends = (x(lon1), y(lat1), x(lon2), y(lat2))
    return _length_to(*ends, _foot(*ends))


def _legs(values: Column, make) -> Column:
    """What ``make`` gives for each two neighbours of an array; the last one, or a lone one, stands beside itself."""
    return F.zip_with(values, F.slice(F.concat(values, F.slice(values, -1, 1)), 2, 1 << 20), lambda p, q: F.when(p.isNotNull() & q.isNotNull(), make(p, q)))


def _around(lon: Column, lat: Column, line: Column) -> Column:
    """A line's points in metres east and north of a point."""
    shrink = F.cos(F.radians(lat))
    return F.transform(line, lambda p: F.struct(((p["lon"] - lon) * METRES_PER_DEGREE * shrink).alias("x"), ((p["lat"] - lat) * METRES_PER_DEGREE).alias("y")))


def line_distance(lon: Column, lat: Column, line: Column) -> Column:
    """Metres from a point to a polyline, an array of (lon, lat) structs.

    Around the point a degree is EARTH times its radians, and east-west shrinks by
    the cosine; each segment's nearest point is then plane geometry. A line of one
    point is that point; an empty line gives null.
    """

    def nearest(p: Column, q: Column) -> Column:
        ends = (p["x"], p["y"], q["x"], q["y"])
        return _length_to(*ends, _foot(*ends))

    return F.when(F.size(line) > 0, F.array_min(_legs(_around(lon, lat, line), nearest)))


def line_lengths(line: Column) -> Column:
    """Metres along a polyline at each of its points, by great circles; the first is 0."""
    steps = F.slice(_legs(line, lambda p, q: haversine(p["lat"], p["lon"], q["lat"], q["lon"])), 1, F.greatest(F.size(line) - 1, F.lit(0)))
    return F.aggregate(steps, F.array(F.lit(0.0)), lambda seen, x: F.concat(seen, F.array(F.element_at(seen, -1) + x)))


def line_place(lon: Column, lat: Column, line: Column, lengths: Column) -> Column:
    """The place on a polyline nearest to a point: a struct of offset_m, segment (from 0) and along_m.

    ``lengths`` is ``line_lengths`` of the line. Of places equally near the first
    counts. Null for a line without points or a point without a place.
    """

    def place(p: Column, q: Column) -> Column:
        ends = (p["x"], p["y"], q["x"], q["y"])
        t = _foot(*ends)
        return F.struct(_length_to(*ends, t).alias("offset_m"), t.alias("t"))

    feet = F.transform(_legs(_around(lon, lat, line), place), lambda f, i: F.when(f["offset_m"].isNotNull(), F.struct(f["offset_m"].alias("offset_m"), i.alias("segment"), f["t"].alias("t"))))
    best = F.array_min(feet)
    start, end = F.get(lengths, best["segment"]), F.get(lengths, best["segment"] + 1)
    along = start + best["t"] * (F.coalesce(end, start) - start)
    return F.when(best.isNotNull(), F.struct(best["offset_m"].alias("offset_m"), best["segment"].alias("segment"), along.alias("along_m")))

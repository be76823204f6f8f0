"""Places: pairing labels with coordinates, distance, and which are near."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed
from .text import once, strip_plain

PLACE = "array<struct<label:string,state:string,lat:double,lon:double,distance_miles:double>>"


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), F.lit(2))
    a = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return F.lit(fixed.EARTH_RADIUS_METERS * 2) * F.asin(F.sqrt(a)) / F.lit(fixed.METERS_PER_MILE)


def state_of(label: Column) -> Column:
    """The part before the last of three or more comma-separated parts."""
    parts = F.array_remove(F.transform(F.split(label, ","), strip_plain), "")
    return once(parts, lambda p: F.when(F.size(p) >= 3, F.element_at(p, F.size(p) - 1)))


def coordinate(value: Column) -> Column:
    finite = ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    return F.when(finite, value)


def places(labels: Column, points: Column) -> Column:
    """Labels (array<string>) paired by position with points (array<struct<lat, lon, lng>>).

    A label without a point stays, without coordinates; a longitude of zero falls through to ``lng``.
    """
    zipped = F.arrays_zip(labels.alias("label"), points.alias("point"))
    trimmed = F.transform(zipped, lambda z: F.struct(strip_plain(z["label"]).alias("label"), z["point"].alias("point")))
    named = F.filter(trimmed, lambda z: F.coalesce(z["label"], F.lit("")) != "")
    lon = lambda p: F.coalesce(F.nullif(p["lon"], F.lit(0.0)), p["lng"])
    return F.transform(
        named,
        lambda z: F.struct(
            z["label"].alias("label"), state_of(z["label"]).alias("state"),
            coordinate(z["point"]["lat"]).alias("lat"), coordinate(lon(z["point"])).alias("lon"),
        ),
    )


def near(found: Column, lat: float, lon: float, radius_miles: float, excluded_states: list[str]) -> Column:
    """Places within the radius and outside the states, nearest first; those without coordinates last."""
    out_of = [s.strip().lower() for s in excluded_states]
    allowed = F.filter(found, lambda p: ~F.coalesce(F.lower(p["state"]).isin(*out_of), F.lit(False))) if out_of else found
    miles = lambda p: haversine_miles(F.lit(lat), F.lit(lon), p["lat"], p["lon"])
    measured = F.transform(allowed, lambda p: F.struct(*[p[c].alias(c) for c in ("label", "state", "lat", "lon")], miles(p).alias("distance_miles")))
    inside = F.filter(measured, lambda m: m["distance_miles"].isNull() | (m["distance_miles"] <= radius_miles))
    placed = F.transform(inside, lambda m, i: F.struct(m["distance_miles"].isNull().alias("far"), F.coalesce(m["distance_miles"], F.lit(0.0)).alias("d"), i.alias("i"), m.alias("m")))
    return F.transform(F.sort_array(placed), lambda x: x["m"])

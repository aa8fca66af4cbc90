"""Places: equal-area coordinates, grid cells, and sun times, as expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# The GRS80 ellipsoid and the parameters of the European equal-area projection (EPSG:3035).
_A, _F = 6378137.0, 1 / 298.257222101
_LAT0, _LON0, _X0, _Y0 = 52.0, 10.0, 4321000.0, 3210000.0

_E2 = 2 * _F - _F * _F
_E = math.sqrt(_E2)


def _q(sin: float) -> float:
    return (1 - _E2) * (sin / (1 - _E2 * sin * sin) - math.log((1 - _E * sin) / (1 + _E * sin)) / (2 * _E))


_QP = _q(1.0)
_B0 = math.asin(_q(math.sin(math.radians(_LAT0))) / _QP)
_RQ = _A * math.sqrt(_QP / 2)
_D = _A * math.cos(math.radians(_LAT0)) / math.sqrt(1 - _E2 * math.sin(math.radians(_LAT0)) ** 2) / (_RQ * math.cos(_B0))


def laea_to_wgs84(x: Column, y: Column) -> tuple[Column, Column]:
    """(lat, lon) of European equal-area metres."""
    dx, dy = (x - _X0) / _D, (y - _Y0) * _D
    rho = F.sqrt(dx * dx + dy * dy)
    c = 2 * F.asin(rho / (2 * _RQ))
    sin_b = F.when(rho == 0, F.lit(math.sin(_B0))).otherwise(F.cos(c) * math.sin(_B0) + dy * F.sin(c) * math.cos(_B0) / rho)
    beta = F.asin(sin_b)
    e2, e4, e6 = _E2, _E2**2, _E2**3
    lat = beta + (e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta) + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta) + 761 * e6 / 45360 * F.sin(6 * beta)
    lon = F.lit(math.radians(_LON0)) + F.atan2(dx * F.sin(c), rho * math.cos(_B0) * F.cos(c) - dy * math.sin(_B0) * F.sin(c))
    return F.degrees(lat), F.degrees(F.when(rho == 0, F.lit(math.radians(_LON0))).otherwise(lon))


def grid_cell(lat: Column, lon: Column, metres: float) -> Column:
    """The name of a square cell of about ``metres``; null without a place. Columns narrow with latitude, by whole degrees."""
    size = metres / 111_194.9
    row = F.floor(lat / size)
    wide = F.lit(size) / F.cos(F.radians(F.floor(lat) + 0.5))
    return F.when(lat.isNotNull() & lon.isNotNull(), F.concat_ws(":", F.lit(f"{metres:g}"), row.cast("string"), F.floor(lon / wide).cast("string")))


def sun_time(day: Column, lat: Column, lon: Column, angle: float = -0.833, rising: bool = True) -> Column:
    """Minutes after midnight UTC at which the sun passes ``angle`` degrees over the horizon; null where it never does."""
    g = (2 * math.pi / 365) * (F.dayofyear(day) - 1)
    shift = 229.18 * (0.000075 + 0.001868 * F.cos(g) - 0.032077 * F.sin(g) - 0.014615 * F.cos(2 * g) - 0.040849 * F.sin(2 * g))
    tilt = 0.006918 - 0.399912 * F.cos(g) + 0.070257 * F.sin(g) - 0.006758 * F.cos(2 * g) + 0.000907 * F.sin(2 * g) - 0.002697 * F.cos(3 * g) + 0.00148 * F.sin(3 * g)
    cosine = F.cos(F.lit(math.radians(90 - angle))) / (F.cos(F.radians(lat)) * F.cos(tilt)) - F.tan(F.radians(lat)) * F.tan(tilt)
    half = F.degrees(F.acos(cosine))
    noon = 720 - 4 * lon - shift
    return F.when(F.abs(cosine) <= 1, noon - 4 * half if rising else noon + 4 * half)


def in_ring(lon: Column, lat: Column, ring: Column) -> Column:
    """Whether a point lies in a closed ring, an array of (lon, lat) corners, its border included, by ray casting."""
    corners = F.transform(F.sequence(F.lit(0), F.size(ring) - 1), lambda i: F.struct(F.get(ring, i).alias("p"), F.get(ring, (i + 1) % F.size(ring)).alias("q")))

    def crosses(e: Column) -> Column:
        x1, y1, x2, y2 = e["p"]["lon"], e["p"]["lat"], e["q"]["lon"], e["q"]["lat"]
        spans = (lat >= F.least(y1, y2)) & (lat < F.greatest(y1, y2))
        return spans & (lon < x1 + (lat - y1) * (x2 - x1) / F.when(y1 == y2, F.lit(1.0)).otherwise(y2 - y1))

    def touches(e: Column) -> Column:
        x1, y1, x2, y2 = e["p"]["lon"], e["p"]["lat"], e["q"]["lon"], e["q"]["lat"]
        off = (lon - x1) * (y2 - y1) - (lat - y1) * (x2 - x1)
        return (F.abs(off) < 1e-12) & lon.between(F.least(x1, x2), F.greatest(x1, x2)) & lat.between(F.least(y1, y2), F.greatest(y1, y2))

    return F.exists(corners, touches) | (F.size(F.filter(corners, crosses)) % 2 == 1)


def covering_areas(points: DataFrame, areas: DataFrame, cell: float = 0.05) -> DataFrame:
    """(lat, lon, areas): for each distinct point a map of the areas that cover it, {kind: (code, name)}.

    ``areas`` has kind, code, name and ring. Areas are spread over the cells of their bounding boxes, in degrees, and
    points meet the areas of their cell. Of several areas of a kind that of the smallest code counts; a point that no area
    covers has no row.
    """
    at = lambda c: F.floor(c / cell)
    lats, lons = F.transform("ring", lambda p: p["lat"]), F.transform("ring", lambda p: p["lon"])
    boxes = areas.filter(F.size("ring") > 0).select(
        "kind", F.struct("code", "name").alias("area"), "ring", F.explode(F.sequence(at(F.array_min(lats)), at(F.array_max(lats)))).alias("_r"),
        F.sequence(at(F.array_min(lons)), at(F.array_max(lons))).alias("_cs"),
    )
    boxes = boxes.withColumn("_c", F.explode("_cs")).drop("_cs")
    there = points.select("lat", "lon").filter("lat is not null and lon is not null").distinct().withColumns({"_r": at(F.col("lat")), "_c": at(F.col("lon"))})
    found = there.join(boxes, ["_r", "_c"]).filter(in_ring(F.col("lon"), F.col("lat"), F.col("ring"))).groupBy("lat", "lon", "kind").agg(F.min("area").alias("area"))
    return found.groupBy("lat", "lon").agg(F.map_from_entries(F.collect_list(F.struct("kind", "area"))).alias("areas"))

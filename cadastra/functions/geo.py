"""Geographic expressions: great-circle distance, grid cells, GeoJSON rings."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = math.pi * EARTH_RADIUS_KM / 180.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; NULL if any coordinate is NULL."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def usable(lat: Column, lon: Column, box: tuple[float, float, float, float] = (-90.0, 90.0, -180.0, 180.0)) -> Column:
    """Both coordinates stand in (min lat, max lat, min lon, max lon); NULL and NaN don't."""
    ok = lat.between(box[0], box[1]) & lon.between(box[2], box[3]) & ~F.isnan(lat) & ~F.isnan(lon)
    return F.coalesce(ok, F.lit(False))


def polygons(geojson: Column) -> Column:
    """array of polygons, each an array of rings of [lon, lat], of a Polygon or MultiPolygon text; NULL for others."""
    kind = F.get_json_object(geojson, "$.type")
    one = F.from_json(geojson, "coordinates array<array<array<double>>>")["coordinates"]
    many = F.from_json(geojson, "coordinates array<array<array<array<double>>>>")["coordinates"]
    return F.when(kind == "Polygon", F.array(one)).when(kind == "MultiPolygon", many)

"""Great-circle distance over latitude/longitude columns, in kilometres."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F, types as T

EARTH_RADIUS_KM = 6371.0088


def geo_point(lat: Column, lon: Column) -> Column:
    """GeoJSON point; coordinates are in longitude, latitude order."""
    point = F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))
    return F.when(lat.isNotNull() & lon.isNotNull(), point)


def latitude(point: Column) -> Column:
    return F.get(point["coordinates"], F.lit(1))


def longitude(point: Column) -> Column:
    return F.get(point["coordinates"], F.lit(0))


def parse_point(text: Column) -> Column:
    """Point from ``"lat,lon"`` text."""
    parts = F.split(text, ",")
    return geo_point(
        F.trim(F.get(parts, F.lit(0))).cast("double"), F.trim(F.get(parts, F.lit(1))).cast("double")
    )


def haversine_km(lat: Column, lon: Column, to_lat: float, to_lon: float) -> Column:
    """Distance of each place to (to_lat, to_lon).

    A place has one distance, whatever numbers it is given by: a pole at any longitude, the date line
    from either side.
    """
    half_lat = F.radians(lat - F.lit(float(to_lat))) / 2
    turn = F.when(lon - F.lit(float(to_lon)) > 180, lon - 360).when(lon - F.lit(float(to_lon)) < -180, lon + 360).otherwise(lon)
    half_lon = F.radians(turn - F.lit(float(to_lon))) / 2
    # The cosine of a latitude as the sine of what is left to the pole, which is 0 there.
    scale = F.sin(F.radians(90 - F.abs(lat))) * F.lit(math.sin(math.radians(90 - abs(to_lat))))
    chord = F.sin(half_lat) * F.sin(half_lat) + scale * F.sin(half_lon) * F.sin(half_lon)
    # Rounding may pass 1; ``least`` would take a null for 1 too.
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.when(chord > 1, 1.0).otherwise(chord)))


def geo_distance(point: Column, lat: float, lon: float) -> Column:
    """Distance of a GeoJSON point column to (lat, lon)."""
    return haversine_km(latitude(point), longitude(point), lat, lon)


def within_box(lat: Column, lon: Column, to_lat: float, to_lon: float, km: float) -> Column:
    """Cheap test that keeps every point within ``km``; plain comparisons, so Parquet can prune.

    Longitude is only bounded where the circle touches neither a pole nor the
    antimeridian.
    """
    slack = 1e-9 + km / EARTH_RADIUS_KM
    degrees = math.degrees(slack)
    box = (lat >= to_lat - degrees) & (lat <= to_lat + degrees)
    if abs(to_lat) + degrees < 90:
        ratio = math.sin(min(slack, math.pi / 2)) / math.cos(math.radians(to_lat))
        width = math.degrees(math.asin(min(1.0, ratio))) + 1e-9
        if to_lon - width >= -180 and to_lon + width <= 180:
            box = box & (lon >= to_lon - width) & (lon <= to_lon + width)
    return box


def is_point(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.StructType) and "coordinates" in data_type.names

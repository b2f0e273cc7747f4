"""Distances on the sphere and grid cells for radius joins."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from wayline import constants as K


def grid_columns(radius: float) -> int:
    """Columns that close the circle, each a little wider than the radius: about four cells hold a circle anywhere."""
    return max(4, int(360.0 / (1.4 * math.degrees(radius / K.EARTH_RADIUS_M))))


def great_circle_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres along the great circle; the cosine is capped at 1 against rounding."""
    lat1, lon1, lat2, lon2 = (F.radians(c.cast("double")) for c in (lat1, lon1, lat2, lon2))
    cosine = F.cos(lat1) * F.cos(lat2) * F.cos(lon2 - lon1) + F.sin(lat1) * F.sin(lat2)
    # `least` skips NULL, which would turn a missing coordinate into distance 0.
    return F.when(cosine.isNotNull(), K.EARTH_RADIUS_M * F.acos(F.least(F.lit(1.0), cosine)))


def within_radius(distance: Column, lat: Column, lon: Column, radius: float = K.MATCH_RADIUS_M) -> Column:
    """Near enough, or the target has no coordinates to judge by."""
    return lat.isNull() | lon.isNull() | (distance <= radius)


def lat_cell(lat: Column, radius: float = K.MATCH_RADIUS_M) -> Column:
    return F.floor(lat.cast("double") * (grid_columns(radius) / 360.0))


def lon_cell(lon: Column, radius: float = K.MATCH_RADIUS_M) -> Column:
    columns = grid_columns(radius)
    return F.pmod(F.floor((lon.cast("double") + 180.0) * (columns / 360.0)), F.lit(columns))


def cells_within(lat: Column, lon: Column, radius: float = K.MATCH_RADIUS_M) -> Column:
    """Array of (lat_cell, lon_cell) holding every point within `radius` metres."""
    lat, lon = lat.cast("double"), lon.cast("double")
    reach = math.degrees(radius / K.EARTH_RADIUS_M) * 1.001
    # Widest meridian span of the circle; all the way round when it holds a pole.
    ratio = math.sin(math.radians(reach)) / F.cos(F.radians(lat))
    span = F.when(F.abs(lat) + reach >= 90.0, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(F.lit(1.0), ratio))) * 1.001
    )
    count = grid_columns(radius)
    rows = F.sequence(lat_cell(lat - reach, radius), lat_cell(lat + reach, radius))
    first = F.floor((lon - span + 180.0) * (count / 360.0))
    last = F.least(F.floor((lon + span + 180.0) * (count / 360.0)), first + (count - 1))
    columns = F.transform(F.sequence(first, last), lambda i: F.pmod(i, F.lit(count)))
    return F.flatten(
        F.transform(
            rows,
            lambda r: F.transform(columns, lambda c: F.struct(r.alias("lat_cell"), c.alias("lon_cell"))),
        )
    )

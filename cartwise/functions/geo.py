"""Points and the Mercator projection."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84 semi-major axis in metres and first eccentricity.
SEMI_MAJOR_AXIS = 6378137.0
ECCENTRICITY = 0.0818191908426


def geopoint(lat: Column, lng: Column) -> Column:
    """Point with x = longitude, y = latitude; none when a coordinate is missing or zero."""
    return F.when((lat != 0) & (lng != 0), F.struct(lng.alias("x"), lat.alias("y")))


def mercator_x(lng: Column) -> Column:
    return F.lit(SEMI_MAJOR_AXIS) * F.radians(lng)


def mercator_y(lat: Column, spherical: bool = False) -> Column:
    """Northing in metres on the WGS84 ellipsoid, or on the sphere web tiles use."""
    phi = F.radians(lat)
    stretch = F.tan(F.lit(math.pi / 4) + phi / 2)
    if not spherical:
        e_sin = F.lit(ECCENTRICITY) * F.sin(phi)
        stretch = stretch * F.pow((1 - e_sin) / (1 + e_sin), F.lit(ECCENTRICITY / 2))
    return F.lit(SEMI_MAJOR_AXIS) * F.log(stretch)

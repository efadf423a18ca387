"""Numeric and geographic column functions (NUM1-NUM6)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Miles per km and degrees per km of latitude / of longitude at the equator.
MILES_PER_KM = 0.621371
KM_PER_DEG_LAT = 110.54
KM_PER_DEG_LONG = 111.32


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def radius_km(sq_mi) -> Column:
    """NUM1: radius of a disc with the given area, in km."""
    return F.sqrt(_c(sq_mi) / F.lit(math.pi)) / F.lit(MILES_PER_KM)


def radius_degrees(sq_mi, lat) -> Column:
    """NUM1: mean of the radius in degrees of latitude and of longitude."""
    km = radius_km(sq_mi)
    lat_deg = km / F.lit(KM_PER_DEG_LAT)
    long_deg = km / (F.lit(KM_PER_DEG_LONG) * F.cos(F.radians(_c(lat))))
    return (lat_deg + long_deg) / 2


def within(lat, long, c_lat: float, c_long: float, r_deg: float) -> Column:
    """NUM2: Euclidean distance in degrees strictly below the radius."""
    return F.sqrt(F.pow(_c(lat) - F.lit(c_lat), 2) + F.pow(_c(long) - F.lit(c_long), 2)) < F.lit(r_deg)


def impute_max_plus_one(df, col: str, out: str | None = None):
    """NUM4: NULL -> max + 1, with the max as a one-row aggregate (broadcast),
    not a single-partition window."""
    m = df.agg((F.max(col) + 1).alias("_fill"))
    return (df.crossJoin(F.broadcast(m))
            .withColumn(out or col, F.coalesce(F.col(col), F.col("_fill"))).drop("_fill"))


def train_fraction(id_col) -> Column:
    """FLT5: a deterministic uniform number in [0, 1) derived from a hash of the id (any type, any size)."""
    head = F.conv(F.substring(F.md5(_c(id_col).cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    return (head % 1000) / F.lit(1000.0)

"""Feature building for the listing analysis (NUM*, JON9, JON10, AGG17, RSH*, MLR6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import numeric as N
from quarry.operators.util import bounded_broadcast, with_global_index


def city_radii(cities: DataFrame) -> DataFrame:
    """NUM1: per city the radius in km and in degrees (lat, long, mean)."""
    km = N.radius_km("sq_mi")
    lat_deg = km / F.lit(N.KM_PER_DEG_LAT)
    long_deg = km / (F.lit(N.KM_PER_DEG_LONG) * F.cos(F.radians("lat")))
    return cities.select("name", "lat", "long", km.alias("radius_km"), lat_deg.alias("radius_lat"),
                         long_deg.alias("radius_long"), ((lat_deg + long_deg) / 2).alias("radius_deg"))


def _city_grid(cities: DataFrame, per_cell: F.Column, name: str) -> tuple[DataFrame, float]:
    """Cities by the grid cells their discs touch, and the cell size (the largest radius): at most 9 cells a city."""
    radii = city_radii(cities)
    size = radii.agg(F.max("radius_deg")).first()[0] or 1.0
    span = lambda c: F.sequence(F.floor((F.col(c) - F.col("radius_deg")) / size - 1e-9), F.floor((F.col(c) + F.col("radius_deg")) / size + 1e-9))
    cells = radii.withColumn("_i", F.explode(span("lat"))).withColumn("_j", F.explode(span("long")))
    return cells.groupBy("_i", "_j").agg(F.collect_list(per_cell).alias(name)), size


def _on_grid(points: DataFrame, cities: DataFrame, lat: str, long: str) -> DataFrame:
    """Points with ``_cities``: the cities whose cells hold the point (NULL for none). One equi-join; rows are not multiplied."""
    cells, size = _city_grid(cities, F.struct("name", "lat", "long", "radius_deg"), "_cities")
    here = points.withColumn("_i", F.floor(F.col(lat) / size)).withColumn("_j", F.floor(F.col(long) / size))
    return here.join(bounded_broadcast(cells), ["_i", "_j"], "left").drop("_i", "_j")


def _inside(lat: str, long: str, city: F.Column) -> F.Column:
    return F.sqrt(F.pow(F.col(lat) - city["lat"], 2) + F.pow(F.col(long) - city["long"], 2)) < city["radius_deg"]


def points_in_cities(points: DataFrame, cities: DataFrame, lat: str = "latitude", long: str = "longitude") -> DataFrame:
    """JON9: a row for each point and city whose disc holds it, with the city's ``name``."""
    met = _on_grid(points, cities, lat, long)
    held = met.withColumn("name", F.explode(F.transform(F.filter("_cities", lambda c: _inside(lat, long, c)), lambda c: c["name"])))
    return held.drop("_cities")


def geo_flags(points: DataFrame, cities: DataFrame, lat: str = "latitude", long: str = "longitude",
              home: str = "London") -> DataFrame:
    """JON9 + NUM2: ``is_home`` (inside the home city) and ``near_other_city``; NULL without coordinates.

    The theta join goes over a grid: a city table of any size is listed by
    cell and joined by cell, broadcast within a checked bound.
    """
    met = _on_grid(points, cities, lat, long)
    in_one = lambda which: F.coalesce(F.exists("_cities", lambda c: which(c["name"]) & _inside(lat, long, c)), F.lit(False))
    known = F.col(lat).isNotNull() & F.col(long).isNotNull()
    return (met.withColumn("is_home", F.when(known, in_one(lambda n: n == home)))
            .withColumn("near_other_city", F.when(known, in_one(lambda n: n != home))).drop("_cities"))


def conditional_counts(df: DataFrame, group_cols: list[str], conditions: dict[str, F.Column]) -> DataFrame:
    """AGG17: ``count_if`` per named condition, per group (partial aggregation)."""
    aggs = [F.count(F.lit(1)).alias("n")] + [F.count_if(c).alias(name) for name, c in conditions.items()]
    return df.groupBy(*group_cols).agg(*aggs)


def pivot_difference(df: DataFrame, key: str, pivot_col: str, value: str, a, b, out: str = "diff") -> DataFrame:
    """JON10: per key, value at pivot ``b`` minus value at pivot ``a``.

    Pivot values are given explicitly (no extra job to discover them).
    """
    p = df.groupBy(key).pivot(pivot_col, [a, b]).agg(F.first(value))
    return p.select(key, F.col(f"`{a}`").alias(f"v_{a}"), F.col(f"`{b}`").alias(f"v_{b}"),
                    (F.col(f"`{b}`") - F.col(f"`{a}`")).alias(out))


def label_groups(df: DataFrame, code_col: str, labels: dict, out: str = "label") -> DataFrame:
    """RSH2: code -> label via a ``CASE`` chain (NULL for unknown codes)."""
    expr = None
    for code, lab in labels.items():
        expr = (F.when(F.col(code_col) == code, lab) if expr is None
                else expr.when(F.col(code_col) == code, lab))
    return df.withColumn(out, expr)


def unpivot_pairs(df: DataFrame, ids: list[str], value_cols: list[str], names: dict[str, str]) -> DataFrame:
    """RSH1: wide measure columns to long ``(pair, value)`` plus a display name."""
    long = df.unpivot(ids, value_cols, "pair", "value")
    return label_groups(long, "pair", names, "pair_name")


def balance_classes(df: DataFrame, class_col: str, order_col: str) -> DataFrame:
    """MLR6: keep, per class, the first ``m`` rows in ``order_col`` order where
    ``m`` is the smallest class size.

    No per-class window (a class can hold half the rows): rows get a global
    position in ``(class, order)`` order (range-partitioned), and the class
    start offsets come from the per-class counts (one row per class).
    """
    counts = df.groupBy(class_col).agg(F.count(F.lit(1)).alias("_n"))
    m = counts.agg(F.min("_n").alias("_m"))
    idx = with_global_index(df, [class_col, order_col], "_pos")
    starts = idx.groupBy(class_col).agg(F.min("_pos").alias("_start"))
    out = idx.join(bounded_broadcast(starts), class_col).crossJoin(F.broadcast(m))
    return out.where(F.col("_pos") - F.col("_start") < F.col("_m")).drop("_pos", "_start", "_m")

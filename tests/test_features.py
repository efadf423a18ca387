import math

import pytest
from pyspark.sql import functions as F

from quarry.operators import features as FE

CITIES = [("London", 51.5, -0.12, 600.0), ("Leeds", 53.8, -1.55, 210.0)]


def test_geo_flags_match_brute_force(spark):
    cities = spark.createDataFrame(CITIES, "name string, lat double, long double, sq_mi double")
    pts = [(i, 50 + (i % 80) / 10.0, -5 + (i % 60) / 10.0) for i in range(400)] + [(999, None, 1.0)]
    df = spark.createDataFrame(pts, "id long, latitude double, longitude double")
    got = {r.id: (r.is_home, r.near_other_city) for r in FE.geo_flags(df, cities).collect()}

    def radius(sq, lat):
        km = math.sqrt(sq / math.pi) / 0.621371
        return (km / 110.54 + km / (111.32 * math.cos(math.radians(lat)))) / 2

    for i, la, lo in pts:
        if la is None:
            assert got[i] == (None, None)
            continue
        inside = {n: math.hypot(la - a, lo - b) < radius(sq, a) for n, a, b, sq in CITIES}
        assert got[i] == (inside["London"], inside["Leeds"])


def test_conditional_counts_pivot_label_unpivot(spark):
    df = spark.createDataFrame([(1, True, 2.0), (1, False, 4.0), (2, True, 6.0)], "g long, f boolean, v double")
    cc = {r.g: (r.n, r.n_f) for r in FE.conditional_counts(df, ["g"], {"n_f": F.col("f")}).collect()}
    assert cc == {1: (2, 1), 2: (1, 1)}
    p = spark.createDataFrame([(1, "a", 1.0), (1, "b", 3.0), (2, "b", 5.0)], "k long, c string, v double")
    diff = {r.k: r.diff for r in FE.pivot_difference(p, "k", "c", "v", "a", "b").collect()}
    assert diff == {1: 2.0, 2: None}
    w = spark.createDataFrame([(3, 0.5, 0.25, 0.75)], "analysis_num int, AA double, AB double, BB double")
    long = sorted((r.pair, r.value, r.pair_name) for r in
                  FE.unpivot_pairs(w, ["analysis_num"], ["AA", "AB", "BB"], {"AA": "x", "AB": "y", "BB": "z"}).collect())
    assert long == [("AA", 0.5, "x"), ("AB", 0.25, "y"), ("BB", 0.75, "z")]


def test_impute_max_plus_one(spark):
    from quarry.functions.numeric import impute_max_plus_one

    df = spark.createDataFrame([(1, 3), (2, None), (3, 7)], "id long, t int")
    got = {r.id: r.t for r in impute_max_plus_one(df, "t").collect()}
    assert got == {1: 3, 2: 8, 3: 7}

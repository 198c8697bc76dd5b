"""WKT expressions."""

import pytest
from pyspark.sql import functions as F

from loopcount.functions import geo


def one_col(spark, values):
    return spark.createDataFrame([(v,) for v in values], "wkt string")


def test_points(spark):
    df = one_col(spark, ["POINT (144.05 -37.12)", "point(1 2)", "POINT Z (1 2 3)", " POINT  ( 1.5e1   -2 ) ",
                         "null", None, ""])
    wkt = geo.missing_to_null(F.col("wkt"))
    lon, lat = geo.point_coords(wkt)
    got = [tuple(r) for r in df.select(lon, lat).collect()]
    assert got == [(144.05, -37.12), (1.0, 2.0), (1.0, 2.0), (15.0, -2.0), (None, None), (None, None), (None, None)]


def test_non_point_raises_with_site(spark):
    df = one_col(spark, ["LINESTRING (0 0, 1 1)"])
    checked = df.where(geo.is_point_or_null(F.col("wkt"), F.lit("site-7")))
    with pytest.raises(Exception, match="site-7"):
        checked.select(F.lit(1)).collect()   # whichever columns are read


def test_roads(spark):
    df = one_col(spark, [
        "LINESTRING (0 1, 1 1)",
        "MULTILINESTRING ((0 1,1 1),(2 2, 3 3))",
        "POLYGON ((0 0, 1 0, 1 1, 0 0))",
        "linestring(0 0,1 1)",
        "LINESTRING EMPTY",
        "MULTILINESTRING Z ((0 0 1, 1 1 1))",
        "POINT (1 2)",
        None,
    ])
    got = [r[0] for r in df.select(geo.road_multilinestring(F.col("wkt"))).collect()]
    assert got == [
        "MULTILINESTRING ((0 1, 1 1))",
        "MULTILINESTRING ((0 1, 1 1), (2 2, 3 3))",
        None,
        "MULTILINESTRING ((0 0, 1 1))",
        "MULTILINESTRING EMPTY",
        "MULTILINESTRING Z ((0 0 1, 1 1 1))",
        None,
        None,
    ]


def test_malformed_line_raises(spark):
    df = one_col(spark, ["LINESTRING (0 0, 1"])
    with pytest.raises(Exception, match="malformed line geometry"):
        df.where(geo.is_line_other_or_null(F.col("wkt"))).count()
    assert one_col(spark, ["POINT (1 2)", "LINESTRING EMPTY", "null", None]).where(geo.is_line_other_or_null(F.col("wkt"))).count() == 4


def test_road_keys_are_equal_for_equal_texts_only(spark):
    df = one_col(spark, ["MULTILINESTRING ((0 1, 1 1))", "MULTILINESTRING ((0 1, 1 1))", "MULTILINESTRING ((0 1, 1 2))", None])
    a, b, c, d = [r[0] for r in df.select(geo.road_key(F.col("wkt"))).collect()]
    assert a == b != c and d is None


def test_line_breaks_inside_a_text_are_blanks(spark):
    df = one_col(spark, ["LINESTRING (0 1,\n1 1)"]).where(geo.is_line_other_or_null(F.col("wkt")))
    assert df.select(geo.road_multilinestring(F.col("wkt"))).first()[0] == "MULTILINESTRING ((0 1, 1 1))"


def test_road_parts(spark):
    df = one_col(spark, ["MULTILINESTRING ((0 1, 1 1), (2.5 -3, 4 5))", None, "MULTILINESTRING EMPTY"])
    got = [r[0] for r in df.select(geo.road_parts(F.col("wkt"))).collect()]
    assert [[[(p.lon, p.lat) for p in part] for part in road] for road in got[:1]] == [
        [[(0.0, 1.0), (1.0, 1.0)], [(2.5, -3.0), (4.0, 5.0)]]]
    assert got[1] is None and got[2] == []

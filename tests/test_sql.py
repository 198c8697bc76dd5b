"""The import as one SQL text (E3), and its functions against the Column expressions they stand for."""

import pytest
from pyspark.sql import functions as F

from loopcount.functions import clean, curve, dates, geo
from loopcount.functions import sql as sql_functions
from loopcount.plans import jobs
from loopcount.sources import csv as csv_source
from tests.conftest import write_text, write_volume_csv

TUE = "2012-01-31 00:00:00"


@pytest.fixture(scope="module")
def registered(spark):
    return sql_functions.register(spark)


def same(df, text, column):
    rows = df.select(F.expr(text).alias("a"), column.alias("b")).collect()
    assert rows and all(r.a == r.b for r in rows), [(r.a, r.b) for r in rows if r.a != r.b][:3]


def test_functions_equal_the_expressions(spark, registered):
    raw = spark.createDataFrame([(["1", "", "-3", "007", None, " 5 "],), (["", "-1"],), ([],), (["x", "1"],), (["99999999999"],)], "raw array<string>")
    same(raw, "counts_usable(raw)", clean.is_usable(F.col("raw")))
    same(raw, "counts_malformed(raw)", clean.is_malformed(F.col("raw")))
    same(raw, "clean_counts(raw)", clean.cleaned("raw"))
    numbers = spark.createDataFrame([(v,) for v in (144.10, -37.0, 0.0, -0.0, 1e-5, 9.9e-6, 1e15, 123456.789, 1.5e-3, None, 1e300, 144.96305999999998)], "v double")
    same(numbers, "coordinate_text(v)", geo.number(F.col("v")))
    places = spark.createDataFrame([(144.5, -37.5), (-180.0, -90.0), (180.0, 90.0), (None, 1.0), (1000.0, -1000.0)], "lon double, lat double")
    same(places, "place_of(lon, lat)", curve.place(F.col("lon"), F.col("lat")))
    days = spark.createDataFrame([("2012-01-31 00:00:00",), ("2012-12-01",), (None,)], "t string").withColumn("d", dates.interval_date(F.col("t")))
    same(days, "interval_date(t)", F.col("d"))
    same(days, "short_weekday(d)", dates.day_of_week(F.col("d")))
    same(days, "month_number(d)", dates.month(F.col("d")))
    same(days, "observation_id('1', '2', d)", dates.observation_id(F.lit("1"), F.lit("2"), F.col("d")))
    lines = spark.createDataFrame([(w,) for w in ("LINESTRING (0.50 0, 1 -0.0)", "multilinestring((0 1,1 1),(2 2 , 3 3.10))", "POLYGON ((0 0, 1 0, 1 1, 0 0))", "LINESTRING EMPTY",
                                                  "MULTILINESTRING EMPTY", "MULTILINESTRING Z ((0 0 1, 1 1 1))", "LINESTRING (0 1,\n1 1)", "null", "", None, " POINT (1 2) ")], "raw string")
    same(lines, "geometry_text(raw)", geo.missing_to_null(F.col("raw")))
    lines = lines.select(geo.missing_to_null(F.col("raw")).alias("w")).withColumn("road", geo.road_multilinestring(F.col("w")))
    same(lines, "road_text(w)", F.col("road"))
    same(lines, "road_key_of(road)", geo.road_key(F.col("road")))
    same(lines, "road_parts(road)", geo.road_parts(F.col("road")))
    same(lines, "road_kept(w)", geo.is_line_other_or_null(F.col("w")))
    points = spark.createDataFrame([("POINT (144.10 -37.0)",), ("point( 1.5e1  -2 )",), ("POINT Z (1 2 3)",), (None,)], "w string")
    same(points, "point_text(point_lon(w), point_lat(w))", geo.canonical_point(F.col("w")))


@pytest.mark.parametrize("text,message", [("point_kept('LINESTRING (0 0, 1 1)', '7')", "site 7 has no POINT"), ("road_kept('LINESTRING (0 0, 1')", "malformed line"),
                                          ("interval_date('2012-02-30')", "invalid interval date"), ("row_kept('1', '', '2', array('1'))", "without site"),
                                          ("row_kept('1', '2012-01-01', '2', array('x'))", "malformed count")])
def test_functions_raise_as_the_expressions_do(spark, registered, text, message):
    with pytest.raises(Exception, match=message):
        spark.sql(f"SELECT {text}").collect()


def test_the_text_equals_the_dataframes(spark, tmp):
    vol = write_volume_csv(f"{tmp}/v", [("1", TUE, "1", ['"4"'] * 96), ("1", TUE, "2", ['"-1"'] * 95 + ['"0"']), ("2", TUE, "1", [""] * 96), ("2", TUE, "2", ['"7"'] * 96),
                                        ("9", TUE, "1", ['"7"'] * 96)])
    points = write_text(f"{tmp}/p", "p.csv", "WKT,SITE_NO\nPOINT (0 0),1\nPOINT (144.10 -37.0),1\nPOINT (1 2),2\nPOINT (1 2),9\nnull,9\n")
    lines = write_text(f"{tmp}/l", "l.csv", 'WKT,hfidl,hfidr\n"LINESTRING (9 9, 8 8)",100,\n"LINESTRING (0 0, 1 1.0)",100,101\n"POLYGON ((0 0, 1 0, 1 1, 0 0))",102,\n')
    layouts = write_text(f"{tmp}/s", "s.csv", "SITE,A,B,LOC,DET,DT,LANE,LMVT,LOCMVT,HF\n1,,,later,1,2012-02-01,1,L,T,101\n1,,,first,1,2012-01-01,1,L,T,100\n1,,,poly,2,2012-01-01,1,L,T,102\n")
    order = csv_source.ORDER_COLUMNS
    args = [csv_source.read_raw_volumes(spark, vol), csv_source.read_points(spark, points), csv_source.read_site_layouts(spark, layouts)]
    for line in (csv_source.read_lines(spark, lines), None):
        a = jobs.import_raw_sql(spark, *args, line, order=order, layout_order=["dt_general", *order])
        b = jobs.import_observations(*args, line, point_order=order, line_order=order, layout_order=["dt_general", *order])
        assert a.columns == b.columns and [f.dataType.simpleString() for f in a.schema] == [f.dataType.simpleString() for f in b.schema]
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.count() == 3
        assert spark.table("placedVolumes").count() == 3

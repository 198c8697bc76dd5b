"""Order-dependent lookups (A1, A4, A5) and file order across several files."""

import pytest

from loopcount.operators import lookups
from loopcount.sources import csv as csv_source
from tests.conftest import write_text


def test_last_point_per_site_wins_in_file_order(spark, tmp):
    write_text(tmp, "part-00000.csv", "WKT,SITE_NO\nPOINT (1 1),1\nPOINT (2 2),2\n")
    write_text(tmp, "part-00001.csv", "WKT,SITE_NO\nPOINT (3 3),1\nnull,2\n")
    pts = lookups.site_points(csv_source.read_points(spark, tmp), csv_source.ORDER_COLUMNS)
    got = {r.site: (r.point_wkt, r.lon, r.lat) for r in pts.collect()}
    assert got == {"1": ("POINT (3 3)", 3.0, 3.0), "2": (None, None, None)}


def test_files_with_another_header_order_fail(spark, tmp):
    write_text(tmp, "part-00000.csv", "WKT,SITE_NO\nPOINT (1 1),1\n")
    write_text(tmp, "part-00001.csv", "SITE_NO,WKT\n1,POINT (3 3)\n")
    with pytest.raises(Exception):
        csv_source.read_points(spark, tmp).collect()


def test_line_ids_left_and_right_later_record_wins(spark, tmp):
    write_text(tmp, "lines.csv",
               "WKT,hfidl,hfidr\n"
               "\"LINESTRING (0 0, 1 0)\",0,2\n"
               "\"MULTILINESTRING ((0 1, 1 1))\",2,4\n"
               "\"POLYGON ((0 0, 1 0, 1 1, 0 0))\",4,\n")
    roads = lookups.road_lookup(csv_source.read_lines(spark, tmp), csv_source.ORDER_COLUMNS)
    got = {r.hf_id: r.road_wkt for r in roads.collect()}
    assert got == {"0": "MULTILINESTRING ((0 0, 1 0))", "2": "MULTILINESTRING ((0 1, 1 1))", "4": None}


def test_first_layout_row_per_detector(spark, tmp):
    header = "SITE,A,B,LOC,DET,DT,LANE,LMVT,LOCMVT,HF\n"
    write_text(tmp, "layouts.csv", header +
               "1,,,second,1,2012-02-01,2,L,x,10\n"
               "1,,,first,1,2012-01-01,1,L,x,11\n"
               "1,,,only,2,2012-01-01,1,L,x\n")
    layouts = csv_source.read_site_layouts(spark, tmp)
    got = {(r.site, r.detector): (r.ds_location, r.hf_id) for r in lookups.first_layout(layouts).collect()}
    # default order: the layout date first; a short row reads its missing fields as NULL
    assert got == {("1", "1"): ("first", "11"), ("1", "2"): ("only", None)}
    by_file = lookups.first_layout(layouts, csv_source.ORDER_COLUMNS)
    assert {(r.site, r.detector): r.ds_location for r in by_file.collect()}[("1", "1")] == "second"


def test_window_top_one_limits_before_the_shuffle(spark, tmp):
    header = "SITE,A,B,LOC,DET,DT,LANE,LMVT,LOCMVT,HF\n"
    write_text(tmp, "layouts.csv", header + "".join(f"1,,,l{i},1,2012-01-{i % 28 + 1:02d},1,L,x,1\n" for i in range(200)))
    plan = lookups.first_layout(csv_source.read_site_layouts(spark, tmp))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_a_text_that_is_no_point_fails_whatever_is_read(spark, tmp):
    write_text(tmp, "p.csv", "WKT,SITE_NO\n\"LINESTRING (0 0, 1 1)\",77\n")
    pts = lookups.site_points(csv_source.read_points(spark, tmp), csv_source.ORDER_COLUMNS)
    with pytest.raises(Exception, match="site 77"):
        pts.select("site").collect()


def test_road_points_are_flat(spark, tmp):
    write_text(tmp, "l.csv", 'WKT,hfidl,hfidr\n"MULTILINESTRING ((0 1, 2 3), (4 5, 6 7))",1,\n"POLYGON ((0 0, 1 0, 1 1, 0 0))",2,\n')
    roads = lookups.road_lookup(csv_source.read_lines(spark, tmp), csv_source.ORDER_COLUMNS)
    assert sorted(map(tuple, lookups.road_points(roads).collect())) == [
        ("1", 0, 0, 0.0, 1.0), ("1", 0, 1, 2.0, 3.0), ("1", 1, 0, 4.0, 5.0), ("1", 1, 1, 6.0, 7.0)]

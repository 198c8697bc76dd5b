"""Cleaning rules (P1-P5, D1-D4) on hand-written CSV lines and on the published golden output."""

import os

import pytest
from pyspark.sql import functions as F

from loopcount.operators import cleaning
from loopcount.sources import csv as csv_source
from tests.conftest import write_volume_csv

EMPTY_REST = ['""'] * 93


def read_clean(spark, folder):
    raw = csv_source.read_raw_volumes(spark, folder)
    return {(r.site, r.detector): list(r.volumes) for r in cleaning.clean_volumes(raw).collect()}


def test_hand_written_cases(spark, tmp):
    rows = [
        ("1", "2012-01-31 00:00:00", "a", ['"-1"', '""', '"4"'] + EMPTY_REST),   # negative and empty -> 0
        ("1", "2012-01-31 00:00:00", "b", ['"-1"', '""', '"-5"'] + EMPTY_REST),  # nothing usable -> dropped
        ("1", "2012-01-31 00:00:00", "c", ['"0"', '"0"', '"0"'] + EMPTY_REST),   # zero is usable
        ("1", "2012-01-31 00:00:00", "d", ["", '""', '"7"'] + EMPTY_REST),       # unquoted empty
        ("1", "2012-01-31 00:00:00", "e", ['"-0"'] + ['""'] * 95),               # -0 is 0, usable
        ("1", "2012-01-31 00:00:00", "f", ['"+3"', '"1"'] + ['""'] * 94),         # sign allowed
    ]
    got = read_clean(spark, write_volume_csv(tmp, rows))
    assert got[("1", "a")][:3] == [0, 0, 4] and sum(got[("1", "a")]) == 4
    assert ("1", "b") not in got
    assert got[("1", "c")] == [0] * 96
    assert got[("1", "d")][:3] == [0, 0, 7]
    assert got[("1", "e")] == [0] * 96
    assert got[("1", "f")][:2] == [3, 1]


def test_dropped_rows_are_reported(spark, tmp):
    rows = [("9", "2012-02-01 00:00:00", "1", ['"-2"'] * 96), ("9", "2012-02-01 00:00:00", "2", ['"1"'] * 96)]
    raw = csv_source.read_raw_volumes(spark, write_volume_csv(tmp, rows))
    assert [(r.site, r.detector) for r in cleaning.dropped_volumes(raw).collect()] == [("9", "1")]


def test_quoted_commas_do_not_shift_fields(spark, tmp):
    rows = [("5,6", "2012-01-31 00:00:00", "1", ['"2"'] * 96)]
    got = read_clean(spark, write_volume_csv(tmp, rows))
    assert got[("5,6", "1")] == [2] * 96


def test_malformed_count_fails_the_job(spark, tmp):
    rows = [("1", "2012-01-31 00:00:00", "1", ['"x"', '"1"', '"2"'] + EMPTY_REST)]
    raw = csv_source.read_raw_volumes(spark, write_volume_csv(tmp, rows))
    with pytest.raises(Exception, match="malformed count"):
        cleaning.clean_volumes(raw).collect()


def test_malformed_count_fails_even_when_nothing_else_is_usable(spark, tmp):
    rows = [("1", "2012-01-31 00:00:00", "1", ['"x"'] + ['"-1"'] * 95)]
    raw = csv_source.read_raw_volumes(spark, write_volume_csv(tmp, rows))
    with pytest.raises(Exception, match="malformed count"):
        cleaning.clean_volumes(raw).collect()


def write_lines(folder, header, lines, name="a.csv"):
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join([",".join(header)] + lines) + "\n")
    return folder


FREE_HEADER = ["NB_SCATS_SITE", "DAY", "NB_DETECTOR"] + [f"X{i}" for i in range(96)]


def test_header_needs_its_two_join_columns_in_place(spark, tmp):
    row = ",".join(["1", "2012-01-31 00:00:00", "2"] + ["1"] * 96)
    got = csv_source.read_raw_volumes(spark, write_lines(tmp, FREE_HEADER, [row])).first()
    assert (got.site, got.detector) == ("1", "2")          # the other names are free
    for i, header in enumerate((["NB_DETECTOR", "DAY", "NB_SCATS_SITE"] + FREE_HEADER[3:], ["A", "B", "C"] + FREE_HEADER[3:],
                                FREE_HEADER[:-1], FREE_HEADER + ["X96"])):
        os.makedirs(f"{tmp}/{i}")
        with pytest.raises(csv_source.HeaderMismatch):
            csv_source.read_raw_volumes(spark, write_lines(f"{tmp}/{i}", header, [row]))


def test_every_file_has_the_first_files_header(spark, tmp):
    row = ",".join(["1", "2012-01-31 00:00:00", "2"] + ["1"] * 96)
    write_lines(tmp, FREE_HEADER, [row], "a.csv")
    write_lines(tmp, ["NB_DETECTOR", "DAY", "NB_SCATS_SITE"] + FREE_HEADER[3:], [row], "b.csv")
    with pytest.raises(Exception):
        csv_source.read_raw_volumes(spark, tmp).collect()


@pytest.mark.parametrize("counts", [2, 95, 97, 98])
def test_short_and_long_lines_fail_whatever_is_read(spark, tmp, counts):
    raw = csv_source.read_raw_volumes(spark, write_lines(tmp, FREE_HEADER, [",".join(["1", "2012-01-31 00:00:00", "2"] + ["1"] * counts)]))
    for read in (raw.count, raw.select("site").collect, cleaning.clean_volumes(raw).select("site").collect):
        with pytest.raises(Exception):
            read()


def test_empty_fields_at_the_end_are_values(spark, tmp):
    raw = csv_source.read_raw_volumes(spark, write_lines(tmp, FREE_HEADER, ["1,2012-01-31 00:00:00,2,7" + "," * 95]))
    assert list(cleaning.clean_volumes(raw).first().volumes) == [7] + [0] * 95


@pytest.mark.parametrize("row", ["1,2012-01-31 00:00:00,2,x" + ",1" * 95, ",2012-01-31 00:00:00,2" + ",1" * 96, '1,2012-01-31 00:00:00,""' + ",1" * 96, "1,,2" + ",1" * 96])
def test_checks_hold_in_reports_that_read_no_counts(spark, tmp, row):
    raw = csv_source.read_raw_volumes(spark, write_lines(tmp, FREE_HEADER, [row]))
    for df in (cleaning.clean_volumes(raw), cleaning.dropped_volumes(raw)):
        for read in (df.count, df.select(F.lit(1)).collect):
            with pytest.raises(Exception, match="malformed count|without site"):
                read()


def test_quotes_are_doubled_and_a_backslash_is_a_character(spark, tmp):
    with open(f"{tmp}/s.csv", "w") as f:
        f.write('S,A,B,LOC,DET,DT,LANE,LMVT,LOCMVT,HF\n1,,,"HIGH ST \\",1,d,1,L,T,5\n2,,,"B ""X"", ST",1,d,1,L,T,5\n')
    got = {r.site: r.ds_location for r in csv_source.read_site_layouts(spark, tmp).collect()}
    assert got == {"1": "HIGH ST \\", "2": 'B "X", ST'}


def test_geometry_texts_may_hold_line_breaks(spark, tmp):
    with open(f"{tmp}/l.csv", "w") as f:
        f.write('WKT,hfidl,hfidr\n"LINESTRING (0 0,\n1 1)",7,8\n"POINT (1\n2)",9,\n')
    assert [(r.wkt, r.hfidl, r.hfidr) for r in csv_source.read_lines(spark, tmp).collect()] == [("LINESTRING (0 0,\n1 1)", "7", "8"), ("POINT (1\n2)", "9", None)]


# The published golden output is site 2 on 2012-01-31, detectors 1-24, and slot 14
# holds 4, 18, 1, 2 for detectors 1-4; every other count is 0.
GOLDEN_SITE, GOLDEN_TIME, GOLDEN_SLOT, GOLDEN_COUNTS = "2", "2012-01-31 00:00:00", 14, [4, 18, 1, 2]


def golden_rows():
    out = {}
    for det in range(1, 25):
        counts = [0] * 96
        if det <= len(GOLDEN_COUNTS):
            counts[GOLDEN_SLOT] = GOLDEN_COUNTS[det - 1]
        out[(GOLDEN_SITE, str(det))] = counts
    return out


def test_golden_output(spark, tmp):
    """Raw rows that hide each golden zero behind an empty or negative text (one real '0'
    per row keeps all-zero rows) clean back to exactly the golden rows."""
    expected = golden_rows()
    rows = []
    for (site, det), counts in expected.items():
        fields = []
        for i, c in enumerate(counts):
            if c:
                fields.append(f'"{c}"')
            elif i == 0:
                fields.append('"0"')
            else:
                fields.append(['""', '"-1"', "", '"-17"'][i % 4])
        rows.append((site, GOLDEN_TIME, det, fields))
    rows.append((GOLDEN_SITE, GOLDEN_TIME, "25", ['"-3"'] * 96))  # no usable count: not in the golden file
    got = read_clean(spark, write_volume_csv(tmp, rows))
    assert got == expected


def test_cleaning_is_one_pass_without_shuffle_or_python(spark, tmp):
    rows = [("1", "2012-01-31 00:00:00", "1", ['"1"'] * 96)]
    folder = write_volume_csv(tmp, rows)
    for with_order in (False, True):
        raw = csv_source.read_raw_volumes(spark, folder, with_order=with_order)
        df = cleaning.clean_volumes(raw, csv_source.ORDER_COLUMNS if with_order else None)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan and plan.count("FileScan csv") == 1
        assert df.select(F.size("volumes")).first()[0] == 96

"""The reshaping of events: counts are shuffled by slot, whatever the number of detector-days."""

import datetime

from loopcount.sources import fixtures

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string"


def at(day, hour, minute):
    return datetime.datetime(2024, 1, day, hour, minute)


def raw_rows(spark, rows):
    got = fixtures.raw_volumes(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], EVENTS)).collect()
    return {(r.site, r.detector, r.qt_interval): r.raw for r in got}, len(got)


def absent(user, slot):
    return ["", "-1", "0"][(user + slot) % 3]


def test_slots_of_a_day_and_rows_with_nulls(spark):
    got, n = raw_rows(spark, [
        (at(2, 0, 14), 1, "click"), (at(2, 0, 0), 1, "click"), (at(2, 23, 59), 1, "click"), (at(3, 0, 15), 1, "click"),
        (at(2, 1, 0), 7, "error"), (at(2, 1, 0), None, "signup"), (None, 2, "view"), (None, 2, None)])
    assert n == 5
    first = got["1", "1", "2024-01-02 00:00:00"]
    assert first == ["2"] + [absent(1, s) for s in range(1, 95)] + ["1"]
    assert got["1", "1", "2024-01-03 00:00:00"] == [absent(1, 0), "1"] + [absent(1, s) for s in range(2, 96)]
    # rows that must drop: present counts are negative
    assert got["7", "2", "2024-01-02 00:00:00"] == ["-1" if s == 4 or s % 2 else "" for s in range(96)]
    assert got[None, "4", "2024-01-02 00:00:00"] == ["1" if s == 4 else absent(2, s) for s in range(96)]
    assert got["2", "5", None] == [absent(2, s) for s in range(96)]


def test_no_row_of_96_counts_is_aggregated_or_shuffled(spark):
    events = spark.createDataFrame([(1, at(2, 0, 0), 1, "click")], EVENTS)
    plan = fixtures.raw_volumes(events)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count(") == 1 and "partial_collect_list" in plan

"""The inputs that queries on counts write for themselves: only those they read, with the same rows."""

import datetime
import os

import pytest

from loopcount.plans import queries as q
from loopcount.session import shared_path
from loopcount.sources import csv as csv_source
from loopcount.sources import fixtures

KEYS = ["site", "qt_interval", "detector", "raw"]


@pytest.fixture
def tables(spark, tmp):
    day = lambda d, h=0: datetime.datetime(2024, 1, d, h)
    rows = {
        "events": ("event_id long, ts timestamp_ntz, user_id long, event_type string",
                   [(i, day(1 + i % 15, i % 24), i % 4, ["click", "error", "view"][i % 3]) for i in range(90)] + [(99, None, 1, "click")]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(i, "s", i, 0.0) for i in range(3)]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(i, "n", i % 5) for i in range(6)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
                     [(9 - i, 3 + i, i % 3, 1 + i % 6, "AN"[i % 2], "F", day(1 + i)) for i in range(10)])}
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{tmp}/{name}.parquet")
    return tmp


def exported(spark, tables):
    base = shared_path(spark, "inputs", q.INPUTS_VERSION, q._tag(spark, tables)).removeprefix("file:")
    return set(os.listdir(base)) if os.path.isdir(base) else set()


def test_only_what_a_query_reads_is_written(spark, tables):
    first = {(r.site, r.detector): r.ds_location for r in q.layout_first(spark, tables).collect()}
    assert exported(spark, tables) == {"layouts"}
    # the first by order key: of supplier 0 and line number 4 the item with order key 0, part 12
    assert first["0", "4"] == 'INT 12, "HIGH" ST \\' and len(first) == 6
    q.volumes_by_day(spark, tables, ("odd",))
    assert exported(spark, tables) == {"layouts", "volumes_odd"}


def test_parts_by_day_hold_the_rows_of_the_volumes(spark, tables):
    read = lambda path: sorted(map(tuple, csv_source.read_raw_volumes(spark, path).select(*KEYS).where("qt_interval IS NOT NULL").collect()))
    whole = read(q.export_csv_inputs(spark, tables, ["volumes"])["volumes"])
    parts = {k: read(p) for k, p in q.volumes_by_day(spark, tables).items()}
    day = lambda r: int(r[1][8:10])
    assert parts["even"] == [r for r in whole if day(r) % 2 == 0] and parts["even"]
    assert parts["odd"] == [r for r in whole if day(r) % 2 == 1] and parts["odd"]
    lower = lambda x: str(int(x) - 1) if x and int(x) > 0 else x
    assert parts["lowered"] == sorted((*r[:3], [lower(x) for x in r[3]]) for r in whole if day(r) % fixtures.LOWERED_DAY == 0)
    assert parts["lowered"]


def test_layouts_are_written_in_their_order(spark, tables):
    rows = csv_source.read_site_layouts(spark, q.export_csv_inputs(spark, tables, ["layouts"])["layouts"]).orderBy(*csv_source.ORDER_COLUMNS)
    assert [r.ds_location.split(",")[0] for r in rows.collect()] == [f"INT {12 - i}" for i in range(10)]

"""J3 with its date condition: the layout valid on the day of a count."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from loopcount.operators import asof
from loopcount.plans import jobs
from tests.conftest import write_text, write_volume_csv

LAYOUTS = "site string, detector string, dt_general string, ds_location string, nb_lane string, lane_mvt string, loc_mvt string, hf_id string, n int"


def brute(counts, layouts):
    out = []
    for site, detector, day, value in counts:
        fit = [(d or "0001-01-01", -n, loc) for s, t, d, loc, n in layouts if (s, t) == (site, detector) and (d or "0001-01-01") <= str(day)]
        out.append((site, detector, str(day), value, max(fit)[2] if fit else None))
    return sorted(out, key=str)


def found(spark, counts, layouts):
    volumes = spark.createDataFrame(counts, "site string, detector string, obs_date date, value int")
    rows = spark.createDataFrame([(s, t, d, loc, "1", None, "x", loc, n) for s, t, d, loc, n in layouts], LAYOUTS)
    got = asof.layout_as_of(volumes, rows, ["n"])
    return got, sorted(((r.site, r.detector, str(r.obs_date), r.value, r.ds_location) for r in got.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    day = lambda: date(2012, 1, 1) + timedelta(days=rnd.randrange(40))
    detectors = [(s, t) for s in "ABC" for t in "12"]
    layouts = [(*rnd.choice(detectors), rnd.choice([None, "", " "]) if rnd.random() < 0.05 else str(day()), f"loc{n}", n) for n in range(80)]
    counts = [(*rnd.choice([*detectors, ("D", "1")]), day(), i) for i in range(300)]
    got, rows = found(spark, counts, [(s, t, (d or "").strip() or None, loc, n) for s, t, d, loc, n in layouts])
    assert rows == brute(counts, [(s, t, (d or "").strip() or None, loc, n) for s, t, d, loc, n in layouts])
    assert [r[4] for r in rows if r[0] == "D"] and all(r[4] is None for r in rows if r[0] == "D")


def test_one_exchange_and_no_join(spark):
    got, _ = found(spark, [("A", "1", date(2012, 1, 1), 1)], [("A", "1", "2012-01-01", "x", 1)])
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning(site") == 1 and plan.count("Exchange ") == 1 and "Join" not in plan


def test_same_day_ties_nulls_and_a_malformed_date(spark):
    counts = [("A", "1", date(2012, 1, 5), 1), ("A", None, date(2012, 1, 5), 2)]
    _, rows = found(spark, counts, [("A", "1", "2012-01-05", "second", 2), ("A", "1", "2012-01-05", "first", 1), ("A", "1", "2012-01-06", "later", 0),
                                    ("A", None, "2012-01-01", "no detector", 0), (None, "1", "2012-01-01", "no site", 0)])
    assert rows == [("A", "1", "2012-01-05", 1, "first"), ("A", None, "2012-01-05", 2, None)]
    with pytest.raises(Exception, match="invalid interval date"):
        found(spark, counts, [("A", "1", "2012-02-30", "x", 1)])


def test_import_by_date(spark, tmp):
    vol = write_volume_csv(f"{tmp}/v", [("1", f"2012-01-{d:02d} 00:00:00", "1", ['"1"'] * 96) for d in (1, 10, 20)])
    points = write_text(f"{tmp}/p", "p.csv", "WKT,SITE_NO\nPOINT (10 20),1\n")
    lines = write_text(f"{tmp}/l", "l.csv", 'WKT,hfidl,hfidr\n"LINESTRING (0 0, 1 1)",100,\n"LINESTRING (0 0, 2 2)",101,\n')
    layouts = write_text(f"{tmp}/s", "s.csv", "SITE,A,B,LOC,DET,DT,LANE,LMVT,LOCMVT,HF\n1,,,new,1,2012-01-15,1,L,T,101\n1,,,old,1,2012-01-05,1,L,T,100\n")
    jobs.import_job(spark, f"{tmp}/obs", vol, layouts, points, lines, by_date=True)
    rows = {r.obs_date.day: (r.ds_location, r.hf_id, r.road_wkt) for r in spark.read.parquet(f"{tmp}/obs").collect()}
    assert rows == {1: (None, None, None), 10: ("old", "100", "MULTILINESTRING ((0 0, 1 1))"), 20: ("new", "101", "MULTILINESTRING ((0 0, 2 2))")}
    assert jobs.stored_profile(spark, f"{tmp}/obs").where("slot = 0").where(F.col("road_wkt").isNotNull()).count() == 2

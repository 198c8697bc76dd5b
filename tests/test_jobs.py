"""Import (E1), profile (E2), SQL form (E3), sinks (K1-K5) and scans (S7, S8) end to end."""

import pytest
from pyspark.sql import functions as F

from loopcount.operators.broadcast import EmptyLookup, measured
from loopcount.plans import jobs
from loopcount.schemas import OBSERVATIONS_SCHEMA, SchemaMismatch, check_schema
from loopcount.sources import csv as csv_source
from loopcount.sources.tables import read_table
from tests.conftest import write_text, write_volume_csv

TUE, WED = "2012-01-31 00:00:00", "2012-02-01 00:00:00"


def counts(first, rest=0):
    return [f'"{first}"'] + [f'"{rest}"'] * 95


@pytest.fixture
def inputs(tmp):
    vol = write_volume_csv(f"{tmp}/volumes", [
        ("1", TUE, "1", counts(4, 1)), ("1", TUE, "2", counts(6, 0)), ("1", TUE, "3", counts(2, 2)),
        ("1", WED, "1", counts(1, 0)), ("1", WED, "2", counts(0, 0)), ("1", WED, "3", counts(-1, 3)),
        ("9", TUE, "1", counts(5, 5)), ("9", WED, "1", counts(5, 5)),
        ("1", TUE, "4", ['"-1"'] * 96),
    ])
    pts = write_text(f"{tmp}/points", "p.csv", "WKT,SITE_NO\nPOINT (10 20),1\n")
    lines = write_text(f"{tmp}/lines", "l.csv", 'WKT,hfidl,hfidr\n"LINESTRING (0 0, 1 1)",100,101\n'
                                                '"POLYGON ((0 0, 1 0, 1 1, 0 0))",200,201\n')
    lay = write_text(f"{tmp}/layouts", "s.csv", "SITE,A,B,LOC,DET,DT,LANE,LMVT,LOCMVT,HF\n"
                                                "1,,,INT A,1,2012-01-01,1,L,T,100\n"
                                                "1,,,INT B,2,2012-01-01,2,R,T,200\n")
    return {"volumes": vol, "points": pts, "lines": lines, "layouts": lay, "root": tmp}


def test_import_job_rows(spark, inputs):
    obs = jobs.import_csv(spark, inputs["volumes"], inputs["layouts"], inputs["points"], inputs["lines"])
    rows = {(r.detector, r.day_of_week): r for r in obs.collect()}
    assert len(rows) == 6                          # site 9 has no point; detector 4 row is dropped
    r = rows[("1", "Tue")]
    assert r.feature_id == "1-1-1327968000000"     # site-detector-epochMillis
    assert (r.point_wkt, r.lon, r.lat) == ("POINT (10 20)", 10.0, 20.0)
    assert (r.ds_location, r.nb_lane, r.lane_mvt, r.loc_mvt, r.hf_id) == ("INT A", "1", "L", "T", "100")
    assert r.road_wkt == "MULTILINESTRING ((0 0, 1 1))" and r.road[0][1].lon == 1.0
    assert rows[("2", "Tue")].road_wkt is None and rows[("2", "Tue")].hf_id == "200"   # polygon: no road
    assert rows[("3", "Tue")].ds_location is None                                      # no layout
    assert list(rows[("3", "Wed")].volumes[:2]) == [0, 3]


def test_unplaced_report(spark, inputs):
    from loopcount.operators import cleaning, enrich, lookups
    pts = lookups.site_points(csv_source.read_points(spark, inputs["points"]), csv_source.ORDER_COLUMNS)
    vol = cleaning.clean_volumes(csv_source.read_raw_volumes(spark, inputs["volumes"]))
    assert sorted((r.site, str(r.obs_date)) for r in enrich.unplaced(vol, pts).collect()) == [
        ("9", "2012-01-31"), ("9", "2012-02-01")]


def test_the_unplaced_report_fails_on_a_malformed_row_it_does_not_show(spark, inputs):
    from loopcount.operators import cleaning, enrich, lookups
    folder = write_volume_csv(f"{inputs['root']}/bad", [("9", TUE, "1", ['"x"'] + ['"1"'] * 95)])
    pts = lookups.site_points(csv_source.read_points(spark, inputs["points"]), csv_source.ORDER_COLUMNS)
    report = enrich.unplaced(cleaning.clean_volumes(csv_source.read_raw_volumes(spark, folder)), pts)
    for read in (report.collect, report.count):
        with pytest.raises(Exception, match="malformed count"):
            read()


def test_staged_inputs_follow_the_source_files(spark, tmp):
    import os
    import time

    from loopcount.plans import queries
    for t in queries.SOURCE_TABLES:
        spark.range(3).write.parquet(f"{tmp}/{t}.parquet")
    first = queries._tag(spark, tmp)
    assert queries._tag(spark, tmp + "/") == first
    name = next(f for f in sorted(os.listdir(f"{tmp}/nation.parquet")) if f.startswith("part"))
    os.utime(f"{tmp}/nation.parquet/{name}", (time.time() + 60,) * 2)
    assert queries._tag(spark, tmp) != first


def test_lines_are_optional(spark, inputs):
    obs = jobs.import_csv(spark, inputs["volumes"], inputs["layouts"], inputs["points"])
    assert obs.where(F.col("road_wkt").isNotNull()).count() == 0 and obs.count() == 6


def test_sql_form_equals_dataframe_form(spark, inputs):
    order = csv_source.ORDER_COLUMNS
    args = (csv_source.read_raw_volumes(spark, inputs["volumes"]), csv_source.read_points(spark, inputs["points"]),
            csv_source.read_site_layouts(spark, inputs["layouts"]), csv_source.read_lines(spark, inputs["lines"]))
    a = jobs.import_sql(spark, *args, point_order=order, line_order=order, layout_order=order)
    b = jobs.import_observations(*args, point_order=order, line_order=order, layout_order=order)
    cols = [c for c in a.columns if c not in ("volumes", "road")]
    assert sorted(a.select(*cols).collect()) == sorted(b.select(*cols).collect())
    assert spark.table("placedVolumes").count() == a.count()
    assert a.schema["point_wkt"].metadata == {"srid": 4326}


def test_profile_job_and_pruning(spark, inputs):
    root = inputs["root"]
    jobs.import_job(spark, f"{root}/obs", inputs["volumes"], inputs["layouts"], inputs["points"], inputs["lines"])
    jobs.profile_job(spark, f"{root}/obs", f"{root}/prof")
    prof = spark.read.parquet(f"{root}/prof")
    assert prof.count() == 4 * 96                  # per weekday: the road group and the no-road group
    tue_null = prof.where("day_of_week = 'Tue' AND road_wkt IS NULL AND slot = 0").first()
    assert (tue_null.num_features, tue_null.avg_vehicle_count, tue_null.detector) == (2, 4.0, "all")
    assert tue_null.feature_id == "1-all-Tue-00:00" and str(tue_null.time_of_day) == "1970-01-01 00:00:00"
    last = prof.where("day_of_week = 'Wed' AND road_wkt IS NULL AND slot = 95").first()
    assert (last.avg_vehicle_count, str(last.time_of_day)) == (1.5, "1970-01-01 23:45:00")
    # feature ids repeat when a site has two roads on one weekday (kept as in the reference)
    assert prof.where("day_of_week = 'Tue'").select("feature_id").distinct().count() == 96
    # the weekday filter reaches the scan as a partition filter
    tue = read_table(spark, f"{root}/obs", day_of_week="Tue")
    plan = tue._jdf.queryExecution().executedPlan().toString()
    assert "isnotnull(day_of_week" in plan.split("PartitionFilters:")[1] and "Tue" in plan
    assert tue.count() == 3


def test_profile_preserves_totals(spark, inputs):
    obs = jobs.import_csv(spark, inputs["volumes"], inputs["layouts"], inputs["points"], inputs["lines"])
    keys = ["site", "day_of_week", "point_wkt", "road_wkt"]
    total = F.aggregate("volumes", F.lit(0).cast("bigint"), lambda a, x: a + x)
    want = obs.groupBy(*keys).agg(F.sum(total).alias("t"))
    got = jobs.dow_profile(obs).groupBy(*keys).agg(F.sum(F.col("avg_vehicle_count") * F.col("num_features")).alias("t"))
    joined = want.alias("a").join(
        got.alias("b"), [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    rows = joined.select(F.col("a.t").alias("want"), F.col("b.t").alias("got")).collect()
    assert len(rows) == want.count() == 4
    assert all(abs(r.want - r.got) < 1e-9 for r in rows)


def test_broadcast_joins_leave_volumes_unshuffled(spark, inputs):
    obs = jobs.import_csv(spark, inputs["volumes"], inputs["layouts"], inputs["points"], inputs["lines"])
    plan = obs._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_oversized_lookup_falls_back_to_shuffle_join(spark, inputs):
    small = jobs.import_csv(spark, inputs["volumes"], inputs["layouts"], inputs["points"], inputs["lines"])
    cols = [c for c in small.columns if c not in ("volumes", "road")]
    expected = sorted(small.select(*cols).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # Spark's own size check too
    try:
        big = jobs.import_csv(spark, inputs["volumes"], inputs["layouts"], inputs["points"], inputs["lines"],
                              max_broadcast_bytes=1)
        plan = big._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        assert sorted(big.select(*cols).collect()) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookups_are_measured_without_leaving_anything_persisted(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    m = measured(spark.createDataFrame([("a" * 10,), ("b",)], "s string"), "t")
    assert (m.rows, m.broadcast) == (2, True) and m.bytes == 10 + 8 + 1 + 8
    nested = measured(spark.createDataFrame([([[(1.0, 2.0), (3.0, 4.0)]],), (None,)], "road array<array<struct<lon double, lat double>>>"), "n", 1)
    assert (nested.rows, nested.broadcast) == (2, False) and nested.bytes == (2 * 16 + 16 + 16) + 16
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    with pytest.raises(EmptyLookup, match="no things found"):
        measured(spark.createDataFrame([], "s string"), "things", needs_rows=True)


def test_schema_check(spark):
    df = spark.createDataFrame([("x",)], "feature_id string")
    with pytest.raises(SchemaMismatch, match="missing site"):
        check_schema(df, OBSERVATIONS_SCHEMA, "observations")


def test_import_again_gives_the_same_table(spark, inputs):
    root = inputs["root"]
    for _ in range(2):
        jobs.import_job(spark, f"{root}/obs2", inputs["volumes"], inputs["layouts"], inputs["points"], inputs["lines"])
    assert spark.read.parquet(f"{root}/obs2").count() == 6


def import_rows(spark, inputs, name, rows, **options):
    folder = write_volume_csv(f"{inputs['root']}/{name}", rows)
    jobs.import_job(spark, f"{inputs['root']}/merged", folder, inputs["layouts"], inputs["points"], inputs["lines"], **options)
    return {r.feature_id: (str(r.obs_date), list(r.volumes)[:1]) for r in spark.read.parquet(f"{inputs['root']}/merged").collect()}


def test_a_later_import_keeps_earlier_days_and_replaces_its_own_ids(spark, inputs):
    first = import_rows(spark, inputs, "v1", [("1", "2012-01-31 00:00:00", "1", counts(1)), ("1", "2012-01-24 00:00:00", "1", counts(2)),
                                              ("1", "2012-02-07 00:00:00", "2", counts(3))])
    assert len(first) == 3
    # the same weekday in another month; in one month already stored; and a corrected row
    second = import_rows(spark, inputs, "v2", [("1", "2012-02-07 00:00:00", "1", counts(4)), ("1", "2012-01-24 00:00:00", "1", counts(9))])
    assert sorted(second.values()) == [("2012-01-24", [9]), ("2012-01-31", [1]), ("2012-02-07", [3]), ("2012-02-07", [4])]
    parts = {(r.day_of_week, r.obs_month) for r in spark.read.parquet(f"{inputs['root']}/merged").select("day_of_week", "obs_month").distinct().collect()}
    assert parts == {("Tue", 201201), ("Tue", 201202)}


def test_of_lines_for_one_detector_day_the_last_in_file_order_stays(spark, inputs):
    got = import_rows(spark, inputs, "v1", [("1", TUE, "1", counts(n)) for n in (5, 8, 2)] + [("1", WED, "1", counts(7))])
    assert sorted(got.values()) == [("2012-01-31", [2]), ("2012-02-01", [7])]


def test_create_refuses_an_existing_table(spark, inputs):
    from loopcount.sinks import TableExists
    rows = [("1", TUE, "1", counts(5))]
    import_rows(spark, inputs, "v1", rows, mode="create")
    with pytest.raises(TableExists):
        import_rows(spark, inputs, "v2", rows, mode="create")


@pytest.mark.parametrize("scheme", ["", "file:"])
def test_a_table_of_another_schema_is_refused_in_every_mode(spark, inputs, scheme):
    from loopcount import sinks
    root = inputs["root"]
    obs = jobs.import_csv(spark, inputs["volumes"], inputs["layouts"], inputs["points"], inputs["lines"])
    # written with dynamic overwrite, so without a marker file
    (obs.drop("road").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day_of_week", "obs_month").parquet(f"{root}/other"))
    for mode in ("merge", "create"):
        with pytest.raises(SchemaMismatch, match="missing road"):
            sinks.write_observations(obs, f"{scheme}{root}/other", mode=mode)
    prof = jobs.dow_profile(obs)
    prof.drop("num_features").write.partitionBy("day_of_week").parquet(f"{root}/other_profile")
    with pytest.raises(SchemaMismatch, match="missing num_features"):
        sinks.write_profile(prof, f"{scheme}{root}/other_profile")
    assert spark.read.parquet(f"{root}/other").count() == 6


def test_the_write_shuffles_once_and_keeps_sites_whole(spark, inputs):
    from pyspark.sql import Window
    obs = jobs.import_csv(spark, inputs["volumes"], inputs["layouts"], inputs["points"], inputs["lines"])
    key = ["day_of_week", "obs_month", "site"]
    ranked = obs.repartitionByRange(*key).withColumn("n", F.row_number().over(Window.partitionBy(*key, "detector", "obs_date").orderBy("volumes")))
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan


def test_date_filters_prune_months(spark, inputs):
    from datetime import date
    root = inputs["root"]
    jobs.import_job(spark, f"{root}/obs", inputs["volumes"], inputs["layouts"], inputs["points"], inputs["lines"])
    df = read_table(spark, f"{root}/obs", first_date=date(2012, 2, 1), last_date=date(2012, 2, 29))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "obs_month" in plan.split("PartitionFilters:")[1].split("]")[0] and {r.day_of_week for r in df.collect()} == {"Wed"}
    assert df.count() == 3


def test_the_srid_survives_parquet(spark, inputs):
    root = inputs["root"]
    jobs.import_job(spark, f"{root}/obs", inputs["volumes"], inputs["layouts"], inputs["points"], inputs["lines"])
    jobs.profile_job(spark, f"{root}/obs", f"{root}/prof")
    for table, columns in (("obs", ("point_wkt", "lon", "lat", "road_wkt", "road")), ("prof", ("point_wkt", "lon", "lat", "road_wkt"))):
        schema = spark.read.parquet(f"{root}/{table}").schema
        assert all(schema[c].metadata == {"srid": 4326} for c in columns)


def test_an_empty_point_file_is_an_error(spark, inputs):
    write_text(f"{inputs['root']}/none", "p.csv", "WKT,SITE_NO\n")
    with pytest.raises(EmptyLookup):
        jobs.import_job(spark, f"{inputs['root']}/out", inputs["volumes"], inputs["layouts"], f"{inputs['root']}/none")


def test_sql_form_broadcasts_only_what_was_measured(spark, inputs):
    order = csv_source.ORDER_COLUMNS
    args = (csv_source.read_raw_volumes(spark, inputs["volumes"]), csv_source.read_points(spark, inputs["points"]),
            csv_source.read_site_layouts(spark, inputs["layouts"]), csv_source.read_lines(spark, inputs["lines"]))
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    df = jobs.import_sql(spark, *args, point_order=order, line_order=order, layout_order=order, max_broadcast_bytes=1)
    assert "strategy=broadcast" not in df._jdf.queryExecution().analyzed().toString() + df._jdf.queryExecution().optimizedPlan().toString()
    assert df.count() == 6 and spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_no_road_text_in_the_profile_s_main_exchange(spark, inputs):
    root = inputs["root"]
    jobs.import_job(spark, f"{root}/obs", inputs["volumes"], inputs["layouts"], inputs["points"], inputs["lines"])
    from loopcount.operators import profile
    from loopcount import sinks
    plan = profile.slot_sums(spark.read.parquet(f"{root}/obs"), sinks.read_roads(spark, f"{root}/obs"))._jdf.queryExecution().executedPlan().toString()
    main = [line for line in plan.splitlines() if "Exchange hashpartitioning(site" in line]
    assert len(main) == 1 and "road_key" in main[0] and "road_wkt" not in main[0]


def test_command_line(spark, inputs):
    from loopcount.__main__ import main
    root = inputs["root"]
    assert main(["import", "--volumes", inputs["volumes"], "--layouts", inputs["layouts"], "--points",
                 inputs["points"], "--lines", inputs["lines"], "--output", f"{root}/cli_obs"]) == 0
    with pytest.raises(SystemExit):
        main(["import", "--mode", "overwrite"])
    assert main(["profile", "--observations", f"{root}/cli_obs", "--output", f"{root}/cli_prof",
                 "--day-of-week", "Tue"]) == 0
    assert spark.read.parquet(f"{root}/cli_prof").count() == 2 * 96


def test_hot_site_is_combined_before_the_shuffle(spark):
    """A site holding a third of all rows: exact averages, and the plan aggregates map-side
    (one partial row per group and task goes through the exchange)."""
    from datetime import date

    from loopcount.operators import profile
    rows = []
    for k in range(300):
        site = "hot" if k % 3 == 0 else f"s{k}"
        rows.append((site, "Tue", "POINT (1 2)", None, 1.0, 2.0, [k % 5] * 96, date(2012, 1, 31)))
    obs = spark.createDataFrame(rows, "site string, day_of_week string, point_wkt string, road_wkt string, "
                                      "lon double, lat double, volumes array<int>, obs_date date").repartition(8)
    prof = profile.dow_profile(obs)
    plan = prof._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan   # the function list is truncated after the first fields
    hot = prof.where("site = 'hot' AND slot = 7").first()
    assert hot.num_features == 100
    assert abs(hot.avg_vehicle_count - sum(k % 5 for k in range(0, 300, 3)) / 100) < 1e-12

"""Filter texts (S8), declared feature types and catalog tables (K3)."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from loopcount import feature_types, sinks
from loopcount.feature_types import BadDeclaration, access_paths, declared, parse, schema
from loopcount.functions import curve
from loopcount.functions.cql import BadFilter, cql_filter
from loopcount.plans import jobs
from loopcount.schemas import DOW_PROFILE_SCHEMA, OBSERVATIONS_SCHEMA, check_schema
from loopcount.sources.tables import read_table
from tests.conftest import write_text, write_volume_csv

ROWS = [("1", "Tue", date(2012, 1, 31), 144.1, -37.0, "100", "INT A", [0, 5]), ("2", "Wed", date(2012, 2, 1), 144.5, -37.5, None, "INT B", [3, 0]),
        ("10", "Tue", date(2012, 2, 7), 145.0, -38.0, "7", "it's", [9, 9]), ("11", "Thu", date(2012, 3, 1), None, None, "8", None, [1, 1])]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame(ROWS, "site string, day_of_week string, obs_date date, lon double, lat double, hf_id string, ds_location string, volumes array<int>")
    return df.withColumn("obs_month", F.year("obs_date") * 100 + F.month("obs_date")).withColumn("place", curve.place(F.col("lon"), F.col("lat"))).cache()


@pytest.mark.parametrize("text,sites", [
    ("DAY_OF_WEEK='Tue'", {"1", "10"}), ("DAY_OF_WEEK <> 'Tue'", {"2", "11"}), ("day_of_week = 'Tue' and HF = '7'", {"10"}),
    ("HF IS NULL", {"2"}), ("HF IS NOT NULL AND NOT HF IN ('7', '8')", {"1"}), ("HF NOT IN ('7')", {"1", "11"}),
    ("DS_LOCATION LIKE 'INT%'", {"1", "2"}), ("DS_LOCATION NOT LIKE 'INT%'", {"10"}), ("DS_LOCATION ILIKE 'int _'", {"1", "2"}), ("DS_LOCATION = 'it''s'", {"10"}),
    ("NB_SCATS_SITE BETWEEN '1' AND '10'", {"1", "10"}), ("V01 >= 5", {"1", "10"}), ("V00 + 0 = 0", None), ("V00 BETWEEN 1 AND 3", {"2", "11"}), ("V00 = 9.0", {"10"}),
    ("BBOX(geometry, 144, -37.6, 144.6, -36.9)", {"1", "2"}), ("BBOX(geometry, 144.1, -37, 144.1, -37, 'EPSG:4326')", {"1"}),
    ("QT_INTERVAL_COUNT DURING 2012-01-31T00:00:00Z/2012-03-01T00:00:00Z", {"2", "10"}),
    ("QT_INTERVAL_COUNT DURING 2012-01-30T23:00:00Z/2012-02-07T00:00:01Z", {"1", "2", "10"}),
    ("QT_INTERVAL_COUNT BEFORE 2012-02-01T00:00:00Z", {"1"}), ("QT_INTERVAL_COUNT BEFORE 2012-02-01T12:00:00Z", {"1", "2"}), ("QT_INTERVAL_COUNT AFTER 2012-02-01", {"10", "11"}),
    ("QT_INTERVAL_COUNT TEQUALS 2012-02-01", {"2"}), ("QT_INTERVAL_COUNT TEQUALS 2012-02-01T01:00:00Z", set()), ("QT_INTERVAL_COUNT >= '2012-02-07'", {"10", "11"}),
    ("QT_INTERVAL_COUNT <> 2012-02-07", {"1", "2", "11"}), ("NOT QT_INTERVAL_COUNT = 2012-02-07", {"1", "2", "11"}),
    ("QT_INTERVAL_COUNT BETWEEN 2012-02-01 AND 2012-02-07", {"2", "10"}), ("QT_INTERVAL_COUNT NOT BETWEEN 2012-02-01 AND 2012-02-07", {"1", "11"}),
    ("QT_INTERVAL_COUNT IN (2012-01-31, 2012-03-01)", {"1", "11"}), ("obs_date < 2012-02-01", {"1"}),
    ("HF='7' OR DAY_OF_WEEK='Wed' AND NB_SCATS_SITE='1'", {"10"}), ("(HF='7' OR DAY_OF_WEEK='Tue') AND NB_SCATS_SITE='1'", {"1"}), ("NOT (HF='7' OR HF='8')", {"1"}),
    ("INCLUDE", {"1", "2", "10", "11"}), ("EXCLUDE OR HF = '8'", {"11"}), ("((HF = '8'))", {"11"}), ("V00 > -1 AND \"HF\" = '100'", {"1"}),
])
def test_filters(rows, text, sites):
    if sites is None:
        with pytest.raises(BadFilter):
            cql_filter(text)
        return
    assert {r.site for r in rows.where(cql_filter(text)).collect()} == sites


@pytest.mark.parametrize("text", ["", "HF", "HF =", "HF = 'a", "HF = 'a' AND", "(HF = 'a'", "HF = 'a')", "HF LIKE 5", "HF IN ()", "NOPE = 1", "HF BETWEEN '1'", "BBOX(HF, 1, 2, 3, 4)",
                                  "BBOX(geometry, 1, 2, 3)", "QT_INTERVAL_COUNT DURING 2012-01-01", "QT_INTERVAL_COUNT = 2012-02-30", "QT_INTERVAL_COUNT BEFORE 2012-01-01/2012-01-02",
                                  "HF = 'a' HF = 'b'", "HF ; 1", "QT_INTERVAL_COUNT = 'soon'", "HF DURING 2012-01-01/2012-01-02"])
def test_unreadable_filters_are_refused(spark, text):
    with pytest.raises(BadFilter):
        cql_filter(text)


@pytest.fixture
def imported(spark, tmp):
    def run(path):
        vol = write_volume_csv(f"{tmp}/v", [("1", f"2012-{m:02d}-{d:02d} 00:00:00", "1", ['"1"'] * 96) for m in (1, 2, 3) for d in (3, 10, 11)])
        points = write_text(f"{tmp}/p", "p.csv", "WKT,SITE_NO\nPOINT (10 20),1\n")
        layouts = write_text(f"{tmp}/s", "s.csv", "SITE,A,B,LOC,DET,DT,LANE,LMVT,LOCMVT,HF\n1,,,new,1,2012-01-15,1,L,T,101\n")
        jobs.import_job(spark, path, vol, layouts, points)
        return path
    return run


def test_a_filter_prunes_partitions(spark, tmp, imported):
    path = imported(f"{tmp}/obs")
    df = read_table(spark, path, cql="DAY_OF_WEEK = 'Tue' AND QT_INTERVAL_COUNT DURING 2012-01-02T00:00:00Z/2012-01-31T00:00:00Z")
    plan = df._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "day_of_week" in pruned and pruned.count("obs_month") >= 2 and [str(r.obs_date) for r in df.orderBy("obs_date").collect()] == ["2012-01-03", "2012-01-10"]
    boxed = read_table(spark, path, cql="BBOX(geometry, 9, 19, 11, 21)")
    assert boxed.count() == 9 and "place" in boxed._jdf.queryExecution().optimizedPlan().toString()


def plain(struct):
    return {(f.name, f.dataType.simpleString()) for f in struct.fields}


def test_the_declared_types_give_the_two_schemas():
    for name, target in ((feature_types.VOLUME_TYPE, OBSERVATIONS_SCHEMA), (feature_types.PROFILE_TYPE, DOW_PROFILE_SCHEMA)):
        made = schema(declared(name))
        assert plain(made) == plain(target) and len(made.fields) == len(target.fields)
        assert {f.name for f in made.fields if f.metadata} == {"point_wkt", "lon", "lat", "road_wkt"} | ({"road"} & set(made.fieldNames()))
    volumes = declared(feature_types.VOLUME_TYPE)
    assert len(volumes.attributes) == 107 and volumes.geometry.name == "geometry" and [a.name for a in volumes.indexed] == ["NB_SCATS_SITE", "DAY_OF_WEEK", "HF"]


def test_access_paths_are_those_of_the_writers():
    paths = access_paths(declared(feature_types.VOLUME_TYPE))
    assert paths.partitions == sinks.OBSERVATION_PARTITIONS and set(paths.bloom) == set(sinks.BLOOM_FILTERS) and paths.order == ["place", "site"]
    paths = access_paths(declared(feature_types.PROFILE_TYPE))
    assert paths.partitions == [sinks.PARTITION_COLUMN] and paths.order == ["site", "slot"] and paths.bloom == []


@pytest.mark.parametrize("text,key", [("a", None), ("a:Strin", None), ("a:String,a:String", None), ("*a:Point,*b:Point", None), ("a:String:index", None), ("", None), ("a:String", "a"), ("a:Date", "b")])
def test_bad_declarations(text, key):
    with pytest.raises(BadDeclaration):
        parse("t", text, key)
    kind = parse("t", " *g:Point:srid=4326:index=full , d:Date", "d")
    assert kind.geometry.options == {"srid": "4326", "index": "full"} and kind.date_key == "d"


def test_a_table_made_before_the_first_write(spark, tmp, imported):
    kind = declared(feature_types.VOLUME_TYPE)
    feature_types.create_table(spark, "declared_counts", f"{tmp}/obs", kind)
    try:
        assert spark.table("declared_counts").count() == 0
        check_schema(spark.table("declared_counts"), OBSERVATIONS_SCHEMA, "declared")
        imported(f"{tmp}/obs")
        feature_types.refresh_table(spark, "declared_counts")
        parts = {r.partition for r in spark.sql("SHOW PARTITIONS declared_counts").collect()}
        assert parts == {f"day_of_week={d}/obs_month={m}" for d, m in (("Tue", 201201), ("Wed", 201201), ("Fri", 201202), ("Sat", 201202), ("Sat", 201203), ("Sun", 201203))}
        df = spark.sql("SELECT site FROM declared_counts WHERE day_of_week = 'Tue'")
        assert df.count() == 2 and "day_of_week" in df._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1].split("]")[0]
        feature_types.create_table(spark, "declared_counts", f"{tmp}/obs", kind)  # again: stays
        assert spark.table("declared_counts").count() == 9
    finally:
        spark.sql("DROP TABLE declared_counts")
    feature_types.create_table(spark, "declared_counts", f"{tmp}/obs", kind)  # over what is stored
    assert spark.table("declared_counts").count() == 9
    spark.sql("DROP TABLE declared_counts")

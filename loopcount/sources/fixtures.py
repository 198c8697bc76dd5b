"""The driver's tables reshaped into the import job's four inputs.

This stands in for the raw CSV files: ``events`` becomes detector-day count rows, ``supplier``
the site points, ``nation`` the road lines and ``lineitem`` the lane layouts. The mapping is
fixed by the fixture description; the operators downstream do not know where rows came from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loopcount.schemas import SLOT_MINUTES, SLOTS

# Event type → detector number; any other type is detector '5'.
DETECTOR_OF_EVENT = {"click": "1", "error": "2", "purchase": "3", "signup": "4"}
OTHER_DETECTOR = "5"

# Detectors 1-4 have the layouts of line numbers 1-4, detector 5 has none (later
# line numbers are detectors 6 and up); layout rows are ordered by these columns.
WITHOUT_LAYOUT = 5
LAYOUT_ORDER = ["l_orderkey", "l_partkey", "l_returnflag", "l_linestatus"]

# The columns of a line item that layouts are made of.
LAYOUT_SOURCE = [*LAYOUT_ORDER, "l_suppkey", "l_linenumber", "l_shipdate"]

# Line geometry per nation region; region 4 is a polygon (no road).
POLYGON_REGION = 4
POLYGON_WKT = "POLYGON ((0 0, 1 0, 1 1, 0 0))"
# Lines of this region have a line break inside their text.
BROKEN_TEXT_REGION = 1

# Every fifth supplier has an earlier record that must lose; the last record of
# every eleventh is the text 'null'.
EARLIER_POINT = (5, "POINT (1 2)")
NO_POINT = (11, "null")


# Days of the month whose counts are lowered are multiples of this.
LOWERED_DAY = 7

# Fixed value: the first day on which a dated layout begins.
FIRST_LAYOUT_DAY = "2023-12-25"

# A box (lon and lat of the lower, then of the upper corner), and some flow ids.
BOX = (144.035, -37.62, 144.115, -37.175)
FLOWS = ["7", "31", "58", "1000"]

# Fixed value: a filter text over several attributes.
CQL = ("(DAY_OF_WEEK IN ('Tue', 'Thu') OR HF = '31') AND QT_INTERVAL_COUNT DURING 2024-01-03T00:00:00Z/2024-01-25T00:00:00Z "
       "AND NOT (DS_LOCATION LIKE 'INT 1%' OR NB_LANE IS NULL) AND (BBOX(geometry, 144.02, -37.8, 144.2, -37.1) OR NB_SCATS_SITE BETWEEN '3' AND '5') AND V10 >= 0")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _absent_pattern_sql() -> str:
    """Texts of the slots without events, per row kind: detector-2 rows of every seventh site
    alternate '' and '-1'; other rows cycle '', '-1', '0' by (site + slot) mod 3."""
    def literal(texts: list[str]) -> str:
        return "array(" + ", ".join(f"'{t}'" for t in texts) + ")"
    negative = literal(["" if i % 2 == 0 else "-1" for i in range(SLOTS)])
    by_phase = [literal([["", "-1", "0"][(r + i) % 3] for i in range(SLOTS)]) for r in range(3)]
    return (f"CASE WHEN {_NEGATIVE_ROW_SQL} THEN {negative} "
            f"WHEN user_id % 3 = 0 THEN {by_phase[0]} WHEN user_id % 3 = 1 THEN {by_phase[1]} "
            f"ELSE {by_phase[2]} END")


# Rows whose present counts are written negative (they must all drop).
_NEGATIVE_ROW_SQL = "(detector = '2' AND user_id % 7 = 0)"


def raw_volumes(events: DataFrame) -> DataFrame:
    """One raw row per (site, detector, day) with an event; slot counts as text.

    Events are counted by slot first, and only the slots that have some are collected by day:
    what is shuffled and held grows with the events, not with 96 counts for each day. A present
    count n becomes 'n' ('-n' on the rows that must drop); an absent one comes from a fixed
    pattern per row kind, so the per-slot work is one small lambda.
    """
    detector = F.coalesce(
        F.create_map(*[F.lit(x) for kv in DETECTOR_OF_EVENT.items() for x in kv])[F.col("event_type")],
        F.lit(OTHER_DETECTOR))
    slot = (F.hour("ts") * (60 // SLOT_MINUTES) + (F.minute("ts") / SLOT_MINUTES).cast("int"))
    keyed = events.select(F.col("user_id"), detector.alias("detector"),
                          F.to_date("ts").alias("day"), slot.alias("slot"))
    sign = f"(CASE WHEN {_NEGATIVE_ROW_SQL} THEN -1 ELSE 1 END)"
    by_slot = keyed.groupBy("user_id", "detector", "day", "slot").agg(F.count(F.lit(1)).alias("n"))
    text = F.struct("slot", (F.col("n") * F.expr(sign)).cast("string").alias("text"))
    counted = by_slot.groupBy("user_id", "detector", "day").agg(
        F.collect_list(F.when(F.col("slot").isNotNull(), text)).alias("present"))
    # Most days have events in a few slots only: each of them replaces one text of the pattern.
    raw = F.expr(f"aggregate(present, {_absent_pattern_sql()}, "
                 f"(texts, p) -> concat(slice(texts, 1, p.slot), array(p.text), slice(texts, p.slot + 2, {SLOTS})))")
    # Exploding a one-element array keeps every row as it is, but as a generator it is a plan
    # boundary: the cleaning's filter and projection read its output column instead of each
    # re-running the lambda (measured 35 % faster at sf 0.1).
    return counted.select(
        F.col("user_id").cast("string").alias("site"),
        F.concat(F.col("day").cast("string"), F.lit(" 00:00:00")).alias("qt_interval"),
        F.col("detector"), F.explode(F.array(raw)).alias("raw"))


def points(supplier: DataFrame) -> DataFrame:
    """Site points from suppliers in key order; some have two records, of which the last counts."""
    pad = lambda c: F.lpad(c.cast("string"), 2, "0")
    key = F.col("s_suppkey")
    wkt = F.concat(F.lit("POINT (144."), pad(F.col("s_nationkey")), F.lit(" -37."), pad(key % 100), F.lit(")"))
    record = lambda rank, text: F.struct(F.lit(rank).alias("rank"), text.alias("wkt"))
    records = F.filter(F.array(F.when(key % EARLIER_POINT[0] == 0, record(0, F.lit(EARLIER_POINT[1]))), record(1, wkt),
                               F.when(key % NO_POINT[0] == 0, record(2, F.lit(NO_POINT[1])))), lambda r: r.isNotNull())
    each = supplier.select(key, F.explode(records).alias("r"))
    return each.select(key.cast("string").alias("site"), F.col("r.wkt").alias("wkt"), (key * 3 + F.col("r.rank")).alias("_row"))


def lines(nation: DataFrame) -> DataFrame:
    """Road lines from nations in key order: ids 2k and 2k+2, kind by region."""
    k = F.col("n_nationkey")
    comma = F.when(F.col("n_regionkey") == BROKEN_TEXT_REGION, F.lit(",\n1 ")).otherwise(F.lit(", 1 "))
    seg = F.concat(F.lit("(0 "), k.cast("string"), comma, k.cast("string"), F.lit(")"))
    wkt = (F.when(F.col("n_regionkey") == POLYGON_REGION, F.lit(POLYGON_WKT))
           .when(F.col("n_regionkey") % 2 == 0, F.concat(F.lit("MULTILINESTRING ("), seg, F.lit(")")))
           .otherwise(F.concat(F.lit("LINESTRING "), seg)))
    return nation.select((2 * k).cast("string").alias("hfidl"), (2 * k + 2).cast("string").alias("hfidr"),
                         wkt.alias("wkt"), k.alias("_row"))


def respelled(wkt: Column) -> Column:
    """The same geometry in other numerals: a zero more behind each decimal, ``.0`` behind each whole
    number, and no blank before the bracket."""
    longer = F.regexp_replace(wkt, r"(\d\.\d+)", "$1\\0")
    whole = F.regexp_replace(longer, r"(?<![\d.])(\d+)(?![\d.])", "$1.0")
    return F.regexp_replace(whole, r"^([A-Z]+) \(", "$1(")


def lowered(raw: DataFrame) -> DataFrame:
    """Raw rows with every positive count one lower."""
    lower = F.transform("raw", lambda x: F.when(F.nullif(x, F.lit("")).cast("int") > 0, (F.nullif(x, F.lit("")).cast("int") - 1).cast("string")).otherwise(x))
    return raw.withColumn("raw", lower)


def layouts(lineitem: DataFrame) -> DataFrame:
    """Lane layouts from all line items; the order columns are kept for the first-row rule. The
    location of every fourth part holds a comma, quotes and a backslash at its end."""
    number = F.col("l_linenumber")
    detector = F.when(number >= WITHOUT_LAYOUT, number + 1).otherwise(number)
    odd = F.when(F.col("l_partkey") % 4 == 0, F.lit(', "HIGH" ST \\')).otherwise(F.lit(""))
    return lineitem.select(
        F.col("l_suppkey").cast("string").alias("site"),
        F.concat(F.lit("INT "), F.col("l_partkey").cast("string"), odd).alias("ds_location"),
        detector.cast("string").alias("detector"),
        F.to_date("l_shipdate").cast("string").alias("dt_general"),
        F.col("l_returnflag").alias("nb_lane"),
        F.col("l_linestatus").alias("lane_mvt"),
        (F.col("l_partkey") % 5).cast("string").alias("loc_mvt"),
        (F.col("l_partkey") % 60).cast("string").alias("hf_id"),
        *LAYOUT_ORDER)


def dated_layouts(layouts: DataFrame) -> DataFrame:
    """Layouts (with the line item's ``l_partkey``) that change during the month of the events; every
    fourth site's begin within it, and some rows have no date."""
    part, site = F.col("l_partkey"), F.col("site").cast("long")
    day = F.date_add(F.lit(FIRST_LAYOUT_DAY).cast("date"), ((part * 7 + F.col("detector").cast("long") * 5) % 40 + F.when(site % 4 == 0, 25).otherwise(0)).cast("int"))
    return layouts.withColumn("dt_general", F.when((part % 37 == 0) & (site % 4 != 0), F.lit("")).otherwise(day.cast("string")))


def inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All four import inputs from one scale-factor folder."""
    return {
        "volumes": raw_volumes(table(spark, sf_dir, "events")),
        "points": points(table(spark, sf_dir, "supplier")),
        "lines": lines(table(spark, sf_dir, "nation")),
        "layouts": layouts(table(spark, sf_dir, "lineitem")),
    }

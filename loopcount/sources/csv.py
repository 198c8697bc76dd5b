"""CSV inputs of the import job.

Files are read by Spark's quote-aware CSV reader; a quote inside a quoted field is doubled and
a backslash has no meaning. Every file's header line is skipped. Order-dependent lookups need
the order of lines in the files: ``file_order()`` gives (file path, split start, row id), which
follows file position because row ids increase within a split and splits of one file are
ordered by their start offset.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loopcount.functions.slots import slot_columns
from loopcount.schemas import (
    LAYOUT_CSV_SCHEMA, LINE_HEADER, POINT_HEADER, REQUIRED_VOLUME_HEADER, SLOT_NAMES, SLOTS,
    VOLUME_KEY_HEADER,
)

ORDER_COLUMNS = ["_file", "_block", "_row"]


def file_order() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    ]


def scanned_order() -> list[Column]:
    """The same order by functions of the running scan instead of scan columns, for the volume
    files: with two more columns than their 99 Spark would not generate code for the scan."""
    return [F.input_file_name().alias("_file"), F.input_file_block_start().alias("_block"), F.monotonically_increasing_id().alias("_row")]


def file_ranks(scan: DataFrame) -> DataFrame:
    """The files of a scan by ``input_file_name()``: _name, _file (their rank by path, as ``file_order()`` has it)."""
    names = sorted(scan.inputFiles(), key=unquote)
    return scan.sparkSession.createDataFrame(list(zip(names, range(len(names)))), "_name string, _file int")


class HeaderMismatch(ValueError):
    """A volume file's header does not have its two join columns in place, or not 99 columns."""


def _reader(spark: SparkSession):
    return spark.read.option("header", True).option("escape", '"')


def read_raw_volumes(spark: SparkSession, path: str | list[str], *, with_order: bool = False) -> DataFrame:
    """Raw volume CSV with a header line in each file.

    The first header must have 99 names, with NB_SCATS_SITE first and NB_DETECTOR third; the
    others are free. Spark holds the header of every other file against the first. A line with
    fewer or more than 98 separators fails the job, whichever columns are asked for (empty
    fields are values, also at the end of a line).

    -> site, qt_interval, detector, raw ARRAY<STRING> of the 96 count texts; file order if asked for.
    """
    names = _reader(spark).csv(path).columns
    if len(names) != len(VOLUME_KEY_HEADER) + SLOTS or any(names[i] != n for i, n in REQUIRED_VOLUME_HEADER.items()):
        raise HeaderMismatch(f"expected {len(VOLUME_KEY_HEADER) + SLOTS} columns with "
                             + ", ".join(f"{n} at {i}" for i, n in REQUIRED_VOLUME_HEADER.items()) + f"; found {len(names)}: {names[:4]} ...")
    raw = (_reader(spark).schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
           .option("enforceSchema", False).option("mode", "FAILFAST").option("columnPruning", False).csv(path))
    quoted = [f"`{n}`" for n in names]
    site, interval, detector = quoted[:3]
    return raw.select(F.expr(site).alias("site"), F.expr(interval).alias("qt_interval"), F.expr(detector).alias("detector"),
                      F.expr(f"array({', '.join(quoted[3:])})").alias("raw"), *(scanned_order() if with_order else []))


def read_site_layouts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Site-layout CSV by position (columns 0, 3-9); missing trailing fields are NULL.

    In the order columns the rank of a file stands for its path: layouts are many short rows that
    are sorted in each task, and a path is longer than the rest of its row."""
    raw = _reader(spark).schema(LAYOUT_CSV_SCHEMA).option("enforceSchema", True).csv(path)
    rows = raw.select(
        F.col("NB_SCATS_SITE").alias("site"), F.col("DS_LOCATION").alias("ds_location"),
        F.col("NB_DETECTOR").alias("detector"), F.col("DT_GENERAL").alias("dt_general"),
        F.col("NB_LANE").alias("nb_lane"), F.col("LANE_MVT").alias("lane_mvt"),
        F.col("LOC_MVT").alias("loc_mvt"), F.col("ID_HOMOGENEOUS_FLOW").alias("hf_id"),
        *[c.alias("_name") if n == "_file" else c for n, c in zip(ORDER_COLUMNS, scanned_order())])
    ranked = rows.join(F.broadcast(file_ranks(raw)), "_name", "left")
    rank = F.coalesce("_file", F.raise_error(F.concat(F.lit("no rank for layout file "), "_name")).cast("int"))
    return ranked.withColumn("_file", rank).drop("_name")


def _by_header(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Columns by header name; a quoted field may hold line breaks. Spark names the columns from
    the first file; ``enforceSchema=False`` makes every other file's header agree, instead of
    being read by position."""
    return _reader(spark).option("inferSchema", False).option("enforceSchema", False).option("multiLine", True).csv(path)


def read_points(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Point geometry CSV by header name: SITE_NO, WKT."""
    return _by_header(spark, path).select(
        F.col(POINT_HEADER["site"]).alias("site"), F.col(POINT_HEADER["wkt"]).alias("wkt"), *file_order())


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Line geometry CSV by header name: hfidl, hfidr, WKT."""
    return _by_header(spark, path).select(
        F.col(LINE_HEADER["left"]).alias("hfidl"), F.col(LINE_HEADER["right"]).alias("hfidr"),
        F.col(LINE_HEADER["wkt"]).alias("wkt"), *file_order())


def write_raw_volumes_csv(raw: DataFrame, path: str) -> None:
    """Write canonical raw volume rows in the reference's file layout: quoted, with header."""
    site, interval, detector = VOLUME_KEY_HEADER
    (raw.selectExpr(f"site AS {site}", f"qt_interval AS {interval}", f"detector AS {detector}",
                    *slot_columns("raw[{i}]", SLOT_NAMES))
     .write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)

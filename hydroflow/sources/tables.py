"""Observation files, plant tables and the plant power export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydroflow.config import EXPORT_COLUMNS, EXPORT_PREAMBLE_ROWS
from hydroflow.functions import null_if_nan, parse_german, parse_number, wall_clock
from hydroflow.functions.numbers import column
from hydroflow.operators.features import drop_incomplete
from hydroflow.schemas import EXPORT


def _nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL once, on read."""
    return df.select(
        *[null_if_nan(c).alias(c) if t in ("double", "float") else column(c) for c, t in df.dtypes]
    )


def read_observation_csv(spark: SparkSession, path: str, value: str) -> DataFrame:
    """Two-column files ``phenomenonTime,<value>``: wall-clock time and the one value column, under its own name."""
    raw = (
        spark.read.schema(f"phenomenonTime string, `{value}` double")
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return _nan_to_null(raw).select(wall_clock("phenomenonTime").alias("phenomenonTime"), column(value))


def read_plant_csv(
    spark: SparkSession, path: str, columns: Sequence[str], time_col: str = "time", partitions: Sequence[str] = ()
) -> DataFrame:
    """Merged plant table: wall-clock time, double features and target, rows with a gap in any column dropped.

    Columns are taken by the names in the header; files whose headers differ are refused. With several plants under
    one root (``plant=…/``) the plant is named in ``partitions`` and a filter on it prunes files.
    """
    raw = spark.read.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    typed = [parse_number(c).alias(c) for c in columns]
    return drop_incomplete(raw.select(wall_clock(time_col).alias(time_col), *typed, *[column(c) for c in partitions]))


def read_wide(spark: SparkSession, path: str) -> DataFrame:
    """Wide per-station parquet table."""
    return _nan_to_null(spark.read.parquet(path))


def read_plant_export(
    spark: SparkSession, path: str, encoding: str = "UTF-8", in_parts: bool = False
) -> DataFrame:
    """Plant power export as text columns, names assigned by position. A file is an export, or with ``in_parts`` all
    files of a folder are one."""
    raw = spark.read.schema(EXPORT).option("header", True).option("encoding", encoding).csv(path)
    file = F.col("_metadata.file_path")
    return raw.toDF(*EXPORT_COLUMNS).withColumn("_export", F.regexp_replace(file, "/[^/]*$", "") if in_parts else file)


def clean_plant_export(
    raw: DataFrame, strict: bool = True, preamble_rows: int = EXPORT_PREAMBLE_ROWS
) -> DataFrame:
    """Typed rows of the export without the metadata rows below its header.

    Metadata rows are those whose start is no timestamp. Strict mode demands exactly ``preamble_rows`` of them
    per export and raises on malformed numbers, so that a broken data row is an error and not a silent loss; the
    count runs in the job that reads the rows, and its one row per export goes to the rows, which stay where they are read. Permissive mode drops rows without a start time and turns bad
    numbers into NULL.
    """
    rows = raw.withColumn("_start", parse_german("Datum_von", strict=False))
    if strict:
        odd = rows.groupBy(F.col("_export").alias("_of")).agg(F.count_if(F.col("_start").isNull()).alias("_n"))
        message = F.concat("_export", F.lit(" has "), "_n", F.lit(f" rows without a start time, expected {preamble_rows}."))
        checked = F.when(F.col("_n") != preamble_rows, F.raise_error(message)).isNull()
        rows = rows.join(F.broadcast(odd), F.col("_export") == F.col("_of")).filter(checked)
    return rows.filter(F.col("_start").isNotNull()).select(
        F.col("_start").alias("Datum_von"),
        parse_german("Datum_bis", strict=False).alias("Datum_bis"),
        parse_number("el", strict).alias("el"),
        parse_number("el1", strict).alias("el1"),
    )

"""Batch readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line; split sizes follow ``spark.sql.files.maxPartitionBytes``."""
    return spark.read.text(path)


def csv_table(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> DataFrame:
    """CSV under a given schema; a quote inside a quoted field is doubled."""
    return spark.read.csv(path, schema=schema, header=header, quote='"', escape='"')


def csv_lines(spark: SparkSession, path: str | list[str], schema: StructType, header: bool = True) -> DataFrame:
    """The records of CSV files as lines, without the header; none is lost however broken.

    A header that does not name the columns of ``schema`` in their order stays, as a record that
    cannot be read. Records end with their line. Empty lines are no records.
    """
    lines = spark.read.text(path).filter(F.length("value") > 0)
    return lines.filter(F.col("value") != ",".join(schema.names)) if header else lines


def links_with_tmdb(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The links file without the rows that have no tmdbId."""
    return csv_table(spark, path, schema).filter(F.col("tmdbId").isNotNull())

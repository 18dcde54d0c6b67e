"""Sheets, typing results, alignment hits and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqlab.operators.reports import malformed, report_schema

# The twelve columns of a tabular alignment report.
HITS_SCHEMA = (
    "allele string, contig string, identity double, aln_length int, mismatch int, gap int, "
    "qstart int, qend int, sstart int, send int, evalue double, score double"
)


def read_sheet(spark: SparkSession, path, sep: str = ",", order: str | None = None) -> DataFrame:
    """A sheet with a header; every column is text, and empty fields are NULL.

    ``order`` names a column to add that grows along the rows of the sheet.
    """
    sheet = spark.read.csv(path, header=True, inferSchema=False, sep=sep, quote='"', escape='"')
    return sheet.withColumn(order, F.monotonically_increasing_id()) if order else sheet


def read_first_row(spark: SparkSession, path, sep: str = "\t") -> DataFrame:
    """The first data row of every file, with ``path``.

    Rows are ordered by the start of their file block and, inside one block, by reading order.
    """
    rows = read_sheet(spark, path, sep)
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    tagged = rows.select(F.col("_metadata.file_path").alias("path"), place.alias("_place"), F.struct("*").alias("_row"))
    return tagged.groupBy("path").agg(F.min_by("_row", "_place").alias("_row")).select("path", "_row.*")


def read_hits(spark: SparkSession, path) -> DataFrame:
    """Alignment hits: tab-separated, no header, typed."""
    return spark.read.schema(HITS_SCHEMA).csv(path, sep="\t")


def read_reports(spark: SparkSession, path, schema: T.StructType | None = None) -> DataFrame:
    """Nested reports, one JSON object per line; only the wanted fields are parsed."""
    return spark.read.schema(schema or report_schema()).json(path)


def malformed_reports(spark: SparkSession, path) -> DataFrame:
    """(path, line_number, line) of the lines of report files that are no JSON object; blank lines are none.

    Lines are counted in the blocks that tasks read, so a file of any size is checked by many tasks.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"), F.col("value").alias("line")
    )
    blocks = lines.groupBy("path", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = blocks.select("path", "_block", (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_offset"))
    return malformed(lines, "line").join(offsets, ["path", "_block"]).select("path", (F.col("_at") + F.col("_offset")).alias("line_number"), "line")

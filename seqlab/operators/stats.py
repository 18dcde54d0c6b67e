"""Counts and assembly statistics. Sequences are reduced to lengths and counts before any shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqlab.functions import count_chars, div, percent_2dp

# Letters that are counted, and the rule for the number of variable sites.
GC_LETTERS = "GCgc"
GENOME_LETTERS = "ATCG"
SITES_DIVISOR = 50
SITES_MINIMUM = 10000

# Ends of the assembly file names in the report.
ASSEMBLY_FILES = {"spades": "_scaffolds.fasta", "flye": "_longassembly.fasta", "original": "_original.fasta"}


def gc_percent(sequence) -> Column:
    """GC share of one sequence in percent, 0 for an empty one."""
    size = F.length(sequence)
    return F.when(size > 0, count_chars(sequence, GC_LETTERS) / size * 100.0).otherwise(F.lit(0.0))


def count_reads(reads: DataFrame, *by: str) -> DataFrame:
    """Number of records per group; sequence and quality are not read."""
    return reads.groupBy(*by).agg(F.count(F.lit(1)).alias("n_reads"))


def count_reads_from_lines(lines: DataFrame, *by: str) -> DataFrame:
    """Number of whole four-line records per group of text lines; a partial last record is ignored."""
    return lines.groupBy(*by).agg(div(F.count(F.lit(1)), F.lit(4)).alias("n_reads"))


def n50_from_lengths(lengths: DataFrame, by: list[str], length: str, out: str = "n50") -> DataFrame:
    """N50 per group: the longest length whose running total, longest first, reaches half of all bases.

    Equal lengths are merged before the window, so its size is the number of distinct lengths of a group.
    """
    merged = lengths.groupBy(*by, F.col(length).alias("_len")).agg(F.count(F.lit(1)).alias("_n"))
    return _n50(merged, by).select(*by, F.col("n50").alias(out))


def _n50(merged: DataFrame, by: list[str], extra: tuple[str, ...] = ()) -> DataFrame:
    """merged: by, _len, _n and counters to sum; one row per distinct length."""
    bases = F.col("_len") * F.col("_n")
    running = Window.partitionBy(*by).orderBy(F.col("_len").desc()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    placed = merged.select(
        "*", F.sum(bases).over(running).alias("_upto"), F.sum(bases).over(whole).alias("_total")
    )
    return placed.groupBy(*by).agg(
        F.max(F.when(F.col("_upto") * 2 >= F.col("_total"), F.col("_len"))).alias("n50"),
        F.sum(bases).alias("total_bases"),
        F.sum("_n").alias("number_of_contigs"),
        *[F.sum(c).alias(c) for c in extra],
    )


def assembly_stats(contigs: DataFrame, *by: str) -> DataFrame:
    """Total bases, contigs, N50 and GC % per group of contigs; empty contigs are ignored."""
    keys = list(by)
    reduced = (
        contigs.where(F.length("sequence") > 0)
        .select(*keys, F.length("sequence").cast("bigint").alias("_len"), count_chars("sequence", GC_LETTERS).alias("_gc"))
        .groupBy(*keys, "_len")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("_gc").alias("_gc"))
    )
    return _n50(reduced, keys, ("_gc",)).select(
        *keys, "total_bases", "number_of_contigs", "n50", percent_2dp("_gc", "total_bases").alias("gc_content")
    )


def genome_length(contigs: DataFrame, *by: str) -> DataFrame:
    """Upper-case A, T, C, G bases per group, and the number of variable sites derived from it."""
    counted = contigs.groupBy(*by).agg(F.sum(count_chars("sequence", GENOME_LETTERS)).alias("genome_length"))
    sites = F.greatest(div(F.col("genome_length"), F.lit(SITES_DIVISOR)), F.lit(SITES_MINIMUM).cast("bigint"))
    return counted.withColumn("variable_sites", sites)


def assembler_report(
    sheet: DataFrame, assemblies: DataFrame, key: str, tool: str, tools: list[str], files: dict[str, str] = ASSEMBLY_FILES
) -> DataFrame:
    """Sheet with the statistics and the file name of every assembler's contigs as <tool>_<statistic> columns."""
    stats = assembly_stats(assemblies, key, tool)
    wide = stats.groupBy(key).pivot(tool, tools).agg(
        F.first("total_bases").alias("total_bases"),
        F.first("number_of_contigs").alias("number_of_contigs"),
        F.first("n50").alias("n50"),
        F.first("gc_content").alias("gc_content"),
    )
    names = {f"{t}_assembly": F.concat(F.col(key), F.lit(files[t])) for t in tools if t in files}
    return sheet.join(wide, key, "left").withColumns(names)

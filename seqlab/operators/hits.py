"""Locus annotation: best hit per locus, strand, and features in contig order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlab.operators.positions import rank_by_range

FEATURE_TYPE = "gene"
SOURCE = "seqlab"


def best_hit(hits: DataFrame, locus: str, score: str, ties: list[str]) -> DataFrame:
    """The hit with the highest score per locus; equal scores are settled by the ``ties`` columns, smallest first.

    A hit without a score is no candidate.

    ``min_by`` is combined before the shuffle, so a locus with a third of all hits is no hot spot.
    """
    order = F.struct((-F.col(score)).alias("s"), *[F.col(c) for c in ties])
    return hits.where(F.col(score).isNotNull()).groupBy(locus).agg(F.min_by(F.struct(*[c for c in hits.columns if c != locus]), order).alias("r")).select(
        locus, "r.*"
    )


def strand_norm(hits: DataFrame, start: str, end: str) -> DataFrame:
    """feat_start (0-based), feat_end and strand: a reversed hit is swapped and gets strand -1."""
    return hits.withColumns(
        {
            "feat_start": F.least(start, end) - F.lit(1),
            "feat_end": F.greatest(start, end),
            "strand": F.when(F.col(start) > F.col(end), F.lit(-1)).otherwise(F.lit(1)),
        }
    )


def as_features(best: DataFrame) -> DataFrame:
    """Feature columns of normalised best hits (allele, contig, feat_start, feat_end, strand)."""
    return best.select(
        "contig",
        "feat_start",
        "feat_end",
        "strand",
        F.lit(FEATURE_TYPE).alias("type"),
        F.col("allele").alias("locus"),
        F.col("allele").alias("gene"),
        F.lit(f"Evidence:{SOURCE}").alias("note"),
        F.lit(SOURCE).alias("source"),
    )


def number_features(features: DataFrame, contig: str, start: str, ties: list[str], out: str = "feature_number") -> DataFrame:
    """Position of each feature on its contig by start, then by the ``ties`` columns."""
    return rank_by_range(features, [contig], [start, *ties], out)


def contig_features(contigs: DataFrame, features: DataFrame, contig: str, start: str, ties: list[str]) -> DataFrame:
    """Every contig with its features in start order, one row per feature; a bare contig keeps one row.

    Rows, not one array per contig: a contig with a third of all features would not fit one task. For the same
    reason it is an inner join, whose skewed side can be split at run time, plus the bare contigs.
    """
    numbered = number_features(features, contig, start, ties)
    bare = contigs.join(features.select(contig).distinct(), contig, "left_anti")
    return contigs.join(numbered, contig).unionByName(bare, allowMissingColumns=True)


def sorted_features(features: DataFrame, *order: str) -> DataFrame:
    """Features sorted by start (range-partitioned sort)."""
    return features.orderBy(*order)


def annotate(contigs: DataFrame, hits: DataFrame) -> DataFrame:
    """Hit table (12 columns) to numbered features per contig."""
    best = best_hit(hits, "allele", "score", ["contig", "sstart", "send", "qstart", "qend"])
    features = as_features(strand_norm(best, "sstart", "send"))
    return contig_features(contigs, features, "contig", "feat_start", ["locus"])

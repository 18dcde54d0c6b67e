"""Nested assembly reports (JSON lines) to one flat row each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The report fields, in sheet order.
REPORT_PATHS = [
    "accession",
    "assemblyInfo.biosample.accession",
    "assemblyInfo.biosample.strain",
    "annotationInfo.pipeline",
    "annotationInfo.softwareVersion",
    "annotationInfo.releaseDate",
    "annotationInfo.stats.geneCounts.nonCoding",
    "annotationInfo.stats.geneCounts.proteinCoding",
    "annotationInfo.stats.geneCounts.pseudogene",
    "annotationInfo.stats.geneCounts.total",
    "assemblyInfo.bioprojectAccession",
    "assemblyStats.contigN50",
    "assemblyStats.gcPercent",
    "assemblyStats.numberOfContigs",
    "assemblyStats.totalSequenceLength",
    "averageNucleotideIdentity.bestAniMatch.ani",
    "averageNucleotideIdentity.bestAniMatch.organismName",
    "averageNucleotideIdentity.bestAniMatch.assembly",
    "averageNucleotideIdentity.bestAniMatch.assemblyCoverage",
    "checkmInfo.checkmMarkerSet",
    "checkmInfo.checkmMarkerSetRank",
    "checkmInfo.species",
    "checkmInfo.completeness",
    "checkmInfo.checkmVersion",
    "organism.organismName",
    "organism.taxId",
]
FALLBACKS = {"checkmInfo.species": "checkmInfo.checkmSpeciesTaxId"}
# JSON texts that count as missing.
FALSY = r"^(|false|null|\{\}|\[\]|-?0+(\.0*)?([eE][+-]?\d+)?)$"
FALSY_STARTS = ("", "0", "-", "f", "n", "{", "[")


def flat_name(path: str) -> str:
    """Deep paths keep the case of their first and last part; others are lower-cased."""
    parts = path.split(".")
    if len(parts) > 2:
        return f"{parts[0]}_{parts[-1]}"
    return "_".join(parts).lower()


def report_schema(paths: list[str] = REPORT_PATHS, fallbacks: dict[str, str] = FALLBACKS) -> T.StructType:
    """Nested schema of the wanted leaves only, all as text; other fields of the report are skipped by the parser."""
    tree: dict = {}
    for path in [*paths, *fallbacks.values()]:
        node = tree
        *parents, leaf = path.split(".")
        for part in parents:
            node = node.setdefault(part, {})
        node[leaf] = None

    def build(node: dict) -> T.StructType:
        return T.StructType(
            [T.StructField(name, T.StringType() if child is None else build(child)) for name, child in node.items()]
        )

    return build(tree)


def truthy(value: Column) -> Column:
    """NULL for missing, empty, zero and false values. Only texts that begin like one are matched in full."""
    suspect = F.substring(value, 1, 1).isin(*FALSY_STARTS)
    return F.when(~(suspect & value.rlike(FALSY)), value)


def flatten_report(
    df: DataFrame,
    paths: list[str] = REPORT_PATHS,
    root: str | None = None,
    keep: tuple[str, ...] = (),
    fallbacks: dict[str, str] = FALLBACKS,
) -> DataFrame:
    """One text column per path; ``root`` is the struct column that holds the report, if any."""

    def leaf(path: str) -> Column:
        return truthy(F.col(f"{root}.{path}" if root else path))

    columns = [
        F.coalesce(leaf(p), *([leaf(fallbacks[p])] if p in fallbacks else [])).alias(flat_name(p)) for p in paths
    ]
    return df.select(*keep, *columns)


def parse_reports(df: DataFrame, text: str, paths: list[str] = REPORT_PATHS) -> DataFrame:
    """Replace a JSON text column by the struct column ``report``."""
    schema = report_schema(paths, {p: f for p, f in FALLBACKS.items() if p in paths})
    return df.withColumn("report", F.from_json(text, schema)).drop(text)


def variant_reports(df: DataFrame, text: str) -> DataFrame:
    """Replace a JSON text column by the variant column ``report``, parsed once; a line that is no JSON is NULL (see ``malformed``)."""
    return df.withColumn("report", F.try_parse_json(text)).drop(text)


def malformed(df: DataFrame, text: str) -> DataFrame:
    """The rows whose text is not blank and no JSON object."""
    kind = F.schema_of_variant(F.try_parse_json(text))
    return df.where((F.trim(text) != "") & ~F.coalesce(kind.startswith("OBJECT"), F.lit(False)))


def flatten_variant(
    df: DataFrame, paths: list[str] = REPORT_PATHS, root: str = "report", keep: tuple[str, ...] = (), fallbacks: dict[str, str] = FALLBACKS
) -> DataFrame:
    """As ``flatten_report``, by paths into the variant column ``root``; any other path can be read from it without parsing again.

    Numbers are as the variant holds them: an exponent is written out.
    """

    def leaf(path: str) -> Column:
        return truthy(F.try_variant_get(F.col(root), f"$.{path}", "string"))

    columns = [F.coalesce(leaf(p), *([leaf(fallbacks[p])] if p in fallbacks else [])).alias(flat_name(p)) for p in paths]
    return df.select(*keep, *columns)

"""Sheet validation: one pass that reports every broken rule of every row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlab.functions import is_blank

# Column names and value patterns of the two sheet conventions.
REQUIRED_COLUMNS = ("SAMPLE_NAME", "SHORT_READS", "ASSEMBLY", "SPECIES", "ST", "AMR", "USE_ORIGINAL_READS")
REQUIRED_KEYS = ("sample_name", "short_reads", "assembly", "species", "st", "use_original_reads")
ASSEMBLY_PATTERN = r"^GC\w_\d+(\.\d+)?"
ST_PATTERN = r"^ST\d+"
FLAG_VALUES = ("TRUE", "FALSE")


def missing_keys(df: DataFrame, required: Iterable[str] = REQUIRED_KEYS) -> list[str]:
    """The keys of the lower-case convention that a sheet lacks."""
    return sorted(set(required) - set(df.columns))


def missing_columns(df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS) -> list[str]:
    return sorted(set(required) - set(df.columns))


def lower_case_columns(df: DataFrame) -> DataFrame:
    """The one convention used after ingest."""
    return df.toDF(*[c.lower() for c in df.columns])


def not_null(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def row_rules(df: DataFrame) -> dict[str, Column]:
    """Every row needs an assembly or reads. The reads column may be READS or SHORT_READS."""
    reads = [c for c in df.columns if c.lower() in ("reads", "short_reads")]
    assembly = next(c for c in df.columns if c.lower() == "assembly")
    no_reads = F.lit(True)
    for c in reads:
        no_reads = no_reads & is_blank(c)
    return {"assembly or reads": is_blank(assembly) & no_reads}


def format_rules() -> dict[str, Column]:
    """Rule name -> condition that is true for a broken row. Patterns are anchored at the start only."""
    return {
        "assembly": ~not_null(F.col("assembly").rlike(ASSEMBLY_PATTERN)),
        "species": F.col("species").isNull(),
        "st": ~not_null(F.col("st").rlike(ST_PATTERN)),
        "use_original_reads": ~not_null(F.col("use_original_reads").isin(*FLAG_VALUES)),
    }


def original_reads_rule() -> dict[str, Column]:
    """A row that asks for its original reads must name them."""
    asked = not_null(F.upper("use_original_reads") == "TRUE")
    return {"original reads": asked & is_blank("short_reads")}


def sheet_violations(df: DataFrame, sample: str, rules: dict[str, Column] | None = None) -> DataFrame:
    """(sample_name, rule), one row per broken rule."""
    rules = row_rules(df) if rules is None else rules
    broken = F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in rules.items()]))
    return df.select(F.col(sample).alias("sample_name"), F.explode(broken).alias("rule"))


def validate_sheet(df: DataFrame) -> DataFrame:
    """The sheet itself, or ValueError: first for missing columns, then for rows without any input."""
    missing = missing_columns(df)
    if missing:
        raise ValueError(f"Input file is missing required columns: {', '.join(missing)}")
    bad = sheet_violations(df, "SAMPLE_NAME").select("sample_name").orderBy("sample_name").limit(1).collect()
    if bad:
        raise ValueError(f"Sample {bad[0][0]} does not have an assembly or read record.")
    return df


def check_original_reads(df: DataFrame) -> DataFrame:
    """The lower-case sheet itself, or ValueError for missing keys or a flagged row without reads."""
    missing = missing_keys(df)
    if missing:
        raise ValueError(f"Sample record is missing keys: {', '.join(missing)}")
    bad = sheet_violations(df, "sample_name", original_reads_rule()).orderBy("sample_name").limit(1).collect()
    if bad:
        raise ValueError(f"Sample {bad[0][0]} does not have a read record.")
    return df

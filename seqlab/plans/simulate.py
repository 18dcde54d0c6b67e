"""The dataset sheet: validated catalogue rows of one species with run parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlab.operators.selection import sample_with_topup
from seqlab.operators.sheet import with_run_params
from seqlab.operators.validate import check_original_reads, lower_case_columns, validate_sheet


def dataset_sheet(catalogue: DataFrame, species: str, n: int, seed: int = 42) -> DataFrame:
    """n samples of one species (drawn again when there are too few), with parameters and read file names."""
    rows = lower_case_columns(validate_sheet(catalogue)).where(F.col("species") == species)
    chosen = check_original_reads(sample_with_topup(rows, n, "sample_name", seed))
    # A copy made by the top-up gets its own name, so its files do not overwrite the first one's.
    name = F.when(F.col("replicate") == 0, F.col("sample_name")).otherwise(
        F.concat("sample_name", F.lit("_"), F.col("replicate").cast("string"))
    )
    named = with_run_params(chosen.withColumn("public_name", name), "public_name", seed)
    return named.drop("replicate").withColumns(
        {f"r{mate}": F.concat("public_name", F.lit(f"_R{mate}.fastq.gz")) for mate in (1, 2)}
    )


def split_by_reads(sheet: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that bring their own reads, and rows whose reads must be made."""
    own = F.coalesce(F.upper("use_original_reads") == "TRUE", F.lit(False))
    return sheet.where(own), sheet.where(~own)

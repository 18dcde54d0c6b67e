"""Sheet building: tidy catalogue rows, run parameters, public names, answer and blank layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlab.functions import basename, draw_hash, zfill
from seqlab.operators.positions import ordered_position, rank_by_bucket
from seqlab.operators.selection import drawn_parameter

# Run parameters of simulated reads, and of samples that keep their original reads.
RUN_PARAMETERS = {"read_length": 150, "platform": "HS25", "fragment_length": 200, "standard_deviation": 10}
UNKNOWN_PARAMETERS = {"read_length": -1, "platform": "Unknown", "fragment_length": -1, "standard_deviation": -1}

# Columns of the written sheets.
ANSWER_COLUMNS = (
    "sample_name", "short_reads", "public_name", "assembly", "species", "st", "random_seed", "use_original_reads", "output_dir",
    "assembly_file", "r1", "r2", "coverage", "read_length", "platform", "fragment_length", "standard_deviation", "qc", "error", "notes", "read_count",
)
BLANK_COLUMNS = ("ID", "R1", "R2", "SPECIES", "QC", "ERROR", "ST", "AMR", "Notes")
BASIC_BLANKS = ("qc", "error", "st", "notes")
TYPING_BLANKS = ("st", "k_locus", "capsule_type", "wzi", "o_locus", "o_type", "bla_carb")
OUTBREAK_COLUMNS = ("Sample", "Cluster", "Host", "Location", "Collection Date", "Phenotype", "R1", "R2", "SPECIES")

# Typing result columns and their sheet names.
TYPING_PREFIX = "klebsiella_pneumo_complex__"
TYPING_COLUMNS = {
    "mlst__ST": "kleborate_st",
    "kaptive__K_locus": "k_locus",
    "kaptive__K_type": "capsule_type",
    "wzi__wzi": "wzi",
    "kaptive__O_locus": "o_locus",
    "kaptive__O_type": "o_type",
    "amr__Bla_Carb_acquired": "bla_carb",
}

# Error name and note text of the assembly exam, by error class; %s is the drawn parameter.
EXAM_ANSWERS = {
    "NORMAL": ("PASSED", "NONE", "None"),
    "TRUNCATED": ("FAILED", "TRUNCATED", "Truncated reads to %s bp"),
    "CONTAMINATED": ("FAILED", "CONTAMINATED", "Contamined sample with %s% using %r1 and %r2"),
    "POOR_QUALITY": ("FAILED", "DEGRADED", "Degraded sample so base quality is decremented %s points"),
    "LOW_COVERAGE": ("FAILED", "LOW_COVERAGE", "Low coverage sample with %s%"),
    "CORRUPTED": ("FAILED", "CORRUPTED", "Corrupted sample with random bytes"),
}

# The contamination verdict.
CONTAMINATION_LIMIT = 10


def tidy_sheet(df: DataFrame, sample: str, reads: str, assembly: str, species: str, st: str) -> DataFrame:
    """Catalogue columns to the sheet convention, with cleaned species and ST."""
    return df.select(
        F.col(sample).alias("SAMPLE_NAME"),
        F.col(reads).alias("SHORT_READS"),
        F.col(assembly).alias("ASSEMBLY"),
        F.replace(F.col(species), F.lit(" sensu stricto"), F.lit("")).alias("SPECIES"),
        F.replace(F.col(st), F.lit("~"), F.lit("")).alias("ST"),
        F.lit("Unknown").alias("AMR"),
        F.lit("FALSE").alias("USE_ORIGINAL_READS"),
    )


def with_run_params(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Attach run parameters; rows that keep their original reads get the "unknown" values."""
    original = F.coalesce(F.upper("use_original_reads") == "TRUE", F.lit(False))
    columns = {"coverage": F.when(original, F.lit(-1).cast("bigint")).otherwise(drawn_parameter("coverage", seed, key))}
    for name, value in RUN_PARAMETERS.items():
        columns[name] = F.when(original, F.lit(UNKNOWN_PARAMETERS[name])).otherwise(F.lit(value))
    columns["random_seed"] = F.when(original, F.lit(-1)).otherwise(F.lit(seed))
    columns.update(qc=F.lit("PASSED"), error=F.lit("NONE"), notes=F.lit("None"))
    return df.withColumns(columns)


def number_samples(df: DataFrame, order_col: str, out: str = "public_name") -> DataFrame:
    """Public names sample01, sample02, ... in the order of a unique column."""
    placed = ordered_position(df, order_col, "_place")
    return placed.withColumn(out, F.concat(F.lit("sample"), zfill("_place", 2))).drop("_place")


def digest_name(digest, suffix: str = "") -> Column:
    """Sample_ and the first eight hex digits of an md5."""
    return F.concat(F.lit("Sample_"), F.substring(digest, 1, 8), F.lit(suffix))


def content_digest(rows: DataFrame, sample: str, index: str, content: str) -> DataFrame:
    """(sample, digest): one md5 over all numbered pieces of each sample.

    The pieces are hashed where they are and their hashes added up in two halves, so neither the pieces nor their digests
    are gathered in one task, and equal pieces don't cancel out. It is not the md5 of a file.
    """
    piece = F.md5(F.concat(F.col(index).cast("string"), F.lit(":"), F.md5(F.col(content).cast("binary"))))
    halves = {f"_s{i}": F.sum(F.conv(F.substring(piece, 1 + 12 * i, 12), 16, 10).cast("decimal(38,0)")) for i in range(2)}
    folded = rows.groupBy(sample).agg(*[v.alias(k) for k, v in halves.items()], F.count(F.lit(1)).alias("_n"))
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in ("_s0", "_s1", "_n")])
    return folded.select(sample, F.md5(text.cast("binary")).alias("digest"))


def digest_names(df: DataFrame, digest: str, key: str, suffix: str = "", out: str = "public_name") -> DataFrame:
    """Digest names; items with equal names get _2, _3, ... in seeded order of the unique key. No digest, no name: NULL.

    Copies are numbered inside hash pieces of each name, so many copies of one file do not fill one task.
    """
    known, bare = df.where(F.col(digest).isNotNull()), df.where(F.col(digest).isNull()).drop(digest)
    named = known.withColumns({"_name": digest_name(F.col(digest), suffix), "_h": draw_hash(0, "copy", key)}).drop(digest)
    placed = rank_by_bucket(named, ["_name"], F.shiftright("_h", 20), [F.col("_h"), F.col(key)], "_copy")
    unique = F.when(F.col("_copy") == 1, F.col("_name")).otherwise(
        F.concat("_name", F.lit("_"), F.col("_copy").cast("string"))
    )
    return placed.withColumn(out, unique).drop("_name", "_h", "_copy").unionByName(bare.withColumn(out, F.lit(None).cast("string")))


def anonymise_contigs(df: DataFrame, sample: str, index: str, out: str = "contig_name") -> DataFrame:
    """Contig names <sample>_contig_0001, ... in file order; ``index`` is unique in its sample."""
    placed = rank_by_bucket(df, [sample], F.shiftright(F.col(index).cast("bigint"), 12), [F.col(index)], "_place")
    return placed.withColumn(out, F.concat(F.col(sample), F.lit("_contig_"), zfill("_place", 4))).drop("_place")


def blank_sheet(df: DataFrame, layout: str = "errors", public: bool = True) -> DataFrame:
    """The participant's sheet: identifying columns kept, every answer blanked."""
    if layout == "errors":
        kept = {"ID": "public_name", "R1": "r1", "R2": "r2", "SPECIES": "species"}
        return df.select(
            *[F.col(source).alias(name) for name, source in kept.items()],
            *[F.lit("Unknown").alias(c) for c in BLANK_COLUMNS[4:8]],
            F.lit("").alias("Notes"),
        )
    if layout == "outbreak":
        blanked = {"Sample": F.col("public_name"), "Cluster": F.lit(""), "R1": F.lit(""), "R2": F.lit("")}
        return df.withColumns(blanked).select(*OUTBREAK_COLUMNS)
    name = F.col("public_name") if public else F.col("sample_name")
    fasta = F.concat("public_name", F.lit(".fasta")) if public else basename("assembly_file")
    if layout == "basic":
        return df.select(
            name.alias("sample_name"),
            "species",
            basename("r1").alias("r1"),
            basename("r2").alias("r2"),
            *[F.lit("").alias(c) for c in BASIC_BLANKS],
            fasta.alias("fasta"),
        )
    if layout == "typing":
        return df.select(name.alias("sample"), *[F.lit("").alias(c) for c in TYPING_BLANKS], fasta.alias("fasta"))
    raise ValueError(f"Unknown sheet layout {layout}")


def exam_answer(label: Column, parameter: Column, r1: Column, r2: Column) -> dict[str, Column]:
    """qc, error and notes of the assembly exam, from the error class and its drawn parameter."""

    def chain(pick) -> Column:
        expr = None
        for name, answer in EXAM_ANSWERS.items():
            value = pick(answer)
            expr = F.when(label == name, value) if expr is None else expr.when(label == name, value)
        return expr

    def note(answer) -> Column:
        text = F.lit(answer[2])
        for mark, value in (("%s", parameter), ("%r1", basename(r1)), ("%r2", basename(r2))):
            if mark in answer[2]:
                text = F.replace(text, F.lit(mark), F.coalesce(value.cast("string"), F.lit("")))
        return text

    return {"qc": chain(lambda a: F.lit(a[0])), "error": chain(lambda a: F.lit(a[1])), "notes": chain(note)}


def answer_sheet(df: DataFrame, label: str = "label", parameter: str = "parameter") -> DataFrame:
    """The full answer row of every sample."""
    answered = df.withColumns(exam_answer(F.col(label), F.col(parameter), F.col("foreign_r1"), F.col("foreign_r2")))
    return answered.select(*ANSWER_COLUMNS)


def contamination_verdict(percent, label: str = "CONTAMINATION") -> dict[str, Column]:
    """FAILED from 10 % foreign reads on."""
    percent = F.col(percent) if isinstance(percent, str) else percent
    failed = percent >= CONTAMINATION_LIMIT
    return {
        "qc": F.when(failed, F.lit("FAILED")).otherwise(F.lit("PASSED")),
        "error": F.when(failed, F.lit(label)).otherwise(F.lit("NONE")),
    }


def typing_results(df: DataFrame, *keep: str) -> DataFrame:
    """Long typing columns to short sheet names."""
    return df.select(*keep, *[F.col(TYPING_PREFIX + long).alias(short) for long, short in TYPING_COLUMNS.items()])



"""Sheet, FASTQ and FASTA writers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from seqlab.functions import div, draw_uniform
from seqlab.session import land, landing_folder
from seqlab.sources.files import join_files, listing

CHUNK_PAIRS = 4_000_000
CONTIGS_SHIFT = 12


def write_sheet(df: DataFrame, path: str, columns: list[str] | None = None, order_by: str | None = None) -> None:
    """CSV with a header; column order as given, empty fields for NULL and empty text."""
    sheet = df.select(*columns) if columns else df
    if order_by:
        sheet = sheet.orderBy(order_by)
    sheet.write.mode("overwrite").csv(
        path, header=True, quote='"', escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def chunked(reads: DataFrame, chunk_pairs: int) -> DataFrame:
    """``reads`` with chunk, and chunks: how many the sample has. A chunk holds the pair ids of one range, of one origin.

    With an ``origin`` column, the chunks of contaminant reads come before those of host reads; nothing in a number tells which is
    which. Chunks are numbered 0, 1, 2, ... in each sample, so reading and writing again does not raise the numbers.
    """
    return numbered_chunks(reads, chunk_pairs)[0]


def numbered_chunks(reads: DataFrame, chunk_pairs: int) -> tuple[DataFrame, DataFrame]:
    """``chunked`` reads, and (sample_id, mate, chunk, chunks, own, foreign) of all that there are, landed: one narrow pass over the reads.

    own and foreign are numbers of reads, by ``origin``.
    """
    host = (F.col("origin") == "host").cast("int") if "origin" in reads.columns else F.lit(0)
    placed = reads.withColumns({"_part": host, "_range": div(F.col("pair_id"), F.lit(chunk_pairs))})
    ranges = placed.groupBy("sample_id", "mate", "_part", "_range").agg(F.count(F.lit(1)).alias("_reads"))
    number = F.dense_rank().over(Window.partitionBy("sample_id").orderBy("_part", "_range")) - 1
    numbered = ranges.withColumn("chunk", number).withColumn("chunks", F.max("chunk").over(Window.partitionBy("sample_id")) + 1)
    table = land(numbered, "chunks")
    once = table.select("sample_id", "_part", "_range", "chunk", "chunks").distinct()
    own = F.when((F.col("_part") == 1) | F.lit("origin" not in reads.columns), F.col("_reads")).otherwise(0)
    counted = table.select("sample_id", "mate", "chunk", "chunks", own.alias("own"), (F.col("_reads") - own).alias("foreign"))
    return placed.join(once, ["sample_id", "_part", "_range"]), counted


def fastq_record() -> Column:
    return F.concat_ws("\n", "header", "sequence", "plus", "quality").alias("value")


def write_fastq(reads: DataFrame, path: str, chunk_pairs: int = CHUNK_PAIRS, compression: str = "gzip") -> None:
    """Folders sample_id=/mate=/chunk= of FASTQ text, both mates in the same record order; for chunks see ``chunked``.

    A sample of any size is spread over many tasks and files.
    """
    folders = ["sample_id", "mate", "chunk"]
    records = chunked(reads, chunk_pairs).select(*folders, "pair_id", fastq_record())
    (
        records.repartition(*folders)
        .sortWithinPartitions(*folders, "pair_id")
        .select(*folders, "value")
        .write.mode("overwrite")
        .partitionBy(*folders)
        .text(path, compression=compression)
    )


def write_read_files(
    reads: DataFrame, path: str, corrupt: DataFrame | None = None, seed: int = 42, chunk_pairs: int = CHUNK_PAIRS, segmented: bool = False
) -> DataFrame:
    """One file <sample_id>_R<mate>.fastq.gz for each sample and mate; returns (target, path, length, position, own, foreign) of the files.

    own and foreign are the reads in a file, by ``origin``; their sum is compared with what the writing jobs observe. A sample of one chunk is written once, under its name, by the tasks that sort it. The chunks of a larger one are files of their
    own, written by many tasks: joined as the members of one file, or left as <sample_id>_R<mate>_001.fastq.gz, _002 and so on
    if ``segmented``, which no byte is copied for. Of the (sample_id, mate) in ``corrupt`` one byte of the file, or of the first
    segment, is overwritten.
    """
    placed, table = numbered_chunks(reads, chunk_pairs)
    if corrupt is not None:
        chosen = corrupt.select("sample_id", F.col("mate").cast("int").alias("mate"), F.lit(True).alias("corrupt")).distinct()
        placed, table = (x.join(chosen, ["sample_id", "mate"], "left") for x in (placed, table))
    else:
        placed, table = (x.withColumn("corrupt", F.lit(None).cast("boolean")) for x in (placed, table))
    target = F.concat("sample_id", F.lit("_R"), F.col("mate").cast("string"), F.lit(".fastq.gz"))
    part = F.concat("sample_id", F.lit("_R"), F.col("mate").cast("string"), F.lit("_"), F.lpad((F.col("chunk") + 1).cast("string"), 3, "0"), F.lit(".fastq.gz"))
    placed, table = (x.withColumns({"target": target, "part": part}) for x in (placed, table))
    records = placed.withColumns({"order": F.col("pair_id"), "value": fastq_record()})
    written, observed = write_files(records, table, path, seed, segmented)
    name = F.when(F.lit(segmented) & (F.col("chunks") > 1), F.col("part")).otherwise(F.col("target"))
    counts = table.groupBy(name.alias("target")).agg(F.sum("own").alias("own"), F.sum("foreign").alias("foreign"))
    planned = table.agg(F.coalesce(F.sum(F.col("own") + F.col("foreign")), F.lit(0))).first()[0]
    if observed != planned:
        raise RuntimeError(f"{planned} reads were to be written, and {observed} were.")
    return written.join(counts, "target")


def write_files(records: DataFrame, table: DataFrame, path: str, seed: int, segmented: bool) -> tuple[DataFrame, int]:
    """Write ``records`` (target, part, chunk, chunks, corrupt, order, value): targets of one chunk at once, of others the parts.

    ``table`` has a row (without order and value) for each part that there is. Parts are joined, unless ``segmented``. Returns
    (target, path, length, position) of the files, landed, and the number of records that the writing tasks were given.
    """
    staged = f"{landing_folder(records.sparkSession)}/parts-{uuid.uuid4().hex}"
    single = F.col("chunks") == 1
    hit = F.col("corrupt") & (single | (F.lit(segmented) & (F.col("chunk") == 0)))
    named = {"file": F.when(single, F.col("target")).otherwise(F.col("part")), "share": F.when(hit, draw_uniform(seed, "corrupt", "target"))}

    def write(chosen: DataFrame, folder: str) -> int:
        rows = chosen.withColumns(named).select("file", "order", "value", F.col("share").alias("corrupt_at"))
        ordered = rows.repartition("file").sortWithinPartitions("file", "order").select("file", "value", "corrupt_at")
        seen = Observation()
        # Observed where the files are written, not before the shuffle, whose tasks may run again.
        ordered.observe(seen, F.count(F.lit(1)).alias("records")).write.format("record_files").mode("append").save(folder)
        return seen.get["records"]

    files = land(table.withColumns(named).select("file", "target", "chunk", "chunks", "corrupt", "share").distinct(), "files")
    joined_later = not segmented and not files.where("chunks > 1").isEmpty()
    observed = write(records.where(single) if joined_later else records, path)
    whole = listed(files.where(single) if joined_later else files, path)
    position = F.floor(F.col("share") * F.col("length")).cast("bigint").alias("position")
    whole = whole.select(F.col("file").alias("target"), "path", "length", position)
    if not joined_later:
        return land(whole, "written"), observed
    observed += write(records.where(~single), staged)
    joined = join_files(listed(files.where(~single), staged).select("target", "chunk", "corrupt", "path", "length"), path, seed)
    return land(whole.unionByName(joined), "written"), observed


def listed(files: DataFrame, folder: str) -> DataFrame:
    """``files`` (file, ...) with the path and length of each below ``folder``; one that is not there is an error."""
    spark = files.sparkSession
    if files.isEmpty():
        return files.withColumns({"path": F.lit(None).cast("string"), "length": F.lit(None).cast("bigint")})
    there = listing(spark, folder).withColumn("name", F.element_at(F.split("path", "/"), -1)).groupBy("name").agg(F.max("path").alias("path"), F.max("length").alias("length"))
    found = files.join(there, F.col("file") == F.col("name"), "left").drop("name")
    return found.withColumn("path", F.coalesce("path", F.raise_error(F.concat(F.lit("Not written: "), "file"))))


def write_fasta(contigs: DataFrame, path: str, name: str = "contig_name", compression: str = "none") -> None:
    """Folders sample_id=/chunk= of FASTA text in contig order, under the given contig names."""
    records = contigs.select(
        "sample_id",
        F.shiftright(F.col("contig_index").cast("bigint"), CONTIGS_SHIFT).alias("chunk"),
        "contig_index",
        F.concat(F.lit(">"), F.col(name), F.lit("\n"), F.col("sequence")).alias("value"),
    )
    (
        records.repartition("sample_id", "chunk")
        .sortWithinPartitions("sample_id", "chunk", "contig_index")
        .select("sample_id", "chunk", "value")
        .write.mode("overwrite")
        .partitionBy("sample_id", "chunk")
        .text(path, compression=compression)
    )


def write_contig_files(contigs: DataFrame, path: str, name: str = "contig_name") -> DataFrame:
    """One file <sample_id>.fasta for each sample; returns (target, path, length, position) of the files.

    Contigs beyond the first 4096 of a sample are chunks of their own, joined to its file.
    """
    sample = Window.partitionBy("sample_id")
    placed = contigs.withColumn("_range", F.shiftright(F.col("contig_index").cast("bigint"), CONTIGS_SHIFT))
    number = (F.row_number().over(sample.orderBy("_range")) - 1).alias("chunk")
    ranges = land(placed.select("sample_id", "_range").distinct().select("*", number, F.count(F.lit(1)).over(sample).alias("chunks")), "chunks")
    made = {
        "target": F.concat("sample_id", F.lit(".fasta")),
        "part": F.concat("sample_id", F.lit(".part"), (F.col("chunk") + 1).cast("string"), F.lit(".fasta")),
        "corrupt": F.lit(None).cast("boolean"),
    }
    written = {"order": F.col("contig_index").cast("bigint"), "value": F.concat(F.lit(">"), F.col(name), F.lit("\n"), F.col("sequence"))}
    records = placed.join(ranges, ["sample_id", "_range"]).withColumns(made).withColumns(written)
    return write_files(records, ranges.withColumns(made), path, 42, False)[0]

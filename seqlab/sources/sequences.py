"""FASTQ and FASTA files as Spark data sources: ``spark.read.format("fastq").load(path)``.

A record is four lines and its number is its position in the file, so here a file is read by one task; small files
share a task. Files are read in blocks and handed over as Arrow batches, in constant memory. ``splits.read_fastq`` gives
the same rows with many tasks for a large file.
"""

from __future__ import annotations

import fnmatch
import gzip
import io
import os
import re
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from seqlab.session import land

BLOCK_CHARS = 8 << 20
PARTITION_BYTES = 128 << 20
CHUNK_SHIFT = 32
CONTIGS_SHIFT = 12
# The names of either format; part files of a text writer count for both, as they are in folders of one kind.
FASTQ_FILE = re.compile(r"\.(fastq|fq)(\.gz)?$|^part-.*\.txt(\.gz)?$", re.IGNORECASE)
FASTA_FILE = re.compile(r"\.(fasta|fna|fa)(\.gz)?$|^part-.*\.txt(\.gz)?$", re.IGNORECASE)
MATE_FILE = re.compile(r"^(?P<sample>.+?)[._]R?(?P<mate>[12])(_(?P<segment>\d{3,}))?$")
FASTQ_SCHEMA = pa.schema(
    [
        ("sample_id", pa.string()),
        ("pair_id", pa.int64()),
        ("mate", pa.int32()),
        ("header", pa.string()),
        ("sequence", pa.string()),
        ("plus", pa.string()),
        ("quality", pa.string()),
    ]
)
FASTA_SCHEMA = pa.schema(
    [("sample_id", pa.string()), ("contig_index", pa.int64()), ("contig_name", pa.string()), ("sequence", pa.string())]
)


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


def _filesystem(path: str):
    if "://" in path or path.startswith("file:"):
        scheme, _, rest = path.partition(":")
        return pafs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe="/:@[],=+&;!$'()*~")}")  # Spark lists paths as they are
    return pafs.LocalFileSystem(), os.path.abspath(path)


def list_files(path: str, names: re.Pattern) -> list[tuple[str, int]]:
    """(path, bytes) of a file, of the files of a glob, or of those in a folder (searched fully) with such names, sorted.

    A folder without any is an error.
    """
    fs, inner = _filesystem(path)
    scheme = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    if any(mark in inner for mark in "*?["):
        fixed = re.split(r"[*?\[]", inner, maxsplit=1)[0].rpartition("/")[0] or "/"
        infos = fs.get_file_info(pafs.FileSelector(fixed, recursive=True))
        found = [i for i in infos if i.is_file and fnmatch.fnmatchcase(i.path, inner)]
    else:
        info = fs.get_file_info(inner)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(path)
        if info.is_file:
            found = [info]
        else:
            infos = fs.get_file_info(pafs.FileSelector(inner, recursive=True))
            found = [i for i in infos if i.is_file and names.search(os.path.basename(i.path))]
            if not found:
                raise FileNotFoundError(f"No sequence files of this format in {path}")
    return sorted((scheme + i.path, i.size) for i in found if not os.path.basename(i.path).startswith(("_", ".")))


def open_text(path: str):
    fs, inner = _filesystem(path)
    raw = fs.open_input_stream(inner, compression=None)
    stream = gzip.GzipFile(fileobj=raw) if inner.lower().endswith(".gz") else raw
    return io.TextIOWrapper(io.BufferedReader(stream, 1 << 20), encoding="utf-8")


def name_parts(path: str, paired: bool = True) -> tuple[str, int, int]:
    """(sample, mate, chunk) from sample_id=/mate=/chunk= folders or from the file name.

    Only names of ``paired`` files may end in a mate number, and a segment number from 001 on; elsewhere a number is part of the name.
    """
    folders = dict(part.split("=", 1) for part in path.split("/")[:-1] if "=" in part)
    stem = (FASTQ_FILE if paired else FASTA_FILE).sub("", path.rsplit("/", 1)[-1])
    match = MATE_FILE.match(stem) if paired else None
    sample = unquote(folders["sample_id"]) if "sample_id" in folders else (match["sample"] if match else stem)
    mate = int(folders["mate"]) if "mate" in folders else (int(match["mate"]) if match else 1)
    segment = max(int(match["segment"]) - 1, 0) if match and match["segment"] else 0
    return sample, mate, int(folders.get("chunk", segment))


def checked_files(path: str, paired: bool) -> list[tuple[str, int]]:
    """(path, bytes) of the files below ``path``; two of one sample, mate and chunk are an error."""
    files, seen = list_files(path, FASTQ_FILE if paired else FASTA_FILE), {}
    for file, _ in files:
        key = name_parts(file, paired)
        if key in seen:
            raise ValueError(f"{seen[key]} and {file} are both files of sample {key[0]}, mate {key[1]}, chunk {key[2]}.")
        seen[key] = file
    return files


class SequenceReader(DataSourceReader):
    def __init__(self, options, schema: pa.Schema, parse, paired: bool):
        self.path = options.get("path")
        if not self.path:
            raise ValueError("A path is required.")
        self.bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.schema, self.parse, self.paired = schema, parse, paired

    def partitions(self):
        packs: list[list[str]] = []
        room = 0
        for path, size in checked_files(self.path, self.paired):
            if not packs or size > room:
                packs.append([])
                room = self.bytes
            packs[-1].append(path)
            room -= size
        return [Files(p) for p in packs] or [Files([])]

    def read(self, partition):
        for path in partition.paths:
            with open_text(path) as lines:
                for columns in self.parse(path, lines):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema
                    )


def fastq_blocks(path: str, lines, ended_early: list | None = None):
    """Column lists of whole records; the scan ends at the first empty header, and tells ``ended_early`` that it did."""
    sample, mate, chunk = name_parts(path)
    number, rest, ended = chunk << CHUNK_SHIFT, [], False
    while not ended:
        block = lines.readlines(BLOCK_CHARS)
        ended = not block
        rest.extend(line.strip() for line in block)
        if ended and len(rest) % 4:
            rest.extend([""] * (4 - len(rest) % 4))
        whole = len(rest) // 4 * 4
        headers = rest[0:whole:4]
        if "" in headers:
            whole, ended = headers.index("") * 4, True
            if ended_early is not None:
                ended_early.append(True)
        size = whole // 4
        if size:
            yield (
                [sample] * size,
                list(range(number, number + size)),
                [mate] * size,
                rest[0:whole:4],
                rest[1:whole:4],
                rest[2:whole:4],
                rest[3:whole:4],
            )
        number += size
        rest = rest[whole:]


def fasta_blocks(path: str, lines, ended_early: list | None = None):
    """Column lists of contigs with at least one base; sequence lines are joined."""
    sample, _, chunk = name_parts(path, paired=False)
    # A written chunk holds the indices from chunk * 4096 on; those of chunk 0 start with 1.
    names, contigs, number, held = [], [], max((chunk << CONTIGS_SHIFT) - 1, 0), 0
    name, parts = "", []

    def close():
        sequence = "".join(parts)
        if sequence:
            names.append(name)
            contigs.append(sequence)
        return len(sequence)

    def block():
        size = len(names)
        return [sample] * size, list(range(number + 1, number + size + 1)), list(names), list(contigs)

    for line in lines:
        if line.startswith(">"):
            held += close()
            name, parts = line[1:].strip(), []
            if held > BLOCK_CHARS:
                yield block()
                number, held = number + len(names), 0
                names.clear()
                contigs.clear()
        else:
            parts.append(line.strip())
    close()
    if names:
        yield block()


class FastqSource(DataSource):
    @classmethod
    def name(cls):
        return "fastq"

    def schema(self):
        return "sample_id string, pair_id bigint, mate int, header string, sequence string, plus string, quality string"

    def reader(self, schema):
        return SequenceReader(self.options, FASTQ_SCHEMA, fastq_blocks, True)


class FastaSource(DataSource):
    @classmethod
    def name(cls):
        return "fasta"

    def schema(self):
        return "sample_id string, contig_index bigint, contig_name string, sequence string"

    def reader(self, schema):
        return SequenceReader(self.options, FASTA_SCHEMA, fasta_blocks, False)


def register(spark: SparkSession) -> SparkSession:
    """Make the formats "fastq", "fasta" and "record_files" known to the session."""
    from seqlab.sources.record_files import RecordFiles

    for source in (FastqSource, FastaSource, RecordFiles):
        spark.dataSource.register(source)
    return spark


def complete_pairs(reads: DataFrame) -> DataFrame:
    """Drop records beyond the end of the shorter mate file of each sample.

    The file length per (sample, mate) is a small table, so the reads are filtered in place. A sample with one
    mate only keeps nothing; read single-end data without this step.
    """
    chunk = F.shiftright("pair_id", CHUNK_SHIFT).alias("_chunk")
    ends = reads.groupBy("sample_id", chunk, "mate").agg(F.max("pair_id").alias("_end"))
    shorter = (
        ends.groupBy("sample_id", "_chunk")
        .agg(F.min("_end").alias("_end"), F.count_distinct("mate").alias("_mates"))
        .where(F.col("_mates") == 2)
        .drop("_mates")
    )
    tagged = reads.withColumn("_chunk", F.shiftright("pair_id", CHUNK_SHIFT))
    return tagged.join(land(shorter, "ends"), ["sample_id", "_chunk"]).where(F.col("pair_id") <= F.col("_end")).select(*reads.columns)

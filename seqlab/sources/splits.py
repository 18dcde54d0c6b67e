"""Large FASTQ and FASTA files read by many tasks: ranges of bytes that start at a record.

Plain files are cut anywhere, and a range begins with the first record that starts in it. A gzip file can be entered at its
members only, so a range begins with the first whole member that starts in it, and there with the first record after a line
end. Three passes, each over ranges: find where records start, count the records of each range, and read them with their
numbers. Files of one range are read once and not counted.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqlab.session import land
from seqlab.sources.sequences import FASTA_SCHEMA, FASTQ_SCHEMA, PARTITION_BYTES, _filesystem, checked_files, fasta_blocks, fastq_blocks

#: Bytes that are looked at or unpacked at once, and the lines that show where a FASTQ record starts.
STEP, LINES = 1 << 18, 12
MEMBER = b"\x1f\x8b\x08"


def fastq_start(lines: list[bytes]) -> int | None:
    """The first of ``lines`` that starts a record, None if none does.

    A header starts with @ and the third line with +. A quality line may start with @ too, but then the third line from it is a
    sequence. The record after it has to look like one as well, if it is there.
    """
    looks = lambda i: lines[i].startswith(b"@") and (i + 2 >= len(lines) or lines[i + 2].startswith(b"+"))
    for i in range(min(4, len(lines) - 2)):
        if looks(i) and (i + 4 >= len(lines) or not lines[i + 4].strip() or looks(i + 4)):
            return i
    return None


def fasta_start(lines: list[bytes]) -> int | None:
    """The first of ``lines`` that names a contig, None if none does."""
    return next((i for i, line in enumerate(lines) if line.startswith(b">")), None)


@dataclass(frozen=True)
class Format:
    """How files of a format are found, where their records start, and how these are read. ``least`` lines show a start, if enough do."""

    paired: bool
    schema: pa.Schema
    types: str
    number: str
    blocks: Callable
    start: Callable[[list[bytes]], int | None]
    least: int | None


FASTQ = Format(
    True, FASTQ_SCHEMA, "sample_id string, pair_id bigint, mate int, header string, sequence string, plus string, quality string", "pair_id", fastq_blocks, fastq_start, LINES
)
FASTA = Format(False, FASTA_SCHEMA, "sample_id string, contig_index bigint, contig_name string, sequence string", "contig_index", fasta_blocks, fasta_start, None)


class Unpacked(io.RawIOBase):
    """A byte stream of pieces."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.rest = pieces, b""

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while not self.rest:
            self.rest = next(self.pieces, None)
            if self.rest is None:
                self.rest = b""
                return 0
        n = min(len(target), len(self.rest))
        target[:n], self.rest = self.rest[:n], self.rest[n:]
        return n


class Cut:
    """A file that is entered at a place: a number of bytes, or a member and the unpacked bytes to skip."""

    def __init__(self, path: str):
        fs, inner = _filesystem(path)
        self.file = fs.open_input_file(inner)
        self.size, self.gzip = self.file.size(), inner.lower().endswith(".gz")

    def raw(self, at: int, stop: int | None = None) -> Iterator[bytes]:
        stop = self.size if stop is None else min(stop, self.size)
        while at < stop and (piece := self.file.read_at(min(STEP, stop - at), at)):
            yield piece
            at += len(piece)

    def members(self, at: int, end: int | None = None, skip: int = 0) -> Iterator[bytes]:
        """What is unpacked from the member at ``at`` on, up to ``skip`` bytes from the start of the member at ``end``, or to the end."""
        left = None
        while at < self.size:
            if at == end:
                left = skip
            elif end is not None and left is None and at > end:
                raise ValueError(f"No member starts at byte {end}.")
            if not any(self.file.read_at(min(10, self.size - at), at)):
                return  # padding
            unpacker = zlib.decompressobj(31)
            for piece in self.raw(at):
                data = unpacker.decompress(piece)
                at += len(piece) - len(unpacker.unused_data)
                if data:
                    yield data if left is None else data[:left]
                if left is not None and (left := left - len(data)) <= 0:
                    return
                if unpacker.eof:
                    break
            else:
                raise EOFError("The file ends within a member.")

    def whole_member(self, at: int) -> bool:
        """Whether a member starts at a place, to its checksum."""
        if self.file.read_at(4, at)[3:] > b"\x1f":
            return False
        unpacker = zlib.decompressobj(31)
        try:
            for piece in self.raw(at):
                unpacker.decompress(piece)
                if unpacker.eof:
                    return True
        except zlib.error:
            pass
        return False

    def member_in(self, start: int, stop: int) -> int | None:
        """The first member that starts in a range."""
        at, held = start, b""
        for piece in self.raw(start, stop + len(MEMBER) - 1):
            held += piece
            found = held.find(MEMBER)
            while found >= 0:
                if at + found < stop and self.whole_member(at + found):
                    return at + found
                found = held.find(MEMBER, found + 1)
            keep = len(MEMBER) - 1
            at += max(len(held) - keep, 0)
            held = held[-keep:]
        return None

    def first_record(self, start: int, stop: int, kind: Format) -> tuple[int, int] | None:
        """The place where the first record that a range has starts: (byte, 0) or (member, unpacked bytes to skip)."""
        if start == 0:
            return 0, 0
        if not self.gzip:
            found = record_after_line_end(self.raw(start - 1), kind, stop - start + 1)
            return None if found is None else (start - 1 + found, 0)
        member = self.member_in(start, stop)
        if member is None:
            return None
        found = record_after_line_end(self.members(member), kind, None)
        return None if found is None else (member, found)

    def lines(self, place: tuple[int, int], end: tuple[int, int] | None) -> io.TextIOWrapper:
        """The lines from one place to another."""
        pieces = self.members(place[0], *(end or ())) if self.gzip else self.raw(place[0], end and end[0])
        stream = io.BufferedReader(Unpacked(pieces), STEP)
        skip = place[1]
        while skip > 0 and (gone := stream.read(min(skip, STEP))):
            skip -= len(gone)
        return io.TextIOWrapper(stream, encoding="utf-8")


def record_after_line_end(pieces: Iterator[bytes], kind: Format, stop: int | None) -> int | None:
    """The place in a stream of the first record that starts after a line end, and before ``stop``; None if there is none."""
    held, at, begun = b"", 0, False
    for piece in pieces:
        held += piece
        if not begun:
            end = held.find(b"\n")
            if end < 0:
                at, held = at + len(held), b""
                if stop is not None and at >= stop:
                    return None
                continue
            at, held, begun = at + end + 1, held[end + 1 :], True
        if stop is not None and at >= stop:
            return None
        lines = held.split(b"\n")
        if kind.least is None:
            found = kind.start(lines[:-1])
            if found is None:  # the last line may go on
                at, held = at + len(held) - len(lines[-1]), lines[-1]
                continue
        elif len(lines) <= kind.least:
            continue
        else:
            found = kind.start(lines[:-1])
        return placed(at, lines, found, stop)
    lines = held.split(b"\n")
    return placed(at, lines, kind.start([x for x in lines if x] if kind.least is None else lines), stop) if begun and held else None


def placed(at: int, lines: list[bytes], found: int | None, stop: int | None) -> int | None:
    if found is None:
        return None
    at += sum(len(x) + 1 for x in lines[:found])
    return None if stop is not None and at >= stop else at


def ranges_of(spark: SparkSession, path: str, kind: Format, range_bytes: int) -> DataFrame:
    """(path, start, stop): the ranges of bytes of all files below ``path``; an empty file has one."""
    files = spark.createDataFrame(checked_files(path, kind.paired), "path string, size bigint")
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("size") - 1, F.lit(0).cast("bigint")), F.lit(range_bytes).cast("bigint"))
    return files.select("path", F.explode(starts).alias("start")).withColumn("stop", F.col("start") + range_bytes)


def read_ranges(spark: SparkSession, path: str, kind: Format, range_bytes: int) -> DataFrame:
    total = sum(max(size, 1) for _, size in checked_files(path, kind.paired))
    tasks = max(-(-total // range_bytes), 1)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r | {"place": Cut(r["path"]).first_record(r["start"], r["stop"], kind)} for r in batch.to_pylist()]
            rows = [{"path": r["path"], "start": r["start"], "mark": r["place"][0], "skip": r["place"][1]} for r in rows if r["place"]]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("path", pa.string()), ("start", pa.int64()), ("mark", pa.int64()), ("skip", pa.int64())]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                n, ended = 0, []
                if r["end"] is not None:  # what follows the last range needs no number
                    lines = Cut(r["path"]).lines((r["mark"], r["skip"]), (r["end"], r["end_skip"]))
                    n = sum(len(columns[0]) for columns in kind.blocks(r["path"], lines, ended))
                out.append(r | {"records": n, "ended": bool(ended)})
            yield pa.RecordBatch.from_pylist(out, pa.schema([*batch.schema, ("records", pa.int64()), ("ended", pa.bool_())]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = kind.schema.names.index(kind.number)
        for r in (row for batch in batches for row in batch.to_pylist()):
            end = None if r["end"] is None else (r["end"], r["end_skip"])
            for columns in kind.blocks(r["path"], Cut(r["path"]).lines((r["mark"], r["skip"]), end)):
                columns = list(columns)
                columns[at] = [n + r["first"] for n in columns[at]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind.schema, strict=True)], schema=kind.schema)

    places = "path string, start bigint, mark bigint, skip bigint"
    located = land(ranges_of(spark, path, kind, range_bytes).repartition(tasks).mapInArrow(locate, places), "record_starts")
    order = Window.partitionBy("path").orderBy("start")
    bounded = located.withColumns({"end": F.lead("mark").over(order), "end_skip": F.lead("skip").over(order)})
    counted = land(bounded.repartition(tasks).mapInArrow(count, f"{places}, end bigint, end_skip bigint, records bigint, ended boolean"), "record_counts")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    first = {"first": F.coalesce(F.sum("records").over(before), F.lit(0)), "over": F.coalesce(F.max("ended").over(before), F.lit(False))}
    return counted.withColumns(first).where(~F.col("over")).repartition(tasks).mapInArrow(read, kind.types)


def read_fastq(spark: SparkSession, path: str, range_bytes: int = PARTITION_BYTES) -> DataFrame:
    """The reads of FASTQ files, as the format "fastq" gives them, with a task for every ``range_bytes`` of plain files and of gzip
    files of several members. A file of one member is one task's."""
    return read_ranges(spark, path, FASTQ, range_bytes)


def read_fasta(spark: SparkSession, path: str, range_bytes: int = PARTITION_BYTES) -> DataFrame:
    """The contigs of FASTA files, as the format "fasta" gives them; see ``read_fastq``."""
    return read_ranges(spark, path, FASTA, range_bytes)

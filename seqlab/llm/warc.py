"""WARC archives: written by tasks as compressed members, and read by a reader that goes on after damage."""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqlab.session import land, shared_folder

#: Payloads from this size on are written once; a repetition is a revisit record.
LEAST_REVISIT = 1000
#: Bytes of an archive that one task reads, that are read at once, and that are unpacked at once.
SPLIT, BLOCK, PIECE = 8 << 20, 1 << 20, 1 << 16
MEMBER, VERSION, LINE = b"\x1f\x8b\x08", b"WARC/1.", re.compile(rb"WARC/1\.\d\r\n")
CONTROL = re.compile(r"[\x00-\x1f\x7f]")
RECORD = "path string, start long, stop long, gap string, type string, id string, refers_to string, uri string, digest string, size long, payload binary"


def file_at(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and the path in it of a path or URI."""
    return pyarrow.fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (pyarrow.fs.LocalFileSystem(), path)


def record(kind: str, ident: str, uri: str, digest: str, size: int, payload: bytes | None, refers: str | None) -> bytes:
    """One record: WARC header, then an HTTP response; that of a revisit has the header alone, with the length of the payload."""
    uri = CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", uri)  # a line break would end the header line
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + (payload or b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{ident}>", f"WARC-Target-URI: {uri}", "Content-Type: application/http; msgtype=response"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}", f"Content-Length: {len(block)}"]
    if refers is not None:
        lines.insert(3, f"WARC-Refers-To: <{refers}>")
        lines.insert(4, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def compressed(data: bytes, level: int = 1) -> bytes:
    """A gzip member of its own."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def spoilt(data: bytes, gzip: bool) -> bytes:
    """A written record with one changed byte: in the middle of a gzip member, or at the end of the block of a plain record.

    A changed byte of a member may name another place where the same letters stand, so that the member stays sound (about one page
    in 22,000). The next byte is changed instead then, and so on; a byte of the checksum, close to the end, never does that.
    """
    at = len(data) // 2 if gzip else len(data) - 5
    while True:
        damaged = data[:at] + bytes([data[at] ^ 0x41]) + data[at + 1 :]
        if not gzip or not unpacks(damaged):
            return damaged
        at += 1


def unpacks(member: bytes) -> bool:
    """Whether a gzip member is whole."""
    unpacker = zlib.decompressobj(31)
    try:
        unpacker.decompress(member)
    except zlib.error:
        return False
    return unpacker.eof


def planned(pages: DataFrame, spoil: str = "false") -> DataFrame:
    """``pages`` (page_id, url, html) as records: page_id, url, payload, digest, size, first_id, leads, spoil.

    Of the rows with equal payloads of ``LEAST_REVISIT`` bytes or more, one with the largest page_id leads, the one of the smallest url;
    the others refer to it. The groups are counted without the payloads and joined back, so a payload that most pages have
    is no single task. A null html is empty; a null page_id comes after all others.
    """
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.select("page_id", "url", "payload", F.sha1("payload").alias("digest"), F.length("payload").cast("long").alias("size"))
    groups = rows.where(F.col("size") >= LEAST_REVISIT).groupBy("digest").agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    repeated = land(groups.where("copies > 1").select("digest", "first_id", F.lit(True).alias("repeated")), "repeated_payloads")
    joined = rows.join(repeated, "digest", "left")
    leading = F.col("repeated").isNotNull() & F.col("page_id").eqNullSafe(F.col("first_id"))
    place = F.row_number().over(Window.partitionBy("digest").orderBy("url"))
    heads = joined.where(leading).withColumn("leads", place == 1)  # one row for each repeated payload, unless ids repeat
    others = joined.where(~leading).withColumn("leads", F.col("repeated").isNull())
    made = heads.unionByName(others).select("page_id", "url", "payload", "digest", "size", "first_id", "leads")
    return made.withColumn("spoil", F.coalesce(F.expr(spoil), F.lit(False)))


def write_archives(pages: DataFrame, folder: str | None = None, gzip: bool = True, spoil: str = "false") -> DataFrame:
    """Write a record for every row of ``pages`` and return the manifest (path, bytes, records) of the archives.

    Where ``spoil``, a condition on the columns of ``planned``, holds, a copy of the record with one changed byte comes before it: a
    trial of the reader, which has to quarantine the copy and to find the record after it. The manifest does not count such copies.

    Each task writes an archive of its own name in ``folder`` (in the shared folder if it is not given). The manifest is landed
    by Spark's commit, so the file of a lost or repeated attempt is in no manifest and is never read. Empty pages, no archive.
    """
    folder = (folder or f"{shared_folder(pages.sparkSession)}/seqlab/warc-{uuid.uuid4().hex}").rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/{uuid.uuid4().hex}{'.warc.gz' if gzip else '.warc'}"
        system, at = file_at(path)
        out, written, records = None, 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    system.create_dir(posixpath.dirname(at), recursive=True)
                    out = system.open_output_stream(at, compression=None)
                leads = row["leads"]
                data = record(
                    "response" if leads else "revisit", page_name(row["page_id"]), row["url"], row["digest"], row["size"],
                    row["payload"] if leads else None, None if leads else page_name(row["first_id"]),
                )
                data = compressed(data) if gzip else data
                if row["spoil"]:
                    damaged = spoilt(data, gzip)
                    out.write(damaged)
                    written += len(damaged)
                out.write(data)
                written += len(data)
                records += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": path, "bytes": written, "records": records}])

    return land(planned(pages, spoil).mapInArrow(run, "path string, bytes long, records long"), "warc_manifest")


def page_name(page_id: int | None) -> str:
    """The record id of a page."""
    return f"urn:page:{'' if page_id is None else page_id}"


class Damage(Exception):
    """A record that fails a check."""


class Archive:
    """One archive, read at any place through a buffer."""

    def __init__(self, path: str):
        system, at = file_at(path)
        self.file = system.open_input_file(at)
        self.size = self.file.size()
        self.gzip = path.endswith(".gz")
        self.at, self.buffer = 0, b""

    def read(self, at: int, size: int) -> bytes:
        if not self.at <= at <= at + size <= self.at + len(self.buffer):
            self.at, self.buffer = at, self.file.read_at(min(max(size, BLOCK), max(self.size - at, 0)), at)
        return self.buffer[at - self.at : at - self.at + size]

    def data(self, at: int) -> tuple[bytes, int]:
        """What is unpacked of the member at a place, or the record there, and its end."""
        if self.gzip:
            unpacker, parts = zlib.decompressobj(31), []
            while not unpacker.eof:
                piece = self.read(at, PIECE)
                if not piece:
                    raise Damage("cut off")
                try:
                    parts.append(unpacker.decompress(piece))
                except zlib.error as error:
                    raise Damage("can't be unpacked") from error
                if len(parts) == 1 and not parts[0].startswith(VERSION[: len(parts[0])]):
                    raise Damage("no version line")
                at += len(piece)
            return b"".join(parts), at - len(unpacker.unused_data)
        head = b""
        while b"\r\n\r\n" not in head:
            piece = self.read(at + len(head), PIECE)
            if not piece or len(head) > BLOCK:
                raise Damage("cut off" if not piece else "no end of the header")
            head += piece
            if not head.startswith(VERSION[: len(head)]):
                raise Damage("no version line")
        size = head.index(b"\r\n\r\n") + 8 + length_of(head)
        data = self.read(at, size)
        if len(data) < size:
            raise Damage("cut off")
        return data, at + size

    def at_place(self, at: int) -> list[dict]:
        """The checked records at a place: of a member all, with a gap for each part of it that fails; raises ``Damage`` if none is sound.

        ``stop`` is the end of the member, or of the record.
        """
        data, stop = self.data(at)
        found, inner, first = [], 0, None
        while inner < len(data):
            try:
                one, inner = checked(data, inner)
                found.append(one)
            except Damage as damage:
                first = first or damage
                found.append({"gap": str(damage)})
                after = LINE.search(data, inner + 1) if self.gzip else None
                inner = after.start() if after else len(data)
        if all("gap" in f for f in found):
            raise first or Damage("empty")
        return [f | {"start": at, "stop": stop} for f in found]

    def next_place(self, at: int, stop: int) -> int | None:
        """The first place from ``at`` to before ``stop`` with a record that passes all checks: a member, or a version line."""
        mark = MEMBER if self.gzip else VERSION
        while at < stop:
            piece = self.read(at, min(BLOCK, stop - at + len(mark) - 1))
            found = piece.find(mark)
            if found < 0:
                at += max(len(piece) - len(mark) + 1, 1)
                continue
            try:
                self.at_place(at + found)
                return at + found
            except Damage:
                at += found + 1
        return None

    def records(self, start: int, stop: int) -> Iterator[dict]:
        """The records that start in a range, and the gaps after them: from the end of a good record to the start of the next."""
        at = start
        if start:
            first = self.next_place(start, min(stop, self.size))
            if first is None:
                return
            at = first
        while at < self.size:
            try:
                found = self.at_place(at)
            except Damage as damage:
                after = self.next_place(at + 1, self.size)
                end = self.size if after is None else after
                yield {"start": at, "stop": end, "gap": str(damage)}
                at = end
            else:
                if at >= stop:
                    return
                yield from found
                at = found[-1]["stop"]
                continue
            if at >= stop:
                return


def checked(data: bytes, at: int) -> tuple[dict, int]:
    """The record that starts at a place of unpacked data, and its end; raises ``Damage`` if a check fails.

    Field names may be in any case, and digests in hexadecimal or base 32. The length is that of the WARC header; a block digest
    that is right vouches for the payload, whose own digest may be of another form of it. Digests of unknown kinds are not checked.
    """
    if not LINE.match(data, at):
        raise Damage("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise Damage("no end of the header")
    head, size = data[at:end], length_of(data[at : end + 4])
    block, stop = data[end + 4 : end + 4 + size], end + 8 + size
    lines = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    fields = {name.strip().lower(): value.strip() for name, value in lines}
    if len(block) < size or data[stop - 4 : stop] != b"\r\n\r\n":
        raise Damage("wrong length")
    sound = same_digest(fields.get("warc-block-digest"), block)
    if sound is False:
        raise Damage("wrong block digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, told = fields.get("warc-type"), fields.get("warc-payload-digest")
    if kind == "response" and not sound and same_digest(told, payload) is False:
        raise Damage("wrong payload digest")
    length = len(payload)
    if kind == "revisit":  # it has the header of the payload alone
        try:
            length = length_of(http + b"\r\n\r\n")
        except Damage:
            pass
    named = lambda name: fields[name].strip("<>") if name in fields else None
    one = {"type": kind, "id": named("warc-record-id"), "refers_to": named("warc-refers-to"), "uri": named("warc-target-uri")}
    return one | {"digest": digest_of(told)[1], "size": length, "payload": payload}, stop


def digest_of(told: str | None) -> tuple[str, str]:
    """The kind of a digest and its value in lower-case hexadecimal, as it is if it is in neither form; nothing for none."""
    kind, _, value = (told or "").partition(":")
    kind = kind.lower()
    size = {"md5": 16, "sha1": 20, "sha256": 32, "sha512": 64}.get(kind)
    if size and len(value) != 2 * size:
        try:
            value = base64.b32decode(value.upper() + "=" * (-len(value) % 8)).hex()
        except ValueError:
            return "", value
    return (kind if size and len(value) == 2 * size else ""), value.lower() if size else value


def same_digest(told: str | None, data: bytes) -> bool | None:
    """Whether data has a digest; None if the digest is of no known kind."""
    kind, value = digest_of(told)
    return hashlib.new(kind, data).hexdigest() == value if kind else None


def length_of(head: bytes) -> int:
    """The Content-Length of a header."""
    for line in head.partition(b"\r\n\r\n")[0].split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return int(value)
    raise Damage("no length")


def read_archives(manifest: DataFrame, split: int = SPLIT, payloads: bool = True) -> DataFrame:
    """The records and gaps of the archives of ``manifest`` (path, bytes), one row each.

    A row with ``gap`` is a quarantined range of bytes, start to stop, and the check that failed; any other is a record. Archives are
    read in ranges of ``split`` bytes by as many tasks: a range starts with the first record that passes its checks in it, and logs
    the gaps that follow its records. An empty manifest gives an empty table.
    """
    ranges = manifest.where("bytes > 0").select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split).cast("long"))).alias("start"))
    names = [f.split()[0] for f in RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"start": pa.int64(), "stop": pa.int64(), "size": pa.int64(), "payload": pa.binary()}
        schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])
        for batch in batches:
            for row in batch.to_pylist():
                held, size = [], 0
                for found in Archive(row["path"]).records(row["start"], row["start"] + split):
                    payload = found.get("payload") if payloads else None
                    held.append({n: found.get(n) for n in names} | {"path": row["path"], "payload": payload})
                    size += len(payload or b"") + 500
                    if size > BLOCK:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema)

    return ranges.repartition(max(ranges.count(), 1)).mapInArrow(run, RECORD)


def archived_pages(pages: DataFrame, spoil: str = "false") -> DataFrame:
    """Every row of ``pages`` (page_id, url, html; other columns are ignored) as its record was read back from the archives.

    (page_id, payload_bytes, payload_digest, record_type, refers_to, salvaged). ``salvaged`` is true if the reader had to quarantine
    the bytes right before the record; see ``write_archives`` for ``spoil``. A null html is empty; equal payloads are written once,
    see ``planned``. An empty table gives an empty table. Raises if not as many records are read as were written.
    """
    manifest = write_archives(pages, spoil=spoil)
    read = read_archives(manifest, payloads=False).select("path", "start", "stop", "gap", "id", "size", "digest", "type", "refers_to")
    read = land(read, "warc_records")
    records = read.where("gap is null")
    written, found = manifest.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0], records.count()
    if found != written:
        raise RuntimeError(f"{written} records were written and {found} read back")
    gaps = read.where("gap is not null").select("path", F.col("stop").alias("start"), F.lit(True).alias("salvaged")).distinct()
    kind = pages.schema["page_id"].dataType
    page = lambda name: F.when(F.col(name) != "urn:page:", F.substring_index(name, ":", -1)).cast(kind)
    return records.join(gaps, ["path", "start"], "left").select(
        page("id").alias("page_id"), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), page("refers_to").alias("refers_to"), F.coalesce("salvaged", F.lit(False)).alias("salvaged"),
    )

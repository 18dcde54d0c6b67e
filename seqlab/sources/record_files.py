"""A data source that writes text files under given names: ``df.write.format("record_files").mode("append").save(folder)``.

Rows (file, value, corrupt_at) come sorted by file. A task writes each of its files once, under a hidden name beside the wanted one;
the commit of the job renames them, so a job that fails leaves no file of any wanted name, and its tasks take back
what they wrote. Files whose names end in .gz are written as members of bounded size, at which readers can split them.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from seqlab.sources.sequences import _filesystem

#: Text of a gzip member.
MEMBER_BYTES = 4 << 20


def changed(block: bytes, at: int) -> bytes:
    """A block with a zero, or 0xFF for a zero, at a place."""
    out = bytearray(block)
    out[at] = 0xFF if out[at] == 0 else 0
    return bytes(out)


def remove(path: str) -> None:
    fs, inner = _filesystem(path)
    try:
        fs.delete_file(inner)
    except FileNotFoundError:
        pass


class File:
    """One file that is being written under a hidden name."""

    def __init__(self, folder: str, name: str, member_bytes: int):
        head, _, tail = f"{folder}/{name}".rpartition("/")
        self.target, self.hidden = f"{head}/{tail}", f"{head}/.{tail}.{uuid.uuid4().hex}"
        self.fs, self.inner = _filesystem(self.hidden)
        self.fs.create_dir(self.inner.rpartition("/")[0], recursive=True)
        self.out, self.length = self.fs.open_output_stream(self.inner, compression=None), 0
        self.gzip, self.member_bytes, self.held, self.held_bytes = name.endswith(".gz"), member_bytes, [], 0

    def write(self, values: list[bytes]) -> None:
        for value in values:
            self.held.append(value)
            self.held_bytes += len(value) + 1
            if self.held_bytes >= self.member_bytes:
                self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        data = b"\n".join([*self.held, b""])
        if self.gzip:
            packer = zlib.compressobj(6, zlib.DEFLATED, 31)
            data = packer.compress(data) + packer.flush()
        self.out.write(data)
        self.length += len(data)
        self.held, self.held_bytes = [], 0

    def close(self, corrupt_at: float | None) -> None:
        """Finish the file; with ``corrupt_at`` (0 to 1) the byte at that share of its length is changed."""
        self.flush()
        self.out.close()
        if corrupt_at is None or not self.length:
            return
        clean, at, position = self.inner, 0, int(corrupt_at * self.length)
        self.hidden += "x"
        self.inner += "x"
        with self.fs.open_input_stream(clean, compression=None) as source, self.fs.open_output_stream(self.inner, compression=None) as out:
            while block := source.read(1 << 22):
                out.write(changed(block, position - at) if at <= position < at + len(block) else block)
                at += len(block)
        self.fs.delete_file(clean)


@dataclass
class Written(WriterCommitMessage):
    """The files of a task: (hidden path, wanted path)."""

    files: list[tuple[str, str]] = field(default_factory=list)


class RecordFilesWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.folder = options.get("path", "").rstrip("/")
        if not self.folder:
            raise ValueError("A path is required.")
        self.member_bytes = int(options.get("memberBytes", MEMBER_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        done, current, name, at = Written(), None, None, None
        try:
            for batch in iterator:
                names, values, shares = (batch.column(c) for c in ("file", "value", "corrupt_at"))
                start = 0
                for run in pc.run_end_encode(names).run_ends.to_pylist() if batch.num_rows else []:
                    wanted = names[start].as_py()
                    if wanted != name:
                        if current is not None:
                            current.close(at)
                            done.files.append((current.hidden, current.target))
                        current, name, at = File(self.folder, wanted, self.member_bytes), wanted, shares[start].as_py()
                    current.write([v.encode() for v in values.slice(start, run - start).to_pylist()])
                    start = run
            if current is not None:
                current.close(at)
                done.files.append((current.hidden, current.target))
            return done
        except BaseException:
            if current is not None:
                remove(current.hidden)
            self.abort([done])
            raise

    def commit(self, messages: list[Written | None]) -> None:
        for hidden, target in (pair for m in messages if m is not None for pair in m.files):
            fs, inner = _filesystem(hidden)
            fs.move(inner, _filesystem(target)[1])

    def abort(self, messages: list[Written | None]) -> None:
        for hidden, _ in (pair for m in messages if m is not None for pair in m.files):
            remove(hidden)


class RecordFiles(DataSource):
    @classmethod
    def name(cls):
        return "record_files"

    def schema(self):
        return "file string, value string, corrupt_at double"

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("Files of other names in the folder stay; write in the mode append.")
        return RecordFilesWriter(self.options)

"""State that a Python worker keeps between its tasks, and Arrow helpers shared by the operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame


def worker_state(key: str, build: Callable[[], Any]) -> Any:
    """The object kept under ``key`` in this Python process; built when it is asked for first.

    Functions of this package travel with the task by value, so a module-level cache would start empty in every task.
    """
    home = sys.modules.setdefault("seqlab_worker_state", types.ModuleType("seqlab_worker_state"))
    if key not in home.__dict__:
        home.__dict__[key] = build()
    return home.__dict__[key]


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null is empty."""
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def parts_of(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """A batch in parts of so many rows, so that few of its texts are Python strings at once."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def slices(texts: list[str], most_chars: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most_chars`` code points each (or one longer text)."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most_chars:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def append_columns(
    df: DataFrame, compute: Callable[[list[str]], dict[str, pa.Array]], added: str, keep: list[str], column: str = "text"
) -> DataFrame:
    """``keep`` columns of ``df`` and the columns that ``compute`` makes of the texts, one Arrow batch at a time.

    Added names win over columns of ``df`` of the same name.
    """
    names = [f.split()[0] for f in added.split(",")]
    kept = [c for c in keep if c not in names]
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept), added])
    source = df.select(*dict.fromkeys([*kept, column]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in parts_of(whole)):
            made = compute(texts_of(batch, column))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(made[n] for n in names)], names=[*kept, *names])

    return source.mapInArrow(run, schema)


def unused(name: str, columns: list[str]) -> str:
    """A column name that none of ``columns`` has, in any case of letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def keep_rows(df: DataFrame, accept: Callable[[list[str]], Any], column: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, whose text ``accept`` says true to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in parts_of(whole)):
            yield batch.filter(pa.array(accept(texts_of(batch, column)), pa.bool_()))

    return df.mapInArrow(run, df.schema)

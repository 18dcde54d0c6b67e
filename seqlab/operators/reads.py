"""Per-read damage: map-only column expressions over a table of reads.

Reads: sample_id, pair_id, mate, header, sequence, plus, quality. Every function keeps the other columns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqlab.functions import draw_hash, scale_hash, stream_draw

# Phred+33 quality characters, 0 is "!" and 93 is "~".
PHRED_OFFSET = 33
PHRED_MAX = 93
PHRED_LADDER = "".join(chr(PHRED_OFFSET + q) for q in range(PHRED_MAX + 1))


BLOCK_BASES = 1 << 20


def _col(value) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def truncated(text, n) -> Column:
    """First n characters; shorter text is unchanged."""
    return F.substring(_col(text), F.lit(1), _col(n).cast("int"))


@F.arrow_udf(T.StringType())
def _quality_letters(h: pa.Array, size: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:
    """Quality strings for a batch of reads, all bases of a block at once.

    The built-in form (``transform`` over the positions) evaluates each base in interpreted mode and is many times
    slower. Only four numbers per read go to Python, not the sequence.
    """
    columns = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in (h, size, low, high)]
    ends = np.cumsum(columns[1])
    total = int(ends[-1]) if len(ends) else 0
    letters = np.empty(total, np.uint8)
    first, done = 0, 0
    while done < total:
        last = max(first + 1, int(np.searchsorted(ends, done + BLOCK_BASES, side="right")))
        stop = int(ends[last - 1])
        letters[done:stop] = _block_letters(*[c[first:last] for c in columns])
        first, done = last, stop
    if total >= 1 << 31:
        raise ValueError("A batch has over 2**31 bases; lower spark.sql.execution.arrow.maxRecordsPerBatch.")
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(letters))


def _block_letters(h: np.ndarray, size: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    def spread(values: np.ndarray) -> np.ndarray:
        return np.repeat(values, size)

    i = np.arange(size.sum()) - spread(np.cumsum(size) - size)
    draw = stream_draw(spread(h), i)
    # The ramp is the floating-point product, truncated.
    drop = (i / spread(size) * spread(high - low)).astype(np.int64)
    q = spread(low) + ((draw * (spread(high - low) - drop + 1)) >> 32)
    return (q + PHRED_OFFSET).astype(np.uint8)


def degraded_quality(sequence, h: Column, min_q, max_q) -> Column:
    """A new quality string, one uniform draw per base; the upper bound falls from max_q towards min_q.

    Where min_q is NULL the result is an empty string and costs nothing.
    """
    wanted = _col(min_q).isNotNull()

    def number(value: Column) -> Column:
        return F.when(wanted, value.cast("bigint")).otherwise(F.lit(0).cast("bigint"))

    return _quality_letters(number(h), number(F.length(_col(sequence))), number(_col(min_q)), number(_col(max_q)))


def decremented_quality(quality, points) -> Column:
    """Every quality lowered by ``points``, not below 0. One pass of ``translate`` over the fixed alphabet."""
    points = _col(points).cast("int")
    lowered = F.concat(
        F.repeat(F.lit(PHRED_LADDER[0]), F.least(points, F.lit(PHRED_MAX + 1))),
        F.substring(F.lit(PHRED_LADDER), F.lit(1), F.greatest(F.lit(PHRED_MAX + 1) - points, F.lit(0))),
    )
    return F.call_function("translate", _col(quality), F.lit(PHRED_LADDER), lowered)


def overwritten(text, position: Column, marker: str) -> Column:
    """Text with the character at 1-based ``position`` replaced."""
    return F.overlay(_col(text), F.lit(marker), position.cast("int"), F.lit(len(marker)))


def truncate_reads(df: DataFrame, n=75, mates: tuple[int, ...] = (1, 2)) -> DataFrame:
    """Cut sequence and quality of the given mates to n bases (number or column)."""
    chosen = F.col("mate").isin(*mates)
    return df.withColumns(
        {c: F.when(chosen, truncated(c, n)).otherwise(F.col(c)) for c in ("sequence", "quality")}
    )


def read_key() -> list[Column]:
    return [F.col("sample_id"), F.col("pair_id"), F.col("mate")]


def degrade_quality(df: DataFrame, min_q: int = 5, max_q: int = 30, seed: int = 42) -> DataFrame:
    """Replace qualities by random ones that get worse towards the end of the read."""
    if not 0 <= min_q <= max_q <= PHRED_MAX:
        raise ValueError(f"Quality scores must be in range 0-{PHRED_MAX}.")
    h = draw_hash(seed, "quality", *read_key())
    return df.withColumn("quality", degraded_quality("sequence", h, min_q, max_q))


def decrement_quality(df: DataFrame, points=20) -> DataFrame:
    return df.withColumn("quality", decremented_quality("quality", points))


def corrupt_text(df: DataFrame, column: str, key: str, seed: int = 42, marker: str = "\x00") -> DataFrame:
    """Overwrite one character per row at a uniform position; empty text stays empty."""
    size = F.length(column)
    position = scale_hash(draw_hash(seed, "corrupt", key), 1, size)
    return df.withColumn(
        column, F.when(size > 0, overwritten(column, position, marker)).otherwise(F.col(column))
    )

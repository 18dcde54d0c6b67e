"""The stateless operators on a stream: reads that arrive as Parquet files are damaged as they come.

Nothing here keeps state between batches; for exact samples see ``sampling``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from seqlab.plans.damage import damage_reads


def damage_stream(reads: DataFrame, params: DataFrame, seed: int = 42) -> DataFrame:
    """Streaming reads joined with the static parameter table of the exam and changed; same rows as the batch job."""
    return damage_reads(reads, params, seed)


def land_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append all available rows to Parquet, once per input file even after a restart."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

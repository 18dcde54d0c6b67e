"""Whole-file work: digests, byte corruption, and joining the parts of a file. Files are read in blocks."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqlab.functions import draw_uniform
from seqlab.session import land
from seqlab.sources.sequences import _filesystem

BLOCK_BYTES = 4 << 20


def listing(spark: SparkSession, path) -> DataFrame:
    """(path, length); the content column is pruned, so no file is read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")


def file_digest(spark: SparkSession, path) -> DataFrame:
    """(path, length, md5) of whole files, digested block by block."""
    return listing(spark, path).mapInPandas(_digest_batches, "path string, length bigint, md5 string")


def _digest_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(md5=[_md5(p) for p in batch["path"]])


def _md5(path: str) -> str:
    fs, inner = _filesystem(path)
    digest = hashlib.md5()
    with fs.open_input_stream(inner, compression=None) as stream:
        while block := stream.read(BLOCK_BYTES):
            digest.update(block)
    return digest.hexdigest()


def corrupted_bytes(content: Column, position: Column, ensure_change: bool = False) -> Column:
    """Binary content with the byte at 1-based ``position`` set to zero.

    A zero byte stays zero; with ``ensure_change`` it becomes 0xFF.
    """
    zero = F.unhex(F.lit("00"))
    if ensure_change:
        old = F.substring(content, position.cast("int"), F.lit(1))
        zero = F.when(old == zero, F.unhex(F.lit("FF"))).otherwise(zero)
    return F.overlay(content, zero, position.cast("int"), F.lit(1))


def corrupt_files(spark: SparkSession, path: str, out: str, seed: int = 42, ensure_change: bool = False) -> DataFrame:
    """Copy every file below ``path`` to ``out`` with one byte overwritten by zero at a uniform position.

    Returns (path, copy, length, position), landed: the files are copied once, before the function returns. The path
    below ``path`` is kept and is the key of the draw, so files of equal names in different folders stay apart.
    """
    files = listing(spark, path).where(F.col("length") > 0)
    root = F.lit(_root(path) + "/")
    inner = F.expr("substring(path, instr(path, root) + length(root))")
    named = files.withColumn("root", root).withColumn("inner", F.when(F.contains("path", "root"), inner).otherwise(F.element_at(F.split("path", "/"), -1)))
    twice = named.groupBy("inner").count().where("count > 1").first()
    if twice:
        raise ValueError(f"Several files would be copied to {twice['inner']}.")
    position = F.floor(draw_uniform(seed, "corrupt", "inner") * F.col("length")).cast("bigint")
    plan = named.select("path", F.concat(F.lit(out.rstrip("/") + "/"), "inner").alias("copy"), "length", position.alias("position"))

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                _write_joined([row.path], row.copy, int(row.position), ensure_change)
            yield batch

    return land(plan.mapInPandas(copy, "path string, copy string, length bigint, position bigint"), "copies")


def _root(path: str) -> str:
    """The inner path of a folder, without a scheme."""
    fs, inner = _filesystem(path)
    return inner.rstrip("/")


def join_files(parts: DataFrame, folder: str, seed: int = 42) -> DataFrame:
    """Join the ``parts`` (path, length, chunk, target, corrupt) of every target, in the order of chunks, below ``folder``.

    Where ``corrupt`` is true, one byte at a uniform position is changed. Returns (target, path, length, position), landed:
    the files are written once. A file is written under another name and then renamed, so a repeated task leaves one.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col("chunk").cast("bigint").alias("chunk"), "path")))
    whole = parts.groupBy("target").agg(ordered.alias("parts"), F.sum("length").alias("length"), F.bool_or("corrupt").alias("corrupt"))
    position = F.when(F.col("corrupt"), F.floor(draw_uniform(seed, "corrupt", "target") * F.col("length")).cast("bigint"))
    plan = whole.select("target", F.concat(F.lit(folder.rstrip("/") + "/"), "target").alias("path"), "length", position.alias("position"), F.col("parts.path").alias("parts"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                _write_joined(list(row.parts), row.path, -1 if pd.isna(row.position) else int(row.position), True)
            yield batch.drop(columns="parts")

    spread = plan.repartition(int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "target")
    return land(spread.mapInPandas(write, "target string, path string, length bigint, position bigint"), "joined")


def _write_joined(sources: list[str], target: str, position: int, ensure_change: bool) -> None:
    """Write the bytes of all sources to the target; the byte at ``position`` becomes zero, a zero 0xFF if a change is wanted."""
    target_fs, inner = _filesystem(target)
    folder, _, name = inner.rpartition("/")
    target_fs.create_dir(folder, recursive=True)
    unfinished, at = f"{folder}/.{name}.{uuid.uuid4().hex}", 0
    with target_fs.open_output_stream(unfinished, compression=None) as out:
        for source in sources:
            fs, path = _filesystem(source)
            with fs.open_input_stream(path, compression=None) as stream:
                while block := stream.read(BLOCK_BYTES):
                    if at <= position < at + len(block):
                        changed = bytearray(block)
                        i = position - at
                        changed[i] = 0xFF if ensure_change and changed[i] == 0 else 0
                        block = bytes(changed)
                    out.write(block)
                    at += len(block)
    target_fs.move(unfinished, inner)

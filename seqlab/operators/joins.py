"""Joins of sheets, names, reads and reports. Join strategies are left to the optimizer."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlab.functions import is_blank


def contaminant_pool(candidates: DataFrame, sheet: DataFrame, species: str = "species", assembly: str = "assembly") -> DataFrame:
    """Candidates with an assembly whose species does not occur in the sheet."""
    return candidates.where(~is_blank(assembly)).join(sheet.select(species).distinct(), species, "left_anti")


def strain_candidates(df: DataFrame, main: DataFrame, species: str = "species", st: str = "st") -> DataFrame:
    """Rows of the main sample's species with another ST; ``main`` is one row."""
    one = main.select(F.col(species).alias("_species"), F.col(st).alias("_st"))
    joined = df.join(one, (df[species] == one["_species"]) & (df[st] != one["_st"]))
    return joined.select(*df.columns)


def apply_names(df: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Attach public names; a key without a name gets NULL (see ``unnamed``)."""
    return df.join(names, key, "left")


def unnamed(df: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no name; an exam is not written while there are any."""
    return df.join(names, key, "left_anti")


def prefix_lookup(prefixes: DataFrame, paths: DataFrame, prefix: str, path: str) -> DataFrame:
    """For each prefix the first path (in text order) that starts with it, and how many do. Null paths count for none.

    Prefixes and paths are range-partitioned and sorted together, a row each, and every partition is passed once: what a prefix
    covers follows it. Where a prefix covers rows of later partitions, it is a start of their first path, so each
    partition also tells how many of its paths share how much of its first one. Equal paths may be in several partitions.
    """
    wanted = prefixes.select(F.col(prefix).alias("text")).where(~is_blank("text")).distinct()
    # One of many equal paths is told from the others by the row, so that they can be dealt out.
    rows = paths.where(F.col(path).isNotNull()).select(F.col(path).alias("text"), F.lit(1).alias("kind"), F.monotonically_increasing_id().alias("row"))
    both = wanted.select("text", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("row")).union(rows)
    ordered = both.repartitionByRange("text", "kind", "row").sortWithinPartitions("text", "kind", "row").select("text", "kind")
    told = ordered.mapInArrow(covered, "prefix string, first_path string, n_paths bigint")
    summed = told.groupBy("prefix").agg(F.min("first_path").alias("first_path"), F.sum("n_paths").alias("n_paths"))
    # Starts of first paths that nobody asked for have no row of their own.
    return summed.where(F.col("n_paths") >= OPENED).select(
        "prefix", "first_path", (F.col("n_paths") % OPENED).alias("n_paths")
    )


#: Added once to the number of paths of a prefix that was asked for, by the partition that has its row.
OPENED = 1 << 50


def covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(prefix, first_path, n_paths) of the prefixes in a sorted partition, and of all starts of its first path.

    ``OPENED`` marks the prefixes that have a row here.
    """
    # Open prefixes: text, first path, number of paths. Of the first path the number of paths that share so many letters.
    way: list[list] = []
    done: list[tuple] = []
    first, opened, shared = None, set(), Counter()
    least = 0

    def close() -> None:
        text, start, n = way.pop()
        done.append((text, start, n + OPENED))
        if way:
            way[-1][2] += n

    for batch in batches:
        for text, kind in zip(batch.column("text").to_pylist(), batch.column("kind").to_pylist(), strict=True):
            while way and not text.startswith(way[-1][0]):
                close()
            if not kind:
                way.append([text, None, 0])
                continue
            if first is None:
                first, least, opened = text, len(text), {x[0] for x in way}
            for one in reversed(way):
                if one[1] is not None:
                    break
                one[1] = text
            if way:
                way[-1][2] += 1
            if least:
                if not text.startswith(first[:least]):
                    least = len(commonprefix([first[:least], text]))
                shared[least] += 1
        yield told(done)
        done.clear()
    while way:
        close()
    n = 0
    for size in range(len(first or ""), 0, -1):
        n += shared[size]
        if n and first[:size] not in opened:
            done.append((first[:size], first, n))
    yield told(done)


def told(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
    types = (pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["prefix", "first_path", "n_paths"])


def cluster_reads(
    reads: DataFrame, name: str, buckets: int, sample: str = "sample_id", pair: str = "pair_id", path: str | None = None
) -> DataFrame:
    """Write reads as the table ``name``, in buckets by (sample, pair) and sorted in them, and return the table.

    The files are in the warehouse, or in ``path``.

    Both mates of a pair are in one bucket, so ``mate_pairs`` of the table, and every grouping or join of two such tables by these
    columns, needs no exchange. The pair is a part of the key: a sample with a third of all reads is in all buckets.
    """
    placed = reads.repartition(buckets, sample, pair)  # as the buckets are, so that a task writes one file
    writer = placed.write.bucketBy(buckets, sample, pair).sortBy(sample, pair).mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return reads.sparkSession.table(name)


def mate_pairs(reads: DataFrame, sample: str, pair: str, mate: str, columns: list[str], mates: tuple[int, int] = (1, 2)) -> DataFrame:
    """One row per complete pair, columns suffixed _1 and _2; one shuffle, no self-join. None of a table of ``cluster_reads``."""
    picks = [
        F.max(F.when(F.col(mate) == value, F.col(c))).alias(f"{c}_{side}")
        for side, value in ((1, mates[0]), (2, mates[1]))
        for c in columns
    ]
    present = [F.max((F.col(mate) == value).cast("int")).alias(f"_has{side}") for side, value in ((1, mates[0]), (2, mates[1]))]
    wide = reads.groupBy(sample, pair).agg(*picks, *present)
    return wide.where((F.col("_has1") == 1) & (F.col("_has2") == 1)).drop("_has1", "_has2")


def enrich_sheet(sheet: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Left join; where both sides have a column, the value of ``stats`` wins for matched rows."""
    clash = [c for c in stats.columns if c != key and c in sheet.columns]
    right = stats.withColumn("_matched", F.lit(True))
    for c in clash:
        right = right.withColumnRenamed(c, f"_new_{c}")
    joined = sheet.join(right, key, "left")
    for c in clash:
        joined = joined.withColumn(c, F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)))
    added = [c for c in stats.columns if c not in sheet.columns]
    return joined.select(*sheet.columns, *added)


def have_table(items: DataFrame, tables: DataFrame, key: str) -> DataFrame:
    """Items that have a table of the same stem."""
    return items.join(tables.select(key), key, "left_semi")

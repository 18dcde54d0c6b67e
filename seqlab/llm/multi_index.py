"""Nearest neighbours by multi-index hashing: learned binary codes, looked up by their substrings within a radius."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqlab.session import land

#: Bits of a code and the substrings that it is indexed by.
BITS, PARTS = 64, 4
#: The bounded sample that the rotation and the radius are learned from, and the share of neighbours that the radius is to reach.
SAMPLE, REACH, TURNS = 4096, 0.97, 20
#: Rows and queries of a block; a task searches one block of queries in the index of one block of rows.
ROWS, QUERIES = 8192, 4096
#: The bits of a substring that may choose the cell of the index.
PART_BITS = BITS // PARTS
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
KEYS = ["part", "cell", "block", "query_block"]


@dataclass(frozen=True)
class Codes:
    """Directions whose signs are the bits, the length that all vectors are filled up to, and the radius to search."""

    directions: np.ndarray
    norm: float
    radius: int

    def lifted(self, vectors: np.ndarray, queries: bool) -> np.ndarray:
        """One more coordinate makes all rows equally long, and 0 in queries: the largest inner product has the least angle."""
        rest = np.zeros(len(vectors)) if queries else np.sqrt(np.maximum(self.norm**2 - (vectors**2).sum(1), 0))
        return np.column_stack([vectors, rest])

    def encode(self, vectors: np.ndarray, queries: bool = False) -> np.ndarray:
        """The code of each vector."""
        bits = self.lifted(vectors, queries) @ self.directions > 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]


def learn(vectors: np.ndarray, norm: float, k: int, rows: int, bits: int = BITS, reach: float = REACH) -> Codes:
    """Codes for ``rows`` vectors like the sample ``vectors``.

    The principal directions are rotated so that the signs lose least, by turns of signs and best rotation; with fewer
    directions than bits, several rotations are learned. The radius is what ``reach`` of the neighbours in the sample need,
    as many of them as the ``k`` nearest of all rows would be in a sample of this size.
    """
    blank = Codes(np.empty((0, 0)), norm, bits)
    data = blank.lifted(vectors, False)
    kept = np.linalg.svd(data, full_matrices=False)[2][:bits].T
    projected = data @ kept
    rng, parts = np.random.default_rng(5), []
    while sum(p.shape[1] for p in parts) < bits:
        turn = np.linalg.qr(rng.normal(size=(kept.shape[1], kept.shape[1])))[0]
        for _ in range(TURNS):
            left, _, right = np.linalg.svd(projected.T @ np.sign(projected @ turn))
            turn = left @ right
        parts.append(kept @ turn)
    codes = Codes(np.column_stack(parts)[:, :bits], norm, bits)
    asked = vectors[:512]
    scores = asked @ vectors.T
    np.fill_diagonal(scores, -np.inf)
    near = min(max(1, round(k * len(vectors) / max(rows, 1))), max(len(vectors) - 1, 1))
    best = np.argpartition(-scores, near - 1, axis=1)[:, :near]
    far = np.bitwise_count(codes.encode(asked, True)[:, None] ^ codes.encode(vectors)[best])
    return Codes(codes.directions, norm, int(np.quantile(far, reach, method="higher")))


class Index:
    """The rows of a block by the values of the substrings ``parts`` of their codes."""

    def __init__(self, codes: np.ndarray, parts: range = range(PARTS)):
        self.codes, self.parts, self.tables = codes, parts, []
        for p in parts:
            part = substrings(codes)[:, p]
            order = np.argsort(part, kind="stable")
            values, first = np.unique(part[order], return_index=True)
            self.tables.append((values, order, np.append(first, len(order))))

    def within(self, code: np.uint64, radius: int) -> np.ndarray:
        """All rows whose code differs in ``radius`` bits or fewer, and that no substring before the first of ``parts`` gives.

        A code that near differs in at most a share of the bits in one of all substrings, so the buckets that near in the
        substrings of this index are probed, and what they hold is verified.
        """
        share = radius // PARTS
        found = np.zeros(len(self.codes), bool)
        asked = substrings(np.array([code], np.uint64))[0]
        for p, (values, order, first) in zip(self.parts, self.tables, strict=True):
            buckets = np.bitwise_count(values ^ asked[p]) <= share
            found[order[np.repeat(buckets, np.diff(first))]] = True
        rows = np.flatnonzero(found)
        rows = rows[np.bitwise_count(self.codes[rows] ^ code) <= radius]
        earlier = np.bitwise_count(substrings(self.codes[rows])[:, : self.parts.start] ^ asked[: self.parts.start]) <= share
        return rows[~earlier.any(1)]


def substrings(codes: np.ndarray) -> np.ndarray:
    """The substrings of each code, the lowest bits first."""
    return codes.view(f"<u{8 // PARTS}").reshape(len(codes), PARTS)


def nearest(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, codes: Codes, k: int, parts: range | None = range(PARTS)
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the ``k`` best rows of each query in one block: of those in the radius by the substrings ``parts``, or
    of all rows if that is None. Rows with the query's id are left out."""
    index, out = parts is not None and Index(codes.encode(vectors), parts), []
    asked = codes.encode(queries, True)
    for i, query in enumerate(queries):
        rows = index.within(asked[i], codes.radius) if index else np.arange(len(ids))
        rows = rows[ids[rows] != query_ids[i]]
        scores = (vectors[rows] * query).sum(1)
        if len(rows) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            rows, scores = rows[scores >= least], scores[scores >= least]
        best = np.lexsort((ids[rows], -scores))[:k]
        out.append((np.full(len(best), i), rows[best], scores[best]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, int), np.empty(0, int), np.empty(0))


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite numbers and one of them not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def cell_bits(rows: int, queries: int, radius: int, block: int, query_block: int) -> int:
    """How many bits of a substring choose a cell, so that the fewest rows and queries are moved; 0 is one cell for all.

    With cells, each row is in one cell for each substring, and a query visits those near enough to its own. If the radius is so
    large that it would visit most of them, one cell, in which all substrings are looked up, is less work.
    """

    def moved(bits: int) -> float:
        tables = PARTS if bits else 1
        visits = sum(math.comb(bits, i) for i in range(min(radius // PARTS, bits) + 1))
        in_cell, asked = rows / 2**bits, queries * visits / 2**bits
        return tables * (rows * max(1, asked / query_block) + queries * visits * max(1, in_cell / block))

    return min(range(min(PART_BITS, max(0, math.ceil(math.log2(max(rows, 1) / block)))) + 1), key=moved)


def with_codes(vectors: DataFrame, sent, queries: bool) -> DataFrame:
    """``vectors`` (vec_id, embedding) and the code of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = Codes(*sent.value).encode(matrix(batch.column("embedding"), batch.num_rows), queries)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made.view(np.int64))], names=[*batch.schema.names, "code"])

    return vectors.mapInArrow(run, f"vec_id long, embedding {vectors.schema['embedding'].dataType.simpleString()}, code long")


def matrix(column: pa.Array, rows: int) -> np.ndarray:
    return np.array(column.flatten(), np.float64).reshape(rows, -1)


def in_cells(coded: DataFrame, bits: int, near: int | None) -> DataFrame:
    """A row for each (part, cell) that a code is in, or that is at most ``near`` bits away; without bits, one for each code."""
    if not bits:
        return coded.select("vec_id", "embedding", F.lit(0).alias("part"), F.lit(0).alias("cell"))
    parts = F.explode(F.array(*(F.struct(F.lit(p).alias("part"), cell_of(p, bits).alias("cell")) for p in range(PARTS)))).alias("at")
    masks = [0] if near is None else [m for m in range(1 << bits) if m.bit_count() <= near]
    placed = coded.select("vec_id", "embedding", parts)
    return placed.select("vec_id", "embedding", "at.part", F.explode(F.transform(F.array(*map(F.lit, masks)), lambda m: F.col("at.cell").bitwiseXOR(m))).alias("cell"))


def cell_of(part: int, bits: int) -> Column:
    """The first ``bits`` bits of a substring of the code."""
    return F.shiftrightunsigned("code", (part + 1) * PART_BITS - bits).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def dealt(rows: DataFrame, asked: DataFrame, block: int, query_block: int, sizes: tuple[int, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides with the ``KEYS`` of the groups that search: a cell with many rows or visits is split into blocks of either.

    ``sizes`` are those of both sides if all is one cell. Keys are int on both sides: groups of different types would be hashed to
    different partitions and never meet.
    """
    if sizes:
        blocks, query_blocks = (F.lit(max(-(-n // most), 1)) for n, most in zip(sizes, (block, query_block), strict=True))
        rows, asked = (x.withColumns({"blocks": blocks, "query_blocks": query_blocks}) for x in (rows, asked))
    else:
        n = rows.groupBy("part", "cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
        m = asked.groupBy("part", "cell").agg(F.ceil(F.count(F.lit(1)) / query_block).cast("int").alias("query_blocks"))
        cells = land(n.join(m, ["part", "cell"]), "cells")
        rows, asked = (x.join(cells, ["part", "cell"]) for x in (rows, asked))
    own = lambda of: F.pmod(F.xxhash64("vec_id"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), (F.col(of) - 1).cast("int")))
    left = rows.select("vec_id", "embedding", "part", "cell", own("blocks").alias("block"), every("query_blocks").alias("query_block"))
    right = asked.select("vec_id", "embedding", "part", "cell", every("blocks").alias("block"), own("query_blocks").alias("query_block"))
    return left, right


def best_found(left: DataFrame, right: DataFrame, sent, k: int, bits: int, exact: bool) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of all groups; a task gives each query ``k`` at most."""

    def run(key: tuple, held: pa.Table, sought: pa.Table) -> pa.Table:
        if not held.num_rows or not sought.num_rows:
            return FOUND.empty_table()
        part = key[0].as_py()
        parts = None if exact else range(part, part + 1) if bits else range(PARTS)
        ids, query_ids = held["vec_id"].to_numpy(), sought["vec_id"].to_numpy()
        vectors, asks = (matrix(x["embedding"].combine_chunks(), x.num_rows) for x in (held, sought))
        of, row, score = nearest(ids, vectors, query_ids, asks, Codes(*sent.value), k, parts)
        return pa.Table.from_arrays([pa.array(query_ids[of]), pa.array(ids[row]), pa.array(score)], schema=FOUND)

    found = left.groupBy(*KEYS).cogroup(right.groupBy(*KEYS)).applyInArrow(run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(rows: DataFrame, queries: DataFrame, k: int = 20, block: int = ROWS, query_block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): for each of ``queries`` the ``k`` rows with the largest inner products that are found.

    Both have vec_id and embedding. If the radius allows, the index is dealt into cells by the first bits of each substring, and a
    query visits the cells within its share of bits; else rows and queries are dealt into blocks. No task holds more than a block
    of rows and one of queries. Queries that find fewer than ``k`` rows in the radius are compared with all rows. Products are
    of doubles; ties go to the smaller vec_id. A row is no neighbour of a query with its id; of queries that repeat an id the
    least vector counts. Vectors that are null, zero, of a length other than the most common, or hold null or non-finite
    components, and null ids take no part. The rotation is learned from ``SAMPLE`` rows, those of the smallest hash of vec_id;
    every row is indexed.
    """
    spark = rows.sparkSession
    good = rows.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long"), "embedding")
    size = good.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    good = good.where(F.size("embedding") == size["size"])
    asked = queries.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull() & (F.size("embedding") == size["size"]))
    asked = land(asked.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("embedding").alias("embedding")), "queries")
    length = F.sqrt(F.aggregate(F.transform("embedding", lambda x: x.cast("double")), F.lit(0.0), lambda total, x: total + x * x))
    norm = good.agg(F.max(length)).first()[0]
    sample = good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()["embedding"].to_pylist()
    codes = learn(np.array(sample, np.float64), norm, k, size["count"])
    sent = spark.sparkContext.broadcast((codes.directions, codes.norm, codes.radius))
    n_rows, n_asked = size["count"], asked.count()
    bits = cell_bits(n_rows, n_asked, codes.radius, block, query_block)
    coded, asks = (with_codes(x, sent, q) if bits else x for x, q in ((good, False), (asked, True)))
    sides = dealt(in_cells(coded, bits, None), in_cells(asks, bits, codes.radius // PARTS), block, query_block, None if bits else (n_rows, n_asked))
    near = land(best_found(*sides, sent, k, bits, exact=False), "near")
    enough = near.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = land(asked.join(enough, "vec_id", "left_anti"), "short")
    if short.isEmpty():
        return near
    rest = best_found(*dealt(in_cells(good, 0, None), in_cells(short, 0, None), block, query_block, (n_rows, short.count())), sent, k, 0, exact=True)
    return near.join(enough.select(F.col("vec_id").alias("query_id")), "query_id", "left_semi").select(*rest.columns).union(rest)

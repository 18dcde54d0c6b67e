"""Packing of token sequences: exact complements first, then best fit, planned on the counts of the lengths."""

from __future__ import annotations

import base64
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seqlab.llm.worker import texts_of, worker_state
from seqlab.session import land

MOST_TOKENS, END = 1024, 2
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Pieces of one length that are numbered in one window, about.
BUCKET = 1 << 20


class Encoder:
    """The ids of whole texts as the tokenizer of the file gives them.

    The ranks of the same vocabulary give equal ids faster (the tests compare them for every code point). Texts with one of the
    tokenizer's special strings, and runs of white space that are too long for the other, go to the tokenizer itself.
    """

    def __init__(self, model: str, ranks: bytes):
        self.tokenizer = Tokenizer.from_str(model)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        merges = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, ranks.splitlines())}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, none added."""
        if not any(s in text for s in self.special):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except ValueError:  # white space without end
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


def pieces(docs: DataFrame, most: int = MOST_TOKENS, path: str | None = None, ranks: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the ids of every whole text and the end id, cut if there are over ``most``.

    All pieces but the first have ``most`` ids. A null text is empty and gives one piece, the end id.
    """
    model, merges = Path(path or public_tokenizers.path(VOCABULARY)).read_text("utf-8"), Path(ranks or public_tokenizers.path(RANKS)).read_bytes()
    sent = docs.sparkSession.sparkContext.broadcast((model, merges))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state("packing encoder", lambda: Encoder(*sent.value))
        for batch in batches:
            texts = texts_of(batch)
            doc, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(texts):
                ids = np.append(encoder.encode(text), END).astype("<u4")
                for k, stop in enumerate(range((len(ids) - 1) % most + 1, len(ids) + 1, most)):
                    begin = stop - most if k else 0
                    doc.append(i)
                    piece.append(k)
                    start.append(begin)
                    length.append(stop - begin)
                    crc.append(zlib.crc32(ids[begin:stop]))
            arrays = [batch.column("doc_id").take(pa.array(doc, pa.int32())), pa.array(piece, pa.int32())]
            arrays += [pa.array(x, pa.int64()) for x in (start, length, crc)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def complements(counts: Counter, most: int) -> list[tuple[int, tuple[int, ...]]]:
    """(times, lengths) of sequences that are exactly full, taken out of ``counts``, which is changed.

    For each length, longest first, the gap that it leaves is looked up among single lengths, sums of pairs and sums of
    triples. A combination is used as often as the counts allow, so each use ends the stock of one of its lengths.
    """
    plan = []
    stock = np.zeros(most + 1, np.int64)
    for length, n in counts.items():
        stock[length] = n
    held = np.flatnonzero(stock)
    pairs: dict[int, np.ndarray] = {}
    sums = held[:, None] + held
    for total in np.unique(sums[sums < most]).tolist():
        pairs[total] = held[(2 * held <= total) & (stock[np.maximum(total - held, 0)] > 0)]

    def take(*lengths: int) -> None:
        times = min(int(stock[x]) // lengths.count(x) for x in set(lengths))
        if times:
            for x in lengths:
                stock[x] -= times
            plan.append((times, lengths))

    def pair_of(total: int, least: int = 0) -> list[int]:
        """The smaller lengths, from ``least`` on, of the pairs with this sum that are still in stock."""
        first = pairs.get(total, held[:0])
        return first[(first >= least) & (stock[first] > 0) & (stock[total - first] > 0)].tolist()

    for length in range(most, 0, -1):
        gap = most - length
        if not stock[length]:
            continue
        take(length, *([gap] if gap else []))
        for first in pair_of(gap):
            take(length, gap - first, first)
        for third in held[3 * held <= gap].tolist():
            if stock[length] and stock[third]:
                for first in pair_of(gap - third, third):
                    take(length, gap - third - first, first, third)
    for length in list(counts):
        counts[length] = int(stock[length])
    return plan


def best_fit(counts: Counter, most: int) -> list[tuple[int, tuple[int, ...]]]:
    """(times, lengths) of sequences for all that is in ``counts``: longest first, each into the open sequence with the
    smallest room that is enough, all equal pieces and sequences at once."""
    closed: list[tuple[int, tuple[int, ...]]] = []
    rooms: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    for length in sorted((x for x in counts if counts[x]), reverse=True):
        left = counts[length]
        while left:
            room = next((r for r in range(length, most + 1) if rooms[r]), None)
            if room is None:
                each = most // length
                whole, rest = divmod(left, each)
                for times, n in ((whole, each), (1 if rest else 0, rest)):
                    if times:
                        (rooms[most - n * length].append if most - n * length else closed.append)((times, (length,) * n))
                break
            times, held = rooms[room].pop()
            fits = min(room // length, left)
            used = min(times, left // fits)
            if used < times:
                rooms[room].append((times - used, held))
            (rooms[room - fits * length].append if room - fits * length else closed.append)((used, held + (length,) * fits))
            left -= used * fits
    return closed + [x for kept in rooms.values() for x in kept]


def plan(counts: dict[int, int], most: int = MOST_TOKENS) -> list[tuple[int, int, int, int, int]]:
    """(length, first, last, sequence, offset): pieces of a length that are numbered first to last, from 0, go to the sequences
    numbered sequence, sequence + 1 ... at offset. Its rows depend on the number of different lengths, at most ``most``,
    not on the number of pieces."""
    stock = Counter(counts)
    used: Counter = Counter()
    rows, sequence = [], 0
    for times, lengths in [*complements(stock, most), *best_fit(stock, most)]:
        offset = 0
        for length in lengths:
            rows.append((length, used[length], used[length] + times - 1, sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    return rows


def pack(docs: DataFrame, most: int = MOST_TOKENS, path: str | None = None, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all pieces of ``docs`` (doc_id, text; others are ignored).

    The tokens are counted once and landed without texts. Full pieces are sequences of their own, numbered where they are read. Of
    the others, one for each document at most, the plan is made on the driver from the counts of fewer than ``most`` lengths; the
    pieces of a length are numbered in as many windows as keep about ``bucket`` of them each, so that a length that most
    pieces have is no single task. Repeated rows and null ids are pieces like any other; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    cut = land(pieces(docs, most, path), "pieces")
    rest, columns = cut.where(F.col("length") < most), ["doc_id", "piece", "start", "length", "ids_crc32"]
    sizes = {r["length"]: r["count"] for r in rest.groupBy("length").count().collect()}  # fewer than ``most`` rows
    planned = plan(sizes, most)
    first = max((sequence + last - begin + 1 for _, begin, last, sequence, _ in planned), default=0)
    full = cut.where(F.col("length") == most).select(*columns, (F.monotonically_increasing_id() + first).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    if not planned:
        return full
    # Both have a few rows for each length, however many pieces there are.
    windows = F.broadcast(spark.createDataFrame([(x, -(-n // bucket)) for x, n in sizes.items()], "length long, windows long"))
    ranges = F.broadcast(spark.createDataFrame(planned, "length long, first long, last long, sequence long, offset long"))
    salted = rest.join(windows, "length").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("windows")))
    upto = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = salted.groupBy("length", "bucket").count()
    before = counts.select("length", "bucket", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    placed = salted.withColumn("place", F.row_number().over(order) - 1).join(before, ["length", "bucket"])
    placed = placed.withColumn("number", F.col("place") + F.col("before")).join(ranges, "length").where("number between first and last")
    return placed.select(*columns, (F.col("sequence") + F.col("number") - F.col("first")).alias("sequence_id"), "offset").union(full)

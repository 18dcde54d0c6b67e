"""Near-duplicates by SimHash: per-segment bit counts put fingerprints on a grid, and a range join finds the links."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlab.llm.components import components
from seqlab.llm.worker import append_columns, unused
from seqlab.session import land

#: Differing bits of linked fingerprints, at most. The two half embeddings below are made for 3.
RADIUS = 3
SEED = 42
#: Shingles whose bits are counted at once, fingerprints of a cell that one task compares with all others of the cell, and
#: the pairs of a small cell that are listed at once.
BLOCK, CELL, SMALL = 1 << 15, 4096, 1024


def fingerprint(text: str, width: int = 3) -> int:
    """The SimHash of a text: bit b is set if it is set in over half of the XXH64 of its word shingles; 0 without words."""
    words = text.encode("utf-8", "replace").lower().split()  # of bytes: A-Z alone, and white space is space and 9 to 13
    if not words:
        return 0
    grams = list(map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))) if len(words) >= width else [b" ".join(words)]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(grams), BLOCK):
        part = grams[at : at + BLOCK]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(SEED)), np.dtype("<u8"), len(part))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(grams), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and fp, the fingerprint of the whole text as a signed long. A null text is empty and gives 0."""
    return append_columns(docs, lambda texts: {"fp": pa.array([fingerprint(t) for t in texts], pa.int64())}, "fp long", keep)


def grid(nodes: DataFrame, cell: int = CELL) -> DataFrame:
    """Rows (half, cell, block, probe, fp) of distinct fingerprints; links show up inside a (half, cell, block).

    A fingerprint is mapped to the bit counts of its 32 two-bit segments, 0 to 2 each. The Manhattan distance of two such
    vectors is a lower bound of the Hamming distance, so linked fingerprints are within 3; of the two halves of 16 counts,
    one is within 1. A half of the vector is a grid cell. Each fingerprint lives in its own cell of either half and probes
    that cell and those with one count more: of two neighbours one has the smaller count. A cell with more than ``cell``
    fingerprints is split into blocks; each probe then visits all blocks.
    """
    # Subtracting every second bit from its pair leaves the number of set bits of each pair in place.
    bits = F.array(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32))
    halves = F.transform(bits, lambda x: x - F.shiftright(x, 1).bitwiseAND(F.lit(0x55555555)))
    homes = nodes.select("fp", F.posexplode(halves).alias("half", "cell"))
    hot = homes.groupBy("half", "cell").count().where(F.col("count") > cell)
    hot = land(hot.select("half", "cell", F.ceil(F.col("count") / cell).cast("int").alias("blocks")), "hot_cells")
    steps = F.filter(
        F.array(*(F.when(F.shiftright("cell", 2 * i).bitwiseAND(F.lit(3)) < 2, F.col("cell") + F.lit(1 << (2 * i))) for i in range(16))),
        lambda c: c.isNotNull(),
    )
    probes = homes.select("fp", "half", F.explode(F.concat(F.array("cell"), steps)).alias("cell"))
    own = homes.join(hot, ["half", "cell"], "left").select(
        "half", "cell", F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int").alias("block"), F.lit(False).alias("probe"), "fp"
    )
    sent = probes.join(hot, ["half", "cell"], "left").select(
        "half", "cell", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("block"), F.lit(True).alias("probe"), "fp"
    )
    return own.union(sent)


def linked(cells: DataFrame) -> DataFrame:
    """Edges (u, v) of fingerprints that join exactly what the links of all cells join.

    Partitions are sorted by cell and streamed; the rows that live in the last cell of a batch are carried over. Small cells
    list their links; in a larger one each probe gives one edge, and the homes that it joins for the first time one each, so
    a cell of near copies gives about as many edges as it has rows.
    """
    keys = ["half", "cell", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None
        for batch in batches:
            half, cell, block, probe, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in (*keys, "probe", "fp"))
            rows = [half.astype(np.int64), cell, block.astype(np.int64), probe.astype(bool), fp]
            if carried is not None:
                rows = [np.concatenate(x) for x in zip(carried, rows, strict=True)]
            if not len(rows[4]):
                continue
            new = np.ones(len(rows[4]), bool)
            new[1:] = (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1]) | (rows[2][1:] != rows[2][:-1])
            last = np.flatnonzero(new)[-1]
            rest = slice(last, None)
            carried = [x[rest][~rows[3][rest]] for x in rows]
            u, v = cell_edges(new, rows[3], rows[4].view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return cells.repartition(*keys).sortWithinPartitions(*keys, "probe").mapInArrow(run, "u long, v long")


def cell_edges(new: np.ndarray, probe: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges within sorted cells; ``new`` marks the first row of a cell, and its homes stand before its probes."""
    start = np.flatnonzero(new)
    homes = np.add.reduceat((~probe).astype(np.int64), start)
    size = np.diff(np.append(start, len(fp)))
    visits = size - homes
    alone = (size == 2) & (fp[start] == fp[np.minimum(start + 1, len(fp) - 1)])  # a fingerprint that visits itself
    small = (homes * visits <= SMALL) & (homes > 0) & (visits > 0) & ~alone
    # Rows of small cells: each probe is paired with every home of its cell.
    of = np.repeat(np.arange(len(start)), size)
    asks = np.flatnonzero(probe & small[of])
    n = homes[of[asks]]
    left = np.repeat(asks, n)
    first = np.repeat(np.cumsum(n) - n, n)
    right = start[of[left]] + np.arange(len(left)) - first
    near = (np.bitwise_count(fp[left] ^ fp[right]) <= RADIUS) & (fp[left] != fp[right])
    us, vs = [fp[left[near]]], [fp[right[near]]]
    for g in np.flatnonzero((homes * visits > SMALL)):
        h = fp[start[g] : start[g] + homes[g]]
        p = fp[start[g] + homes[g] : start[g] + size[g]]
        label = np.arange(len(h))
        step = max(1, (1 << 22) // len(h))
        for at in range(0, len(p), step):
            close = np.bitwise_count(p[at : at + step, None] ^ h) <= RADIUS
            one = close.any(1)
            lead = close.argmax(1)
            us.append(p[at : at + step][one])
            vs.append(h[lead[one]])
            for i in np.flatnonzero(close.sum(1) > 1):
                met = np.unique(label[close[i]])
                if len(met) > 1:
                    us.append(np.full(len(met) - 1, h[met[0]]))
                    vs.append(h[met[1:]])
                    label[np.isin(label, met)] = met[0]
    return np.concatenate(us), np.concatenate(vs)


def near_duplicates(rows: DataFrame, cell: int = CELL) -> DataFrame:
    """(fp, root, component_id, members) of the fingerprints of ``rows`` (doc_id, fp): linked at ``RADIUS`` or fewer differing bits.

    component_id is the smallest doc_id of all rows that can be reached, null if none has one. Equal fingerprints are one
    node, so copies cost nothing; the work grows with the number of distinct fingerprints and the links between cells.
    """
    nodes = land(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")), "fingerprints")
    roots = components(linked(grid(nodes.select("fp"), cell)))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first_id", "copies", F.coalesce("root", "fp").alias("root"))
    groups = placed.groupBy("root").agg(F.min("first_id").alias("component_id"), F.sum("copies").alias("members"))
    return placed.join(groups, "root").select("fp", "root", "component_id", "members")


def simhash_components(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id, members) of every row of ``docs`` (doc_id, text; other columns are ignored).

    Empty, blank and null texts have fingerprint zero and are linked like any other. Repeated rows are returned repeatedly.
    A null doc_id is kept; it never becomes a component_id. An empty table gives an empty table.
    """
    rows = land(fingerprints(docs, ["doc_id"]), "simhash")
    found = near_duplicates(rows)
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return rows.join(found, "fp").select("doc_id", hexed, "component_id", "members")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, with one row of each component: that of the smallest doc_id, a null doc_id last.

    Rows are told apart by doc_id and a hash of the text, so that the texts are fingerprinted once and shuffled once.
    """
    own = unused("text_hash", docs.columns)
    rows = land(fingerprints(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), ["doc_id", "text_hash"]), "simhash")
    groups = near_duplicates(rows)
    firsts = rows.join(groups, "fp").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("kept"))
    firsts = firsts.select(F.col("kept.doc_id").alias("kept_id"), F.col("kept.text_hash").alias("kept_hash"))
    same = docs["doc_id"].eqNullSafe(firsts["kept_id"]) & (F.xxhash64(docs["text"]) == firsts["kept_hash"])
    kept = docs.join(firsts, same, "left_semi")
    return kept.groupBy("doc_id", F.xxhash64("text").alias(own)).agg(*(F.first(c).alias(c) for c in docs.columns if c != "doc_id")).select(*docs.columns)

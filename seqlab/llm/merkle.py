"""A Merkle manifest of documents: a tree of every source under a tree of the sources, and proofs by shared multiproofs.

Leaves are dealt into partitions of whole aligned blocks. A partition needs, beyond its own leaves, the least set of nodes from
which all its paths to the root can be derived (an octopus); it fetches them once, derives the interior that its leaves
share, and cuts the proof of every leaf out of that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqlab.session import land

#: Children of a node, and the levels that one task builds over a block of leaves or nodes.
ARITY, LEVELS = 3, 6
BLOCK = ARITY**LEVELS
#: The number of the tree whose leaves are the roots of all sources.
TOP = -1
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
NODES = "part long, tree long, level int, idx long, n long, done boolean, digest string"
RESULT = pa.schema(
    [("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()),
     ("folded_root", pa.string()), ("verified", pa.bool_())]
)
RESULT_TYPES = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(value: Column) -> Column:
    """A value as its number of UTF-8 bytes, a colon and itself; null is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The digest of a row of documents, with some columns changed."""
    return F.sha2(F.concat(*(encoded(changed.get(c, F.col(c))) for c in FIELDS)), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, tampered): the leaf of every row, and where 2 divides crc32(doc_id) that of the row without line feeds.

    tampered is null where nothing is changed. Other columns are ignored.
    """
    chosen = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    tampered = F.when(chosen, leaf(text=F.replace("text", F.lit("\n"), F.lit(""))))
    return docs.select("doc_id", "source", leaf().alias("leaf"), tampered.alias("tampered"))


def numbered(rows: DataFrame, keys: list[str], out: str) -> DataFrame:
    """``rows``, landed, with ``out``: their place 0, 1, 2, ... by ``keys``, nulls first. Rows with equal keys may stand in any order.

    Range partitions are sorted and counted in one pass, and the number of rows before each is added; no group is in one task,
    also not one of equal keys, as these are told apart by where they were read.
    """
    fixed = land(rows.withColumn("_read", F.monotonically_increasing_id()), "unordered")
    order = [*keys, "_read"]
    ranged = fixed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_read")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, range_id = 0, TaskContext.get().partitionId()
        for batch in batches:
            n = batch.num_rows
            added = [pa.array([range_id] * n, pa.int32()), pa.array(range(at, at + n), pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "_range", "_place"])
            at += n

    placed = land(ranged.mapInArrow(run, f"{types}, _range int, _place long"), "ordered")
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))  # a row for each range
    offsets = counts.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    return placed.join(offsets, "_range").withColumn(out, F.col("_before") + F.col("_place")).select(*rows.columns, out)


def levels_above(n: int) -> int:
    """The levels between ``n`` nodes and the one they become."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def raised(nodes: list[str]) -> list[str]:
    """The digests of all runs of ``ARITY`` nodes; the last may be shorter."""
    return [digest("".join(nodes[i : i + ARITY])) for i in range(0, len(nodes), ARITY)]


def missing(known: Iterable[int], n: int) -> list[tuple[int, int]]:
    """The least set of nodes (level, index) that together with the ``known`` of ``n`` nodes gives all nodes above the known."""
    needed, level, known = [], 0, set(known)
    while n > 1:
        runs = {i // ARITY for i in known}
        needed += [(level, i) for r in sorted(runs) for i in range(r * ARITY, min((r + 1) * ARITY, n)) if i not in known]
        known, n, level = runs, -(-n // ARITY), level + 1
    return needed


def derive(found: dict[tuple[int, int], str], known: Iterable[int], n: int) -> None:
    """Add the nodes (level, index) above the ``known`` of ``n`` nodes, from what is ``found`` of them and of the missing ones."""
    level, known = 0, set(known)
    while n > 1:
        known_runs = {i // ARITY for i in known}
        for r in known_runs:
            found[level + 1, r] = digest("".join(found[level, i] for i in range(r * ARITY, min((r + 1) * ARITY, n))))
        known, n, level = known_runs, -(-n // ARITY), level + 1


def way_up(found: dict[tuple[int, int], str], index: int, n: int) -> list[tuple[str, str]]:
    """For each level above a node, the digests of its run that stand before it and those after it."""
    steps, level = [], 0
    while n > 1:
        first = index // ARITY * ARITY
        run = [found[level, i] for i in range(first, min(first + ARITY, n))]
        steps.append(("".join(run[: index - first]), "".join(run[index - first + 1 :])))
        index, n, level = index // ARITY, -(-n // ARITY), level + 1
    return steps


def streamed(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """The groups of sorted rows, one after another."""
    rows = (r for batch in batches for at in range(0, batch.num_rows, 2048) for r in batch.slice(at, 2048).to_pylist())
    for k, group in groupby(rows, key=lambda r: tuple(r[c] for c in key)):
        yield k, list(group)


def in_batches(rows: Iterable[tuple], schema: pa.Schema, most: int = 5000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield columns_of(held, schema)
            held = []
    yield columns_of(held, schema)


def columns_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


NODE_SCHEMA = pa.schema(
    [("part", pa.int64()), ("tree", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("n", pa.int64()), ("done", pa.bool_()), ("digest", pa.string())]
)


def build_blocks(nodes: DataFrame, all_levels: bool) -> DataFrame:
    """Nodes above ``nodes`` (part, tree, level, idx, n, digest), up to ``LEVELS`` levels: all, or of each block the last alone.

    n is the number of nodes of the tree at the level of a row. done says that the node is the last that its block gives. The
    nodes of a block are one group of at most ``BLOCK`` rows.
    """

    def above(block: list[dict]) -> Iterator[tuple]:
        part, tree, level, idx, n = (block[0][c] for c in ("part", "tree", "level", "idx", "n"))
        current, climb = [r["digest"] for r in block], min(LEVELS, levels_above(n))
        if not climb:
            yield part, tree, level, idx, n, True, current[0]
        for step in range(climb):
            current, idx, n = raised(current), idx // ARITY, -(-n // ARITY)
            if all_levels or step + 1 == climb:
                yield from ((part, tree, level + step + 1, idx + i, n, step + 1 == climb, d) for i, d in enumerate(current))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches((row for _, block in streamed(batches, ["tree", "block"]) for row in above(block)), NODE_SCHEMA)

    blocks = nodes.select("part", "tree", "level", "idx", "n", "digest", F.floor(F.col("idx") / BLOCK).alias("block"))
    return blocks.repartition("part").sortWithinPartitions("part", "tree", "block", "idx").mapInArrow(run, NODES)


def climbed(nodes: DataFrame) -> list[DataFrame]:
    """All nodes above ``nodes`` up to the root of each tree, as landed tables, one for each ``LEVELS`` levels."""
    found, live = [], nodes.where("n > 1")
    while not live.isEmpty():
        block = live.withColumn("part", F.xxhash64("tree", F.floor(F.col("idx") / BLOCK)))
        found.append(land(build_blocks(block, all_levels=True), "merkle_nodes"))
        live = found[-1].where("done and n > 1")
    return found


def union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f)
    return whole


class Manifest:
    """The landed leaves and nodes of a set of documents. ``root`` is the digest of all."""

    def __init__(self, docs: DataFrame):
        ordered = land(numbered(leaves(docs), ["source", "doc_id", "leaf"], "place"), "leaves")
        sources = ordered.groupBy("source").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("n"))
        self.sources = land(numbered(sources, ["start"], "tree"), "sources")
        same = ordered["source"].eqNullSafe(self.sources["source"])
        idx = F.col("place") - F.col("start")
        # Blocks whose first leaves are in one stretch of BLOCK places are one partition: fewer than two blocks of leaves in all.
        part = F.floor((F.col("start") + F.floor(idx / BLOCK) * BLOCK) / BLOCK)
        joined = ordered.join(self.sources, same).select("doc_id", "leaf", "tampered", "tree", idx.alias("idx"), "n", part.alias("part"))
        self.leaves = land(joined, "placed_leaves")
        rows = self.leaves.select("part", "tree", F.lit(0).alias("level"), "idx", "n", F.col("leaf").alias("digest"))
        #: The last node of each block of leaves, and the partition that has the block.
        self.blocks = land(build_blocks(rows, all_levels=False), "merkle_blocks")
        inner = climbed(self.blocks)
        roots = union([self.blocks, *inner]).where("n = 1")
        self.n_sources = self.sources.count()
        ends = roots.select(F.lit(0).cast("long").alias("part"), F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"), F.lit(self.n_sources).cast("long").alias("n"), F.lit(True).alias("done"), "digest")
        self.subroots = land(ends, "merkle_subroots")
        outer = climbed(self.subroots)
        #: All nodes from the last of the blocks of leaves on.
        self.nodes = union([self.blocks, *inner, self.subroots, *outer]).select("tree", "level", "idx", "n", "digest")
        top = union([self.subroots, *outer]).where("n = 1").first() if self.n_sources else None
        self.root = top["digest"] if top else None

    def fetched(self) -> DataFrame:
        """(part, tree, level, idx, digest): for each partition of leaves the nodes that it lacks, and no more."""
        n_sources = self.n_sources

        def wanted(part: int, blocks: list[dict]) -> Iterator[tuple]:
            trees = {r["tree"] for r in blocks}
            for tree in sorted(trees):
                own = [r for r in blocks if r["tree"] == tree]
                yield from ((part, tree, own[0]["level"] + level, i) for level, i in missing([r["idx"] for r in own], own[0]["n"]))
            yield from ((part, TOP, level, i) for level, i in missing(trees, n_sources))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            schema = pa.schema([("part", pa.int64()), ("tree", pa.int64()), ("level", pa.int32()), ("idx", pa.int64())])
            yield from in_batches((row for (part,), blocks in streamed(batches, ["part"]) for row in wanted(part, blocks)), schema)

        sorted_blocks = self.blocks.repartition("part").sortWithinPartitions("part", "tree", "idx")
        asked = land(sorted_blocks.mapInArrow(run, "part long, tree long, level int, idx long"), "merkle_asked")
        return asked.join(self.nodes.drop("n"), ["tree", "level", "idx"])

    def per_partition(self, expand: Callable, types: str, schema: pa.Schema) -> DataFrame:
        """``expand`` of the derived nodes and the leaves of every partition: its rows, a partition at a time."""
        n_sources, root = self.n_sources, self.root
        blank = lambda c: F.lit(None).cast(c)
        nodes = self.fetched().select("part", F.lit(0).alias("kind"), "tree", "level", "idx", blank("long").alias("n"), "digest", blank("long").alias("doc_id"), blank("string").alias("tampered"))
        rows = self.leaves.select("part", F.lit(1).alias("kind"), "tree", F.lit(0).alias("level"), "idx", "n", F.col("leaf").alias("digest"), F.col("doc_id").cast("long"), "tampered")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = (row for _, rows in streamed(batches, ["part"]) for row in expand(*derived(rows, n_sources), n_sources, root))
            yield from in_batches(out, schema)

        both = nodes.unionByName(rows).repartition("part").sortWithinPartitions("part", "kind", "tree", "level", "idx")
        return both.mapInArrow(run, types)

    def proofs(self) -> DataFrame:
        """(doc_id, leaf, siblings): the proof of every leaf, the digests of the other nodes of each run on its way to the root."""
        schema = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("siblings", pa.list_(pa.string()))])

        def expand(trees: dict, own: dict, n_sources: int, root: str) -> Iterator[tuple]:
            for row, steps, _ in paths(trees, own, n_sources):
                joined = "".join(before + after for before, after in steps)
                yield row["doc_id"], row["digest"], [joined[i : i + 64] for i in range(0, len(joined), 64)]

        return self.per_partition(expand, "doc_id long, leaf string, siblings array<string>", schema)

    def verdicts(self) -> DataFrame:
        """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every leaf; see ``tampered_proofs``."""

        def expand(trees: dict, own: dict, n_sources: int, root: str) -> Iterator[tuple]:
            for row, steps, subroot in paths(trees, own, n_sources):
                folded = row["tampered"] or row["digest"]
                proof = hashlib.sha256()
                for before, after in steps:
                    proof.update((before + after).encode())
                    folded = digest(before + folded + after)
                yield row["doc_id"], row["digest"], subroot, root, proof.hexdigest(), folded, folded == root

        return self.per_partition(expand, RESULT_TYPES, RESULT)


def derived(rows: list[dict], n_sources: int) -> tuple[dict[int, dict], dict[int, list[dict]]]:
    """The nodes of each tree that a partition has and derives, by (level, index), and its leaves of each tree."""
    trees: dict[int, dict] = {TOP: {}}
    own: dict[int, list[dict]] = {}
    for r in rows:
        trees.setdefault(r["tree"], {})[r["level"], r["idx"]] = r["digest"]
        if r["kind"]:
            own.setdefault(r["tree"], []).append(r)
    for tree, members in own.items():
        # Within the blocks nothing is missing below the nodes that were fetched, so runs are complete on all levels.
        derive(trees[tree], [r["idx"] for r in members], members[0]["n"])
        trees[TOP][0, tree] = trees[tree][levels_above(members[0]["n"]), 0]
    derive(trees[TOP], list(own), n_sources)
    return trees, own


def paths(trees: dict[int, dict], own: dict[int, list[dict]], n_sources: int) -> Iterator[tuple[dict, list[tuple[str, str]], str]]:
    """Every leaf of a partition with its way to the root and the root of its source."""
    for tree, members in own.items():
        shared = way_up(trees[TOP], tree, n_sources)
        for row in members:
            yield row, way_up(trees[tree], row["idx"], row["n"]) + shared, trees[TOP][0, tree]


def tampered_proofs(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of ``docs`` (doc_id, source, lang, n_chars, text).

    Other columns are ignored. Leaves of a source ascend by doc_id (null first), then by leaf; a null source is a source. proof_sha256
    is the digest of the siblings on the way to the root, of no text if there are none. folded_root is what the tampered row, if
    its doc_id is chosen, and the original siblings give. Repeated rows are leaves of their own; an empty table gives an empty table.
    """
    if docs.isEmpty():
        return docs.sparkSession.createDataFrame([], RESULT_TYPES)
    return Manifest(docs).verdicts()

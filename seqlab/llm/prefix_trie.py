"""A trie of conversation prefixes as a burst trie: heads above containers of suffixes, which are sorted and swept into nodes.

A turn is a token of fixed size, so a conversation is a binary value whose order is that of its turns. Conversations start in one
container for each first turn. A container above a size bursts: what all its suffixes share becomes a head, and each next
turn gets a container of its own. The others are sorted and swept, each by itself. Heads take the sums of what is below them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlab.session import land

#: Bytes of a token: of the digest of role and text, and of the number of code points of the text.
DIGEST, LENGTH = 16, 8
TOKEN = DIGEST + LENGTH
#: Turns below the head of a container, at most, unless one conversation alone has more.
MOST_TURNS = 4096
#: Ids of equal conversations are listed in chunks of this power of two of ids, before the list of all is hashed.
CHUNK_BITS = 12
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = pa.schema(
    [("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
     ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("top", pa.bool_()), ("up", pa.binary())]
)
NODE_TYPES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, top boolean, up binary"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
ROW = ["seq", "n", "first", "ends", "depth", "parent", "up", "children", "leaves", "saved"]


def turn_token(role: Column, text: Column) -> Column:
    """The token of a turn: 16 bytes of the SHA-256 of role and text, told apart by the length of the role, and the text's length."""
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.substring(F.unhex(F.sha2(said, 256)), 1, DIGEST), F.unhex(F.lpad(F.hex(F.length(text)), 2 * LENGTH, "0")))


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq): the tokens of each conversation by turn, null first, ties by token. Null roles and texts are empty.

    Rows without a conv_id are no conversation. Texts are hashed before the shuffle: 24 bytes a turn are one value of a conversation.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), F.struct("turn", turn_token(role, text).alias("token")).alias("said"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    return whole.select("conv_id", F.unhex(F.array_join(F.transform("said", lambda s: F.hex(s["token"])), "")).alias("seq"))


def tokens_of(seq: Column, start: Column | int, count: Column | int) -> Column:
    """``count`` tokens from the token of number ``start`` on, counted from 0; fewer at the end."""
    start, count = (F.lit(x) if isinstance(x, int) else x for x in (start, count))
    return F.substring(seq, (start * TOKEN + 1).cast("int"), (count * TOKEN).cast("int"))


def size_of(seq: Column) -> Column:
    """How many tokens there are."""
    return F.floor(F.octet_length(seq) / TOKEN).cast("long")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq) of every conversation c: the first h turns of c - c % 100, then its own after its first h; h = crc32(c) % 6."""
    own = land(sequences(conversations), "sequences")
    h = (F.crc32(F.col("conv_id").cast("string")) % 6).cast("int")
    rest = own.select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 100).alias("base_id"), tokens_of(F.col("seq"), h, size_of(F.col("seq"))).alias("rest"))
    bases = own.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base_id"), tokens_of(F.col("seq"), 0, 5).alias("base"))
    start = tokens_of(F.coalesce("base", F.unhex(F.lit(""))), 0, F.col("h"))
    return rest.join(bases, "base_id", "left").select("conv_id", F.concat(start, "rest").alias("seq"))


def distinct_sequences(rows: DataFrame) -> DataFrame:
    """(seq, n, first, ends) of ``rows`` (conv_id, seq), conv_id unique: how many conversations are this sequence, the smallest, and the digest of all ids.

    Ids are sorted and listed in chunks first, so a sequence that very many conversations share gives one task a row for each
    chunk; these are hashed as a stream, and nothing of the size of the group is ever held.
    """
    key, chunk = F.unhex(F.sha2("seq", 256)).alias("key"), F.shiftright("conv_id", CHUNK_BITS).alias("chunk")
    chunks = rows.groupBy(key, chunk).agg(F.first("seq").alias("seq"), F.sort_array(F.collect_list("conv_id")).alias("ids"))
    listed = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("listed")
    sent = chunks.select("key", "chunk", "seq", F.size("ids").cast("long").alias("n"), F.col("ids")[0].alias("first"), listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("seq", pa.binary()), ("n", pa.int64()), ("first", pa.int64()), ("ends", pa.string())])
        held: list = []
        for batch in batches:
            out: list[tuple] = []
            for key, seq, n, first, listed in zip(*(batch.column(c).to_pylist() for c in ("key", "seq", "n", "first", "listed")), strict=True):
                if held and held[0] == key:
                    held[2] += n
                    held[4].update(b"," + listed.encode())
                else:
                    out += [(*held[1:4], held[4].hexdigest())] if held else []
                    held = [key, seq, n, first, hashlib.sha256(listed.encode())]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema)
        if held:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*held[1:4], held[4].hexdigest()), strict=True))], schema)

    return sent.repartition("key").sortWithinPartitions("key", "chunk").mapInArrow(run, "seq binary, n long, first long, ends string")


def head_of() -> Column:
    """The container of a row: the turns down to the depth of its head."""
    return tokens_of(F.col("seq"), 0, F.col("depth"))


def shared(low: Column, high: Column) -> Column:
    """How many turns the least and the greatest of some sequences share, and so all between them."""
    least = F.least(size_of(low), size_of(high))
    differs = F.filter(F.sequence(F.lit(0).cast("long"), least), lambda i: (i == least) | (tokens_of(low, i, 1) != tokens_of(high, i, 1)))
    return F.array_min(differs)


def burst(live: DataFrame, most_turns: int) -> tuple[DataFrame, list[DataFrame]]:
    """The rows of containers that stay, and for each round the containers that burst.

    A round costs jobs over the rows of the containers before it; each burst container has at least two ways on, so rounds
    follow the branches of large containers, not their depth. Sizes are counted before the shuffle.
    """
    settled, rounds = [], []
    while True:
        named = live.withColumn("head", head_of())
        turns = F.sum(size_of(F.col("seq")) - F.col("depth") + 1)
        large = named.groupBy("head").agg(F.count(F.lit(1)).alias("rows"), turns.alias("turns")).where((F.col("rows") > 1) & (F.col("turns") > most_turns))
        large = land(large.select("head"), "large_containers")
        if large.isEmpty():
            return reduce(DataFrame.unionByName, [*settled, live]), rounds
        settled.append(named.join(large, "head", "left_anti").select(*ROW))
        hot = named.join(large, "head")
        one = hot.groupBy("head").agg(
            F.min("seq").alias("low"), F.max("seq").alias("high"), F.sum("n").alias("n"), F.min("first").alias("first"), F.min_by("ends", "seq").alias("low_ends"),
            F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.max("up").alias("up"),
        )
        one = one.withColumn("shared", shared(F.col("low"), F.col("high")))
        ends = F.when(size_of(F.col("low")) == F.col("shared"), F.col("low_ends"))  # what ends at the head comes first
        heads = land(one.select("head", tokens_of(F.col("low"), 0, F.col("shared")).alias("seq"), "n", "first", ends.alias("ends"), "depth", "parent", "up", "shared"), "heads")
        rounds.append(heads)
        on = heads.select("head", F.col("shared"), F.col("first").alias("above"))
        below = hot.drop("parent", "up", "depth").join(on, "head").where(size_of(F.col("seq")) > F.col("shared"))
        below = below.withColumns({"depth": F.col("shared") + 1, "parent": F.col("above"), "up": F.col("head")})
        live = land(below.select(*ROW), "containers")


def sweep(rows: DataFrame) -> DataFrame:
    """The nodes of all containers of ``rows``, each container sorted and swept by itself; its top node knows the head above.

    A row may stand for a burst container: what it shares, with the sums of what is below. A container holds a bounded number of
    turns, or one sequence, and containers come one after another.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, head = [], None
        for batch in batches:
            nodes: list[tuple] = []
            for key, *row in zip(*(batch.column(c).to_pylist() for c in ("head", *ROW)), strict=True):
                if held and key != head:
                    nodes += container_nodes(held)
                    held = []
                    if len(nodes) > 20_000:
                        yield as_batch(nodes)
                        nodes = []
                head = key
                held.append(row)
            yield as_batch(nodes)
        if held:
            yield as_batch(container_nodes(held))

    placed = rows.withColumn("head", head_of()).select("head", *ROW)
    return placed.repartition("head").sortWithinPartitions("head", "seq").mapInArrow(run, NODE_TYPES)


def as_batch(nodes: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*nodes, strict=True)) if nodes else [()] * len(NODE)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, NODE, strict=True)], schema=NODE)


def container_nodes(rows: list[list]) -> list[tuple]:
    """The nodes (as ``NODE``) of one container from its rows (as ``ROW``), distinct sequences in their order."""
    depth, parent, up = rows[0][4:7]
    # A node: depth, members, smallest member, children, leaves, saved, code points of its text, ends, the node above.
    nodes: list[list] = []
    way: list[int] = []
    before = b""

    def close() -> None:
        node = nodes[way.pop()]
        node[4] = node[4] if node[3] else 1
        node[5] += (node[1] - 1) * node[6]
        if way:
            node[8] = way[-1]
            above = nodes[way[-1]]
            above[1] += node[1]
            above[2] = node[2] if above[2] is None else min(above[2], node[2])
            above[3] += 1
            above[4] += node[4]
            above[5] += node[5]

    for seq, n, first, ends, _, _, _, children, leaves, saved in rows:
        size, same = len(seq) // TOKEN, depth - 1
        while same < size and before and before[same * TOKEN : (same + 1) * TOKEN] == seq[same * TOKEN : (same + 1) * TOKEN]:
            same += 1
        while len(way) > same - depth + 1:
            close()
        for d in range(same + 1, size + 1):
            way.append(len(nodes))
            nodes.append([d, 0, None, 0, 0, 0, int.from_bytes(seq[d * TOKEN - LENGTH : d * TOKEN], "big"), NO_ENDS, -1])
        last = nodes[way[-1]]
        last[1] += n
        last[2] = first
        last[3] += children
        last[4] += leaves
        last[5] += saved
        last[7] = ends or NO_ENDS
        before = seq
    while way:
        close()
    return [
        (first, d, nodes[above][2] if above >= 0 else parent, n, children, leaves, saved, ends, above < 0, up if above < 0 else None)
        for d, n, first, children, leaves, saved, _, ends, above in nodes
    ]


def trie(rows: DataFrame, most_turns: int = MOST_TURNS) -> DataFrame:
    """The nodes of the trie of ``rows`` (conv_id, seq): (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    (conv_id, depth) is a key: a node is named by its smallest member. Empty sequences are members of the root alone. No rows, no node.
    """
    spark = rows.sparkSession
    whole = land(distinct_sequences(rows), "distinct_sequences")
    ended = F.max(F.when(F.octet_length("seq") == 0, F.col("ends")))
    root = whole.agg(F.sum("n").alias("n"), F.min("first").alias("first"), ended.alias("ends")).first()
    if root["n"] is None:
        return spark.createDataFrame([], NODE_TYPES).select(*COLUMNS)
    zero = F.lit(0).cast("long")
    given = {"depth": F.lit(1).cast("long"), "parent": F.lit(root["first"]).cast("long"), "up": F.lit(None).cast("binary"), "children": zero, "leaves": zero, "saved": zero}
    settled, rounds = burst(whole.where(F.octet_length("seq") > 0).withColumns(given).select(*ROW), most_turns)
    parts = [land(sweep(settled), "nodes")]
    for heads in reversed(rounds):
        tops = reduce(DataFrame.unionByName, parts).where(F.col("top") & F.col("up").isNotNull())
        sums = tops.groupBy(F.col("up").alias("head")).agg(F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
        parts.append(land(sweep(heads.join(sums, "head").select(*ROW)), "nodes"))
    nodes = reduce(DataFrame.unionByName, parts)
    below = nodes.where(F.col("top") & F.col("up").isNull()).agg(F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")).first()
    top = (root["first"], 0, None, root["n"], below["children"], below["leaves"] or 1, below["saved"] or 0, root["ends"] or NO_ENDS)
    one = spark.createDataFrame([top], ", ".join(NODE_TYPES.split(", ")[:8]))
    return nodes.select(*COLUMNS).union(one.select(*COLUMNS))


def prefix_nodes(conversations: DataFrame, most_turns: int = MOST_TURNS) -> DataFrame:
    """The trie of all rebuilt conversations of ``conversations`` (conv_id, turn, role, text; other columns are ignored).

    Null roles and texts are empty, null turns come first, ties follow the tokens, repeated rows are turns of their own, and rows
    without a conv_id take no part. An empty table gives an empty table.
    """
    return trie(rebuilt(conversations), most_turns)

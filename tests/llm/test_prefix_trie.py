import hashlib
import random
import zlib

import pytest

from seqlab.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string, seq string, head string, n long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], TURNS).repartition(3)


def plain(rows):
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    whole = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole[c] = tuple(own.get(base, [])[:h] + said[h:])
    nodes = {}
    for c, said in whole.items():
        for d in range(len(said) + 1):
            nodes.setdefault(said[:d], []).append(c)
    out = {}
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        ends = ",".join(str(c) for c in sorted(c for c in members if whole[c] == path))
        out[min(members), len(path)] = (
            min(nodes[path[:-1]]) if path else None, len(members), len(kids), sum(not any(q[: len(p)] == p and len(q) > len(p) for q in below) for p in below),
            sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p), hashlib.sha256(ends.encode()).hexdigest(),
        )
    return out


def found(df):
    rows = df.collect()
    out = {(r["conv_id"], r["depth"]): tuple(r[c] for c in ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for r in rows}
    assert len(out) == len(rows)
    return out


def chats(seed, n=160):
    """Conversations with shared starts, copies, chains of one way on, and some that end inside others."""
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-300, 900), n):
        kind = rng.random()
        words = ["system prompt", *rng.choices("ab", k=rng.randint(0, 7))] if kind < 0.6 else ["same", "to", "the", "end", "of", "it", "all", "x"] if kind < 0.8 else rng.choices("pqr", k=rng.randint(1, 3))
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", w) for t, w in enumerate(words)]
    return rows


@pytest.mark.parametrize("most_turns", [1, 3, 20, 10**6])
def test_against_all_prefixes(spark, most_turns):
    rows = chats(most_turns)
    assert found(prefix_trie.prefix_nodes(frame(spark, rows), most_turns)) == plain(rows)


def test_containers_burst_by_rounds(spark):
    rows = prefix_trie.land(prefix_trie.rebuilt(frame(spark, chats(5))), "rebuilt")
    whole = prefix_trie.distinct_sequences(rows)
    zero = prefix_trie.F.lit(0).cast("long")
    given = {"depth": zero + 1, "parent": zero, "up": prefix_trie.F.lit(None).cast("binary"), "children": zero, "leaves": zero, "saved": zero}
    live = whole.where("octet_length(seq) > 0").withColumns(given).select(*prefix_trie.ROW)
    settled, rounds = prefix_trie.burst(live, 8)
    assert len(rounds) > 2 and settled.count() < live.count() + sum(r.count() for r in rounds)
    sizes = settled.withColumn("head", prefix_trie.head_of()).groupBy("head").agg({"*": "count", "seq": "max"}).collect()
    assert all(r["count(1)"] <= 8 for r in sizes)


def test_edges(spark):
    rows = [
        (1, None, None, None), (1, 2, "user", "b"), (1, 1, "user", ""), (2, 5, "user", "b"), (2, 5, "user", "b"), (None, 1, "user", "lost"),
        (100, 0, "user", "x" * 50_000), (100, 1, None, "日本語"), (101, 0, "user", "𝔘"), (199, 0, "a", "bc"), (198, 0, "ab", "c"), (-101, 0, "user", "n"), (-100, 0, "user", "m"),
    ]
    assert found(prefix_trie.prefix_nodes(frame(spark, rows))) == plain(rows)
    assert found(prefix_trie.prefix_nodes(frame(spark, rows), 1)) == plain(rows)
    empty = prefix_trie.prefix_nodes(frame(spark, rows).limit(0))
    assert empty.count() == 0 and empty.columns == prefix_trie.COLUMNS
    assert prefix_trie.prefix_nodes(frame(spark, [(None, 1, "user", "lost")])).count() == 0
    turnless = [(next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6), 0, "user", "gone")]
    assert found(prefix_trie.prefix_nodes(frame(spark, turnless))) == plain(turnless)


def test_ids_of_many_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK_BITS", 3)
    rows = spark.range(-500, 3000, 7).selectExpr("id AS conv_id", "unhex(repeat('AB', 24)) AS seq").repartition(5)
    one = prefix_trie.distinct_sequences(rows).collect()
    want = ",".join(map(str, range(-500, 3000, 7)))
    assert [(r["n"], r["first"], r["ends"]) for r in one] == [(500, -500, hashlib.sha256(want.encode()).hexdigest())]


def test_small_arrow_batches(spark):
    key, rows = "spark.sql.execution.arrow.maxRecordsPerBatch", chats(8)
    spark.conf.set(key, "3")
    try:
        assert found(prefix_trie.prefix_nodes(frame(spark, rows), 6)) == plain(rows)
    finally:
        spark.conf.unset(key)

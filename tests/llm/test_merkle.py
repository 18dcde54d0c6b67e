import hashlib
import zlib

import pytest

from seqlab.llm import merkle

DOCS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, tree long, level int, part long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "z", 1, 1, 1) for r in rows], DOCS).repartition(3)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def layers(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def plain(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append(((r[0] is not None, r[0] or 0, plain_leaf(r)), r))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: layers([k[2] for k, _ in sorted(sources[s], key=lambda x: x[0])]) for s in order}
    top = layers([trees[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for i, (_, r) in enumerate(sorted(sources[s], key=lambda x: x[0])):
            text = r[4].replace("\n", "") if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else r[4]
            proof, folded = "", plain_leaf((*r[:4], text))
            for levels, i in ((trees[s], i), (top, at)):
                for level in levels[:-1]:
                    run = level[i // 3 * 3 : i // 3 * 3 + 3]
                    proof += "".join(run[: i % 3] + run[i % 3 + 1 :])
                    folded = sha("".join([*run[: i % 3], folded, *run[i % 3 + 1 :]]))
                    i //= 3
            root = top[-1][0]
            out.append((r[0], plain_leaf(r), trees[s][-1][0], root, sha(proof), folded, folded == root))
    return sorted(out, key=repr)


def made(sizes):
    rows, at = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            at += 7
            rows.append((at % 1009, source, "en" if at % 3 else None, at, f"text {at}\nline" if at % 5 else f"text {at}"))
    return rows


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize(
    "sizes",
    [{"a": 1}, {"a": 5}, {"a": 1, None: 1, "b": 1}, {"hot": 700, "b": 9, "c": 10, "é": 1, None: 28}, {f"s{i}": 1 + i % 3 for i in range(60)}, {"x": 81, "y": 82, "z": 243}],
)
def test_against_whole_trees(spark, monkeypatch, sizes):
    rows = made(sizes)
    for levels in (1, 2, 6):
        monkeypatch.setattr(merkle, "LEVELS", levels)
        monkeypatch.setattr(merkle, "BLOCK", 3**levels)
        assert found(merkle.tampered_proofs(frame(spark, rows))) == plain(rows)


def test_edges(spark):
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (1, "a", "en", 3, "x\ny"), (1, "a", "en", 3, "x\ny"), (3, "", "", 0, ""),
        (2, "a", None, 5, "\n\n"), (5, "ä", "de", 1, "日本\n語"), (6, "z", "de", 1, "long\n" * 50_000), (-4, "Z", "de", -1, "\r\n"),
    ]
    assert found(merkle.tampered_proofs(frame(spark, rows))) == plain(rows)
    empty = merkle.tampered_proofs(frame(spark, rows).limit(0))
    assert empty.count() == 0 and empty.columns == [f.name for f in merkle.RESULT]


def test_missing_is_the_least_union():
    for n in (1, 2, 3, 4, 10, 27, 28, 100):
        nodes = layers([sha(str(i)) for i in range(n)])
        for known in ({0}, {n - 1}, set(range(n)), set(range(n // 2, n)), {0, n // 2, n - 1}):
            asked = merkle.missing(known, n)
            have = {(0, i): nodes[0][i] for i in known} | {(level, i): nodes[level][i] for level, i in asked}
            merkle.derive(have, known, n)
            assert have[len(nodes) - 1, 0] == nodes[-1][0]
            # None of them can be derived from the known, or is needed twice.
            below = lambda level, i: {j for j in range(n) if j // 3**level == i}
            assert all(not below(level, i) & known for level, i in asked) and len(set(asked)) == len(asked)


def test_proofs_and_what_is_fetched(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    rows = made({"hot": 200, **{f"s{i}": 2 for i in range(20)}})
    manifest = merkle.Manifest(frame(spark, rows))
    assert sum(len(set(r["siblings"])) for r in manifest.proofs().collect()) > 200 * 8
    asked = manifest.fetched()
    n_parts = manifest.leaves.select("part").distinct().count()
    assert asked.groupBy("part", "tree", "level", "idx").count().where("count > 1").count() == 0
    assert asked.count() <= n_parts * 2 * (merkle.levels_above(200) + merkle.levels_above(21)) and asked.where(f"tree <> {merkle.TOP} and level < 2").count() == 0
    for r in manifest.verdicts().collect():
        assert r["root"] == manifest.root


def test_numbers_follow_the_keys(spark):
    rows = spark.range(1000).selectExpr("IF(id % 3 = 0, 7, id) AS k", "IF(id % 10 = 0, NULL, 'x') AS other")
    found = [(r["at"], r["k"]) for r in merkle.numbered(rows, ["k"], "at").orderBy("at").collect()]
    assert [a for a, _ in found] == list(range(1000)) and [k for _, k in found] == sorted(k for _, k in found)

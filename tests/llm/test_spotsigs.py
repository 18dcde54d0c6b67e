import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from seqlab.llm import spotsigs


def plain_signatures(text):
    words = [w for w in re.sub(r"[\W_]+", " ", (text or "").lower()).split(" ") if w]
    stop, content, spots, held = set(spotsigs.ANCHORS), [], [], ["^"]
    for w in words:
        if w in stop:
            held.append(w)
        else:
            spots += [(a, len(content)) for a in held]
            content.append(w)
            held = []
    if held:  # anchors at the end stand before an empty word
        spots += [(a, len(content)) for a in held]
        content.append("")
    out = set()
    for anchor, at in spots:
        value = 42
        for part in [anchor, *content[at : at + 3]]:
            value = xxhash.xxh64_intdigest(part.encode(), value)
        out.add(value - (1 << 64) if value >> 63 else value)
    return out


def test_signatures(spark, odd_texts):
    texts = [t for t in odd_texts if t is None or "́" not in t] + ["The house of the old man is by a big river and", "der Mann und die Frau"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", spotsigs.signatures(F.col("t")).alias("s"))
    for r in df.collect():
        assert set(r["s"]) == plain_signatures(r["t"]) and r["s"] == sorted(set(r["s"])), r["t"]


def test_every_word_is_in_a_signature(spark, documents):
    words = "это письмо написано человеком который живёт далеко отсюда около большой реки среди старых высоких деревьев".split()
    texts = [words] + [[*words[:i], "иначе", *words[i + 1 :]] for i in range(len(words))]
    texts = [" ".join(t) for t in texts] + ["the " + " ".join(t) + " of the house" for t in texts]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(spotsigs.signatures(F.col("t"), cover=True))
    assert len({tuple(r[0]) for r in df.collect()}) == len(texts)
    docs = documents(list(enumerate([" ".join(words[:3] + words[k : k + 6]) for k in (3, 9)])))
    for r in spotsigs.edited_fingerprints(docs).collect():
        assert r["near_next"] < 0.5 and r["near_edited"] < 1 and r["signatures"] == 7
    members, links = spotsigs.similar(docs, cover=True)
    assert {r["class_id"] for r in members.collect()} == {0, 1} and links.count() == 0


@pytest.mark.parametrize("ranges", [1, 2, 5, None])
def test_edited(spark, documents, odd_texts, ranges, monkeypatch):
    rows = [(3 * i, t) for i, t in enumerate(odd_texts)] + [(3, "tie"), (3, "tie"), (None, "last")]
    if ranges:
        spark_next = spotsigs.with_next
        monkeypatch.setattr(spotsigs, "with_next", lambda docs: spark_next(docs, ranges))
    found = spotsigs.edited_fingerprints(documents(rows)).collect()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    want = []
    for k, (i, t) in enumerate(order):
        after, n = order[(k + 1) % len(order)][1], len(t) // 3
        edited = t[: len(t) - n] + after[:n]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found), key=repr) == sorted(want, key=repr)
    for r in found:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (r["near_edited"] == 1)


def test_few_rows(documents):
    assert spotsigs.edited_fingerprints(documents([])).count() == 0
    row = spotsigs.edited_fingerprints(documents([(1, "one single text")])).first()
    assert row["near_next"] == 1 and row["near_edited"] < 1


def test_jaccard(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [1, 2, 3, 5]), ([1], [1, 2, 3, 4, 5, 6]), ([], [])], "a array<long>, b array<long>")
    assert [r[0] for r in df.select(spotsigs.jaccard(F.col("a"), F.col("b"))).collect()] == [3 / 5, 1 / 6, 0]
    assert [r[0] for r in df.select(spotsigs.jaccard(F.col("a"), F.col("b"), 0.5)).collect()] == [3 / 5, 0, 0]


@pytest.mark.parametrize("threshold", [0.4, 0.8])
def test_similar(spark, folder, threshold):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    edited = docs.selectExpr("doc_id + 1000", "concat(text, ' and the end of it')")
    docs = docs.union(edited).unionByName(docs.limit(5))
    members, links = spotsigs.similar(docs, threshold)
    sets, classes = {}, {}
    for r in sorted(docs.collect()):
        sets[r["doc_id"]] = plain_signatures(r["text"])
        classes.setdefault(frozenset(sets[r["doc_id"]]), r["doc_id"])
    assert {(r["doc_id"], r["class_id"]) for r in members.collect()} == {(i, classes[frozenset(s)]) for i, s in sets.items()}
    want, heads = set(), sorted((v, set(k)) for k, v in classes.items())
    for n, (b, y) in enumerate(heads):
        want |= {(a, b) for a, x in heads[:n] if len(x & y) >= threshold * len(x | y) - 1e-12}
    assert {(r["a"], r["b"]) for r in links.collect()} == want and want
    assert spotsigs.similar(docs.limit(0), threshold)[1].count() == 0

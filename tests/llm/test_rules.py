import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from seqlab.llm import rules
from seqlab.llm.rules import Policy, Rule


def plain(text, window=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
    twice = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if twice[g] > 1 for k in range(window)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


TEXTS = [
    "a b c d e a b c d e", "x x x x x", "x x x x x x", "a b c d e f g\na b c d e f g\n\n \na b c d e f g\n", "    word", "#*$ %&| <>#",
    "one two three four five six seven eight nine ten one two three four five six seven eight nine", "\x0bv\x0cf\rr\tt", "ab " * 4000 + "end", "𝔘𝔫𝔦 ✓ né",
]


def test_measurements(documents, odd_texts):
    texts = odd_texts + TEXTS
    docs = documents([(i, t) for i, t in enumerate(texts)] + [(None, "a b"), (0, "again")])
    rows = rules.ledger(docs).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        text = "a b" if r["doc_id"] is None else "again" if r["n_words"] == 1 and r["doc_id"] == 0 else texts[r["doc_id"]]
        assert {m: r[m] for m in rules.MEASURES} == plain(text), text
    assert rules.rule_verdicts(docs.limit(0)).count() == 0


def test_equal_hashes_are_told_apart(documents, monkeypatch):
    monkeypatch.setattr(F, "hash", lambda *c: F.lit(7))
    docs = documents([(1, "a b c d e f g h i j a b c d e"), (2, "a b c d e f g h i")])
    found = {r["doc_id"]: r["n_repeat_words"] for r in rules.measured(docs).collect()}
    assert found == {1: 10, 2: 0}


def test_verdicts(documents):
    prose = " ".join(f"word{i} other{i}" for i in range(40))
    docs = documents([(1, prose), (2, "too few"), (3, prose.replace("word", "#word")), (4, "w x y z q " * 10), (5, None)])
    found = {r["doc_id"]: r for r in rules.rule_verdicts(docs).collect()}
    assert {i: (r["base_failed"], r["kept"]) for i, r in found.items()} == {1: (False, True), 2: (True, False), 3: (False, False), 4: (True, False), 5: (True, False)}
    assert found[3]["decisive"] == 4 and found[1]["decisive"] is None
    assert all(not r["base_failed"] or not r["kept"] for r in found.values())


@pytest.fixture
def entries(spark):
    rows = [("a", f) for f in (0, 0, 1, 2, 3, 4, 6, 64)] + [(None, f) for f in (5, 5, 1)]
    return spark.createDataFrame(rows, "source string, failures long")


def test_ablations(entries):
    masks = [r["failures"] for r in entries.collect()]
    for policies in (rules.POLICIES, (Policy(9, 0b100),)):
        found = {(r["version"], r["rule"]): r for r in rules.ablations(entries, policies).collect()}
        want = [(p, r) for p in policies for r in rules.RULES if p.mask >> r.bit & 1]
        assert found.keys() == {(p.version, r.name) for p, r in want}
        for p, rule in want:
            got, less = found[p.version, rule.name], p.mask & ~(1 << rule.bit)
            assert got["documents"] == len(masks)
            assert got["kept"] == sum(not m & p.mask for m in masks)
            assert got["failing"] == sum(m >> rule.bit & 1 for m in masks)
            assert got["kept_without"] == sum(not m & less for m in masks)
    by = rules.ablations(entries, by=["source"])
    assert by.agg(F.sum("documents")).first()[0] == len(masks) * sum(bin(p.mask).count("1") for p in rules.POLICIES)
    assert rules.ablations(entries.limit(0)).count() == 0


def test_rules_that_some_or_all_fail(entries):
    found = {r["source"]: (r["some"], r["every"]) for r in rules.failed_by(entries, ["source"]).collect()}
    assert found[None] == (["few_words", "short_words"], ["few_words"])
    assert found["a"][1] == [] and found["a"][0] == ["few_words", "repeated_windows", "short_words", "many_words"]


def test_bits_are_used_once(documents):
    with pytest.raises(ValueError, match="bit of its own"):
        rules.ledger(documents([(1, "x")]), (Rule(3, "a", lambda: F.lit(True)), Rule(3, "b", lambda: F.lit(True))))


def test_no_python_in_the_plan(documents):
    plan = rules.rule_verdicts(documents([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange hash", plan)


def test_a_filter_on_the_ledger_splits_a_text_once(spark, documents):
    docs = documents([(1, "some words of a long text " * 10_000)])  # quadratic if the words were split for every window
    assert rules.ledger(docs).where("failures = 2").count() == 1

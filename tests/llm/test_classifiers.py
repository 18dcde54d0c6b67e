import random
import zlib

import numpy as np
import pytest

from seqlab.llm import grams, language, toxicity

SYLLABLES = ["ka", "lo", "mi", "ne", "ru", "sta", "pe", "vor", "din", "sha"]


def prose(rng, n, extra=()):
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n)] + list(extra)
    rng.shuffle(words)
    return " ".join(words)


def test_grams_are_those_of_words():
    texts = ["Ab cd!", "", "abc", "x ab"]
    found = {n: {} for n in range(1, 5)}
    for n in found:
        for values, of in grams.hashed_grams(texts, range(n, n + 1), 24):
            for i in range(len(texts)):
                found[n][i] = sorted(values[of == i].tolist())
    plain = lambda text, n: [p[i : i + n] for w in text.lower().replace("!", " ").split() for p in [f"<{w}>"] for i in range(len(p) - n + 1)]
    for n in (3, 4):
        assert [len(found[n].get(i, [])) for i in range(4)] == [len(plain(t, n)) for t in texts]
    assert [len(found[1].get(i, [])) for i in range(4)] == [4, 0, 3, 3]
    assert len(set(found[3][0]) & set(found[3][3])) == 2  # "<ab" and "ab>"


@pytest.fixture(scope="module")
def model():
    rng = random.Random(4)
    texts = [prose(rng, rng.randint(5, 200)) for _ in range(300)]
    labels = np.array([0] * 300 + [1] * 120)
    texts += [prose(rng, n, rng.choices(["scumbag", "vilewretch"], k=max(1, n // 30))) for n in (rng.randint(5, 200) for _ in range(120))]
    return toxicity.train(texts, labels)


def test_unseen_texts_and_misspellings(model):
    rng = random.Random(8)
    assert (model.score([prose(rng, 60) for _ in range(200)]) < 0.5).mean() > 0.99
    for word in ("scumbag", "vilewretch", "scumbagg", "vilewretchh"):
        assert (model.score([prose(rng, 60, [word] * 3) for _ in range(50)]) >= 0.5).mean() > 0.95, word


def test_whole_texts_count(model):
    rng = random.Random(2)
    clean = prose(rng, 30_000)
    assert model.score([clean + " scumbag" * 1500])[0] >= 0.5 > model.score([clean])[0]
    assert model.score(["a b " * 40_000, ""]).shape == (2,)


def test_no_evidence_is_the_share_of_labels_and_not_toxic(model):
    assert model.score(["", "???"]) == pytest.approx([120 / 420] * 2)
    assert toxicity.train([], np.array([])).score(["x"])[0] < 0.01
    assert toxicity.train(["abc"], np.array([1])).score(["x", ""]).tolist() == pytest.approx([toxicity.MOST_PRIOR] * 2)
    for labels in ([0, 1], [0, 0, 1], [0, 1, 0, 0, 1, 0]):
        few = toxicity.train([f"text number {i}" for i in range(len(labels))], np.array(labels))
        assert few.score(["text number 1", "", "other"]) == pytest.approx([min(np.mean(labels), toxicity.MOST_PRIOR)] * 3)
    assert toxicity.train(["a b", "c d"], np.array([0, 1]), share=0.03).score([""])[0] == pytest.approx(0.03)


def test_labels_that_texts_do_not_tell_apart():
    rng = random.Random(5)
    texts = [prose(rng, 60) for _ in range(400)]
    blind = toxicity.train(texts, np.array([i % 10 == 0 for i in range(400)]))
    assert (blind.score([prose(rng, 60) for _ in range(200)]) < 0.5).mean() > 0.97


def test_labels_that_differ_by_a_factor():
    rng, texts, labels = random.Random(9), [], []
    for i in range(1200):
        toxic = i % 3 == 0
        texts.append(prose(rng, 40, ["grubworm"] * 4 if rng.random() < (0.6 if toxic else 0.3) else []))
        labels.append(int(toxic))
    model = toxicity.train(texts, np.array(labels))
    with_word, without = (model.score([prose(rng, 40, extra) for _ in range(100)]).mean() for extra in (["grubworm"] * 4, []))
    assert without < 0.32 and 0.4 < with_word and model.score([""])[0] == pytest.approx(1 / 3)


def test_held_out_documents_of_the_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    found = toxicity.score(docs, model).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    hits = sum(r["predicted"] and r["toxic"] for r in found)
    assert (model.value != 0).sum() > 1000
    assert hits >= 0.9 * sum(r["toxic"] for r in found) and hits >= 0.9 * sum(r["predicted"] for r in found)


def test_scores(spark, documents, odd_texts):
    docs = documents([(i, t) for i, t in enumerate(odd_texts)] + [(None, "z"), (1, "")])
    labels = spark.createDataFrame([(1, 1, 1), (1, None, 0), (None, 1, 1), (2, 1, None), (900, 0, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(rows) == len(odd_texts) + 2
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    empty = docs.limit(0)
    assert toxicity.score(empty, toxicity.fit(empty, labels)).count() == 0


def test_a_repeated_id_is_sampled_once(spark, documents, monkeypatch):
    rows = [(1, f"text {i}") for i in range(40)] + [(1, "long " * 9000), (2, "two"), (3, "three")]
    docs, seen = documents(rows), []
    assert not any(zlib.crc32(str(i).encode()) % 5 == 0 for i in (1, 2, 3))
    monkeypatch.setattr(toxicity, "train", lambda texts, labels, share: seen.append(sorted(map(len, texts.to_pylist()))))
    monkeypatch.setattr(language, "train", lambda rows, langs: seen.append(len(langs)))
    toxicity.fit(docs, spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int"))
    language.fit(docs)
    assert len(seen[0]) == 3 and max(seen[0]) < 10 and seen[1] == 3


def test_held_out_labels_change_nothing(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    other = labels.selectExpr("doc_id", "quality", "if(crc32(string(doc_id)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    a, b = (toxicity.fit(docs, x) for x in (labels, other))
    assert a.bias == b.bias and (a.value == b.value).all()


def test_toxic_documents_go(documents, model):
    rng = random.Random(6)
    docs = documents([(1, prose(rng, 80)), (2, prose(rng, 80, ["scumbag"] * 5)), (3, None)])
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


@pytest.mark.parametrize("classes", [1, 2, 3, 5, 7, 9, 30])
def test_codewords(classes):
    code = language.codewords(classes)
    assert len(code) == classes and set(np.unique(code)) <= {-1, 1}
    apart = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
    assert min(apart, default=1) >= (2 ** (classes - 2) if 2 <= classes <= 7 else 1)


def test_language_of_held_out_documents(spark, folder):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(docs, language.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 100 and np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.97


def test_languages(spark, documents, odd_texts):
    docs = documents([(i, t) for i, t in enumerate(odd_texts)] + [(1, ""), (None, "x")])
    model = language.fit(docs)
    assert model.names == ["en"]
    for r in language.identify(docs, model).collect():
        if r["doc_id"] is not None:
            text = odd_texts[r["doc_id"]]
            assert r["lang_pred"] == ("en" if any(c.isalpha() for c in text or "") else "und")
        assert 0 <= r["score"] <= 1
    kept = language.drop_unknown(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(any(c.isalpha() for c in t or "") for t in odd_texts) + 1
    none = language.fit(docs.limit(0))
    assert {r["lang_pred"] for r in language.identify(docs, none).collect()} == {"und"}
    assert language.identify(docs.limit(0), model).count() == 0


def test_the_nearest_codeword_wins():
    code = language.codewords(4)
    model = language.Language(list("abcd"), code, np.zeros((1 << language.BITS, code.shape[1]), np.float32), np.zeros(code.shape[1]))
    for i, name in enumerate("abcd"):
        one = language.Language(model.names, code, model.weight, code[i] * 5.0 * np.where(np.arange(code.shape[1]) == 0, -1, 1))  # one bit is wrong
        names, scores, unsure = one.predict(["text"])
        assert names[0] == name and scores[0] > 0.9 and not unsure[0]
    names, scores, unsure = model.predict(["text"])
    assert unsure[0] and scores[0] == pytest.approx(0.25)


def test_texts_far_from_every_codeword_go(spark, documents):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs)
    texts = ["Это русский текст о погоде " * 5, "我们在学习中文句子" * 8, "Καλημέρα κόσμε " * 5, "Да", "A.", "12 34", None]
    known = {r["doc_id"] for r in language.drop_unknown(documents(list(enumerate(texts))), model).select("doc_id").collect()}
    assert known == {3, 4}
    held = docs.where(toxicity.held_out())
    kept, letters = language.drop_unknown(held, model).count(), held.where(r"text rlike '\\p{L}'").count()
    assert letters - kept <= 0.003 * letters


def test_sample_of_languages(spark, monkeypatch):
    rows = [(i, "en") for i in range(4000)] + [(i, "de") for i in range(5000, 5030)] + [(9000, "fr")] * 50
    known = spark.createDataFrame(rows, "doc_id long, lang string").repartition(5)
    found = [tuple(r) for r in language.sampled_ids(known, 300, 100).collect()]
    by = {x: {i for i, lang in found if lang == x} for x in ("en", "de", "fr")}
    assert len(found) == len(set(found)) == 131 and [len(by[x]) for x in ("en", "de", "fr")] == [100, 30, 1]
    assert len(language.sampled_ids(known, 60, 100).collect()) == 60
    with pytest.raises(ValueError, match="3 languages"):
        language.sampled_ids(known, 2, 100)


def test_languages_of_long_documents_are_learned(spark):
    rows = [(i, "the and of it " * 3000, "en") for i in range(20)] + [(100 + i, "le la les des que " * 3000, "fr") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    assert {(r["doc_id"] >= 100, r["lang_pred"]) for r in language.identify(docs, language.fit(docs)).collect()} == {(False, "en"), (True, "fr")}

import hashlib

from pyspark.sql import functions as F

from seqlab.llm import chat

MESSAGES = "tree string, node string, parent string, role string, text string, score double, leaf string, position int"


def digests(rows):
    rows = [(i, t, r or "", x or "") for i, t, r, x in rows]
    out = {}
    for i in {r[0] for r in rows}:
        turns = sorted(r[1:] for r in rows if r[0] == i)
        told = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        learned = "".join(x for _, r, x in turns if r == "assistant")
        out[i] = (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


def found(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.conversation_digests(df).collect()}


def test_conversations(spark, odd_texts):
    rows = [(1, i, ["user", "assistant", "system", None, "a]b<"][i % 5], t) for i, t in enumerate(odd_texts)]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]&amp;lt; <s>[user]")]
    rows += [(2, 0, "user", "tie"), (2, 0, "assistant", "tie"), (2, 0, "assistant", "tie"), (None, 1, "user", "no id")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, node long, formatted string")
    assert found(df) == digests(rows)
    assert chat.conversation_digests(df.limit(0)).count() == 0


def test_long_conversation(spark):
    rows = [(5, i, "assistant" if i % 2 else "user", f"[{i}]") for i in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    assert found(df) == digests(rows)


def test_trees(spark):
    rows = [
        ("t", "a", None, "user", "hi", 1.0), ("t", "b", "a", "assistant", "x", 5.0), ("t", "c", "a", "assistant", "y", 0.0), ("t", "d", "c", "user", "z", 9.0),
        ("t", "f", "b", "user", "w", 0.0), ("u", "e", "nowhere", "user", None, None), ("v", "g", "h", "user", "", 1.0), ("v", "h", "g", "user", "", 1.0),
        ("w", "s", "s", "user", "self", 1.0), ("t", "b", "a", "assistant", "x", 5.0), ("t", None, "a", "user", "?", 1.0),
    ]
    df = spark.createDataFrame([(*r, "l", 0) for r in rows], MESSAGES)
    paths = {}
    for r in chat.reply_paths(df, None).collect():
        paths.setdefault(r["leaf"], {})[r["position"]] = r["node"]
    assert paths == {"d": {0: "a", 1: "c", 2: "d"}, "f": {0: "a", 1: "b", 2: "f"}, "e": {0: "e"}, "s": {0: "s"}}
    best = {r["tree"]: (r["leaf"], r["formatted"]) for r in chat.format_trees(df, 1).collect()}
    assert best["t"] == ("d", "<s>[user]hi</s><s>[assistant]y</s><s>[user]z</s>") and best["u"] == ("e", "<s>[user]</s>")
    assert chat.format_trees(df.limit(0)).count() == 0


def test_loss_spans(spark):
    df = spark.createDataFrame([("t", "a", None, "user", "q<", 0.0, "", 0), ("t", "b", "a", "assistant", "r[é", 0.0, "", 0)], MESSAGES)
    row = chat.format_trees(df).first()
    assert [row["formatted"][s["start"] : s["start"] + s["length"]] for s in row["loss"]] == ["r&lb;é"]


def test_escapes_are_reversible(spark, odd_texts):
    texts = [t or "" for t in odd_texts] + ["&lt;", "&amp;lt;", "<[&]>", "&&lb;;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u"))
    for r in df.collect():
        assert r["u"] == r["t"] and not set("<[]") & set(r["e"])

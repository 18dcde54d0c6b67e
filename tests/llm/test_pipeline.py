import numpy as np

import corpus_pipeline
from seqlab.llm import language, simhash, toxicity
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_tokens import check_packing


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scores = model.score(list(rows.values()))
    want = [i for i, s in zip(rows, scores, strict=True) if s < 0.5]
    clean = corpus_pipeline.drop_toxic(spark, docs, folder)
    assert clean.columns == docs.columns and sorted(r["doc_id"] for r in clean.select("doc_id").collect()) == sorted(want)

    known = corpus_pipeline.drop_unknown_language(spark, clean, folder)
    want = sorted(i for i in want if any(c.isalpha() for c in rows[i]))
    assert known.columns == docs.columns and sorted(r["doc_id"] for r in known.select("doc_id").collect()) == want

    single = corpus_pipeline.drop_near_duplicates(spark, known, folder)
    label = plain_components([plain_fingerprint(rows[i]) for i in want])
    want = sorted({want[g] for g in label})
    assert single.columns == docs.columns and sorted(r["doc_id"] for r in single.select("doc_id").collect()) == want

    packed = corpus_pipeline.run(spark, folder).collect()
    assert sorted({r["doc_id"] for r in packed}) == want
    n = check_packing(packed, 1024)
    assert n <= np.ceil(sum(r["length"] for r in packed) / 1024) * 1.02 + 1


def test_empty_documents(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 4 and corpus_pipeline.ORACLE_SQL is None
    assert simhash and language


def test_queries(spark, folder):
    import __spark_entry__

    names = [*(f"op{n}_" for n in range(1, 14)), "pipeline"]
    assert all(sum(q.startswith(n) for q in __spark_entry__.queries()) == 1 for n in names)

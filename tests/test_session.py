import random

import pytest
from pyspark.sql import functions as F

from seqlab import session
from seqlab.operators import screen
from seqlab.operators.hits import best_hit
from seqlab.operators.screen import encoded_kmers
from seqlab.operators.sheet import content_digest


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class Fake:
    def __init__(self, **settings):
        self.conf = Conf({k.replace("_", "."): v for k, v in settings.items()})


@pytest.mark.parametrize("master", [None, "yarn", "local-cluster[2,1,1024]", "spark://host:7077"])
def test_landing_fails_closed(master):
    settings = {"spark_master": master} if master else {}
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Fake(**settings))
    assert session.shared_folder(Fake(**settings, **{"spark_checkpoint_dir": "hdfs://x/y/"})) == "hdfs://x/y"


def test_release(spark, tmp_path):
    landed = session.land(spark.range(3).toDF("x"), "kept")
    assert landed.count() == 3
    path = landed.inputFiles()[0]
    session.release(spark)
    from pathlib import Path

    assert not Path(path.removeprefix("file://")).exists()


def test_hits_without_a_score(spark):
    rows = [("a", 5.0, "x"), ("a", None, "y"), ("a", 9.0, "z"), ("b", None, "w")]
    found = best_hit(spark.createDataFrame(rows, "locus string, score double, contig string"), "locus", "score", ["contig"])
    assert [tuple(r) for r in found.collect()] == [("a", 9.0, "z")]


def test_encoded_kmers(spark):
    df = spark.createDataFrame([("s", "ACGTACGTNACGA"), ("s", "ACG")], "id string, t string")
    found = {r["kmer"] for r in encoded_kmers(df, "t", 4, "id").collect()}
    code = lambda k: int("".join(str("ACGT".index(c)) for c in k), 4)
    assert found == {code(k) for k in ("ACGT", "CGTA", "GTAC", "TACG", "ACGA")}
    with pytest.raises(ValueError):
        encoded_kmers(df, "t", 32, "id")


def test_short_codes_are_sent_once_by_a_task(spark, monkeypatch):
    rng = random.Random(5)
    texts = [(rng.choice("ab"), "".join(rng.choices("ACGTACGTNé日", k=rng.randint(0, 4000)))) for _ in range(200)]
    df = spark.createDataFrame([*texts, (None, "ACGTT"), ("a", None), ("c", "ACé")], "id string, t string").repartition(2)
    code = lambda k: int("".join(str("ACGT".index(c)) for c in k), 4)
    words = [(s, t[i : i + 4]) for s, t in [*texts, (None, "ACGTT")] for i in range(len(t) - 3)]
    want = {(s, code(w)) for s, w in words if set(w) <= set("ACGT")}
    for held in (screen.HELD, 90):
        monkeypatch.setattr(screen, "HELD", held)
        found = [tuple(r) for r in encoded_kmers(df, "t", 4, "id").collect()]
        assert set(found) == want and len(found) == len(want)
    assert {r["kmer"] for r in encoded_kmers(df, "t", 4).collect()} == {kmer for _, kmer in want}
    plan = encoded_kmers(df, "t", 4, "id")._jdf.queryExecution().executedPlan().toString()
    assert "minimizer" not in plan and "regexp_extract_all" not in plan
    long = spark.createDataFrame([("a", "ACGT" * 9 + "CA"), ("a", "A" * 31)], "id string, t string")
    w = ["ACGT" * 9 + "CA", "A" * 31]
    assert {r["kmer"] for r in encoded_kmers(long, "t", 31, "id").collect()} == {code(t[i : i + 31]) for t in w for i in range(len(t) - 30)}


def test_equal_pieces_do_not_cancel_out(spark):
    rows = [("a", 1, "AC"), ("b", 1, "AC"), ("b", 1, "AC"), ("b", 1, "AC"), ("c", 1, "AC"), ("c", 1, "GT"), ("c", 1, "GT")]
    found = content_digest(spark.createDataFrame(rows, "s string, i int, t string"), "s", "i", "t")
    assert found.select(F.count_distinct("digest")).first()[0] == 3

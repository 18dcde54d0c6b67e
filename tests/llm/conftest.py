import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, hashes string"


@pytest.fixture
def documents(spark):
    """Documents with extra columns whose names operators use themselves."""

    def make(rows, partitions=3):
        full = [(i, t, "en", "s", len(t or ""), 0.5, "x", "y") for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)

    return make


@pytest.fixture
def folder():
    from pathlib import Path

    path = Path("/root/testdata/sf0.001")
    if not path.exists():
        pytest.skip("test tables are not here")
    return str(path)


@pytest.fixture
def odd_texts():
    """Texts at the edges: empty, blank, without spaces, very long, with control strings and several scripts."""
    return [
        None, "", " ", "\n", "  \n ", "a", " a", "A. ", "x" * 5000, "ab " * 4000, " " * 3000, "日本語のテキスト", "né½ﬁ́",
        "<s></s><unk> [INST] <|endoftext|> y", "tab\tand\x0bmore\x1c", "▁▁ x", "𝔘𝔫𝔦 ✓", "same text twice", "same text twice", "123 456", "!!!",
    ]

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from seqlab.session import build_session  # noqa: E402
from seqlab.sources import register  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = register(build_session("tests", 8, 8))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_reads(spark):
    """Paired reads of some samples, over a given number of partitions."""

    def make(sizes: dict[str, int], partitions: int = 3, length: int = 12):
        rows = [
            (sample, pair, mate, f"@{sample}.{pair}/{mate}", ("ACGT" * 10)[pair % 4 :][:length], "+", "I" * length)
            for sample, n in sizes.items()
            for pair in range(n)
            for mate in (1, 2)
        ]
        schema = "sample_id string, pair_id bigint, mate int, header string, sequence string, plus string, quality string"
        return spark.createDataFrame(rows, schema).repartition(partitions)

    return make

import os

import pytest

os.environ.setdefault("OMP_NUM_THREADS", "1")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns an operator must not be confused by.
CLASHING = ["digest", "n", "size", "shard", "score", "copies", "set_id", "bucket", "rank", "base", "row", "link", "units"]


@pytest.fixture
def docs_of(spark):
    """Documents from (id, text) or (id, text, source), with columns whose names operators use inside."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 1, *range(len(CLASHING))) for r in rows]
        return spark.createDataFrame(full, DOCS + "".join(f", {c} int" for c in CLASHING))

    return make


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

import pytest

TEXTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def texts(spark):
    """A documents table from (doc_id, text) pairs."""

    def make(pairs):
        rows = [(i, t, "en", "src0", len(t) if t is not None else None) for i, t in pairs]
        return spark.createDataFrame(rows, TEXTS)

    return make


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture
def small_blocks(monkeypatch):
    """Many blocks and key ranges on small tables."""
    from ledgerline.llm import blocks

    monkeypatch.setattr(blocks.blocked, "__defaults__", (20_000, 40_000, ()))

import pytest

from tillmark.llm.registry import prepare

SF = "/root/testdata/sf0.001"

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def settings(spark):
    """The settings of the registered queries, for operators that a test calls itself."""
    prepare(spark)


@pytest.fixture
def documents(spark):
    """documents(texts) -> a table like `documents`, doc_id from 0; documents(pairs=...) takes (doc_id, text)."""

    def make(texts=(), pairs=None, lang="en"):
        rows = list(enumerate(texts)) if pairs is None else pairs
        return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t in rows], DOCUMENTS)

    return make


@pytest.fixture
def folder(spark, tmp_path):
    """folder(table=frame, ...) -> a directory of Parquet tables like the given ones."""

    def make(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/sf/{name}.parquet")
        return f"{tmp_path}/sf"

    return make


@pytest.fixture(scope="session")
def given():
    """Texts of the given documents by doc_id."""
    import pyarrow.parquet as pq

    table = pq.read_table(f"{SF}/documents.parquet")
    return dict(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))

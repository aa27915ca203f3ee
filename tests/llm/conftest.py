import duckdb
import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents():
    return duckdb.connect().execute(f"SELECT doc_id, text, lang, source FROM '{DATA}/documents.parquet' ORDER BY 1").fetchall()


@pytest.fixture
def make_docs(spark):
    def make(rows):
        """rows of (doc_id, text); clashing column names stand beside them."""
        data = [(i, t, "x", 1) for i, t in rows]
        return spark.createDataFrame(data, "doc_id long, text string, band string, component int")

    return make

import pytest

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    """The smallest documents as (doc_id, text) rows."""
    return [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture
def frame(spark):
    """Rows of (doc_id, text) over several partitions, with extra columns whose names clash."""
    def make(rows, schema="doc_id long, text string"):
        df = spark.createDataFrame(rows, schema).repartition(3)
        for c in ("fp", "n", "a", "c", "start", "spans", "u", "v", "window", "items"):
            df = df.selectExpr("*", f"'x' AS {c}")
        return df
    return make

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (id, text[, lang]) rows over several partitions, with columns
    whose names the operators use inside."""
    from pyspark.sql import functions as F

    def make(rows, partitions=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(partitions)
        for name in ("kept", "row", "base", "digest", "n", "run", "part", "offset"):
            df = df.withColumn(name, F.lit("clash"))
        return df

    return make


@pytest.fixture(scope="session")
def sample(spark):
    """doc_id, text, lang of the driver's smallest table."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return [(r.doc_id, r.text, r.lang) for r in df.select("doc_id", "text", "lang").collect()]

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text[, source]) rows, with a further
    column whose name clashes with names used inside the operators."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 1, "x") for r in rows]
        return spark.createDataFrame(full, DOCS + ", key string")
    return make


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """Write tables into a folder like the given ones."""
    def make(**frames):
        at = tmp_path_factory.mktemp("tables")
        for name, df in frames.items():
            df.write.parquet(f"{at}/{name}.parquet")
        return str(at)
    return make

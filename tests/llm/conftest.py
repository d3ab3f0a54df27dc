import pytest

from ledgerlake.llm.queries import vocabulary


@pytest.fixture(scope="session")
def byte_bpe():
    return vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def word_bpe():
    return vocabulary("word_bpe_49k.json")


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text) or (id, text, lang, source) rows."""
    def make(rows, extra: str = ""):
        full = [(*r, *(("en", "s0")[len(r) - 2:] if len(r) < 4 else ()), len(r[1]) if r[1] is not None else None)
                for r in rows]
        df = spark.createDataFrame(full, DOC_SCHEMA)
        for column in extra.split():
            df = df.withColumn(column, df["doc_id"])
        return df
    return make

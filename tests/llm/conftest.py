import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h string, k int, f0 string, size string, shard string"


@pytest.fixture
def docs(spark):
    """Builds a documents table from (doc_id, text) or (doc_id, text, lang), with columns whose names operators use too."""

    def build(rows):
        rows = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None, "h", 1, "f", "z", "q") for r in rows]
        return spark.createDataFrame(rows, DOCS)

    return build


@pytest.fixture
def folder(spark, tmp_path, docs):
    """A folder of tables as the registered queries read it."""

    def build(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return build


#: Texts that every operator must stand: null, empty, blank, one word, ties, and a very long one without a break.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "x"), (4, "x"), (None, "x"), (5, "ab" * 60_000), (6, "a b c " * 4000), (7, "\U0001f600 é\x00z")]

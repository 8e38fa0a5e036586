import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties, and clashing extra columns."""
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen. "
    rows = [
        (1, base * 3, "en", "a", 1),
        (2, base * 3, "en", "a", 1),
        (2, base * 3, "en", "a", 1),
        (3, (base * 3).replace("seven", "SEVEN"), None, None, 1),
        (4, None, "en", "a", None),
        (5, "", "en", None, 0),
        (6, " \n\t ", None, "b", 0),
        (7, "word", "en", "b", 4),
        (8, "word", "de", "b", 4),
        (None, base * 3, "en", "a", 1),
        (9, "long " * 60_000 + "Ende äöü 😀.", "de", "a", 1),
        (10, "x" * 200_000, None, "a", 1),
        (11, "1234567890 !!! ??? ... 😀", "fr", "a", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names = ["id", "row", "tk", "n", "kept", "component_id", "h", "rk", "spans", "pii", "llr", "host", "p", "tokens", "y", "_n"]
    for name in names:
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit("clash"))
    return df

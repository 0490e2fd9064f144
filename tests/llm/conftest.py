import pyarrow.parquet as pq
import pytest

CLASHING = ["row", "block", "bucket", "kept", "key", "n", "size", "lang2", "n_lines", "ids", "offset", "u", "v", "word", "__extra"]
LONG = "\n".join(f"line number {i} of a very long document." for i in range(30_000))


def with_clashes(df):
    """The table with columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    for name in CLASHING:
        if name not in df.columns:
            df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and ids, clashing columns."""
    rows = [
        (1, "The same words\nstand here, more than twenty of them."), (2, None), (3, ""), (None, "An orphan without any id."),
        (None, None), (4, "repeated row"), (4, "repeated row"), (5, "repeated  ROW"), (6, LONG), (7, " \t\n\x0b\x0c\r "),
        (8, "x"), (4, "another text under a repeated id"),
    ]
    return with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))


@pytest.fixture(scope="session")
def odd_rows(odd):
    return [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def texts(sf_dir):
    table = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    return dict(zip(table["doc_id"], table["text"], strict=True))


def fold_ascii(text):
    return text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))

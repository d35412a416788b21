import pyarrow.dataset as ds
import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, th string, h int, score string, part int"

LONG = " ".join(f"word{i % 9_000} of the long text," for i in range(12_000)) + "\n" + "x" * 50_000


def row(doc_id, text, extra=None):
    return (doc_id, text, extra, extra, None if text is None else len(text), extra, extra, None, extra, None)


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null, empty, blank, repeated, very long and shared texts, null ids, and columns with clashing names."""
    line = "this line of text is long enough to count as one that is compared here"
    rows = [
        row(1, None), row(2, ""), row(3, " \n\t "), row(4, "one"), row(5, "One"), row(6, line, "a"), row(6, line, "a"),
        row(7, line + "\n" + line), row(None, line), row(None, None), row(8, LONG), row(9, LONG + " end"), row(10, "a b\x0bc\x1fd  e"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(sf_dir):
    """The documents of the test tables as Python rows, by id."""
    return sorted(ds.dataset(f"{sf_dir}/documents.parquet").to_table(columns=["doc_id", "text"]).to_pylist(), key=lambda r: r["doc_id"])

import duckdb
import pytest

TABLES = "documents embeddings pages benchmark labels conversations".split()

DOCS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, row_id string, size string, "
    "node string, places string, finish string, doc string, `end` string"
)


@pytest.fixture(scope="session")
def con(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


@pytest.fixture(scope="session")
def documents(con):
    return con.execute("SELECT doc_id, text, source FROM documents ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def make(spark):
    """Documents with extra columns whose names operators use themselves."""

    def build(*rows):
        full = [(i, t, "en", s, None if t is None else len(t), *["x"] * 7) for i, t, s in rows]
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture(scope="session")
def edge(make):
    """Nulls in every column, empty, blank and long texts, ties and repeated rows."""
    long = "word%d " * 3000 % tuple(range(3000)) + "x" * 70000
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, long, "b"), (None, "some text", None),
            (None, None, None), (6, "same text here", "b"), (6, "same text here", "b"), (7, "same text here", "c")]
    return rows, make(*rows)

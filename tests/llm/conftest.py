import pytest

SF = "/root/testdata/sf0.001"

#: Ids, texts and a column whose name clashes with working columns: nulls, empty and odd texts, repeated rows.
ROWS = [(1, "The quick brown fox jumps. " * 30, "a"), (2, "", "b"), (None, None, None), (3, None, "c"),
        (4, "The quick brown fox jumps. " * 30, "d"), (4, "The quick brown fox jumps. " * 30, "d"),
        (5, "x" * 3000 + " ÄÖÜ  İ \n\n \t" + "ab" * 400, "e"), (6, "one two three\nfour", "f"),
        (7, "password: hunter2hunter2 AKIA" + "Q" * 16 + " " + "0f" * 20 + " a@b.example.com", "g")]
SCHEMA = "doc_id long, text string, spans string"


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(ROWS, SCHEMA).coalesce(2)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def raw(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")

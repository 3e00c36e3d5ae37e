"""Tables and fixtures of these tests."""

import os

import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LONG = "word mail a@b.example.com " * 4000 + "x" * 5000

# Null and empty texts, a long one, a repeated row, a repeated id, a null id, clashing extra columns.
ODD = [
    (1, "plain words stand here in a row", "x", 1, 0, 0.5),
    (1, "plain words stand here in a row", "x", 1, 0, 0.5),
    (2, None, None, None, None, None),
    (3, "", "x", 1, 1, 0.5),
    (4, LONG, "x", 1, 1, 0.5),
    (4, "another text of this id", "x", 1, 1, 0.5),
    (None, "no id, but words", "x", 1, 1, 0.5),
    (7, " \t\n ", "x", 1, 1, 0.5),
    (8, "Plain words stand here in a row", "x", 1, 1, 0.5),
]
ODD_SCHEMA = "doc_id bigint, text string, pii string, _key int, _fp int, severity double"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, ODD_SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="session")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}

import pathlib

import pytest

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def sf_dir():
    if not pathlib.Path(FOLDER).exists():
        pytest.skip("test tables not present")
    return FOLDER


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs."""
    def make(pairs, partitions=3):
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA).repartition(partitions) if rows else spark.createDataFrame([], SCHEMA)

    return make

import os

import pytest

from clickmill.llm.common import importable

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or whole rows."""
    importable(spark)

    def made(*rows, schema=DOCUMENTS):
        filled = [(r[0], r[1], "en", "src0", len(r[1] or "")) if len(r) == 2 else r for r in rows]
        return spark.createDataFrame(filled, schema)

    return made


@pytest.fixture(scope="session")
def sf_dir():
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    return folder

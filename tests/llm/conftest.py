from __future__ import annotations

import pytest
from agrolume.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(4, shuffle_partitions=4)


@pytest.fixture
def docs_of(spark):
    """Documents from texts, doc_id counting from 0, with an extra column of a clashing name."""

    def make(texts, ids=None):
        rows = [(i, t, None, "s", None if t is None else len(t), k % 3) for k, (i, t) in enumerate( zip(ids or range(len(texts)), texts, strict=True))]
        return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, path bigint").repartition(3)

    return make

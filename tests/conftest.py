from __future__ import annotations

import pytest

from textloom.operators.postings import stack_fields
from textloom.plans.index import build_index
from textloom.session import local_session, scratch_path


@pytest.fixture(scope="session")
def spark():
    session = local_session("*")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(0, "red red blue"), (1, "blue green"), (2, "green green green"), (3, "")]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING")


@pytest.fixture(scope="session")
def index(spark, docs):
    return build_index(stack_fields(docs, ["text"]), scratch_path(spark, "micro"))


@pytest.fixture(scope="session")
def queries(spark):
    rows = [(1, "Red (blue"), (2, "absent"), (3, "green")]
    return spark.createDataFrame(rows, "query_id BIGINT, text STRING")


@pytest.fixture(scope="session")
def qrels(spark):
    return spark.createDataFrame([(1, 0), (1, 2), (3, 1)], "query_id BIGINT, doc_id BIGINT")


@pytest.fixture
def new_path(spark):
    return lambda name: scratch_path(spark, name)

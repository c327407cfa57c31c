import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from quire.session import build_session, checkpoint_dir  # noqa: E402

FIXTURE_TEXTS = [
    "apple banana apple cherry",
    "banana cherry date",
    "apple date date elder",
    "cherry elder fig",
    "apple banana",
]
# Links file and citations file of the hand fixture (citations = transpose).
FIXTURE_LINKS = ["0->1,2", "1->2", "2->0", "3->2", "4->"]
FIXTURE_CITATIONS = ["0->2", "1->0", "2->0,1,3", "3->", "4->"]


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", app="quire-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def fixture_docs(spark):
    rows = [(i, f"www.example.edu%%d{i}.html", t) for i, t in enumerate(FIXTURE_TEXTS)]
    return spark.createDataFrame(rows, "doc_id bigint, path string, text string")


@pytest.fixture(scope="session")
def fixture_queries(spark):
    qs = ["apple", "apple banana", "fig", "Apple kiwi"]
    return spark.createDataFrame(list(enumerate(qs)), "query_id bigint, query string")

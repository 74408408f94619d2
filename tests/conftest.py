import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from topic_tables.session import local_session
    s = local_session(os.environ.get("TEST_CORES", "*"), 8, app="topic_tables_tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def golden(spark):
    """The 4-document fixture (names repeat on purpose)."""
    from topic_tables import build_vocab, to_bags
    docs = spark.createDataFrame(
        [(0, "10027839", ["a", "b", "a"]), (1, "10343751", ["x", "y", "y", "z"]),
         (2, "1034", ["a", "z", "x", "n"]), (3, "1034", ["a", "z", "x", "n"])],
        "row_id bigint, name string, tokens array<string>")
    vocab = build_vocab(docs, 0)
    bags = to_bags(docs, vocab)
    return docs, vocab, bags

import random

import pytest

from tests.conftest import SF_SMALL

LONG = " ".join(f"w{i * i % 9973}" for i in range(60_000))     # some 350,000 characters


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text): nulls, empty and blank texts, a very long one, ties and repeated rows."""
    rnd = random.Random(5)
    words = lambda n: " ".join(rnd.choice("abcdefghijklmnop") * rnd.randint(1, 6) for _ in range(n))
    passage = words(80)
    rows = [(1, None), (2, ""), (3, " \t\n\x0b "), (None, None), (None, "one two"), (4, LONG), (5, "Ünïcode   日本語 \U0001f600 x"),
            (6, passage), (7, passage), (7, passage), (8, words(30) + ". " + passage + " " + words(30)), (None, passage),
            (9, "aa " * 400), (10, "b" * 700), (11, "it's we've  \r\n\r\n\tx\x1c\x1fy"), (12, "Released under the MIT License."), (12, "one two")]
    rows += [(100 + i, words(rnd.randint(1, 90))) for i in range(25)]
    return rows


@pytest.fixture(scope="session")
def edges(spark, edge_rows):
    """The edge rows with further columns, some named like those the operators make."""
    rows = [(i, t, "x", "s", None, 1, "r", 2, 3, 4, "k") for i, t in edge_rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key long, row string, "
                                       "size int, n_words long, failed int, `odd name` string").repartition(3).cache()


@pytest.fixture(scope="session")
def empty(edges):
    return edges.where("1 = 0")

import os

import pytest

#: Python workers import the operators from here.
os.environ["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))) + ":" + os.environ.get("PYTHONPATH", "")

SF_DIR = "/root/testdata/sf0.001"

ODD = [
    (1, "alpha beta gamma delta epsilon zeta"),
    (1, "alpha beta gamma delta epsilon zeta"),
    (2, None),
    (3, ""),
    (None, "alpha beta gamma delta epsilon zeta"),
    (4, "  \n \n"),
    (5, "word " * 30_000),
    (6, "eins zwei\neins zwei\ndrei"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names operators might use themselves."""
    rows = [(i, t, "en", "s", 0, n) for n, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")

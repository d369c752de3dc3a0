import os

import pytest
from pyspark.sql import Row

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(DATA):
        pytest.skip("test data not present")
    return DATA


HARD_TEXTS = [
    None, "", " ", "\n\n \t", "one", "one two three four", "Password: hunter22 token=abc secret = 'xyz123456'",
    "a b c a b c a b c", "AKIA" + "A1" * 10 + " AKIAshort AKIAAB", "x" * 3 + " " + "0123456789abcdef" * 3,
    "Ünïcödé ÉCLAIR 漢字 😀 text with — signs", "word " * 20000, "😀" * 300 + " end",
    "password password: token = abcdefgh api_key='0123456789abcdef01234567'", "line\nline\nline\n other\nother",
    " ".join(f"w{k}" for k in range(200)), " ".join(f"w{k}" for k in range(200)),
    " ".join(f"w{k}" for k in range(199)) + " changed", " ".join(f"v{k % 9}" for k in range(120)),
]


@pytest.fixture(scope="session")
def hard(spark):
    """Texts of every awkward kind, with extra columns whose names the operators use themselves."""
    rows = [Row(doc_id=k * 3, text=t, lang="en", source=[None, "b", "a"][k % 3], n_chars=len(t or ""),
                sig=1, id=2, component="c", size=5, part=7, n=None, rank="r", text_2="x") for k, t in enumerate(HARD_TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, sig int, "
                                 "id int, component string, size int, part int, n string, rank string, text_2 string")


@pytest.fixture(scope="session")
def empty(hard):
    return hard.limit(0)

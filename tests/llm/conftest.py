import os
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
# Python workers start in another folder than the tests.
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Nulls in every column, empty and blank texts, repeated rows and ids, a very long text, extra letters.
ROWS = [
    (1, "the cat sat on the mat and the dog sat on the log by the old red barn", "en", "a", 10),
    (1, "the cat sat on the mat and the dog sat on the log by the old red barn", "en", "a", 10),
    (2, "The CAT sat on the mat and the dog sat on the log by the old red barn", "en", "a", 10),
    (3, None, "en", "a", None),
    (4, "", None, None, 0),
    (5, " \n\t ", "de", "", 4),
    (None, "der hund und die katze sind über dem großen haus und dem kleinen baum", "de", "b", 50),
    (None, None, None, None, None),
    (7, "one two three four five " * 8000, "en", "a", 192000),
    (8, "12345 ## $$ 67", "en", "c", 14),
    (9, "line one has words\nline one has words\nline two\n\nline one has words", "en", "c", 66),
    (10, "日本語 のテキスト 日本語 のテキスト", "ja", "c", 18),
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """The smallest tables, or a skip."""
    path = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not Path(path).exists():
        pytest.skip("no test tables")
    return path

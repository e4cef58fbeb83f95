from __future__ import annotations

import os
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parents[2])
sys.path[:0] = [ROOT, str(Path(__file__).resolve().parent)]
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])

import pytest  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, `Group` string"


@pytest.fixture(scope="session")
def odd(spark):
    """NULLs in every column, empty and blank texts, one very long text, repeated rows and columns that clash."""
    long_text = " ".join(f"word{i % 977} line{i % 31}" for i in range(40_000))
    rows = [
        (1, "one two three four five", "en", "a", 23, 5, "x"), (1, "one two three four five", "en", "a", 23, 5, "x"), (2, None, "en", "a", None, None, None),
        (3, "", "fr", None, 0, 1, "y"), (4, " \n\t ", None, "b", 4, 1, "y"), (None, "one two three four five", None, None, None, 1, None), (None, None, None, None, None, None, None),
        (7, long_text, "en", "b", len(long_text), 9, "z"), (8, "ÀÉ ünïcode 漢字 \U0001f600", "fr", "c", 20, 2, "z"), (9, "two", "en", "c", 3, 2, "z"), (11, "hello <|endoftext|> world", "en", "c", 25, 2, "z"), (12, "<|endoftext|><|endoftext|>x", "en", "c", 27, 2, "z"), (10, "two", "en", "c", 3, 2, "z"),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)

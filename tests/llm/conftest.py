from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"

LONG = "the quick brown fox jumps over the lazy dog and runs away from it " * 400
LINE = "This very line is found in many documents"
PROSE = "It was of the and in that on a day by for with as at from this there is to be or not in the house"

# Empty, null, short, long, repeated and tied texts.
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one two"),
    (5, LONG),
    (6, LONG + "tail"),
    (7, f"{LINE}\nown seven\n{LINE}"),
    (8, f"  {LINE.upper()}\t\nown eight"),
    (9, f"{LINE}\r\nown nine é日本 👍🏽"),
    (10, PROSE),
    (11, PROSE),
    (12, PROSE + " end"),
    (13, "ÀÉ ∑ß " * 30),
    (14, "\n\n\nx\n\n"),
    (15, 'token = "f33e61083db5dbdf4bd2369d2f80176e57f7" a.b@mail.example.com, 10.20.30.40 +1 (743) 555-3824; card 4111111111111111'),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture
def texts(spark):
    return spark.createDataFrame(TEXTS, SCHEMA)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def full(spark):
    """A documents table with a null in every column, and columns named like those that operators make."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, id long, found string, clean string"
    rows = [(i, t, None if i == 4 else "en", None if i == 5 else "s", None, None, 7, None, "c") for i, t in TEXTS]
    return spark.createDataFrame([*rows, (None, LONG, None, None, None, None, None, None, None)], schema)

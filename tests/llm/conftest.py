import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from llm_helpers import repeat_words  # noqa: E402

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

#: Column names that operators use inside; a table may have its own of that name.
CLASHING = ("fp", "h", "w", "block", "recipe", "group_size", "score", "piece", "length", "node", "root", "hash", "row")


@pytest.fixture(scope="session", autouse=True)
def _package(spark):
    from keysieve.llm.common import with_package
    with_package(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """``documents(rows)``: (doc_id, text) rows with all columns of the table
    and some of clashing names."""
    def make(rows):
        df = spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string")
        clash = ", ".join(f"cast('x' as string) as `{c}`" for c in CLASHING)
        return df.selectExpr("doc_id", "text", "'en' as lang", "cast(null as string) as source",
                             "cast(length(text) as long) as n_chars", *clash.split(", "))
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and white-space texts, ties, repeated rows, a long text."""
    long = repeat_words(20_000, 1)
    return [(0, None), (1, ""), (2, " \t\n\x0b\f\r"), (3, "one two"), (4, "onetwo"), (5, "one  two "),
            (5, "one  two "), (6, "one"), (None, "one"), (None, "lonely"), (7, long), (8, long + " end"),
            (9, long), (10, "ONE TWO"), (11, "ünï cödé ☃ 😀 text"), (12, "ünï cödé ☃ 😀 text"), (13, "�" * 3),
            (14, "a " * 300), (15, repeat_words(60, 2)), (16, repeat_words(60, 2) + "!")]

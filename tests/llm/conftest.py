from __future__ import annotations

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small() -> str:
    return SMALL


ODD_TEXTS = [
    None,
    "",
    "   \n\t ",
    "one",
    "one two three four",
    "one two three four five",
    "ONE two Three four five six seven",
    "Ünï çödé " * 30,
    "\U0001f916 robots \U0001f468 and others, é İstanbul ΣΣ end. " * 4,
    "word " * 3000,
    "a.b?c! d\r\ne\x0bf\x0cg\x1ch",
    "x" * 20_000,
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, blanks, repeats, long texts, ties, and columns that clash with working names."""
    rows = [(i, t, None, "src0", None, "mine", 7, 0.5) for i, t in enumerate(ODD_TEXTS)]
    rows += [(3, "one", "en", "src1", 3, "mine", 8, 0.1), (3, "another text for id three with many words", "en", None, 1, "x", 1, 0.2)]
    rows += [(None, "a text without an id but with words enough to count", None, None, None, None, None, None)] * 2
    kinds = "doc_id long, text string, lang string, source string, n_chars long, row_key string, n int, score double"
    return spark.createDataFrame(rows, kinds).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)

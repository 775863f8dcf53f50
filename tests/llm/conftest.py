import random

import pytest

from ledgerlens.llm import prepare


@pytest.fixture(scope="session")
def llm(spark):
    prepare(spark)
    return spark


@pytest.fixture(scope="session")
def docs(llm):
    from tests.conftest import SF_SMALL

    return llm.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd_docs(llm):
    """Nulls in every column, empty and long texts, repeated rows, equal ids, and
    columns named like those the operators use inside."""
    rng = random.Random(5)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "délta", "epsilon"]) + str(rng.randrange(400)) for _ in range(12_000))
    same = "The same words stand here twice, and nothing else is in the text."
    texts = [(1, same, "s"), (1, same, "s"), (2, same, None), (None, same, "s"), (None, None, None), (3, None, "s"), (4, "", "z"),
             (5, " \n\t", "z"), (6, "one two", "z"), (7, "é", "é"), (8, long, "z"), (8, long + " end", "z"), (9, "... !!! ???", None)]
    rows = [(i, t, "en", s, len(t or ""), 1, "x", 0.5, "y", 7) for i, t, s in texts]
    return llm.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                     "size int, t string, score double, key string, cid int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)

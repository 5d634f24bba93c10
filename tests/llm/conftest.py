import pytest

from spendmart.llm.shipping import ship

LONG = "lorem ipsum dolor sit amet " * 30_000
PASSAGE = " ".join(f"shared{i}" for i in range(30))
ODD_TEXTS = [
    None, "", "   \n\t ", "one", "a b c d e", "Same text twice over, with enough words to have a window of twenty words in it, "
    "so that both copies are seen as repeats of one another.",
    f"before {PASSAGE} after", f"{PASSAGE} other words", "the the " * 40, "x\x0by\x0cz  double  space\n\n\nlines", "É日本語 ñ <|endoftext|> it's 12345!!",
    "mail a.b@example.com card 4111 1111 1111 1111 on 2024-02-29", LONG,
]


@pytest.fixture(scope="session")
def shipped(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def odd_docs(shipped):
    """Null and empty texts, a very long one, repeated rows, a null id and source, odd column names."""
    rows = [(i, t, "en", "big" if i % 3 else f"s{i}", 1, "x", "y") for i, t in enumerate(ODD_TEXTS)]
    rows += [(20, ODD_TEXTS[5], "en", None, 1, "x", "y"), (20, ODD_TEXTS[5], "en", None, 1, "x", "y"), (None, "no id here", None, "big", None, None, None)]
    return shipped.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, judged string, mix string"
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _text string, id long, score double"


@pytest.fixture
def make_docs(spark):
    """Rows of documents, with further columns whose names the operators use inside."""

    def make(texts, ids=None, langs=None):
        ids = list(range(len(texts))) if ids is None else ids
        langs = ["en"] * len(texts) if langs is None else langs
        rows = [
            (i, t, lang, "src", None if t is None else len(t), "clash", -1, 0.5)
            for i, t, lang in zip(ids, texts, langs, strict=True)
        ]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture
def words():
    """Random texts over a small vocabulary."""
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(300)]

    def text(n, lines=1):
        return "\n".join(" ".join(rng.choice(vocabulary) for _ in range(n)) for _ in range(lines))

    text.rng = rng
    return text


#: Nulls, empty texts, white space only, no letters, one word, and a very long text.
ODD = [None, "", " \n\t ", "!!! ... 123", "word", "ab " * 60_000]

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from texts, or from (doc_id, text) or (doc_id, text, lang, source)."""
    def make(*rows):
        full = [(i, r) if r is None or isinstance(r, str) else r for i, r in enumerate(rows)]
        full = [(*r, *(None,) * (4 - len(r)), len(r[1] or "")) for r in full]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture(scope="session")
def prose():
    """Invented words; the same seed gives the same text."""
    def make(n, seed, vocabulary=400):
        r = random.Random(seed)
        return " ".join(f"w{r.randrange(vocabulary):x}{'aeiou'[r.randrange(5)]}" for _ in range(n))
    return make

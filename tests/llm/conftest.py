import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def make_docs(spark, rows):
    """documents from (doc_id, text) or (doc_id, text, lang, source) rows."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def prose(seed, n, vocabulary=4000):
    rng = random.Random(seed)
    return [f"{rng.choice('bcdfgklmnprst')}{rng.choice('aeiou')}w{rng.randrange(vocabulary)}" for _ in range(n)]


def changed(words, seed, n):
    rng = random.Random(seed)
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"new{seed}x{k}"
    return out


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long_text = " ".join(prose(1, 30_000))
    same = " ".join(prose(2, 120))
    rows = [
        (1, same, "en", "a"), (1, same, "en", "a"), (2, same, None, "b"), (None, same, "en", "a"),
        (None, None, None, None), (None, None, None, None), (3, None, "en", "a"), (4, "", "en", "a"), (5, " \t\n ", "en", None),
        (6, long_text, "de", "b"), (7, long_text + " tail", "de", "c"), (8, "one", "en", "c"), (9, "... --- !!!", "en", "c"),
        (10, "word " * 2000, "en", "a"), (11, "line\n" * 300, "fr", "a"), (12, "<|endoftext|> é\U0001f600  x", "fr", "b"),
        (13, " ".join(changed(prose(2, 120), 1, 1)), "en", "b"), (14, "x" * 50_000, "en", "b"),
    ]
    return make_docs(spark, rows)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)

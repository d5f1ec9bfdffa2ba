import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from featpipe.llm import search, spans
from tests.llm.conftest import make_docs, prose

BENCH = "item_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [w.translate(LOWER) for w in WORD.findall(text or "")]


def brute(docs, items, top=50):
    """The contract, document by document."""
    counted = [(d, Counter(terms(text))) for d, text in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n_docs, n_terms = sum(n > 0 for n in sizes), sum(sizes)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        scores = Counter()
        for term in own:
            df = sum(term in c for _, c in counted)
            w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
            for k, (_, c) in enumerate(counted):
                if c[term]:
                    m = 50 + 50 * sizes[k] * n_docs // n_terms
                    scores[k] += w * ((1_000_000_000 * c[term]) // (1000 * c[term] + 20 * m))
        best = sorted((-s, docs[k][0] is None, docs[k][0] or 0) for k, s in scores.items() if s > 0)[:top]
        out += [(item, r + 1, None if no_id else d, -s) for r, (s, no_id, d) in enumerate(best)]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


@pytest.fixture
def corpus():
    docs = [(k, " ".join(prose(k, 10 + 13 * k % 170, 60 + k % 500))) for k in range(260)]
    docs += [(1000 + k, docs[7][1]) for k in range(80)]  # ties beyond the last place
    items = [(k, " ".join(prose(k, 20, 300)).upper() + " É-é") for k in range(70)] + [(90, docs[7][1])]
    return docs, items


def test_matches_brute_force(spark, corpus):
    docs, items = corpus
    got = search.search(make_docs(spark, docs).repartition(7), spark.createDataFrame(items, BENCH))
    assert rows_of(got) == brute(docs, items)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]


def test_tiles_and_blocks_change_nothing(spark, corpus, monkeypatch):
    docs, items = corpus
    want = brute(docs, items, 8)
    frame, bench = make_docs(spark, docs).repartition(3), spark.createDataFrame(items, BENCH)
    monkeypatch.setattr(search, "ITEM_TILE", 7)
    monkeypatch.setattr(search, "DOC_TILE", 19)
    monkeypatch.setattr(spans.text_blocks, "__defaults__", (300, False))
    assert rows_of(search.search(frame, bench, top=8)) == want
    assert rows_of(search.search(frame, bench, top=8, item_bytes=6000)) == want


def test_vocabulary_is_cut_below_the_exact_bound(monkeypatch):
    """Partial sums stay below 2**53: with a weight near the bound every term is a part of its own."""
    weight = np.array([1 << 32, 5, (1 << 32) - 1], dtype=np.int64)
    tile = search.Tile([np.array([0, 1, 2]), np.array([2])], weight)
    assert len(tile.parts) == 2 and all(w.shape[1] * weight.max() * search.IMPACT < search.EXACT for _, w in tile.parts)
    doc, term, impact = np.array([0, 0, 1]), np.array([0, 2, 1]), np.array([999_999, 999_998, 7])
    got = tile.scores(doc, term, impact, 2)
    assert got.tolist() == [[(1 << 32) * 999_999 + ((1 << 32) - 1) * 999_998, 35], [((1 << 32) - 1) * 999_998, 0]]


def test_best_keeps_ties():
    best = search.Best(2, 3)
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(40):
        scores, ids = rng.integers(0, 4, (2, 30)), rng.permutation(100_000)[:30]
        best.add(0, scores, ids)
        rows += [(i, -int(scores[i, k]), int(ids[k])) for i in range(2) for k in range(30) if scores[i, k] > 0]
        best.settle()
    want = sorted(r for r in rows if r[0] == 0)[:3] + sorted(r for r in rows if r[0] == 1)[:3]
    assert [(i, -s, d) for i, s, d in best.settle().tolist()] == want


def test_awkward_rows(spark, awkward, no_docs):
    items = [(1, " ".join(prose(2, 20))), (None, "word one"), (None, "line"), (2, ""), (3, None), (4, "nowhere"), (5, "é\U0001f600 X")]
    bench = spark.createDataFrame(items, BENCH).withColumn("block", F.lit(1)).withColumn("terms", F.lit("t"))
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    clash = awkward.withColumn("item_id", F.lit("x")).withColumn("score", F.lit(1)).withColumn("task", F.lit(2))
    assert rows_of(search.search(clash, bench)) == brute(docs, items)
    assert search.search(no_docs, bench).count() == 0
    assert search.search(awkward, spark.createDataFrame([], BENCH)).count() == 0
    assert search.search(awkward.where("text is null"), bench).count() == 0

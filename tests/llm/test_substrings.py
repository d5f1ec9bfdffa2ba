import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featpipe.llm import substrings
from featpipe.llm.common import BASE_B, ngram_hashes
from tests.llm import brute
from tests.llm.conftest import make_docs, prose


def repeated_passages(seed):
    rng = random.Random(seed)
    passages = [prose(1000 + k, rng.choice([40, 49, 50, 51, 75, 130])) for k in range(8)]
    rows = []
    for k in range(90):
        words = []
        for _ in range(rng.randrange(0, 5)):
            words += prose(rng.randrange(10**6), rng.randrange(0, 60))
            p = rng.choice(passages)
            a = rng.randrange(0, 20)
            words += p[a:] if rng.random() < 0.4 else p
        sep = rng.choice([" ", "\n", " \t "])
        rows.append((rng.randrange(60), sep.join(words)))  # ids repeat
    whole = " ".join(prose(7, 70))
    rows += [(200, whole), (201, whole), (3, whole), (None, whole), (202, " ".join(prose(7, 70)[:49])), (203, "a " * 120), (204, "a " * 60)]
    return rows


def found(docs):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.remove_repeats(docs).collect()), key=repr)


@pytest.mark.parametrize("seed", [0, 1])
def test_matches_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(substrings, "PHRASES", 300)  # several blocks in a task
    rows = repeated_passages(seed)
    assert found(make_docs(spark, rows).repartition(3)) == sorted(brute.remove_repeats(rows), key=repr)


def test_spans_and_text(spark):
    shared = prose(1, 60)
    rows = [(1, " ".join(prose(2, 10) + shared)), (2, " ".join(prose(3, 5) + shared + prose(4, 7)))]
    docs = make_docs(spark, rows)
    out = docs.join(substrings.remove_repeats(docs), "doc_id").withColumn("kept", substrings.kept_text(F.col("text"), F.col("spans")))
    out = {r.doc_id: r for r in out.collect()}
    assert out[1].spans == [] and out[1].factors == [] and out[1].n_removed == 0 and out[1].kept == rows[0][1]
    assert [(s["first"], s["words"]) for s in out[2].spans] == [(5, 60)]
    assert [tuple(f) for f in out[2].factors] == [(5, 60, 1, 10)]
    assert out[2].kept == " ".join(prose(3, 5) + prose(4, 7))


def test_a_span_of_several_references_has_a_factor_of_each(spark):
    """No single earlier document holds the passage: it is parsed into the stretches that they hold."""
    p = prose(9, 130)
    rows = [(1, " ".join(p[:80])), (2, " ".join(prose(3, 4) + p[31:])), (3, " ".join(p))]
    out = {r.doc_id: r for r in substrings.remove_repeats(make_docs(spark, rows)).collect()}
    assert [(f["first"], f["words"]) for f in out[2].spans] == [] and out[2].n_removed == 0   # 49 words in common
    assert [tuple(f) for f in out[3].factors] == [(0, 80, 1, 0), (31, 99, 2, 4)]
    assert [(f["first"], f["words"]) for f in out[3].spans] == [(0, 130)]


@pytest.mark.parametrize("seed,hot", [(3, 1), (4, 500)])
def test_factors_stand_in_their_references(spark, seed, hot, monkeypatch):
    """Every factor's words are the reference's at its place, the reference is an earlier document, factors of one
    document neither lie inside each other nor could be one, and together they are the spans."""
    monkeypatch.setattr(substrings, "HOT_ANCHOR", hot)
    monkeypatch.setattr(substrings, "PHRASES", 300)
    rows = list({r[0]: r for r in repeated_passages(seed)}.values())
    texts = {doc_id: text.split() for doc_id, text in rows}
    docs = make_docs(spark, rows).repartition(4)
    assert found(docs) == sorted(brute.remove_repeats(rows), key=repr)
    n = 0
    seen = docs.select("doc_id", F.col("text").alias("t")).join(
        substrings.remove_repeats(docs).withColumnRenamed("doc_id", "d"), F.col("doc_id").eqNullSafe(F.col("d"))).collect()
    for r in seen:
        words = r.t.split()
        covered = set()
        for a, b in zip(r.factors, r.factors[1:]):
            assert a.first <= b.first and a.first + a.words < b.first + b.words
            assert (a.ref_id, a.ref_first - a.first) != (b.ref_id, b.ref_first - b.first) or b.first > a.first + a.words - 49
        for f in r.factors:
            assert r.doc_id is None or f.ref_id < r.doc_id
            own = words[f.first:f.first + f.words]
            assert texts[f.ref_id][f.ref_first:f.ref_first + f.words] == own and len(own) >= 50
            covered |= set(range(f.first, f.first + f.words))
            n += 1
        assert covered == {k for s in r.spans for k in range(s.first, s.first + s.words)}
    assert n > 30


def test_greedy_parse_goes_on_in_its_reference():
    """A phrase that stands elsewhere earlier still belongs to the open factor while its reference holds it."""
    rows = [(1, 2, 7), (2, 0, 5), (2, 1, 6), (2, 2, 7), (2, 3, 8), (3, 10, 5), (3, 11, 6), (3, 12, 7), (3, 13, 8)]
    order, start, h = (np.array(x, dtype=np.int64) for x in zip(*rows))
    block = substrings.Block(order, order * 100, start, h, h)
    got = [tuple(int(v) for v in f) for f in zip(*block.factors())]
    assert got == [(2, 200, 2, 2, 1, 100, 2), (3, 300, 10, 13, 2, 200, 0)]


def test_anchors_depend_on_the_phrase_alone():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 300).astype(np.uint64)
    b = np.concatenate([rng.integers(0, 2**63, 37).astype(np.uint64), a[100:200]])
    assert (substrings.phrase_anchors(a)[100:151] == substrings.phrase_anchors(b)[37:88]).all()
    assert (ngram_hashes(a, 50, BASE_B)[100:151] == ngram_hashes(b, 50, BASE_B)[37:88]).all()
    grams = ngram_hashes(a, 25)
    assert substrings.phrase_anchors(a)[17] == grams[17:17 + 26].min()


def test_edges(spark, awkward, no_docs):
    assert substrings.remove_repeats(no_docs).count() == 0
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    clash = awkward.withColumn("key", F.lit("x")).withColumn("order", F.lit(1)).withColumn("_text", F.lit(2)).withColumn("first", F.lit(3))
    assert found(awkward) == found(clash) == sorted(brute.remove_repeats(rows), key=repr)


def test_texts_meet_by_a_shuffle(spark):
    """What is wanted of the texts grows with them: it is not broadcast, at no size."""
    passage = prose(77, 60)
    docs = make_docs(spark, [(k, " ".join(prose(700 + k, 20) + passage)) for k in range(4)])
    out = substrings.remove_repeats(docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert {r.doc_id: r.n_removed for r in out.collect()} == {0: 0, 1: 60, 2: 60, 3: 60}

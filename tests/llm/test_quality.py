import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from featpipe.llm import quality
from featpipe.llm.common import WordCodes
from tests.llm import brute
from tests.llm.conftest import make_docs, prose

LABELS = "doc_id long, quality int, toxic int"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=list("ab #*|\n\t\r\x0b\x0c\x1c\x85 é\U0001f600"), max_size=80))
def test_base_counts(text):
    n, chars, symbols, dups, repeats = quality.base_counts(text.encode(), WordCodes())
    assert (n, chars, symbols, dups, repeats) == brute.base_rules(text)[:5]


def corpus(spark):
    good = [(k, " ".join(prose(k, 200))) for k in range(200)]
    junk = [(1000 + k, " ".join(w + "###" for w in prose(500 + k, 200))) for k in range(40)]
    loud = [(2000 + k, " ".join(prose(700 + k, 200)).upper()) for k in range(40)]
    docs = make_docs(spark, good + junk + loud)
    labels = spark.createDataFrame([(k, 1, 0) for k in range(0, 200, 2)] + [(1000, 0, 0), (None, 1, 0), (5, 1, 1), (0, 1, 0), (9999, 1, None)], LABELS)
    return docs, labels


def test_score_is_the_log_likelihood_ratio(spark):
    docs, labels = corpus(spark)
    rows = {r.doc_id: r for r in quality.quality_rules(docs, labels).collect()}
    assert all(rows[k].kept for k in range(200))
    assert not any(r.kept for k, r in rows.items() if k >= 1000)
    trusted = set(range(0, 200, 2))
    texts = {r.doc_id: r.text.encode() for r in docs.collect()}
    raw, target = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for k, t in texts.items():
        for i in range(len(t) - 3):
            b = (int.from_bytes(t[i:i + 4], "little") * 2654435761 & 0xFFFFFFFF) >> 16
            raw[b] += 1
            target[b] += k in trusted
    prior = (raw + 1) / (raw.sum() + quality.BUCKETS)
    ratio = np.log((target / target.sum() + 0.01 * prior) / 1.01 / prior)
    for k in (0, 7, 1000, 2000):
        t = texts[k]
        at = [(int.from_bytes(t[i:i + 4], "little") * 2654435761 & 0xFFFFFFFF) >> 16 for i in range(len(t) - 3)]
        assert abs(rows[k].score - ratio[at].mean()) < 1e-9


def test_same_verdicts_in_any_layout(spark):
    docs, labels = corpus(spark)
    key = lambda df: sorted((r.doc_id, r.score, r.kept) for r in df.collect())
    assert key(quality.quality_rules(docs.coalesce(1), labels)) == key(quality.quality_rules(docs.repartition(7), labels.repartition(3)))


def test_edges(spark, awkward, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (None, None, None)], LABELS)
    none = spark.createDataFrame([], LABELS)
    rows = quality.quality_rules(awkward, labels).collect()
    assert len(rows) == awkward.count()
    texts = [r.text for r in awkward.collect()]
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows) == sorted(map(brute.base_rules, texts))
    assert quality.quality_rules(no_docs, labels).count() == 0
    # nothing trusted: the base rules decide alone
    assert all(r.kept != r.base_failed for r in quality.quality_rules(awkward, none).collect())
    clash = awkward.withColumn("kept", F.lit("x")).withColumn("score", F.lit("y")).withColumn("n_words", F.lit(0))
    assert quality.quality_rules(clash, labels).count() == awkward.count()
    assert quality.accepted(clash, labels).columns == clash.columns

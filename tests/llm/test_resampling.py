import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from featpipe.llm import resampling, spans
from tests.llm.conftest import changed, make_docs, prose

BENCH = "item_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute(docs, target, drawn=25, buckets=10_000):
    """The contract, feature by feature."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, features(text)))
    for _, text in target:
        t.update(map(bucket, features(text)))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        f = features(text)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= 39), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(able[:drawn * len(able) // 100]):
        r[4] = k + 1
    return sorted(map(tuple, rows), key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=repr)


@pytest.fixture
def corpus():
    target = [(k, " ".join(prose(900, 30)[:10] + prose(50 + k, 20))) for k in range(12)]
    docs = [(k, " ".join(prose(k, 5 + 7 * k % 90))) for k in range(150)]
    docs += [(200 + k, " ".join(changed(target[k % 12][1].split(), k, 3) + prose(k, 10)).title() + " É. x-1") for k in range(40)]
    return docs, target


def test_matches_brute_force(spark, corpus):
    docs, target = corpus
    got = resampling.resample(make_docs(spark, docs).repartition(5), spark.createDataFrame(target, BENCH))
    assert rows_of(got) == brute(docs, target)
    assert dict(got.dtypes) == dict.fromkeys(["doc_id", "n_features", "weight", "score", "rank"], "bigint")


def test_draws_towards_the_target(spark, corpus):
    """A few documents made of the target's phrases weigh more than all others."""
    _, target = corpus
    docs = [(k, " ".join(prose(k, 60 + k % 40))) for k in range(150)]
    docs += [(200 + k, " ".join(prose(900, 30)[:10] + target[k][1].split())) for k in range(3)]
    got = resampling.resample(make_docs(spark, docs), spark.createDataFrame(target, BENCH)).collect()
    assert min(r.weight for r in got if r.doc_id >= 200) > max(r.weight for r in got if r.doc_id < 200)


def test_blocks_and_batches_change_nothing(spark, corpus, monkeypatch):
    docs, target = corpus
    docs = [*docs, (500, " ".join(prose(7, 4000)))]
    want = brute(docs, target)
    frame, bench = make_docs(spark, docs), spark.createDataFrame(target, BENCH)
    monkeypatch.setattr(spans.text_blocks, "__defaults__", (700, False))  # texts in many parts
    assert rows_of(resampling.resample(frame.repartition(3), bench)) == want


def test_awkward_rows(spark, awkward, no_docs):
    bench = spark.createDataFrame([(1, " ".join(prose(2, 20))), (None, None), (2, "")], BENCH)
    clash = awkward.withColumn("rank", F.lit("x")).withColumn("bucket", F.lit(1)).withColumn("_id", F.lit(2)).withColumn("score", F.lit(3))
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    assert rows_of(resampling.resample(clash, bench.withColumn("n", F.lit(1)))) == brute(docs, [(1, " ".join(prose(2, 20)))])
    assert resampling.resample(no_docs, bench).count() == 0
    none = spark.createDataFrame([], BENCH)
    assert rows_of(resampling.resample(awkward, none)) == brute(docs, [])

"""The stages against brute force, each on its own input."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from featpipe.llm import mixing, queries
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.test_decontaminate import brute as overlaps
from tests.llm.test_mixing import level_targets


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs.collect()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, SF_SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        if k < 4:
            assert docs.columns == corpus_pipeline.COLUMNS
        out.append(docs.collect())
    return out


def test_quality_stage(stages):
    before, after = stages[:2]
    kept = {r.doc_id for r in after}
    assert not any(brute.base_rules(r.text)[5] for r in after)
    labels = dict(duckdb.sql(f"select doc_id, quality from '{SF_SMALL}/labels.parquet'").fetchall())
    passed = [r for r in before if not brute.base_rules(r.text)[5]]
    assert not any(labels.get(r.doc_id) == 0 for r in after)
    good = [r for r in passed if labels.get(r.doc_id) == 1]
    assert good and all(r.doc_id in kept for r in good)


def test_jaccard_stage(stages):
    before, after = stages[1:3]
    want = {d for d, _, c in brute.jaccard_components([(r.doc_id, r.text) for r in before]) if d == c}
    assert sorted(r.doc_id for r in after) == sorted(want)


def test_decontamination_stage(stages):
    before, after = stages[2:4]
    items = duckdb.sql(f"select item_id, text from '{SF_SMALL}/benchmark.parquet'").fetchall()
    hit = {d for d, _ in overlaps([(r.doc_id, r.text) for r in before], items)}
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if r.doc_id not in hit)


def test_mixing_stage(stages):
    before, after = stages[3:5]
    size = lambda r: len(brute.words(r.text))
    sizes, taken, largest = {}, {}, {}
    for r in before:
        sizes[r.source] = sizes.get(r.source, 0) + size(r)
        largest[r.source] = max(largest.get(r.source, 0), size(r))
    for r in after:
        taken[r.source] = taken.get(r.source, 0) + size(r)
    for source, target in level_targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= largest[source] / 2 + 1
    ids = [r.doc_id for r in after]
    assert max(map(ids.count, set(ids))) <= mixing.MAX_EPOCHS
    assert {(r.doc_id, r.text) for r in after} <= {(r.doc_id, r.text) for r in before}


def test_sharding_stage(stages):
    before, after = stages[4:6]
    key = lambda r: (r.doc_id, r.text)
    assert sorted(map(key, before)) == sorted(map(key, after))
    assert {r.shard for r in after} <= set(range(corpus_pipeline.SHARDS))


def test_run(spark, stages):
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.shard) for r in got) == sorted((r.doc_id, r.shard) for r in stages[-1])


def test_awkward_rows_through_every_stage(spark, awkward, no_docs):
    """Nulls, empty and very long texts, repeated rows, an empty table and columns of clashing names."""
    clash = awkward
    for name in ("_key", "_order", "shard", "size", "kept", "group", "hash"):
        clash = clash.withColumn(name, F.lit(f"mine {name}"))
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    same = rows[0][1]
    passed = {}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF_SMALL).count() == 0, name
        out = stage(spark, clash, SF_SMALL)
        assert name == "sharding" or out.columns == corpus_pipeline.COLUMNS
        passed[name] = [(r.doc_id, r.text) for r in out.collect()]
        assert set(passed[name]) <= set(rows), name
    assert all(text and len(text.split()) >= 50 for _, text in passed["quality rules"])
    kept = passed["n-gram Jaccard join"]
    assert [r for r in kept if r[1] == same] == [(1, same)] and (3, None) in kept and (4, "") in kept
    assert sorted(map(repr, passed["benchmark decontamination"])) == sorted(map(repr, rows))
    assert all(text and text.split() for _, text in passed["mixing sources to target weights"])
    assert sorted(map(repr, passed["sharding"])) == sorted(map(repr, rows))


def test_registry():
    assert list(corpus_pipeline.QUERIES) == ["pipeline"]
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracles(spark, name):
    from tests.oracle_check import run
    assert run(SF_SMALL, [name], verbose=False)[name]["ok"]

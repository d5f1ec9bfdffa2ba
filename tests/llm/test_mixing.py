import random

import pytest
from pyspark.sql import functions as F

from featpipe.llm import mixing
from tests.llm.conftest import make_docs, prose


def level_targets(sizes, max_epochs=3, weights=(1, 2, 3)):
    """The resharing loop as stated, on {source: size}."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:
        rest = total - sum(fixed.values())
        open_ = [s for s in order if s not in fixed]
        w = sum(weight[s] for s in open_)
        target = {s: rest * weight[s] / w for s in open_}
        above = [s for s in open_ if target[s] > max_epochs * sizes[s]]
        if not above:
            return {**fixed, **target}
        fixed.update({s: max_epochs * sizes[s] for s in above})


@pytest.mark.parametrize("seed", range(4))
def test_targets_match_the_loop(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{k}": int(10 ** rng.uniform(0, 6)) for k in range(rng.randrange(1, 30))}
    sizes[None] = rng.randrange(0, 100)
    sizes["zero"] = 0
    found = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()
    want = level_targets(sizes)
    for r in found:
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-6)
    assert sum(r.target for r in found) == pytest.approx(sum(sizes.values()))


def test_budget_cut_and_epochs(spark):
    rng = random.Random(5)
    rows = [(k, " ".join(prose(k, rng.randrange(0, 60))), "en", rng.choice(["a", "a", "a", "b", "c", None])) for k in range(400)]
    rows += [(None, None, None, None), (7, rows[7][1], "en", rows[7][3])]
    mixed = mixing.mix(make_docs(spark, rows)).collect()
    assert len(mixed) == len(rows)
    again = sorted((r.doc_id or -1, r.size, r.taken) for r in mixing.mix(make_docs(spark, rows).repartition(5)).collect())
    assert again == sorted((r.doc_id or -1, r.size, r.taken) for r in mixed)
    by = {}
    for r in mixed:
        by.setdefault(r.source, []).append(r)
        assert 0 <= r.taken <= 3 * r.size and r.size == len((dict((x[0], x[1]) for x in rows)[r.doc_id] or "").split())
    for rs in by.values():
        assert sum(r.size for r in rs) == rs[0].source_size
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= 0.5 + 1e-6
        # whole epochs, then a prefix of the order, one document cut
        parts = [(r.before, r.taken - r.epochs * r.size, r.size) for r in rs if r.size]
        parts.sort()
        assert sum(0 < t < s for _, t, s in parts) <= 1
        assert [t > 0 for _, t, _ in parts] == sorted([t > 0 for _, t, _ in parts], reverse=True)


def test_mixture_repeats_whole_documents(spark):
    rows = [(k, " ".join(prose(k, 20 + k % 9)), "en", "a" if k % 4 else "b") for k in range(300)]
    rows += [(900, None, "en", "a"), (901, "", "en", "z")]
    docs = make_docs(spark, rows)
    mixed = {r.doc_id: r for r in mixing.mix(docs).collect()}
    got = {r.doc_id: r["count"] for r in mixing.mixture(docs).groupBy("doc_id").count().collect()}
    for k, r in mixed.items():
        whole = int(r.taken / r.size + 0.5) if r.size else 0
        assert got.get(k, 0) == whole
    assert mixing.mixture(docs).columns == docs.columns


def test_edges(spark, awkward, no_docs):
    assert mixing.mix(no_docs).count() == 0 and mixing.mixture(no_docs).count() == 0
    mixed = mixing.mix(awkward)
    assert mixed.count() == awkward.count()
    assert mixed.where("size = 0 and taken != 0").count() == 0
    clash = awkward.withColumn("size", F.lit("x")).withColumn("key", F.lit(1)).withColumn("taken", F.lit(2))
    assert mixing.mix(clash).count() == awkward.count()
    assert mixing.mixture(clash).columns == clash.columns
    nothing = make_docs(spark, [(1, None), (2, "")])
    assert [r.taken for r in mixing.mix(nothing).collect()] == [0, 0]


def test_mixture_keeps_columns_of_any_name(spark):
    rows = [(k, f"word{k} two three", "en", "ab"[k % 2]) for k in range(12)]
    docs = make_docs(spark, rows)
    named = docs
    for name in ("_key", "_cut", "_source", "_copies", "_copy", "_epochs", "key"):
        named = named.withColumn(name, F.lit(f"mine {name}"))
    got = mixing.mixture(named)
    assert got.columns == named.columns
    assert sorted(map(tuple, got.select(*docs.columns).collect())) == sorted(map(tuple, mixing.mixture(docs).collect()))
    assert {r._key for r in got.collect()} == {"mine _key"}

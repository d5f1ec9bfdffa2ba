import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from featpipe.llm import sharding
from tests.llm.conftest import make_docs, prose


def check(rows, n):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert set(by) <= set(range(n))
    total, largest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    unit = max(largest, total / n * sharding.UNIT_SHARE)
    for rs in by.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
        assert abs(sum(r["size"] for r in rs) - total / n) <= 2.5 * unit
    return by


def test_bytes_law_slots_and_groups(spark):
    rng = random.Random(1)
    rows = [(k, " ".join(prose(k, rng.randrange(1, 400))), rng.choice(["en", "de", None]), f"s{min(9, int(rng.expovariate(0.6)))}") for k in range(1500)]
    short = [r for r in rows if len(r[1]) < 600]
    rows += [(5000 + k, short[k % 40][1], "en", "x") for k in range(120)]
    out = sharding.with_slots(sharding.shard(make_docs(spark, rows), n_shards=24)).collect()
    assert len(out) == len(rows)
    check(out, 24)
    text = {r[0]: r[1].encode() for r in rows}
    shards = defaultdict(set)
    for r in out:
        assert r["size"] == len(text[r.doc_id]) + 8 and r.text_crc32 == zlib.crc32(text[r.doc_id])
        shards[text[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())  # no group weighs more than the largest document


def test_hot_group_is_spread(spark):
    rows = [(k, "the same text " * 30, "en", "a") for k in range(600)] + [(1000 + k, " ".join(prose(k, 60)), "de", "b") for k in range(600)]
    out = sharding.with_slots(sharding.shard(make_docs(spark, rows), n_shards=8)).collect()
    check(out, 8)
    again = sharding.with_slots(sharding.shard(make_docs(spark, rows).repartition(3), n_shards=8)).collect()
    key = lambda rs: sorted((r.doc_id, r.shard, r.slot) for r in rs)
    assert key(out) == key(again)


def test_leaves_reach_target_bytes(spark):
    rows = [(k, " ".join(prose(k, 100)), "en", "a") for k in range(400)]
    total = sum(len(r[1]) + 8 for r in rows)
    out = sharding.shard(make_docs(spark, rows), target_bytes=total // 7).collect()
    assert len(Counter(r.shard for r in out)) == 7


def test_splits_along_the_widest_dimension(spark):
    units = [(k, 0, 0, 0, 1, float(k), 5.0) for k in range(64)]
    made = spark.createDataFrame(units, "_hash long, _crc long, _size long, _piece long, _weight long, wide double, flat double")
    tree = {r._hash: r.shard for r in sharding.kd_tree(made, 4, ["wide", "flat"]).collect()}
    assert [tree[k] for k in range(64)][::16] == [0, 1, 2, 3] and Counter(tree.values()) == {0: 16, 1: 16, 2: 16, 3: 16}


def plain_tree(units, n_shards, names):
    """The tree by sorting each node's units in plain Python: {unit: shard}."""
    rows = [dict(u) for u in units]
    for d in names:
        known = [r[d] for r in rows if r[d] is not None]
        low, high = min(known, default=None), max(known, default=None)
        for r in rows:
            r[d] = 0.0 if r[d] is None or low is None or high <= low else (r[d] - low) / (high - low)
    out = {}

    def split(own, node, leaves):
        if leaves == 1 or not own:
            out.update({r["_hash"]: node for r in own})
            return
        spans = {d: max(r[d] for r in own) - min(r[d] for r in own) for d in names}
        widest = next(d for d in names if spans[d] == max(spans.values()))
        total, before, left = sum(r["_weight"] for r in own), 0, []
        half = leaves // 2
        for r in sorted(own, key=lambda r: (r[widest], r["_hash"], r["_crc"], r["_size"], r["_piece"])):
            if (before + r["_weight"] / 2) * leaves <= total * half:
                left.append(r)
            before += r["_weight"]
        names_left = {r["_hash"] for r in left}
        split(left, node, half)
        split([r for r in own if r["_hash"] not in names_left], node + half, leaves - half)

    split(rows, 0, n_shards)
    return out


def test_tree_equals_a_plain_one(spark):
    """Random weights and coordinates with ties, nulls and one heavy unit, for numbers of shards that don't halve evenly."""
    rng = random.Random(8)
    units = [{"_hash": k, "_crc": k % 7, "_size": 3, "_piece": 0, "_weight": rng.choice([1, 5, 40, 900 if k == 3 else 2]),
              "x": rng.choice([None, float(rng.randrange(9)), rng.random() * 9]), "y": float(rng.randrange(4)), "z": 2.0} for k in range(300)]
    made = spark.createDataFrame([tuple(u.values()) for u in units],
                                 "_hash long, _crc long, _size long, _piece long, _weight long, x double, y double, z double")
    for n in (5, 24):
        tree = {r._hash: r.shard for r in sharding.kd_tree(made.repartition(3), n, ["z", "x", "y"]).collect()}
        assert tree == plain_tree(units, n, ["z", "x", "y"])


def test_edges(spark, awkward, no_docs):
    assert sharding.with_slots(sharding.shard(no_docs, n_shards=24)).count() == 0
    out = sharding.with_slots(sharding.shard(awkward, n_shards=4)).collect()
    assert len(out) == awkward.count() and all(0 <= r.shard < 4 for r in out)
    clash = awkward.withColumn("shard", F.lit("x")).withColumn("_hash", F.lit(1)).withColumn("size", F.lit(2)).withColumn("_node", F.lit(3))
    kept = sharding.shard(clash, n_shards=3, keep=("doc_id", "text", "lang", "source", "n_chars"))
    assert kept.count() == awkward.count()
    one = sharding.shard(make_docs(spark, [(1, "x")]), n_shards=24).collect()
    assert len(one) == 1

import itertools
import random

import pytest
from pyspark.sql import functions as F

from featpipe.llm import decontaminate as dc
from tests.llm.conftest import make_docs, prose

BENCH = "item_id long, text string"


def covered(length, replaced):
    """Whether a mask fits between the replaced positions, for every choice of them."""
    places = [{o + i for i in m} for m in dc.MASKS for o in range(length - m[-1])]
    return [any(not p & set(c) for p in places) for c in itertools.combinations(range(length), replaced)]


def test_masks_tolerate_replaced_tokens():
    """Every choice of replaced tokens that the comparison accepts leaves a whole mask."""
    assert all(all(covered(dc.SPAN, n)) for n in (1, 2, 3))
    for length in range(dc.WHOLE, dc.SPAN):
        assert all(covered(length, length * dc.REPLACED // dc.SPAN)), length


def brute(docs, items):
    import regex
    one = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]"
    tokens = lambda t: [x for w in regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())
                        for x in regex.findall(one + "|(?:(?!" + one + ").)+", w)]
    out = {}
    for d, text in docs:
        x = tokens(text)
        for item, passage in items:
            y = tokens(passage)
            if not y:
                continue
            n = min(dc.SPAN, len(y))
            allowed = n * dc.REPLACED // dc.SPAN if n >= dc.WHOLE else 0
            for shift in range(-len(y), len(x) + 1):
                same = [0 <= shift + j < len(x) and x[shift + j] == y[j] for j in range(len(y))]
                best = max(sum(same[a:a + n]) for a in range(len(y) - n + 1))
                if best >= n - allowed:
                    out[d, item] = max(best, out.get((d, item), 0))
    return out


@pytest.fixture
def cases():
    rng = random.Random(4)
    items = [(k, " ".join(prose(50 + k, rng.choice([8, 10, 14, 20, 40])))) for k in range(12)]
    items += [(60 + k, " ".join(prose(70 + k, 1 + k))) for k in range(7)]
    items += [(80, "深度学习模型需要大量的训练数据"), (81, "量子计算"), (90, "too short an item"), (91, None), (92, "..."), (None, " ".join(prose(80, 20)))]
    docs = []
    for k in range(120):
        words = prose(1000 + k, rng.randrange(0, 120))
        item = rng.choice(items)[1]
        if k % 7 == 0:
            words.insert(len(words) // 2, rng.choice(["前言深度学习模型需要大量的训练数据。后记", "关于量子计算的书", "量子的计算"]))
        if k % 3 and item:
            passage = item.split()
            for at in rng.sample(range(len(passage)), min(len(passage) // 8, rng.randrange(0, 4))):
                passage[at] = "other"
            if k % 2:
                passage = [w.upper() + "," for w in passage]
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage
        docs.append((k, " ".join(words)))
    return docs, items


def test_finds_what_brute_force_finds(spark, cases):
    docs, items = cases
    found = {(r.doc_id, r.item_id): r.matched for r in dc.contaminated(make_docs(spark, docs), spark.createDataFrame(items, BENCH)).collect()}
    want = brute(docs, items)
    assert set(found) == set(want) and len(want) > 60
    assert all(found[k] <= want[k] for k in found)
    short = {i for _, i in found if i is not None and (60 <= i < 70 or i in (80, 81))}
    assert len(short) >= 6


def test_short_items_and_scripts_without_spaces(spark):
    """A six-word question and a passage of one clause, copied exactly, are found; parts of them are not."""
    items = [(1, "what is the capital of France?"), (2, "机器学习是人工智能的一个分支它使用统计方法让计算机系统学习"), (3, "yes")]
    docs = [(1, "Quiz: What is the capital of France? Paris."), (2, "序言。机器学习是人工智能的一个分支它使用统计方法让计算机系统学习，等等"),
            (3, "what is the capital of Spain"), (4, "机器学习很有用"), (5, "Yes, indeed"), (6, "yesterday")]
    found = dc.contaminated(make_docs(spark, docs), spark.createDataFrame(items, BENCH)).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (2, 2), (5, 3)]


def test_clean_documents_keeps_columns_of_any_name(spark):
    bench = spark.createDataFrame([(1, " ".join(prose(2, 20)))], BENCH)
    docs = make_docs(spark, [(1, "x y"), (2, " ".join(prose(2, 20)))])
    for name in ("_key", "_id", "_gone", "key"):
        docs = docs.withColumn(name, F.lit(f"mine {name}"))
    kept = dc.clean_documents(docs, dc.contaminated(docs, bench))
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [tuple(r) for r in docs.where("doc_id = 1").collect()]


def test_benchmark_in_blocks(spark, cases, monkeypatch):
    docs, items = cases
    docs, items = make_docs(spark, docs), spark.createDataFrame(items, BENCH)
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    whole = key(dc.contaminated(docs, items))
    monkeypatch.setattr(dc, "SEED_BLOCK", 150)
    assert key(dc.contaminated(docs, items)) == whole


def test_clean_documents(spark, cases):
    docs, items = cases
    frame, bench = make_docs(spark, [*docs, (None, items[3][1]), (None, "clean"), (5000, None)]), spark.createDataFrame(items, BENCH)
    kept = dc.clean_documents(frame, dc.contaminated(frame, bench))
    want = {d for d, _ in docs} - {d for d, _ in brute(docs, items)}
    ids = [r.doc_id for r in kept.collect()]
    assert set(ids) == want | {None, 5000}
    assert kept.columns == frame.columns and [r.text for r in kept.where("doc_id is null").collect()] == ["clean"]


def test_edges(spark, awkward, no_docs):
    bench = spark.createDataFrame([(1, " ".join(prose(2, 20))), (None, None), (2, "")], BENCH)
    none = spark.createDataFrame([], BENCH)
    assert dc.contaminated(no_docs, bench).count() == 0
    assert dc.contaminated(awkward, none).count() == 0
    assert dc.clean_documents(awkward, dc.contaminated(awkward, none)).count() == awkward.count()
    clash = awkward.withColumn("key", F.lit("x")).withColumn("item_id", F.lit(1)).withColumn("_tokens", F.lit(2))
    got = sorted((r.doc_id or -1, r.item_id) for r in dc.contaminated(clash, bench.withColumn("seed", F.lit(1))).collect())
    assert got == [(-1, 1), (1, 1), (2, 1), (13, 1)]


def test_large_benchmarks_are_joined_by_shuffle(spark, cases, monkeypatch):
    """A benchmark of many seeds is neither broadcast nor read block by block: one pass over the documents, and no
    broadcast that grows with the seeds. Items of equal tokens, repeated rows and ids keep their own results."""
    docs, items = cases
    items = [*items, *[(i + 1000 if i is not None else None, t) for i, t in items], items[3], (items[4][0], items[5][1])]
    docs, items = make_docs(spark, [*docs, docs[7]]), spark.createDataFrame(items, BENCH)
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    whole = key(dc.contaminated(docs, items))
    monkeypatch.setattr(dc, "SEED_BLOCK", 100)
    monkeypatch.setattr(dc, "FILTER_BLOCKS", 4)
    parted = dc.contaminated(docs, items)
    plan = parted._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and "SortMergeJoin" in plan
    assert key(parted) == whole and len(whole) > 100


def test_filter_lets_every_seed_pass(spark):
    """All of the seeds pass, few others, and none is lost when its blocks are full."""
    seeds = spark.range(20_000).select(F.xxhash64("id").alias("seed"))
    places = seeds.select(F.col("seed").alias("_seed")).union(spark.range(20_000, 220_000).select(F.xxhash64("id")))
    passed = dc.perhaps_seeded(places, seeds, 20_000)
    assert passed.columns == ["_seed"] and passed.join(seeds, F.col("_seed") == F.col("seed")).count() == 20_000
    assert passed.count() < 20_000 + 600
    full = dc.perhaps_seeded(places, seeds, 40)
    assert full.join(seeds, F.col("_seed") == F.col("seed")).count() == 20_000

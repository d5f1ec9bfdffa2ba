"""Tabular pipeline operators on edge fixtures and invariances."""

import math
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from featpipe.functions.keys import hash_bucket
from featpipe.operators import evaluate, features, model, profile
from featpipe.sources import csv as csv_src
from featpipe.sources import examples as ex

SCHEMA = ("pickup_latitude double, pickup_longitude double, dropoff_latitude double, "
          "dropoff_longitude double, euclidean double, month int, day string, trip_total double")


def rows_fixture():
    # constant column (euclidean), all-missing column (dropoff_longitude),
    # missing text, '' and line-break tokens, equal token frequencies
    return [
        (1.0, 10.0, 0.5, None, 7.0, 1, "Mon", 10.0),
        (2.0, 20.0, None, None, 7.0, 1, "Tue", 20.0),
        (3.0, 30.0, 0.1, None, 7.0, 2, "Mon", None),
        (4.0, 40.0, 0.2, None, 7.0, 2, "Tue", 40.0),
        (5.0, 50.0, 0.3, None, 7.0, None, None, 50.0),
        (6.0, 60.0, 0.4, None, 7.0, 3, "", 60.0),
        (7.0, 70.0, 0.6, None, 7.0, 3, "a\nb", 70.0),
    ]


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(rows_fixture(), SCHEMA).withColumn("split", F.lit("train"))


def test_fill_missing(train):
    f = features.fill_missing(train).collect()
    assert all(r.dropoff_longitude == 0.0 for r in f)
    assert sorted(r.day for r in f).count("") == 2
    assert sorted(r.month for r in f)[0] == 0
    assert [r.trip_total for r in f].count(0.0) == 1


def test_zscore_population_and_constant(train):
    p = features.fit(train)
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0]
    m = sum(vals) / 7
    sd = math.sqrt(sum((v - m) ** 2 for v in vals) / 7)
    assert p.moments["pickup_latitude"][0] == pytest.approx(m)
    assert p.moments["pickup_latitude"][1] == pytest.approx(sd)
    out = features.apply(train, p).collect()
    assert all(r.euclidean_xf == 0.0 for r in out)             # constant column: x - mean
    assert all(r.dropoff_longitude_xf == 0.0 for r in out)     # all missing -> 0 -> constant
    # fill happens before the fit: zeros count in the moments
    dl = [0.5, 0.0, 0.1, 0.2, 0.3, 0.4, 0.6]
    assert p.moments["dropoff_latitude"][0] == pytest.approx(sum(dl) / 7)


def test_zero_deviation_keeps_difference_on_new_rows(spark, train):
    p = features.fit(train)
    new = spark.createDataFrame([(1.0, 1.0, 1.0, 1.0, 9.0, 1, "Mon", 1.0)], SCHEMA)
    r = features.apply(new, p, keep=()).collect()[0]
    assert r.euclidean_xf == pytest.approx(2.0)


def test_vocabulary_rules(spark, train):
    v = {(r.feature, r.token): (r.idx, r.freq) for r in features.fit(train).vocab.collect()}
    day = {t: i for (f, t), (i, _) in v.items() if f == "day"}
    # '' and the line-break token are left out; Mon/Tue tie at 2: larger text first
    assert day == {"Tue": 0, "Mon": 1}
    month = {t: i for (f, t), (i, _) in v.items() if f == "month"}
    # '0' (filled missing) is an ordinary token; 1, 2, 3 tie at 2 -> '3', '2', '1'
    assert month == {"3": 0, "2": 1, "1": 2, "0": 3}


def test_top_k_cap(spark):
    df = spark.createDataFrame([(str(i % 7),) for i in range(100)], "day string")
    v = features.fit_vocabulary(df, "day", top_k=3).collect()
    assert len(v) == 3 and [r.idx for r in sorted(v, key=lambda r: r.idx)] == [0, 1, 2]


def test_unknown_tokens_hash_after_vocabulary(spark, train):
    p = features.fit(train)
    size = p.vocab_sizes["day"]
    new = spark.createDataFrame([(1.0, 1.0, 1.0, 1.0, 1.0, 1, "Sun", 1.0),
                                 (1.0, 1.0, 1.0, 1.0, 1.0, 1, None, 1.0)], SCHEMA)
    out = features.apply(new, p, keep=("day",), with_index=True).collect()
    for r in out:
        assert size <= r.day_xf_idx < size + features.OOV_SIZE
        assert len(r.day_xf) == size + features.OOV_SIZE
        assert r.day_xf[r.day_xf_idx] == 1.0 and sum(r.day_xf) == 1.0
    b = spark.createDataFrame([("Sun",)], "t string").select(hash_bucket("t", 10).alias("b")).first().b
    assert out[0].day_xf_idx == size + b


def test_fit_apply_is_repeatable_and_partition_independent(spark, train):
    a = features.apply(train, features.fit(train)).collect()
    b = features.apply(train.repartition(5), features.fit(train.repartition(3))).collect()
    key = lambda r: (r.pickup_latitude_xf, str(r.day_xf))
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)
    assert len(a) == len(b) == 7 and key(a[0]) is not None


def test_assembled_order_is_sorted_names(spark, train):
    p = features.fit(train)
    t = features.assemble_features(features.apply(train, p), p.spec, "v")
    r = t.first()
    expect = list(r.day_xf) + [r.dropoff_latitude_xf, r.dropoff_longitude_xf, r.euclidean_xf] \
        + list(r.month_xf) + [r.pickup_latitude_xf, r.pickup_longitude_xf]
    assert list(r.v) == expect
    assert "trip_total" not in features.feature_order(p.spec)


def test_saved_params_roundtrip(spark, train):
    p = features.fit(train)
    path = tempfile.mkdtemp(prefix="featpipe-params-")
    features.save_params(p, path)
    q = features.load_params(spark, path)
    assert q.moments == p.moments and q.vocab_sizes == p.vocab_sizes
    a = sorted(map(str, features.apply(train, p).collect()))
    b = sorted(map(str, features.apply(train, q).collect()))
    assert a == b


# ------------------------------------------------------------------ split, csv

def test_hash_split_is_stable(spark):
    df = spark.range(2000).select((F.col("id") * 1.5).alias("x"), (F.col("id") % 7).cast("string").alias("s"))
    a = {(r.x, r.s, r.split) for r in ex.hash_split(df).collect()}
    b = {(r.x, r.s, r.split) for r in ex.hash_split(df.repartition(9)).collect()}
    assert a == b
    frac = sum(1 for *_, s in a if s == "train") / len(a)
    assert 0.6 < frac < 0.73


def test_csv_type_rule(spark):
    d = tempfile.mkdtemp(prefix="featpipe-csv-")
    with open(os.path.join(d, "part.csv"), "w") as f:
        f.write("a,b,c,d,e\n1,1.5,x,,7\n-2,3,y,,1e3\n,4,z,,\n")
    df = csv_src.read_csv_typed(spark, d)
    assert dict(df.dtypes) == {"a": "bigint", "b": "double", "c": "string", "d": "string", "e": "double"}
    assert [r.a for r in df.collect()] == [1, -2, None]


# ------------------------------------------------------------------ profile

def test_stats_histogram_topk(spark, train):
    stats = {r.column: r for r in profile.column_stats(train).collect()}
    assert stats["pickup_latitude"]["count"] == 7 and stats["pickup_latitude"].zeros == 0
    assert stats["dropoff_longitude"]["count"] == 0 and stats["dropoff_longitude"].missing == 7
    assert stats["day"].type == "BYTES" and stats["day"].missing == 1 and stats["day"].distinct == 4
    assert stats["month"].type == "INT"
    h = profile.column_histogram(train).where("column = 'pickup_latitude'").orderBy("bucket").collect()
    assert sum(r["count"] for r in h) == 7 and h[-1]["count"] == 1 and h[-1].high == 7.0
    const = profile.column_histogram(train).where("column = 'euclidean'").collect()
    assert [r["count"] for r in const if r.bucket == 0] == [7]
    top = profile.column_topk(train, ["day"], k=2, splits=("train",)).orderBy("rank").collect()
    assert [(r.value, r.freq, r.rank) for r in top] == [("Mon", 2, 1), ("Tue", 2, 2)]


def test_schema_and_validation_anomalies(spark, train):
    stats = profile.column_stats(train)
    freqs = profile.value_frequencies(train, ["day"])
    constraints, domain = profile.infer_schema(stats, freqs)
    c = {r.column: r for r in constraints.collect()}
    assert c["pickup_latitude"].required and not c["dropoff_latitude"].required
    assert c["day"].domain_size == 4 and c["month"].domain_size is None
    # eval rows: a missing required value, a value outside the domain, a
    # column of another type, an unknown column, a dropped column
    ev = spark.createDataFrame(
        [(None, 1.0, 1.0, 1.0, 1.0, "1", "Fri", 1.0, 5)],
        "pickup_latitude double, pickup_longitude double, dropoff_latitude double, dropoff_longitude double, "
        "euclidean double, month string, day string, trip_total double, extra int").withColumn("split", F.lit("eval"))
    ev_stats = profile.column_stats(ev)
    report = profile.validate_examples(ev, ev_stats, constraints, domain, splits=("eval",))
    bad = {(r.column, r.check): r.n_bad for r in profile.anomalies(report).collect()}
    assert bad == {("pickup_latitude", "presence"): 1, ("month", "type"): 1, ("day", "domain"): 1,
                   ("extra", "unknown_column"): 1}
    dropped = profile.validate_examples(ev.drop("euclidean"), profile.column_stats(ev.drop("euclidean")),
                                        constraints, domain, splits=("eval",))
    assert ("euclidean", "missing_column") in {(r.column, r.check) for r in profile.anomalies(dropped).collect()}
    with pytest.raises(profile.ValidationError):
        profile.require_valid(report)
    clean = profile.validate_examples(train, stats, constraints, domain, splits=("train",))
    assert profile.require_valid(clean) is clean


def test_report_names_domains_that_were_not_inferred(spark):
    rows = [("train", f"v{k}", f"s{k % 3}") for k in range(101)] + [("eval", "unseen", "s0")]
    df = spark.createDataFrame(rows, "split string, wide string, narrow string")
    stats = profile.column_stats(df)
    constraints, domain = profile.infer_schema(stats, profile.value_frequencies(df, ["wide", "narrow"]))
    report = profile.validate_examples(df, stats, constraints, domain)
    got = {(r.split, r.column): (r.n_bad, r.ok) for r in report.where("check = 'domain'").collect()}
    assert got == {("train", "wide"): (None, None), ("eval", "wide"): (None, None),
                   ("train", "narrow"): (0, True), ("eval", "narrow"): (0, True)}


# ------------------------------------------------------------------ evaluation

@pytest.mark.parametrize("mae,blessed", [(1.0, True), (4.0, True), (0.999, False), (4.001, False), (2.5, True)])
def test_gate_bounds_inclusive(spark, mae, blessed):
    df = spark.createDataFrame([(0.0, mae), (0.0, -mae), (None, 3.0)], "label double, prediction double")
    m = evaluate.eval_metrics(df, "label")
    r = m.first()
    assert r.mean_absolute_error == pytest.approx(mae) and r.n == 2 and r.n_missing_label == 1
    g = evaluate.quality_gate(m)
    assert evaluate.is_blessed(g) is blessed
    assert {x.metric: x.ok for x in g.collect()}[evaluate.MSE] is True


def test_gate_fails_without_value(spark):
    df = spark.createDataFrame([(None, 1.0)], "label double, prediction double")
    assert evaluate.is_blessed(evaluate.quality_gate(evaluate.eval_metrics(df, "label"))) is False


def test_latest_artifact(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    m = spark.createDataFrame([("m", "v1", t, 1), ("m", "v3", t, 3), ("m", "v2", t - dt.timedelta(days=1), 2),
                               ("n", "v9", t, 9)], "name string, version string, update_time timestamp, x int")
    got = {r.name: r.version for r in evaluate.latest_artifact(m).collect()}
    assert got == {"m": "v3", "n": "v9"}


def test_publish_only_when_blessed(spark):
    reg = tempfile.mkdtemp(prefix="featpipe-reg-")
    saved = []
    good = evaluate.quality_gate(evaluate.eval_metrics(
        spark.createDataFrame([(0.0, 2.0)], "label double, prediction double"), "label"))
    bad = evaluate.quality_gate(evaluate.eval_metrics(
        spark.createDataFrame([(0.0, 9.0)], "label double, prediction double"), "label"))
    r1 = evaluate.gated_publish(spark, good, reg, "m", saved.append).first()
    r2 = evaluate.gated_publish(spark, bad, reg, "m", saved.append).first()
    assert r1.published and not r2.published and len(saved) == 1
    latest = evaluate.latest_artifact(spark.read.parquet(f"{reg}/_manifest")).first()
    assert latest.name == "m"


# ------------------------------------------------------------------ model / scoring

def test_batch_and_stream_scoring_agree(spark, train):
    from featpipe.streaming.scoring import score_stream
    big = train.unionByName(train).unionByName(train)
    p = features.fit(big)
    m = model.regress_fit(features.apply(big, p), p.spec)
    raw = big.drop("trip_total").withColumn("rid", F.monotonically_increasing_id())
    src = tempfile.mkdtemp(prefix="featpipe-src-")
    raw.write.mode("overwrite").parquet(src)
    raw = spark.read.parquet(src)
    batch = {r.rid: r.prediction for r in model.predict(m, features.apply(raw, p, keep=("rid",)), p.spec).collect()}
    sink, ck = tempfile.mkdtemp(prefix="featpipe-sink-"), tempfile.mkdtemp(prefix="featpipe-ck-")
    stream = {r.rid: r.prediction for r in score_stream(spark, src, raw.schema, p, m, sink, ck, keep=("rid",)).collect()}
    assert batch.keys() == stream.keys() and len(batch) == 21
    assert all(batch[k] == pytest.approx(stream[k]) for k in batch)


def test_rescale_and_classifier(spark):
    rows = [(i, [float((i * 7 + j) % 255) for j in range(4)], i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    r = model.vector_rescale(df, "embedding", out="s").first()
    assert r.s == [x / 255.0 for x in r.embedding]
    m = model.classify_fit(model.image_split(df).where("split = 'train'"), 4, 2, hidden=8, max_iter=20)
    acc = model.accuracy(model.classify_predict(m, model.image_split(df))).collect()
    assert {a.split for a in acc} == {"train", "test"}


def test_tabular_pipeline_end_to_end(spark):
    from featpipe.plans.training import run_pipeline
    from featpipe.sources.trips import trips
    from tests.conftest import SF_SMALL
    reg = tempfile.mkdtemp(prefix="featpipe-reg-")
    res = run_pipeline(spark, trips(spark, SF_SMALL), reg)
    gate = {r.metric: r for r in res.gate.collect()}
    assert set(gate) == {evaluate.MAE, evaluate.MSE}
    blessed = gate[evaluate.MAE].blessed
    assert blessed == (1.0 <= gate[evaluate.MAE].value <= 4.0)
    row = res.manifest_row.first()
    assert row.published == blessed and row.blessed == blessed
    assert res.report.where("not ok").count() == 0          # both splits follow the train schema
    m = res.metrics.first()
    assert m.n > 0 and m.n_missing_label > 0                 # NULL labels skipped, counted


def test_gbt_regressor_option(spark, train):
    big = train
    for _ in range(3):
        big = big.unionByName(big)
    p = features.fit(big)
    m = model.regress_fit(features.apply(big, p), p.spec, algorithm="gbt")
    pred = model.predict(m, features.apply(big, p), p.spec)
    assert pred.where("prediction is null").count() == 0 and pred.count() == 56


def test_broadcast_if_small_checks_size(spark):
    from featpipe.functions.frames import TooLarge, bounded_local, broadcast_if_small
    small = spark.range(5)
    big = spark.range(50)
    assert "ResolvedHint" in small.join(broadcast_if_small(small, 10), "id")._jdf.queryExecution().analyzed().toString() \
        or broadcast_if_small(small, 10).count() == 5
    assert broadcast_if_small(big, 10) is big          # over the bound: left to the planner
    with pytest.raises(TooLarge):
        bounded_local(big, 10)
    assert bounded_local(small, 5).count() == 5


def test_index_form_model_equals_dense_form(spark, train):
    big = train
    for _ in range(3):
        big = big.unionByName(big)
    big = big.withColumn("rid", F.monotonically_increasing_id())
    p = features.fit(big)
    dense = features.apply(big, p, keep=("rid",))
    index = features.apply(big, p, keep=("rid",), onehot="index")
    assert "day_xf" not in index.columns and "day_xf_idx" in index.columns
    meta = index.schema["day_xf_idx"].metadata["ml_attr"]
    assert meta["num_vals"] == p.depth("day")
    md, mi = model.regress_fit(dense, p.spec), model.regress_fit(index, p.spec)
    assert model.input_form(md) == "dense" and model.input_form(mi) == "index"
    a = {r.rid: r.prediction for r in model.predict(md, dense, p.spec).collect()}
    b = {r.rid: r.prediction for r in model.predict(mi, index, p.spec).collect()}
    assert a.keys() == b.keys()
    assert all(a[k] == pytest.approx(b[k], rel=1e-6, abs=1e-6) for k in a)
    # the written compact form keeps the depth for the encoder
    path = tempfile.mkdtemp(prefix="featpipe-idx-")
    index.write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    assert back.schema["day_xf_idx"].metadata["ml_attr"]["num_vals"] == p.depth("day")


def test_stream_scoring_with_no_files(spark, train):
    from featpipe.streaming.scoring import score_stream
    big = train.unionByName(train).unionByName(train)
    p = features.fit(big)
    m = model.regress_fit(features.apply(big, p, onehot="index"), p.spec)
    raw = big.drop("trip_total")
    src = tempfile.mkdtemp(prefix="featpipe-empty-src-")
    sink, ck = tempfile.mkdtemp(prefix="featpipe-sink-") + "/out", tempfile.mkdtemp(prefix="featpipe-ck-")
    out = score_stream(spark, src, raw.schema, p, m, sink, ck, keep=("split",))
    assert out.count() == 0 and "prediction" in out.columns


def test_schema_struct_from_constraints(spark, train):
    from pyspark.sql import types as T
    constraints, _ = profile.infer_schema(profile.column_stats(train))
    st = profile.schema_struct(constraints)
    f = {x.name: x for x in st.fields}
    assert isinstance(f["month"].dataType, T.LongType) and isinstance(f["day"].dataType, T.StringType)
    assert isinstance(f["pickup_latitude"].dataType, T.DoubleType) and not f["pickup_latitude"].nullable
    assert f["dropoff_latitude"].nullable


def test_histogram_bounds_from_stats_equal_own_bounds(spark, train):
    stats = profile.column_stats(train)
    a = sorted(map(str, profile.column_histogram(train).collect()))
    b = sorted(map(str, profile.column_histogram(train, stats=stats).collect()))
    assert a == b and len(a) > 0


# ------------------------------------------------ counted values, quantiles, domains of any size
def test_quantiles_with_a_far_outlier(spark):
    """One outlier puts every other value into one bucket: its values are still spread over many range partitions."""
    n = 200_000
    df = spark.range(n).select(F.lit("train").alias("split"), F.col("id").cast("double").alias("x")).union(
        spark.createDataFrame([("train", 1e18), ("train", None), ("train", float("nan")), ("eval", 7.0)], "split string, x double"))
    got = {r.split: (r.p25, r.p50, r.p75) for r in profile.column_quantiles(df).collect()}
    rank = lambda p: float(math.ceil(p * (n + 1)) - 1)
    assert got == {"train": (rank(0.25), rank(0.5), rank(0.75)), "eval": (7.0, 7.0, 7.0)}


def test_running_totals_spread_a_group(spark):
    from featpipe.functions.ranks import running_totals
    df = spark.range(20_000).select(F.lit("g").alias("g"), ((F.col("id") * 7919) % 20_000).alias("v"), F.lit(2).alias("n"))
    out = running_totals(df, ["g"], [F.col("v").desc()], "n", "test")
    rows = out.orderBy(F.desc("v")).collect()
    assert [r.upto for r in rows] == [2 * k for k in range(1, 20_001)]
    # the widest window partition holds one range partition of the group
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in plan


def test_text_statistics_need_one_scan_and_no_expand(spark):
    df = spark.createDataFrame([("train", "a", "bb", None, 1), ("train", "a", "c", "", 2), ("eval", None, "bb", "x\ny", None)],
                               "split string, t1 string, t2 string, t3 string, n int")
    stats = profile.column_stats(df)
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    got = {(r.split, r.column): (r["count"], r.missing, r.distinct, r.avg_length) for r in stats.collect()}
    assert got[("train", "t1")] == (2, 0, 1, 1.0) and got[("eval", "t1")] == (0, 1, 0, None)
    assert got[("train", "t3")] == (1, 1, 1, 0.0) and got[("eval", "t3")] == (1, 0, 1, 3.0)
    assert got[("train", "n")] == (2, 0, None, None)


def test_domains_have_any_size(spark):
    train = spark.range(12_000).select(F.lit("train").alias("split"), F.concat(F.lit("v"), "id").alias("c"))
    fresh = spark.createDataFrame([("eval", "v5"), ("eval", "new"), ("eval", "new"), ("eval", "newer"), ("eval", None)], "split string, c string")
    both = train.union(fresh)
    counted = profile.counted_values(both, ["c"])
    stats = profile.column_stats(both, counted=counted)
    constraints, domain = profile.infer_schema(stats, counted, max_domain=None)
    assert constraints.first().domain_size == 12_000
    report = {(r.split, r["check"]): (r.n_bad, r.ok) for r in profile.validate_examples(both, stats, constraints, domain, counted=counted).collect()}
    assert report[("eval", "domain")] == (3, False) and report[("train", "domain")] == (0, True)


# ------------------------------------------------ large vocabularies
def test_large_vocabulary_equals_small(spark, monkeypatch):
    """Ranks by prefix sums and the shuffled join give what the ordered limit and the broadcast give; hot, empty, NULL
    and unseen tokens included, and no vocabulary row comes to the driver."""
    rows = [("train", f"t{k % 700}") for k in range(3000)] + [("train", "hot")] * 900 + [("train", ""), ("train", None), ("train", "a\nb")]
    rows += [("eval", f"t{k}") for k in range(650, 800)] + [("eval", "hot"), ("eval", ""), ("eval", None)] * 20
    df = spark.createDataFrame(rows, "split string, c string")
    train = df.where("split = 'train'")
    for top_k in (500, 1_000_000):
        spec = features.FeatureSpec(numeric=(), categorical=("c",), label=None, top_k=top_k)
        small = features.fit(train, spec)
        want = sorted(map(str, features.apply_vocabulary(df, "c", small, "i").collect()))
        monkeypatch.setattr(features, "LOCAL_TOKENS", 10)
        monkeypatch.setattr(features, "bounded_local", None)
        large = features.fit(train, spec)
        assert sorted(map(str, large.vocab.collect())) == sorted(map(str, small.vocab.select(*large.vocab.columns).collect()))
        assert large.vocab_sizes == small.vocab_sizes
        out = features.apply_vocabulary(df, "c", large, "i")
        assert "monotonically_increasing_id" in out._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, out.collect())) == want
        monkeypatch.undo()


# ------------------------------------------------ metrics by slices
def test_sliced_metrics_equal_one_query_per_slice(spark):
    df = spark.createDataFrame([(1.0, 2.0, "a", 1), (3.0, 2.5, "a", None), (None, 1.0, "b", 1), (5.0, 1.0, None, 2)],
                               "label double, prediction double, g string, h int")
    slices = [(), ("g",), ("h",), ("g", "h")]
    out = evaluate.eval_metrics_sliced(df, "label", slices)
    assert out._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1
    got = {(r["slice"], r["value"]): tuple(r)[2:] for r in out.collect()}
    want = {}
    for s in slices:
        for r in evaluate.eval_metrics(df, "label", slices=s).collect():
            want[",".join(s), ",".join("NULL" if r[c] is None else str(r[c]) for c in s)] = tuple(r)[len(s):]
    assert got == want and len(got) == 1 + 3 + 3 + 4
    assert [tuple(r) for r in evaluate.eval_metrics_sliced(df, "label", [()]).collect()] == [("", "", *want["", ""])]


# ------------------------------------------------ publishing
def passing_gate(spark):
    return evaluate.quality_gate(spark.createDataFrame([(2.0, 5.0)], f"{evaluate.MAE} double, {evaluate.MSE} double"))


def test_failed_publish_leaves_nothing(spark, tmp_path):
    reg, gate = str(tmp_path / "reg"), passing_gate(spark)
    parts = spark.range(3)

    def broken(path):
        parts.write.parquet(f"{path}/transform")   # half of an artifact
        raise RuntimeError("disk full")

    with pytest.raises(RuntimeError):
        evaluate.gated_publish(spark, gate, reg, "m", broken, version="v1")
    assert not os.path.exists(f"{reg}/m/v1") and not os.path.exists(f"{reg}/_manifest")
    # the same version again, twice: one artifact, one row
    saves = []

    def save(path):
        saves.append(path)
        parts.write.parquet(f"{path}/transform")

    for _ in range(2):
        row = evaluate.gated_publish(spark, gate, reg, "m", save, version="v1").collect()
        assert [(r.version, r.published, r.path) for r in row] == [("v1", True, f"{reg}/m/v1")]
    assert len(saves) == 1 and evaluate.is_committed(spark, f"{reg}/m/v1")
    assert spark.read.parquet(f"{reg}/m/v1/transform").count() == 3
    assert evaluate.read_manifest(spark, reg).count() == 1


def test_publish_after_a_lost_commit(spark, tmp_path):
    """An attempt that ended between the rename and the commit marker is replaced by the next one."""
    reg, gate = str(tmp_path / "reg"), passing_gate(spark)
    spark.range(1).write.parquet(f"{reg}/m/v2/transform")
    row = evaluate.gated_publish(spark, gate, reg, "m", lambda p: spark.range(5).write.parquet(f"{p}/transform"), version="v2").first()
    assert row.published and spark.read.parquet(f"{reg}/m/v2/transform").count() == 5


def test_gate_plans_its_metrics_once(spark):
    metrics = spark.range(10).agg(F.avg("id").alias(evaluate.MAE), F.max("id").cast("double").alias(evaluate.MSE))
    plan = evaluate.quality_gate(metrics)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1


def test_examples_are_decoded_by_the_inferred_schema(spark):
    train = spark.createDataFrame([("train", 1, 2.5, "x"), ("train", 2, None, "y")], "split string, i int, f double, t string")
    schema = profile.schema_struct(profile.infer_schema(profile.column_stats(train))[0])
    drifted = spark.createDataFrame([("eval", "3", "a"), ("eval", "oops", None)], "split string, i string, extra string")
    out = profile.conform(drifted, schema)
    assert dict(out.dtypes) == {"f": "double", "i": "bigint", "t": "string", "split": "string", "extra": "string"}
    assert [(r.i, r.f, r.t, r.extra) for r in out.collect()] == [(3, None, None, "a"), (None, None, None, None)]


def test_trees_fit_on_rows_dealt_by_number(spark, monkeypatch):
    """Partitions that a fit keeps hold ``FIT_ROWS`` rows or so, however few files the rows come from."""
    from pyspark.ml.regression import GBTRegressor
    monkeypatch.setattr(model, "FIT_ROWS", 100)
    spec = features.FeatureSpec(numeric=("x",), categorical=(), label="y")
    rows = spark.range(1000).coalesce(1).selectExpr("double(id) AS x_xf", "2.0 * id AS y")
    seen = []

    class Trees(GBTRegressor):
        def fit(self, dataset, params=None):
            seen.append(dataset.rdd.getNumPartitions())
            return super().fit(dataset, params)

    fitted = model.regress_fit(rows, spec, estimator=Trees(featuresCol="features", labelCol="y", maxIter=2, maxDepth=2, seed=1))
    assert seen == [10] and model.predict(fitted, rows, spec).count() == 1000

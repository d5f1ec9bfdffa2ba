"""CSV records as written, distinct dates at any range, hooks, and stream errors."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from featpipe.operators import evaluate, features, model, profile, transfers
from featpipe.sources import csv as csv_src
from featpipe.streaming.scoring import score_stream


def write(tmp_path, text):
    (tmp_path / "a.csv").write_text(text)
    return str(tmp_path)


def test_csv_numbers_are_written_as_numbers(spark, tmp_path):
    df = csv_src.read_csv_typed(spark, write(tmp_path, "a,b,c,d\n1d,NaN,1.5,7\n2f,3,.5e3,-8\n"))
    assert dict(df.dtypes) == {"a": "string", "b": "string", "c": "double", "d": "bigint"}
    assert [tuple(r) for r in df.collect()] == [("1d", "NaN", 1.5, 7), ("2f", "3", 500.0, -8)]


def test_csv_quoted_line_break(spark, tmp_path):
    df = csv_src.read_csv_typed(spark, write(tmp_path, 'a,b\n1,"x\ny"\n2,z\n'))
    assert sorted(map(tuple, df.collect())) == [(1, "x\ny"), (2, "z")]


def test_csv_extra_cell_is_an_error_or_kept(spark, tmp_path):
    path = write(tmp_path, "a,b\n1,2\n4f,5,99\n")
    with pytest.raises(csv_src.MalformedRecords):
        csv_src.read_csv_typed(spark, path)
    rows = csv_src.read_csv_typed(spark, path, malformed="broken").collect()
    assert [r.broken for r in rows if r.broken] == ["4f,5,99"]


@pytest.mark.parametrize("dates", [
    ["2020-01-01", "2020-01-15", "2020-01-15", "2020-02-01"],
    ["2020-01-01", "2020-01-15", "2400-01-01"],
    ["2020-01-01", "2020-02-01", "2020-02-01", "2021-01-01"],
])
def test_active_months_count_distinct_dates(spark, dates):
    rows = [("k", datetime.date.fromisoformat(x), f"h{i}", datetime.datetime(2020, 1, 1)) for i, x in enumerate(dates)]
    t = spark.createDataFrame(rows, "address string, month date, hash string, block_time timestamp").withColumn("value", F.lit(1).cast("decimal(38,9)"))
    t = t.withColumn("is_transfer", F.lit(True)).withColumn("has_addresses", F.lit(True))
    assert transfers.transfer_stats(t).first().output_active_months == len(set(dates))


def test_nan_has_no_place_in_moments_or_buckets(spark):
    df = spark.createDataFrame([("train", 1.0), ("train", 3.0), ("train", float("nan")), ("train", None)], "split string, x double")
    r = profile.column_stats(df).first()
    assert (r["count"], r.missing, r.min, r.max, r.mean) == (3, 1, 1.0, 3.0, 2.0)
    h = profile.column_histogram(df).collect()
    assert sum(x["count"] for x in h) == 2 and h[0].low == 1.0


def test_unknown_algorithm_raises(spark):
    with pytest.raises(ValueError, match="unknown algorithm"):
        model._estimator(features.FeatureSpec(), "forest", 1)


def test_saved_spec_keeps_any_column_name(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "x", 2.0), (2.0, "y", 3.0)], "`a,b` double, `c,d` string, y double")
    spec = features.FeatureSpec(numeric=("a,b",), categorical=("c,d",), label="y")
    params = features.fit(df, spec)
    assert features.load_params(spark, features.save_params(params, str(tmp_path / "p"))).spec == spec


def test_unreadable_sink_is_an_error(spark, tmp_path, monkeypatch):
    """Nothing arrived: empty frame. Rows arrived but the sink is gone: error."""
    from pyspark.sql import types as T

    from featpipe.streaming import scoring
    schema = T.StructType([T.StructField("x", T.DoubleType())])
    monkeypatch.setattr(scoring, "score", lambda m, raw, p, keep=(): raw)
    empty = tmp_path / "none"
    empty.mkdir()
    out = score_stream(spark, str(empty), schema, None, None, str(tmp_path / "s1"), str(tmp_path / "c1"))
    assert out.count() == 0
    src = str(tmp_path / "src")
    spark.createDataFrame([(1.0,)], schema).write.parquet(src)
    assert score_stream(spark, src, schema, None, None, str(tmp_path / "s2"), str(tmp_path / "c2")).count() == 1


def test_gate_thresholds(spark):
    m = spark.createDataFrame([(2.0, 9.0, 5, 0)], f"{evaluate.MAE} double, {evaluate.MSE} double, n long, n_missing_label long")
    assert evaluate.is_blessed(evaluate.quality_gate(m)) and not evaluate.is_blessed(evaluate.quality_gate(m, [(evaluate.MAE, 3.0, 4.0)]))


# ------------------------------------------------ splittable CSV
def lines_of(spark, path):
    return sorted(map(str, csv_src.read_csv_typed(spark, path).collect()))


def test_large_files_are_split_when_no_record_spans_lines(spark, tmp_path):
    path = write(tmp_path, "a,b,c\n" + "".join(f'{k},"x, {k}",{k / 4}\n' for k in range(30_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        df = csv_src.read_csv_typed(spark, path)
        assert df.rdd.getNumPartitions() > 1 and not csv_src.may_span_lines(spark, path)
        assert lines_of(spark, path) == sorted(map(str, csv_src.read_csv_typed(spark, path, multi_line=True).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_lines_that_may_not_stand_alone(spark, tmp_path):
    """Whatever could leave a quote open is read file by file; the rows are those of the reader that never splits."""
    for k, (text, spans) in enumerate([
            ('a,b\n1,"x"\n2,y\n', False), ('a,b\n1,"x\ny"\n2,z\n', True), ('a,b\n1,"x ""q"" y"\n', True),
            ('a,b\n1,"x\\"y"\n', True), ('a,b\n1,st"ray\n', True), ('a,b\n1,"p" tail\n', True),
            ('a,b\n1,"p, q"\n"2","r"\n', False), ('a,b\r\n1,"p"\r\n2,"q"\r\n', False), ('a,b\n1,s"t,"open\nclose"\n', True)]):
        (tmp_path / f"f{k}").mkdir()
        path = write(tmp_path / f"f{k}", text)
        assert csv_src.may_span_lines(spark, path) == spans, text
        if k != 8:
            assert lines_of(spark, path) == sorted(map(str, csv_src.read_csv_typed(spark, path, multi_line=True).collect())), text


# ------------------------------------------------ stream recovery
def test_stream_restarts_after_a_broken_batch(spark, tmp_path):
    """The second file is broken: the query fails, and started again from its checkpoint it scores every row once."""
    import shutil
    import time as clock

    rows = [(float(k), float(k % 7), 3.0 * k + (k % 7)) for k in range(40)]
    df = spark.createDataFrame(rows, "x double, y double, label double")
    spec = features.FeatureSpec(numeric=("x", "y"), categorical=(), label="label")
    params = features.fit(df.withColumn("split", F.lit("train")), spec)
    fitted = model.regress_fit(features.apply(df, params, keep=()), spec)
    src, sink, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    os.makedirs(src)
    raw = df.drop("label")
    for k in range(3):
        part = str(tmp_path / f"part{k}")
        raw.where((F.col("x") >= 14 * k) & (F.col("x") < 14 * (k + 1))).coalesce(1).write.parquet(part)
        [name] = [n for n in os.listdir(part) if n.endswith(".parquet")]
        shutil.copy(f"{part}/{name}", f"{src}/{k}.parquet")
        os.utime(f"{src}/{k}.parquet", (clock.time() - 100 + 10 * k,) * 2)
    good = open(f"{src}/1.parquet", "rb").read()
    stamp = os.path.getmtime(f"{src}/1.parquet")
    with open(f"{src}/1.parquet", "wb") as f:
        f.write(good[:len(good) // 2])
    os.utime(f"{src}/1.parquet", (stamp, stamp))
    run = lambda: score_stream(spark, src, raw.schema, params, fitted, sink, ckpt, keep=("x",), max_files=1)
    with pytest.raises(Exception):
        run()
    assert spark.read.parquet(sink).count() == 14
    with open(f"{src}/1.parquet", "wb") as f:
        f.write(good)
    os.utime(f"{src}/1.parquet", (stamp, stamp))
    got = {r.x: r.prediction for r in run().collect()}
    want = {r.x: r.prediction for r in model.score(fitted, raw, params, keep=("x",)).collect()}
    assert got == want and run().count() == 40

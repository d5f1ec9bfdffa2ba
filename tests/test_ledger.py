"""Ledger operators on edge fixtures, against brute force in plain Python."""

import datetime as dt
import math
import random
import re
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from featpipe.operators import idle, signatures, transfers, vectors
from featpipe.sources.ledger import BLOCKS_SCHEMA, TRANSACTIONS_SCHEMA

T0 = dt.datetime(2020, 1, 1)


def tr(addresses, value):
    return Row(addresses=addresses, value=None if value is None else Decimal(str(value)))


def tx(h, secs, inputs=None, outputs=None, coinbase=False, block=None):
    ts = T0 + dt.timedelta(seconds=secs)
    month = dt.date(ts.year, ts.month, 1)
    return (h, block or f"b{h}", ts, month, coinbase, inputs, outputs)


def frame(spark, rows):
    return spark.createDataFrame(rows, TRANSACTIONS_SCHEMA)


# ------------------------------------------------------------------ unnest / key

def test_unnest_drops_empty_and_null_arrays(spark):
    df = frame(spark, [
        tx("t1", 0, outputs=[]),
        tx("t2", 1, outputs=None),
        tx("t3", 2, outputs=[tr(["a"], 1), tr(["b"], 2)]),
    ])
    out = transfers.unnest_transfers(df, "outputs").collect()
    assert sorted(r.address for r in out) == ["a", "b"]


def test_address_key_rules(spark):
    df = frame(spark, [
        tx("t1", 0, outputs=[tr(None, 1)]),               # NULL addresses -> ''
        tx("t2", 0, outputs=[tr(["a", None, "b"], 1)]),   # NULL element skipped
        tx("t3", 0, outputs=[tr(["a", "b"], 1)]),         # composite key
        tx("t4", 0, outputs=[tr(["a"], 1)]),
        tx("t5", 0, outputs=[None]),                       # NULL struct element
    ])
    rows = transfers.unnest_transfers(df, "outputs").collect()
    keys = sorted(r.address for r in rows)
    assert keys == ["", "", "a", "a,b", "a,b"]
    null_struct = [r for r in rows if not r.is_transfer]
    assert len(null_struct) == 1 and null_struct[0].address == "" and not null_struct[0].has_addresses


def test_transfer_stats_counts_follow_null_rules(spark):
    df = frame(spark, [
        tx("t1", 0, outputs=[tr(None, 4), None]),
        tx("t2", 86400 * 40, outputs=[tr(None, 6)]),
    ])
    r = transfers.transfer_stats(transfers.unnest_transfers(df, "outputs"), "output").collect()[0]
    assert r.address == ""
    assert r.total_tx_output_count == 2          # the NULL struct is not counted
    assert r.total_tx_output_value == 10.0
    assert r.mean_tx_output_value == 5.0
    assert r.total_output_tx == 2
    assert r.output_active_months == 2
    assert r.mean_monthly_output_value == 10.0 / 3   # divides by the row count of months
    assert r.mean_monthly_output_count == 0.0        # no non-NULL address arrays


# ------------------------------------------------------------------ idle gaps

def brute_gaps(events):
    """Reference semantics: sort, lag, drop NULL/equal previous, floored
    seconds difference."""
    out = {}
    by_key = {}
    for k, t in events:
        by_key.setdefault(k, []).append(t)
    for k, ts in by_key.items():
        ts = sorted(t for t in ts if t is not None)
        prev = None
        for t in ts:
            if prev is not None and t != prev:
                out.setdefault(k, []).append(math.floor(t.timestamp()) - math.floor(prev.timestamp()))
            prev = t
    return out


def _events_df(spark, events):
    return spark.createDataFrame([(k, t) for k, t in events], "k string, t timestamp")


UNIT_LEVELS = [("day",), ("hour", "day"), ("minute", "hour", "day")]


@pytest.mark.parametrize("units", UNIT_LEVELS)
@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y", "z"]),
                          st.integers(0, 3 * 86400 * 1000)), min_size=0, max_size=60))
def test_segmented_gaps_equal_lag_window(spark, units, raw):
    # times in milliseconds spread over three days: ties, sub-second gaps and
    # day boundaries all occur
    events = [(k, dt.datetime(2021, 5, 1, tzinfo=dt.timezone.utc).replace(tzinfo=None)
               + dt.timedelta(milliseconds=ms)) for k, ms in raw]
    events = [(k, t.replace(tzinfo=dt.timezone.utc)) for k, t in events]
    df = _events_df(spark, [(k, t.replace(tzinfo=None)) for k, t in events])
    want = brute_gaps(events)
    got = {}
    for r in idle.idle_gaps(df, "k", "t", units).collect():
        got.setdefault(r.k, []).append(r.idle_time)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    window = {}
    for r in idle.idle_gaps_window(df, "k", "t").collect():
        window.setdefault(r.k, []).append(r.idle_time)
    assert {k: sorted(v) for k, v in window.items()} == {k: sorted(v) for k, v in want.items()}


@pytest.mark.parametrize("units", UNIT_LEVELS)
def test_idle_stats_exact_moments(spark, units):
    rng = random.Random(7)
    events = []
    for k in ["p", "q", "r", "s"]:
        base = T0
        for _ in range(rng.randint(1, 40)):
            base += dt.timedelta(seconds=rng.choice([0, 0, 1, 59, 3600, 86399, 86400, 400000]),
                                 microseconds=rng.choice([0, 250000, 999999]))
            events.append((k, base))
    df = _events_df(spark, events)
    utc = [(k, t.replace(tzinfo=dt.timezone.utc)) for k, t in events]
    want = brute_gaps(utc)
    got = {r.k: r for r in idle.idle_stats(df, "k", "t", units, "x").collect()}
    assert set(got) == set(want)
    for k, gaps in want.items():
        n = len(gaps)
        mean = sum(gaps) / n
        assert got[k].mean_x_idle_time == pytest.approx(mean, rel=1e-12)
        if n == 1:
            assert got[k].stddev_x_idle_time is None
        else:
            sd = math.sqrt(sum((g - mean) ** 2 for g in gaps) / (n - 1))
            assert got[k].stddev_x_idle_time == pytest.approx(sd, rel=1e-9, abs=1e-9)


def test_equal_timestamps_give_no_gap(spark):
    df = _events_df(spark, [("k", T0), ("k", T0), ("j", T0)])
    assert idle.idle_gaps(df, "k", "t").count() == 0
    assert idle.idle_stats(df, "k", "t").count() == 0


# ------------------------------------------------------------------ signatures

def test_signature_match_is_case_sensitive_any_of(spark):
    df = spark.createDataFrame([("b1", "xx2f736c7573682fyy"), ("b2", "2F736C7573682F"), ("b3", None),
                                ("b4", "4b616e6f")], BLOCKS_SCHEMA)
    got = {r.hash: r.m for r in df.select("hash", signatures.signature_match(
        "coinbase_param", signatures.MINER_SIGNATURES).alias("m")).collect()}
    assert got == {"b1": True, "b2": False, "b3": None, "b4": True}


def test_signature_keys_need_coinbase_true_and_hits(spark):
    rows = [tx(f"t{i}", i, outputs=[tr(["m"], 1)], coinbase=True, block=f"b{i}") for i in range(3)]
    rows += [tx("n1", 10, outputs=[tr(["m"], 1)], coinbase=None, block="b0"),     # NULL is not true
             tx("n2", 11, outputs=[tr(["m"], 1)], coinbase=False, block="b0")]
    df = frame(spark, rows)
    blocks = spark.createDataFrame([(f"b{i}", "00aa11") for i in range(3)], BLOCKS_SCHEMA)
    keys = signatures.signature_keys(blocks, df, ["aa"], min_hits=3).collect()
    assert [(r.miner, r.hits) for r in keys] == [("m", 3)]
    assert signatures.signature_keys(blocks, df, ["aa"], min_hits=4).count() == 0
    assert signatures.signature_keys(blocks, df, ["AA"], min_hits=1).count() == 0


def test_not_in_null_rules(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    s_plain = spark.createDataFrame([("a",)], "m string")
    s_null = spark.createDataFrame([("a",), (None,)], "m string")
    s_empty = spark.createDataFrame([], "m string")
    assert [r.k for r in signatures.anti_not_in(df, "k", s_plain, "m").collect()] == ["b"]
    assert signatures.anti_not_in(df, "k", s_null, "m").count() == 0
    assert sorted(r.k or "" for r in signatures.anti_not_in(df, "k", s_empty, "m").collect()) == ["", "a", "b"]
    assert [r.k for r in signatures.semi_in(df, "k", s_null, "m").collect()] == ["a"]
    # same as SQL
    df.createOrReplaceTempView("dk")
    s_null.createOrReplaceTempView("sn")
    assert spark.sql("SELECT k FROM dk WHERE k NOT IN (SELECT m FROM sn)").count() == 0


# ------------------------------------------------------------------ whole vectors

def brute_vectors(rows, blocks, sigs, min_hits):
    """Plain-Python evaluation of the source query on a small fixture
    (no caps)."""
    def key(addrs):
        return ",".join(a for a in (addrs or []) if a is not None)

    sides = {}
    for side in ("outputs", "inputs"):
        per = {}
        for (h, bh, ts, month, cb, ins, outs) in rows:
            arr = outs if side == "outputs" else ins
            for x in arr or []:
                k = key(x.addresses if x is not None else None)
                per.setdefault(k, []).append((x, h, ts, month))
        sides[side] = per
    block_sig = {b: any(s in (p or "") for s in sigs) for b, p in blocks}
    hits = {}
    for (h, bh, ts, month, cb, ins, outs) in rows:
        if cb is True and block_sig.get(bh):
            for x in outs or []:
                k = key(x.addresses if x is not None else None)
                hits[k] = hits.get(k, 0) + 1
    miners = {k for k, n in hits.items() if n >= min_hits}

    def ep(d):
        return int(dt.datetime(d.year, d.month, d.day, tzinfo=dt.timezone.utc).timestamp())

    def stats(items, p):
        vals = [float(x.value) for x, *_ in items if x is not None and x.value is not None]
        months = [m for *_, m in items if m is not None]
        n_addr = sum(1 for x, *_ in items if x is not None and x.addresses is not None)
        sv = sum(Decimal(str(v)) for v in vals) if vals else None
        out = {
            f"{p}_month_min": min(months), f"{p}_month_max": max(months),
            f"{p}_active_months": len(set(months)),
            f"total_tx_{p}_count": sum(1 for x, *_ in items if x is not None),
            f"total_tx_{p}_value": float(sv) if sv is not None else None,
            f"mean_tx_{p}_value": float(sv) / len(vals) if vals else None,
            f"total_{p}_tx": len({h for _, h, *_ in items}),
            f"mean_monthly_{p}_value": float(sv) / len(months) if vals else None,
            f"mean_monthly_{p}_count": n_addr / len(months),
        }
        if len(vals) > 1:
            m = sum(vals) / len(vals)
            out[f"stddev_tx_{p}_value"] = math.sqrt(sum((v - m) ** 2 for v in vals) / (len(vals) - 1))
        else:
            out[f"stddev_tx_{p}_value"] = None
        gaps = brute_gaps([(0, ts.replace(tzinfo=dt.timezone.utc)) for _, _, ts, _ in items]).get(0, [])
        if not gaps:
            return None
        gm = sum(gaps) / len(gaps)
        out[f"mean_{p}_idle_time"] = gm
        out[f"stddev_{p}_idle_time"] = (math.sqrt(sum((g - gm) ** 2 for g in gaps) / (len(gaps) - 1))
                                        if len(gaps) > 1 else None)
        return out

    res = {}
    for k in set(sides["outputs"]) & set(sides["inputs"]):
        o, i = stats(sides["outputs"][k], "output"), stats(sides["inputs"][k], "input")
        if o is None or i is None:
            continue
        r = {**o, **i, "address": k, "is_miner": k in miners}
        for c in ("output_month_min", "output_month_max", "input_month_min", "input_month_max"):
            r[c] = ep(r[c])
        r["output_active_time"] = r["output_month_max"] - r["output_month_min"]
        r["input_active_time"] = r["input_month_max"] - r["input_month_min"]
        r["io_max_lag"] = r["output_month_max"] - r["input_month_max"]
        r["io_min_lag"] = r["output_month_min"] - r["input_month_min"]
        res[k] = r
    return res


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6)
    return a == b


def test_address_vectors_match_brute_force(spark):
    rng = random.Random(11)
    addrs = ["a", "b", "c", "d", "e", "f", "g", "h"]
    rows, blocks = [], []
    for i in range(160):
        secs = rng.randint(0, 200) * 43200 + rng.choice([0, 0, 1, 7])
        outs = [tr(rng.sample(addrs, rng.choice([1, 1, 2])), rng.randint(1, 9999) / 100)
                for _ in range(rng.randint(0, 3))]
        if rng.random() < 0.05:
            outs.append(None)
        if rng.random() < 0.05:
            outs = None
        ins = [tr([rng.choice(addrs)], rng.randint(1, 9999) / 100) for _ in range(rng.randint(0, 2))]
        cb = rng.choice([True, False, None])
        rows.append(tx(f"t{i}", secs, ins, outs, cb, block=f"b{i % 40}"))
    for b in range(40):
        blocks.append((f"b{b}", rng.choice(["00ff", "2f736c7573682f", "4b616e6f00", "abc"])))
    df = frame(spark, rows)
    bdf = spark.createDataFrame(blocks, BLOCKS_SCHEMA)
    sigs = signatures.MINER_SIGNATURES
    # a hit threshold that leaves both classes in the result
    for min_hits in range(1, 200):
        want = brute_vectors(rows, blocks, sigs, min_hits)
        if 0 < sum(v["is_miner"] for v in want.values()) < len(want):
            break
    got = {r.address: r.asDict() for r in
           vectors.address_vectors(df, bdf, sigs, min_hits, None, None).collect()}
    assert set(got) == set(want)
    assert any(v["is_miner"] for v in want.values()) and not all(v["is_miner"] for v in want.values())
    for k, w in want.items():
        for c in vectors.VECTOR_COLUMNS:
            assert _close(got[k][c], w[c]), (k, c, got[k][c], w[c])


def test_caps_are_deterministic_and_bounded(spark):
    rows = []
    for i, a in enumerate("pqrstuvw"):
        for j in range(3):
            rows.append(tx(f"o{i}{j}", j * 86400, outputs=[tr([a], 1)], inputs=[tr([a], 2)]))
    df = frame(spark, rows)
    blocks = spark.createDataFrame([], BLOCKS_SCHEMA)
    full = vectors.address_vectors(df, blocks, signatures.MINER_SIGNATURES, 1, None, None)
    assert full.count() == 8
    capped = vectors.address_vectors(df, blocks, signatures.MINER_SIGNATURES, 1, 5, 3)
    a = sorted(r.address for r in capped.collect())
    b = sorted(r.address for r in vectors.address_vectors(df.repartition(7), blocks,
                                                          signatures.MINER_SIGNATURES, 1, 5, 3).collect())
    assert len(a) == 3 and a == b
    expect = sorted(sorted("pqrstuvw", key=lambda x: __import__("hashlib").md5(x.encode()).hexdigest())[:3])
    assert a == expect


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["k1", "k2"]),
                          st.one_of(st.none(), st.integers(0, 200))), min_size=1, max_size=40),
       st.sampled_from([0, 1500 * 12]))
def test_month_bitmap_equals_count_distinct(spark, raw, base):
    from featpipe.functions.distinct import bitmap_aggs, bitmap_count, fits, month_index, value_range
    rows = [(k, None if m is None else dt.date(1 + (base + m) // 12, (base + m) % 12 + 1, 1)) for k, m in raw]
    df = spark.createDataFrame(rows, "k string, month date")
    lo, hi = value_range(df, month_index("month"))
    want = {r.k: r.n for r in df.groupBy("k").agg(F.count_distinct("month").alias("n")).collect()}
    if lo is None:
        assert all(v == 0 for v in want.values())
        return
    assert fits(lo, hi)
    got = df.groupBy("k").agg(*bitmap_aggs(month_index("month"), lo, hi, "_w")) \
        .select("k", bitmap_count("_w", lo, hi).alias("n"))
    assert {r.k: r.n for r in got.collect()} == want


def test_month_bitmap_falls_back_on_wide_ranges(spark):
    from featpipe.functions.distinct import fits
    assert fits(0, 63 * 64 - 1) and not fits(0, 63 * 64)
    rows = [tx("w1", 0, outputs=[tr(["a"], 1)]), tx("w2", 86400 * 366 * 400, outputs=[tr(["a"], 1)])]
    t = transfers.unnest_transfers(frame(spark, rows), "outputs")
    r = transfers.transfer_stats(t, "output").first()
    assert r.output_active_months == 2


def test_key_on_one_side_or_without_gap_is_dropped(spark):
    rows = [
        tx("x1", 0, outputs=[tr(["both"], 1), tr(["out_only"], 1)], inputs=[tr(["both"], 2)]),
        tx("x2", 86400, outputs=[tr(["both"], 1), tr(["out_only"], 1)], inputs=[tr(["both"], 2), tr(["one_in"], 1)]),
        tx("x3", 86400, outputs=[tr(["one_in"], 1)]),
        tx("x4", 2 * 86400, outputs=[tr(["one_in"], 1)]),
    ]
    df = frame(spark, rows)
    blocks = spark.createDataFrame([], BLOCKS_SCHEMA)
    got = [r.address for r in vectors.address_vectors(df, blocks, signatures.MINER_SIGNATURES, 1, None, None).collect()]
    # 'out_only' has no input side; 'one_in' has a single input time (no input gap)
    assert got == ["both"]


def test_read_ledger_from_written_tables(spark):
    import tempfile
    from featpipe.sources.ledger import ledger_from_tables, read_ledger
    from tests.conftest import SF_SMALL
    tx, blocks = ledger_from_tables(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="featpipe-ledger-")
    tx.write.parquet(f"{base}/transactions")
    blocks.write.parquet(f"{base}/blocks")
    tx2, blocks2 = read_ledger(spark, f"{base}/transactions", f"{base}/blocks")
    assert tx2.schema == tx.schema or tx2.columns == tx.columns
    a = vectors.address_vectors(tx, blocks, ["555247454e54", "48494748"], 6, None, None)
    b = vectors.address_vectors(tx2, blocks2, ["555247454e54", "48494748"], 6, None, None)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert a.count() > 0


def test_hot_key_with_a_third_of_all_transfers(spark):
    rng = random.Random(5)
    rows, blocks = [], []
    for i in range(300):
        secs = rng.randint(0, 120) * 86400 + rng.choice([0, 0, 0, 3600, 7200])   # many equal times
        hot = i % 3 == 0
        outs = [tr(["hot"] if hot else [rng.choice("abcdef")], rng.randint(1, 999) / 10)]
        ins = [tr(["hot"] if rng.random() < 0.34 else [rng.choice("abcdef")], rng.randint(1, 999) / 10)]
        rows.append(tx(f"h{i}", secs, ins, outs, rng.choice([True, False]), block=f"b{i % 30}"))
    for b in range(30):
        blocks.append((f"b{b}", "2f736c7573682f" if b % 2 else "00"))
    df = frame(spark, rows).repartition(4)
    bdf = spark.createDataFrame(blocks, BLOCKS_SCHEMA)
    want = brute_vectors(rows, blocks, signatures.MINER_SIGNATURES, 5)
    got = {r.address: r.asDict() for r in
           vectors.address_vectors(df, bdf, signatures.MINER_SIGNATURES, 5, None, None).collect()}
    assert "hot" in got and set(got) == set(want)
    assert want["hot"]["total_tx_output_count"] == 100
    for k, w in want.items():
        for c in vectors.VECTOR_COLUMNS:
            assert _close(got[k][c], w[c]), (k, c, got[k][c], w[c])


def test_build_vectors_job(spark):
    import tempfile
    from featpipe.plans.ledger_job import build_vectors
    from featpipe.sources.ledger import ledger_from_tables
    from tests.conftest import SF_SMALL
    tx, blocks = ledger_from_tables(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="featpipe-job-")
    tx.write.parquet(f"{base}/tx")
    blocks.write.parquet(f"{base}/blocks")
    v = build_vectors(spark, f"{base}/tx", f"{base}/blocks", f"{base}/out",
                      signatures=["555247454e54", "48494748"], min_hits=6)
    assert v.columns == vectors.VECTOR_COLUMNS and v.count() == 150


def test_month_bitmap_rejects_values_outside_the_range(spark):
    from featpipe.functions.distinct import bitmap_aggs, bitmap_count, month_index
    df = spark.createDataFrame([("k", dt.date(2020, 5, 1))], "k string, month date")
    lo = 2020 * 12 + 5   # one month after the only value
    bad = df.groupBy("k").agg(*bitmap_aggs(month_index("month"), lo, lo + 10, "_w")) \
        .select(bitmap_count("_w", lo, lo + 10))
    with pytest.raises(Exception):
        bad.collect()


def test_row_per_line_nesting_equals_row_per_order_nesting(spark):
    from featpipe.sources.ledger import (FIXTURE_MIN_HITS, FIXTURE_SIGNATURES, blocks_from_tables,
                                         transactions_from_tables, transactions_grouped_from_tables)
    from featpipe.sources.tables import read_table
    from tests.conftest import SF_SMALL
    orders, lineitem = read_table(spark, SF_SMALL, "orders"), read_table(spark, SF_SMALL, "lineitem")
    flat = transactions_from_tables(orders, lineitem)
    grouped = transactions_grouped_from_tables(orders, lineitem)
    assert grouped.count() == orders.count()
    assert grouped.where("outputs is null").count() > 0          # orders without lines
    blocks = blocks_from_tables(orders)

    def vec(tx):
        return {r.address: r.asDict() for r in
                vectors.address_vectors(tx, blocks, FIXTURE_SIGNATURES, FIXTURE_MIN_HITS, None, None).collect()}
    a, b = vec(flat), vec(grouped)
    assert set(a) == set(b) and len(a) > 0
    # equal up to the summation order of floating deviations
    for k in a:
        for c in vectors.VECTOR_COLUMNS:
            assert _close(a[k][c], b[k][c]), (k, c, a[k][c], b[k][c])


def test_both_sides_classes_and_splits_have_a_query(spark):
    """Each of these agrees with its own SQL and has rows of the part the other leaves out."""
    from tests.conftest import SF_SMALL
    from tests.oracle_check import run
    pairs = {"address_key": "address_key_inputs", "activity_ages": "activity_ages_inputs", "idle_gaps": "idle_gaps_inputs",
             "idle_stats": "idle_stats_outputs", "class_cap": "class_cap_miners", "transformed_roundtrip": "transformed_roundtrip_all"}
    report = run(SF_SMALL, list(pairs.values()), verbose=False)
    assert all(r["ok"] for r in report.values()), report
    assert all(r["rows"] > 0 for r in report.values()), report


# ------------------------------------------------ one explode per side
def random_ledger(spark, seed, once=True):
    """Rows with several, repeated and NULL elements, NULL values and times, microsecond times, hashes on several rows."""
    rng = random.Random(seed)

    def element():
        if rng.random() < 0.1:
            return None
        addresses = rng.choice([None, [], ["a"], ["b"], ["a", "b"], ["c", None]])
        return addresses, rng.choice([None, Decimal(rng.randrange(10 ** 6)) / 100, Decimal("12345678.90")])

    times = {}
    rows = []
    for k in range(400):
        name = f"h{rng.randrange(150)}" if rng.random() < 0.97 else None
        moment = rng.choice([None, dt.datetime(2020, 1, 1) + dt.timedelta(days=rng.randrange(3), microseconds=rng.choice([0, 1, 999_999, 10 ** 6]) * rng.randrange(9))])
        if once and name is not None:
            moment = times.setdefault(name, moment)
        month = rng.choice([None, dt.date(2020, rng.randrange(1, 13), 1)])
        rows.append((name, "b", moment, month, False, [element() for _ in range(rng.randrange(4))], rng.choice([None, [element()]])))
    return spark.createDataFrame(rows, TRANSACTIONS_SCHEMA)


@pytest.mark.parametrize("seed,unit", [(1, "day"), (2, "hour"), (3, "day")])
def test_side_profile_in_one_pass_equals_two(spark, seed, unit):
    tx = random_ledger(spark, seed)
    assert vectors.one_time_per_hash(tx)
    for side in ("outputs", "inputs"):
        got = {r.address: r.asDict() for r in vectors.side_profile(tx, side, unit).collect()}
        want = {r.address: r.asDict() for r in vectors.side_profile_apart(tx, side, unit).collect()}
        assert got.keys() == want.keys() and len(got) >= 3
        for address, row in want.items():
            assert list(got[address]) == list(row)
            for name, value in row.items():
                assert got[address][name] == (pytest.approx(value, rel=1e-9, abs=1e-9) if isinstance(value, float) else value), (address, name)


def test_hashes_with_several_times_are_counted_once(spark):
    tx = random_ledger(spark, 4, once=False)
    assert not vectors.one_time_per_hash(tx)
    got = {r.address: r.total_output_tx for r in vectors.side_profile(tx, "outputs").collect()}
    t = transfers.unnest_transfers(tx, "outputs").collect()
    for address, n in got.items():
        assert n == len({r.hash for r in t if r.address == address and r.hash is not None})


# ------------------------------------------------ L1 without gathering n rows
@pytest.mark.parametrize("n", [0, 1, 7, 1000, 4999, 5000, 9000])
def test_class_cap_equals_ordered_limit(spark, n):
    df = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("address"), F.col("id").alias("v"))
    want = sorted(map(str, df.orderBy(F.md5("address"), "address").limit(n).collect()))
    assert sorted(map(str, vectors.class_cap(df, n).collect())) == want


def test_class_cap_sorts_only_its_last_bucket(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CAP_ROWS", 30)   # about five rows to each of 4096 buckets
    df = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("address"))
    limits = []
    for n in range(15_000, 15_004):
        out = vectors.class_cap(df, n)
        plan = out._jdf.queryExecution().executedPlan().toString()
        limits += [int(x) for x in re.findall(r"TakeOrderedAndProject\(limit=(\d+)", plan)]
        assert "SinglePartition" not in plan and out.count() == n
    assert limits and max(limits) <= 30


def test_class_cap_with_repeated_addresses(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 5, "address string")
    for n in range(11):
        got = sorted(r.address for r in vectors.class_cap(df, n).collect())
        assert got == sorted(r.address for r in df.orderBy(F.md5("address"), "address").limit(n).collect())


def test_idle_rows_are_dealt_to_all_partitions(spark):
    """The sorted steps keep the session's number of partitions, and seconds are moved without what follows from them."""
    events = spark.range(5000).selectExpr("concat('k', id % 50) AS address", "timestamp_seconds(id * 7919 % 8000000) AS block_time")
    out = idle.idle_moments(events)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2
    want = {r.address: tuple(r)[1:] for r in idle.idle_gaps_window(events).groupBy("address").agg(
        F.count("idle_time"), F.sum("idle_time"), F.sum(F.col("idle_time") * F.col("idle_time")).cast("decimal(38,0)")).collect()}
    assert {r.address: tuple(r)[1:] for r in out.collect()} == want

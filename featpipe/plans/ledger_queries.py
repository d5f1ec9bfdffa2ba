"""Registered ledger queries over the driver tables, each with its DuckDB
oracle on the *flat* tables (the oracle never sees the nested view, so it
also checks the unnest and the key construction).

Floating results that two engines may sum in a different order are passed
through ``fixed`` (same formula on both sides); everything else is compared
bit for bit. Dates and timestamps are reported as epoch seconds.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from featpipe.functions.keys import epoch_seconds
from featpipe.functions.numeric import fixed, fixed_sql
from featpipe.operators import idle, signatures, transfers, vectors
from featpipe.plans.inputs import ledger_tables
from featpipe.sources import ledger
from featpipe.sources.ledger import FIXTURE_MIN_HITS, FIXTURE_SIGNATURES
from featpipe.sources.tables import read_table

SEGMENT_UNIT = "day"                # block times: distinct times per key-day are bounded by blocks
EVENT_UNITS = ("minute", "day")     # raw event times: minute sets, minute -> day -> key roll-up
CAP_MINERS, CAP_OTHERS = 100, 500   # caps used by the class_cap / labelled_union checks


def _ledger(spark, d):
    return ledger_tables(spark, d)


def _rounded_vectors(df):
    """Compare-friendly projection of vector columns that exist in ``df``."""
    out = []
    for c in df.columns:
        if c.startswith("stddev_tx_"):
            out.append(fixed(c, 3).alias(c))
        elif c.endswith("_idle_time"):
            out.append(fixed(c, 2).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def _miners(spark, d):
    tx, blocks = _ledger(spark, d)
    return signatures.signature_keys(blocks, tx, FIXTURE_SIGNATURES, FIXTURE_MIN_HITS)


def _sized(c):
    # NULL for a NULL array; reported as double so that a nullable count has
    # one representation in every client (nullable integers become floats in
    # some dataframe conversions and stay integers in others)
    return F.when(F.col(c).isNull(), F.lit(None)).otherwise(F.size(c)).cast("double")


# ---------------------------------------------------------------- queries

def q_ledger_scan(spark, d):
    tx, _ = _ledger(spark, d)
    return tx.select(
        "hash", "block_hash",
        epoch_seconds("block_timestamp").alias("block_time"),
        epoch_seconds("block_timestamp_month").alias("month"),
        "is_coinbase",
        _sized("inputs").alias("n_inputs"),
        _sized("outputs").alias("n_outputs"),
    )


def _epochs(df, cols):
    return df.select(*[epoch_seconds(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def q_unnest_transfers(spark, d):
    tx, _ = _ledger(spark, d)
    parts = []
    for side in ("outputs", "inputs"):
        t = transfers.unnest_transfers(tx, side)
        parts.append(t.select(
            F.lit(side).alias("side"), "address", F.col("value").cast("double").alias("value"), "hash",
            epoch_seconds("block_time").alias("block_time"), epoch_seconds("month").alias("month"),
            "is_transfer", "has_addresses"))
    return parts[0].unionByName(parts[1])


def q_address_key(spark, d):
    tx, _ = _ledger(spark, d)
    return (transfers.unnest_transfers(tx, "outputs")
            .groupBy("address").agg(F.count(F.lit(1)).alias("n_transfers")))


def q_activity_ages(spark, d):
    tx, _ = _ledger(spark, d)
    ages = transfers.activity_ages(transfers.unnest_transfers(tx, "outputs"), "output")
    return _epochs(ages, {"output_month_min", "output_month_max"})


def q_address_key_inputs(spark, d):
    tx, _ = _ledger(spark, d)
    return (transfers.unnest_transfers(tx, "inputs")
            .groupBy("address").agg(F.count(F.lit(1)).alias("n_transfers")))


def q_activity_ages_inputs(spark, d):
    tx, _ = _ledger(spark, d)
    ages = transfers.activity_ages(transfers.unnest_transfers(tx, "inputs"), "input")
    return _epochs(ages, {"input_month_min", "input_month_max"})


def q_transfer_stats(spark, d):
    tx, _ = _ledger(spark, d)
    parts = []
    months = transfers.month_range(tx)
    for side, p in (("outputs", "output"), ("inputs", "input")):
        s = transfers.transfer_stats(transfers.unnest_transfers(tx, side), p, months)
        s = _epochs(s, {f"{p}_month_min", f"{p}_month_max"})
        parts.append(_rounded_vectors(s).toDF(*[c.replace(f"_{p}", "_side").replace(f"{p}_", "side_")
                                                for c in s.columns]).withColumn("side", F.lit(side)))
    return parts[0].unionByName(parts[1])


def q_epoch_features(spark, d):
    tx, _ = _ledger(spark, d)
    o = transfers.activity_ages(transfers.unnest_transfers(tx, "outputs"), "output")
    i = transfers.activity_ages(transfers.unnest_transfers(tx, "inputs"), "input")
    return transfers.epoch_features(o.join(i, "address"))


def q_idle_gaps(spark, d):
    tx, _ = _ledger(spark, d)
    return idle.idle_gaps(transfers.unnest_transfers(tx, "outputs"), "address", "block_time", SEGMENT_UNIT)


def q_idle_stats(spark, d):
    tx, _ = _ledger(spark, d)
    t = transfers.unnest_transfers(tx, "inputs")
    return _rounded_vectors(idle.idle_stats(t, "address", "block_time", SEGMENT_UNIT, "input"))


def q_idle_gaps_inputs(spark, d):
    tx, _ = _ledger(spark, d)
    return idle.idle_gaps(transfers.unnest_transfers(tx, "inputs"), "address", "block_time", SEGMENT_UNIT)


def q_idle_stats_outputs(spark, d):
    tx, _ = _ledger(spark, d)
    t = transfers.unnest_transfers(tx, "outputs")
    return _rounded_vectors(idle.idle_stats(t, "address", "block_time", SEGMENT_UNIT, "output"))


def q_event_idle_stats(spark, d):
    ev = read_table(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    return idle.idle_stats(ev, "user_id", "ts", EVENT_UNITS, "event").select(
        "user_id", fixed("mean_event_idle_time", 2).alias("mean_event_idle_time"),
        fixed("stddev_event_idle_time", 2).alias("stddev_event_idle_time"))


def q_event_idle_gaps(spark, d):
    ev = read_table(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    return idle.idle_gaps(ev, "user_id", "ts", EVENT_UNITS)


def q_signature_match(spark, d):
    _, blocks = _ledger(spark, d)
    return blocks.select("hash", signatures.signature_match("coinbase_param", FIXTURE_SIGNATURES).alias("signed"),
                         signatures.signature_match("coinbase_param", signatures.MINER_SIGNATURES).alias("pool_signed"))


def q_block_join(spark, d):
    tx, blocks = _ledger(spark, d)
    return signatures.block_join(blocks, tx, FIXTURE_SIGNATURES)


def q_signature_keys(spark, d):
    return _miners(spark, d)


def _unlabelled(spark, d):
    tx, _ = _ledger(spark, d)
    return vectors.unlabelled_vectors(tx, SEGMENT_UNIT)


def q_address_join(spark, d):
    return _rounded_vectors(_unlabelled(spark, d))


def q_semi_signature(spark, d):
    v = _unlabelled(spark, d).select("address", "total_tx_output_count", "total_tx_input_count")
    return signatures.semi_in(v, "address", _miners(spark, d), "miner")


def q_anti_signature(spark, d):
    v = _unlabelled(spark, d).select("address", "total_tx_output_count", "total_tx_input_count")
    return signatures.anti_not_in(v, "address", _miners(spark, d), "miner")


def _labelled(spark, d):
    return vectors.label(_unlabelled(spark, d), _miners(spark, d))


def q_class_cap(spark, d):
    v = vectors.write_table(_labelled(spark, d).where(~F.col("is_miner")), "vectors")
    return vectors.class_cap(v, CAP_OTHERS).select("is_miner", "address", "total_tx_output_count")


def q_class_cap_miners(spark, d):
    v = vectors.write_table(_labelled(spark, d).where("is_miner"), "vectors")
    return vectors.class_cap(v, CAP_MINERS).select("is_miner", "address", "total_tx_output_count")


def q_labelled_union(spark, d):
    v = _labelled(spark, d)
    return vectors.labelled_union(v, CAP_MINERS, CAP_OTHERS).select("is_miner", "address", "io_max_lag")


def q_address_vectors(spark, d):
    tx, blocks = _ledger(spark, d)
    v = vectors.address_vectors(tx, blocks, FIXTURE_SIGNATURES, FIXTURE_MIN_HITS,
                                vectors.DEFAULT_CAP, vectors.DEFAULT_CAP, SEGMENT_UNIT)
    return _rounded_vectors(v)


def q_address_vectors_defaults(spark, d):
    """C1 with the source's own defaults: the nine pool signatures, 20 hits,
    2000 vectors per class."""
    tx, blocks = _ledger(spark, d)
    return _rounded_vectors(vectors.address_vectors(tx, blocks))


QUERIES = {
    "ledger_scan": q_ledger_scan,
    "unnest_transfers": q_unnest_transfers,
    "address_key": q_address_key,
    "activity_ages": q_activity_ages,
    "activity_ages_inputs": q_activity_ages_inputs,
    "address_key_inputs": q_address_key_inputs,
    "transfer_stats": q_transfer_stats,
    "epoch_features": q_epoch_features,
    "idle_gaps": q_idle_gaps,
    "idle_stats": q_idle_stats,
    "idle_stats_outputs": q_idle_stats_outputs,
    "idle_gaps_inputs": q_idle_gaps_inputs,
    "event_idle_stats": q_event_idle_stats,
    "event_idle_gaps": q_event_idle_gaps,
    "signature_match": q_signature_match,
    "block_join": q_block_join,
    "signature_keys": q_signature_keys,
    "address_join": q_address_join,
    "semi_signature": q_semi_signature,
    "anti_signature": q_anti_signature,
    "class_cap": q_class_cap,
    "class_cap_miners": q_class_cap_miners,
    "labelled_union": q_labelled_union,
    "address_vectors": q_address_vectors,
    "address_vectors_defaults": q_address_vectors_defaults,
}

# ---------------------------------------------------------------- oracles


def _ep(x: str) -> str:
    return f"CAST(floor(epoch_us(CAST({x} AS TIMESTAMP)) / 1000000) AS BIGINT)"


_OUT_KEY = ("CASE WHEN l.l_linenumber = 7 THEN 'a' || l.l_partkey || ',a' || l.l_suppkey "
            "ELSE 'a' || l.l_partkey END")
_MONTH = "CAST(date_trunc('month', o.o_orderdate) AS DATE)"

_HEAD = f"""'t' || o.o_orderkey AS hash, o.o_orderdate AS block_time, {_MONTH} AS month"""
_LO = "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"
_QTY = "CAST(l.l_quantity AS DECIMAL(18,2))"


def _on(rule) -> str:
    return f"l.l_orderkey % {rule[0]} = 0 AND l.l_linenumber = {rule[1]}"


# every element of every array as a flat row: (address, value, is_transfer, has_addresses, condition)
_OUT_ROWS = [
    (_OUT_KEY, "CAST(l.l_extendedprice AS DECIMAL(18,2))", True, True, "TRUE"),
    ("'a' || l.l_suppkey", _QTY, True, True, f"l.l_orderkey % {ledger.SECOND_OUTPUT} = 0"),
    ("''", "CAST(NULL AS DECIMAL(18,2))", False, False, _on(ledger.NULL_OUTPUT)),
    ("''", _QTY, True, False, _on(ledger.NULL_ADDRESSES)),
    ("''", _QTY, True, True, _on(ledger.NO_ADDRESSES)),
]
_IN_ROWS = [
    ("'a' || o.o_custkey", "CAST(o.o_totalprice AS DECIMAL(18,2))", True, True, "TRUE"),
    ("''", "CAST(o.o_totalprice AS DECIMAL(18,2))", True, False, f"o.o_orderkey % {ledger.NULL_INPUT_ADDRESSES} = 0"),
    ("'a' || o.o_custkey", "CAST(1 AS DECIMAL(18,2))", True, True, f"o.o_orderkey % {ledger.NULL_ADDRESS_ELEMENT} = 0"),
]


def _flat(rows, source: str, more: str = "") -> str:
    return "\n  UNION ALL ".join(
        f"SELECT {key} AS address, {value} AS value, {_HEAD}, {real} AS is_transfer, {named} AS has_addresses{more} {source} WHERE {when}"
        for key, value, real, named, when in rows)


_COINBASE = (f"lower(hex(o.o_orderpriority)) || CASE WHEN o.o_orderkey % {ledger.POOL_SIGNED} = 0 THEN "
             f"[{', '.join(repr(s) for s in signatures.MINER_SIGNATURES)}][1 + o.o_custkey % {len(signatures.MINER_SIGNATURES)}] ELSE '' END")

_BASE = f"""
out_t AS ({_flat(_OUT_ROWS, _LO, f", o.o_orderstatus = 'F' AS is_coinbase, {_COINBASE} AS coinbase_param")}),
in_t AS ({_flat(_IN_ROWS, "FROM orders o")})"""


def _sig_sql(sigs, text="coinbase_param") -> str:
    return "(" + " OR ".join(f"{text} LIKE '%{s}%'" for s in sigs) + ")"


def _miners_sql(sigs, min_hits) -> str:
    return f"""
miners AS (
  SELECT address AS miner, count(*) AS hits FROM out_t WHERE is_coinbase AND {_sig_sql(sigs)}
  GROUP BY 1 HAVING count(*) >= {min_hits})"""


_MINERS = _miners_sql(FIXTURE_SIGNATURES, FIXTURE_MIN_HITS)


def _stats_sql(src: str, p: str) -> str:
    return f"""
{p}_stats AS (
  SELECT address, min(month) AS {p}_month_min, max(month) AS {p}_month_max,
    count(DISTINCT month) AS {p}_active_months,
    count(*) FILTER (WHERE is_transfer) AS total_tx_{p}_count,
    CAST(sum(value) AS DOUBLE) AS total_tx_{p}_value,
    CAST(sum(value) AS DOUBLE) / count(value) AS mean_tx_{p}_value,
    stddev_samp(value) AS stddev_tx_{p}_value,
    count(DISTINCT hash) AS total_{p}_tx,
    CAST(sum(value) AS DOUBLE) / count(month) AS mean_monthly_{p}_value,
    CAST(count(*) FILTER (WHERE has_addresses) AS DOUBLE) / count(month) AS mean_monthly_{p}_count
  FROM {src} GROUP BY address)"""


def _gaps_sql(src: str, p: str, key: str = "address", t: str = "block_time") -> str:
    return f"""
{p}_gaps AS (
  SELECT {key}, {_ep('t_')} - {_ep('prev_')} AS idle_time
  FROM (SELECT {key}, {t} AS t_, lag({t}) OVER (PARTITION BY {key} ORDER BY {t}) AS prev_ FROM {src})
  WHERE t_ != prev_),
{p}_idle AS (
  SELECT {key}, avg(idle_time) AS mean_{p}_idle_time, stddev_samp(idle_time) AS stddev_{p}_idle_time
  FROM {p}_gaps GROUP BY {key})"""


_VEC_BASE = f"WITH {_BASE},{_stats_sql('out_t', 'output')},{_stats_sql('in_t', 'input')}," \
            f"{_gaps_sql('out_t', 'output')},{_gaps_sql('in_t', 'input')},{_MINERS}," + """
vec AS (
  SELECT * FROM output_stats JOIN output_idle USING (address)
  JOIN input_stats USING (address) JOIN input_idle USING (address)),
labelled AS (
  SELECT address IN (SELECT miner FROM miners) AS is_miner, * FROM vec)
"""


def _vec_select(cols, src="labelled") -> str:
    ep = {c: _ep(c) for c in ("output_month_min", "output_month_max", "input_month_min", "input_month_max")}
    exprs = {
        **ep,
        "output_active_time": f"{ep['output_month_max']} - {ep['output_month_min']}",
        "input_active_time": f"{ep['input_month_max']} - {ep['input_month_min']}",
        "io_max_lag": f"{ep['output_month_max']} - {ep['input_month_max']}",
        "io_min_lag": f"{ep['output_month_min']} - {ep['input_month_min']}",
    }
    out = []
    for c in cols:
        e = exprs.get(c, c)
        if c.startswith("stddev_tx_"):
            e = fixed_sql(e, 3)
        elif c.endswith("_idle_time"):
            e = fixed_sql(e, 2)
        out.append(f"{e} AS {c}")
    return f"SELECT {', '.join(out)} FROM {src}"


_UNLABELLED_COLS = [c for c in vectors.VECTOR_COLUMNS if c != "is_miner"]


def _capped(where: str, n: int) -> str:
    return f"(SELECT * FROM labelled WHERE {where} ORDER BY md5(address), address LIMIT {n})"


def _transfer_stats_sql() -> str:
    parts = []
    for side, p, src in (("outputs", "output", "out_t"), ("inputs", "input", "in_t")):
        parts.append(f"""SELECT '{side}' AS side, address,
  {_ep(f'{p}_month_min')} AS side_month_min, {_ep(f'{p}_month_max')} AS side_month_max,
  {p}_active_months AS side_active_months, total_tx_{p}_count AS total_tx_side_count,
  total_tx_{p}_value AS total_tx_side_value, mean_tx_{p}_value AS mean_tx_side_value,
  {fixed_sql(f'stddev_tx_{p}_value', 3)} AS stddev_tx_side_value, total_{p}_tx AS total_side_tx,
  mean_monthly_{p}_value AS mean_monthly_side_value, mean_monthly_{p}_count AS mean_monthly_side_count
FROM {p}_stats""")
    return (f"WITH {_BASE},{_stats_sql('out_t', 'output')},{_stats_sql('in_t', 'input')}\n"
            + "\nUNION ALL\n".join(parts))


ORACLE = {
    "ledger_scan": f"""
SELECT 't' || o.o_orderkey AS hash, 'b' || o.o_orderkey AS block_hash, {_ep('o.o_orderdate')} AS block_time,
       {_ep(_MONTH)} AS month, o.o_orderstatus = 'F' AS is_coinbase,
       CAST(0 AS DOUBLE) AS n_inputs, CAST({' + '.join(f'({w})::INT' for *_, w in _OUT_ROWS)} AS DOUBLE) AS n_outputs
{_LO}
UNION ALL
SELECT 't' || o.o_orderkey, 'b' || o.o_orderkey, {_ep('o.o_orderdate')}, {_ep(_MONTH)},
       o.o_orderstatus = 'F', CAST({' + '.join(f'({w})::INT' for *_, w in _IN_ROWS)} AS DOUBLE), CAST(NULL AS DOUBLE)
FROM orders o""",
    "unnest_transfers": f"""WITH {_BASE}
SELECT 'outputs' AS side, address, CAST(value AS DOUBLE) AS value, hash, {_ep('block_time')} AS block_time,
       {_ep('month')} AS month, is_transfer, has_addresses FROM out_t
UNION ALL
SELECT 'inputs', address, CAST(value AS DOUBLE), hash, {_ep('block_time')}, {_ep('month')}, is_transfer, has_addresses FROM in_t""",
    "address_key": f"WITH {_BASE} SELECT address, count(*) AS n_transfers FROM out_t GROUP BY address",
    "activity_ages": f"""WITH {_BASE}
SELECT address, {_ep('min(month)')} AS output_month_min, {_ep('max(month)')} AS output_month_max
FROM out_t GROUP BY address""",
    "address_key_inputs": f"WITH {_BASE} SELECT address, count(*) AS n_transfers FROM in_t GROUP BY address",
    "activity_ages_inputs": f"""WITH {_BASE}
SELECT address, {_ep('min(month)')} AS input_month_min, {_ep('max(month)')} AS input_month_max
FROM in_t GROUP BY address""",
    "transfer_stats": _transfer_stats_sql(),
    "epoch_features": f"""WITH {_BASE},
o AS (SELECT address, min(month) AS output_month_min, max(month) AS output_month_max FROM out_t GROUP BY address),
i AS (SELECT address, min(month) AS input_month_min, max(month) AS input_month_max FROM in_t GROUP BY address),
labelled AS (SELECT * FROM o JOIN i USING (address))
""" + _vec_select(["address", "output_month_min", "output_month_max", "input_month_min", "input_month_max",
                   "output_active_time", "input_active_time", "io_max_lag", "io_min_lag"]),
    "idle_gaps": f"WITH {_BASE},{_gaps_sql('out_t', 'output')} SELECT address, idle_time FROM output_gaps",
    "idle_stats": f"""WITH {_BASE},{_gaps_sql('in_t', 'input')}
SELECT address, {fixed_sql('mean_input_idle_time', 2)} AS mean_input_idle_time,
       {fixed_sql('stddev_input_idle_time', 2)} AS stddev_input_idle_time FROM input_idle""",
    "idle_gaps_inputs": f"WITH {_BASE},{_gaps_sql('in_t', 'input')} SELECT address, idle_time FROM input_gaps",
    "idle_stats_outputs": f"""WITH {_BASE},{_gaps_sql('out_t', 'output')}
SELECT address, {fixed_sql('mean_output_idle_time', 2)} AS mean_output_idle_time,
       {fixed_sql('stddev_output_idle_time', 2)} AS stddev_output_idle_time FROM output_idle""",
    "event_idle_stats": f"""WITH ev AS (SELECT user_id, ts FROM events),{_gaps_sql('ev', 'event', 'user_id', 'ts')}
SELECT user_id, {fixed_sql('mean_event_idle_time', 2)} AS mean_event_idle_time,
       {fixed_sql('stddev_event_idle_time', 2)} AS stddev_event_idle_time FROM event_idle""",
    "event_idle_gaps": f"""WITH ev AS (SELECT user_id, ts FROM events),{_gaps_sql('ev', 'event', 'user_id', 'ts')}
SELECT user_id, idle_time FROM event_gaps""",
    "signature_match": "SELECT 'b' || o.o_orderkey AS hash, "
                       f"{_sig_sql(FIXTURE_SIGNATURES, f'({_COINBASE})')} AS signed, "
                       f"{_sig_sql(signatures.MINER_SIGNATURES, f'({_COINBASE})')} AS pool_signed FROM orders o",
    "block_join": f"WITH {_BASE} SELECT address AS miner FROM out_t WHERE is_coinbase AND {_sig_sql(FIXTURE_SIGNATURES)}",
    "signature_keys": f"WITH {_BASE},{_MINERS} SELECT miner, hits FROM miners",
    "address_join": _VEC_BASE + _vec_select(_UNLABELLED_COLS),
    "semi_signature": _VEC_BASE + "SELECT address, total_tx_output_count, total_tx_input_count FROM vec "
                                  "WHERE address IN (SELECT miner FROM miners)",
    "anti_signature": _VEC_BASE + "SELECT address, total_tx_output_count, total_tx_input_count FROM vec "
                                  "WHERE address NOT IN (SELECT miner FROM miners)",
    "class_cap": _VEC_BASE + "SELECT is_miner, address, total_tx_output_count FROM "
                 + _capped("NOT is_miner", CAP_OTHERS),
    "class_cap_miners": _VEC_BASE + "SELECT is_miner, address, total_tx_output_count FROM "
                        + _capped("is_miner", CAP_MINERS),
    "labelled_union": _VEC_BASE + _vec_select(["is_miner", "address", "io_max_lag"], "(" + _capped(
        "is_miner", CAP_MINERS) + " UNION ALL " + _capped("NOT is_miner", CAP_OTHERS) + ")"),
    "address_vectors": _VEC_BASE + _vec_select(vectors.VECTOR_COLUMNS, "(" + _capped("is_miner", vectors.DEFAULT_CAP)
                                               + " UNION ALL " + _capped("NOT is_miner", vectors.DEFAULT_CAP) + ")"),
    "address_vectors_defaults": _VEC_BASE.replace(
        _MINERS, _miners_sql(signatures.MINER_SIGNATURES, signatures.MIN_HITS)) + _vec_select(
        vectors.VECTOR_COLUMNS, "(" + _capped("is_miner", vectors.DEFAULT_CAP) + " UNION ALL "
        + _capped("NOT is_miner", vectors.DEFAULT_CAP) + ")"),
}

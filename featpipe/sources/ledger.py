"""Nested ledger inputs (S1) and their derivation from the driver tables.

Ledger model: ``transactions(hash, block_hash, block_timestamp,
block_timestamp_month, is_coinbase, inputs, outputs)`` where ``inputs`` and
``outputs`` are ``array<struct<addresses: array<string>, value: decimal>>``;
``blocks(hash, coinbase_param)``.

Driver mapping (orders/lineitem -> ledger):
  * every order line becomes one transaction row whose ``outputs`` holds that
    line (one address ``a<partkey>``, or ``a<partkey>,a<suppkey>`` on line 7,
    value ``l_extendedprice``) and whose ``inputs`` is empty. Some lines have more
    outputs: a second one to ``a<suppkey>`` (every fifth order), a NULL struct,
    one with NULL and one with no addresses, all of value ``l_quantity``;
  * every order adds one row whose ``inputs`` holds the customer
    (``a<custkey>``, value ``o_totalprice``) and whose ``outputs`` is NULL. Every
    sixth order has an input with NULL addresses, every ninth one whose second
    address is NULL.
  Every third block's coinbase text also carries one of the nine pool signatures.
  All rows of an order share ``hash = t<orderkey>``, ``block_hash =
  b<orderkey>``, the order date as block time, and ``is_coinbase =
  (o_orderstatus = 'F')``.
  Splitting an order over several rows leaves every exploded transfer, and so
  every result, exactly as a one-row-per-order nesting would; it needs no
  grouping, so no order, however large, is ever collected into one array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featpipe.operators.signatures import MINER_SIGNATURES

VALUE_TYPE = T.DecimalType(18, 2)
TRANSFER = T.StructType([
    T.StructField("addresses", T.ArrayType(T.StringType())),
    T.StructField("value", VALUE_TYPE),
])
TRANSFERS = T.ArrayType(TRANSFER)

TRANSACTIONS_SCHEMA = T.StructType([
    T.StructField("hash", T.StringType()),
    T.StructField("block_hash", T.StringType()),
    T.StructField("block_timestamp", T.TimestampType()),
    T.StructField("block_timestamp_month", T.DateType()),
    T.StructField("is_coinbase", T.BooleanType()),
    T.StructField("inputs", TRANSFERS),
    T.StructField("outputs", TRANSFERS),
])
BLOCKS_SCHEMA = T.StructType([
    T.StructField("hash", T.StringType()),
    T.StructField("coinbase_param", T.StringType()),
])

# Hex text of the driver's order priorities used as miner
# signatures in tests (URGENT, HIGH), and the hit threshold that gives both
# classes at sf0.01.
FIXTURE_SIGNATURES = ["555247454e54", "48494748"]
FIXTURE_MIN_HITS = 6


#: Which rows have what beside their first element: (column, divisor) and line numbers.
SECOND_OUTPUT, NULL_OUTPUT, NULL_ADDRESSES, NO_ADDRESSES = 5, (7, 1), (11, 2), (13, 3)
NULL_INPUT_ADDRESSES, NULL_ADDRESS_ELEMENT = 6, 9
POOL_SIGNED = 3


def _header(orders: DataFrame):
    return [
        F.concat(F.lit("t"), F.col("o_orderkey")).alias("hash"),
        F.concat(F.lit("b"), F.col("o_orderkey")).alias("block_hash"),
        F.col("o_orderdate").cast("timestamp").alias("block_timestamp"),
        F.to_date(F.date_trunc("month", F.col("o_orderdate"))).alias("block_timestamp_month"),
        (F.col("o_orderstatus") == "F").alias("is_coinbase"),
    ]


def _transfer(addresses, value):
    return F.struct(addresses.alias("addresses"), value.cast(VALUE_TYPE).alias("value"))


def _name(column: str):
    return F.concat(F.lit("a"), F.col(column))


def _some(when, *elements):
    """An array of transfers where ``when`` holds, else an empty one."""
    return F.when(when, F.array(*elements).cast(TRANSFERS)).otherwise(F.array().cast(TRANSFERS))


def _outputs():
    """All outputs of one order line, from its own row."""
    on = lambda rule: (F.col("l_orderkey") % rule[0] == 0) & (F.col("l_linenumber") == rule[1])
    first = F.when(F.col("l_linenumber") == 7, F.array(_name("l_partkey"), _name("l_suppkey"))).otherwise(F.array(_name("l_partkey")))
    no_names = F.array().cast("array<string>")
    return F.concat(
        F.array(_transfer(first, F.col("l_extendedprice"))).cast(TRANSFERS),
        _some(F.col("l_orderkey") % SECOND_OUTPUT == 0, _transfer(F.array(_name("l_suppkey")), F.col("l_quantity"))),
        _some(on(NULL_OUTPUT), F.lit(None).cast(TRANSFER)),
        _some(on(NULL_ADDRESSES), _transfer(F.lit(None).cast("array<string>"), F.col("l_quantity"))),
        _some(on(NO_ADDRESSES), _transfer(no_names, F.col("l_quantity"))))


def _inputs():
    """All inputs of one order."""
    key, own, value = F.col("o_orderkey"), _name("o_custkey"), F.col("o_totalprice")
    return F.concat(
        F.array(_transfer(F.array(own), value)).cast(TRANSFERS),
        _some(key % NULL_INPUT_ADDRESSES == 0, _transfer(F.lit(None).cast("array<string>"), value)),
        _some(key % NULL_ADDRESS_ELEMENT == 0, _transfer(F.array(own, F.lit(None).cast("string")), F.lit(1))))


_ORDER = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
_LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity"]


def transactions_from_tables(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Nested ``transactions`` view of ``orders`` and ``lineitem`` (map-only
    apart from the line -> order join)."""
    o = orders.select(*_ORDER)
    lines = (lineitem.select(*_LINE).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
             .select(*_header(o), F.array().cast(TRANSFERS).alias("inputs"), _outputs().alias("outputs")))
    order_rows = o.select(*_header(o), _inputs().alias("inputs"), F.lit(None).cast(TRANSFERS).alias("outputs"))
    return lines.unionByName(order_rows)


def transactions_grouped_from_tables(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """The conventional nesting: one row per order, ``outputs`` holding those of
    all its lines (NULL for an order without lines). Its arrays are bounded by the
    lines of one order; ``transactions_from_tables`` gives the same exploded
    transfers without grouping and is what the queries use."""
    o = orders.select(*_ORDER)
    outs = lineitem.select(*_LINE).groupBy("l_orderkey").agg(F.flatten(F.collect_list(_outputs())).alias("outputs"))
    return o.join(outs, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        *_header(o), _inputs().alias("inputs"), F.col("outputs").cast(TRANSFERS).alias("outputs"))


def blocks_from_tables(orders: DataFrame) -> DataFrame:
    """``blocks(hash, coinbase_param)``: coinbase text is the lower-case hex of
    the order priority, with a pool signature after it in every third block."""
    pools = F.array(*[F.lit(s) for s in MINER_SIGNATURES])
    pool = F.get(pools, (F.col("o_custkey") % len(MINER_SIGNATURES)).cast("int"))
    return orders.select(
        F.concat(F.lit("b"), F.col("o_orderkey")).alias("hash"),
        F.concat(F.lower(F.hex(F.col("o_orderpriority"))),
                 F.when(F.col("o_orderkey") % POOL_SIGNED == 0, pool).otherwise(F.lit(""))).alias("coinbase_param"))


def ledger_from_tables(spark, sf_dir: str):
    from featpipe.sources.tables import read_table
    orders = read_table(spark, sf_dir, "orders")
    lineitem = read_table(spark, sf_dir, "lineitem")
    return transactions_from_tables(orders, lineitem), blocks_from_tables(orders)


def read_ledger(spark, transactions_path: str, blocks_path: str):
    """Scan of real ledger tables stored as Parquet (or catalog tables when
    the argument has no '/')."""
    def _read(p):
        return spark.table(p) if "/" not in p else spark.read.parquet(p)
    return _read(transactions_path), _read(blocks_path)

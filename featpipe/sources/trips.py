"""``trips`` records (the tabular pipeline's raw input) derived from the
driver tables: ``lineitem`` joined to ``orders``.

  pickup_latitude / pickup_longitude   l_quantity / l_extendedprice
  dropoff_latitude / dropoff_longitude nullif(l_discount, 0) / nullif(l_tax, 0)
  euclidean                            o_totalprice
  month                                month(l_shipdate), integer
  day                                  week-day name of l_shipdate, NULL on Sunday
  trip_total                           l_extendedprice * (1 - l_discount), NULL on line 7
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The source's feature lists and label.
NUMERIC_FEATURE_KEYS = ["pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude", "euclidean"]
CATEGORICAL_FEATURE_KEYS = ["month", "day"]
LABEL_KEY = "trip_total"

TRIP_COLUMNS = NUMERIC_FEATURE_KEYS + CATEGORICAL_FEATURE_KEYS + [LABEL_KEY]


def trips_from_tables(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    day = F.date_format(F.col("l_shipdate"), "EEEE")
    return (
        lineitem.select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                        "l_shipdate", "l_linenumber")
        .join(orders.select("o_orderkey", "o_totalprice"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("l_quantity").alias("pickup_latitude"),
            F.col("l_extendedprice").alias("pickup_longitude"),
            F.nullif(F.col("l_discount"), F.lit(0.0)).alias("dropoff_latitude"),
            F.nullif(F.col("l_tax"), F.lit(0.0)).alias("dropoff_longitude"),
            F.col("o_totalprice").alias("euclidean"),
            F.month("l_shipdate").alias("month"),
            F.when(day != "Sunday", day).alias("day"),
            F.when(F.col("l_linenumber") != 7,
                   F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias(LABEL_KEY),
        )
    )


def trips(spark, sf_dir: str) -> DataFrame:
    from featpipe.sources.tables import read_table
    return trips_from_tables(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "orders"))


# Oracle-side twin (DuckDB) of the mapping above.
TRIPS_SQL = """
SELECT l.l_quantity AS pickup_latitude, l.l_extendedprice AS pickup_longitude,
       nullif(l.l_discount, 0) AS dropoff_latitude, nullif(l.l_tax, 0) AS dropoff_longitude,
       o.o_totalprice AS euclidean, CAST(month(l.l_shipdate) AS INTEGER) AS month,
       CASE WHEN dayname(l.l_shipdate) <> 'Sunday' THEN dayname(l.l_shipdate) END AS "day",
       CASE WHEN l.l_linenumber <> 7 THEN l.l_extendedprice * (1 - l.l_discount) END AS trip_total
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

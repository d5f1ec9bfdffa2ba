"""Frame helpers with explicit size checks."""

from __future__ import annotations

from pyspark.sql import DataFrame


class TooLarge(ValueError):
    pass


def bounded_local(df: DataFrame, max_rows: int) -> DataFrame:
    """Bring a result that is small by construction (fit parameters,
    statistics: one row per column and split) to the driver once and return
    it as a local frame, so later uses do not recompute its plan. The bound is
    checked: more than ``max_rows`` rows is an error, never a truncation."""
    rows = df.take(max_rows + 1)
    if len(rows) > max_rows:
        raise TooLarge(f"expected at most {max_rows} rows")
    return df.sparkSession.createDataFrame(rows, df.schema)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast side with a checked size: when ``df`` has at most
    ``max_rows`` rows it comes back as a local frame marked for broadcast;
    beyond that it is returned unchanged and the planner (AQE) picks the join
    strategy from runtime sizes."""
    from pyspark.sql import functions as F
    rows = df.take(max_rows + 1)
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))

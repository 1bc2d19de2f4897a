"""Irregular readings onto a regular grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintara.functions.common import partitions, symbol_key


def regular_grid(readings: DataFrame, periods: DataFrame, source: str = "symbol", time: str = "event_date", period: str = "session", observed: str = "observation_time", values: tuple[str, ...] = ("close", "volume"), max_gap: int = 5) -> DataFrame:
    """One row for each source and period from its first to its last reading: source, period, n_readings, status and,
    for each value, that of the latest observed reading or, within max_gap periods, the one before carried forward.

    status: observed (a reading in the period), filled (none, and something carried), missing. Readings without source
    or time count for nothing, those on a time that is no period fill none but do move the first and last. Null values
    are not carried: the last known one is. Ties of observation: the greater values. Repeated readings count once
    towards the values. Without readings or periods there are no rows. Column names other than those named are not read.

    Readings are reduced by (source, time) before the one shuffle by source that the carrying needs, so a source holds at
    most one row for a period. The sequence of each source's days is an equi-join with the periods, no range join.
    """
    r = readings.select(symbol_key(F.col(source).cast("string")).alias("s"), F.col(time).cast("date").alias("d"), F.struct(F.col(observed).alias("t"), *[F.col(v).alias(f"v_{v}") for v in values]).alias("x")).where("s is not null and d is not null")
    bucket = r.groupBy("s", "d").agg(F.count(F.lit(1)).alias("n"), F.max("x").alias("x"))
    span = r.groupBy("s").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).repartition(partitions(readings), "s")
    days = periods.select(F.col(period).cast("date").alias("d")).where("d is not null").distinct()
    grid = span.select("s", F.explode(F.sequence("lo", "hi")).alias("d")).join(days, "d")
    out = grid.join(bucket, ["s", "d"], "left")
    past = Window.partitionBy("s").orderBy("d")
    out = out.withColumn("i", F.row_number().over(past))
    cols = [F.col("s").alias(source), F.col("d").alias(period), F.coalesce("n", F.lit(0)).alias("n_readings")]
    for v in values:
        last = F.last(F.when(F.col(f"x.v_{v}").isNotNull(), F.struct("i", F.col(f"x.v_{v}").alias("v"))), ignorenulls=True).over(past)
        out = out.withColumn(f"f_{v}", last)
        cols.append(F.when(F.col("i") - F.col(f"f_{v}.i") <= max_gap, F.col(f"f_{v}.v")).alias(v))
    held = F.lit(False)
    for v in values:
        held = held | F.coalesce(F.col("i") - F.col(f"f_{v}.i") <= max_gap, F.lit(False))
    return out.select(*cols, F.when(F.col("n").isNotNull(), "observed").when(held, "filled").otherwise("missing").alias("status"))

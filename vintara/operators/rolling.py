"""Totals and averages over trailing days by block decomposition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintara.functions.common import symbol_key


def latest_reading(records: DataFrame, source: str, time: str, observed: str, values: tuple[str, ...]) -> DataFrame:
    """(s, d, values) by the latest observed record of each source and day; ties: the greater values, nulls last."""
    order = F.struct(F.col(observed), *[F.col(v) for v in values])
    r = records.select(symbol_key(F.col(source).cast("string")).alias("s"), F.col(time).cast("date").alias("d"), order.alias("x")).where("s is not null and d is not null")
    return r.groupBy("s", "d").agg(F.max("x").alias("x")).select("s", "d", *[F.col(f"x.{v}").alias(v) for v in values])


def trailing_totals(records: DataFrame, source: str = "symbol", time: str = "event_date", observed: str = "observation_time", total: str = "volume", average: str = "close", windows: tuple[int, ...] = (7, 30)) -> DataFrame:
    """For each source and every day from its first to its last record: total_W of `total` and avg_W of `average` over the
    W days that end there, for each W of windows.

    Each day counts once, by its latest observed record; days without one add nothing. A null value adds nothing; a
    window without any value gives a null total or average. Records without source or time count for nothing. Sums are
    exact (decimal or bigint); the average is the exact sum as a double over the count. No records, no rows; other
    columns are not read.

    With blocks of W days, a trailing window is the suffix of the block before, from the window's first day on, and the
    prefix of its own block. A prefix is a running sum within one block, a suffix the block's total less the prefix before
    it, so each costs one step a day whatever W is.
    """
    day = latest_reading(records, source, time, observed, (total, average))
    exact = day.schema[average].dataType.typeName() == "decimal"
    wide = "decimal(30,8)" if exact else "double"  # sums of two still fit a decimal without loss
    day = day.select("s", "d", F.col(total).alias("a"), F.col(average).cast("decimal(20,8)" if exact else "double").alias("b"))
    # Each day with a record also gives the days up to the next one, which have none.
    line = Window.partitionBy("s").orderBy("d")
    upto = F.coalesce(F.date_sub(F.lead("d").over(line), 1), F.col("d"))
    dense = day.withColumn("upto", upto).select("s", "d", "a", "b", F.posexplode(F.sequence("d", "upto")).alias("gap", "day"))
    own = F.col("gap") == 0
    here = {f"n{c}": F.when(own & F.col(c).isNotNull(), 1).otherwise(0) for c in "ab"} | {c: F.coalesce(F.when(own, F.col(c)), F.lit(0)) for c in "ab"}
    dense = dense.select("s", F.col("day").alias("d"), F.datediff("day", F.lit("1970-01-01").cast("date")).alias("k"), *[x.alias(n) for n, x in here.items()])
    cast = {"a": "bigint", "b": wide, "na": "bigint", "nb": "bigint"}
    cols = [F.col("s").alias(source), F.col("d").alias(time)]
    for w in windows:
        dense = dense.withColumn(f"blk{w}", F.floor(F.col("k") / w))
        block = Window.partitionBy("s", f"blk{w}").orderBy("k")
        sums = {f"{side}{w}_{n}": F.sum(n).over(block.rowsBetween(Window.unboundedPreceding, to)).cast(kind) for n, kind in cast.items() for side, to in (("p", 0), ("t", Window.unboundedFollowing))}
        dense = dense.withColumns(sums).withColumns({f"s{w}_{n}": (F.col(f"t{w}_{n}") - F.col(f"p{w}_{n}")).cast(kind) + F.col(n) for n, kind in cast.items()}).drop(*[f"t{w}_{n}" for n in cast])
    line = Window.partitionBy("s").orderBy("k")
    dense = dense.withColumn("row", F.row_number().over(line))
    for w in windows:
        whole = F.pmod(F.col("k") + 1, F.lit(w)) == 0  # the window is the block itself
        got = {}
        for n in cast:
            suffix = F.lag(f"s{w}_{n}", w - 1).over(line)
            # Before the source's first day there is no such row; the whole block before, if any, is then within the window.
            before = F.last(F.when(F.pmod("k", F.lit(w)) == w - 1, F.col(f"p{w}_{n}")), ignorenulls=True).over(line)
            got[n] = F.col(f"p{w}_{n}") + F.when(whole, 0).otherwise(F.coalesce(F.when(F.col("row") < w, before).otherwise(suffix), F.lit(0)))
        dense = dense.withColumns({f"w{w}_{n}": x for n, x in got.items()})
        cols += [F.when(F.col(f"w{w}_na") > 0, F.col(f"w{w}_a").cast("bigint")).alias(f"total_{w}"), F.when(F.col(f"w{w}_nb") > 0, F.col(f"w{w}_b").cast("double") / F.col(f"w{w}_nb")).alias(f"avg_{w}")]
    return dense.select(*cols)

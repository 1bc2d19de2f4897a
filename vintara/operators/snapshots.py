"""What changed between consecutive full snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def snapshot_changes(rows: DataFrame, series: str, version: str, key: tuple[str, ...], compared: tuple[str, ...]) -> DataFrame:
    """For each series, its versions in order and each key: whether its row was added, removed or changed against the
    nearest lower version that has rows. Columns: series, version (the later), key, change_kind, before, after (structs
    of the compared columns, null on the side that lacks the key).

    Repeated rows count once; if one version holds different rows for a key, the greatest counts. Rows without series,
    version or part of the key are left out. In the compared columns null differs from a value and equals null. The
    first version of a series gives nothing. No rows, no changes; other columns are not read.

    A EXCEPT ALL B and B EXCEPT ALL A are read off one signed count of the rows of both versions, so each row is shuffled
    once for it; only the residues, i.e. rows that did change, are full-joined by key. Rows spread over all keys, so a
    large series or version is no hot spot.
    """
    clean = rows.select(F.col(series).alias("g"), F.col(version).alias("n"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(key)], F.struct(*compared).alias("x"))
    keys = [f"k{i}" for i in range(len(key))]
    clean = clean.dropna(subset=["g", "n", *keys]).groupBy("g", "n", *keys).agg(F.max("x").alias("x"))
    order = Window.partitionBy("g").orderBy("n")
    seen = clean.select("g", "n").distinct().select("g", "n", F.lag("n").over(order).alias("prev"), F.lead("n").over(order).alias("next"))
    sides = F.array_compact(F.array(F.when(F.col("prev").isNotNull(), F.struct(F.col("n").alias("at"), F.lit(1).alias("sign"))), F.when(F.col("next").isNotNull(), F.struct(F.col("next").alias("at"), F.lit(-1).alias("sign")))))
    both = clean.join(seen, ["g", "n"]).select("g", *keys, "x", F.explode(sides).alias("side"))
    net = both.groupBy("g", F.col("side.at").alias("at"), *keys, "x").agg(F.sum("side.sign").alias("net")).where("net <> 0")
    on = ["g", "at", *keys]
    later, earlier = net.where("net > 0").select(*on, F.col("x").alias("after")), net.where("net < 0").select(*on, F.col("x").alias("before"))
    kind = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").otherwise("changed")
    return later.join(earlier, on, "full").select(F.col("g").alias(series), F.col("at").alias(version), *[F.col(a).alias(b) for a, b in zip(keys, key)], kind.alias("change_kind"), "before", "after")


def except_all_both(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(left EXCEPT ALL right, right EXCEPT ALL left) of tables with the same columns, nulls equal to nulls."""
    return left.exceptAll(right.select(*left.columns)), right.select(*left.columns).exceptAll(left)

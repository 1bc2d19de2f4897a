"""Deterministic bars and vendor documents, as plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.functions.canonical import day_millis, seed64

#: The base price of some symbols; all others have 100.
BASES, BASE = {"SPY": 470, "XLK": 200, "XLE": 85}, 100


def generated_bars(pairs: DataFrame, symbol: str = "symbol", day: str = "session") -> DataFrame:
    """For each (symbol, day) its bar, a function of the two alone: symbol, event_date, open, high, low, close
    (decimal(18,8)), volume, trades."""
    seed = seed64(F.concat(F.col(symbol), F.lit("|"), F.col(day).cast("string")))
    part = lambda bits, m: F.floor(F.col("x") / F.lit(2**bits).cast("decimal(20,0)")).cast("decimal(20,0)") % m
    cents = lambda c: (c / 100).cast("decimal(18,2)")
    base: Column = F.lit(BASE)
    for s, b in BASES.items():
        base = F.when(F.col(symbol) == s, b).otherwise(base)
    p = pairs.select(F.col(symbol).alias("symbol"), F.col(day).cast("date").alias("event_date"), base.cast("decimal(18,2)").alias("base"), seed.alias("x"))
    p = p.withColumn("o", (F.col("base") + cents(F.col("x") % 10000)).cast("decimal(18,2)")).withColumn("c", (F.col("o") + cents(part(16, 400) - 200)).cast("decimal(18,2)")).withColumn("w", cents(part(32, 150)))
    cent = F.lit("0.01").cast("decimal(18,2)")
    high, low = F.greatest("o", "c") + F.col("w") + cent, F.least("o", "c") - F.col("w") - cent
    return p.select("symbol", "event_date", *[x.cast("decimal(18,8)").alias(n) for n, x in (("open", F.col("o")), ("high", high), ("low", low), ("close", F.col("c")))], (F.col("x") % 5000000 + 1000000).cast("bigint").alias("volume"), (F.col("x") % 90000 + 10000).cast("bigint").alias("trades"))


def overridden(bars: DataFrame, overrides: DataFrame) -> DataFrame:
    """Bars with the values of overrides (symbol, event_date and any value columns) where those are not null."""
    given = [c for c in overrides.columns if c not in ("symbol", "event_date")]
    o = overrides.select("symbol", "event_date", *[F.col(c).alias(f"_{c}") for c in given])
    return bars.join(o, ["symbol", "event_date"], "left").select(*[F.coalesce(f"_{c}", F.col(c)).cast(bars.schema[c].dataType).alias(c) if c in given else F.col(c) for c in bars.columns])


def documents(bars: DataFrame, nonce: str | None = None) -> DataFrame:
    """(symbol, payload, event_min, event_max, row_count): each symbol's generated bars as a flat vendor document, byte for
    byte a function of the bars: keys sorted, rows by day, numbers without exponent. nonce: a request id, if any; it
    changes the bytes, not the bars."""
    row = F.struct(F.col("symbol").alias("T"), *[F.col(c).cast("decimal(18,2)").alias(n) for c, n in (("close", "c"), ("high", "h"), ("low", "l"))], F.col("trades").alias("n"), F.col("open").cast("decimal(18,2)").alias("o"), day_millis(F.col("event_date")).alias("t"), F.col("volume").alias("v"))
    held = bars.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct("event_date", row.alias("r")))).alias("x"), F.min("event_date").alias("event_min"), F.max("event_date").alias("event_max"), F.count(F.lit(1)).alias("row_count"))
    doc = F.to_json(F.struct(F.lit(False).alias("adjusted"), F.lit(nonce).cast("string").alias("request_id"), F.transform("x", lambda e: e["r"]).alias("results"), F.col("row_count").alias("resultsCount"), F.lit("OK").alias("status")))
    return held.select("symbol", doc.cast("binary").alias("payload"), "event_min", "event_max", "row_count")


def fetch(spark: SparkSession, mode: str, symbols: list[str], start: str, end: str, retrieved_at: str, sessions: DataFrame | None = None, overrides: DataFrame | None = None, nonce: str | None = None, **live: str) -> DataFrame:
    """Documents as the "vendor_daily" source gives them. mode "fixture": generated, one for each symbol over the sessions
    (column session) from start to end, with overrides; a symbol without sessions has an empty document with the request's
    bounds. mode "live": fetched, with the source's options. Any other mode raises ValueError."""
    if mode == "live":
        return spark.read.format("vendor_daily").options(symbols=",".join(symbols), start=start, end=end, retrieved_at=retrieved_at, **live).load()
    if mode != "fixture" or sessions is None:
        raise ValueError("mode must be live, or fixture with sessions")
    asked = spark.createDataFrame([(s,) for s in sorted({x.strip().upper() for x in symbols if x.strip()})], "symbol string")
    days = sessions.select(F.col("session").cast("date").alias("session")).where(F.col("session").between(F.lit(start).cast("date"), F.lit(end).cast("date"))).distinct()
    span = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    bars = generated_bars(asked.select("symbol", F.explode(span).alias("session")).join(days, "session"))
    docs = documents(bars if overrides is None else overridden(bars, overrides), nonce)
    empty = F.to_json(F.struct(F.lit(False).alias("adjusted"), F.lit(nonce).cast("string").alias("request_id"), F.array().cast("array<string>").alias("results"), F.lit(0).alias("resultsCount"), F.lit("OK").alias("status"))).cast("binary")
    out = asked.join(docs, "symbol", "left").withColumn("payload", F.coalesce("payload", empty))
    lo, hi = (F.coalesce(c, F.lit(x).cast("date")) for c, x in (("event_min", start), ("event_max", end)))
    return out.select(F.lit("fixture").alias("source"), F.lit("daily").alias("dataset"), "symbol", F.sha2("payload", 256).alias("sha256"), "payload", F.lit(retrieved_at).cast("timestamp").alias("observation_time"), lo.alias("event_min"), hi.alias("event_max"), F.coalesce("row_count", F.lit(0)).alias("row_count"), F.lit(nonce).cast("string").alias("request_id"))

"""Queries on the general problems of TESTDATA.md and, where SQL can say it, the SQL to hold them against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.functions.common import strip, symbol_key, table
from vintara.operators.asknown import attributes_as_known, known_versions
from vintara.operators.grid import regular_grid
from vintara.operators.history import renamed_periods
from vintara.operators.rolling import trailing_totals
from vintara.operators.snapshots import snapshot_changes
from vintara.operators.spikes import implausible_readings

PRICES = ("open", "high", "low", "close", "volume")


def _day(name: str) -> F.Column:
    return F.date_format(name, "yyyy-MM-dd")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    found = implausible_readings(table(spark, d, "daily_bars"))
    return found.select("symbol", _day("event_date").alias("event_date"), "source_artifact_id")


def p1_reasons(spark: SparkSession, d: str) -> DataFrame:
    found = implausible_readings(table(spark, d, "daily_bars"))
    return found.select("symbol", _day("event_date").alias("event_date"), "source_artifact_id", F.array_join("reasons", ",").alias("reasons"))


def _sessions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "exchange_sessions").where("calendar = 'XMER' and version = '2.0.0'")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    grid = regular_grid(table(spark, d, "daily_bars"), _sessions(spark, d))
    return grid.where("n_readings = 0").select("symbol", _day("session").alias("session"))


def p2_grid(spark: SparkSession, d: str) -> DataFrame:
    grid = regular_grid(table(spark, d, "daily_bars"), _sessions(spark, d))
    return grid.select("symbol", _day("session").alias("session"), "n_readings", F.col("close").cast("double").alias("close"), "volume", "status")


def _actions(spark: SparkSession, d: str) -> DataFrame:
    cols = ["symbol", "ex_date", "observation_time", "source_artifact_id"]
    splits, dividends = (table(spark, d, t).select(F.lit(k).alias("action"), *cols, F.col(v).cast("double").alias("value")) for t, k, v in (("splits", "SPLIT", "ratio"), ("dividends", "DIVIDEND", "cash_amount")))
    return splits.unionByName(dividends)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    bars = table(spark, d, "daily_bars")
    cases = known_versions(bars, _actions(spark, d)).where("not (known_id <=> true_id)").select("s", "d", "t", "kind", "known_id")
    rows = bars.select(symbol_key("symbol").alias("s"), F.col("event_date").alias("d"), F.col("observation_time").alias("t"), "source_artifact_id")
    out = rows.join(cases, ["s", "d", "t"])
    return out.select(F.col("s").alias("symbol"), _day("d").alias("event_date"), "source_artifact_id", F.col("kind").alias("action"), F.coalesce("known_id", F.lit("")).alias("known_artifact_id")).distinct()


def p3_attributes(spark: SparkSession, d: str) -> DataFrame:
    bars = table(spark, d, "daily_bars").select("symbol", "event_date", "observation_time", "source_artifact_id", "close")
    out = attributes_as_known(bars, _actions(spark, d), ("SPLIT", "DIVIDEND"))
    return out.select(symbol_key("symbol").alias("symbol"), _day("event_date").alias("event_date"), "source_artifact_id", F.col("close").cast("double").alias("close"), F.col("known_SPLIT").alias("split_ratio"), F.col("known_DIVIDEND").alias("cash_amount"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    deliveries = table(spark, d, "ingestion_results").select("logical_key", "vintage", F.col("sha256").alias("source_artifact_id")).dropna().distinct()
    bars = table(spark, d, "snapshot_bars").select(symbol_key("symbol").alias("symbol"), "event_date", *PRICES, "source_artifact_id")
    diff = snapshot_changes(bars.join(deliveries, "source_artifact_id"), "logical_key", "vintage", ("symbol", "event_date"), PRICES)
    return diff.select("logical_key", "vintage", "symbol", _day("event_date").alias("event_date"), "change_kind")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    periods = renamed_periods(table(spark, d, "listings"), table(spark, d, "ticker_changes"))
    return periods.select("listing_id", "symbol", _day("valid_from").alias("valid_from"), F.coalesce(_day("valid_to"), F.lit("")).alias("valid_to"))


def p6_trailing(spark: SparkSession, d: str) -> DataFrame:
    out = trailing_totals(table(spark, d, "daily_bars"))
    return out.withColumn("event_date", _day("event_date"))


QUERIES = {f.__name__: f for f in (p1_found, p1_reasons, p2_found, p2_grid, p3_found, p3_attributes, p4_found, p5_found, p6_trailing)}

#: Stripping as in functions.common.strip, blank as null.
_KEY = "nullif(upper(trim({0}, chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288))), '')"
_SYM = _KEY.format("symbol")
_BARS = f"bars as (select {_SYM} s, event_date d, open o, high h, low l, close c, volume v, observation_time t, source_artifact_id a from daily_bars)"
_GRID = f"""{_BARS}, b as (select * from bars where s is not null and d is not null),
 span as (select s, min(d) lo, max(d) hi from b group by s), days as (select distinct session d from exchange_sessions where calendar = 'XMER' and version = '2.0.0'),
 latest as (select s, d, max(n) n, max(c) filter (r = 1) c, max(v) filter (r = 1) v from (select s, d, c, v, count(*) over (partition by s, d) n,
   row_number() over (partition by s, d order by t desc nulls last, c desc nulls last, v desc nulls last) r from b) group by s, d),
 grid as (select span.s, days.d, latest.n, latest.c, latest.v, row_number() over (partition by span.s order by days.d) i
   from span join days on days.d between lo and hi left join latest on latest.s = span.s and latest.d = days.d),
 carried as (select *, last_value(c ignore nulls) over w fc, i - max(i) filter (c is not null) over w gc, last_value(v ignore nulls) over w fv, i - max(i) filter (v is not null) over w gv
   from grid window w as (partition by s order by i rows unbounded preceding))"""
_ACTIONS = " union all ".join(f"select distinct '{k}' kind, {_SYM} s, ex_date x, observation_time vt, source_artifact_id id, cast({v} as double) val from {t} where symbol is not null and ex_date is not null and {v} is not null" for t, k, v in (("splits", "SPLIT", "ratio"), ("dividends", "DIVIDEND", "cash_amount")))
_KNOWN = f"""{_BARS}, acts as ({_ACTIONS}), ev as (select distinct s, d, t from bars where s is not null and d is not null and t is not null),
 hits as (select ev.s, ev.d, ev.t, kind, x, vt, id, val, row_number() over (partition by ev.s, ev.d, ev.t, kind order by x desc, vt desc nulls last, id desc, val desc) best,
   row_number() over (partition by ev.s, ev.d, ev.t, kind, vt <= ev.t order by x desc, vt desc nulls last, id desc, val desc) best_known from ev join acts on acts.s = ev.s and acts.x <= ev.d),
 known as (select s, d, t, kind, max(id) filter (best = 1) true_id, max(id) filter (vt <= t and best_known = 1) known_id, max(val) filter (vt <= t and best_known = 1) known_value from hits group by s, d, t, kind)"""


def _window(w: int) -> str:
    return f"""cast(sum(v) over w{w} as bigint) total_{w}, case when count(c) over w{w} > 0 then cast(sum(c) over w{w} as double) / count(c) over w{w} end avg_{w}"""


ORACLE = {
    "p2_found": f"with {_GRID} select s symbol, strftime(d, '%Y-%m-%d') session from grid where n is null",
    "p2_grid": f"""with {_GRID} select s symbol, strftime(d, '%Y-%m-%d') session, coalesce(n, 0) n_readings, case when gc <= 5 then cast(fc as double) end as close, case when gv <= 5 then fv end volume,
 case when n is not null then 'observed' when gc <= 5 or gv <= 5 then 'filled' else 'missing' end status from carried""",
    "p3_found": f"with {_KNOWN} select distinct bars.s symbol, strftime(bars.d, '%Y-%m-%d') event_date, a source_artifact_id, kind as action, coalesce(known_id, '') known_artifact_id from bars join known on bars.s = known.s and bars.d = known.d and bars.t = known.t where known_id is distinct from true_id",
    "p3_attributes": f"""with {_KNOWN} select bars.s symbol, strftime(bars.d, '%Y-%m-%d') event_date, a source_artifact_id, cast(c as double) as close, p.known_value split_ratio, q.known_value cash_amount from bars
 left join known p on p.kind = 'SPLIT' and bars.s = p.s and bars.d = p.d and bars.t = p.t left join known q on q.kind = 'DIVIDEND' and bars.s = q.s and bars.d = q.d and bars.t = q.t""",
    "p4_found": f"""with r as (select logical_key g, vintage n, {_SYM} s, event_date d, max(row(open, high, low, close, volume)) x from snapshot_bars join (select distinct logical_key, vintage, sha256 from ingestion_results
   where logical_key is not null and vintage is not null) on sha256 = source_artifact_id where {_SYM} is not null and event_date is not null group by 1, 2, 3, 4),
 v as (select g, n, lag(n) over (partition by g order by n) prev from (select distinct g, n from r)),
 a as (select r.*, v.prev from r join v using (g, n) where prev is not null), b as (select r.g, v.n, r.s, r.d, r.x from r join v on r.g = v.g and r.n = v.prev)
 select coalesce(a.g, b.g) logical_key, coalesce(a.n, b.n) vintage, coalesce(a.s, b.s) symbol, strftime(coalesce(a.d, b.d), '%Y-%m-%d') event_date,
 case when b.g is null then 'added' when a.g is null then 'removed' else 'changed' end change_kind
 from a full join b on a.g = b.g and a.n = b.n and a.s = b.s and a.d = b.d where a.g is null or b.g is null or a.x is distinct from b.x""",
    "p5_found": f"""with recursive c as (select {_KEY.format('old_symbol')} o, {_KEY.format('new_symbol')} n, effective_date d, observation_time t from ticker_changes),
 m as (select o, n, max(d) d from (select *, rank() over (partition by o, n order by t desc nulls last) r from c where o is not null and n is not null and d is not null and o <> n) where r = 1 group by o, n),
 p as (select distinct listing_id k, {_SYM} s, listed_on f, delisted_on u from listings
   union all select k, n, d, u from (select p.k, m.n, m.d, p.u, row_number() over (partition by p.k order by m.d, m.n) r from p join m on m.o = p.s and m.d > p.f and (p.u is null or m.d < p.u)) where r = 1)
 select k listing_id, s symbol, strftime(f, '%Y-%m-%d') valid_from, coalesce(strftime(coalesce(lead(f) over (partition by k order by f), u), '%Y-%m-%d'), '') valid_to from p""",
    "p6_trailing": f"""with {_BARS}, b as (select s, d, c, v from (select *, row_number() over (partition by s, d order by t desc nulls last, v desc nulls last, c desc nulls last) r from bars where s is not null and d is not null) where r = 1),
 days as (select s, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) d from (select s, min(d) lo, max(d) hi from b group by s)),
 x as (select days.s, days.d, b.v, b.c from days left join b on b.s = days.s and b.d = days.d)
 select s symbol, strftime(d, '%Y-%m-%d') event_date, {_window(7)}, {_window(30)} from x
 window w7 as (partition by s order by d rows 6 preceding), w30 as (partition by s order by d rows 29 preceding)""",
}

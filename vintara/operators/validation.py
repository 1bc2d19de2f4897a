"""Validation rules: bars in, findings out. Each rule is one plan; nothing is collected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintara.schema import COLUMNS, FINDING, RULE_ORDER, RULES, RULESET_VERSION, schema_matches


def _finding(df: DataFrame, rule: str, observed: Column, **columns: Column | str | None) -> DataFrame:
    version, severity, reason = RULES[rule]
    given = {"source": "source", "artifact_id": "source_artifact_id", "symbol": "symbol", "event_date": "event_date"} | columns
    cols = [F.lit(rule), F.lit(version), F.lit(severity), F.lit(reason), *[F.lit(None) if c is None else F.col(c) if isinstance(c, str) else c for c in given.values()], observed]
    return df.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(cols, FINDING)])


def malformed(rows: DataFrame) -> DataFrame:
    """MD001: one finding for each row of a parsed document (sources.vendor.parsed) that is no bar; row -1 is the
    document."""
    bad = rows.where("code is not null").withColumn("source", F.lit(None).cast("string"))
    return _finding(bad, "MD001", F.format_string("row=%d", "row"))


def null_fields(bars: DataFrame) -> DataFrame:
    """MD002: one finding for each null in a required column, by one pass over the bars."""
    names = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in COLUMNS]))
    return _finding(bars.withColumn("_null", F.explode(names)), "MD002", F.col("_null"))


def duplicate_keys(bars: DataFrame) -> DataFrame:
    """MD003: (symbol, event_date) held more than once; nulls are values of a key. Counts are added before the shuffle."""
    n = bars.groupBy("symbol", "event_date").count().where("count > 1")
    return _finding(n, "MD003", F.format_string("count=%d", "count"), source=None, artifact_id=None)


def _range_rule() -> tuple[Column, Column]:
    valid = (F.col("high") >= F.col("open")) & (F.col("high") >= F.col("close")) & (F.col("low") <= F.col("open")) & (F.col("low") <= F.col("close")) & (F.col("high") >= F.col("low"))
    return valid, F.concat_ws(",", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(c).cast("string"), F.lit("None"))) for k, c in (("o", "open"), ("h", "high"), ("l", "low"), ("c", "close"))])


def impossible_ranges(bars: DataFrame) -> DataFrame:
    """MD004: bars that break high >= open, close, low and low <= open, close; unknown comparisons alone are no finding."""
    valid, told = _range_rule()
    return _finding(bars.where(~valid), "MD004", told)


def negative_volumes(bars: DataFrame) -> DataFrame:
    """MD005: volume below zero."""
    return _finding(bars.where("volume < 0"), "MD005", F.format_string("volume=%d", "volume"))


def missing_sessions(bars: DataFrame, symbols: DataFrame, sessions: DataFrame) -> DataFrame:
    """MD006: sessions (column session) on which a requested symbol (column symbol) has no bar. Bars on other days are
    no finding. Symbols times sessions is the size of the complete answer; the sessions of a calendar are few."""
    lo, hi = sessions.agg(F.min("session"), F.max("session")).first()
    days = F.sequence(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
    expected = symbols.select("symbol").distinct().select("symbol", F.explode(days).alias("event_date"))
    expected = expected.join(sessions.select(F.col("session").alias("event_date")).distinct(), "event_date")
    gone = expected.join(bars.select("symbol", "event_date").distinct(), ["symbol", "event_date"], "left_anti")
    return _finding(gone, "MD006", F.col("event_date").cast("string"), source=None, artifact_id=None)


def duplicate_observations(bars: DataFrame) -> DataFrame:
    """MD007: one artifact holding a (source, symbol, event_date) more than once."""
    n = bars.groupBy("source", "symbol", "event_date", "source_artifact_id").count().where("count > 1")
    return _finding(n, "MD007", F.format_string("count=%d", "count"))


def no_digest(c: Column) -> Column:
    """Whether a value is no SHA-256 in lower-case hex; a null is none either."""
    return ~F.coalesce(c.rlike(r"^[0-9a-f]{64}\z"), F.lit(False))


def schema_finding(bars: DataFrame) -> DataFrame:
    """MD008: one finding, decided from the schema alone."""
    one = bars.sparkSession.range(1)
    return _finding(one, "MD008", F.lit(",".join(bars.columns)), source=None, artifact_id=None, symbol=None, event_date=None)


def row_findings(bars: DataFrame) -> DataFrame:
    """MD002, MD004 and MD005 by one pass over the bars: a row's findings are listed side by side, then taken apart."""
    valid, told = _range_rule()
    nulls = F.transform(F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in COLUMNS])), lambda c: F.struct(F.lit("MD002").alias("rule"), c.alias("observed")))
    others = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(r).alias("rule"), x.alias("observed"))) for r, c, x in (("MD004", ~valid, told), ("MD005", F.col("volume") < 0, F.format_string("volume=%d", "volume")))]))
    found = bars.withColumn("_f", F.explode(F.concat(nulls, others)))
    rule = lambda k: F.element_at(F.create_map(*[F.lit(x) for r in ("MD002", "MD004", "MD005") for x in (r, RULES[r][k])]), F.col("_f.rule"))
    cols = [F.col("_f.rule"), rule(0), rule(1), rule(2), *[F.col(c) for c in ("source", "source_artifact_id", "symbol", "event_date")], F.col("_f.observed")]
    return found.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(cols, FINDING)])


def findings(bars: DataFrame, symbols: DataFrame | str | None = None, sessions: DataFrame | None = None) -> DataFrame:
    """All findings on bars; a wrong schema gives MD008 and nothing else. Without symbols or sessions there is no MD006;
    symbols="own" expects those of the bars.

    Rules on rows share one pass; each rule on keys counts them before the shuffle.
    """
    if not schema_matches(bars):
        return schema_finding(bars)
    parts = [row_findings(bars), duplicate_keys(bars), duplicate_observations(bars)]
    if symbols is not None and sessions is not None:
        own = bars.where("symbol is not null")
        parts.append(missing_sessions(own, own if isinstance(symbols, str) else symbols, sessions))
    return reduce(DataFrame.unionByName, parts)


def ordered(found: DataFrame) -> DataFrame:
    """Findings in the order of a report: by rule, then symbol and date, nulls first, then the rest."""
    rank = F.array_position(F.array(*[F.lit(r) for r in RULE_ORDER]), F.col("rule_id"))
    return found.orderBy(rank, F.col("symbol").asc_nulls_first(), F.col("event_date").asc_nulls_first(), "source", "artifact_id", "observed_value")


def summary(found: DataFrame) -> DataFrame:
    """One row: ruleset_version, passed (no ERROR), error_count, warning_count, total_findings."""
    errors = F.count_if(F.col("severity") == "ERROR")
    return found.agg(F.lit(RULESET_VERSION).alias("ruleset_version"), (errors == 0).alias("passed"), errors.alias("error_count"), F.count_if(F.col("severity") == "WARNING").alias("warning_count"), F.count(F.lit(1)).alias("total_findings"))

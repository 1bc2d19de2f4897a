"""The engine's own queries over the test tables, each with the SQL to hold it against.

They take whole tables. daily_bars is the dirty delivery table, snapshot_bars and ingestion_results the deliveries whose
versions are compared; the star-schema tables serve where an operator needs parents, children or documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintara.functions import canonical as C
from vintara.functions.common import shared_folder, strip, symbol_key, table
from vintara.operators import evidence, identity, manifests, validation
from vintara.operators.snapshots import except_all_both, snapshot_changes
from vintara.plans.problems import _SYM, PRICES
from vintara.schema import COLUMNS, ECONOMIC
from vintara.sources import fixtures, store, vendor
from vintara.sources.fixtures import generated_bars
from vintara.streaming import deliveries

INSTANT = "2023-07-01 00:00:00"
#: Which state may follow which.
TRANSITIONS = (
    "RAW VALIDATED", "RAW QUARANTINED", "VALIDATED PROVISIONAL", "VALIDATED QUARANTINED", "PROVISIONAL SEALED", "PROVISIONAL QUARANTINED", "PROVISIONAL SUPERSEDED", "QUARANTINED VALIDATED", "QUARANTINED SUPERSEDED", "SEALED SUPERSEDED",
)


def _text(df: DataFrame) -> DataFrame:
    """Dates, instants and decimals as text, so that both engines' values compare."""
    out = {}
    for f in df.schema:
        if isinstance(f.dataType, T.DateType):
            out[f.name] = F.col(f.name).cast("string")
        elif isinstance(f.dataType, T.TimestampType):
            out[f.name] = F.date_format(f.name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.DecimalType):
            out[f.name] = C.plain_decimal(F.col(f.name))
    return df.withColumns(out)


def _bars(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "daily_bars").select(*COLUMNS)


def _clean(s: SparkSession, d: str) -> DataFrame:
    return identity.cleaned(_bars(s, d))


def _sessions(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "exchange_sessions").where("calendar = 'XMER' and version = '2.0.0'")


def canonical_bars(s, d):
    return _text(_clean(s, d))


def economic_projection(s, d):
    return _text(_clean(s, d).select(*ECONOMIC))


def md002_nulls(s, d):
    return _text(validation.null_fields(_bars(s, d)))


def md003_duplicate_key(s, d):
    return _text(validation.duplicate_keys(_clean(s, d)))


def md004_impossible_ohlc(s, d):
    return _text(validation.impossible_ranges(_bars(s, d)))


def md005_negative_volume(s, d):
    return _text(validation.negative_volumes(_bars(s, d)))


def md006_missing_sessions(s, d):
    bars = _clean(s, d)
    return _text(validation.missing_sessions(bars, bars.where("symbol is not null").select("symbol"), _sessions(s, d)))


def md007_duplicate_observation(s, d):
    return _text(validation.duplicate_observations(_bars(s, d)))


def md008_schema(s, d):
    return _text(validation.findings(table(s, d, "listings")))


def _findings(s, d):
    return validation.findings(_clean(s, d), "own", _sessions(s, d))


def validation_summary(s, d):
    return validation.summary(_findings(s, d))


def findings_by_rule(s, d):
    return _findings(s, d).groupBy("rule_id", "severity").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("symbol").alias("n_symbols"))


def logical_hash(s, d):
    return identity.logical_hashes(identity.cleaned(table(s, d, "snapshot_bars")))


def _deliveries(s, d):
    """One row for each artifact of snapshot_bars: key, time, content."""
    bars = identity.cleaned(table(s, d, "snapshot_bars")).dropDuplicates([*ECONOMIC, "source_artifact_id"])
    hashes = identity.logical_hashes(bars)
    keys = table(s, d, "ingestion_results").where("sha256 is not null").groupBy(F.col("sha256").alias("source_artifact_id")).agg(F.min("logical_key").alias("logical_key"))
    times = table(s, d, "snapshot_bars").groupBy("source_artifact_id").agg(F.min("observation_time").alias("observation_time"))
    return hashes.join(keys, "source_artifact_id").join(times, "source_artifact_id").select("logical_key", "source_artifact_id", "logical_hash", "observation_time")


def economic_vintage(s, d):
    return _text(identity.vintages(_deliveries(s, d)).select("logical_key", "source_artifact_id", F.col("vintage").cast("bigint").alias("vintage")))


def classify_deliveries(s, d):
    return _text(identity.classified(_deliveries(s, d)).select("logical_key", "source_artifact_id", "kind", "prior_raw"))


def _changes(s, d):
    deliveries = table(s, d, "ingestion_results").select("logical_key", "vintage", F.col("sha256").alias("source_artifact_id")).dropna().distinct()
    bars = identity.cleaned(table(s, d, "snapshot_bars")).select("symbol", "event_date", *PRICES, "source_artifact_id")
    return snapshot_changes(bars.join(deliveries, "source_artifact_id"), "logical_key", "vintage", ("symbol", "event_date"), PRICES)


def changed_observations(s, d):
    out = identity.changed_observations(_changes(s, d))
    return out.select("logical_key", "vintage", "n_changed", F.array_join("changed", ",").alias("changed"))


def as_of_known(s, d):
    bars = _clean(s, d).where("symbol is not null and event_date is not null")
    out = identity.as_of(bars.select("symbol", "event_date", "observation_time", "source_artifact_id", "close"), INSTANT)
    return _text(out)


def latest_bar(s, d):
    bars = _clean(s, d).where("symbol is not null")
    return _text(identity.latest_by(bars.select("symbol", "event_date", "observation_time", "source_artifact_id", "close"), ("symbol",), ("event_date", "observation_time", "source_artifact_id")))


def latest_run(s, d):
    runs = table(s, d, "ingestion_results").select("logical_key", "vintage", "run_id", "state")
    return identity.latest_by(runs, ("logical_key", "vintage"), ("run_id",))


def repeated_in_artifact(s, d):
    w = Window.partitionBy("source_artifact_id", "symbol", "event_date").orderBy(*[F.col(c).asc_nulls_first() for c in ("open", "high", "low", "close", "volume", "source", "observation_time")])
    out = _clean(s, d).withColumn("nth", F.row_number().over(w).cast("bigint")).where("nth > 1")
    return _text(out.select("source_artifact_id", "symbol", "event_date", "nth"))


def first_failure(s, d):
    bad = validation.findings(_clean(s, d)).where("artifact_id is not null")
    out = bad.groupBy("artifact_id").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rule_id", F.coalesce("symbol", F.lit("")).alias("symbol"), F.coalesce(F.col("event_date").cast("string"), F.lit("")).alias("event_date"), "observed_value")).alias("x"))
    return out.select("artifact_id", "n", "x.*")


def referential_integrity(s, d):
    bars = table(s, d, "snapshot_bars").select("source_artifact_id", "symbol", "event_date")
    return _text(identity.orphans(bars, table(s, d, "ingestion_results"), "source_artifact_id", "sha256"))


def provenance_linked(s, d):
    runs = table(s, d, "ingestion_results").select("run_id", "sha256", "logical_key", "vintage")
    return identity.orphans(runs, table(s, d, "snapshot_bars"), "sha256", "source_artifact_id")


def order_references(s, d):
    return identity.orphans(table(s, d, "lineitem").select("l_orderkey", "l_partkey"), table(s, d, "orders"), "l_orderkey", "o_orderkey")


def evidence_join(s, d):
    c, n, r = table(s, d, "customer"), table(s, d, "nation"), table(s, d, "region")
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    return j.groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("n_customers"), F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("acctbal"))


def gate_matrix(s, d):
    runs = table(s, d, "ingestion_results")
    out = evidence.gates(runs, ["source"], {"has_digest": F.col("manifest_digest").isNotNull(), "not_quarantined": ~F.col("quarantined"), "sized": F.col("byte_size") > 0}, (F.col("state"), ["PROVISIONAL"]))
    return out.select("source", "n_rows", "has_digest", "not_quarantined", "sized", "has_all", "passed")


def transitions(s, d):
    runs = table(s, d, "ingestion_results").select("logical_key", "vintage", "run_id", F.col("state").alias("to"))
    line = Window.partitionBy("logical_key").orderBy("vintage", "run_id")
    moves = runs.withColumn("from", F.lag("to").over(line)).where("`from` is not null").select("logical_key", "run_id", "from", "to")
    edges = s.createDataFrame([x.split(" ") for x in TRANSITIONS], "from string, to string")
    return evidence.transitions_outside(moves, edges)


def namespace_scan(s, d):
    runs = table(s, d, "ingestion_results")
    out = runs.where(F.col("dataset").like("%/%") & ~F.col("logical_key").like("test%")).select("source", "dataset", F.split_part("logical_key", F.lit("|"), F.lit(2)).alias("part"), C.last_segment(F.col("dataset")).alias("last")).distinct()
    return out


def json_field_strict(s, d):
    e = table(s, d, "events")
    v = F.try_parse_json("props")
    return e.select("event_id", F.try_variant_get(v, "$.k", "bigint").alias("k"))


def json_type_check(s, d):
    v = F.try_parse_json("validation_summary")
    kind = F.schema_of_variant(F.variant_get(v, "$.errors", "variant"))
    return table(s, d, "ingestion_results").select("run_id", F.when(kind == "BIGINT", F.try_variant_get(v, "$.errors", "bigint")).alias("errors"), F.try_variant_get(v, "$.warnings", "bigint").alias("warnings"))


def et_business_date(s, d):
    e = table(s, d, "events").select("event_id", F.unix_millis("ts").alias("t"))
    return _text(e.select("event_id", C.utc_day(F.col("t")).alias("utc_day"), C.market_day(F.col("t")).alias("market_day"), C.day_millis(C.utc_day(F.col("t"))).alias("midnight")))


def sla_staleness(s, d):
    days = _sessions(s, d).select(F.col("session").alias("event_date"), C.expected_by(F.col("close_utc")).alias("due"))
    late = _clean(s, d).where("symbol is not null").join(days, "event_date").withColumn("late", F.col("observation_time") > F.col("due"))
    return late.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.count_if("late").alias("n_late"))


def content_dedupe(s, d):
    docs = table(s, d, "documents").where("text is not null").select(F.sha2("text", 256).alias("sha256"), "doc_id")
    return docs.groupBy("sha256").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"))


def supersede_chain(s, d):
    docs = table(s, d, "documents").select("doc_id", F.col("ruling_id"), "version_no").where("ruling_id is not null")
    line = Window.partitionBy("ruling_id").orderBy(F.col("version_no").asc_nulls_first(), "doc_id")
    chain = docs.withColumn("supersedes", F.lag("doc_id").over(line))
    return identity.superseded_last(chain, "doc_id", "supersedes").select("doc_id", "ruling_id", "supersedes")


def canonical_decimal(s, d):
    return _bars(s, d).select(C.plain_decimal(F.col("open")).alias("open"), C.plain_decimal(F.col("close")).alias("close"), F.count(F.lit(1)).over(_all_by("open", "close")).alias("n")).distinct()


def _all_by(*cols):
    return Window.partitionBy(*cols)


def canonical_json_digest(s, d):
    runs = table(s, d, "ingestion_results").select("run_id", "source", "dataset", "vintage", "quarantined", "governance_event_types", "manifest_digest")
    out = identity.row_digests(runs)
    return out.select("run_id", "digest")


def manifest(s, d):
    runs = table(s, d, "ingestion_results").where("sha256 is not null")
    bars = identity.cleaned(table(s, d, "snapshot_bars"))
    stats = bars.groupBy("source_artifact_id").agg(F.count(F.lit(1)).alias("rows"), F.array_sort(F.collect_set("symbol")).alias("symbols"), F.min("event_date").alias("lo"), F.max("event_date").alias("hi"), F.min("observation_time").alias("at"))
    b = runs.join(stats, F.col("sha256") == F.col("source_artifact_id"))
    b = b.select(
        "run_id", "source", "dataset", "logical_key", "vintage", "state", "symbols", F.col("lo").alias("event_date_min"), F.col("hi").alias("event_date_max"), F.col("at").alias("observation_time"), "sha256", "object_path", "byte_size",
        F.col("row_count").alias("raw_row_count"), F.lit("fixture").alias("fetch_mode"), F.col("rows").alias("row_count"), F.struct(F.lit("1.0.0").alias("ruleset_version"), (~F.col("quarantined")).alias("passed")).alias("validation"), F.struct(F.lit("XMER").alias("calendar_name"), F.lit("2.0.0").alias("calendar_vintage")).alias("reference_calendar"),
    )
    return manifests.manifests(b).select("run_id", "manifest", "manifest_digest")


def except_all(s, d):
    """What one calendar version has and the other lacks, both ways."""
    days = table(s, d, "exchange_sessions")
    one, two = (days.where(F.col("version") == v).select("calendar", "session", "close_utc") for v in ("1.0.0", "2.0.0"))
    a, b = except_all_both(one, two)
    return _text(a.withColumn("side", F.lit("old")).unionByName(b.withColumn("side", F.lit("new"))))


def generated(s, d):
    pairs = table(s, d, "listings").select(symbol_key("symbol").alias("symbol"), "listed_on").where("symbol is not null").distinct()
    return _text(generated_bars(pairs, "symbol", "listed_on"))


def request_symbols(s, d):
    a = table(s, d, "daily_bars").where("symbol is not null").groupBy("source_artifact_id").agg(F.collect_set("symbol").alias("raw"))
    return a.select("source_artifact_id", F.array_join(C.symbols_of(F.col("raw")), ",").alias("symbols"))


def logical_keys(s, d):
    a = _clean(s, d).where("source is not null and event_date is not null").groupBy("source", "source_artifact_id").agg(F.min("event_date").cast("string").alias("lo"), F.max("event_date").cast("string").alias("hi"))
    return a.select("source_artifact_id", C.logical_key(F.col("source"), F.lit("bars"), F.col("lo"), F.col("hi")).alias("logical_key"), C.path_join(F.lit("/raw/"), F.col("source"), F.col("source_artifact_id")).alias("path"), C.truthy(strip(F.col("source"))).alias("flag"))


def parse_documents(s, d):
    """Each record as a vendor's document of one row, parsed again: rows by outcome."""
    b = _bars(s, d)
    result = F.struct(F.col("symbol").alias("T"), C.day_millis(F.col("event_date")).alias("t"), F.col("open").alias("o"), F.col("high").alias("h"), F.col("low").alias("l"), F.col("close").alias("c"), F.col("volume").alias("v"))
    docs = b.select(F.to_json(F.struct(F.lit("OK").alias("status"), F.array(result).alias("results"))).cast("binary").alias("payload"))
    rows = vendor.parsed(docs)
    return rows.groupBy(F.coalesce("code", F.lit("")).alias("code")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("symbol").alias("n_symbols"), F.sum("volume").alias("volume"), C.plain_decimal(F.sum("close")).alias("close"), F.min(F.col("event_date").cast("string")).alias("first"))


def malformed_rows(s, d):
    """MD001 of records that are written as documents."""
    b = _bars(s, d)
    result = F.struct(F.col("symbol").alias("T"), C.day_millis(F.col("event_date")).alias("t"), F.col("open").alias("o"), F.col("high").alias("h"), F.col("low").alias("l"), F.col("close").alias("c"), F.col("volume").alias("v"))
    found = validation.malformed(vendor.parsed(b.select(F.to_json(F.struct(F.array(result).alias("results"))).cast("binary").alias("payload"))))
    return found.groupBy("rule_id", "severity", "reason", "observed_value").agg(F.count(F.lit(1)).alias("n"))


def _envelopes(s, d):
    """Each record as an envelope of one page that asks for days of 2023; times of day at noon UTC."""
    b = _bars(s, d).where(symbol_key("symbol").isNotNull())
    noon = C.day_millis(F.col("event_date")) + 12 * 3_600_000
    row = F.struct(noon.alias("t"), F.col("open").alias("o"), F.col("high").alias("h"), F.col("low").alias("l"), F.col("close").alias("c"), F.col("volume").alias("v"))
    page = F.to_json(F.struct(F.lit("OK").alias("status"), F.col("symbol").alias("ticker"), F.array(row).alias("results")))
    request = F.struct(F.col("symbol").alias("ticker"), F.lit("2023-01-01").alias("from"), F.lit("2023-12-31").alias("to"))
    doc = F.struct(F.lit("aggregates").alias("envelope_kind"), F.lit("v2").alias("endpoint_version"), request.alias("request"), F.array(page).alias("pages"))
    return vendor.parsed(b.select(F.to_json(doc).cast("binary").alias("payload")))


def envelope_rows(s, d):
    rows = _envelopes(s, d).where("code is null").groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume"), F.sum("close").alias("close"), F.min("event_date").alias("first"), F.max("event_date").alias("last"))
    return _text(rows)


def reason_codes(s, d):
    return _envelopes(s, d).groupBy(F.coalesce("code", F.lit("")).alias("code")).agg(F.count(F.lit(1)).alias("n"))


def fixture_document(s, d):
    """Generated documents of all listed symbols over a month's sessions, Mondays overridden, parsed again."""
    days = _sessions(s, d).where("session between '2023-01-01' and '2023-01-31'").select("session").distinct()
    symbols = table(s, d, "listings").select(symbol_key("symbol").alias("symbol")).where("symbol is not null").distinct()
    pairs = symbols.select("symbol", F.explode(F.sequence(F.lit("2023-01-01").cast("date"), F.lit("2023-01-31").cast("date"))).alias("session")).join(days, "session")
    mondays = pairs.where(F.weekday("session") == 0).select("symbol", F.col("session").alias("event_date"), F.lit(1).cast("bigint").alias("volume"))
    docs = fixtures.documents(fixtures.overridden(fixtures.generated_bars(pairs), mondays), "run-1")
    return _text(vendor.parsed(docs).select("symbol", "event_date", "open", "high", "low", "close", "volume", F.col("row").cast("bigint").alias("row"), "code"))


def stored_as_of(s, d):
    """Complete records delivered as documents, taken in, validated, stored by vintage, read back: what was known."""
    b = _clean(s, d).dropna().groupBy("source_artifact_id", "symbol", "event_date", "observation_time").agg(F.max(F.struct("open", "high", "low", "close", "volume")).alias("x"))
    row = F.struct(F.col("symbol").alias("T"), C.day_millis(F.col("event_date")).alias("t"), F.col("x.open").alias("o"), F.col("x.high").alias("h"), F.col("x.low").alias("l"), F.col("x.close").alias("c"), F.col("x.volume").alias("v"))
    docs = b.groupBy("source_artifact_id").agg(F.min("observation_time").alias("modificationTime"), F.to_json(F.struct(F.array_sort(F.collect_list(row)).alias("results"))).cast("binary").alias("content"))
    root = f"{shared_folder(s)}/stored-{uuid.uuid4()}"
    deliveries.ingest_batch(docs.select(F.lit("").alias("path"), "modificationTime", F.length("content").cast("bigint").alias("length"), "content"), root, "feed", "daily")
    deliveries.finalize(s, root, "feed", "daily", ("XMER", "2.0.0"))
    stored = store.read(s, f"{root}/canonical", deliveries.STORED).select(*COLUMNS)
    return _text(identity.as_of(stored, INSTANT).select("symbol", "event_date", "close", "volume", "observation_time", "source_artifact_id"))


def digest_format(s, d):
    runs = table(s, d, "ingestion_results")
    return runs.groupBy("source").agg(F.count_if(validation.no_digest(F.col("sha256"))).alias("n_bad"), F.count_if(validation.no_digest(F.substring("sha256", 2, 63))).alias("n_cut"))


def expected_gates(s, d):
    """Which listed symbols have bars at all that are complete: listed ones without a bar fail."""
    want = table(s, d, "listings").select(symbol_key("symbol").alias("symbol")).where("symbol is not null")
    out = evidence.gates(_clean(s, d).where("symbol is not null"), ["symbol"], {"closed": F.col("close").isNotNull(), "traded": F.col("volume") >= 0}, groups=want)
    return out.select("symbol", "n_rows", "closed", "traded", "passed")


_NAMES = """canonical_bars economic_projection md002_nulls md003_duplicate_key md004_impossible_ohlc md005_negative_volume md006_missing_sessions md007_duplicate_observation md008_schema
validation_summary findings_by_rule logical_hash economic_vintage classify_deliveries changed_observations as_of_known latest_bar latest_run repeated_in_artifact first_failure referential_integrity
provenance_linked order_references evidence_join gate_matrix transitions namespace_scan json_field_strict json_type_check et_business_date sla_staleness content_dedupe supersede_chain canonical_decimal
canonical_json_digest manifest except_all generated request_symbols logical_keys parse_documents malformed_rows envelope_rows reason_codes fixture_document stored_as_of digest_format expected_gates"""
QUERIES = {n: globals()[n] for n in _NAMES.split()}

# ---- the same in SQL ----

_DEC = "regexp_replace(regexp_replace(cast({0} as varchar), '(\\.\\d*?)0+$', '\\1'), '\\.$', '')"
_TS = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
_P = {c: f"{_DEC.format(c)} as {c}" for c in ("open", "high", "low", "close")}
_CLEAN = f"(select {_SYM} as symbol, event_date, open, high, low, close, volume, source, observation_time, source_artifact_id from daily_bars)"
_RAW = f"(select {', '.join(COLUMNS)} from daily_bars)"
_SNAP = f"(select {_SYM} as symbol, event_date, open, high, low, close, volume, source, observation_time, source_artifact_id from snapshot_bars)"
_DAYS = "(select session from exchange_sessions where calendar = 'XMER' and version = '2.0.0')"
_RULE = {"MD002": ("ERROR", "null_required_field"), "MD003": ("ERROR", "duplicate_symbol_date"), "MD004": ("ERROR", "impossible_ohlc"), "MD005": ("ERROR", "negative_volume"), "MD006": ("WARNING", "missing_trading_date"), "MD007": ("ERROR", "duplicate_source_observation")}


def _f(rule: str, observed: str, body: str, source: str = "source", artifact: str = "source_artifact_id") -> str:
    severity, reason = _RULE[rule]
    return f"select '{rule}' rule_id, '1.0.0' rule_version, '{severity}' severity, '{reason}' reason, {source} as source, {artifact} as artifact_id, symbol, cast(event_date as varchar) event_date, {observed} observed_value from {body}"


def _null(bars: str) -> str:
    return " union all ".join(_f("MD002", f"'{c}'", f"{bars} where {c} is null") for c in COLUMNS)


def _rules(bars: str) -> list[str]:
    told = " || ',' || ".join(f"'{k}=' || coalesce(cast({c} as varchar), 'None')" for k, c in (("o", "open"), ("h", "high"), ("l", "low"), ("c", "close")))
    return [
        _null(bars),
        _f("MD003", "'count=' || n", f"(select symbol, event_date, count(*) n from {bars} group by 1, 2) where n > 1", "cast(null as varchar)", "cast(null as varchar)"),
        _f("MD004", told, f"{bars} where not (high >= open and high >= close and low <= open and low <= close and high >= low)"),
        _f("MD005", "'volume=' || volume", f"{bars} where volume < 0"),
        _f("MD007", "'count=' || n", f"(select source, symbol, event_date, source_artifact_id, count(*) n from {bars} group by 1, 2, 3, 4) where n > 1"),
    ]


_MD006 = _f("MD006", "cast(event_date as varchar)", f"(select s.symbol, d.session event_date from (select distinct symbol from {_CLEAN} where symbol is not null) s cross join (select distinct session from {_DAYS}) d where not exists (select 1 from {_CLEAN} b where b.symbol = s.symbol and b.event_date = d.session))", "cast(null as varchar)", "cast(null as varchar)")
_ALL = " union all ".join([*_rules(_CLEAN), _MD006])
_Q = lambda x: f"coalesce('\"' || {x} || '\"', 'null')"
_ECO = "'{\"close\":' || " + _Q(_DEC.format("close")) + " || ',\"event_date\":' || " + _Q("cast(event_date as varchar)") + " || ',\"high\":' || " + _Q(_DEC.format("high")) + " || ',\"low\":' || " + _Q(_DEC.format("low")) + " || ',\"open\":' || " + _Q(_DEC.format("open")) + " || ',\"symbol\":' || coalesce(cast(to_json(symbol) as varchar), 'null') || ',\"volume\":' || coalesce(cast(volume as varchar), 'null') || '}'"


def _hash(bars: str) -> str:
    return f"select source_artifact_id, count(*) n_rows, sha256('[' || string_agg(j, ',' order by s, d, j) || ']') logical_hash from (select source_artifact_id, coalesce(symbol, 'None') s, coalesce(cast(event_date as varchar), 'None') d, {_ECO} j from {bars}) group by 1"


_DELIV = f"""dl as (select logical_key, source_artifact_id, logical_hash, observation_time from ({_hash(f'(select distinct symbol, event_date, open, high, low, close, volume, source_artifact_id from {_SNAP})')})
 join (select sha256, min(logical_key) logical_key from ingestion_results where sha256 is not null group by 1) on sha256 = source_artifact_id join (select source_artifact_id, min(observation_time) observation_time from snapshot_bars group by 1) using (source_artifact_id))"""
_P4 = f"""r as (select logical_key g, vintage n, {_SYM} s, event_date d, max(row(open, high, low, close, volume)) x from snapshot_bars join (select distinct logical_key, vintage, sha256 from ingestion_results
 where logical_key is not null and vintage is not null) on sha256 = source_artifact_id where {_SYM} is not null and event_date is not null group by 1, 2, 3, 4),
 v as (select g, n, lag(n) over (partition by g order by n) prev from (select distinct g, n from r)),
 a as (select r.*, v.prev from r join v using (g, n) where prev is not null), b as (select r.g, v.n, r.s, r.d, r.x from r join v on r.g = v.g and r.n = v.prev)"""
_STR = lambda x: f"coalesce(cast(to_json({x}) as varchar), 'null')"
_ISO = lambda x: f"case when microsecond({x}) % 1000000 = 0 then strftime({x}, '%Y-%m-%dT%H:%M:%SZ') else strftime({x}, '%Y-%m-%dT%H:%M:%S.%fZ') end"
_COLS = "[" + ",".join(f'"{c}"' for c in COLUMNS) + "]"

#: Records as envelopes: the first problem in the order of the checks.
_ENV = f"(select *, {_SYM} s from daily_bars where {_SYM} is not null)"
_CODES = """when event_date is null then 'TIMESTAMP_INVALID' when event_date not between date '2023-01-01' and date '2023-12-31' then 'OUTSIDE_REQUEST_RANGE' when open is null or high is null or low is null or close is null then 'NUMERIC_NONFINITE'
 when volume is null or volume < 0 then 'VOLUME_INVALID' when not (high >= low and low <= open and open <= high and low <= close and close <= high) then 'OHLC_INVALID' else ''"""
#: JSON writes a decimal of 0 with its scale as an exponent.
_ZERO = "case when {0} = 0 then '0E-8' else cast({0} as varchar) end"
_MADE = """y as (select *, 100 + cast(x % 10000 as decimal(18,2)) / 100 o0, cast((x >> 32) % 150 as decimal(18,2)) / 100 w0 from x), z as (select s, d, x, cast(o0 as decimal(18,2)) o, cast(cast(o0 as decimal(18,2)) + cast(cast((x >> 16) % 400 as decimal(18,2)) - 200 as decimal(18,2)) / 100 as decimal(18,2)) c, cast(w0 as decimal(18,2)) w from y)"""

ORACLE = {
    "canonical_bars": f"select symbol, cast(event_date as varchar) event_date, {', '.join(_P.values())}, volume, source, {_TS.format('observation_time')} observation_time, source_artifact_id from {_CLEAN}",
    "economic_projection": f"select symbol, cast(event_date as varchar) event_date, {', '.join(_P.values())}, volume from {_CLEAN}",
    "md002_nulls": _null(_RAW),
    "md003_duplicate_key": _rules(_CLEAN)[1],
    "md004_impossible_ohlc": _rules(_RAW)[2],
    "md005_negative_volume": _rules(_RAW)[3],
    "md006_missing_sessions": _MD006,
    "md007_duplicate_observation": _rules(_RAW)[4],
    "md008_schema": "select 'MD008' rule_id, '1.0.0' rule_version, 'ERROR' severity, 'schema_mismatch' reason, cast(null as varchar) as source, cast(null as varchar) artifact_id, cast(null as varchar) symbol, cast(null as varchar) event_date, 'listing_id,symbol,listed_on,delisted_on' observed_value",
    "validation_summary": f"select '1.0.0' ruleset_version, count(*) filter (severity = 'ERROR') = 0 passed, count(*) filter (severity = 'ERROR') error_count, count(*) filter (severity = 'WARNING') warning_count, count(*) total_findings from ({_ALL})",
    "findings_by_rule": f"select rule_id, severity, count(*) n, count(distinct symbol) n_symbols from ({_ALL}) group by 1, 2",
    "logical_hash": _hash(_SNAP),
    "economic_vintage": f"with {_DELIV}, f as (select logical_key, logical_hash, min(row(observation_time, source_artifact_id)) x from dl where logical_key is not null group by 1, 2), v as (select logical_key, logical_hash, dense_rank() over (partition by logical_key order by x, logical_hash) vintage from f) select logical_key, source_artifact_id, vintage from dl left join v using (logical_key, logical_hash)",
    "classify_deliveries": f"""with {_DELIV}, k as (select *, row_number() over (partition by logical_key order by observation_time nulls first, source_artifact_id) k from dl),
 c as (select *, row_number() over (partition by logical_key, source_artifact_id order by k) r, row_number() over (partition by logical_key, logical_hash order by k) c, first_value(source_artifact_id) over (partition by logical_key, logical_hash order by k) p from k)
 select logical_key, source_artifact_id, case when k = 1 then 'first' when r > 1 then 'identical_refetch' when c > 1 then 'raw_only' else 'restatement' end kind, case when k > 1 and (r > 1 or c > 1) then p end prior_raw from c""",
    "changed_observations": f"""with {_P4}, x as (select coalesce(a.g, b.g) logical_key, coalesce(a.n, b.n) vintage, coalesce(a.s, b.s) || ':' || strftime(coalesce(a.d, b.d), '%Y-%m-%d') o
 from a full join b on a.g = b.g and a.n = b.n and a.s = b.s and a.d = b.d where a.g is null or b.g is null or a.x is distinct from b.x) select logical_key, vintage, count(*) n_changed, string_agg(o, ',' order by o) changed from x group by 1, 2""",
    "as_of_known": f"select symbol, cast(event_date as varchar) event_date, {_TS.format('observation_time')} observation_time, source_artifact_id, {_P['close']} from (select *, row_number() over (partition by symbol, event_date order by observation_time desc, source_artifact_id desc nulls last, close desc nulls last) r from {_CLEAN} where observation_time <= timestamptz '{INSTANT}+00' and symbol is not null and event_date is not null) where r = 1",
    "latest_bar": f"select symbol, cast(event_date as varchar) event_date, {_TS.format('observation_time')} observation_time, source_artifact_id, {_P['close']} from (select *, row_number() over (partition by symbol order by event_date desc nulls last, observation_time desc nulls last, source_artifact_id desc nulls last, close desc nulls last) r from {_CLEAN} where symbol is not null) where r = 1",
    "latest_run": "select logical_key, vintage, run_id, state from (select *, row_number() over (partition by logical_key, vintage order by run_id desc nulls last, state desc nulls last) r from ingestion_results) where r = 1",
    "repeated_in_artifact": f"select source_artifact_id, symbol, cast(event_date as varchar) event_date, nth from (select *, row_number() over (partition by source_artifact_id, symbol, event_date order by open nulls first) nth from {_CLEAN}) where nth > 1",
    "first_failure": f"""select artifact_id, n, rule_id, symbol, event_date, observed_value from (select artifact_id, rule_id, coalesce(symbol, '') symbol, coalesce(event_date, '') event_date, observed_value, count(*) over (partition by artifact_id) n,
 row_number() over (partition by artifact_id order by rule_id, coalesce(symbol, ''), coalesce(event_date, ''), observed_value) r from ({' union all '.join(_rules(_CLEAN))}) where artifact_id is not null) where r = 1""",
    "referential_integrity": "select source_artifact_id, symbol, cast(event_date as varchar) event_date from snapshot_bars b where source_artifact_id is not null and not exists (select 1 from ingestion_results i where i.sha256 = b.source_artifact_id)",
    "provenance_linked": "select run_id, sha256, logical_key, vintage from ingestion_results i where sha256 is not null and not exists (select 1 from snapshot_bars b where b.source_artifact_id = i.sha256)",
    "order_references": "select l_orderkey, l_partkey from lineitem where l_orderkey is not null and not exists (select 1 from orders where o_orderkey = l_orderkey)",
    "evidence_join": "select r_name, n_name, count(*) n_customers, cast(sum(cast(c_acctbal as decimal(18,2))) as double) acctbal from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2",
    "gate_matrix": """select source, n_rows, has_digest, not_quarantined, sized, has_all, has_digest and not_quarantined and sized and has_all passed from (select source, count(*) n_rows, bool_and(manifest_digest is not null) has_digest,
 bool_and(coalesce(not quarantined, false)) not_quarantined, bool_and(coalesce(byte_size > 0, false)) sized, bool_or(coalesce(state = 'PROVISIONAL', false)) has_all from ingestion_results group by 1)""",
    "transitions": "select logical_key, run_id, \"from\", \"to\" from (select logical_key, run_id, state \"to\", lag(state) over (partition by logical_key order by vintage nulls first, run_id nulls first) \"from\" from ingestion_results) where \"from\" is not null and not coalesce(\"from\" || ' ' || \"to\" in (" + ", ".join(f"'{x}'" for x in TRANSITIONS) + "), false)",
    "namespace_scan": "select distinct source, dataset, split_part(logical_key, '|', 2) part, upper(split_part(dataset, '/', -1)) \"last\" from ingestion_results where dataset like '%/%' and logical_key not like 'test%'",
    "json_field_strict": "select event_id, cast(json_extract(props, '$.k') as bigint) k from events",
    "json_type_check": "select run_id, case when json_type(validation_summary, '$.errors') in ('UBIGINT', 'BIGINT') then cast(json_extract(validation_summary, '$.errors') as bigint) end errors, cast(json_extract(validation_summary, '$.warnings') as bigint) warnings from ingestion_results",
    "et_business_date": "select event_id, cast(cast(ts as date) as varchar) utc_day, cast(cast(timezone('America/New_York', make_timestamptz(epoch_us(ts) // 1000 * 1000)) as date) as varchar) market_day, epoch_ms(cast(cast(ts as date) as timestamp)) midnight from events",
    "sla_staleness": f"select symbol, count(*) n, count(*) filter (observation_time > close_utc + interval 90 minute) n_late from {_CLEAN} b join (select session, close_utc from exchange_sessions where calendar = 'XMER' and version = '2.0.0') on session = event_date where symbol is not null group by 1",
    "content_dedupe": "select sha256(text) sha256, min(doc_id) doc_id, count(*) n from documents where text is not null group by 1",
    "supersede_chain": "with c as (select doc_id, ruling_id, lag(doc_id) over (partition by ruling_id order by version_no nulls first, doc_id) supersedes from documents where ruling_id is not null) select * from c where not exists (select 1 from c x where x.supersedes = c.doc_id)",
    "canonical_decimal": f"select {_P['open']}, {_P['close']}, count(*) n from daily_bars group by daily_bars.open, daily_bars.close",
    "canonical_json_digest": "select run_id, sha256('{\"dataset\":' || " + _STR("dataset") + " || ',\"governance_event_types\":' || coalesce('[' || array_to_string(list_transform(governance_event_types, lambda x: coalesce(cast(to_json(x) as varchar), 'null')), ',') || ']', 'null') || ',\"manifest_digest\":' || " + _STR("manifest_digest") + " || ',\"quarantined\":' || coalesce(cast(quarantined as varchar), 'null') || ',\"run_id\":' || " + _STR("run_id") + " || ',\"source\":' || " + _STR("source") + " || ',\"vintage\":' || coalesce(cast(vintage as varchar), 'null') || '}') digest from ingestion_results",
    "manifest": f"""with st as (select source_artifact_id a, count(*) n, list_sort(list(distinct symbol) filter (symbol is not null)) sy, min(event_date) lo, max(event_date) hi, min(observation_time) ot from {_SNAP} group by 1),
 m as (select run_id, '{{"canonical":{{"columns":{_COLS},"row_count":' || n || ',"schema_version":"1.0.0"}},"dataset":' || {_STR('dataset')} || ',"event_date_max":' || coalesce('"' || cast(hi as varchar) || '"', 'null') || ',"event_date_min":' || coalesce('"' || cast(lo as varchar) || '"', 'null')
 || ',"logical_key":' || {_STR('logical_key')} || ',"manifest_schema":"1.0.0","observation_time":' || coalesce('"' || {_ISO('ot')} || '"', 'null') || ',"raw_artifact":{{"byte_size":' || coalesce(cast(byte_size as varchar), 'null') || ',"fetch_mode":"fixture","object_path":' || {_STR('object_path')}
 || ',"row_count":' || coalesce(cast(row_count as varchar), 'null') || ',"sha256":' || {_STR('sha256')} || '}},"reference_calendar":{{"calendar_name":"XMER","calendar_vintage":"2.0.0"}},"source":' || {_STR('source')} || ',"state":' || {_STR('state')}
 || ',"symbols":[' || coalesce(array_to_string(list_transform(sy, lambda x: cast(to_json(x) as varchar)), ','), '') || '],"validation":{{"passed":' || coalesce(cast(not quarantined as varchar), 'null') || ',"ruleset_version":"1.0.0"}},"vintage":' || coalesce(cast(vintage as varchar), 'null') || '}}' manifest
 from ingestion_results join st on a = sha256) select run_id, manifest, sha256(manifest) manifest_digest from m""",
    "except_all": f"""with o as (select calendar, session, close_utc from exchange_sessions where version = '1.0.0'), n as (select calendar, session, close_utc from exchange_sessions where version = '2.0.0')
 select calendar, cast(session as varchar) session, {_TS.format('close_utc')} close_utc, side from (select *, 'old' side from (select * from o except all select * from n) union all select *, 'new' side from (select * from n except all select * from o))""",
    "generated": f"""with p as (select distinct {_SYM} s, listed_on d from listings where {_SYM} is not null), x as (select s, d, cast('0x' || substr(sha256(s || '|' || cast(d as varchar)), 1, 16) as ubigint) x from p),
 y as (select *, 100 + cast(x % 10000 as decimal(18,2)) / 100 o0, cast((x >> 32) % 150 as decimal(18,2)) / 100 w0 from x), z as (select s, d, x, cast(o0 as decimal(18,2)) o, cast(cast(o0 as decimal(18,2)) + cast(cast((x >> 16) % 400 as decimal(18,2)) - 200 as decimal(18,2)) / 100 as decimal(18,2)) c, cast(w0 as decimal(18,2)) w from y)
 select s symbol, cast(d as varchar) event_date, {_DEC.format('cast(o as decimal(18,8))')} as open, {_DEC.format('cast(greatest(o, c) + w + 0.01 as decimal(18,8))')} high, {_DEC.format('cast(least(o, c) - w - 0.01 as decimal(18,8))')} low, {_DEC.format('cast(c as decimal(18,8))')} as close, cast(x % 5000000 + 1000000 as bigint) volume, cast(x % 90000 + 10000 as bigint) trades from z""",
    "parse_documents": f"""select case when k then '' else 'MALFORMED_RECORD' end code, count(*) n, count(distinct case when k then s end) n_symbols, cast(sum(case when k then volume end) as bigint) volume, {_DEC.format('sum(case when k then close end)')} as close, min(case when k then cast(event_date as varchar) end) "first"
 from (select *, {_SYM} s, {_SYM} is not null and event_date is not null and open is not null and high is not null and low is not null and close is not null and volume is not null k from daily_bars) group by k""",
    "malformed_rows": f"select 'MD001' rule_id, 'ERROR' severity, 'malformed_record' reason, 'row=0' observed_value, count(*) n from daily_bars where not ({_SYM} is not null and event_date is not null and open is not null and high is not null and low is not null and close is not null and volume is not null)",
    "reason_codes": f"select case {_CODES} end code, count(*) n from {_ENV} group by 1",
    "envelope_rows": f"select s symbol, count(*) n, cast(sum(volume) as bigint) volume, {_DEC.format('sum(close)')} as close, cast(min(event_date) as varchar) \"first\", cast(max(event_date) as varchar) \"last\" from {_ENV} where case {_CODES} end = '' group by 1",
    "fixture_document": f"""with p as (select s, d from (select distinct {_SYM} s from listings where {_SYM} is not null) cross join (select distinct session d from {_DAYS} where session between date '2023-01-01' and date '2023-01-31')),
 x as (select s, d, cast('0x' || substr(sha256(s || '|' || cast(d as varchar)), 1, 16) as ubigint) x from p), {_MADE}
 select s symbol, cast(d as varchar) event_date, {_DEC.format('cast(o as decimal(18,8))')} as open, {_DEC.format('cast(greatest(o, c) + w + 0.01 as decimal(18,8))')} high, {_DEC.format('cast(least(o, c) - w - 0.01 as decimal(18,8))')} low, {_DEC.format('cast(c as decimal(18,8))')} as close,
 case when isodow(d) = 1 then 1 else cast(x % 5000000 + 1000000 as bigint) end volume, row_number() over (partition by s order by d) - 1 as row, cast(null as varchar) code from z""",
    "stored_as_of": f"""with r as (select source_artifact_id a, symbol s, event_date d, observation_time t, max(row(open, high, low, close, volume)) x from {_CLEAN} where {' and '.join(f'{c} is not null' for c in COLUMNS)} group by 1, 2, 3, 4),
 b as (select a, s, d, t, x[1] o, x[2] h, x[3] l, x[4] c, x[5] v from r),
 docs as (select min(t) t, sha256('{{"results":[' || string_agg('{{"T":' || cast(to_json(s) as varchar) || ',"t":' || epoch_ms(cast(d as timestamp)) || ',"o":' || {_ZERO.format('o')} || ',"h":' || {_ZERO.format('h')} || ',"l":' || {_ZERO.format('l')} || ',"c":' || {_ZERO.format('c')} || ',"v":' || v || '}}', ',' order by s, d, t, o, h, l, c, v) || ']}}') sha,
   list(row(s, d, o, h, l, c, v) order by s, d, o, h, l, c, v) k, min(d) lo, max(d) hi, bool_or(not (h >= o and h >= c and l <= o and l <= c and h >= l) or v < 0) or count(*) > count(distinct (s, d)) bad from b group by a),
 one as (select sha, min(t) t, any_value(k) k, any_value(lo) lo, any_value(hi) hi from docs where not bad group by sha),
 kept as (select * from (select *, row_number() over (partition by lo, hi, k order by t, sha) n from one) where n = 1),
 held as (select sha, t, u[1] s, u[2] d, u[6] c, u[7] v from (select sha, t, unnest(k) u from kept))
 select s symbol, cast(d as varchar) event_date, {_DEC.format('c')} as close, v volume, {_TS.format('t')} observation_time, sha source_artifact_id from (select *, row_number() over (partition by s, d order by t desc, sha desc) n from held where t <= timestamptz '{INSTANT}+00') where n = 1""",
    "digest_format": "select source, count(*) filter (not coalesce(regexp_full_match(sha256, '[0-9a-f]{64}'), false)) n_bad, count(*) n_cut from ingestion_results group by 1",
    "expected_gates": f"select w.s symbol, coalesce(n, 0) n_rows, closed, traded, coalesce(closed and traded, false) passed from (select distinct {_SYM} s from listings where {_SYM} is not null) w left join (select symbol, count(*) n, bool_and(close is not null) closed, bool_and(coalesce(volume >= 0, false)) traded from {_CLEAN} where symbol is not null group by 1) b on b.symbol = w.s",
    "request_symbols": f"select source_artifact_id, string_agg(s, ',' order by s) symbols from (select distinct source_artifact_id, coalesce({_SYM}, '') s from daily_bars where symbol is not null) group by 1",
    "logical_keys": "select source_artifact_id, source || '|bars|' || min(event_date) || '|' || max(event_date) logical_key, 'raw/' || source || '/' || source_artifact_id path, lower(source) in ('true', '1', 'yes') flag from daily_bars where source is not null and event_date is not null group by source, source_artifact_id",
}

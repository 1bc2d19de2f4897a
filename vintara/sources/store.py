"""Stores on a Hadoop file system: raw artifacts by content, canonical bars, manifests, append-only ledgers, anchors.

Nothing is updated: this module has no way to. Each write appends, and what is stored already is left out by an anti-join
on its key, so a batch that is run again adds nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.operators.identity import new_only
from vintara.schema import BAR

ANCHOR = "anchored_at string, digest string, subject_id string, subject_type string"


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    """A stored table, empty if nothing was stored yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return spark.createDataFrame([], schema)
        raise


def _laid_out(rows: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """Rows of one folder brought together, so that a folder gets few files; a folder of many rows is split again."""
    return rows.hint("rebalance", *partition_by) if partition_by else rows


def insert_absent(batch: DataFrame, path: str, key: tuple[str, ...], partition_by: tuple[str, ...] = ()) -> int:
    """Append the rows whose key is not stored; how many those were. The greatest row of a repeated key counts."""
    fresh = new_only(batch, read(batch.sparkSession, path, batch.schema), key).persist()
    try:
        n = fresh.count()
        if n:
            _laid_out(fresh, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)
        return n
    finally:
        fresh.unpersist()


def put_raw(artifacts: DataFrame, root: str) -> int:
    """Artifacts (source, dataset, payload, observation_time, ...) by content: the key is source and SHA-256 of the bytes,
    so the same bytes on another day are not written again. Laid out by source, dataset and day of observation."""
    a = artifacts.withColumns({"sha256": F.sha2("payload", 256), "byte_size": F.length("payload").cast("bigint"), "observation_date": F.to_date("observation_time")})
    return insert_absent(a, f"{root}/raw", ("source", "sha256"), ("source", "dataset", "observation_date"))


def put_canonical(bars: DataFrame, root: str) -> int:
    """Bars with dataset and vintage, by source, dataset and vintage; one delivery's bars (artifact) are written once."""
    keyed = bars.select(*BAR.fieldNames(), "dataset", "vintage")
    have = read(bars.sparkSession, f"{root}/canonical", keyed.schema).select("source", "dataset", "vintage", "source_artifact_id").distinct()
    fresh = keyed.join(have.withColumn("vintage", F.col("vintage").cast(keyed.schema["vintage"].dataType)), ["source", "dataset", "vintage", "source_artifact_id"], "left_anti").select(*keyed.columns).persist()
    try:
        n = fresh.count()
        if n:
            by = ("source", "dataset", "vintage")
            _laid_out(fresh, by).write.mode("append").partitionBy(*by).parquet(f"{root}/canonical")
        return n
    finally:
        fresh.unpersist()


def put_manifests(built: DataFrame, root: str) -> int:
    """Manifests by digest."""
    return insert_absent(built.select("source", "dataset", "vintage", "manifest_digest", "manifest"), f"{root}/manifests", ("manifest_digest",), ("source", "dataset"))


def append_anchors(rows: DataFrame, path: str) -> None:
    """Lines of sorted, compact JSON with anchored_at (+00:00), digest, subject_id and subject_type."""
    at = F.when(F.date_format("anchored_at", "SSSSSS") == "000000", F.date_format("anchored_at", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).otherwise(F.date_format("anchored_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))
    rows.select(F.to_json(F.struct(at.alias("anchored_at"), "digest", "subject_id", "subject_type")).alias("value")).write.mode("append").text(path)


def read_anchors(spark: SparkSession, path: str) -> DataFrame:
    """All anchors; none if nothing was anchored yet. Blank lines are skipped."""
    try:
        return spark.read.schema(ANCHOR).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], ANCHOR)
        raise


#: The ledgers and what identifies a record in each.
LEDGERS = {
    "artifacts": ("source", "sha256"), "observations": ("sha256", "observed_at"), "runs": ("run_id",), "builds": ("build_id",), "build_artifacts": ("build_id", "sha256"), "validation_runs": ("validation_run_id",),
    "findings": ("finding_id",), "events": ("event_id",), "calendars": ("calendar", "version"),
}


def record(rows: DataFrame, root: str, ledger: str) -> int:
    """Append records to a ledger, those it has not yet; how many those were. An unknown ledger raises KeyError."""
    return insert_absent(rows, f"{root}/ledgers/{ledger}", LEDGERS[ledger])


def recorded(spark: SparkSession, root: str, ledger: str, schema, where: dict[str, object] | None = None, order: tuple[str, ...] = ()) -> DataFrame:
    """A ledger's records with these values (None for null), in this order if any; none if nothing was recorded yet."""
    if ledger not in LEDGERS:
        raise KeyError(ledger)
    out = read(spark, f"{root}/ledgers/{ledger}", schema)
    for c, x in (where or {}).items():
        out = out.where(F.col(c).eqNullSafe(F.lit(x)))
    return out.orderBy(*order) if order else out


def register_calendar(sessions: DataFrame, root: str) -> int:
    """Record each calendar version (calendar, version, n_sessions, first, last) once; how many were new."""
    return record(sessions.groupBy("calendar", "version").agg(F.count(F.lit(1)).alias("n_sessions"), F.min("session").alias("first"), F.max("session").alias("last")), root, "calendars")


def open_store(uri: str, options: dict[str, str] | None = None, needed: dict[str, tuple[str, ...]] | None = None) -> str:
    """The root of a store by its address: a path or a Hadoop URI. For schemes in `needed` the named options must be there
    and not empty, or it fails closed with ValueError, as it does without an address."""
    if not uri:
        raise ValueError("no store given")
    missing = [k for k in (needed or {}).get(uri.partition("://")[0] if "://" in uri else "file", ()) if not (options or {}).get(k)]
    if missing:
        raise ValueError(f"the store needs {', '.join(missing)}")
    return uri.rstrip("/")

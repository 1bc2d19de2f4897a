"""Deliveries as a stream: files that arrive in a folder are stored by content, parsed and kept as ledgers.

There is no watermark: a late or corrected delivery is another version, never dropped. A batch that is run again after a
failure adds nothing, since all it writes is keyed by content.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vintara.functions.canonical import logical_key
from vintara.operators import validation
from vintara.operators.identity import classified, logical_hashes, vintages
from vintara.operators.manifests import manifests
from vintara.schema import BAR, RULESET_VERSION
from vintara.sources import store, vendor

FILES = "path string, modificationTime timestamp, length bigint, content binary"
STORED = T.StructType([*BAR.fields, T.StructField("row", T.IntegerType())])


def ingest_batch(files: DataFrame, root: str, source: str, dataset: str) -> None:
    """Raw bytes, rows, problems, findings and logical hashes of a batch of files (as FILES).

    What a file says was observed when the file came: bars carry that time, of equal files the earliest. Files without
    content or time are left out.
    """
    files = files.where("content is not null and modificationTime is not null").select(F.sha2("content", 256).alias("sha256"), F.col("content").alias("payload"), F.col("modificationTime").alias("observation_time"))
    one = files.groupBy("sha256").agg(F.min("observation_time").alias("observation_time"), F.first("payload").alias("payload"), F.array_sort(F.collect_set("observation_time")).alias("times"))
    one = one.persist()  # each file's bytes are read once
    try:
        store.insert_absent(one.select("sha256", F.explode("times").alias("observation_time")), f"{root}/observations", ("sha256", "observation_time"))
        known = store.read(files.sparkSession, f"{root}/raw", "source string, sha256 string").where(F.col("source") == source).select("sha256")
        fresh = one.drop("times").join(known, "sha256", "left_anti").select(F.lit(source).alias("source"), F.lit(dataset).alias("dataset"), "payload", "observation_time", "sha256")
        rows = vendor.parsed(fresh).persist()
        good = vendor.accepted(rows).withColumn("source", F.lit(source)).join(fresh.select(F.col("sha256").alias("source_artifact_id"), "observation_time"), "source_artifact_id").select(*STORED.fieldNames())
        store.insert_absent(good, f"{root}/bars", ("source_artifact_id", "row"))
        store.insert_absent(vendor.rejected(rows), f"{root}/problems", ("source_artifact_id",))
        found = validation.findings(good.select(*BAR.fieldNames())).where("artifact_id is not null")
        store.insert_absent(found, f"{root}/findings", tuple(found.columns))
        store.insert_absent(logical_hashes(good), f"{root}/hashes", ("source_artifact_id",))
        store.put_raw(fresh.drop("sha256"), root)  # last: what is raw-stored is done
        rows.unpersist()
    finally:
        one.unpersist()


def deliveries(spark: SparkSession, root: str, source: str, dataset: str) -> DataFrame:
    """One row for each raw artifact of a dataset: source_artifact_id, observation_time, byte_size, n_rows, event_min,
    event_max, symbols, n_errors, logical_key, logical_hash, vintage, kind, prior_raw.

    kind: unparseable (no rows to speak of), failed_validation (an ERROR among its findings), or as identity.classified has
    it; only the latter have a vintage.
    """
    raw = store.read(spark, f"{root}/raw", "source string, dataset string, sha256 string, byte_size bigint, observation_time timestamp").where((F.col("source") == source) & (F.col("dataset") == dataset))
    bars = store.read(spark, f"{root}/bars", STORED).groupBy("source_artifact_id").agg(F.count(F.lit(1)).alias("n_rows"), F.min("event_date").alias("event_min"), F.max("event_date").alias("event_max"), F.array_sort(F.collect_set("symbol")).alias("symbols"))
    errors = store.read(spark, f"{root}/findings", "artifact_id string, severity string").where("severity = 'ERROR'").groupBy(F.col("artifact_id").alias("source_artifact_id")).agg(F.count(F.lit(1)).alias("n_errors"))
    hashes = store.read(spark, f"{root}/hashes", "source_artifact_id string, n_rows bigint, logical_hash string").drop("n_rows")
    d = raw.select(F.col("sha256").alias("source_artifact_id"), "observation_time", "byte_size").join(bars, "source_artifact_id", "left").join(errors, "source_artifact_id", "left").join(hashes, "source_artifact_id", "left")
    d = d.withColumn("n_errors", F.coalesce("n_errors", F.lit(0))).withColumn("logical_key", F.when(F.col("n_rows").isNotNull(), logical_key(F.lit(source), F.lit(dataset), F.col("event_min").cast("string"), F.col("event_max").cast("string"))))
    good, bad = d.where("n_rows is not null and n_errors = 0"), d.where("n_rows is null or n_errors > 0")
    told = bad.withColumn("kind", F.when(F.col("n_rows").isNull(), "unparseable").otherwise("failed_validation"))
    return vintages(classified(good)).unionByName(told, allowMissingColumns=True)


def finalize(spark: SparkSession, root: str, source: str, dataset: str, calendar: tuple[str, str], fetch_mode: str = "live") -> dict[str, int]:
    """Store what new contents brought: canonical bars by vintage, a manifest for each and its anchor; how many of each
    were new. Run again it adds nothing."""
    new = deliveries(spark, root, source, dataset).where("kind in ('first', 'restatement')").persist()
    try:
        bars = store.read(spark, f"{root}/bars", STORED).join(new.select("source_artifact_id", "vintage"), "source_artifact_id").withColumn("dataset", F.lit(dataset))
        n_bars = store.put_canonical(bars, root)
        built = new.select(
            F.lit(source).alias("source"), F.lit(dataset).alias("dataset"), "logical_key", "vintage", F.lit("VALIDATED").alias("state"), "symbols", F.col("event_min").alias("event_date_min"), F.col("event_max").alias("event_date_max"), "observation_time",
            F.col("source_artifact_id").alias("sha256"), F.concat(F.lit(f"raw/{source}/{dataset}/"), "source_artifact_id").alias("object_path"), "byte_size", F.col("n_rows").alias("raw_row_count"), F.lit(fetch_mode).alias("fetch_mode"), F.col("n_rows").alias("row_count"),
            F.struct(F.lit(RULESET_VERSION).alias("ruleset_version"), F.lit(True).alias("passed")).alias("validation"), F.struct(F.lit(calendar[0]).alias("calendar_name"), F.lit(calendar[1]).alias("calendar_vintage")).alias("reference_calendar"),
        )
        built = manifests(built).persist()
        n_manifests = store.put_manifests(built, root)
        have = store.read_anchors(spark, f"{root}/anchors").select("digest").distinct()
        due = built.select(F.col("manifest_digest").alias("digest")).distinct().join(have, "digest", "left_anti")
        due = due.select(F.current_timestamp().alias("anchored_at"), "digest", F.col("digest").alias("subject_id"), F.lit("manifest").alias("subject_type")).persist()
        n_anchors = due.count()
        if n_anchors:
            store.append_anchors(due, f"{root}/anchors")
        built.unpersist()
        due.unpersist()
        return {"bars": n_bars, "manifests": n_manifests, "anchors": n_anchors}
    finally:
        new.unpersist()


def ingest_stream(spark: SparkSession, folder: str, root: str, source: str, dataset: str, checkpoint: str) -> StreamingQuery:
    """Take in all files of a folder that are new, then stop."""
    files = spark.readStream.format("binaryFile").schema(FILES).load(folder)
    return files.writeStream.foreachBatch(lambda df, _: ingest_batch(df, root, source, dataset)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

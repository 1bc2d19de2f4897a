"""Manifests: one canonical document for each dataset version, and its digest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintara.functions.canonical import canonical_json
from vintara.schema import COLUMNS, SCHEMA_VERSION

#: The manifest's own schema.
MANIFEST_SCHEMA = "1.0.0"


def manifests(builds: DataFrame) -> DataFrame:
    """Each build with manifest (canonical JSON) and manifest_digest.

    builds has source, dataset, logical_key, vintage, state, symbols (array), event_date_min, event_date_max,
    observation_time, sha256, object_path, byte_size, raw_row_count, fetch_mode, row_count, validation and
    reference_calendar (structs). Symbols are sorted; run ids and times of processing are not part of it; nulls are kept.
    """
    doc = F.struct(
        F.lit(MANIFEST_SCHEMA).alias("manifest_schema"), "source", "dataset", "logical_key", "vintage", "state", F.array_sort("symbols").alias("symbols"), "event_date_min", "event_date_max", "observation_time",
        F.struct("sha256", "object_path", "byte_size", F.col("raw_row_count").alias("row_count"), "fetch_mode").alias("raw_artifact"),
        F.struct(F.lit(SCHEMA_VERSION).alias("schema_version"), "row_count", F.array(*[F.lit(c) for c in COLUMNS]).alias("columns")).alias("canonical"), "validation", "reference_calendar",
    )
    out = builds.withColumn("_doc", doc)
    text = canonical_json(F.col("_doc"), out.schema["_doc"].dataType)
    return out.withColumn("manifest", text).drop("_doc").withColumn("manifest_digest", F.sha2("manifest", 256))

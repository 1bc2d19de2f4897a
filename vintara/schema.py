"""The fixed schema of daily bars, its strict construction, and the fixed value sets of the data model."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

PRICE = T.DecimalType(18, 8)
BAR = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("event_date", T.DateType())]
    + [T.StructField(c, PRICE) for c in ("open", "high", "low", "close")]
    + [T.StructField("volume", T.LongType()), T.StructField("source", T.StringType()), T.StructField("observation_time", T.TimestampType()), T.StructField("source_artifact_id", T.StringType())]
)
COLUMNS = BAR.fieldNames()
ECONOMIC = ("symbol", "event_date", "open", "high", "low", "close", "volume")

FINDING = T.StructType([T.StructField(c, T.StringType()) for c in ("rule_id", "rule_version", "severity", "reason", "source", "artifact_id", "symbol")] + [T.StructField("event_date", T.DateType()), T.StructField("observed_value", T.StringType())])

# Rule, version, severity, reason.
RULES = {
    "MD001": ("1.0.0", "ERROR", "malformed_record"),
    "MD002": ("1.0.0", "ERROR", "null_required_field"),
    "MD003": ("1.0.0", "ERROR", "duplicate_symbol_date"),
    "MD004": ("1.0.0", "ERROR", "impossible_ohlc"),
    "MD005": ("1.0.0", "ERROR", "negative_volume"),
    "MD006": ("1.0.0", "WARNING", "missing_trading_date"),
    "MD007": ("1.0.0", "ERROR", "duplicate_source_observation"),
    "MD008": ("1.0.0", "ERROR", "schema_mismatch"),
}
#: Order in which findings of one report are listed.
RULE_ORDER = ("MD001", "MD002", "MD003", "MD004", "MD005", "MD007", "MD006", "MD008")
RULESET_VERSION = "1.0.0"
SCHEMA_VERSION = "1.0.0"


def schema_matches(df: DataFrame) -> bool:
    """Same names in the same order with the same types; nullability is not part of a type here."""
    return [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in BAR]


def bars_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Bars from Python values, strictly: a price must be a Decimal of at most 8 places and below 10^10 (ValueError),
    every other value of its column's type (PySparkTypeError). None is allowed anywhere; rules judge it later."""
    for r in rows:
        for name, x in zip(COLUMNS, r):
            if isinstance(x, Decimal) and (not x.is_finite() or x != round(x, 8) or abs(x) >= Decimal(10) ** 10):
                raise ValueError(f"{name}: {x} does not fit decimal(18,8)")
    return spark.createDataFrame(rows, BAR, verifySchema=True)

"""Identity of deliveries: digests, vintages, classes of redelivery, differences, what was known when."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintara.functions.canonical import canonical_json, json_text, plain_decimal
from vintara.functions.common import ship, symbol_key
from vintara.schema import ECONOMIC


def economic_json(prefix: str = "") -> Column:
    """One bar's economic fields as canonical JSON; null where a field is null."""
    c = lambda n: F.col(prefix + n)
    quoted = lambda x: F.coalesce(F.concat(F.lit('"'), x, F.lit('"')), F.lit("null"))
    value = {n: quoted(plain_decimal(c(n))) for n in ("open", "high", "low", "close")} | {"symbol": F.coalesce(json_text(c("symbol")), F.lit("null")), "event_date": quoted(c("event_date").cast("string")), "volume": F.coalesce(c("volume").cast("string"), F.lit("null"))}
    parts = [x for i, n in enumerate(sorted(ECONOMIC)) for x in (F.lit(f'{"," if i else ""}"{n}":'), value[n])]
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def logical_hashes(bars: DataFrame, by: tuple[str, ...] = ("source_artifact_id",)) -> DataFrame:
    """(by, n_rows, logical_hash): SHA-256 of each group's bars as one canonical JSON array, ordered by symbol and date as
    text and then by the whole row, whatever their order in the table.

    The digest is a running one over rows that Spark has sorted on disk where it must, so a group of any size needs no
    more memory than one row. Null group columns form groups. No bars, no rows.
    """
    ship(bars.sparkSession)
    kinds = T.StructType([bars.schema[c] for c in by])
    rows = bars.select(*[F.col(c).alias(f"g{i}") for i, c in enumerate(by)], F.coalesce(F.col("symbol"), F.lit("None")).alias("s"), F.coalesce(F.col("event_date").cast("string"), F.lit("None")).alias("d"), economic_json().alias("j"))
    keys = [f"g{i}" for i in range(len(by))]
    out = T.StructType([T.StructField(k, f.dataType) for k, f in zip(keys, kinds)] + [T.StructField("n_rows", T.LongType()), T.StructField("logical_hash", T.StringType())])

    def run(batches):
        now, sha, n, types = None, None, 0, None

        def ended():
            sha.update(b"]")
            return pa.RecordBatch.from_arrays([*[pa.array([k], t) for k, t in zip(now, types)], pa.array([n], pa.int64()), pa.array([sha.hexdigest()])], names=[*keys, "n_rows", "logical_hash"])

        for b in batches:
            types = [b.schema.field(k).type for k in keys]
            columns = [b.column(k).to_pylist() for k in keys]
            for key, j in zip(zip(*columns), b.column("j").to_pylist()):
                if sha is None or key != now:
                    if sha is not None:
                        yield ended()
                    now, sha, n = key, hashlib.sha256(b"["), 0
                else:
                    sha.update(b",")
                sha.update(j.encode())
                n += 1
        if sha is not None:
            yield ended()

    ordered = rows.repartition(*keys).sortWithinPartitions(*keys, "s", "d", "j").select(*keys, "j")
    return ordered.mapInArrow(run, out).select(*[F.col(k).alias(c) for k, c in zip(keys, by)], "n_rows", "logical_hash")


def row_digests(df: DataFrame, name: str = "digest") -> DataFrame:
    """Each row with the SHA-256 of its canonical JSON; a column of that name is replaced."""
    kind = T.StructType([f for f in df.schema if f.name != name])
    return df.select(*kind.fieldNames(), F.sha2(canonical_json(F.struct(*kind.fieldNames()), kind), 256).alias(name))


def changed_observations(changes: DataFrame, series: str = "logical_key", version: str = "vintage") -> DataFrame:
    """(series, version, n_changed, changed): from snapshot_changes, the sorted SYM:yyyy-MM-dd of added, removed and
    changed observations of each version. The list is the report of one restatement; n_changed is its length."""
    told = F.concat(F.col("symbol"), F.lit(":"), F.col("event_date").cast("string"))
    return changes.groupBy(series, version).agg(F.count(F.lit(1)).alias("n_changed"), F.array_sort(F.collect_list(told)).alias("changed"))


def vintages(deliveries: DataFrame, key: str = "logical_key", content: str = "logical_hash", observed: str = "observation_time", artifact: str = "source_artifact_id") -> DataFrame:
    """Each delivery with its vintage: the number, within its key, of its content by first observation (ties: the content
    whose first artifact is least). Content seen before keeps its vintage, so A, B, A gives 1, 2, 1.

    Rows without key or content get null. A delivery is a row; nothing is lost. Only one row for each content goes
    through the window by key.
    """
    first = deliveries.where(F.col(key).isNotNull() & F.col(content).isNotNull()).groupBy(key, content).agg(F.min(F.struct(observed, artifact)).alias("_first"))
    rank = first.withColumn("vintage", F.dense_rank().over(Window.partitionBy(key).orderBy("_first", content))).drop("_first")
    return deliveries.drop("vintage").join(rank, [key, content], "left")


def classified(deliveries: DataFrame, key: str = "logical_key", raw: str = "source_artifact_id", content: str = "logical_hash", observed: str = "observation_time") -> DataFrame:
    """Each delivery with kind: first (of its key), identical_refetch (these bytes came before under this key), raw_only
    (other bytes, content known under this key) or restatement; and prior_raw, the artifact that first had that content.

    Order within a key: observation (nulls first), then raw. Windows are over deliveries, not over their rows.
    """
    order = [F.col(observed).asc_nulls_first(), F.col(raw)]
    d = deliveries.drop("kind", "prior_raw")
    d = d.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    d = d.withColumns({"_r": F.row_number().over(Window.partitionBy(key, raw).orderBy("_k")), "_c": F.row_number().over(Window.partitionBy(key, content).orderBy("_k")), "prior_raw": F.first(raw).over(Window.partitionBy(key, content).orderBy("_k"))})
    kind = F.when(F.col("_k") == 1, "first").when(F.col("_r") > 1, "identical_refetch").when(F.col("_c") > 1, "raw_only").otherwise("restatement")
    return d.withColumn("kind", kind).withColumn("prior_raw", F.when(F.col("kind").isin("identical_refetch", "raw_only"), F.col("prior_raw"))).drop("_k", "_r", "_c")


def as_of(records: DataFrame, instant: str, key: tuple[str, ...] = ("symbol", "event_date"), observed: str = "observation_time", tie: str = "source_artifact_id") -> DataFrame:
    """What was known at an instant: of each key's records observed by then, the latest (ties: the greatest artifact, then
    the greatest row). Keys are compared as given; null keys form groups, records never observed are left out."""
    rest = [c for c in records.columns if c not in (*key, observed, tie)]
    known = records.where(F.col(observed) <= F.lit(instant).cast("timestamp"))
    top = known.groupBy(*key).agg(F.max(F.struct(observed, tie, *rest)).alias("_x"))
    return top.select(*[c if c in key else F.col(f"_x.{c}").alias(c) for c in records.columns])


def latest_by(records: DataFrame, key: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """The last row of each key by the order given (nulls lowest), then by the other columns."""
    rest = [c for c in records.columns if c not in (*key, *order)]
    top = records.groupBy(*key).agg(F.max(F.struct(*order, *rest)).alias("_x"))
    return top.select(*[c if c in key else F.col(f"_x.{c}").alias(c) for c in records.columns])


def new_only(batch: DataFrame, stored: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Rows of a batch, one for each key (the greatest), whose key is not stored yet: insert if absent."""
    rest = [c for c in batch.columns if c not in key]
    one = batch.groupBy(*key).agg(F.max(F.struct(*rest)).alias("_x")).select(*[c if c in key else F.col(f"_x.{c}").alias(c) for c in batch.columns])
    return one.join(stored.select(*key).distinct(), list(key), "left_anti").select(*batch.columns)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of child whose key is not null and not in parent: broken references."""
    return child.where(F.col(child_key).isNotNull()).join(parent.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_anti").select(*child.columns)


def superseded_last(rows: DataFrame, ident: str, supersedes: str) -> DataFrame:
    """Rows that no other row supersedes."""
    return rows.join(rows.select(F.col(supersedes).alias(ident)).where(F.col(ident).isNotNull()).distinct(), ident, "left_anti").select(*rows.columns)


def cleaned(bars: DataFrame) -> DataFrame:
    """Bars with their symbols in comparable spelling."""
    return bars.withColumn("symbol", symbol_key("symbol"))

"""Attributes as known at event time, by dyadic time nodes.

A version's validity is a half-open interval of days. It is cut into the few dyadic nodes of fixed widths that cover it
exactly; an event looks up the nodes that enclose its day, one of each width, by an equi-join. So there is no range join
and no per-source list: rows are spread by (source, node), and a source that holds a third of all events is split by time.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintara.functions.common import ship, symbol_key

#: Widths of the nodes used, powers of two, each dividing the next. Fewer widths: fewer look-ups, more nodes per interval.
WIDTHS = (1, 16, 256)


def _day(c: Column) -> Column:
    return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("bigint")


def _upto(a: Column, b: Column) -> Column:
    return F.when(a < b, F.sequence(a, b - 1)).otherwise(F.array().cast("array<bigint>"))


def _id(level: int, levels: int):
    return lambda x: x * levels + level


def covering_nodes(lo: Column, hi: Column, widths: tuple[int, ...] = WIDTHS) -> Column:
    """Ids of the disjoint nodes whose union is [lo, hi); none if it is empty. lo, hi: days as bigint."""
    ends = [(F.ceil(lo / w), F.floor(hi / w)) for w in widths]
    found = []
    for j, (a, b) in enumerate(ends):
        part = _upto(a, b)
        if j + 1 < len(widths):
            ratio, (up_a, up_b) = widths[j + 1] // widths[j], ends[j + 1]
            part = F.when(up_a < up_b, F.concat(_upto(a, up_a * ratio), _upto(up_b * ratio, b))).otherwise(part)
        found.append(F.transform(part, _id(j, len(widths))))
    return F.concat(*found)


def enclosing_nodes(day: Column, widths: tuple[int, ...] = WIDTHS) -> Column:
    """Ids of the nodes that hold a day, one of each width."""
    return F.array(*[F.floor(day / w) * len(widths) + j for j, w in enumerate(widths)])


#: Micros after every instant.
_NEVER = (1 << 63) - 1


def known_steps(versions: DataFrame) -> DataFrame:
    """(kind, s, x, id, val, d1, d2, t1, t2): for days in [d1, d2) and observers at [t1, t2), in micros, this version is in
    force among those observed by then. d2 is null while open. versions: kind, s, x, vt, id, val.

    Versions are taken up in order of precedence. On a day a new one holds for all who observe it, so it takes the place of
    what was known from its observation on: of the steps known then those that begin later end, one is cut short. So there
    are at most two steps a version, and the steps of a day never overlap. A source is streamed, sorted; only the steps of
    the present day are held.
    """
    ship(versions.sparkSession)
    kinds = {f.name: f.dataType for f in versions.schema}
    names = ["kind", "s", "x", "id", "val"]
    out = T.StructType([T.StructField(n, kinds[n]) for n in names] + [T.StructField(n, T.LongType()) for n in ("d1", "d2", "t1", "t2")])

    def run(batches):
        now, open_, done, types = None, [], [], None

        def told():
            rows = [[r[c] for r in done] for c in range(9)]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, [*types, *[pa.int64()] * 4])], names=out.names)

        for b in batches:
            types = [b.schema.field(n).type for n in names]
            for *row, day, t in zip(*(b.column(n).to_pylist() for n in (*names, "d", "t"))):
                if row[:2] != now:
                    done += [(*v, d1, None, t1, t2) for v, d1, t1, t2 in open_]
                    now, open_ = row[:2], []
                cut = _NEVER
                while open_ and open_[-1][2] >= t:
                    v, d1, cut, t2 = open_.pop()
                    if d1 < day:
                        done.append((*v, d1, day, cut, t2))
                if open_ and open_[-1][3] != t:
                    v, d1, t1, t2 = open_.pop()
                    if d1 < day:
                        done.append((*v, d1, day, t1, t2))
                    open_.append((v, day, t1, t))
                open_.append((row, day, t, _NEVER))
            yield told()
        if open_:
            done += [(*v, d1, None, t1, t2) for v, d1, t1, t2 in open_]
            yield told()

    line = versions.where("vt is not null").repartition("kind", "s").sortWithinPartitions("kind", "s", "x", "vt", "id", "val")
    return line.select(*names, _day(F.col("x")).alias("d"), F.unix_micros("vt").alias("t")).mapInArrow(run, out)


def known_versions(events: DataFrame, versions: DataFrame, source: str = "symbol", event_time: str = "event_date", observed: str = "observation_time", kind: str = "action", valid_from: str = "ex_date", ident: str = "source_artifact_id", value: str = "value") -> DataFrame:
    """For each distinct (source, event_time, observed) of the events and each kind with a version in force: the version
    in force among all, and that among those observed no later than the event's own observation.

    In force: the latest valid_from on or before the event's day, then the latest observation (null: before any), then
    the greater ident, then the greater value. Columns: s, d, t, kind, known_id, known_value, known_from, true_id,
    true_value; the known ones are null where no version was known. Events without source, time or observation are left
    out, as are versions without source, valid_from or value; a version never observed is never known. Repeated versions
    and events count once. Empty tables give no rows. Other columns are not read.
    """
    ev = events.select(symbol_key(F.col(source).cast("string")).alias("s"), F.col(event_time).cast("date").alias("d"), F.col(observed).cast("timestamp").alias("t")).dropna()
    vs = versions.select(F.col(kind).alias("kind"), symbol_key(F.col(source).cast("string")).alias("s"), F.col(valid_from).cast("date").alias("x"), F.col(observed).cast("timestamp").alias("vt"), F.col(ident).cast("string").alias("id"), F.col(value).alias("val"))
    vs = vs.dropna(subset=["kind", "s", "x", "val"]).distinct()
    last = ev.agg(F.max("d")).first()[0]  # open intervals end with the events
    ev = ev.distinct()
    end = _day(F.lit(last).cast("date")) + 1
    # The version in force among all: one interval for each (kind, source, valid_from), up to the next.
    line = Window.partitionBy("kind", "s").orderBy("x")
    true = vs.groupBy("kind", "s", "x").agg(F.max(F.struct("vt", "id", "val")).alias("v")).select("kind", "s", "x", "v.*", F.lead("x").over(line).alias("until"))
    true = true.select("kind", "s", "x", "vt", "id", "val", F.explode(covering_nodes(_day(F.col("x")), F.least(F.coalesce(_day(F.col("until")), end), end))).alias("node"))
    hits = ev.select("s", "d", "t", F.explode(enclosing_nodes(_day(F.col("d")))).alias("node")).join(true, ["s", "node"]).drop("node")
    names = {"id": "known_id", "val": "known_value", "x": "known_from"}
    on_time = hits.where("vt <= t").select("s", "d", "t", "kind", *[F.col(k).alias(n) for k, n in names.items()], F.col("id").alias("true_id"), F.col("val").alias("true_value"))
    late = hits.where("vt is null or vt > t").select("s", "d", "t", "kind", F.col("id").alias("true_id"), F.col("val").alias("true_value"))
    # Where that one was not yet known, an earlier one may have been. Steps of one node hold on all its days, so they do not
    # overlap, and each event meets in each of its nodes the one that began last before its observation, in their order,
    # never all of them.
    steps = known_steps(vs).select("kind", "s", F.col("t1").alias("m"), F.struct("x", "id", "val", "t2").alias("step"), F.explode(covering_nodes(F.col("d1"), F.least(F.coalesce("d2", end), end))).alias("node"))
    ask = late.select("*", F.unix_micros("t").alias("m"), F.explode(enclosing_nodes(_day(F.col("d")))).alias("node"))
    begun = Window.partitionBy("kind", "s", "node").orderBy("m", F.col("d").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    met = steps.unionByName(ask, allowMissingColumns=True).withColumn("w", F.last("step", ignorenulls=True).over(begun)).where("d is not null")
    found = met.groupBy("s", "d", "t", "kind", "true_id", "true_value").agg(F.max(F.when(F.col("m") < F.col("w.t2"), F.col("w"))).alias("w"))
    found = found.select("s", "d", "t", "kind", *[F.col(f"w.{k}").alias(n) for k, n in names.items()], "true_id", "true_value")
    return on_time.unionByName(found)


def attributes_as_known(events: DataFrame, versions: DataFrame, kinds: tuple[str, ...], source: str = "symbol", event_time: str = "event_date", observed: str = "observation_time", **names: str) -> DataFrame:
    """Every event, whole, with known_<kind> (value) and known_<kind>_id for each of kinds; null where none was known or
    the event lacks source, time or observation. No event is lost or repeated. Columns of the events with those names
    are replaced."""
    known = known_versions(events, versions, source, event_time, observed, **names)
    wide = known.groupBy("s", "d", "t").agg(*[x for k in kinds for x in (F.max(F.when(F.col("kind") == k, F.col("known_value"))).alias(f"known_{k}"), F.max(F.when(F.col("kind") == k, F.col("known_id"))).alias(f"known_{k}_id"))])
    new = [c for c in wide.columns if c not in ("s", "d", "t")]
    e = events.drop(*new)
    on = (symbol_key(e[source].cast("string")) == wide["s"]) & (e[event_time].cast("date") == wide["d"]) & (e[observed].cast("timestamp") == wide["t"])
    return e.join(wide, on, "left").select(*[e[c] for c in e.columns], *[wide[c] for c in new])

"""History of changing attributes, from snapshots compared by Merkle trees.

A snapshot has one row for each key. Keys fall into 2^bits leaf buckets by hash; a leaf's digest is made of its rows'
hashes, and each parent covers 2^FAN_BITS children, up to the root. Digests are built once for each snapshot and serve
both its comparisons. Consecutive snapshots are compared from the root down: below nodes that agree nothing is looked at,
and only rows of leaves that differ are compared by key, which gives the new versions. All pairs of consecutive snapshots
go down the tree together, so a plan has as many steps as the tree has levels, however many snapshots there are.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintara.functions.common import checkpointed, symbol_key

#: Bits of a bucket number by which a level of the tree is narrower than the one below, and rows aimed at in a leaf.
FAN_BITS, LEAF_ROWS = 4, 64


def tree_bits(rows: int) -> int:
    """Bits of a leaf's number for a table of so many rows, a multiple of FAN_BITS, at most 28."""
    return min(28, FAN_BITS * max(1, math.ceil(math.log2(max(2, rows / LEAF_ROWS)) / FAN_BITS)))


def _hashes(*values: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes. xxhash64 skips nulls, so each value goes with whether it is one."""
    told = [x for v in values for x in (v.isNull(), v)]
    return F.xxhash64(*told), F.xxhash64(F.lit(1), *told)


def digest_levels(rows: DataFrame, bits: int) -> DataFrame:
    """(v, next, level, node, n, p, q): every node of every snapshot's tree. rows: v (snapshot), next (the one after), k, x,
    leaf. n counts rows, p and q do not depend on their order; level 0 is the root."""
    p, q = _hashes(F.col("k"), F.col("x"))
    at = rows.withColumns({"p": p, "q": q}).groupBy("v", "next", F.col("leaf").alias("node")).agg(F.count(F.lit(1)).alias("n"), F.bit_xor("p").alias("p"), F.bit_xor("q").alias("q"))
    level, levels = bits // FAN_BITS, []
    while True:
        levels.append(at.select("v", "next", F.lit(level).alias("level"), "node", "n", "p", "q"))
        if not level:
            return reduce(DataFrame.unionByName, levels)
        p, q = _hashes(F.col("node"), F.col("n"), F.col("p"), F.col("q"))
        at = at.select("v", "next", F.shiftright("node", FAN_BITS).alias("node"), "n", p.alias("p"), q.alias("q")).groupBy("v", "next", "node").agg(F.sum("n").alias("n"), F.bit_xor("p").alias("p"), F.bit_xor("q").alias("q"))
        level -= 1


def _sides(rows: DataFrame) -> DataFrame:
    """Each row where its snapshot is the later of two (at = its own) and where it is the earlier (at = the next one)."""
    sides = F.array_compact(F.array(F.struct(F.col("v").alias("at"), F.lit(True).alias("later")), F.when(F.col("next").isNotNull(), F.struct(F.col("next").alias("at"), F.lit(False).alias("later")))))
    return rows.withColumn("_s", F.explode(sides)).select("*", "_s.*").drop("_s", "v", "next")


def differing_leaves(levels: DataFrame, bits: int) -> DataFrame:
    """(at, leaf): leaves in which snapshot `at` differs from the one before, found from the root down; the nodes compared
    on a level are only those below nodes that differ."""
    open_ = None
    for level in range(bits // FAN_BITS + 1):
        below = _sides(levels.where(F.col("level") == level))
        if open_ is not None:
            below = below.withColumn("up", F.shiftright("node", FAN_BITS)).join(open_.withColumnRenamed("node", "up"), ["at", "up"], "left_semi")
        digest = F.struct("n", "p", "q")
        open_ = below.groupBy("at", "node").agg(F.count(F.lit(1)).alias("sides"), F.min(digest).alias("a"), F.max(digest).alias("z")).where("sides = 1 or a <> z").select("at", "node")
    return open_.withColumnRenamed("node", "leaf")


def _differences(rows: DataFrame, bits: int) -> DataFrame:
    """(at, k, before, after) of keys that differ between a snapshot and the one before; null on the side that lacks it."""
    rows = checkpointed(rows.withColumn("leaf", F.shiftrightunsigned(F.xxhash64("k"), 64 - bits)))
    levels = checkpointed(digest_levels(rows, bits))
    held = _sides(rows).join(differing_leaves(levels, bits), ["at", "leaf"], "left_semi")
    side = {n: F.max(F.when(F.col("later") == b, F.col("x"))).alias(n) for n, b in (("before", False), ("after", True))}
    return held.groupBy("at", "k").agg(*side.values()).where("not (before <=> after)")


def _stacked(snapshots: list[tuple[object, DataFrame]], key: str, attributes: list[str]) -> DataFrame:
    times = [t for t, _ in snapshots]
    nexts = dict(zip(times, [*times[1:], None]))
    kind = snapshots[0][1].select(F.lit(times[0])).schema[0].dataType
    return reduce(DataFrame.unionByName, [d.select(F.lit(t).alias("v"), F.lit(nexts[t]).cast(kind).alias("next"), F.col(key).alias("k"), F.struct(*attributes).alias("x")) for t, d in snapshots])


def _single(rows: DataFrame) -> DataFrame:
    return rows.where("k is not null").groupBy("v", "next", "k").agg(F.max("x").alias("x"))


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, attributes: list[str], rows: int | None = None) -> DataFrame:
    """(key, before, after, change_kind) of keys whose attributes differ between two snapshots; structs, null if absent.

    Of repeated keys the greatest row counts; a null key is left out. Nulls equal nulls. Other columns are not read.
    rows: about how many a snapshot has, if known.
    """
    both = _single(_stacked([(0, before), (1, after)], key, attributes))
    diff = _differences(both, tree_bits(after.count() if rows is None else rows)).where("at = 1")
    kind = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").otherwise("changed")
    return diff.select(F.col("k").alias(key), "before", "after", kind.alias("change_kind"))


def history_of_snapshots(snapshots: DataFrame | list[tuple[object, DataFrame]], key: str, attributes: list[str], version: str = "version", rows: int | None = None) -> DataFrame:
    """(key, attributes, valid_from, valid_to) from full snapshots: one table whose column `version` orders them, or a list
    of (version, table) in any order, in which tables may be empty.

    A version is valid from the snapshot that first shows it until the one that shows another or none (half open;
    valid_to null while open). A key that comes back starts a new version. An empty list raises ValueError, an empty table
    gives no rows; an empty snapshot ends all versions. Of repeated keys the greatest row counts; null keys and versions
    are left out. rows: about how many a snapshot has, if known.
    """
    if isinstance(snapshots, list):
        if not snapshots:
            raise ValueError("no snapshots")
        stacked = _stacked(sorted(snapshots, key=lambda x: x[0]), key, attributes)
    else:
        given = snapshots.select(F.col(version).alias("v"), F.col(key).alias("k"), F.struct(*attributes).alias("x")).where("v is not null")
        order = given.select("v").distinct().withColumn("next", F.lead("v").over(Window.orderBy("v")))  # as many rows as snapshots
        stacked = given.join(order, "v")
    if rows is None:
        rows = stacked.groupBy("v").count().agg(F.max("count")).first()[0] or 0
    diff = _differences(_single(stacked), tree_bits(rows))
    line = Window.partitionBy("k").orderBy("at")
    every = diff.select("k", "after", F.col("at").alias("valid_from"), F.lead("at").over(line).alias("valid_to")).where("after is not null")
    return every.select(F.col("k").alias(key), "after.*", "valid_from", "valid_to")


def _chains(entities: DataFrame, moves: DataFrame) -> DataFrame:
    """(k, r, name, since, until): the r-th name of every entity, r = 0 the first. entities: k, name, since, until; moves:
    o, n, d, unique by (o, n).

    Which move follows a move (or an entity's start) is read off one line of arrivals and departures for each name. Chains
    are then doubled: links over 2^j moves take those of r to r + 2^j, so rounds are the logarithm of the longest chain.
    """
    arrive = moves.select(F.col("n").alias("s"), "d", "o", F.lit(None).cast(entities.schema["k"].dataType).alias("k"), F.lit(None).cast("date").alias("until"))
    start = entities.where("name is not null and since is not null").select(F.col("name").alias("s"), F.col("since").alias("d"), F.lit(None).cast("string").alias("o"), "k", "until")
    leave = moves.select(F.col("o").alias("s"), "d", F.struct("d", "n").alias("to"))
    line = Window.partitionBy("s").orderBy(F.desc("d"), F.col("to").isNotNull(), F.desc("to.n"))  # a move of the same day comes too early
    links = arrive.unionByName(start).unionByName(leave, allowMissingColumns=True).withColumn("then", F.last("to", ignorenulls=True).over(line))
    links = checkpointed(links.where("to is null and then is not null and (until is null or then.d < until)").select("k", "until", "o", "s", F.col("then.n").alias("n"), F.col("then.d").alias("d")))
    chain = links.where("k is not null").select("k", F.lit(1).alias("r"), "s", "n", "d", "until")
    jump = links.where("k is null").select(F.col("o").alias("o1"), F.col("s").alias("s1"), F.col("s").alias("s2"), F.col("n").alias("n2"), F.col("d").alias("d2"))  # (o1, s1) is a move
    step = 1
    while True:
        more = chain.join(jump, (F.col("s") == F.col("o1")) & (F.col("n") == F.col("s1"))).where("until is null or d2 < until").select("k", (F.col("r") + step).alias("r"), F.col("s2").alias("s"), F.col("n2").alias("n"), F.col("d2").alias("d"), "until")
        more = checkpointed(more)
        if more.isEmpty():
            break
        chain = chain.unionByName(more)
        far = jump.select(*[F.col(c).alias(f"f_{c}") for c in jump.columns])
        jump = checkpointed(jump.join(far, (F.col("s2") == F.col("f_o1")) & (F.col("n2") == F.col("f_s1"))).select("o1", "s1", F.col("f_s2").alias("s2"), F.col("f_n2").alias("n2"), F.col("f_d2").alias("d2")))
        step *= 2
    return entities.select("k", F.lit(0).alias("r"), "name", "since", "until").unionByName(chain.select("k", "r", F.col("n").alias("name"), F.col("d").alias("since"), "until"))


def renamed_periods(entities: DataFrame, changes: DataFrame, entity: str = "listing_id", name: str = "symbol", start: str = "listed_on", end: str = "delisted_on", old: str = "old_symbol", new: str = "new_symbol", effective: str = "effective_date", observed: str = "observation_time") -> DataFrame:
    """(entity, name, valid_from, valid_to) of every name that every entity had; valid_to null while open.

    Reports without old, new or effective date, or with both names equal, are left out; reports of one (old, new) are one
    change, dated by the latest observed (null observation: before any; ties: the latest date). A change applies to the
    entity that holds the old name the day before; several of one old name and date: the least new name. An entity without
    a start or without a name keeps what it has. Of repeated entities the greatest row counts, null ones are left out.
    Empty tables: as many periods as entities.

    Reports become full snapshots: every entity as it stands after r changes of its own, r = 0, 1, ... up to the longest
    chain. The history is that of these snapshots.
    """
    pair = changes.select(symbol_key(F.col(old)).alias("o"), symbol_key(F.col(new)).alias("n"), F.col(effective).cast("date").alias("d"), F.col(observed).alias("t")).where("o is not null and n is not null and d is not null and o <> n")
    moves = checkpointed(pair.groupBy("o", "n").agg(F.max(F.struct("t", "d")).alias("x")).select("o", "n", F.col("x.d").alias("d")))
    now = entities.select(F.col(entity).alias("k"), F.struct(F.col(start).cast("date").alias("since"), symbol_key(F.col(name)).alias("name"), F.col(end).cast("date").alias("until")).alias("x"))
    now = checkpointed(now.where("k is not null").groupBy("k").agg(F.max("x").alias("x")).select("k", "x.name", "x.since", "x.until"))
    states = checkpointed(_chains(now, moves))
    count, last = states.agg(F.count_if(F.col("r") == 0), F.coalesce(F.max("r"), F.lit(0))).first()
    stays = F.when(F.lead("r").over(Window.partitionBy("k").orderBy("r")).isNull(), F.lit(last)).otherwise(F.col("r"))  # after its last change an entity stays in all later snapshots
    snapshots = states.withColumn("last", stays).withColumn("version", F.explode(F.sequence("r", "last")))
    history = history_of_snapshots(snapshots, "k", ["name", "since", "until"], rows=count)
    to = F.coalesce(F.lead("since").over(Window.partitionBy("k").orderBy("valid_from")), F.col("until"))
    return history.select(F.col("k").alias(entity), F.col("name").alias(name), F.col("since").alias("valid_from"), to.alias("valid_to"))

"""Implausible readings: impossible values, spikes that return, stuck values.

Every reading is held against its own source's behaviour:

* plausibility: bounds that no reading can break;
* spikes: the residual of the logarithm from the source's level on the sessions before and after, a volume's less the
  source's weekday effect, against a peaks-over-threshold cutoff. Residuals are measured in the source's own scale, its 90 %
  quantile. How the tail goes on from there is fitted to the exceedances of all sources together, since one source has too
  few: a generalised Pareto distribution over the 98 % quantile, by its moments, from which what lies beyond the cutoff
  itself is left out, so that spikes do not widen it. The cutoff is the fit's quantile at a fixed risk, times the scale;
* stuck values: runs of equal values over consecutive dates of the source.

Data flow: records are reduced to distinct readings of (source, date) before anything is gathered by source, so that a
source polled over and over costs one row for each distinct version of a date; within a source Spark sorts and spills.
Nothing is collected per source but at most 2 * reach values around a date. The fit sees rows above their source's 90 %
quantile only, and sends a few sums to the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintara.functions.common import checkpointed, symbol_key


@dataclass(frozen=True)
class SpikeRule:
    """few: sessions within which an excursion that is a spike has returned; the level on either side is the median of
    2 * few - 1 sessions, the least that such an excursion cannot move. risk: of a reading, by the tail fit; alone_risk:
    for a price whose range within the day shows nothing. tail: share of readings the tail is fitted to. stuck: dates that
    a value must keep. prior: readings that the scale of all sources counts for in a source's own."""

    few: int = 7
    risk: float = 1e-5
    alone_risk: float = 1e-8
    tail: float = 0.02
    stuck: int = 4
    prior: int = 20

    @property
    def reach(self) -> int:
        return 2 * self.few - 1


def _median(values: Column) -> Column:
    n, s = F.size(values), F.sort_array(values)
    return F.when(n > 0, (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2)


def _nearer(x: Column, before: Column, after: Column) -> Column:
    """The deviation that holds against both levels: 0 if they lie on different sides, as at a move of level."""
    a, b = x - before, x - after
    both = F.when(F.signum(a) != F.signum(b), 0.0).when(F.abs(a) < F.abs(b), a).otherwise(b)
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(both)


def pareto(mean: float, spread: float, n: int) -> tuple[float, float]:
    """(scale, shape) of the generalised Pareto distribution whose n excesses have this mean and standard deviation. The
    shape is taken two standard errors nearer to 0, and a bounded tail not on trust: few excesses suggest one too easily."""
    shape = 0.0 if not spread else min(max((1 - (mean / spread) ** 2) / 2 - 2 / math.sqrt(n), 0.0), 0.45)
    return mean * (1 - shape), shape


def pot_cutoff(threshold: float, share: float, scale: float, shape: float, risk: float) -> float:
    """The value exceeded with probability risk, if share of all values exceed threshold."""
    times = max(share / risk, 1.0)
    return threshold + scale * (math.log(times) if shape < 1e-6 else (times**shape - 1) / shape)


TAILS = ("h", "l", "v", "wh", "wl")


def fit_tails(held: DataFrame, rule: SpikeRule) -> dict[str, dict[float, float]]:
    """Of each tail the cutoffs at risk and alone_risk, and at share 1 where it begins, in units of the sources' scales. held: the readings over their
    source's scale in any tail, z_<tail> (null where the reading does not count), and n_<tail> in one row of each source."""
    over = {k: F.when(F.col(f"z_{k}") > 1, F.col(f"z_{k}")) for k in TAILS}
    counts = held.agg(*[x for k in TAILS for x in (F.sum(f"n_{k}").alias(f"n_{k}"), F.count(over[k]).alias(f"m_{k}"))]).first()
    share, levels = {}, {}
    for k in TAILS:
        n, m = counts[f"n_{k}"] or 0, counts[f"m_{k}"]
        share[k] = min(rule.tail, m / n) if n else 0.0
        levels[k] = [1 - share[k] * n * part / m for part in (1, 0.5)] if m else [0.0, 0.0]
    q = held.agg(*[F.percentile_approx(over[k], F.array(*[F.lit(x) for x in levels[k]]), 10_000).alias(k) for k in TAILS]).first()
    fits = {k: (q[k][0], (q[k][1] - q[k][0]) / math.log(2), 0.0) for k in TAILS if q[k]}
    for shaped in (False, True):  # first the scale alone, so that no spike lies within the cutoff when the shape is judged
        inside = {k: F.when((over[k] > u) & (over[k] <= pot_cutoff(u, share[k], scale, shape, rule.risk)), over[k] - u) for k, (u, scale, shape) in fits.items()}
        if not inside:
            break
        got = held.agg(*[x for k, e in inside.items() for x in (F.avg(e).alias(f"a_{k}"), F.stddev_pop(e).alias(f"s_{k}"), F.count(e).alias(f"m_{k}"))]).first()
        fits = {k: (u, *pareto(got[f"a_{k}"], shaped and got[f"s_{k}"], got[f"m_{k}"])) if got[f"a_{k}"] else (u, scale, shape) for k, (u, scale, shape) in fits.items()}
    none = {rule.risk: math.inf, rule.alone_risk: math.inf, 1.0: math.inf}
    return {k: {r: pot_cutoff(fits[k][0], share[k], *fits[k][1:], r) for r in none} if k in fits else none for k in TAILS}


def implausible_readings(
    records: DataFrame, source: str = "symbol", time: str = "event_date", observed: str = "observation_time", ident: str = "source_artifact_id",
    open_: str = "open", high: str = "high", low: str = "low", close: str = "close", volume: str = "volume", rule: SpikeRule = SpikeRule(),
) -> DataFrame:
    """One row for each implausible (source, time, ident) with its reasons; columns source, time, ident, reasons.

    Null source, time or blank source: not judged. A null in one of the values: only what needs it is not judged. A null
    ident comes out as null. Repeated records count once. Records of one date that differ are judged apart, each against
    the other dates; the date's own level is its latest observed possible reading (ties: the greater values). An empty
    table gives none. Other columns are not read, so their names cannot clash.
    """
    base = records.select(
        symbol_key(F.col(source).cast("string")).alias("s"), F.col(time).cast("date").alias("d"), F.col(open_).alias("o"), F.col(high).alias("h"), F.col(low).alias("l"),
        F.col(close).alias("c"), F.col(volume).alias("v"), F.col(observed).alias("t"), F.col(ident).cast("string").alias("id"),
    ).where("s is not null and d is not null")
    key = ["s", "d", "o", "h", "l", "c", "v"]
    readings = base.groupBy(*key).agg(F.max("t").alias("t"))
    # Written out, since the optimizer would otherwise carry the rules' expressions through the join's constraints.
    held = _scaled(checkpointed(_judged(readings, rule), constraints=False), rule)
    counts = F.col("rep") & ~F.col("bad") & ~F.col("stuck_hl") & ~F.col("stuck_vv")  # what other rules tell is no tail
    counted = held.withColumns({f"z_{k}": F.when(counts, F.col(f"z_{k}")) for k in TAILS})
    flagged = checkpointed(_reasons(held, fit_tails(counted, rule), rule).select(*[F.col(k).alias(f"f_{k}") for k in key], "reasons"), constraints=False)
    same = [F.col(k).eqNullSafe(F.col(f"f_{k}")) if k not in "sd" else F.col(k) == F.col(f"f_{k}") for k in key]
    hit = base.join(flagged, on=same)
    return hit.groupBy(F.col("s").alias(source), F.col("d").alias(time), F.col("id").alias(ident)).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("reasons")))).alias("reasons"))


def _judged(readings: DataFrame, rule: SpikeRule) -> DataFrame:
    """Readings with what the rules need: those that are impossible, stuck or over their source's scale in any tail, and one
    of each source, which has the source's counts."""
    c = F.col
    body_top, body_low = F.greatest("o", "c"), F.least("o", "c")
    impossible = (c("h") <= 0) | (c("l") <= 0) | (c("l") > c("h")) | (c("h") < body_top) | (c("l") > body_low) | (c("v") < 0)
    by_source = Window.partitionBy("s")
    r = readings.withColumn("bad", F.coalesce(impossible, F.lit(False)))
    r = r.withColumn("i", F.dense_rank().over(by_source.orderBy("d")))
    # A value stays the same over consecutive dates: its dates' ranks less their number in order are equal in a run. Rows are
    # narrow here, and what is sorted anew later is not.
    for name, held in (("hl", ["h", "l"]), ("vv", ["v"])):
        same = ["s", *held]
        r = r.withColumn("g", c("i") - F.dense_rank().over(Window.partitionBy(*same).orderBy("i")))
        run = Window.partitionBy(*same, "g")
        known = F.lit(True)
        for k in held:
            known = known & c(k).isNotNull()
        r = r.withColumn(f"stuck_{name}", known & (F.max("i").over(run) - F.min("i").over(run) + 1 >= rule.stuck) & (c("i") > F.min("i").over(run))).drop("g")
    r = r.withColumn("rep", F.row_number().over(Window.partitionBy("s", "d").orderBy("bad", c("t").desc_nulls_last(), *[c(k).desc_nulls_last() for k in "chlov"])) == 1).drop("t")
    # Prices are held against one level, that between high and low. A volume of 0 is judged as any other, from a finite
    # place below 1.
    level = {"p": F.when((c("h") > 0) & (c("l") > 0), F.ln(((c("h") + c("l")) / 2).cast("double"))), "v": F.when(c("v") >= 0, F.ln(F.greatest(c("v").cast("double"), F.lit(0.5))))}
    # The level on either side: the median of the dates' own readings; ranges are over dates, not rows.
    around = by_source.orderBy("i")
    each = F.struct(*[F.when(c("rep") & ~c("bad"), x).alias(k) for k, x in level.items()])
    r = r.withColumns({side: F.collect_list(each).over(around.rangeBetween(*span)) for side, span in (("a", (-rule.reach, -1)), ("z", (1, rule.reach)))})
    r = r.withColumns({f"{side}_{k}": _median(F.array_compact(c(side)[k])) for side in "az" for k in level}).drop("a", "z")
    x = {"h": F.when(c("h") > 0, F.ln(c("h").cast("double"))), "l": F.when(c("l") > 0, F.ln(c("l").cast("double"))), "v": level["v"]}
    r = r.withColumns({f"r_{k}": _nearer(x[k], c(f"a_{side}"), c(f"z_{side}")) for k, side in (("h", "p"), ("l", "p"), ("v", "v"))} | {"sided": c("a_p").isNotNull() & c("z_p").isNotNull(), "dow": F.weekday("d") + 1})
    r = r.drop("a_p", "z_p", "a_v", "z_v")
    # The source's weekday effect on volume, from residuals held within the usual, shrunk where it has few.
    mine = F.when(c("rep") & ~c("bad"), F.least(F.greatest(c("r_v"), F.lit(-1.0)), F.lit(1.0)))
    of_day = [F.when(c("dow") == w, mine) for w in range(1, 8)]
    r = r.withColumn("e", F.array(*[F.sum(y).over(by_source) / (F.count(y).over(by_source) + 20) for y in of_day]))
    r = r.withColumn("r_v", c("r_v") - F.when(c("r_v") != 0, F.coalesce(F.get("e", c("dow") - 1), F.lit(0.0))).otherwise(0.0)).drop("e", "dow")
    wick = {k: F.when(body, F.ln(hi.cast("double")) - F.ln(lo.cast("double"))) for k, body, hi, lo in (("wh", (body_top > 0) & (c("h") > 0), c("h"), body_top), ("wl", (body_low > 0) & (c("l") > 0), body_low, c("l")))}
    r = r.withColumns({f"t_{k}": y for k, y in ({k: F.abs(f"r_{k}") for k in "hlv"} | wick).items()})
    fit = {k: F.when(c("rep") & ~c("bad"), c(f"t_{k}")) for k in TAILS}
    r = r.withColumns({f"q_{k}": F.percentile_approx(y, F.lit(0.9), 1000).over(by_source) for k, y in fit.items()} | {f"c_{k}": F.count(y).over(by_source) for k, y in fit.items()})
    one = c("rep") & (c("i") == 1)
    r = r.withColumns({f"n_{k}": F.when(one, c(f"c_{k}")) for k in TAILS})
    large = one | c("bad") | c("stuck_hl") | c("stuck_vv")
    for k in TAILS:
        large = large | F.coalesce(c(f"t_{k}") > c(f"q_{k}"), F.lit(False))
    return r.where(large).select("s", "d", "o", "h", "l", "c", "v", "rep", "bad", "sided", "stuck_hl", "stuck_vv", "r_h", "r_l", *[f"{x}_{k}" for k in TAILS for x in "tqcn"])


def _scaled(held: DataFrame, rule: SpikeRule) -> DataFrame:
    """z_<tail>: each tail in its source's scale; a source of few readings has the usual scale of all mixed in."""
    usual = held.agg(*[(F.sum(F.col(f"n_{k}") * F.col(f"q_{k}")) / F.sum(f"n_{k}")).alias(k) for k in TAILS]).first()
    scale = {k: (F.col(f"q_{k}") * F.col(f"c_{k}") + (usual[k] or 0.0) * rule.prior) / (F.col(f"c_{k}") + rule.prior) for k in TAILS}
    return held.withColumns({f"z_{k}": F.col(f"t_{k}") / F.nullif(scale[k], F.lit(0.0)) for k in TAILS})


def _reasons(held: DataFrame, cut: dict[str, dict[float, float]], rule: SpikeRule) -> DataFrame:
    c = F.col
    over = lambda k, risk: c(f"z_{k}") > cut[k][risk]
    # The range within the day and the level must both be in their tails; without open or close the former says less.
    level = {k: F.when(c("o").isNotNull() & c("c").isNotNull(), over(k, 1.0)).otherwise(over(k, rule.risk)) for k in "hl"}
    spike = {k: (up & level[k] & over(f"w{k}", rule.risk)) | (c("sided") & over(k, rule.alone_risk)) for k, up in (("h", c("r_h") > 0), ("l", c("r_l") < 0))}
    named = (("impossible", c("bad")), ("high_spike", spike["h"]), ("low_spike", spike["l"]), ("volume_spike", over("v", rule.risk)), ("stuck_range", c("stuck_hl")), ("stuck_volume", c("stuck_vv")))
    return held.withColumn("reasons", F.array_compact(F.array(*[F.when(x, F.lit(n)) for n, x in named]))).where(F.size("reasons") > 0)

"""The operators of the general problems on small hand-made tables: nulls, ties, repeats, empty tables, odd columns."""

import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vintara.operators import asknown, grid, history, rolling, snapshots, spikes
from vintara.schema import BAR

D = dt.date
AT = dt.datetime(2023, 6, 1, 12)


def bar(symbol, day, price=10.0, volume=1000, at=AT, art="a", **over):
    p = {k: Decimal(str(round(price * f, 6))) for k, f in (("open", 1), ("high", 1.01), ("low", 0.99), ("close", 1.001))} | over
    return (symbol, day, p["open"], p["high"], p["low"], p["close"], volume, "v", at, art)


def bars(spark, rows):
    return spark.createDataFrame(rows, BAR)


def days(n, start=D(2023, 1, 2)):
    return [start + dt.timedelta(k) for k in range(n)]


def walk(symbol, n, seed, jump=None):
    r, out, p = random.Random(seed), [], 50.0
    for k, d in enumerate(days(n)):
        p *= math.exp(r.gauss(0, 0.01))
        if jump == k:
            p /= 4
        o, c = p, p * math.exp(r.gauss(0, 0.005))
        hi, lo = max(o, c) * math.exp(abs(r.gauss(0, 0.004))), min(o, c) * math.exp(-abs(r.gauss(0, 0.004)))
        q = lambda x: Decimal(str(round(x, 4)))
        out.append([symbol, d, q(o), q(hi), q(lo), q(c), int(1e6 * math.exp(r.gauss(0, 0.3))), "v", AT, f"{symbol}{k}"])
    return out


def test_spikes_stand_out_and_levels_do_not(spark):
    a, b = walk("AAA", 200, 1), walk(" bbb ", 200, 2, jump=100)
    a[50][3] = Decimal(100) * a[50][3]
    a[80][4] = a[80][4] / 3
    a[80][4] = a[80][4].quantize(Decimal("1e-6"))
    a[120][6] *= 300
    a[121][6] *= 5  # a lively day
    b[30][6] = -5
    b[31][4] = Decimal(0)
    for k in range(60, 65):
        b[k][6] = 777
    again = list(a[50])  # the same bad reading again, and its correction
    fixed = list(walk("AAA", 200, 1)[50])
    fixed[-1] = "fix"
    null = [None, *a[3][1:]], [a[3][0], None, *a[3][2:]], ["CCC", *[None] * 8, "x"]
    df = bars(spark, [tuple(x) for x in [*a, *b, again, fixed, *null]]).withColumn("s", F.lit(1)).withColumn("reasons", F.lit("clash"))
    got = {(r.symbol, r.source_artifact_id): r.reasons for r in spikes.implausible_readings(df).collect()}
    want = {("AAA", "AAA50"): ["high_spike"], ("AAA", "AAA80"): ["low_spike"], ("AAA", "AAA120"): ["volume_spike"], ("BBB", " bbb 30"): ["impossible"], ("BBB", " bbb 31"): ["impossible"]}
    want |= {("BBB", f" bbb {k}"): ["stuck_volume"] for k in range(61, 65)}
    want |= {("BBB", " bbb 60"): ["volume_spike"]}  # the first of five sessions far below all others
    for k, v in want.items():
        assert {*v} <= {*got.pop(k, [])}, k
    assert got == {}, got


def test_a_volume_of_zero_among_normal_ones(spark):
    a, b = walk("AAA", 200, 3), walk("BBB", 200, 4)
    a[90][6] = 0
    for k in range(200):  # hardly traded: 0 on all days but every third, where it is a little
        b[k][6] = 0 if k % 3 else 1 + k % 2
    got = {(r.symbol, r.source_artifact_id): r.reasons for r in spikes.implausible_readings(bars(spark, [tuple(x) for x in [*a, *b]])).collect()}
    assert got == {("AAA", "AAA90"): ["volume_spike"]}, got


def test_spikes_of_nothing(spark):
    assert spikes.implausible_readings(bars(spark, [])).count() == 0
    assert spikes.implausible_readings(bars(spark, [bar("A", D(2023, 1, 2))])).count() == 0


def test_fit_of_known_tails():
    r = random.Random(2)
    for shape in (0.0, 0.3):
        values = sorted(r.expovariate(1) if not shape else (r.random() ** -shape - 1) / shape for _ in range(200_000))
        u = values[int(0.98 * len(values))]
        over = [x - u for x in values if x > u]
        mean = sum(over) / len(over)
        scale, got = spikes.pareto(mean, (sum((x - mean) ** 2 for x in over) / len(over)) ** 0.5, len(over))
        true = -math.log(1e-4) if not shape else (1e-4**-shape - 1) / shape
        assert abs(spikes.pot_cutoff(u, 0.02, scale, got, 1e-4) / true - 1) < 0.12, (shape, got)
    assert spikes.pot_cutoff(2.0, 0.001, 1.0, 0.0, 0.01) == 2.0


def test_an_excursion_of_several_sessions(spark):
    a, b = walk("AAA", 300, 5), walk("BBB", 300, 6)
    for k in range(100, 106):
        a[k][6] *= 1000  # six sessions in another unit
    for k in range(100, 300):
        b[k][6] *= 1000  # for good
    got = {r.source_artifact_id for r in spikes.implausible_readings(bars(spark, [tuple(x) for x in [*a, *b]])).collect()}
    assert got == {f"AAA{k}" for k in range(100, 106)}


def test_grid(spark):
    ds = days(10)
    rows = [bar("a", ds[0], art="1"), bar(" A", ds[0], price=11, at=AT + dt.timedelta(1), art="2"), bar("A", ds[9]), bar("A", None), bar(None, ds[3]), bar("A", ds[2], volume=None)]
    sess = spark.createDataFrame([(d,) for d in ds if d != ds[5]] + [(ds[1],), (None,)], "session date").withColumn("v_close", F.lit(0))
    out = grid.regular_grid(bars(spark, rows).withColumn("n", F.lit(9)), sess, max_gap=3).orderBy("session").collect()
    assert [r.session for r in out] == [d for d in ds if d != ds[5]]
    assert [r.status for r in out] == ["observed", "filled", "observed", "filled", "filled", "filled", "missing", "missing", "observed"]
    assert out[0].n_readings == 2 and float(out[1].close) == 11.011 and out[3].volume == 1000
    assert grid.regular_grid(bars(spark, []), sess).count() == 0
    assert grid.regular_grid(bars(spark, rows), sess.limit(0)).count() == 0


def test_covering_nodes_partition_the_interval(spark):
    r = random.Random(3)
    pairs = [(a := r.randint(-600, 20000), a + r.choice([-1, 0, 1, 15, 16, 17, 300, 5000])) for _ in range(60)]
    rows = spark.createDataFrame(pairs, "lo bigint, hi bigint").select("lo", "hi", asknown.covering_nodes(F.col("lo"), F.col("hi")).alias("n")).collect()
    for lo, hi, nodes in rows:
        covered = []
        for x in nodes:
            j, i = x % 3, x // 3
            covered += range(i * asknown.WIDTHS[j], (i + 1) * asknown.WIDTHS[j])
        assert sorted(covered) == list(range(lo, hi))
    some = spark.createDataFrame([(-1,), (0,), (257,)], "d bigint").select(asknown.enclosing_nodes(F.col("d"))).collect()
    assert [x[0] for x in some] == [[-3, -2, -1], [0, 1, 2], [257 * 3, 16 * 3 + 1, 1 * 3 + 2]]


def brute_known(events, versions):
    out = set()
    for s, d, t in {e for e in events if None not in e}:
        for k in {v[0] for v in versions}:
            inforce = [v for v in versions if v[0] == k and v[1] == s and None not in (v[2], v[5]) and v[2] <= d]
            if inforce:
                rank = lambda v: (v[2], v[3] is not None, v[3] or AT, v[4], v[5])
                known = [v for v in inforce if v[3] is not None and v[3] <= t]
                out.add((s, d, t, k, max(known, key=rank)[4] if known else None, max(inforce, key=rank)[4]))
    return out


def test_known_versions_against_brute_force(spark):
    r = random.Random(5)
    day = lambda: D(2021, 1, 1) + dt.timedelta(r.randint(0, 700))
    time = lambda: None if r.random() < 0.05 else dt.datetime(2020, 12, 1) + dt.timedelta(r.randint(0, 800), r.choice([0, 0, 3600]))
    versions = [(r.choice(["X", "Y"]), r.choice("AB"), None if r.random() < 0.03 else day(), time(), f"v{k:03}", None if r.random() < 0.05 else 1.0 * k) for k in range(80)]
    versions += versions[:10]
    versions += [(*versions[20][:4], "tie", 5.0)]
    events = [(r.choice(["A", "B", "C", None]), day() if r.random() > 0.03 else None, time()) for _ in range(400)]
    ev = spark.createDataFrame([(s and f" {s.lower()}", d, t, 7) for s, d, t in events], "symbol string, event_date date, observation_time timestamp, node int")
    vs = spark.createDataFrame(versions, "action string, symbol string, ex_date date, observation_time timestamp, source_artifact_id string, value double")
    got = asknown.known_versions(ev.unionByName(ev), vs).collect()
    assert len(got) == len({(g.s, g.d, g.t, g.kind) for g in got})
    assert {(g.s, g.d, g.t, g.kind, g.known_id, g.true_id) for g in got} == brute_known(events, versions)
    whole = asknown.attributes_as_known(ev, vs, ("X", "Y"))
    assert whole.count() == len(events) and whole.columns == [*ev.columns, "known_X", "known_X_id", "known_Y", "known_Y_id"]
    assert asknown.known_versions(ev.limit(0), vs).count() == 0 and asknown.known_versions(ev, vs.limit(0)).count() == 0


def test_many_early_events_and_versions_stay_linear(spark):
    """All versions are announced before all events, which are observed before their own days."""
    n_v, n_e, first = 10_000, 100_000, dt.datetime(2020, 1, 1)
    vs = spark.range(n_v).select(F.lit("X").alias("action"), F.lit("A").alias("symbol"), F.date_add(F.lit("2021-01-01").cast("date"), F.col("id").cast("int") % 3000).alias("ex_date"), (F.lit(first) + F.make_dt_interval(secs=F.col("id") * 7 % 9973)).alias("observation_time"), F.col("id").cast("string").alias("source_artifact_id"), F.lit(1.0).alias("value"))
    ev = spark.range(n_e).select(F.lit("A").alias("symbol"), F.date_add(F.lit("2021-01-01").cast("date"), F.col("id").cast("int") % 3000).alias("event_date"), (F.lit(first) + F.make_dt_interval(secs=F.col("id") % 10_000)).alias("observation_time"))
    steps = asknown.known_steps(vs.select(F.col("action").alias("kind"), F.col("symbol").alias("s"), F.col("ex_date").alias("x"), F.col("observation_time").alias("vt"), F.col("source_artifact_id").alias("id"), F.col("value").alias("val")))
    assert steps.count() <= 2 * n_v
    out = asknown.known_versions(ev, vs)
    assert out.count() == ev.distinct().count()
    some = out.where("hash(d, t) % 400 = 0").collect()
    versions = [tuple(v) for v in vs.collect()]
    assert {(g.d, g.t, g.known_id) for g in some} == {(d, t, k) for _, d, t, _, k, _ in brute_known([("A", g.d, g.t) for g in some], versions)} and len(some) > 50


def test_snapshot_changes(spark):
    rows = [("g", 1, "A", 1.0, None), ("g", 1, "A", 1.0, None), ("g", 1, "B", 2.0, 1), ("g", 3, "A", 1.0, 5), ("g", 3, "C", 2.0, 1), ("g", 4, "A", 1.0, 5), ("g", 4, "C", 2.0, 1), ("h", 2, "A", 0.0, 0), ("g", None, "Z", 0.0, 0), ("g", 3, None, 0.0, 0)]
    df = spark.createDataFrame(rows, "series string, version int, k string, x double, y int").withColumn("sign", F.lit(1))
    got = {(r.series, r.version, r.k, r.change_kind) for r in snapshots.snapshot_changes(df, "series", "version", ("k",), ("x", "y")).collect()}
    assert got == {("g", 3, "A", "changed"), ("g", 3, "B", "removed"), ("g", 3, "C", "added")}
    assert snapshots.snapshot_changes(df.limit(0), "series", "version", ("k",), ("x", "y")).count() == 0


def test_except_all_both(spark):
    a, b = spark.createDataFrame([(1,), (1,), (None,)], "x int"), spark.createDataFrame([(1,), (2,), (None,)], "x int")
    left, right = snapshots.except_all_both(a, b)
    assert [r.x for r in left.collect()] == [1] and [r.x for r in right.collect()] == [2]


def test_history_of_snapshots(spark):
    S = "k int, a string, b double"
    one, two, three = (spark.createDataFrame(x, S) for x in ([(1, "x", None), (2, "y", 1.0), (3, "z", 0.0), (3, "z", 0.0)], [(1, "x", 2.0), (2, "y", 1.0), (None, "n", 0.0)], [(1, "x", 2.0), (3, "z", 0.0)]))
    h = history.history_of_snapshots([(D(2023, 3, 1), three), (D(2023, 1, 1), one), (D(2023, 2, 1), two)], "k", ["a", "b"])
    got = {(r.k, r.a, r.b, r.valid_from.month, r.valid_to and r.valid_to.month) for r in h.collect()}
    assert got == {(1, "x", None, 1, 2), (1, "x", 2.0, 2, None), (2, "y", 1.0, 1, 3), (3, "z", 0.0, 1, 2), (3, "z", 0.0, 3, None)}
    stacked = one.withColumn("version", F.lit(1)).unionByName(two.withColumn("version", F.lit(2))).unionByName(three.withColumn("version", F.lit(3))).unionByName(one.withColumn("version", F.lit(None)))
    assert {(r.k, r.a, r.b, r.valid_from, r.valid_to) for r in history.history_of_snapshots(stacked, "k", ["a", "b"]).collect()} == got
    ended = history.history_of_snapshots([(1, one), (2, one.limit(0)), (3, three)], "k", ["a"]).collect()
    assert {(r.k, r.valid_from, r.valid_to) for r in ended} == {(1, 1, 2), (2, 1, 2), (3, 1, 2), (1, 3, None), (3, 3, None)}
    assert history.history_of_snapshots(stacked.limit(0), "k", ["a"]).count() == 0
    with pytest.raises(ValueError):
        history.history_of_snapshots([], "k", ["a"])


def test_rows_come_through_the_tree(spark, monkeypatch):
    """What lies in a leaf that the descent does not name is not found, and equal snapshots name no leaf."""
    a = spark.range(500).selectExpr("id as k", "0 as x", "1 as version")
    b = a.withColumn("version", F.lit(2)).withColumn("x", F.when(F.col("k") < 40, 1).otherwise(F.col("x")))
    whole = {(r.k, r.valid_from) for r in history.history_of_snapshots(a.unionByName(b), "k", ["x"]).collect()}
    assert whole == {(k, 1) for k in range(500)} | {(k, 2) for k in range(40)}
    seen = history.differing_leaves
    monkeypatch.setattr(history, "differing_leaves", lambda levels, bits: seen(levels, bits).where("leaf % 2 = 0"))
    part = {(r.k, r.valid_from) for r in history.history_of_snapshots(a.unionByName(b), "k", ["x"]).collect()}
    assert part < whole and 0 < len(part) < len(whole)


def test_merkle_diff_finds_every_change(spark):
    a = spark.range(3000).selectExpr("id as k", "id % 7 as x")
    b = a.withColumn("x", F.when(F.col("k").isin(5, 2999), 99).otherwise(F.col("x"))).where("k <> 77").unionByName(spark.createDataFrame([(5000, 1)], "k bigint, x bigint"))
    got = {(r.k, r.change_kind) for r in history.snapshot_diff(a, b, "k", ["x"]).collect()}
    assert got == {(5, "changed"), (2999, "changed"), (77, "removed"), (5000, "added")}
    assert history.snapshot_diff(a, a, "k", ["x"]).count() == 0


def test_renamed_periods(spark):
    L = spark.createDataFrame([(1, "a", D(2020, 1, 1), None), (2, "B ", D(2020, 1, 1), D(2020, 6, 1)), (3, "A", D(2020, 7, 1), None), (4, None, D(2020, 1, 1), None)], "listing_id bigint, symbol string, listed_on date, delisted_on date")
    t = lambda k: dt.datetime(2020, 1, k)
    C = [("A", "B", D(2020, 3, 1), t(1)), ("b", "a", D(2020, 3, 1), t(1)), ("A", "C", D(2020, 5, 1), t(1)), ("A", "C", D(2020, 6, 1), t(2)), ("A", "D", D(2020, 6, 1), t(3)), ("X", "Y", D(2020, 2, 1), t(1)), ("B", "B", D(2020, 4, 1), t(1)), (None, "Q", D(2020, 4, 1), t(1)), ("B", "E", D(2020, 8, 1), None)]
    ch = spark.createDataFrame(C, "old_symbol string, new_symbol string, effective_date date, observation_time timestamp").withColumn("k", F.lit(0))
    got = {(r.listing_id, r.symbol, str(r.valid_from), str(r.valid_to)) for r in history.renamed_periods(L, ch).collect()}
    assert got == {(1, "A", "2020-01-01", "2020-03-01"), (1, "B", "2020-03-01", "2020-08-01"), (1, "E", "2020-08-01", "None"), (2, "B", "2020-01-01", "2020-03-01"), (2, "A", "2020-03-01", "2020-06-01"), (3, "A", "2020-07-01", "None"), (4, None, "2020-01-01", "None")}
    assert history.renamed_periods(L.limit(0), ch).count() == 0 and history.renamed_periods(L, ch.limit(0)).count() == 4


def test_trailing_totals_against_brute_force(spark):
    r = random.Random(9)
    rows = [bar(r.choice(["A", "b", None]), r.choice(days(90)), price=r.choice([10, 20.5, 31]), volume=r.choice([None, 1, 5, 7]), at=AT + dt.timedelta(r.randint(0, 3)), art=str(k)) for k in range(70)]
    got = {(x.symbol, x.event_date): (x.total_7, x.avg_7, x.total_30, x.avg_30) for x in rolling.trailing_totals(bars(spark, rows).withColumn("k", F.lit(1))).collect()}
    best = {}
    for x in rows:
        if x[0] and x[1]:
            key, rank = (x[0].upper(), x[1]), (x[8], x[6] is not None, x[6] or 0, x[5])
            if key not in best or rank > best[key]:
                best[key] = rank
    want = {}
    for s in ("A", "B"):
        mine = {d: v for (z, d), v in best.items() if z == s}
        d = min(mine)
        while d <= max(mine):
            row = []
            for w in (7, 30):
                inside = [mine[e] for e in mine if d - dt.timedelta(w) < e <= d]
                v = [x[2] for x in inside if x[1]]
                c = [x[3] for x in inside]
                row += [sum(v) if v else None, float(sum(c)) / len(c) if c else None]
            want[s, d] = tuple(row)
            d += dt.timedelta(1)
    assert got == want
    assert rolling.trailing_totals(bars(spark, [])).count() == 0

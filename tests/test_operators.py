"""Schema, canonical JSON, rules, identity, gates on small tables."""

import datetime as dt
import hashlib
import json
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkTypeError
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintara import schema
from vintara.functions import canonical as C
from vintara.functions.common import strip
from vintara.operators import evidence, identity, manifests, validation

D, AT = dt.date, dt.datetime(2024, 4, 1, 12)


def bar(symbol="SPY", day=D(2024, 1, 2), o="10", h="11", low="9", c="10.5", v=1000, art="a" * 64, at=AT, source="v"):
    return (symbol, day, *[None if x is None else Decimal(x) for x in (o, h, low, c)], v, source, at, art)


def bars(spark, *rows):
    return schema.bars_frame(spark, list(rows))


def rules(df, **k):
    return sorted((r.rule_id, r.observed_value) for r in validation.findings(df, **k).collect())


def test_bars_are_built_strictly(spark):
    assert schema.schema_matches(bars(spark, bar(o="1.005")))
    for x in ("1.234567891", "10000000000", "NaN"):
        with pytest.raises(ValueError):
            bars(spark, bar(o=x))
    with pytest.raises(PySparkTypeError):
        schema.bars_frame(spark, [(*bar()[:2], 1.5, *bar()[3:])])


def test_bars_survive_parquet(spark, tmp_path):
    df = bars(spark, bar(o="123.4567", h="128.25"))
    df.write.parquet(str(tmp_path / "x"))
    back = spark.read.parquet(str(tmp_path / "x"))
    assert schema.schema_matches(back) and back.collect() == df.collect()


def test_rules(spark):
    assert rules(bars(spark, bar(), bar(day=D(2024, 1, 3)))) == []
    assert rules(bars(spark, bar(), bar(art="b"))) == [("MD003", "count=2")]
    assert rules(bars(spark, bar(), bar())) == [("MD003", "count=2"), ("MD007", "count=2")]
    assert rules(bars(spark, bar(h="5", low="4", c="6"))) == [("MD004", "o=10.00000000,h=5.00000000,l=4.00000000,c=6.00000000")]
    assert rules(bars(spark, bar(v=-1))) == [("MD005", "volume=-1")] and rules(bars(spark, bar(v=0))) == []
    # An unknown comparison is no finding unless another one is false.
    assert rules(bars(spark, bar(h=None))) == [("MD002", "high")]
    assert [r for r, _ in rules(bars(spark, bar(h=None, low="12")))] == ["MD002", "MD004"]
    assert rules(spark.createDataFrame([(1, 2)], "totally int, columns int")) == [("MD008", "totally,columns")]
    assert rules(bars(spark)) == []


def test_missing_sessions(spark):
    sess = spark.createDataFrame([(D(2024, 1, d),) for d in (2, 3, 4)], "session date")
    syms = spark.createDataFrame([("SPY",), ("XLE",), ("SPY",)], "symbol string")
    got = validation.findings(bars(spark, bar(), bar(day=D(2024, 1, 4)), bar(day=D(2024, 1, 6))), syms, sess)
    assert {(r.rule_id, r.symbol, str(r.event_date)) for r in got.collect()} == {("MD006", "SPY", "2024-01-03"), *[("MD006", "XLE", f"2024-01-0{d}") for d in (2, 3, 4)]}
    s = validation.summary(got).first()
    assert (s.passed, s.error_count, s.warning_count, s.total_findings) == (True, 0, 4, 4)
    both = validation.ordered(got.unionByName(validation.findings(bars(spark, bar(v=-1, h=None)))))
    assert [r.rule_id for r in both.collect()] == ["MD002", "MD005", *["MD006"] * 4]


def py_canonical(x):
    def go(v):
        if isinstance(v, Decimal):
            s = format(v.normalize(), "f")
            return s
        if isinstance(v, dt.datetime):
            return v.isoformat() + "Z"
        if isinstance(v, D):
            return v.isoformat()
        if isinstance(v, dict):
            return {k: go(y) for k, y in v.items()}
        return [go(y) for y in v] if isinstance(v, list) else v

    return json.dumps(go(x), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


KIND = T.StructType([T.StructField("z", T.StringType()), T.StructField("a", T.DecimalType(18, 8)), T.StructField("d", T.DateType()), T.StructField("t", T.TimestampType()), T.StructField("m", T.MapType(T.StringType(), T.LongType())), T.StructField("l", T.ArrayType(T.StringType())), T.StructField("b", T.BooleanType()), T.StructField("n", T.IntegerType())])


def test_canonical_json_is_that_of_python(spark):
    rows = [
        {"z": 'q"\\\n\t\x1f\x0b\x7f é€🙂/', "a": Decimal("1.00500000"), "d": D(2024, 1, 2), "t": AT, "m": {"b": 1, "a": 2}, "l": ["x", None], "b": True, "n": 5},
        {"z": "\\u001F \\\x1e", "a": Decimal("100"), "d": None, "t": dt.datetime(2024, 1, 1, 0, 0, 0, 5), "m": {}, "l": [], "b": None, "n": None},
        {"z": None, "a": Decimal("0"), "d": None, "t": None, "m": None, "l": None, "b": False, "n": -1},
    ]
    df = spark.createDataFrame([tuple(r[f.name] for f in KIND) for r in rows], KIND)
    got = [r[0] for r in df.select(C.canonical_json(F.struct("*"), KIND)).collect()]
    assert got == [py_canonical(r) for r in rows]
    with pytest.raises(TypeError):
        C.canonical_json(F.lit(1.0), T.DoubleType())


def test_scalars(spark):
    r = spark.createDataFrame([("  spy\t", "Yes", 1704153600000, Decimal("10.50000000"), "/a/b/")], "s string, f string, t bigint, x decimal(18,8), p string").select(
        strip("s"), C.truthy(F.col("f")), C.utc_day(F.col("t")), C.market_day(F.col("t")), C.plain_decimal(F.col("x")), C.path_join(F.lit("raw/"), F.col("p")), C.last_segment(F.btrim("p", F.lit("/"))), C.day_millis(C.utc_day(F.col("t"))), C.truthy(F.lit(None).cast("string")), C.symbols_of(F.array(F.lit(" b"), F.lit("A "), F.lit("a"))), C.logical_key(*map(F.lit, "abcd"))
    ).first()
    assert tuple(r) == ("spy", True, D(2024, 1, 2), D(2024, 1, 1), "10.5", "raw/a/b", "B", 1704153600000, True, ["A", "B"], "a|b|c|d")


def py_hash(rows):
    obs = [dict(zip(schema.COLUMNS, r)) for r in rows]
    obs = [{k: o[k] for k in schema.ECONOMIC} for o in obs]
    return hashlib.sha256(py_canonical(sorted(obs, key=lambda o: (o["symbol"], o["event_date"].isoformat(), py_canonical(o)))).encode()).hexdigest()


def test_logical_hash_is_of_content_alone(spark):
    rows = [bar(), bar("XLE", D(2024, 1, 3), v=7), bar(day=D(2024, 1, 9), o="10.10")]
    a = bars(spark, *rows)
    b = bars(spark, *[(*r[:7], "other", dt.datetime(2030, 1, 1), "z") for r in reversed(rows)]).repartition(3)
    (x,), (y,) = identity.logical_hashes(a).collect(), identity.logical_hashes(b).collect()
    assert x.logical_hash == y.logical_hash == py_hash(rows) and x.n_rows == 3
    assert identity.logical_hashes(bars(spark, *rows[:2])).first().logical_hash != x.logical_hash
    assert identity.logical_hashes(bars(spark)).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("kl"), st.sampled_from("ABC")), max_size=12))
def test_vintages_and_classes_are_those_of_one_delivery_after_another(spark, seq):
    rows, seen, want = [], {}, []
    for i, (key, content) in enumerate(seq):
        raw = f"{content}{i % 2}"
        order = seen.setdefault(key, {"v": {}, "raw": set(), "n": 0})
        kind = "first" if not order["n"] else "identical_refetch" if raw in order["raw"] else "raw_only" if content in order["v"] else "restatement"
        order["n"] += 1
        order["raw"].add(raw)
        v = order["v"].setdefault(content, len(order["v"]) + 1)
        rows.append((key, raw, content, dt.datetime(2024, 1, 1) + dt.timedelta(i)))
        want.append((rows[-1][3], v, kind))
    df = spark.createDataFrame(rows, "logical_key string, source_artifact_id string, logical_hash string, observation_time timestamp")
    got = identity.classified(identity.vintages(df)).select("observation_time", "vintage", "kind").collect()
    assert sorted(map(tuple, got)) == want


def test_as_of_follows_observations(spark):
    rows = [bar(v=1, at=dt.datetime(2024, 1, 1), art="A"), bar(v=2, at=dt.datetime(2024, 1, 2), art="B"), bar(v=1, at=dt.datetime(2024, 1, 3), art="A2"), bar(v=9, at=None, art="N")]
    known = lambda t: [r.volume for r in identity.as_of(bars(spark, *rows), t).collect()]
    assert [known(f"2024-01-0{d}") for d in (1, 2, 3)] == [[1], [2], [1]] and known("2023-01-01") == []
    assert identity.as_of(bars(spark, *rows), "2024-01-02").columns == schema.COLUMNS


def test_references_and_supersession(spark):
    child, parent = spark.createDataFrame([(1, 10), (2, None), (3, 11)], "c int, p int"), spark.createDataFrame([(10,), (10,), (None,)], "q int")
    assert [r.c for r in identity.orphans(child, parent, "p", "q").collect()] == [3]
    chain = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("z", None)], "id string, sup string")
    assert {r.id for r in identity.superseded_last(chain, "id", "sup").collect()} == {"c", "z"}


def test_gates(spark):
    df = spark.createDataFrame([("x", 1, "raw"), ("x", 2, "canonical"), ("y", None, "raw")], "g string, n int, kind string")
    got = {r.g: (r.positive, r.has_all, r.passed) for r in evidence.gates(df, ["g"], {"positive": F.col("n") > 0}, (F.col("kind"), ["raw", "canonical"])).collect()}
    assert got == {"x": (True, True, True), "y": (False, False, False)}
    moves, edges = spark.createDataFrame([("A", "B"), ("B", "A"), (None, "A")], "from string, to string"), spark.createDataFrame([("A", "B")], "from string, to string")
    assert sorted(r.to for r in evidence.transitions_outside(moves, edges).collect()) == ["A", "A"]
    assert [r[0] for r in spark.createDataFrame([("v", ["v"]), ("v", ["v", "w"])], "s string, a array<string>").select(evidence.independent(F.col("s"), F.col("a"))).collect()] == [False, True]


def test_manifest_digest_is_of_content(spark):
    def build(symbols, closed):
        row = [("v", "d", "k", 1, "PROVISIONAL", symbols, D(2024, 1, 2), D(2024, 1, 3), AT, "s", "p", 5, closed, "fixture", 2)]
        df = spark.createDataFrame(row, "source string, dataset string, logical_key string, vintage int, state string, symbols array<string>, event_date_min date, event_date_max date, observation_time timestamp, sha256 string, object_path string, byte_size bigint, raw_row_count bigint, fetch_mode string, row_count bigint")
        df = df.withColumns({"validation": F.struct(F.lit(True).alias("passed")), "reference_calendar": F.struct(F.lit("X").alias("calendar_name"))})
        return manifests.manifests(df).first()

    a, b, c = build(["B", "A"], 2), build(["A", "B"], 2), build(["A", "B"], None)
    assert a.manifest_digest == b.manifest_digest == hashlib.sha256(a.manifest.encode()).hexdigest() != c.manifest_digest
    doc = json.loads(c.manifest)
    assert doc["raw_artifact"]["row_count"] is None and doc["symbols"] == ["A", "B"] and len(doc) == 14


def test_last_segment_of_a_long_dataset_name(spark, tmp_path):
    from vintara.plans.reference import namespace_scan

    name = "a" * 150 + "/" + "b" * 150
    spark.createDataFrame([("v", name, "k|x")], "source string, dataset string, logical_key string").write.parquet(str(tmp_path / "ingestion_results.parquet"))
    assert [r["last"] for r in namespace_scan(spark, str(tmp_path)).collect()] == ["B" * 150]


def test_a_day_that_is_no_session_is_an_error(spark):
    from vintara.functions.canonical import expected_on

    rows = spark.createDataFrame([(dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 21)), (dt.date(2024, 1, 6), None)], "d date, c timestamp")
    assert rows.where("c is not null").select(expected_on(F.col("d"), F.col("c"))).first()[0] == dt.datetime(2024, 1, 2, 22, 30)
    with pytest.raises(Exception, match="2024-01-06 is no session"):
        rows.select(expected_on(F.col("d"), F.col("c"))).collect()


def test_absent_groups_fail_and_reports_are_documents(spark):
    rows = spark.createDataFrame([("a", 1), ("b", None), ("z", 1)], "g string, x int")
    want = spark.createDataFrame([("a",), ("b",), ("c",)], "g string")
    got = {r.g: (r.n_rows, r.ok, r.passed) for r in evidence.gates(rows, ["g"], {"ok": F.col("x") > 0}, groups=want).collect()}
    assert got == {"a": (1, True, True), "b": (1, False, False), "c": (0, None, False)}
    assert [sorted(x) for x in json.loads(evidence.document(rows).first()[0])] == [["g", "x"]] * 3
    assert evidence.document(rows.limit(0)).first()[0] == "[\n\n]"


def test_digest_format(spark):
    rows = spark.createDataFrame([("0" * 64,), ("A" * 64,), ("0" * 63,), ("0" * 64 + "\n",), (None,)], "h string")
    assert [r[0] for r in rows.select(validation.no_digest(F.col("h"))).collect()] == [False, True, True, True, True]

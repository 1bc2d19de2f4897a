"""Vendor documents, fetching, stores and the stream."""

import datetime as dt
import hashlib
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vintara.schema import BAR
from vintara.sources import fixtures, http, store, vendor
from vintara.streaming import deliveries
from vintara.streaming.deliveries import ingest_stream

T2 = 1704153600000  # 2024-01-02 00:00 UTC


def flat(*rows, **more):
    base = {"T": "spy ", "t": T2, "o": 10, "h": 11, "l": 9, "c": 10.5, "v": 100, "n": 1}
    return json.dumps({"status": "OK", "results": [base | r if isinstance(r, dict) else r for r in rows]} | more).encode()


NY = 1704171600000  # 2024-01-02 00:00 New York


def env(*pages, request=None, **more):
    req = {"ticker": "AAPL", "from": "2024-01-01", "to": "2024-01-31"} | (request or {})
    return json.dumps({"envelope_kind": "x", "request": req, "pages": [p if isinstance(p, str) else json.dumps({"ticker": "AAPL", "status": "OK", "results": p} if not isinstance(p, dict) else p) for p in pages]} | more).encode()


def row(**over):
    return {"t": NY, "o": 10, "h": 11, "l": 9, "c": 10.5, "v": 100} | over


def test_flat_rows():
    k, s, d, o, h, low, c, v, code, why = vendor.parse(flat({"o": 1.005}))[0]
    assert (s, d, o, c, v, code) == ("SPY", dt.date(2024, 1, 2), Decimal("1.005"), Decimal("10.5"), 100, None)
    got = vendor.parse(flat({}, {"o": "x", "v": 1.0, "T": " "}, 7, {"h": True}, {"c": 10**10}, {"v": -5}))
    assert [g[8] for g in got] == [None, "MALFORMED_RECORD", "MALFORMED_RECORD", "MALFORMED_RECORD", "MALFORMED_RECORD", None]
    assert got[1][9] == "T is no ticker, o is no number, v is no whole number" and got[5][7] == -5
    assert vendor.parse(flat().replace(b'"results": []', b'"results": [{"T":"A","t":0,"o":1.1234567890,"h":1,"l":1,"c":NaN,"v":1}]'))[0][9] == "o has more than 8 places, c is not finite"


@pytest.mark.parametrize("payload", [b"", b"[1]", b"3", b"\xff", b'{"results": 5}', b"{"])
def test_documents_that_are_none(payload):
    assert vendor.parse(payload) == [(-1, *[None] * 7, "MALFORMED_JSON", vendor.parse(payload)[0][9])]


@pytest.mark.parametrize(
    ("payload", "code"),
    [
        (env([row(t="x")]), "TIMESTAMP_INVALID"), (env([row(t=NY + 40 * 86400000)]), "OUTSIDE_REQUEST_RANGE"), (env([row()], [row()]), "BUSINESS_DATE_DUPLICATE"), (env([row(o=True)]), "NUMERIC_NONFINITE"),
        (env(json.dumps({"results": [row()]}).replace('"o": 10', '"o": NaN')), "NUMERIC_NONFINITE"), (env([row(o=1.1234567891)]), "NUMERIC_NONFINITE"), (env([row(v=-3)]), "VOLUME_INVALID"), (env([row(v=1.5)]), "VOLUME_INVALID"),
        (env([row(l=12)]), "OHLC_INVALID"), (env({"status": "ERROR"}), "UNEXPECTED_STATUS"), (env({"ticker": "MSFT"}), "TICKER_MISMATCH"), (env("{"), "MALFORMED_JSON"), (env({"results": 3}), "MALFORMED_JSON"), (env([4]), "MALFORMED_JSON"), (env(pages=3), "MALFORMED_JSON"),
    ],
)
def test_first_problem_of_an_envelope(payload, code):
    (got,) = vendor.parse(payload)
    assert got[0] == -1 and got[8] == code


def test_envelope_rows():
    got = vendor.parse(env([row(), row(t=NY + 86400000, v=7.0)], {"results": None}, [row(t=NY + 2 * 86400000)]))
    assert [(g[0], g[1], str(g[2]), g[7]) for g in got] == [(0, "AAPL", "2024-01-02", 100), (1, "AAPL", "2024-01-03", 7), (2, "AAPL", "2024-01-04", 100)]
    # The same instant is another day by the format: midnight UTC is the day before in New York.
    assert vendor.parse(env([row(t=T2)]))[0][2] == dt.date(2024, 1, 1) and vendor.parse(flat({}))[0][2] == dt.date(2024, 1, 2)


def test_documents_as_a_table(spark):
    docs = [flat({}, {"t": T2 + 86400000}), flat({}, *[{"o": "x"}] * 7), env([row()]), None, flat()]
    df = spark.createDataFrame([(d, 1) for d in docs], "payload binary, row int")
    rows = vendor.parsed(df).cache()
    assert {r.source_artifact_id for r in vendor.accepted(rows).collect()} == {hashlib.sha256(docs[k]).hexdigest() for k in (0, 2)}
    bad = {r.source_artifact_id: r for r in vendor.rejected(rows).collect()}
    assert bad[hashlib.sha256(docs[1]).hexdigest()].problems.endswith("row 5: o is no number (+2 more)") and bad[None].first_code == "MALFORMED_JSON"
    assert vendor.parsed(df.limit(0)).count() == 0


class Script:
    def __init__(self, *answers):
        self.answers, self.urls = list(answers), []

    def __call__(self, url, headers, timeout):
        self.urls.append(url)
        a = self.answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a


def page(**doc):
    return 200, {"X-Request-Id": "r"}, json.dumps(doc).encode()


def client(*answers):
    waits, s = [], Script(*answers)
    return http.Client("https://host", "k", s, waits.append), s, waits


def test_fetching_retries_and_gives_up():
    c, s, waits = client((503, {}, b""), TimeoutError(), (429, {"Retry-After": "99"}, b""), page(a=1))
    assert c.get("/p")[0] == {"a": 1} and waits == [0.1, 0.2, 60.0]
    for answers, code in (([(429, {}, b"")] * 4, "RATE_LIMITED"), ([(500, {}, b"")] * 4, "HTTP_ERROR"), ([TimeoutError()] * 4, "TIMEOUT"), ([ConnectionError()] * 4, "CONNECTION_FAILED"), ([(401, {}, b"")], "AUTH_FAILED"), ([(404, {}, b"")], "HTTP_ERROR"), ([(200, {}, b"{")], "MALFORMED_JSON"), ([(200, {}, b"[]")], "MALFORMED_JSON")):
        c, s, _ = client(*answers)
        with pytest.raises(http.FetchFailed) as e:
            c.get("/p")
        assert e.value.code == code and not s.answers
    with pytest.raises(http.FetchFailed):
        http.Client("https://host", "")


def test_pages_stay_on_the_server(monkeypatch):
    c, s, _ = client(page(next_url="https://elsewhere/q?cursor=2"), page())
    assert len(c.pages("/p")) == 2 and s.urls == ["https://host/p", "https://host/q?cursor=2"]
    monkeypatch.setattr(http, "MAX_PAGES", 3)
    c, *_ = client(*[page(next_url="/p")] * 4)
    with pytest.raises(http.FetchFailed):
        c.pages("/p")


def test_lookup():
    for found, ok in (({"ticker": "spy"}, True), ([{"ticker": "SPY"}], True), ({"ticker": ""}, True), ({"ticker": "XLE"}, False), ([], False), (None, False)):
        c, *_ = client(page(results=found))
        if ok:
            assert c.lookup("SPY")
        else:
            with pytest.raises(http.FetchFailed):
                c.lookup("SPY")


def test_data_source(spark, tmp_path):
    code = tmp_path / "scripted_transport.py"
    code.write_text("import json\n\ndef answer(url, headers, timeout):\n    s = url.split('/ticker/')[1].split('/')[0]\n    return 200, {}, json.dumps({'ticker': s, 'status': 'OK', 'results': [{'t': %d, 'o': 10, 'h': 11, 'l': 9, 'c': 10.5, 'v': 5}]}).encode()\n" % NY)
    from vintara.functions.common import ship

    ship(spark)
    spark.sparkContext.addPyFile(str(code))
    import sys

    sys.path.insert(0, str(tmp_path))
    spark.dataSource.register(http.DailyDataSource)
    df = spark.read.format("vendor_daily").options(symbols="msft, aapl,AAPL", start="2024-01-01", end="2024-01-31", base="https://host", key="k", retrieved_at="2024-02-01T00:00:00+00:00", transport="scripted_transport:answer").load()
    assert sorted((r.symbol, r.row_count) for r in df.collect()) == [("AAPL", 1), ("MSFT", 1)]
    assert sorted(r.symbol for r in vendor.accepted(vendor.parsed(df)).collect()) == ["AAPL", "MSFT"]


def test_generated_bars_are_a_function_of_symbol_and_day(spark):
    pairs = spark.createDataFrame([("SPY", dt.date(2024, 1, 2)), ("ABC", dt.date(2024, 1, 3))], "symbol string, session date")
    bars = {r.symbol: r for r in fixtures.generated_bars(pairs).collect()}
    for s, d, base in (("SPY", "2024-01-02", 470), ("ABC", "2024-01-03", 100)):
        x = int.from_bytes(hashlib.sha256(f"{s}|{d}".encode()).digest()[:8], "big")
        o = base + Decimal(x % 10000) / 100
        c = o + Decimal((x >> 16) % 400 - 200) / 100
        w = Decimal((x >> 32) % 150) / 100
        b = bars[s]
        assert (b.open, b.close, b.high, b.low, b.volume) == (o, c, max(o, c) + w + Decimal("0.01"), min(o, c) - w - Decimal("0.01"), 1000000 + x % 5000000)
    over = spark.createDataFrame([("SPY", dt.date(2024, 1, 2), 7777777)], "symbol string, event_date date, volume bigint")
    assert {r.volume for r in fixtures.overridden(fixtures.generated_bars(pairs), over).collect()} == {7777777, bars["ABC"].volume}


def test_stores_only_grow(spark, tmp_path):
    root = str(tmp_path)
    art = spark.createDataFrame([("v", "d", b"one", dt.datetime(2024, 1, 1)), ("v", "d", b"one", dt.datetime(2024, 1, 2)), ("w", "d", b"one", dt.datetime(2024, 1, 1))], "source string, dataset string, payload binary, observation_time timestamp")
    assert store.put_raw(art, root) == 2 and store.put_raw(art, root) == 0
    assert store.put_raw(art.withColumn("payload", F.lit(b"two")), root) == 2
    assert store.read(spark, f"{root}/raw", "x int").where("observation_date = '2024-01-02'").count() == 2
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    assert store.insert_absent(rows, f"{root}/t", ("k",)) == 2 and store.insert_absent(rows.withColumn("x", F.lit("other")), f"{root}/t", ("k",)) == 0
    assert {tuple(r) for r in spark.read.parquet(f"{root}/t").collect()} == {(1, "a"), (2, "b")}
    assert store.read_anchors(spark, f"{root}/none").count() == 0
    a = spark.createDataFrame([(dt.datetime(2024, 1, 1), "d", "s", "m"), (dt.datetime(2024, 1, 1, 0, 0, 0, 5), "d", "s", "m")], "anchored_at timestamp, digest string, subject_id string, subject_type string")
    store.append_anchors(a, f"{root}/anchors")
    store.append_anchors(a, f"{root}/anchors")
    assert store.read_anchors(spark, f"{root}/anchors").count() == 4
    assert {r.value for r in spark.read.text(f"{root}/anchors").collect()} == {'{"anchored_at":"2024-01-01T00:00:00%s+00:00","digest":"d","subject_id":"s","subject_type":"m"}' % x for x in ("", ".000005")}


def test_stream_takes_each_content_once(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "store")
    folder.mkdir()
    (folder / "a.json").write_bytes(flat({}, {"t": T2 + 86400000}))
    (folder / "b.json").write_bytes(flat({"o": "x"}))
    run = lambda: ingest_stream(spark, str(folder), root, "v", "d", str(tmp_path / "cp")).awaitTermination()
    run()
    (folder / "again.json").write_bytes(flat({}, {"t": T2 + 86400000}))
    (folder / "late.json").write_bytes(flat({"t": T2 - 400 * 86400000}))
    run()
    count = lambda t: spark.read.parquet(f"{root}/{t}").count()
    assert {t: count(t) for t in ("raw", "bars", "problems", "hashes")} == {"raw": 3, "bars": 3, "problems": 1, "hashes": 2}
    assert count("observations") == 4
    stored = spark.read.parquet(f"{root}/bars")
    assert stored.where("observation_time is null").count() == 0 and set(stored.columns) == {*BAR.fieldNames(), "row"}
    kinds = {(r.kind, r.vintage, r.n_rows) for r in deliveries.deliveries(spark, root, "v", "d").collect()}
    assert kinds == {("first", 1, 2), ("first", 1, 1), ("unparseable", None, None)}
    done = deliveries.finalize(spark, root, "v", "d", ("X", "1"))
    assert done == {"bars": 3, "manifests": 2, "anchors": 2} and set(deliveries.finalize(spark, root, "v", "d", ("X", "1")).values()) == {0}
    assert spark.read.parquet(f"{root}/canonical").where("vintage = 1 and dataset = 'd'").count() == 3
    digests = {r.manifest_digest for r in spark.read.parquet(f"{root}/manifests").collect()}
    assert digests == {r.digest for r in store.read_anchors(spark, f"{root}/anchors").collect()}


def test_restatements_and_failures_of_a_batch(spark, tmp_path):
    root, at = str(tmp_path), dt.datetime(2024, 1, 3, 12)
    one, two, bad = flat({}), flat({"c": 10.25}), flat({"l": 12})
    files = [(one, 1), (one, 0), (two, 2), (flat({}, x=1), 3), (bad, 4), (b"{", 5), (None, 6)]
    df = spark.createDataFrame([("p", at + dt.timedelta(hours=h), len(x or b""), x) for x, h in files], deliveries.FILES)
    for _ in range(2):  # a batch that is run again adds nothing
        deliveries.ingest_batch(df, root, "v", "d")
    rows = deliveries.deliveries(spark, root, "v", "d").collect()
    assert sorted((r.observation_time.hour, r.kind, r.vintage) for r in rows) == [(12, "first", 1), (14, "restatement", 2), (15, "raw_only", 1), (16, "failed_validation", None), (17, "unparseable", None)]
    assert deliveries.finalize(spark, root, "v", "d", ("X", "1"))["bars"] == 2
    known = spark.read.parquet(f"{root}/canonical").orderBy("observation_time").collect()
    assert [(k.close, k.vintage, k.observation_time.hour) for k in known] == [(Decimal("10.5"), 1, 12), (Decimal("10.25"), 2, 14)]
    assert deliveries.deliveries(spark, str(tmp_path / "none"), "v", "d").count() == 0


def test_ledgers(spark, tmp_path):
    root = str(tmp_path)
    runs = spark.createDataFrame([("r1", "a", 1), ("r1", "a", 1), ("r2", None, 2)], "run_id string, key string, n int")
    assert store.record(runs, root, "runs") == 2 and store.record(runs, root, "runs") == 0
    assert [r.run_id for r in store.recorded(spark, root, "runs", runs.schema, order=("run_id",)).collect()] == ["r1", "r2"]
    assert store.recorded(spark, root, "runs", runs.schema, {"key": None}).count() == 1 and store.recorded(spark, root, "builds", "x int").count() == 0
    with pytest.raises(KeyError):
        store.record(runs, root, "others")
    days = spark.createDataFrame([("X", "1", dt.date(2024, 1, k)) for k in (2, 3)], "calendar string, version string, session date")
    assert store.register_calendar(days, root) == 1 and store.register_calendar(days, root) == 0
    assert store.open_store("s3a://b/x/", {"key": "k"}, {"s3a": ("key",)}) == "s3a://b/x"
    for uri, options in (("", {}), ("s3a://b", {"key": ""})):
        with pytest.raises(ValueError):
            store.open_store(uri, options, {"s3a": ("key",)})


def test_fixture_documents(spark):
    sessions = spark.createDataFrame([(dt.date(2024, 1, k),) for k in (2, 3, 4)], "session date")
    over = spark.createDataFrame([("SPY", dt.date(2024, 1, 3), 7)], "symbol string, event_date date, volume bigint")
    get = lambda **k: fixtures.fetch(spark, "fixture", ["spy ", "XLK"], "2024-01-03", "2024-01-31", "2024-02-01", sessions, **k).orderBy("symbol").collect()
    spy, xlk = get(overrides=over, nonce="n1")
    assert (spy.event_min, spy.event_max, spy.row_count, spy.request_id) == (dt.date(2024, 1, 3), dt.date(2024, 1, 4), 2, "n1")
    doc = json.loads(bytes(spy.payload))
    assert list(doc) == sorted(doc) and doc["request_id"] == "n1" and [r["v"] for r in doc["results"]][0] == 7 and [r["t"] for r in doc["results"]] == sorted(r["t"] for r in doc["results"])
    plain = get()
    assert plain[1].payload == get()[1].payload != xlk.payload and b"request_id" not in plain[0].payload
    assert [r[1:9] for r in vendor.parse(bytes(plain[1].payload))] == [r[1:9] for r in vendor.parse(bytes(xlk.payload))]
    none = fixtures.fetch(spark, "fixture", ["A"], "2025-01-01", "2025-01-02", "2025-02-01", sessions).first()
    assert (none.event_min, none.event_max, none.row_count) == (dt.date(2025, 1, 1), dt.date(2025, 1, 2), 0) and vendor.parse(bytes(none.payload)) == []
    with pytest.raises(ValueError):
        fixtures.fetch(spark, "other", ["A"], "2025-01-01", "2025-01-02", "2025-02-01", sessions)


def test_provenance_of_an_envelope():
    pages = [({"request_id": "d1"}, b"{}", 200, ""), ({}, b"{}", 200, ""), ({}, b"{}", 200, "h3")]
    doc = json.loads(http.envelope("A", "2024-01-01", "2024-01-02", True, pages, "v", "/x"))
    assert (doc["vendor"], doc["endpoint"], doc["endpoint_version"], doc["request_ids"]) == ("v", "/x", "v2", ["d1", "h3"])


def test_a_huge_exponent_is_no_volume():
    assert vendor.parse(env([row()]).replace(b'\\"v\\": 100', b'\\"v\\": 1e999999999'))[0][8] == "VOLUME_INVALID"


def test_five_problems_are_told(spark):
    bad = vendor.parsed(spark.createDataFrame([(flat(*[{"o": "x"}] * 8),), (flat(4),)], "payload binary"))
    got = sorted((r.n_problems, r.first_code, r.problems) for r in vendor.rejected(bad).collect())
    assert got == [(1, "MALFORMED_RECORD", "row 0: row is no object"), (8, "MALFORMED_RECORD", "; ".join(f"row {k}: o is no number" for k in range(5)) + " (+3 more)")]

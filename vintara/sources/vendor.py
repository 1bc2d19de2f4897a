"""Vendor documents into bars, strictly. A document is one row; parsing is per document in Python workers, since no built-in
reader keeps a number's own text, which the precision rules need.

Two formats: "flat" (one object with results; every bad row is reported) and "envelope" (pages of JSON texts with the
request; the first problem rejects the document). A document is an envelope if it has envelope_kind.
"""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal
from zoneinfo import ZoneInfo

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintara.functions.common import ship

ZONE = ZoneInfo("America/New_York")
EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
#: Fields of a row, statuses of a good page.
PRICES, STATUSES = {"o": "open", "h": "high", "l": "low", "c": "close"}, ("OK", "DELAYED")
PARSED = "source_artifact_id string, row int, symbol string, event_date date, open decimal(18,8), high decimal(18,8), low decimal(18,8), close decimal(18,8), volume bigint, code string, problem string"


class Rejected(Exception):
    def __init__(self, code: str, text: str):
        super().__init__(text)
        self.code = code


def loads(payload: bytes):
    """JSON with exact numbers; NaN and infinities come as Decimals of that kind. Anything else wrong is MALFORMED_JSON."""
    try:
        return json.loads(payload if isinstance(payload, str) else payload.decode("utf-8"), parse_float=Decimal, parse_constant=lambda x: Decimal(x.replace("Infinity", "inf")))
    except (ValueError, RecursionError) as e:
        raise Rejected("MALFORMED_JSON", "not a JSON document") from e


def price(x) -> Decimal:
    """An int or Decimal of at most 8 written places and below 10^10; ValueError says what is wrong."""
    if isinstance(x, bool) or not isinstance(x, (int, Decimal)):
        raise ValueError("is no number")
    d = Decimal(x)
    if not d.is_finite():
        raise ValueError("is not finite")
    if d.as_tuple().exponent < -8:
        raise ValueError("has more than 8 places")
    if abs(d) >= 10**10:
        raise ValueError("is too large")
    return d


def whole(x) -> int | None:
    return None if isinstance(x, bool) or not isinstance(x, int) else x


def instant(ms: int) -> dt.datetime | None:
    try:
        return EPOCH + dt.timedelta(milliseconds=ms)
    except OverflowError:
        return None


def parse_flat(payload: bytes | None, doc=None) -> list[tuple]:
    """(row, symbol, date, o, h, l, c, volume, code, problem) of every row; the last two are null for a good one. Row -1
    stands for the document. doc: the document if it is decoded already."""
    try:
        doc = loads(payload) if doc is None else doc
        if not isinstance(doc, dict) or not isinstance(doc.get("results", []), (list, type(None))):
            raise Rejected("MALFORMED_JSON", "no object with a list of results")
    except Rejected as e:
        return [(-1, *[None] * 7, e.code, str(e))]
    out = []
    for k, r in enumerate(doc.get("results") or []):
        if not isinstance(r, dict):
            out.append((k, *[None] * 7, "MALFORMED_RECORD", "row is no object"))
            continue
        wrong, values = [], []
        ticker = r.get("T")
        if not isinstance(ticker, str) or not ticker.strip():
            wrong.append("T is no ticker")
        t = whole(r.get("t"))
        at = None if t is None else instant(t)
        if at is None:
            wrong.append("t is no epoch in milliseconds")
        for f in PRICES:
            try:
                values.append(price(r.get(f)))
            except ValueError as e:
                wrong.append(f"{f} {e}")
        v = whole(r.get("v"))
        if v is None or not -(2**63) <= v < 2**63:
            wrong.append("v is no whole number")
        out.append((k, *[None] * 7, "MALFORMED_RECORD", ", ".join(wrong)) if wrong else (k, ticker.strip().upper(), at.date(), *values, v, None, None))
    return out


def _page_row(r, first: dt.date | None, last: dt.date | None, seen: set) -> tuple:
    if not isinstance(r, dict):
        raise Rejected("MALFORMED_JSON", "row is no object")
    t = whole(r.get("t"))
    at = None if t is None else instant(t)
    if at is None:
        raise Rejected("TIMESTAMP_INVALID", "t is no epoch in milliseconds")
    day = at.astimezone(ZONE).date()
    if first and last and not first <= day <= last:
        raise Rejected("OUTSIDE_REQUEST_RANGE", f"{day} was not asked for")
    if day in seen:
        raise Rejected("BUSINESS_DATE_DUPLICATE", f"{day} comes twice")
    seen.add(day)
    values = []
    for f in PRICES:
        try:
            values.append(price(r.get(f)))
        except ValueError as e:
            raise Rejected("NUMERIC_NONFINITE", f"{f} {e}") from e
    v = r.get("v")
    if isinstance(v, bool) or not isinstance(v, (int, Decimal)) or not Decimal(v).is_finite() or not 0 <= v < 2**63 or v != int(v):
        raise Rejected("VOLUME_INVALID", "v is no whole number of at least 0")
    o, h, low, c = values
    if not (h >= low and low <= o <= h and low <= c <= h):
        raise Rejected("OHLC_INVALID", "the range does not hold open and close")
    return day, *values, int(v)


def _date(x) -> dt.date | None:
    try:
        return dt.date.fromisoformat(x)
    except (TypeError, ValueError):
        return None


def parse_envelope(payload: bytes | None, doc=None) -> list[tuple]:
    """As parse_flat, but a document with any problem gives one row: the first one's."""
    try:
        doc = loads(payload) if doc is None else doc
        request, pages = (doc.get("request"), doc.get("pages")) if isinstance(doc, dict) else (None, None)
        if not isinstance(request, dict) or not isinstance(pages, list) or not isinstance(request.get("ticker"), str):
            raise Rejected("MALFORMED_JSON", "no envelope with request and pages")
        ticker, first, last = request["ticker"].strip().upper(), _date(request.get("from")), _date(request.get("to"))
        seen: set = set()
        out = []
        for text in pages:
            page = loads(text) if isinstance(text, str) else None
            if not isinstance(page, dict):
                raise Rejected("MALFORMED_JSON", "page is no object")
            if page.get("status") is not None and page["status"] not in STATUSES:
                raise Rejected("UNEXPECTED_STATUS", f"status {page['status']}")
            if page.get("ticker") is not None and str(page["ticker"]).strip().upper() != ticker:
                raise Rejected("TICKER_MISMATCH", f"page of {page['ticker']}")
            results = page.get("results")
            if results is not None and not isinstance(results, list):
                raise Rejected("MALFORMED_JSON", "results is no list")
            for r in results or []:
                day, *values = _page_row(r, first, last, seen)
                out.append((len(out), ticker, day, *values, None, None))
        return out
    except Rejected as e:
        return [(-1, *[None] * 7, e.code, str(e))]


def parse(payload: bytes) -> list[tuple]:
    """By the document's own format; it is decoded once."""
    try:
        doc = loads(payload)
    except Rejected as e:
        return [(-1, *[None] * 7, e.code, str(e))]
    if doc is None:  # the JSON text null
        return parse_flat(payload)
    return parse_envelope(None, doc) if isinstance(doc, dict) and "envelope_kind" in doc else parse_flat(None, doc)


def parsed(artifacts: DataFrame, payload: str = "payload") -> DataFrame:
    """Documents (binary) into rows as PARSED, with the SHA-256 of their bytes as source_artifact_id. A null document is
    malformed; an empty list of results gives no row. Documents are not shuffled."""
    ship(artifacts.sparkSession)

    def run(batches):
        for b in batches:
            rows = [(sha, *r) for sha, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for r in (parse(data) if data is not None else [(-1, *[None] * 7, "MALFORMED_JSON", "no document")])]
            kinds = [pa.string(), pa.int32(), pa.string(), pa.date32(), *[pa.decimal128(18, 8)] * 4, pa.int64(), pa.string(), pa.string()]
            names = [x.split()[0] for x in PARSED.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] if k not in (4, 5, 6, 7) or r[k] is None else r[k].quantize(Decimal("1e-8")) for r in rows], t) for k, t in enumerate(kinds)], names=names)

    return artifacts.select(F.sha2(payload, 256), F.col(payload).cast("binary")).toDF("id", "payload").mapInArrow(run, PARSED)


def accepted(rows: DataFrame) -> DataFrame:
    """Rows of documents without any problem: a document is taken whole or not at all."""
    bad = rows.where("code is not null").select("source_artifact_id").distinct()
    return rows.where("code is null").join(bad, "source_artifact_id", "left_anti").select(*rows.columns)


def rejected(rows: DataFrame) -> DataFrame:
    """(source_artifact_id, n_problems, first_code, problems): the first five problems are spelled out, then how many more.
    Only five of a document's problems are ever held together."""
    each = Window.partitionBy("source_artifact_id")
    bad = rows.where("code is not null").select("source_artifact_id", "row", "code", "problem")
    bad = bad.withColumns({"nth": F.row_number().over(each.orderBy("row", "code", "problem")), "n_problems": F.count(F.lit(1)).over(each)})
    first = bad.where("nth <= 5").groupBy("source_artifact_id", "n_problems").agg(F.array_sort(F.collect_list(F.struct("nth", "row", "code", "problem"))).alias("p"))
    told = F.array_join(F.transform("p", lambda x: F.concat(F.lit("row "), x["row"].cast("string"), F.lit(": "), x["problem"])), "; ")
    return first.select("source_artifact_id", "n_problems", F.col("p")[0]["code"].alias("first_code"), F.when(F.col("n_problems") > 5, F.concat(told, F.format_string(" (+%d more)", F.col("n_problems") - 5))).otherwise(told).alias("problems"))

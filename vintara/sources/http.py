"""Fetching vendor documents over HTTP, as a Spark data source with one partition for each symbol.

The transport is a callable (url, headers, timeout) -> (status, headers, body), named by the option "transport" as
module:function, so that tests and other networks bring their own.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import importlib
import json
import time
import urllib.error
import urllib.request
from urllib.parse import urlsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Statuses worth another try, tries after the first, most pages, seconds.
RETRIED, RETRIES, MAX_PAGES, TIMEOUT, LONGEST_WAIT = (413, 429, 499, 500, 502, 503, 504), 3, 1000, 15.0, 60.0


class FetchFailed(Exception):
    def __init__(self, code: str, text: str):
        super().__init__(f"{code}: {text}")
        self.code = code


def urllib_transport(url: str, headers: dict, timeout: float) -> tuple[int, dict, bytes]:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as r:
            return r.status, dict(r.headers), r.read()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers or {}), e.read()


def wait(attempt: int, asked: str | None) -> float:
    """Seconds before the next try: what the server asks, within a minute, else doubling from a tenth."""
    try:
        return min(max(float(asked), 0.0), LONGEST_WAIT)
    except (TypeError, ValueError):
        return 0.1 * 2**attempt


class Client:
    def __init__(self, base: str, key: str, transport=urllib_transport, sleep=time.sleep, retries: int = RETRIES, timeout: float = TIMEOUT):
        if not key:
            raise FetchFailed("AUTH_FAILED", "no key")
        self.base, self.key, self.transport, self.sleep, self.retries, self.timeout = base.rstrip("/"), key, transport, sleep, retries, timeout

    def get(self, path: str) -> tuple[dict, bytes, int, str]:
        """(document, body, status, request id) of a page."""
        why = FetchFailed("HTTP_ERROR", "not tried")
        for attempt in range(self.retries + 1):
            asked = None
            try:
                status, headers, body = self.transport(self.base + path, {"Authorization": f"Bearer {self.key}"}, self.timeout)
            except TimeoutError:
                why = FetchFailed("TIMEOUT", path)
            except OSError:
                why = FetchFailed("CONNECTION_FAILED", path)
            else:
                low = {k.lower(): v for k, v in headers.items()}
                if status == 200:
                    return (*self._decoded(body), status, low.get("x-request-id", ""))
                if status in (401, 403):
                    raise FetchFailed("AUTH_FAILED", f"status {status}")
                why = FetchFailed("RATE_LIMITED" if status == 429 else "HTTP_ERROR", f"status {status}")
                if status not in RETRIED:
                    raise why
                asked = low.get("retry-after")
            if attempt < self.retries:
                self.sleep(wait(attempt, asked))
        raise why

    @staticmethod
    def _decoded(body: bytes) -> tuple[dict, bytes]:
        try:
            doc = json.loads(body.decode("utf-8"))
        except ValueError as e:
            raise FetchFailed("MALFORMED_JSON", "page is no JSON") from e
        if not isinstance(doc, dict):
            raise FetchFailed("MALFORMED_JSON", "page is no object")
        return doc, body

    def pages(self, path: str) -> list[tuple[dict, bytes, int, str]]:
        """All pages of a listing; only path and query of next_url are followed, on the same server."""
        out = []
        while path:
            if len(out) == MAX_PAGES:
                raise FetchFailed("HTTP_ERROR", f"more than {MAX_PAGES} pages")
            out.append(self.get(path))
            u = urlsplit(out[-1][0].get("next_url") or "")
            path = u.path + (f"?{u.query}" if u.query else "")
        return out


    def lookup(self, ticker: str, path: str = "/v3/reference/tickers/") -> dict:
        """Reference data of one ticker: the answer's results, or the first of them. Another ticker's is refused; none
        named is taken as the one asked for."""
        found = self.get(path + ticker)[0].get("results")
        if isinstance(found, list):
            found = found[0] if found else None
        if not isinstance(found, dict):
            raise FetchFailed("MALFORMED_JSON", f"no results for {ticker}")
        named = str(found.get("ticker") or "").strip().upper()
        if named and named != ticker.strip().upper():
            raise FetchFailed("TICKER_MISMATCH", f"{named} for {ticker}")
        return found


def request_ids(pages: list[tuple[dict, bytes, int, str]]) -> list[str]:
    """The pages' request ids in order, from the answer's head or else its document; empty ones left out."""
    return [i for i in (head or d.get("request_id") for d, _, _, head in pages) if i]


def envelope(ticker: str, first: str, last: str, adjusted: bool, pages: list[tuple[dict, bytes, int, str]], vendor: str = "vendor", endpoint: str = "") -> bytes:
    """The pages' texts with their request and where they come from, as one canonical document."""
    doc = {
        "envelope_kind": "aggregates", "vendor": vendor, "endpoint": endpoint, "endpoint_version": "v2", "http_method": "GET", "adjusted": adjusted, "request_ids": request_ids(pages), "http_status": [s for _, _, s, _ in pages], "pages": [b.decode("utf-8") for _, b, _, _ in pages],
        "request": {"ticker": ticker, "multiplier": 1, "timespan": "day", "from": first, "to": last, "adjusted": adjusted, "sort": "asc", "limit": 50000},
    }
    return json.dumps(doc, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()


class SymbolPartition(InputPartition):
    def __init__(self, symbol: str):
        self.symbol = symbol


class DailyReader(DataSourceReader):
    def __init__(self, options: dict):
        self.o = {k.lower(): v for k, v in options.items()}

    def partitions(self):
        return [SymbolPartition(s) for s in sorted({x.strip().upper() for x in self.o["symbols"].split(",") if x.strip()})]

    def read(self, part):
        o = self.o
        module, _, name = o.get("transport", "vintara.sources.http:urllib_transport").partition(":")
        client = Client(o["base"], o.get("key", ""), getattr(importlib.import_module(module), name))
        adjusted = o.get("adjusted", "true").strip().lower() in ("true", "1", "yes")
        at = dt.datetime.fromisoformat(o["retrieved_at"])
        endpoint = f"/v2/aggs/ticker/{part.symbol}/range/1/day/{o['start']}/{o['end']}"
        pages = client.pages(f"{endpoint}?adjusted={str(adjusted).lower()}&sort=asc&limit=50000")
        data = envelope(part.symbol, o["start"], o["end"], adjusted, pages, o.get("source", "vendor"), endpoint)
        n = sum(len(d["results"]) for d, *_ in pages if isinstance(d.get("results"), list))
        yield (o.get("source", "vendor"), o.get("dataset", "daily"), part.symbol, hashlib.sha256(data).hexdigest(), data, at, dt.date.fromisoformat(o["start"]), dt.date.fromisoformat(o["end"]), n, next(iter(request_ids(pages)), None))


class DailyDataSource(DataSource):
    """spark.dataSource.register(DailyDataSource); spark.read.format("vendor_daily").options(symbols=..., start=..., end=...,
    base=..., key=..., retrieved_at=...).load()"""

    @classmethod
    def name(cls):
        return "vendor_daily"

    def schema(self):
        return "source string, dataset string, symbol string, sha256 string, payload binary, observation_time timestamp, event_min date, event_max date, row_count bigint, request_id string"

    def reader(self, schema):
        return DailyReader(dict(self.options))

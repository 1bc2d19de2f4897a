"""Canonical JSON, digests and the scalar rules of the data model, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintara.functions.common import BLANKS, strip


def plain_decimal(c: Column) -> Column:
    """Decimal as text without trailing zeros or exponent; its type's scale must be above 0 or it is cast as is."""
    return F.regexp_replace(F.regexp_replace(c.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")


def iso_instant(c: Column) -> Column:
    """A UTC instant as ISO text with Z; microseconds only where there are any. The session's zone must be UTC."""
    return F.when(F.date_format(c, "SSSSSS") == "000000", F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))


def json_text(c: Column) -> Column:
    """A string as JSON: only quotes, backslashes and control characters escaped, the latter in lower-case hex."""
    body = F.regexp_replace(F.regexp_replace(F.to_json(F.array(c)), r"^\[", ""), r"\]$", "")
    lower = body
    for x in "ABCDEF":
        lower = F.regexp_replace(lower, rf"(?<!\\)((?:\\\\)*)\\u00([01]){x}", rf"$1\\u00$2{x.lower()}")
    return F.when(c.rlike(r"[\x00-\x1f]"), lower).otherwise(body)


def canonical_json(c: Column, kind: T.DataType) -> Column:
    """Canonical JSON of a column: keys sorted, no blanks, nulls kept, decimals as plain strings, dates and UTC instants
    as ISO text, lists in order. Maps must have string keys. Binary, float and interval types raise TypeError."""
    if isinstance(kind, T.StructType):
        parts = []
        for i, f in enumerate(sorted(kind.fields, key=lambda f: f.name)):
            name = '"' + f.name.replace("\\", "\\\\").replace('"', '\\"') + '":'
            parts += [F.lit(("," if i else "") + name), canonical_json(c.getField(f.name), f.dataType)]
        text = F.concat(F.lit("{"), *parts, F.lit("}"))
    elif isinstance(kind, T.ArrayType):
        text = F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: canonical_json(x, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            raise TypeError("a map's keys must be strings")
        entry = F.transform(F.map_entries(c), lambda e: F.concat(json_text(e["key"]), F.lit(":"), canonical_json(e["value"], kind.valueType)))
        text = F.concat(F.lit("{"), F.array_join(F.array_sort(entry), ","), F.lit("}"))
    elif isinstance(kind, T.StringType):
        text = json_text(c)
    elif isinstance(kind, T.DecimalType):
        text = F.concat(F.lit('"'), plain_decimal(c), F.lit('"'))
    elif isinstance(kind, T.DateType):
        text = F.concat(F.lit('"'), F.date_format(c, "yyyy-MM-dd"), F.lit('"'))
    elif isinstance(kind, T.TimestampType):
        text = F.concat(F.lit('"'), iso_instant(c), F.lit('"'))
    elif isinstance(kind, (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        text = c.cast("string")
    else:
        raise TypeError(f"no canonical form of {kind.simpleString()}")
    return F.coalesce(text, F.lit("null"))


def digest(text: Column) -> Column:
    """SHA-256 in hex of a string's UTF-8 bytes or of binary."""
    return F.sha2(text, 256)


def utc_day(millis: Column) -> Column:
    """Day in UTC of an epoch in milliseconds."""
    return F.to_date(F.timestamp_millis(millis))


def market_day(millis: Column, zone: str = "America/New_York") -> Column:
    """Day in an exchange's zone of an epoch in milliseconds; the session's zone must be UTC."""
    return F.to_date(F.from_utc_timestamp(F.timestamp_millis(millis), zone))


def day_millis(day: Column) -> Column:
    """Epoch in milliseconds of a day's midnight in UTC."""
    return F.unix_millis(day.cast("timestamp"))


def logical_key(source: Column, dataset: Column, first: Column, last: Column) -> Column:
    return F.concat_ws("|", source, dataset, first, last)


def truthy(c: Column, default: bool = True) -> Column:
    """true, 1 and yes in any case; null is the default."""
    return F.when(c.isNull(), default).otherwise(F.lower(strip(c)).isin("true", "1", "yes"))


def path_join(*parts: Column) -> Column:
    return F.concat_ws("/", *[F.btrim(p, F.lit("/")) for p in parts])


def last_segment(c: Column) -> Column:
    return F.upper(F.split_part(c, F.lit("/"), F.lit(-1)))


def symbols_of(c: Column) -> Column:
    """A request's symbols: stripped, upper case, distinct, sorted."""
    return F.array_sort(F.array_distinct(F.transform(c, lambda s: F.upper(F.trim(s, F.lit(BLANKS))))))


def seed64(text: Column) -> Column:
    """The first 8 bytes of a text's SHA-256 as an unsigned integer, decimal(20,0)."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, 10).cast("decimal(20,0)")


def expected_by(close: Column, minutes: int = 90) -> Column:
    """When a session's bar should be there: its close and the agreed delay."""
    return close + F.make_dt_interval(mins=F.lit(minutes))


def expected_on(day: Column, close: Column, minutes: int = 90) -> Column:
    """As expected_by, but a day that is no session (whose close is null) is an error, not an unknown."""
    return F.when(close.isNull(), F.raise_error(F.concat(F.coalesce(day.cast("string"), F.lit("null")), F.lit(" is no session"))).cast("timestamp")).otherwise(expected_by(close, minutes))

"""Bytes, maps and times as text. Everything here is a built-in expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clean_text(value: Column | str) -> Column:
    """Decode UTF-8, writing U+FFFD for each malformed sequence instead of failing."""
    value = F.col(value) if isinstance(value, str) else value
    return F.make_valid_utf8(value.cast("string"))


def clean_list(value: Column | str) -> Column:
    return F.transform(value, clean_text)


def last_per_key(entries: Column) -> Column:
    """A map of (key, value) entries; of entries with one key the last counts."""
    def is_last(entry: Column, at: Column) -> Column:
        later = F.slice(entries, at + 2, F.size(entries))
        return ~F.exists(later, lambda x: x["key"] == entry["key"])
    return F.map_from_entries(F.filter(entries, is_last))


def _clean_entries(value: Column | str, clean_value) -> Column:
    """A map decoded; keys that decode alike are one key. NULL stays NULL."""
    return last_per_key(F.transform(F.map_entries(value), lambda e: F.struct(
        clean_text(e["key"]).alias("key"), clean_value(e["value"]).alias("value"))))


def clean_map(value: Column | str) -> Column:
    """Decode keys and values of a map."""
    return _clean_entries(value, clean_text)


def clean_list_map(value: Column | str) -> Column:
    """Decode a map whose values are lists."""
    return _clean_entries(value, clean_list)


def clean_nested(value: Column, kind: T.DataType) -> Column:
    """Decode every binary or text inside maps, lists and structs of any depth.

    The type says where they are, so the walk is over the type and the work one expression. Other
    values and NULL stay as they are; keys that decode alike are one key, the last counts.
    """
    if isinstance(kind, (T.BinaryType, T.StringType)):
        return clean_text(value)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: clean_nested(x, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*[
            clean_nested(value.getField(f.name), f.dataType).alias(f.name) for f in kind]))
    if isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.struct(
            clean_nested(e["key"], kind.keyType).alias("key"),
            clean_nested(e["value"], kind.valueType).alias("value")))
        return last_per_key(entries)
    return value


def with_clean(df: DataFrame, *columns: str) -> DataFrame:
    """These columns decoded at any depth, in their places."""
    return df.withColumns({c: clean_nested(F.col(f"`{c}`"), df.schema[c].dataType)
                           for c in columns or df.columns})


def properties_json(value: Column | str, of_bytes: bool = False) -> Column:
    """JSON text of a property map; absent and empty maps both give NULL.

    Text is written with malformed parts replaced already; maps ``of_bytes`` are decoded first.
    """
    value = F.col(value) if isinstance(value, str) else value
    decoded = clean_map(value) if of_bytes else value
    return F.when(F.size(value) > 0, F.to_json(decoded, {"ignoreNullFields": "false"}))


_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def iso_timestamp(value: Column | str) -> Column:
    """ISO-8601 text of a UTC time without zone; the fraction is written only if not zero."""
    text = (F.col(value) if isinstance(value, str) else value).cast("timestamp_ntz").cast("string")
    whole = F.translate(F.substring_index(text, ".", 1), " ", "T")
    fraction = F.concat(F.lit("."), F.rpad(F.substring_index(text, ".", -1), 6, "0"))
    return F.concat(whole, F.when(F.contains(text, F.lit(".")), fraction).otherwise(""),
                    F.lit("+00:00"))


def micros(value: Column | str) -> Column:
    """Microseconds from 1970 to a time without zone."""
    value = (F.col(value) if isinstance(value, str) else value).cast("timestamp_ntz")
    since = (value - F.expr(_EPOCH)).cast("interval second").cast("decimal(18,6)")
    return (since * 1_000_000).cast("bigint")


def utc(instant: Column) -> Column:
    """The UTC time, without zone, of an instant, whatever the session's zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(_EPOCH))


def instant(value: Column | str) -> Column:
    """The instant of a UTC time without zone; the inverse of :func:`utc`."""
    return F.timestamp_micros(micros(value))


def utc_now() -> Column:
    return utc(F.current_timestamp())

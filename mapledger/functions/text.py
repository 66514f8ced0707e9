"""Text helpers as column expressions: trimming, JSON text, ISO timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters a full Unicode strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Trim every kind of whitespace, not only blanks."""
    return F.btrim(text, F.lit(WHITESPACE))


def basename(path: Column) -> Column:
    """Last path component, ignoring trailing slashes."""
    return F.substring_index(F.rtrim(path, F.lit("/")), "/", -1)


def after_first(text: Column, mark: str) -> Column:
    """What follows the first occurrence of a one-character mark."""
    return F.substr(text, F.locate(mark, text) + F.lit(1))


def normalize_id(value: Column) -> Column:
    """Null becomes the empty string; anything else its trimmed text."""
    return strip(F.coalesce(value.cast("string"), F.lit("")))


def iso_timestamp(ts: Column) -> Column:
    """ISO-8601 text of a zone-less timestamp; microseconds only when present."""
    micros = F.date_format(ts, "SSSSSS")
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(micros == "000000", base).otherwise(F.concat(base, F.lit("."), micros))


def csv_timestamp(ts: Column) -> Column:
    """Timestamp text as reports print it: a blank between date and time."""
    return F.replace(iso_timestamp(ts), F.lit("T"), F.lit(" "))


def _escape_code_point(ch: Column) -> Column:
    units = F.lower(F.hex(F.encode(ch, "UTF-16BE")))
    low = F.when(F.length(units) > 4, F.concat(F.lit("\\u"), F.substr(units, F.lit(5), F.lit(4)))).otherwise("")
    return F.when(
        ch.rlike(r"[^ -~]"), F.concat(F.lit("\\u"), F.substr(units, F.lit(1), F.lit(4)), low)
    ).otherwise(ch)


def needs_escape(text: Column) -> Column:
    """Whether JSON text of a string differs from it."""
    return text.rlike(r'[^ !#-\[\]-~]')


def json_string(text: Column) -> Column:
    """A quoted ASCII-only JSON string; rare characters take the slow branches only where they occur."""
    out = text
    for raw, escaped in (
        ("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"),
        ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f"),
    ):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    points = F.regexp_extract_all(out, F.lit("(?s)."), F.lit(0))
    out = F.when(
        out.rlike(r"[^ -~]"), F.array_join(F.transform(points, _escape_code_point), "")
    ).otherwise(out)
    return F.concat(F.lit('"'), F.when(~needs_escape(text), text).otherwise(out), F.lit('"'))


def json_value(col: Column, dtype: T.DataType) -> Column:
    """JSON text of a column with `, ` and `: ` separators and ISO timestamps, recursively."""
    if isinstance(dtype, T.StringType):
        text = json_string(col)
    elif isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        text = json_string(iso_timestamp(col))
    elif isinstance(dtype, T.DateType):
        text = json_string(F.date_format(col, "yyyy-MM-dd"))
    elif isinstance(dtype, T.ArrayType):
        items = F.transform(col, lambda x: json_value(x, dtype.elementType))
        text = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    elif isinstance(dtype, T.MapType):
        pairs = F.transform(
            F.map_entries(col),
            lambda e: F.concat(json_string(e["key"]), F.lit(": "), json_value(e["value"], dtype.valueType)),
        )
        text = F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))
    elif isinstance(dtype, T.StructType):
        text = json_object({f.name: (col[f.name], f.dataType) for f in dtype.fields})
    else:
        text = col.cast("string")
    return F.when(col.isNull(), F.lit("null")).otherwise(text)


def json_object(fields: dict[str, tuple[Column, T.DataType]]) -> Column:
    """JSON object text with the fields in the given order."""
    parts: list[Column] = []
    for i, (name, (col, dtype)) in enumerate(fields.items()):
        parts.append(F.lit(("{" if i == 0 else ", ") + f'"{name}": '))
        parts.append(json_value(col, dtype))
    return F.concat(*parts, F.lit("}")) if parts else F.lit("{}")


def payload_size(record_bytes: Column) -> Column:
    """Bytes of a request body holding records of the given sizes (aggregate expression)."""
    return F.lit(15) + F.sum(record_bytes) + F.lit(2) * (F.count(record_bytes) - F.lit(1))


def json_kind(variant: Column) -> Column:
    """Type name of a variant value: OBJECT, ARRAY, STRING, ... ; null when absent."""
    return F.substring_index(F.substring_index(F.schema_of_variant(variant), "<", 1), "(", 1)


def member(variant: Column, path: str | Column) -> Column:
    """A member of a JSON value, still as a variant; null when absent."""
    return F.try_variant_get(variant, path, "variant")


def text_member(variant: Column, path: str | Column) -> Column:
    return F.try_variant_get(variant, path, "string")

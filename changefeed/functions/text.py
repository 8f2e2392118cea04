"""Readable copies of raw record bytes and headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REPLACEMENT = "�"


def readable(raw: Column) -> Column:
    """Bytes as text; what is not UTF-8, and NUL, shows as U+FFFD."""
    return F.translate(F.make_valid_utf8(raw.cast("string")), "\0", REPLACEMENT)


def decode_headers(raw: Column) -> Column:
    """map<string,binary> as map<string,string> without the null values."""
    present = F.map_filter(raw, lambda _, value: value.isNotNull())
    return F.transform_values(present, lambda _, value: F.make_valid_utf8(value.cast("string")))


def first_line(message: Column) -> Column:
    return F.substring_index(message, "\n", 1)


# Characters that do not print: control, format, unassigned, private ones, separators but the space.
UNPRINTED = r"[\p{C}\p{Z}&&[^ ]]"


def _escaped(char: Column) -> Column:
    """A character that does not print, by its code point."""
    code = F.ltrim(F.lower(F.hex(F.encode(char, "UTF-32"))), F.lit("0"))
    size = F.when(F.length(code) <= 2, 2).when(F.length(code) <= 4, 4).otherwise(8)
    mark = F.when(size == 2, "\\x").when(size == 4, "\\u").otherwise("\\U")
    named = F.when(char == "\n", "\\n").when(char == "\r", "\\r").when(char == "\t", "\\t")
    return F.coalesce(named, F.concat(mark, F.lpad(code, size, F.lit("0"))))


def python_repr(text: Column) -> Column:
    """A string value the way rule messages quote it."""
    single, double = F.contains(text, F.lit("'")), F.contains(text, F.lit('"'))
    body = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    chars = F.regexp_extract_all(body, F.lit("(?s)."), F.lit(0))
    shown = F.transform(chars, lambda c: F.when(c.rlike(UNPRINTED), _escaped(c)).otherwise(c))
    body = F.when(text.rlike(UNPRINTED), F.array_join(shown, "")).otherwise(body)
    inner = F.when(double, F.lit("\\'")).otherwise(F.lit("'"))
    quote = F.when(single & ~double, F.lit('"')).otherwise(F.lit("'"))
    return F.concat(quote, F.replace(body, F.lit("'"), inner), quote)


def page_token(sequence: Column) -> Column:
    """URL-safe base64 of {"before": n}."""
    document = F.concat(F.lit('{"before": '), sequence.cast("string"), F.lit("}"))
    return F.translate(F.base64(F.encode(document, "UTF-8")), "+/", "-_")


def page_position(token: Column) -> Column:
    """The sequence inside a page token; null if the token is malformed."""
    raw = F.try_to_binary(F.translate(token, "-_", "+/"), F.lit("base64"))
    before = F.try_variant_get(
        F.try_parse_json(F.make_valid_utf8(raw.cast("string"))), "$.before", "variant"
    )
    return F.when(
        F.schema_of_variant(before) == "BIGINT", F.try_variant_get(before, "$", "bigint")
    )

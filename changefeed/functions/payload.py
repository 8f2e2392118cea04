"""Source rows as JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changefeed.functions.times import iso_offset

_PLAIN = (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)


class UnsupportedColumn(ValueError):
    """A source column whose type has no JSON form."""


def json_value(column: Column, data_type: T.DataType) -> Column:
    """A source value in the type it has in the payload.

    Decimals become fixed-point text and so stay exact; dates, times and
    timestamps become ISO text, bytes become base64.
    """
    if isinstance(data_type, _PLAIN):
        return column
    if isinstance(data_type, T.DecimalType):
        return column.cast("string")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return iso_offset(column.cast("timestamp"))
    if isinstance(data_type, T.DateType):
        return F.date_format(column, "yyyy-MM-dd")
    if isinstance(data_type, T.BinaryType):
        return F.base64(column)
    if type(data_type).__name__ == "TimeType":
        return column.cast("string")
    raise UnsupportedColumn(f"unsupported source column type: {data_type.simpleString()}")


def _float_member(column: Column, name: str) -> Column:
    """``"name":1.5`` -- JSON has no NaN or infinity, so those become text."""
    double = column.cast("double")
    shown = (
        F.when(F.isnan(double), F.lit("nan"))
        .when(double == float("inf"), F.lit("inf"))
        .when(double == float("-inf"), F.lit("-inf"))
    )
    as_text = _members([shown.alias(name)])
    return F.when(shown.isNotNull(), as_text).otherwise(_members([double.alias(name)]))


def _members(values: list[Column]) -> Column:
    text = F.to_json(F.struct(*values), {"ignoreNullFields": "false"})
    return F.substr(text, F.lit(2), F.length(text) - F.lit(2))


def payload_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Every column of the row under its lower-case name, as one JSON object."""
    plain, floats = [], []
    for field in df.schema.fields:
        if columns is not None and field.name not in columns:
            continue
        column, name = F.col(f"`{field.name}`"), field.name.lower()
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            floats.append(_float_member(column, name))
        else:
            plain.append(json_value(column, field.dataType).alias(name))
    members = ([_members(plain)] if plain else []) + floats
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))

"""Text codecs of the order and rate feeds: one comma-separated record per line.

Decoding is a handful of Catalyst expressions. Two modes:

``strict``      a bad number or a missing field fails the query, whatever the ANSI setting;
``quarantine``  bad lines are set apart and the rest goes on.

Fields after the last declared one are ignored in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.schemas import ORDER, RATE

SEPARATOR = ","


def _split(lines: DataFrame, value: str) -> DataFrame:
    """``value`` and its ``parts``. A line is split in a generator of one row: Catalyst puts no generator in
    place of the columns that come from it, so a line is split once however often its parts are used."""
    return lines.select(value, F.explode_outer(F.array(F.split(value, SEPARATOR))).alias("parts"))


def _part(i: int) -> Column:
    return F.get("parts", F.lit(i))


def _fields(schema: T.StructType) -> list[Column]:
    return [_part(i).try_cast(field.dataType).alias(field.name) for i, field in enumerate(schema.fields)]


def _is_good(schema: T.StructType) -> Column:
    good = F.lit(True)
    for i, field in enumerate(schema.fields):
        good = good & _part(i).try_cast(field.dataType).isNotNull()
    return good


def _is_strict(schema: T.StructType) -> Column:
    """Good, and numbers without padding: the cast alone would take it."""
    good = _is_good(schema)
    for i, field in enumerate(schema.fields):
        if not isinstance(field.dataType, T.StringType):
            good = good & (_part(i) == F.trim(_part(i)))
    return F.coalesce(good, F.lit(False))


def decode(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Strict: the check is a filter over all fields, which column pruning can't take away, so no bad
    line gets through whatever is selected or counted."""
    complaint = F.concat(
        F.lit("not a record of ("), F.lit(", ".join(schema.names)), F.lit("): "),
        F.coalesce(F.col(value), F.lit("null")),
    )
    checked = F.when(_is_strict(schema), True).otherwise(F.raise_error(complaint).cast("boolean"))
    return _split(lines, value).where(checked).select(*_fields(schema))


def decode_quarantine(
    lines: DataFrame, schema: T.StructType, value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """(good records, bad lines as they came). Works on streams: each is its own query."""
    parts = _split(lines, value)
    good = parts.where(_is_good(schema)).select(*_fields(schema))
    bad = parts.where(~_is_good(schema)).select(value)
    return good, bad


def encode(records: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    return records.select(
        F.concat_ws(SEPARATOR, *(F.col(name).cast("string") for name in schema.names)).alias(value)
    )


def decode_orders(lines: DataFrame, value: str = "value") -> DataFrame:
    return decode(lines, ORDER, value)


def decode_rates(lines: DataFrame, value: str = "value") -> DataFrame:
    return decode(lines, RATE, value)


def encode_orders(orders: DataFrame, value: str = "value") -> DataFrame:
    return encode(orders, ORDER, value)


def encode_rates(rates: DataFrame, value: str = "value") -> DataFrame:
    return encode(rates, RATE, value)

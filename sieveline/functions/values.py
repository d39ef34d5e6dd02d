"""Typed literals for filter bounds, and culture-invariant text of values."""

from __future__ import annotations

from datetime import datetime, timezone
from decimal import Decimal, InvalidOperation
from math import ceil, floor

from pyspark.sql import Column, functions as F, types as T


def _number(raw: str) -> Decimal:
    try:
        number = Decimal(raw.strip())
    except InvalidOperation:
        raise ValueError(f"not a number: {raw!r}") from None
    if not number.is_finite():
        raise ValueError(f"not a number: {raw!r}")
    return number


def can_equal(raw: str, data_type: T.DataType) -> bool:
    """Whether a value of ``data_type`` can equal ``raw``: no whole number equals a fraction."""
    return not isinstance(data_type, T.IntegralType) or _number(raw) % 1 == 0


def compared(field: Column, operator: str, raw: str, data_type: T.DataType) -> Column:
    """``field`` compared (``<``, ``<=``, ``>``, ``>=``) with a bound given as text.

    A fractional bound of a whole-number column becomes the next whole number that decides alike.
    """
    if not can_equal(raw, data_type):
        up = operator in (">", ">=")
        operator, raw = (">=", str(ceil(_number(raw)))) if up else ("<=", str(floor(_number(raw))))
    bound = typed_literal(raw, data_type)
    return {"<": field < bound, "<=": field <= bound, ">": field > bound, ">=": field >= bound}[operator]


def typed_literal(raw: str, data_type: T.DataType) -> Column:
    """Literal of ``raw`` comparable with a column of ``data_type``; a bad text raises.

    The literal takes the column's own type wherever it can, so that the
    comparison reaches the Parquet reader instead of hiding behind a cast.
    """
    if isinstance(data_type, T.StringType):
        return F.lit(raw)
    if isinstance(data_type, T.BooleanType):
        flag = {"true": True, "false": False}.get(raw.lower())
        if flag is None:
            raise ValueError(f"not a boolean: {raw!r}")
        return F.lit(flag)
    if isinstance(data_type, T.IntegralType):
        if not can_equal(raw, data_type):
            return F.lit(_number(raw))
        number, bits = int(_number(raw)), {"tinyint": 7, "smallint": 15, "int": 31}.get(data_type.simpleString(), 63)
        fits = -(2**bits) <= number < 2**bits
        return F.lit(number).cast(data_type) if fits else F.lit(Decimal(number))
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.lit(float(raw)).cast(data_type)
    if isinstance(data_type, T.DecimalType):
        number = _number(raw)
        _, digits, exponent = number.as_tuple()
        whole = len(digits) + exponent <= data_type.precision - data_type.scale
        # Rounded to the column's scale, the bound would be another one.
        return F.lit(number).cast(data_type) if whole and -exponent <= data_type.scale else F.lit(number)
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        instant = datetime.fromisoformat(raw)
        # Without a zone, a date-time is UTC.
        if instant.tzinfo is not None:
            instant = instant.astimezone(timezone.utc).replace(tzinfo=None)
        zone = "+00:00" if isinstance(data_type, T.TimestampType) else ""
        return F.lit(instant.isoformat(sep=" ") + zone).cast(data_type)
    return F.lit(raw).cast(data_type)


def utc_time(value: Column, data_type: T.DataType) -> Column:
    """Instants as date-times in UTC, whatever the session's zone; other values unchanged."""
    if not isinstance(data_type, T.TimestampType):
        return value
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(value), epoch)


def plain_text(column: Column, data_type: T.DataType) -> Column:
    """Cheap one-to-one text of a value, fit as a grouping key."""
    column = utc_time(column, data_type)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        column = column.cast("double") + F.lit(0.0)
    return column.cast("string")


def invariant_text(text: Column, data_type: T.DataType) -> Column:
    """Turn ``plain_text`` into the invariant form: ``5`` not ``5.0``, ``True``, ``1E+20``."""
    if isinstance(data_type, T.BooleanType):
        return F.initcap(text)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return _invariant_double(text)
    if isinstance(data_type, T.DecimalType):
        return text
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        # From yyyy-MM-dd HH:mm:ss.
        part = lambda start, size: F.substring(text, start, size)
        slash = F.lit("/")
        return F.concat(part(6, 2), slash, part(9, 2), slash, part(1, 4), F.lit(" "), part(12, 8), F.lit(" +00:00"))
    return text


def _invariant_double(text: Column) -> Column:
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    exponent = F.substring_index(text, "E", -1).cast("int")
    # Between 1E-4 and 1E15 the digits are written out.
    written_out = F.regexp_replace(text.cast(T.DecimalType(38, 22)).cast("string"), r"\.?0+$", "")
    sign = F.when(exponent < 0, "E-").otherwise("E+")
    scientific = F.concat(mantissa, sign, F.format_string("%02d", F.abs(exponent)))
    with_exponent = F.when((exponent > -5) & (exponent < 15), written_out).otherwise(scientific)
    special = text.isin("NaN", "Infinity", "-Infinity")
    return (
        F.when(special, text).when(F.contains(text, F.lit("E")), with_exponent).otherwise(mantissa)
    )

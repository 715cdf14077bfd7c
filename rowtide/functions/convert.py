"""Source value -> typed value, as column expressions.

A source value arrives as the bytes or the text of the wire. Null stays null
(V17). Errors are raised in the task that meets the value, with the value in
the message; nothing here depends on the session's ANSI setting.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowtide.functions import types as T

# What an unusable date or time becomes in a primary key column.
EPOCH_DATE = "1970-01-01"
EPOCH_TIME = "1970-01-01 00:00:00"
# Fixed value: any text holding this is the source's zero date.
ZERO_DATE_MARK = "0000-00-0"

INTEGER_TEXT = r"^[+-]?\d+$"
UNSIGNED_TEXT = r"^\d+$"
DATE_TEXT = r"^\d{4}-\d{2}-\d{2}$"
TIME_TEXT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d+)?$"


def _text(value: Column) -> Column:
    return value.cast("string")


def _fail(what: str, value: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"cannot read {what}: "), _text(value)))


def _checked(value: Column, parsed: Column, what: str) -> Column:
    """``parsed``, or an error where a present value could not be parsed."""
    return F.when(value.isNull() | parsed.isNotNull(), parsed).otherwise(_fail(what, value))


def clean_utf8(raw: Column) -> Column:
    """Valid UTF-8 is kept, anything else is read as Latin-1."""
    as_text = raw.cast("string")
    return F.when(F.is_valid_utf8(as_text), as_text).otherwise(
        F.decode(raw.cast("binary"), "ISO-8859-1")
    )


def to_string(value: Column) -> Column:
    """V1."""
    return clean_utf8(value)


def to_boolean(value: Column) -> Column:
    """V2: ``1`` and ``0`` only."""
    v = _text(value)
    return (
        F.when(v == "1", F.lit(True))
        .when(v == "0", F.lit(False))
        .when(v.isNotNull(), _fail("BOOLEAN", value))
    )


def _integral(value: Column, what: str) -> Column:
    v = _text(value)
    return _checked(value, F.when(v.rlike(INTEGER_TEXT), v.try_cast("bigint")), what)


def _narrow(value: Column, ddl: str, low: int, high: int, what: str, on_overflow: str) -> Column:
    wide = _integral(value, what)
    over = F.lit(None) if on_overflow == "null" else _fail(f"{what} (out of range)", value)
    return F.when(wide.between(low, high), wide.try_cast(ddl)).when(wide.isNotNull(), over)


def to_short(value: Column, on_overflow: str = "error") -> Column:
    """V3: the carrier is 32 bits wide, the Spark type is not."""
    return _narrow(value, "smallint", -(2**15), 2**15 - 1, "SHORT", on_overflow)


def to_int(value: Column, on_overflow: str = "error") -> Column:
    """V3: overflow is an error, or null with ``on_overflow='null'`` (A1)."""
    return _narrow(value, "int", -(2**31), 2**31 - 1, "INT", on_overflow)


def to_long(value: Column) -> Column:
    """V4."""
    return _integral(value, "LONG")


def bits_to_long(raw: Column) -> Column:
    """V5: up to eight big-endian bytes that fit a signed long."""
    b = raw.cast("binary")
    parsed = F.when(F.length(b) == 0, F.lit(0).cast("bigint")).when(
        F.length(b) <= 8, F.conv(F.hex(b), 16, 10).try_cast("bigint")
    )
    return F.when(b.isNull() | parsed.isNotNull(), parsed).otherwise(
        F.raise_error(F.concat(F.lit("cannot read BIT: x'"), F.hex(b), F.lit("'")))
    )


def to_decimal(
    value: Column, precision: int = T.DEFAULT_PRECISION, scale: int = T.DEFAULT_SCALE
) -> Column:
    """V6: exact; text where Spark has no decimal that wide."""
    if precision > T.SPARK_MAX_PRECISION:
        return _text(value)
    return _checked(value, _text(value).try_cast(f"decimal({precision},{scale})"), "DECIMAL")


def to_double(value: Column) -> Column:
    """V7."""
    return _checked(value, _text(value).try_cast("double"), "DOUBLE")


def to_float(value: Column, on_overflow: str = "error") -> Column:
    """V7: beyond the largest float is an error, or null with ``on_overflow='null'``."""
    wide = to_double(value)
    over = F.lit(None) if on_overflow == "null" else _fail("FLOAT (out of range)", value)
    fits = (F.abs(wide) <= F.lit(3.4028234663852886e38)) | F.isnan(wide)
    return F.when(fits, wide.cast("float")).when(wide.isNotNull(), over)


def _unparsable(value: Column, parsed: Column, epoch: str, ddl: str, what: str,
                is_pk: bool, strict: bool) -> Column:
    """A bad value gives the epoch in a primary key and null elsewhere."""
    if strict:
        return _checked(value, parsed, what)
    if not is_pk:
        return parsed
    return F.when(value.isNull(), F.lit(None)).otherwise(
        F.coalesce(parsed, F.lit(epoch).cast(ddl))
    )


def to_date(value: Column, is_pk: bool = False, strict: bool = False) -> Column:
    """V8: exactly ``yyyy-MM-dd``."""
    v = _text(value)
    parsed = F.when(v.rlike(DATE_TEXT), v.try_cast("date"))
    return _unparsable(value, parsed, EPOCH_DATE, "date", "DATE", is_pk, strict)


def to_timestamp_ntz(value: Column, is_pk: bool = False, strict: bool = False) -> Column:
    """V9: ``yyyy-MM-dd HH:mm:ss`` with an optional fraction, no zone."""
    v = _text(value)
    parsed = F.when(v.rlike(TIME_TEXT), v.try_cast("timestamp_ntz"))
    return _unparsable(value, parsed, EPOCH_TIME, "timestamp_ntz", "DATETIME", is_pk, strict)


def to_timestamp_utc(value: Column, is_pk: bool = False, strict: bool = False) -> Column:
    """As V9, read as UTC. ``strict`` turns every zero date into the epoch."""
    v = _text(value)
    # The zone is part of the text, so the session's zone does not matter.
    parsed = F.when(v.rlike(TIME_TEXT), F.concat(v, F.lit("Z")).try_cast("timestamp"))
    if strict:
        epoch = F.lit(EPOCH_TIME + "Z").cast("timestamp")
        parsed = F.when(v.contains(ZERO_DATE_MARK), epoch).otherwise(parsed)
    return _unparsable(value, parsed, EPOCH_TIME + "Z", "timestamp", "TIMESTAMP", is_pk, strict)


def to_binary(value: Column) -> Column:
    """V11."""
    return value.cast("binary")


def to_json(value: Column) -> Column:
    """Empty text is null; other text passes, valid JSON or not."""
    return F.nullif(clean_utf8(value), F.lit(""))


def enum_label(value: Column, labels: Column) -> Column:
    """An index gives its label, 0 the empty text; all else passes as text."""
    # Bytes that need cleaning are no number, so only the text that passes is cleaned.
    plain = _text(value)
    index = F.when(plain.rlike(INTEGER_TEXT), plain.try_cast("bigint"))
    return (
        F.when(index == 0, F.lit(""))
        .when(
            (index >= 1) & (index <= F.size(labels)),
            F.try_element_at(labels, index.try_cast("int")),
        )
        .otherwise(clean_utf8(value))
    )


def _mask(v: Column) -> Column:
    """Unsigned 64-bit text as the long with the same bits; null if it is none."""
    digits = v.rlike(UNSIGNED_TEXT)
    narrow = F.when(digits, v.try_cast("bigint"))
    # Only the upper half of the range needs a decimal.
    wide = F.when(digits & narrow.isNull(), v.try_cast("decimal(38,0)"))
    top = F.lit("18446744073709551616").cast("decimal(38,0)")
    return F.coalesce(narrow, F.when(wide < top, (wide - top).try_cast("bigint")))


def set_labels(
    value: Column, labels: Column | Sequence[str], as_json: bool = False
) -> Column:
    """The labels of a mask's bits, low to high, joined by commas.

    Text that is no mask passes. A bit without a label is an error. Labels known
    while planning, as a plain list, keep the work in generated code. ``as_json``
    gives a JSON array of the labels instead of the bare join (A10).
    """
    v = clean_utf8(value)
    mask = _mask(_text(value))
    if isinstance(labels, Column):
        n = F.size(labels)
        unknown = (n < 64) & (F.call_function("shiftrightunsigned", mask, n) != 0)
        bit = lambda m, i: F.call_function("shiftrightunsigned", m, i).bitwiseAND(F.lit(1)) == 1
        # The one-element array binds the mask, so that it is not read once per label.
        picked = F.transform(
            F.array(mask), lambda m: F.filter(labels, lambda _, i: bit(m, i))
        )[0]
        joined = F.to_json(picked) if as_json else F.array_join(picked, ",")
    else:
        n = len(labels)
        unknown = F.shiftrightunsigned(mask, n) != 0 if n < 64 else F.lit(False)
        # Bit 63 is the sign.
        bits = [1 << i if i < 63 else -(1 << 63) for i in range(n)]
        parts = [
            F.when(mask.bitwiseAND(F.lit(bit).cast("bigint")) != 0, F.lit(label))
            for bit, label in zip(bits, labels)
        ]
        joined = F.to_json(F.array_compact(F.array(*parts))) if as_json else F.concat_ws(",", *parts)
    return (
        F.when(mask.isNull(), F.to_json(F.split(v, ",")) if as_json else v)
        .when(unknown, _fail("SET (bit without label)", value))
        .otherwise(joined)
    )


# The converter of each logical type. A column's plan may add options.
CONVERTERS: dict[str, Callable[..., Column]] = {
    T.BOOLEAN: to_boolean,
    T.SHORT: to_short,
    T.INT: to_int,
    T.LONG: to_long,
    T.FLOAT: to_float,
    T.DOUBLE: to_double,
    T.DECIMAL: to_decimal,
    T.NAIVE_DATE: to_date,
    T.NAIVE_DATETIME: to_timestamp_ntz,
    T.UTC_DATETIME: to_timestamp_utc,
    T.BINARY: to_binary,
    T.JSON: to_json,
    T.STRING: to_string,
}


def converter(logical: str) -> Callable[..., Column]:
    """A type without converter is an error while planning."""
    try:
        return CONVERTERS[logical]
    except KeyError:
        raise ValueError(f"no converter for logical type {logical!r}") from None

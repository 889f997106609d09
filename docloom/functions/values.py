"""Typed extraction values: typing raw text, picking the set value, display."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.schemas import NUMBER_SCALE

#: The typed fields, in the order in which the set one is looked for.
TYPED_FIELDS = ("value_text", "value_number", "value_bool", "value_date")

DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy")
TRUE_WORDS = ("true", "yes")
FALSE_WORDS = ("false", "no")

_PLAIN_NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)$"


def _plain_digits(raw: Column) -> Column:
    return F.regexp_replace(F.trim(raw), "[$,]", "")


def parse_number(raw: Column, scale: int = NUMBER_SCALE) -> Column:
    """Exact decimal of a number text, null when it has none or does not fit.

    ``$`` and ``,`` are ignored.  A number with more digits than the type holds
    on either side of the point is not rounded: it stays null here and
    :func:`is_number_text` tells it from other texts.
    """
    digits = _plain_digits(raw)
    exact = (F.length(digits) <= scale) | ~digits.rlike(rf"[.][0-9]{{{scale}}}[0-9]*[1-9]")
    fits = digits.rlike(_PLAIN_NUMBER) & exact
    return F.when(fits, digits.try_cast(T.DecimalType(38, scale)))


def is_number_text(raw: Column) -> Column:
    """True for a text that is a plain number of any size."""
    return _plain_digits(raw).rlike(_PLAIN_NUMBER)


def number_overflow(data_type: Column, number: Column, raw: Column) -> Column:
    """True for a number text that the decimal column could not hold exactly."""
    left_out = (data_type == "Number") & number.isNull() & is_number_text(raw)
    return F.coalesce(left_out, F.lit(False))


def parse_bool(raw: Column) -> Column:
    word = F.lower(F.trim(raw))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def _date_shape(fmt: str) -> str | None:
    """Pattern of the texts a numeric date format can read; None for other formats."""
    if re.search(r"[^yMd\W_]", fmt):
        return None
    parts = re.findall(r"y+|M+|d+|.", fmt)
    if any(len(part) > 2 for part in parts if part[0] in "Md"):
        return None
    digits = {1: "[0-9]+", 2: "[0-9]{2}", 4: "[0-9]{4}"}
    shape = [
        digits.get(len(part), "[0-9]+") if part[0] in "yMd" else re.escape(part) for part in parts
    ]
    return "^" + "".join(shape) + "$"


def parse_date(raw: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First date that one of the formats reads.

    A text of another shape is not handed to the parser, whose failures are slow.
    """
    text = F.trim(raw)
    tries = []
    for fmt in formats:
        parsed = F.try_to_timestamp(text, F.lit(fmt)).cast("date")
        shape = _date_shape(fmt)
        tries.append(parsed if shape is None else F.when(text.rlike(shape), parsed))
    return F.coalesce(*tries)


def typed_fields(
    raw: Column,
    data_type: str,
    *,
    scale: int = NUMBER_SCALE,
    date_formats: Sequence[str] = DATE_FORMATS,
) -> dict[str, Column]:
    """The four typed columns for one known data type.

    At most one typed column is non-null; an unknown data type sets none.
    """
    number = T.DecimalType(38, scale)
    out = {
        "value_text": F.lit(None).cast("string"),
        "value_number": F.lit(None).cast(number),
        "value_bool": F.lit(None).cast("boolean"),
        "value_date": F.lit(None).cast("date"),
    }
    if data_type == "String":
        out["value_text"] = raw
    elif data_type == "Number":
        out["value_number"] = parse_number(raw, scale)
    elif data_type == "Boolean":
        out["value_bool"] = parse_bool(raw)
    elif data_type == "Date":
        out["value_date"] = parse_date(raw, date_formats)
    return out


def typed_fields_by_column(
    raw: Column,
    data_type: Column,
    *,
    scale: int = NUMBER_SCALE,
    date_formats: Sequence[str] = DATE_FORMATS,
) -> dict[str, Column]:
    """Like :func:`typed_fields` where the data type is itself a column."""
    return {
        "value_text": F.when(data_type == "String", raw),
        "value_number": F.when(data_type == "Number", parse_number(raw, scale)),
        "value_bool": F.when(data_type == "Boolean", parse_bool(raw)),
        "value_date": F.when(data_type == "Date", parse_date(raw, date_formats)),
    }


def _parsed_is_set(parsed_value: Column, is_variant: bool) -> Column:
    if is_variant:
        return parsed_value.isNotNull() & ~F.coalesce(F.is_variant_null(parsed_value), F.lit(False))
    return parsed_value.isNotNull()


def value_type(columns: dict[str, T.DataType]) -> Column:
    """Which field holds the value: ``text number bool date parsed`` or null.

    ``columns`` are the fields of the result table (name to type).  The legacy
    ``parsed_value`` counts only when no typed field is set; false and the empty
    string are values.
    """
    picked = F.lit(None).cast("string")
    if "parsed_value" in columns:
        variant = isinstance(columns["parsed_value"], T.VariantType)
        picked = F.when(_parsed_is_set(F.col("parsed_value"), variant), F.lit("parsed"))
    for field in reversed(TYPED_FIELDS):
        label = field.removeprefix("value_")
        picked = F.when(F.col(field).isNotNull(), F.lit(label)).otherwise(picked)
    return picked


def number_text(number: Column) -> Column:
    """Shortest exact rendering of a decimal, without trailing zeros."""
    text = number.cast("string")
    trimmed = F.regexp_replace(F.regexp_replace(text, "0+$", ""), "[.]$", "")
    return F.when(F.instr(text, ".") > 0, trimmed).otherwise(text)


def display_value(columns: dict[str, T.DataType]) -> Column:
    """One text column for the set value, for wide tables and CSV."""
    parts = [
        F.col("value_text"),
        number_text(F.col("value_number")),
        F.col("value_bool").cast("string"),
        F.date_format("value_date", "yyyy-MM-dd"),
    ]
    if "parsed_value" in columns:
        parsed = F.col("parsed_value")
        if isinstance(columns["parsed_value"], T.VariantType):
            scalar = F.try_variant_get(parsed, "$", "string")
            parts.append(
                F.when(~F.is_variant_null(parsed), F.coalesce(scalar, F.to_json(parsed)))
            )
        else:
            parts.append(parsed.cast("string"))
    return F.coalesce(*parts)


def fields_of(schema: T.StructType) -> dict[str, T.DataType]:
    return {field.name: field.dataType for field in schema.fields}

"""Strict value parsing: number syntax, JSON scalars, sensor addresses and depths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: accepted number syntax, null words and sentinels -----------------------
FLOAT_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
SPECIAL_FLOAT_PATTERN = r"^[+-]?(inf|infinity|nan)$"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
NULL_WORD = "nan"
SENTINEL = -99.0
SENTINEL_TOLERANCE = 2.220446049250313e-16
DEPTH_WORDS = {
    "inner": "inner",
    "in": "inner",
    "i": "inner",
    "outer": "outer",
    "out": "outer",
    "o": "outer",
}
# --- End of fixed values ------------------------------------------------------------------


def strict_double(text: Column) -> Column:
    """Decimal, exponent, inf and nan syntax only; anything else is null."""
    lowered = F.lower(text)
    return F.when(text.rlike(FLOAT_PATTERN), text.try_cast("double")).when(
        lowered.rlike(SPECIAL_FLOAT_PATTERN),
        F.when(lowered.endswith("nan"), F.lit(float("nan")))
        .when(lowered.startswith("-"), F.lit(float("-inf")))
        .otherwise(F.lit(float("inf"))),
    )


def strict_bigint(text: Column) -> Column:
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast("bigint"))


def is_null_word(text: Column) -> Column:
    trimmed = F.trim(text)
    return (trimmed == "") | (F.lower(trimmed) == NULL_WORD)


def reading(text: Column) -> Column:
    """A measurement cell: blank, NAN and the -99 sentinel are null."""
    trimmed = F.trim(text)
    parsed = F.when(trimmed.rlike(FLOAT_PATTERN), trimmed.try_cast("double")).otherwise(
        F.when(~is_null_word(trimmed), strict_double(trimmed))
    )
    return F.when(F.abs(parsed - F.lit(SENTINEL)) < SENTINEL_TOLERANCE, F.lit(None)).otherwise(
        parsed
    )


def reading_is_bad(text: Column) -> Column:
    """True when a measurement cell is neither a number nor a null word."""
    trimmed = F.trim(text)
    return ~(
        trimmed.rlike(FLOAT_PATTERN)
        | is_null_word(trimmed)
        | F.lower(trimmed).rlike(SPECIAL_FLOAT_PATTERN)
    )


def sdi12_address(text: Column) -> Column:
    """One ASCII alphanumeric character, or null."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike("^[0-9A-Za-z]$"), trimmed)


def thermistor_depth(text: Column) -> Column:
    word = F.lower(F.trim(text))
    known = F.create_map(*[F.lit(part) for pair in DEPTH_WORDS.items() for part in pair])
    return F.try_element_at(known, word)


def json_scalar(value: Column) -> tuple[Column, Column, Column]:
    """(is string, is number, text) of a JSON scalar held as text."""
    trimmed = F.trim(value)
    is_string = trimmed.startswith('"')
    is_number = trimmed.rlike(r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$")
    text = F.when(
        is_string,
        F.get_json_object(F.concat(F.lit('{"v":'), trimmed, F.lit("}")), "$.v"),
    ).otherwise(trimmed)
    return is_string, is_number, text


def json_to_kind(value: Column, kind: str) -> Column:
    """Convert a JSON scalar to a parameter kind; an unconvertible value is null."""
    is_string, is_number, text = json_scalar(value)
    if kind == "float":
        return F.when(is_number, text.try_cast("double")).when(is_string, strict_double(text))
    if kind == "integer":
        return F.when(is_number | is_string, strict_bigint(text))
    if kind == "boolean":
        lowered = F.lower(text)
        literal = F.when(text == "true", True).when(text == "false", False)
        quoted = F.when(lowered.isin("true", "1"), True).when(lowered.isin("false", "0"), False)
        return F.when(is_string, quoted).otherwise(literal)
    if kind == "string":
        return text
    raise ValueError(f"unknown parameter kind {kind!r}")

"""Text to typed values, under a strict and a permissive rule.

Strict: text that does not look like the type becomes NULL, text that does but
cannot be held (a number too wide, a date that does not exist) raises.
Permissive: anything unreadable becomes NULL.

No function depends on the session's ANSI setting.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from salesloom.schema import DATE_FORMAT

# What strict text must look like. \z, because $ would also
# accept a final newline.
STRICT_INTEGER = r"^[0-9]+\z"
STRICT_DECIMAL = r"^[0-9]+(\.[0-9]+)?\z"
# What the permissive integer reads. Blanks and control characters
# around the number are ignored, a fraction is cut off, a missing digit counts as 0.
PERMISSIVE_INTEGER = (
    r"^[\x00-\x20\x7F]*(?:[+-]?[0-9]+(?:\.[0-9]*)?|[+-]?\.[0-9]*)[\x00-\x20\x7F]*\z"
)
INTEGER_PART = r"^[\x00-\x20\x7F]*([+-]?[0-9]*)"

# Wide enough to compare parsed values before any rounding, but for texts with
# significant digits behind the eighteenth place: see ``beyond_scale``.
EXACT_DECIMAL = "decimal(38,18)"
BEYOND_SCALE = r"^[0-9]+\.[0-9]{18}([0-9]*[1-9])0*\z"


def null_to_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def is_filled(text: Column) -> Column:
    """True for text that is neither NULL nor empty."""
    return text.isNotNull() & (text != "")


def _or_raise(value: Column, text: Column, type_name: str) -> Column:
    message = F.concat(F.lit(f"value out of range for {type_name}: "), text)
    return F.coalesce(value, F.raise_error(message).cast(type_name))


def strict_int(text: Column) -> Column:
    return F.when(text.rlike(STRICT_INTEGER), _or_raise(text.try_cast("int"), text, "int"))


def strict_decimal(text: Column, type_name: str = EXACT_DECIMAL) -> Column:
    return F.when(
        text.rlike(STRICT_DECIMAL), _or_raise(text.try_cast(type_name), text, type_name)
    )


def beyond_scale(text: Column) -> Column:
    """The significant digits behind the eighteenth decimal place, '' if there are none.

    A number with such digits equals no stored number; numbers that differ only in them
    are different.
    """
    return F.coalesce(F.regexp_extract(text, BEYOND_SCALE, 1), F.lit(""))


def lenient_int(text: Column) -> Column:
    """The strict integer at any width up to 38 digits, never an error."""
    return F.when(text.rlike(STRICT_INTEGER), text.try_cast("decimal(38,0)"))


def lenient_decimal(text: Column) -> Column:
    return F.when(text.rlike(STRICT_DECIMAL), text.try_cast(EXACT_DECIMAL))


def strict_date(text: Column) -> Column:
    return F.when(is_filled(text), _or_raise(permissive_date(text), text, "date"))


def permissive_int(text: Column) -> Column:
    whole = F.regexp_extract(text, INTEGER_PART, 1)
    digits = F.when(whole.isin("", "+", "-"), F.lit("0")).otherwise(whole)
    return F.when(text.rlike(PERMISSIVE_INTEGER), digits.try_cast("int"))


def permissive_double(text: Column) -> Column:
    return text.try_cast("double")


def permissive_date(text: Column) -> Column:
    return F.try_to_date(text, DATE_FORMAT)


def strict_outcome(text: Column, kind: str) -> tuple[Column, Column]:
    """Whether filled text becomes NULL, and whether it raises, under the strict rule."""
    if kind == "date":
        return F.lit(False), is_filled(text) & permissive_date(text).isNull()
    pattern, type_name = {
        "int": (STRICT_INTEGER, "int"), "decimal": (STRICT_DECIMAL, EXACT_DECIMAL),
    }[kind]
    looks_right = text.rlike(pattern)
    return (
        is_filled(text) & ~looks_right,
        is_filled(text) & looks_right & text.try_cast(type_name).isNull(),
    )


PERMISSIVE = {"int": permissive_int, "double": permissive_double, "date": permissive_date}
STRICT = {"int": strict_int, "decimal": strict_decimal, "date": strict_date}
# For audits: reads what the strict rule reads, and has NULL where that raises.
LENIENT = {"int": lenient_int, "decimal": lenient_decimal, "date": permissive_date}


def date_parts(date: Column) -> dict[str, Column]:
    """Calendar columns of a date dimension."""
    return {
        "day": F.dayofmonth(date),
        "month": F.month(date),
        "year": F.year(date),
        "quarter": F.quarter(date),
    }

"""Declared column types: enforce them, or count what breaks them."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def _length_limit(declared: str) -> int | None:
    limit = re.fullmatch(r"varchar\((\d+)\)", declared)
    return int(limit.group(1)) if limit else None


def _is_decimal(declared: str) -> bool:
    return declared.startswith("decimal")


def breaks(column: Column, declared: str) -> Column:
    """True where a value cannot be stored under the declared type.

    Blanks beyond the length limit do not count: storing cuts them off.
    """
    limit = _length_limit(declared)
    if limit is not None:
        return F.coalesce(F.length(F.rtrim(column)) > limit, F.lit(False))
    if declared in ("key", "string"):
        return F.lit(False)
    return column.isNotNull() & column.try_cast(declared).isNull()


def conform(df: DataFrame, columns: Mapping[str, str], strict: bool = True) -> DataFrame:
    """``df`` with exactly the declared columns and types; a value that does not fit raises,
    or is NULL if not ``strict``.

    Decimals are rounded half away from zero to their scale.
    """

    def stored(name: str, declared: str) -> Column:
        column = F.col(name)
        limit = _length_limit(declared)
        if declared in ("key", "string"):
            return column
        error = F.raise_error(
            F.concat(F.lit(f"{name} does not fit {declared}: "), column.cast("string"))
        ) if strict else F.lit(None)
        if limit is not None:
            return F.when(breaks(column, declared), error.cast("string")).otherwise(
                F.substring(column, 1, limit)
            )
        return F.when(
            column.isNotNull(), F.coalesce(column.try_cast(declared), error.cast(declared))
        )

    return df.select(*[stored(n, d).alias(n) for n, d in columns.items()])


def contract_report(df: DataFrame, table: str, columns: Mapping[str, str]) -> DataFrame:
    """One row per column: values present, values that cannot be stored, values rounding changes.

    One aggregation pass over the table; the result has as many rows as columns.
    """
    names = [n for n, declared in columns.items() if declared != "key"]
    aggregates = []
    for name in names:
        column, declared = F.col(name), columns[name]
        present = F.count(column)
        broken = F.count_if(breaks(column, declared))
        if _is_decimal(declared):
            changed = column.try_cast(declared).cast("decimal(38,18)") != column
            rounded = F.count_if(F.coalesce(changed, F.lit(False)))
        else:
            rounded = F.lit(0).cast("bigint")
        aggregates.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(name).alias("column_name"),
                F.lit(columns[name]).alias("declared_type"),
                present.alias("values_present"),
                broken.alias("not_storable"),
                rounded.alias("rounded"),
            )
        )
    return df.agg(F.array(*aggregates).alias("_rows")).select(F.inline("_rows"))

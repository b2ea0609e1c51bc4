"""Fit the columns of a DataFrame to a target table's columns, before any job runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.convert import default_value
from quayside.types import ColumnSpec, is_typed, storage_type


class AlignmentError(ValueError):
    """The input columns cannot be loaded into the target."""


def insertable(fields: list[str], columns: list[ColumnSpec], table: str = "the target", typed: bool = True) -> list[ColumnSpec]:
    """Target columns the input fills, in table order. Names match by case.

    ``typed=False`` is the JSON load path, which also takes maps, tuples and other
    nested types.
    """
    known = {s.name for s in columns}
    unknown = [f for f in fields if f not in known]
    doubled = sorted({f for f in fields if fields.count(f) > 1})
    if doubled:
        raise AlignmentError(f"record fields {doubled} appear more than once")
    chosen = [s for s in columns if s.name in set(fields)]
    for s in chosen:
        if s.computed:
            raise AlignmentError(
                f"column '{s.name}' of table {table} is computed and cannot be loaded; drop the field from the records"
            )
        if typed and not is_typed(s.type):
            raise AlignmentError(
                f"column '{s.name}' has type {s.type_text}, which the typed load path does not take; use the JSON path (typed=False)"
            )
    if unknown:
        raise AlignmentError(f"record fields {unknown} have no column in table {table}")
    if not chosen:
        raise AlignmentError(f"no record field matches a column of table {table}")
    return chosen


def default_column(s: ColumnSpec) -> Column:
    """The DEFAULT of a column, else the zero of its type."""
    return F.expr(s.default).cast(storage_type(s.type)) if s.default else default_value(s.type)


def align(df: DataFrame, columns: list[ColumnSpec], table: str = "the target", typed: bool = True, fill_defaults: bool = False) -> DataFrame:
    """Select the input columns the target has, in table order; refuse everything else by name.

    With ``fill_defaults`` the columns the input lacks follow with their DEFAULT
    (or the type's own default) in their place.
    """
    chosen = {s.name for s in insertable(df.columns, columns, table, typed)}
    if not fill_defaults:
        return df.select(*[F.col(f"`{s.name}`") for s in columns if s.name in chosen])
    out = []
    for s in columns:
        if s.name in chosen:
            out.append(F.col(f"`{s.name}`"))
        elif not s.computed:
            out.append(default_column(s).alias(s.name))
    return df.select(*out)

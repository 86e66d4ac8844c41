"""Input checks shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require(df: DataFrame, columns: Iterable[str], numeric: Iterable[str] = ()) -> None:
    """Fail with the column's name when one is missing or not a number."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    for name in [*columns, *numeric]:
        if name not in fields:
            raise ValueError(f"column '{name}' is missing; the table has {sorted(fields)}")
    for name in numeric:
        if not isinstance(fields[name], (T.NumericType, T.BooleanType)):
            raise ValueError(f"column '{name}' must be a number, not {fields[name].simpleString()}")


def refuse(df: DataFrame, columns: Iterable[str]) -> None:
    """Fail when an output column would overwrite an input column."""
    for name in columns:
        if name in df.columns:
            raise ValueError(f"column '{name}' is already there; rename it first")


def finite(col: Column) -> Column:
    """True for a number; False for NULL, NaN and infinity."""
    return F.coalesce(F.abs(col.cast("double")) < float("inf"), F.lit(False))


def complete(columns: Iterable[str]) -> Column:
    """True when all of the numeric columns hold a number: not NULL, NaN or infinite."""
    cond = F.lit(True)
    for name in columns:
        cond = cond & finite(F.col(name))
    return cond


def weighted(weight: str | None) -> Column:
    """True when a row's weight is a positive number, or when there are no weights."""
    return F.lit(True) if weight is None else finite(F.col(weight)) & (F.col(weight).cast("double") > 0)


def as_double(df: DataFrame, name: str) -> Column:
    """The column as a double; a boolean counts as 0 or 1."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, T.BooleanType):
        col = col.cast("int")
    return col.cast("double")

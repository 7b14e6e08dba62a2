"""Row filters and the projection to training pairs."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.constants import PAGE_MARKERS


def drop_marked(df: DataFrame, column: str, markers=PAGE_MARKERS) -> DataFrame:
    """Drop rows whose text contains any marker (case-sensitive); null text is kept."""
    if not markers:
        return df
    marked = reduce(or_, [F.col(column).contains(m) for m in markers])
    return df.where(F.col(column).isNull() | ~marked)


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with a null in any of the columns (default: all)."""
    return df.dropna(how="any", subset=columns)


def to_pairs(df: DataFrame, inputs: str | Column, targets: str | Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly `(inputs, targets)`, plus any key columns named in `keep`."""
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    return df.select(*keep, as_col(inputs).alias("inputs"), as_col(targets).alias("targets"))

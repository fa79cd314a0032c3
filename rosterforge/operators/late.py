"""Filters on costly columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_once(df: DataFrame, test: Callable[[Column], Column]) -> DataFrame:
    """Rows of ``df`` that pass ``test``, given as a function of the row struct.

    An ordinary filter is pushed below the select that made its columns, with
    their whole expressions copied into it, and works them out twice or more.
    This one stays where it is written.  Not for plain columns of a scan, whose
    filters should be pushed down.
    """
    row = F.struct(*df.columns)
    return df.select(F.inline(F.filter(F.array(row), test)))

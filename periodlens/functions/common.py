"""Small shared helpers for building Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def string_columns(df) -> list[str]:
    """Names of the string-typed columns of ``df`` in schema order."""
    return [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]

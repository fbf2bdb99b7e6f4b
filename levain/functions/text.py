"""Text cleaning as one projection (no per-column withColumn chains, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def trim_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Overwrite the given (default: all string) columns with their trimmed value.

    SQL TRIM removes spaces only; tabs and newlines stay, as in the reference SQL.
    """
    cols = string_columns(df) if columns is None else list(columns)
    return df.withColumns({c: F.trim(F.col(c)) for c in cols}) if cols else df


def clean_lower(c: str | Column) -> Column:
    """LOWER(TRIM(c)) — the normalisation used for categorical codes such as gender."""
    return F.lower(F.trim(F.col(c) if isinstance(c, str) else c))

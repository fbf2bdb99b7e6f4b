"""Calendar parts of a timestamp (session time zone is pinned to UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sale_date(ts: str | Column) -> Column:
    return F.to_date(F.col(ts) if isinstance(ts, str) else ts)


def date_parts(ts: str | Column, prefix: str = "sale") -> dict[str, Column]:
    """{prefix_date, prefix_year, prefix_month} from a timestamp column."""
    d = sale_date(ts)
    return {f"{prefix}_date": d, f"{prefix}_year": F.year(d), f"{prefix}_month": F.month(d)}

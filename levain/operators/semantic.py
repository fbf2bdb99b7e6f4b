"""A small semantic layer: named dimensions and measures over one source DataFrame.

A dashboard dataset declares dimensions (``source.col`` expressions) and measures
(``COUNT(*)``); a chart picks some of each.  ``query`` validates the names and issues a
single ``groupBy().agg()`` — a partial and a final hash aggregate around one exchange.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class SemanticModel:
    source: DataFrame
    dimensions: dict[str, str]
    measures: dict[str, str]

    @classmethod
    def over_columns(cls, source: DataFrame, measures: dict[str, str] | None = None) -> "SemanticModel":
        """Every column is a dimension (``source.col``); the default measure is ``count``."""
        dims = {c: f"source.`{c}`" for c in source.columns}
        return cls(source, dims, measures or {"count": "COUNT(*)"})

    def query(self, dims: list[str], measures: list[str]) -> DataFrame:
        unknown = [d for d in dims if d not in self.dimensions] + [m for m in measures if m not in self.measures]
        if unknown:
            raise KeyError(f"unknown dimensions/measures: {unknown}")
        src = self.source.alias("source")
        keys = [F.expr(self.dimensions[d]).alias(d) for d in dims]
        aggs = [F.expr(self.measures[m]).alias(m) for m in measures]
        return src.groupBy(*keys).agg(*aggs) if keys else src.agg(*aggs)

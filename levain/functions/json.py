"""JSON held in strings: ``col:a:b`` style paths and typed parsing."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_json_path(path: str) -> str:
    """Turn ``a:b:c`` / ``a.b`` / ``a:b.c`` (colon-path notation) into ``$.a.b.c``."""
    path = path.strip()
    if path.startswith("$"):
        return path
    parts = [p for p in re.split(r"[:.]", path) if p]
    return "$." + ".".join(parts)


def json_path(c: str | Column, path: str) -> Column:
    """Extract a JSON value by path from a string column (text for scalars, JSON text otherwise)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.get_json_object(col, to_json_path(path))


def parse_json_array(c: str | Column, element_ddl: str) -> Column:
    """from_json(c, 'array<...>') with the element type given as DDL."""
    col = F.col(c) if isinstance(c, str) else c
    return F.from_json(col, f"array<{element_ddl}>")

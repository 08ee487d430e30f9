"""Compiler of the JSON zoom filters of layers to one boolean Column.

``any, all, none, ==, !=, <, <=, >, >=, in, !in, has, !has``; ``$zoom`` is the zoom column.  A missing attribute (null)
satisfies only ``!=``, ``!in`` and ``!has``.  Layer filters are keyed by layer id, ``*`` holds for all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ORDER = {"<": "__lt__", "<=": "__le__", ">": "__gt__", ">=": "__ge__"}


def _compile(x: list, zoom: Column, columns: set[str]) -> Column:
    op, *args = x
    if op in ("any", "all", "none"):
        parts = [_compile(a, zoom, columns) for a in args]
        if op == "all":
            return reduce(lambda a, b: a & b, parts, F.lit(True))
        some = reduce(lambda a, b: a | b, parts, F.lit(False))
        return some if op == "any" else ~some
    key, *values = args
    if key == "$zoom":
        of = zoom
    elif key in columns:
        of = F.col(key)
    else:
        of = F.lit(None)
    if op == "has":
        return of.isNotNull()
    if op == "!has":
        return of.isNull()
    if op == "==":
        return F.coalesce(of == F.lit(values[0]), F.lit(False)) if values[0] is not None else of.isNull()
    if op == "!=":
        return F.coalesce(of != F.lit(values[0]), F.lit(True))
    if op in ORDER:
        return F.coalesce(getattr(of, ORDER[op])(F.lit(values[0])), F.lit(False))
    if op == "in":
        return F.coalesce(of.isin(*values), F.lit(False)) if values else F.lit(False)
    if op == "!in":
        return F.coalesce(~of.isin(*values), F.lit(True)) if values else F.lit(True)
    raise ValueError(f"unknown filter operator {op!r}")


def compile_filter(filters: dict | None, layer: str, zoom: Column, columns: list[str]) -> Column:
    """What holds for the layer and for all layers; true where nothing is said."""
    said = [f for k, f in (filters or {}).items() if k in ("*", layer)]
    return reduce(lambda a, b: a & b, [_compile(f, zoom, set(columns)) for f in said], F.lit(True))

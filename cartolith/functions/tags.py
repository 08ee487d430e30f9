"""Lifecycle of a tagged feature: one scheme for all line layers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null

# The states a feature can be in, in the order of detection, and those that a bare key can flag.
STATES = ["construction", "proposed", "planned", "disused", "abandoned", "destroyed", "demolished", "razed", "removed"]
FLAGS = ["disused", "abandoned", "destroyed", "demolished", "razed", "removed"]


def _prefix(key: Column, base: str) -> Column:
    """The state that prefixes a key, as in abandoned:railway."""
    low = F.lower(key)
    state = F.split_part(low, F.lit(":"), F.lit(1))
    return F.when((F.split_part(low, F.lit(":"), F.lit(2)) == base.lower()) & state.isin(STATES), state)


def _value(value: Column) -> Column:
    v = F.lower(F.trim(value))
    return F.when(v == "ruins", "abandoned").when(v.isin(STATES), v)


def _first(states: list[str], test) -> Column:
    return F.coalesce(*(F.when(test(s), F.lit(s)) for s in states))


def lifecycle_type(key: Column, value: Column, tags: Column, base: str) -> Column:
    """Prefix of the key, else the value, else a prefixed tag, else a bare flag other than no, else intact."""
    tagged = _first(STATES, lambda s: blank_to_null(tags[f"{s}:{base}"], trim=True).isNotNull())
    flagged = _first(FLAGS, lambda s: ~F.lower(F.trim(tags[s])).isin("", "no"))
    return F.coalesce(_prefix(key, base), _value(value), tagged, flagged, F.lit("intact"))


def lifecycle_subject(key: Column, value: Column, tags: Column, base: str, fallback: Column) -> Column:
    """What the feature is, whatever its state."""
    v = F.lower(F.trim(value))
    told = lambda k: F.nullif(blank_to_null(F.lower(F.trim(F.try_element_at(tags, k)))), F.lit("yes"))
    return (
        F.when(_prefix(key, base).isNotNull(), v)
        .when(_value(value).isNotNull(), F.coalesce(told(v), told(F.concat(v, F.lit(f":{base}"))), fallback))
        .otherwise(value)
    )

"""Column builders over strings: names, numbers, similarity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column, trim: bool = False) -> Column:
    """NULL for the empty string, which sources store for a missing value."""
    return F.nullif(F.trim(c) if trim else c, F.lit(""))


def name_of(*names: Column, trim: bool = False) -> Column:
    """The first name that is neither null nor empty.  Both variants exist among the layers: with and without trimming."""
    return F.coalesce(*(blank_to_null(c, trim) for c in names))


def any_like(c: Column, patterns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.like(p) for p in patterns])


def any_ilike(c: Column, patterns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.ilike(p) for p in patterns])


def replace_all(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """Literal replacements, one after the other."""
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, c)


def trigrams(c: Column) -> Column:
    """Set of the three-grams of each word of letters and digits, padded with two blanks before and one after."""
    words = F.filter(F.split(F.lower(c), "[^\\p{L}\\p{N}]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    grams = F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def similarity(a: Column, b: Column) -> Column:
    """Shared over all trigrams; null where either is null, 0 where neither has any."""
    x, y = trigrams(a), trigrams(b)
    every = F.size(F.array_union(x, y))
    return F.when(a.isNotNull() & b.isNotNull(), F.when(every > 0, F.size(F.array_intersect(x, y)) / every).otherwise(0.0))


def similar(a: Column, b: Column, least: float = 0.3) -> Column:
    return similarity(a, b) >= least


def first_match(c: Column, rules: list[tuple[str, str]], other: Column) -> Column:
    """The label of the first rule whose regular expression is found; null stays null."""
    out = reduce(lambda w, r: w.when(c.rlike(r[0]), r[1]) if w is not None else F.when(c.rlike(r[0]), r[1]), rules, None)
    return F.when(c.isNotNull(), out.otherwise(other))


def to_int(c: Column) -> Column:
    """Half-even rounding to integer, as SQL casts from float round; a plain cast truncates."""
    return F.rint(c).cast("int")

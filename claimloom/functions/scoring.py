"""Weighted scores with their components.

A score is a sum of named rules, each a condition with a weight; the components that are not
zero come out as a sorted map, so that every score can be explained. The weights are the caller's.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def components(rules: Mapping[str, tuple[Column, int | Column]]) -> Column:
    """map of the rules that hold to their weights, by name."""
    parts = [F.struct(F.lit(name).alias("key"), F.when(F.coalesce(cond, F.lit(False)), F.lit(w) if isinstance(w, int) else w).otherwise(F.lit(0)).cast("int").alias("value")) for name, (cond, w) in sorted(rules.items())]
    return F.map_from_entries(F.filter(F.array(*parts), lambda p: p["value"] != 0))


def total(rules: Mapping[str, tuple[Column, int | Column]], base: int = 0, low: int | None = None, high: int | None = None) -> Column:
    score = F.lit(base)
    for cond, w in rules.values():
        score = score + F.when(F.coalesce(cond, F.lit(False)), F.lit(w) if isinstance(w, int) else w).otherwise(F.lit(0))
    if low is not None:
        score = F.greatest(score, F.lit(low))
    if high is not None:
        score = F.least(score, F.lit(high))
    return score.cast("int")


def first_reason(ordered: list[tuple[str, Column]], otherwise: str = "") -> Column:
    """The name of the first condition that holds."""
    out = F.lit(otherwise)
    for name, cond in reversed(ordered):
        out = F.when(F.coalesce(cond, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def reasons(rules: Mapping[str, Column]) -> Column:
    """Names of all conditions that hold, in order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))

"""Naming a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(values: dict[str, Column], use: Callable[[dict[str, Column]], Column]) -> Column:
    """use(values) with each value computed once, however often use mentions it; keeps nested formulas small."""
    one = F.array(F.struct(*[v.alias(k) for k, v in values.items()]))
    return F.element_at(F.transform(one, lambda s: use({k: s[k] for k in values})), 1)

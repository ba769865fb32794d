"""Name an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once, however often `use` mentions it.

    Common subexpressions are not shared inside conditionals, generators or next to
    lambdas, so a regex result that is tested and then used would be computed twice.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def unless_empty(text: Column) -> Column:
    """NULL instead of the empty string."""
    return let(text, lambda t: F.when(t != "", t))

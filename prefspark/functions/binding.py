"""Naming an intermediate value inside an expression."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, however often `use` mentions it."""
    return F.transform(F.array(value), use)[0]

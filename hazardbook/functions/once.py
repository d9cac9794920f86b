"""A value that an expression uses several times, worked out once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``. A column that is named twice in an expression is worked out twice,
    and again for each level of nesting; the variable of a lambda function is not."""
    return F.get(F.transform(F.array(value), use), F.lit(0))

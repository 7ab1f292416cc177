"""Sort keys with explicit NULL placement.

The marts follow the SQL convention in which NULL counts as the largest value:
first under descending order and last under ascending order. Spark's default is
the opposite, so every ordering in this package is written through ``SortKey``.
"""

from __future__ import annotations

from typing import Any, NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class SortKey(NamedTuple):
    name: str
    descending: bool = False

    def column(self) -> Column:
        c = F.col(self.name)
        return c.desc_nulls_first() if self.descending else c.asc_nulls_last()

    def after(self, value: Any) -> Column:
        """True where the row sorts strictly after ``value``."""
        c = F.col(self.name)
        if self.descending:  # NULL first: only a NULL bound has NULL rows beside it
            return c.isNotNull() if value is None else F.coalesce(c < F.lit(value), F.lit(False))
        return F.lit(False) if value is None else F.coalesce(c > F.lit(value), F.lit(True))

    def same(self, value: Any) -> Column:
        return F.col(self.name).isNull() if value is None else F.col(self.name).eqNullSafe(F.lit(value))


def largest_first(name: str) -> Column:
    return SortKey(name, descending=True).column()


def smallest_first(name: str) -> Column:
    return SortKey(name).column()

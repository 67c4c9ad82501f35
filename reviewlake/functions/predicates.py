"""Boolean column expressions used by the quality checks."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def any_of(conditions: Iterable[Column]) -> Column:
    """OR over any number of conditions; FALSE for none."""
    return reduce(or_, conditions, F.lit(False))


def is_blank(value: Column) -> Column:
    """NULL, empty, or nothing but spaces."""
    return value.isNull() | (F.trim(value.cast("string")) == "")


def lossy_cast(value: Column, data_type: T.DataType) -> Column:
    """A value is present but cannot be read as the wanted type."""
    return value.isNotNull() & value.try_cast(data_type).isNull()

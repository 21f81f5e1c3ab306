"""Null conditions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_present(*names: str) -> Column:
    """True where none of the columns is null.

    ``na.drop`` keeps the same rows, but as one opaque condition that no scan can use; separate
    null checks reach the files.
    """
    return reduce(Column.__and__, (F.col(name).isNotNull() for name in names))

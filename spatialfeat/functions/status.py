"""Status of a row: the first failure wins, and a patch that failed as a whole keeps nothing but its keys and a message."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import STATUS_ERROR


def blank_on_error(status: Column) -> Callable[[Column], Column]:
    """Makes values null on rows that failed as a whole."""
    return lambda value: F.when(status != STATUS_ERROR, value)

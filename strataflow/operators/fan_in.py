"""Several inputs into one append-only table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def fan_in(inputs: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; a column missing on one side is NULL there."""
    if not inputs:
        raise ValueError("fan_in needs at least one input")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), inputs)

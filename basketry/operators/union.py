"""Combining event sets written with different column sets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_event_sets(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column missing from one input is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

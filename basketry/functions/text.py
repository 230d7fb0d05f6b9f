"""Identifier formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded_id(prefix: str, number: Column | str, width: int = 4) -> Column:
    """``prefix`` + number zero-padded to ``width`` digits, never cut
    (12345 -> ``U12345``; a bare ``lpad`` would truncate). Null stays null."""
    num = F.col(number) if isinstance(number, str) else number
    return F.when(num.isNotNull(), F.format_string(f"{prefix}%0{width}d", num))

"""Formatting expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(c, decimals: int = 4) -> Column:
    """Fixed-decimal text, like Python's ``f"{x:.4f}"``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.format_string(f"%.{decimals}f", c)


def percent_text(c, decimals: int = 2) -> Column:
    """``12.34%`` text for a value already in percent."""
    return F.concat(fixed(c, decimals), F.lit("%"))

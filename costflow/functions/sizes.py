"""Byte counts for people."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The unit names, 1024 apart.
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB")


def human_bytes(size: Column) -> Column:
    """`1536` as `1.50 KB`, two digits, halves to even."""
    text = None
    for power, unit in enumerate(SIZE_UNITS):
        # Division by a power of two is exact, so a half is a true half here.
        scaled = F.bround(size.cast("double") / F.lit(float(1024**power)), 2)
        shown = F.format_string(f"%.2f {unit}", scaled)
        below = size < F.lit(1024 ** (power + 1))
        if text is None:
            text = F.when(below, shown)
        elif unit == SIZE_UNITS[-1]:
            text = text.otherwise(F.when(size.isNotNull(), shown))
        else:
            text = text.when(below, shown)
    return text

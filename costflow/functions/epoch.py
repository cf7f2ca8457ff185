"""Integer epochs of unknown unit to zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from costflow.sqltext import quote

# An epoch counts only from 2000-01-01 to 2100-01-01, both included.
FIRST_SECOND = 946_684_800
LAST_SECOND = 4_102_444_800

# Ticks per second, and the least value with the number of digits
# by which a unit is told (10, 16, 19). Milliseconds also take any other length.
UNITS = (
    (1, 10**9),
    (10**3, 0),
    (10**6, 10**15),
    (10**9, 10**18),
)

ORIGIN = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_sql(value: str, precision: str = "seconds", strict: bool = True) -> str:
    """SQL text turning the BIGINT expression `value` into a TIMESTAMP_NTZ.

    Digit count and calendar guard together leave one interval per unit, and the
    four intervals do not overlap. So each value is told by integer comparison
    alone; anything outside gives null. `strict=False` also takes the shorter
    numbers that lie between 2000-01-01 and 2001-09-09.

    `precision` is "seconds" (drops the fraction) or "micros" (keeps it).
    The result does not depend on the session time zone.
    """
    if precision not in ("seconds", "micros"):
        raise ValueError(f"precision must be 'seconds' or 'micros', not {precision!r}")
    wanted = 1 if precision == "seconds" else 10**6
    branches = []
    for per_second, least in UNITS:
        low = FIRST_SECOND * per_second
        if strict:
            low = max(low, least)
        high = LAST_SECOND * per_second
        scaled = value
        if per_second > wanted:
            scaled = f"{value} div {per_second // wanted}L"
        elif per_second < wanted:
            scaled = f"{value} * {wanted // per_second}L"
        branches.append(f"WHEN {value} BETWEEN {low}L AND {high}L THEN {scaled}")
    tick = "SECOND" if precision == "seconds" else "MICROSECOND"
    return f"timestampadd({tick}, CASE {' '.join(branches)} END, {ORIGIN})"


def epoch_to_ntz(column: str, precision: str = "seconds", strict: bool = True) -> Column:
    """`epoch_sql` for a column given by name."""
    return F.expr(epoch_sql(f"CAST({quote(column)} AS BIGINT)", precision, strict))

"""Display formatting for the dashboard rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NA = "N/A"


def time_of_day(key: str | Column) -> Column:
    """``'2024-01-05 13:00:00'`` -> ``'13:00:00'`` (the part after the space)."""
    c = F.col(key) if isinstance(key, str) else key
    return F.split(c, " ").getItem(1)


def two_dp(x: str | Column, zero_as_na: bool = False) -> Column:
    """Two-decimal text; null -> ``N/A`` (and 0 too when ``zero_as_na``).

    ``format_string`` of a null gives text, not null, so the null test has to
    come first rather than a ``coalesce`` around it.
    """
    c = F.col(x) if isinstance(x, str) else x
    missing = c.isNull() | (c == 0) if zero_as_na else c.isNull()
    return F.when(missing, F.lit(NA)).otherwise(_fixed_two(c))


def _fixed_two(c: Column) -> Column:
    """Two decimals of the binary value, as the page rounds it (1.005 is a bit less, so 1.00).

    The fraction is split in two parts of at most 27 bits, whose products with
    200 are exact, so the comparison with the half-way point is, too.  Beyond
    2**40 a double has no half cents to tell apart.
    """
    x = F.abs(c.cast("double"))
    whole = F.floor(x).cast("double")
    fraction = x - whole
    high = F.floor(fraction * float(1 << 26)).cast("double") / float(1 << 26)
    cents = F.floor(fraction * 100)
    above = ((high * 200 - (2 * cents + 1)) + (fraction - high) * 200) >= 0
    total = F.floor(x) * 100 + cents + above.cast("long")
    text = F.concat(
        F.when(c < 0, "-").otherwise(""), F.floor(total / 100).cast("string"), F.lit("."), F.lpad((total % 100).cast("string"), 2, "0")
    )
    return F.when(x < float(1 << 40), text).otherwise(F.format_string("%.2f", c))

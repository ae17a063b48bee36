"""Order-independent numeric aggregates and ANSI-safe statistics.

Floating-point sums depend on the order rows arrive in, which differs between
runs, partitionings and engines. Grouped sums that feed a rounded output are
therefore taken in DECIMAL (exact, associative) and converted to DOUBLE once.
All of these stay JVM-side and inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Per-value precision for exact sums: 6 decimals, 18 integer digits.
EXACT = "decimal(24,6)"
# Precision for exact second moments: x*x stays exact at decimal(33,12).
MOMENT = "decimal(16,6)"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def no_nan(c: str | Column) -> Column:
    """A double with NaN, the missing value of some producers, read as NULL."""
    return F.nanvl(col_(c).cast("double"), F.lit(None).cast("double"))


def exact_sum(c: str | Column) -> Column:
    """DECIMAL sum (exact, order-independent); NULL when all inputs are NULL or NaN."""
    return F.sum(no_nan(c).cast(EXACT))


def exact_avg(c: str | Column) -> Column:
    """Mean ignoring NULL and NaN: exact sum converted to double, then one division."""
    x = no_nan(c)
    n = F.count(x)
    return F.when(n > 0, exact_sum(x).cast("double") / n)


def quantized_mean(total: Column, n: Column, digits: int = 6, total_scale: int = 6) -> Column:
    """HALF_UP(total / n) at ``digits`` decimals, computed in integers.

    ``total`` must be an exact DECIMAL of scale ``total_scale`` (>= digits).
    Integer arithmetic makes the result identical in every engine, ties
    included; NULL when ``n`` is 0.
    """
    unit = 10 ** (total_scale - digits)
    si = (total * F.lit(10**total_scale)).cast("bigint")
    a = F.abs(si) * 2 + n * unit
    b = n * (2 * unit)
    q = (a - F.pmod(a, b)) / b
    return F.when(n > 0, F.signum(si) * q / F.lit(float(10**digits)))


def round_exact(x: str | Column, digits: int) -> Column:
    """Display rounding of a derived double: DECIMAL HALF_UP, back to DOUBLE."""
    return F.round(col_(x).cast(EXACT), digits).cast("double")


def quantize(x: Column, digits: int = 6) -> Column:
    """Round a derived double to ``digits`` decimals with plain double ops.

    ``floor(x * 10^d + 0.5) / 10^d`` evaluates identically in every IEEE
    engine, unlike decimal casts whose tie rules differ.
    """
    scale = float(10**digits)
    return F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def mean_of_nonnull(cols: list[Column]) -> Column:
    """Row-wise mean of the non-NULL entries of ``cols`` (NULL if none)."""
    total = None
    count = None
    for c in cols:
        v = F.coalesce(c, F.lit(0.0))
        k = F.when(c.isNotNull(), F.lit(1)).otherwise(F.lit(0))
        total = v if total is None else total + v
        count = k if count is None else count + k
    return F.when(count > 0, total / count)

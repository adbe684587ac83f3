"""Half-up rounding of a double on its exact binary value.

The original job rounds a ratio with ``new BigDecimal(d).setScale(2, HALF_UP)``:
the *exact* binary value of ``d`` is rounded, so 3/40 (stored as
0.07499999…) becomes 0.07, while Spark's ``round`` (and DuckDB's) round the
shortest decimal text and give 0.08. We reproduce the exact rule with integer
arithmetic on Spark columns:

    d     = |value|                       the sign comes back at the end: half away from 0
    f     = d - floor(d)                  exact for d >= 0
    m     = f * 2^61 as bigint            exact whenever f >= 2^-8; below
                                          that the result is 0 either way
    units = floor((m * 2u + 2^61) / 2^62) = floor(f * u + 1/2), u = 10^scale
    out   = (floor(d) * u + units) / u

``m * 2u`` overflows 64 bits, so the division is done on the two 31-bit
halves of ``m`` with shifts (exact, no decimal rounding involved).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_61 = 2305843009213693952
TWO_62 = 4611686018427387904
_LOW31 = (1 << 31) - 1


def half_up(d: Column, scale: int = 2) -> Column:
    """Round a double column half-up (a half away from zero) at ``scale`` decimals."""
    unit = 10 ** scale
    if 2 * unit * (1 << 30) >= 1 << 62:
        raise ValueError("scale too large for exact half-up")
    size = F.abs(d)
    whole = F.floor(size)
    m = ((size - whole) * F.lit(float(TWO_61))).cast("bigint")
    hi = F.shiftright(m, 31)
    lo = m.bitwiseAND(F.lit(_LOW31))
    a = hi * (2 * unit)
    b = lo * (2 * unit) + F.lit(TWO_61)
    units = F.shiftright(a + F.shiftright(b, 31), 31)
    out = (whole.cast("bigint") * unit + units).cast("double") / F.lit(float(unit))
    return F.signum(d) * out + F.lit(0.0)  # no -0.0


def half_up_sql(d: str, scale: int = 2) -> str:
    """Spark SQL text of :func:`half_up` for the SQL expression ``d``."""
    unit = 10 ** scale
    size = f"abs({d})"
    m = f"CAST(({size} - floor({size})) * {float(TWO_61)!r}D AS BIGINT)"
    a = f"shiftright({m}, 31) * {2 * unit}"
    b = f"(({m} & {_LOW31}) * {2 * unit} + {TWO_61}L)"
    units = f"shiftright({a} + shiftright({b}, 31), 31)"
    out = f"CAST(CAST(floor({size}) AS BIGINT) * {unit} + {units} AS DOUBLE) / {float(unit)!r}D"
    return f"(signum({d}) * {out} + 0.0D)"


def ratio_sql(numerator: str, denominator: str, scale: int = 2) -> str:
    """Spark SQL text of :func:`ratio`."""
    return half_up_sql(f"try_divide(CAST({numerator} AS DOUBLE), CAST({denominator} AS DOUBLE))", scale)


def ratio(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """``half_up(numerator / denominator)``; NULL when the denominator is 0."""
    d = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return half_up(d, scale)


def half_up_reference(d: float, scale: int = 2) -> float:
    """Pure-Python statement of the rule (for tests): Decimal of the exact double."""
    from decimal import ROUND_HALF_UP, Decimal

    return float(Decimal(d).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP))

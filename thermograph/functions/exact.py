"""Exact arithmetic on measures.

Means are rounded half-even to two digits, which meets exact ties often, so the
exact mode holds every value as whole numbers, sums those as BIGINT, and rounds
the quotient with integer arithmetic: no value is rounded before it is summed, no
order of additions changes a result, and differences of growing sums are exact.
How a value is held (:class:`Held`) depends on the type of its column:

* DECIMAL with up to ``UNIT_PLACES`` places: one whole number of units of its last
  place ("cents" where it has two by definition);
* DECIMAL with more places: its whole part and digits of base 10**9;
* FLOAT and DOUBLE: the whole part and digits of base 2**24 of its binary value,
  so many that the smallest value keeps its last bit (one aggregate looks for it).
  NaN and infinite values are read as missing.

Everything stays in BIGINT arithmetic inside whole-stage codegen.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Most decimal places that are held as one number of units.
UNIT_PLACES = 6
DECIMAL_BASE, BINARY_BASE, BINARY_BITS = 10**9, 1 << 24, 24
INFINITY = float("inf")


def to_cents(c: Column | str) -> Column:
    """DECIMAL(p,2) (or any numeric with two digits) -> BIGINT hundredths."""
    c = F.col(c) if isinstance(c, str) else c
    return (c.cast("decimal(18,2)") * 100).cast("bigint")


@dataclass(frozen=True)
class Held:
    """How the values of the measure ``name`` are held as whole numbers.

    ``base`` 0: one number of units of ``10 ** -scale``.  Else the whole part and
    ``places`` digits of ``base`` behind it; all digits of a binary value carry its
    sign, decimal ones count up from the whole number below."""
    name: str
    scale: int = 2
    base: int = 0
    places: int = 0

    @property
    def parts(self) -> list[str]:
        """Names of the numbers; the first is null where the value is missing."""
        return [self.name] + [f"{self.name}_{k}" for k in range(1, self.places + 1)]

    def values(self, column: Column | str | None = None) -> dict[str, Column]:
        """The numbers (BIGINT) of ``column``, by part."""
        column = self.name if column is None else column
        c = F.col(column) if isinstance(column, str) else column
        if not self.base:
            return {self.name: to_units(c, self.scale)}
        if self.base == DECIMAL_BASE:
            below = F.floor(c)
            rest = (c - below).cast("decimal(18,18)") * F.lit(10**18).cast("decimal(19,0)")
            rest = rest.cast("bigint")
            high, low = F.call_function("div", rest, F.lit(DECIMAL_BASE)), rest % F.lit(DECIMAL_BASE)
            return dict(zip(self.parts, [below.cast("bigint"), high, low], strict=True))
        size = F.abs(c.cast("double"))
        size = F.when(size < F.lit(INFINITY), size)
        sign = F.when(c < 0, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
        out = [size.cast("bigint")]
        for k in range(1, self.places + 1):
            # What stands behind digit k - 1, then so far to the left that digit k
            # is whole: remainders and powers of two are exact.
            rest = size % F.lit(2.0 ** (-BINARY_BITS * (k - 1)))
            far = BINARY_BITS * k
            shifted = rest * F.lit(2.0 ** min(far, 1000)) * F.lit(2.0 ** max(far - 1000, 0))
            out.append(shifted.cast("bigint"))
        return {p: x * sign for p, x in zip(self.parts, out, strict=True)}

    def mean(self, total: Callable[[str], str], n: str) -> Column:
        """Half-even mean in hundredths (BIGINT) from the names of the columns with
        the parts' sums and of the count; null for a count of 0."""
        if not self.base:
            return half_even_div(total(self.name), hundredths(n, self.scale))
        return _half_even_digits([F.col(total(p)) for p in self.parts], F.col(n), self.base)

    def exact(self, sums: list[int]) -> tuple[int, int]:
        """The sum of values as a fraction (numerator, denominator)."""
        if not self.base:
            return sums[0], 10**self.scale
        out = 0
        for x in sums:
            out = out * self.base + x
        return out, self.base**self.places


def held(df: DataFrame, *measures: str) -> dict[str, Held]:
    """How the named measures of ``df`` are held.  FLOAT and DOUBLE take one
    aggregate over ``df`` (a row to the driver), DECIMAL none."""
    out: dict[str, Held] = {}
    binary: dict[str, int] = {}
    for m in measures:
        t = df.schema[m].dataType
        if isinstance(t, (T.FloatType, T.DoubleType)):
            binary[m] = 24 if isinstance(t, T.FloatType) else 53
        elif isinstance(t, T.DecimalType) and t.scale > UNIT_PLACES:
            if t.scale > 18 or t.precision - t.scale > 18:
                raise ValueError(f"{m}: DECIMAL of up to 18 digits before and behind the point, "
                                 f"not {t.simpleString()}")
            out[m] = Held(m, base=DECIMAL_BASE, places=2)
        else:
            out[m] = Held(m, scale=max(2, t.scale) if isinstance(t, T.DecimalType) else 2)
    if binary:
        size = {m: F.abs(F.col(m).cast("double")) for m in binary}
        least = df.agg(*[F.min(F.when((c > 0) & (c < F.lit(INFINITY)), c)).alias(m)
                         for m, c in size.items()]).first()
        for m, bits in binary.items():
            out[m] = Held(m, base=BINARY_BASE, places=binary_places(least[m], bits))
    return out


def binary_places(least: float | None, bits: int) -> int:
    """Digits behind the point that hold a number of ``bits`` bits, and all larger."""
    if least is None:
        return 1
    last = min(math.frexp(least)[1] - bits, 0)
    return max(1, -(-min(-last, 1074) // BINARY_BITS))


def _half_even_digits(sums: list[Column], n: Column, base: int) -> Column:
    """round_half_even(100 * sum / n) for a sum given by digits, the whole part first.

    One pass from the last digit on carries what exceeds the base, multiplies by a
    hundred and carries again; the whole part takes in both, and of the digits only
    the first and whether any other is left count."""
    def over(x: Column) -> Column:
        """``x`` divided by the base, rounded down."""
        if base == BINARY_BASE:
            return F.shiftright(x, BINARY_BITS)
        return F.call_function("div", x - F.pmod(x, F.lit(base)), F.lit(base))

    def step(state: Column, digit: Column) -> Column:
        sum_ = digit + state["carry"]
        hundred = F.pmod(sum_, F.lit(base)) * 100 + state["up"]
        return F.struct(over(sum_).alias("carry"), over(hundred).alias("up"),
                        F.pmod(hundred, F.lit(base)).alias("first"),
                        (state["below"] | (state["first"] > 0)).alias("below"))

    zero = F.lit(0).cast("bigint")
    start = F.struct(zero.alias("carry"), zero.alias("up"), zero.alias("first"),
                     F.lit(False).alias("below"))
    end = F.aggregate(F.array(*reversed(sums[1:])), start, step)
    half = base // 2

    def rounded(x: Column) -> Column:
        b, first, below = x["rest"], x["first"], x["below"]
        some, more = (first > 0) | below, (first > half) | ((first == half) & below)
        up = (2 * b > n) | ((2 * b == n) & some) | ((2 * b == n - 1) & more)
        tie = ((2 * b == n) & ~some) | ((2 * b == n - 1) & (first == half) & ~below)
        return x["q"] + (up | (tie & (F.pmod(x["q"], F.lit(2)) == 1))).cast("bigint")

    # A list of one, so that each step is computed once and named in the next.
    def divided(x: Column) -> Column:
        rest = F.pmod(x["whole"], n)
        return F.struct(F.call_function("div", x["whole"] - rest, n).alias("q"), rest.alias("rest"),
                        x["first"].alias("first"), x["below"].alias("below"))

    whole = F.transform(F.array(end), lambda e: F.struct(
        ((sums[0] + e["carry"]) * 100 + e["up"]).alias("whole"), e["first"].alias("first"),
        e["below"].alias("below")))
    return F.when(n > 0, F.get(F.transform(F.transform(whole, divided), rounded), F.lit(0)))


def to_units(c: Column | str, scale: int) -> Column:
    """A measure as a whole number of ``10 ** -scale`` (BIGINT)."""
    c = F.col(c) if isinstance(c, str) else c
    return (c.cast(f"decimal({16 + scale},{scale})") * F.lit(10 ** scale)).cast("bigint")


def hundredths(n: str, scale: int) -> str:
    """The divisor that turns a sum of ``n`` values in units of ``10 ** -scale``
    into a mean in hundredths (SQL text for :func:`half_even_div`)."""
    return n if scale == 2 else f"{n} * {10 ** (scale - 2)}L"


def half_even_div(s: str, n: str) -> Column:
    """round_half_even(s / n) for BIGINT SQL expressions ``s`` and ``n``.

    Null when n is 0 or null.  With r = pmod(s, n) in [0, n) and
    q = (s - r) div n (exact), go up when 2r > n, and on 2r = n go up only
    if q is odd.
    """
    r = f"pmod({s}, {n})"
    q = f"(({s}) - {r}) div ({n})"
    return F.expr(
        f"CASE WHEN ({n}) > 0 THEN {q} + CASE WHEN 2 * {r} > ({n}) THEN 1 "
        f"WHEN 2 * {r} = ({n}) AND pmod({q}, 2) = 1 THEN 1 ELSE 0 END END")


def cents_to_double(c: Column | str) -> Column:
    """BIGINT hundredths -> DOUBLE (IEEE division, same in every engine)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double") / F.lit(100.0)


def mean_2dp(s: str, n: str) -> Column:
    """Half-even two-digit mean of a cents sum, as DOUBLE."""
    return cents_to_double(half_even_div(s, n))

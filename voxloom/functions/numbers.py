"""Numbers in messages: decimals of a double, rounded as its exact binary value rounds, ties to even.

`format_string` and `round` start from the shortest decimal that reads back as the double, so 1.95, whose value lies
just under, becomes 2.0 there and 1.9 here. Here all is integer arithmetic on the part after the point, which is a whole
number of 2^-(53 + e) when it is under 2^-e.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# from here on a double has no part after the point
WHOLE = float(1 << 53)
# a part after the point under 2^-11 is less than half of the third decimal
DEEPEST = 11


def _let(values: dict[str, Column], then: Callable[[Column], Column]) -> Column:
    """then(struct of values), each of them computed once."""
    return F.element_at(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), then), 1)


def fixed(x: Column, digits: int) -> Column:
    """x with so many decimals, 0 to 3; `nan`, `inf` and `-inf` by name, null for null.

    A negative number that rounds to zero keeps its sign, -0.0 too. From 2^63 on the digits are the platform's.
    """
    if digits not in (0, 1, 2, 3):
        raise ValueError("digits must be 0 to 3")
    ten, point = 10**digits, "." if digits else ""
    x = x.cast("double")

    def scaled(v: Column) -> Column:
        deep = sum((F.when(v["rest"] < 2.0**-e, 1).otherwise(0) for e in range(1, DEEPEST + 1)), F.lit(0))
        shift = F.lit(53) + F.least(deep, F.lit(DEEPEST - 1))
        n = (v["rest"] * F.pow(F.lit(2.0), shift.cast("double"))).cast("long") * F.lit(ten)
        return _let({"n": n, "shift": shift, "flat": deep == DEEPEST, "base": v["whole"] * F.lit(ten)}, rounded)

    def rounded(v: Column) -> Column:
        # a shift by 63 leaves nothing, and only the comparison with half of it is needed
        q = F.call_function("shiftright", v["n"], v["shift"])
        low = v["n"] - F.call_function("shiftleft", q, v["shift"])
        half = F.call_function("shiftleft", F.lit(1).cast("long"), v["shift"] - 1)
        odd = F.pmod(v["base"] + q, F.lit(2)) == 1
        up = ~v["flat"] & ((low > half) | ((low == half) & odd))
        return v["base"] + F.when(v["flat"], F.lit(0).cast("long")).otherwise(q) + F.when(up, 1).otherwise(0)

    def written(v: Column) -> Column:
        # `div`, as a quotient of doubles would lose digits
        before = F.call_function("div", v["total"], F.lit(ten)) if digits else v["total"]
        after = F.lpad((v["total"] % ten).cast("string"), digits, "0") if digits else F.lit("")
        return F.concat(before.cast("string"), F.lit(point), after)

    size = F.least(F.abs(x), F.lit(WHOLE))
    whole = F.floor(size).cast("long")
    small = _let({"total": _let({"whole": whole, "rest": size - whole.cast("double")}, scaled)}, written)
    large = F.when(F.abs(x) < float(1 << 63), F.concat(F.abs(x).cast("long").cast("string"), F.lit(point + "0" * digits))).otherwise(F.format_string(f"%.{digits}f", F.abs(x)))
    sign = F.when(x.cast("string").startswith("-"), "-").otherwise("")
    named = F.when(F.isnan(x), "nan").when(F.abs(x) == float("inf"), F.concat(sign, F.lit("inf")))
    return F.when(x.isNull(), None).otherwise(F.coalesce(named, F.concat(sign, F.when(F.abs(x) < WHOLE, small).otherwise(large))))


def percent(x: Column, digits: int) -> Column:
    """A share as a percentage with so many decimals."""
    return F.concat(fixed(x.cast("double") * 100, digits), F.lit("%"))

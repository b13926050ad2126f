"""Money amounts: parsing, matching, display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recsieve.functions.text import bound

NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def parse_amount(c: Column) -> Column:
    """Dollars as a long: `$`, `,` and a final B, M or K are understood, anything else is 0, fractions are cut off.

    A double times the multiplier is truncated, so `$4.1M` is 4099999. Digits may be grouped by `_`. Infinity is 0.
    """
    s = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"[$,]", ""), r"(?U)^\s+|\s+$", "")
    return bound(s, _parse)


def _parse(s: Column) -> Column:
    last = F.upper(F.substring(s, -1, 1))
    times = F.when(last == "B", 1e9).when(last == "M", 1e6).when(last == "K", 1e3).otherwise(1.0)
    body = F.when(last.isin("B", "M", "K"), F.substr(s, F.lit(1), F.length(s) - 1)).otherwise(s)
    body = F.regexp_replace(F.regexp_replace(body, r"(?U)^\s+|\s+$", ""), r"(?<=[0-9])_(?=[0-9])", "")
    value = bound(body, lambda b: F.when(b.rlike(NUMBER), b.try_cast("double"))) * times
    return bound(value, lambda v: F.coalesce(F.when(F.abs(v) < 9.2e18, v).cast("long"), F.lit(0).cast("long")))


def amounts_match(a: Column, b: Column, tolerance: float = 0.05) -> Column:
    """Within the tolerance of the larger; zero matches zero only. A division, as products round otherwise."""
    return F.when((a == 0) | (b == 0), a == b).otherwise(F.abs(a - b) / F.greatest(a, b) <= tolerance)


def _tenths(a: Column, unit: int) -> Column:
    """a / unit as a decimal fraction of one digit, rounded as the binary double a / unit is: exact, halves to even.

    Only halfway cases depend on the double: it is scaled by a power of two to an exact whole number and compared with the half.
    """
    tenth = unit // 10
    low = F.floor(a / tenth).cast("long")
    rest = a - low * tenth
    x = a.cast("double") / float(unit)
    bits = F.when(x < 1024, 52).when(x < 2.0**21, 42).otherwise(32)
    scaled = F.when(x < 1024, x * 2.0**52).when(x < 2.0**21, x * 2.0**42).otherwise(x * 2.0**32).cast("long").cast("decimal(20,0)")
    half = (low * 2 + 1).cast("decimal(18,0)") * F.when(bits == 52, F.lit(1 << 52)).when(bits == 42, F.lit(1 << 42)).otherwise(F.lit(1 << 32)).cast("decimal(17,0)")
    up = F.when(scaled * F.lit(20).cast("decimal(2,0)") == half, low % 2 == 1).otherwise(scaled * F.lit(20).cast("decimal(2,0)") > half)
    n = low + F.when(rest * 2 > tenth, 1).when(rest * 2 < tenth, 0).otherwise(up.cast("int"))
    return F.concat(F.floor(n / 10).cast("long").cast("string"), F.lit("."), (n % 10).cast("string"))


def format_amount(a: Column) -> Column:
    """`$1.5B`, `$31M`, `$4.2M`, `$750K`, `$999`; `$0` for zero and below. No carry between units."""
    dollar = lambda x, unit: F.concat(F.lit("$"), x, F.lit(unit))
    whole = F.floor(a / 1000000).cast("long").cast("string")
    return (
        F.when(a >= 1000000000, dollar(_tenths(a, 1000000000), "B"))
        .when((a >= 1000000) & (a % 1000000 == 0), dollar(whole, "M"))
        .when(a >= 1000000, dollar(_tenths(a, 1000000), "M"))
        .when(a >= 1000, dollar(F.bround(a / 1000, 0).cast("long").cast("string"), "K"))
        .when(a > 0, dollar(a.cast("string"), ""))
        .otherwise("$0")
    )

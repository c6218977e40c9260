"""Numbers as texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, f) -> Column:
    """f(value), the value computed once."""
    return F.transform(F.array(value), f)[0]


def significant(value: Column, digits: int = 4) -> Column:
    """A number to so many significant digits, without trailing zeros; large and small ones with an exponent."""
    def text(v: Column) -> Column:
        parts = F.split(F.format_string(f"%.{digits - 1}e", F.abs(v)), "e")
        power, plain = parts[1].cast("int"), F.regexp_replace(parts[0], r"[.]", "")
        whole = F.concat(F.substring(plain, F.lit(1), power + 1), F.lit("."), F.substring(plain, power + 2, F.lit(digits)))
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), plain)
        bare = lambda x: F.regexp_replace(x, r"[.]?0*$", "")
        mantissa = F.concat(F.substring(plain, 1, 1), F.lit("."), F.substring(plain, F.lit(2), F.lit(digits)))
        long = F.concat(bare(mantissa), F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0")))
        shown = F.when((power < -4) | (power >= digits), long).when(power < 0, bare(small)).otherwise(bare(whole))
        infinite = F.abs(v) == float("inf")
        return F.concat(F.when(v.cast("string").startswith("-"), "-").otherwise(""), F.when(infinite, "inf").when(v == 0, "0").otherwise(shown))

    return F.when(F.isnan(value), "nan").otherwise(bound(value, text))

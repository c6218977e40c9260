"""Exact quantiles of a column that no task has to hold.

Values are cut into bins at approximate quantiles (a sketch of fixed size), bins are counted, and only the bins that hold
the wanted ranks are looked into, value by value with counts. The result is exact whatever the cuts are; a better sketch
only makes the last bins smaller.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BINS = 1024
#: So many values one aggregate may hold.
SMALL = 1_000_000


def _bin(value: Column, cuts: Column) -> Column:
    """How many of the ascending cuts lie below the value, by halving."""
    steps = F.array(*[F.lit(BINS >> k) for k in range(1, BINS.bit_length())])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(cuts, at + step - 1) < value, at + step).otherwise(at))


def exact_quantiles(df: DataFrame, column: str, shares: dict[str, float], keys: tuple[str, ...] = (), small: int = SMALL) -> DataFrame:
    """One row of each key (one row without keys): keys and, by name, the quantile at each share, between neighbours in
    proportion. Null values are left out; a key without values has no row."""
    k = [F.col(f"`{c}`") for c in keys] or [F.lit(0).alias("_all")]
    names = list(keys) or ["_all"]
    rows = df.where(F.col(column).isNotNull()).select(*k, F.col(column).cast("double").alias("_v"))
    largest = rows.groupBy(*names).count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    if largest <= small:  # what an aggregate holds of one key is bounded by this count
        return rows.groupBy(*names).agg(*[F.percentile("_v", F.lit(p)).alias(name) for name, p in shares.items()]).select(*keys, *shares)
    points = [i / BINS for i in range(1, BINS)]
    # One row a key; the arrays have BINS - 1 numbers.
    cuts = rows.groupBy(*names).agg(F.percentile_approx("_v", points, 10_000).alias("_cuts"), F.count("*").alias("_n"))
    binned = rows.join(F.broadcast(cuts) if not keys else cuts, names).withColumn("_bin", _bin(F.col("_v"), F.col("_cuts"))).drop("_cuts")
    counted = binned.groupBy(*names, "_bin").agg(F.count("*").alias("_c"), F.max("_n").alias("_n"))
    upto = W.partitionBy(*names).orderBy("_bin").rowsBetween(W.unboundedPreceding, 0)  # at most BINS rows a key
    counted = counted.withColumn("_before", F.sum("_c").over(upto) - F.col("_c"))
    at = {name: F.lit(float(p)) * (F.col("_n") - 1) for name, p in shares.items()}
    ranks = [f(x).cast("long") for x in at.values() for f in (F.floor, F.ceil)]
    wanted = counted.where(reduce(lambda a, b: a | b, [(F.col("_before") <= r) & (r < F.col("_before") + F.col("_c")) for r in ranks]))
    inside = binned.join(F.broadcast(wanted.drop("_c", "_n")) if not keys else wanted.drop("_c", "_n"), [*names, "_bin"])
    values = inside.groupBy(*names, "_bin", "_v").agg(F.count("*").alias("_c"), F.max("_n").alias("_n"), F.max("_before").alias("_before"))
    within = W.partitionBy(*names, "_bin").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    values = values.withColumn("_hi", F.col("_before") + F.sum("_c").over(within)).withColumn("_lo", F.col("_hi") - F.col("_c"))
    pick = lambda r: F.max(F.when((F.col("_lo") <= r) & (r < F.col("_hi")), F.col("_v")))

    def between(x: Column) -> Column:
        low, high, part = pick(F.floor(x).cast("long")), pick(F.ceil(x).cast("long")), F.max(x - F.floor(x))
        return low + part * (high - low)

    return values.groupBy(*names).agg(*[between(x).alias(name) for name, x in at.items()]).select(*keys, *shares)

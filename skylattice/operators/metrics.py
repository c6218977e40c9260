"""Agreement metrics: one pass and one shuffle of partial sums for each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def sides() -> tuple[Column, Column]:
    return F.col("predicted"), F.col("reference")


def both(pairs: DataFrame) -> DataFrame:
    p, r = sides()
    return pairs.where(p.isNotNull() & r.isNotNull())


def continuous(pairs: DataFrame, *keys: str) -> DataFrame:
    """rmse, correlation, bias, n over pairs where both sides are there. The correlation is null of a constant, 0 of
    fewer than two pairs; moments are merged around running means, so that large offsets lose no digits."""
    p, r = sides()
    d = p - r
    agg = both(pairs).groupBy(*keys).agg(
        F.sqrt(F.avg(d * d)).alias("rmse"),
        F.avg(d).alias("bias"),
        F.count("*").alias("n"),
        F.covar_pop(p, r).alias("_c"),
        F.var_pop(p).alias("_vp"),
        F.var_pop(r).alias("_vr"),
    )
    corr = F.when(F.col("n") < 2, 0.0).otherwise(F.try_divide(F.col("_c"), F.sqrt(F.col("_vp") * F.col("_vr"))))
    return agg.select(*keys, F.coalesce("rmse", F.lit(0.0)).alias("rmse"), corr.alias("correlation"), F.coalesce("bias", F.lit(0.0)).alias("bias"), "n")


def confusion(where: Column | None = None) -> list[Column]:
    ok = F.lit(True) if where is None else where
    p, r = sides()
    return [
        F.count_if(ok & (p == 1) & (r == 1)).alias("tp"),
        F.count_if(ok & (p == 1) & (r == 0)).alias("fp"),
        F.count_if(ok & (p == 0) & (r == 1)).alias("fn"),
        F.count_if(ok & (p == 0) & (r == 0)).alias("tn"),
        F.count_if(ok & (p == r)).alias("correct"),
        F.count_if(ok).alias("total"),
    ]


def ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def scores() -> dict[str, Column]:
    """From confusion counts. Nodata is skipped by the first three and counts as wrong in accuracy."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return {
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
        "accuracy": ratio(F.col("correct"), F.col("total")),
    }


def classification(pairs: DataFrame, *keys: str) -> DataFrame:
    return pairs.groupBy(*keys).agg(*confusion()).withColumns(scores())


def histogram(df: DataFrame, column: str, bins: int, *keys: str) -> DataFrame:
    """Counts of equal bins between least and largest value; keyless extremes are one row, joined by broadcast."""
    ends = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    k = F.least(F.lit(bins - 1), F.coalesce(F.floor(F.try_divide(F.col(column) - F.col("lo"), width)), F.lit(0)).cast("int"))
    return df.where(F.col(column).isNotNull()).join(F.broadcast(ends)).groupBy(*keys, k.alias("bin")).agg(F.count("*").alias("n"))


def class_shares(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("percent", 100 * F.col("n") / F.sum("n").over(W.partitionBy(F.lit(1))))

"""Stacks over time: coherence, velocity, ramps and inversion."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .quantiles import SMALL, exact_quantiles

MM_PER_RADIAN = 0.05546576 / (4 * math.pi) * 1000


def amplitude_rmse_db(pairs: DataFrame, key: str, least: float = 5.0, enough: int = 100) -> DataFrame:
    """RMSE of amplitudes a, b in decibels: of strong pairs only, where a group has more than `enough` of them."""
    strong = (F.col("a") > least) & (F.col("b") > least)
    d = 20 * F.log10("a") - 20 * F.log10("b")
    sums = pairs.groupBy(key).agg(
        F.count_if(strong).alias("ns"), F.avg(F.when(strong, d * d)).alias("vs"), F.count("*").alias("na"), F.avg(d * d).alias("va")
    )
    use = F.col("ns") > enough
    return sums.select(key, F.when(use, F.col("ns")).otherwise(F.col("na")).alias("n"), F.sqrt(F.when(use, F.col("vs")).otherwise(F.col("va"))).alias("rmse_db"))


def coherence_stats(stack: DataFrame, least: float = 0.6, small: int = SMALL) -> DataFrame:
    """Six statistics of per-pixel coherence over time; null coherence counts as 0, an empty stack gives zeros. Up to
    `small` pixels one aggregate gives them all; beyond, quantiles are found without one task's holding the pixels."""
    c = F.coalesce("coh", F.lit(0.0))
    pixel = stack.groupBy("row", "col").agg(F.avg(c).alias("mean"), F.bool_and(c >= least).alias("persistent"))
    z = lambda x, n: F.coalesce(x, F.lit(0.0)).alias(n)
    averages = [F.avg("mean").alias("_mean"), F.avg(F.col("persistent").cast("double")).alias("_share")]
    names = ["mean", "median", "p25", "p75", "persistently_coherent_fraction", "median_of_persistent"]
    if pixel.count() <= small:
        at = F.percentile("mean", F.array(F.lit(0.5), F.lit(0.25), F.lit(0.75)))
        one = pixel.agg(*averages, at.alias("_at"), F.percentile(F.when(F.col("persistent"), F.col("mean")), F.lit(0.5)).alias("_steady"))
        return one.select(*[z(x, n) for x, n in zip((F.col("_mean"), *(F.get("_at", k) for k in range(3)), F.col("_share"), F.col("_steady")), names, strict=True)])
    means = pixel.agg(*averages)
    # One row each.
    every = F.broadcast(exact_quantiles(pixel, "mean", {"_p50": 0.5, "_p25": 0.25, "_p75": 0.75}))
    steady = F.broadcast(exact_quantiles(pixel.where("persistent"), "mean", {"_steady": 0.5}))
    return means.join(every, F.lit(True), "left").join(steady, F.lit(True), "left").select(
        z(F.col("_mean"), "mean"), z(F.col("_p50"), "median"), z(F.col("_p25"), "p25"), z(F.col("_p75"), "p75"),
        z(F.col("_share"), "persistently_coherent_fraction"), z(F.col("_steady"), "median_of_persistent"),
    )


def residual_mean(values: DataFrame, column: str) -> DataFrame:
    """Mean of what is left after the median is taken off."""
    anchor = exact_quantiles(values, column, {"anchor": 0.5})
    mean = values.agg(F.avg(F.col(column).cast("double")).alias("mean"))
    return mean.join(F.broadcast(anchor), F.lit(True), "left").select(F.coalesce(F.col("mean") - F.col("anchor"), F.lit(0.0)).alias("residual"))


def unwrapped(stack: DataFrame) -> DataFrame:
    """Phase made continuous over epochs, pixel by pixel: steps of half a turn or more are brought within half a turn."""
    w = W.partitionBy("row", "col").orderBy("epoch")
    d = F.col("phase") - F.lag("phase").over(w)
    turn = 2 * math.pi
    m = d + math.pi
    m = m - F.floor(m / turn) * turn - math.pi
    m = F.when((m == -math.pi) & (d > 0), F.lit(math.pi)).otherwise(m)
    fix = F.when(F.abs(d) < math.pi, 0.0).otherwise(m - d)
    return stack.withColumn("_fix", F.coalesce(fix, F.lit(0.0))).withColumn("unwrapped", F.col("phase") + F.sum("_fix").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_fix")


def velocity(stack: DataFrame, column: str = "unwrapped", least: int = 3, sign: float = -1.0) -> DataFrame:
    """Slope over days of each pixel in millimetres a year; pixels with fewer than `least` epochs have none."""
    slope = F.regr_slope(column, F.col("days").cast("double"))
    out = stack.where(F.col(column).isNotNull()).groupBy("row", "col").agg(F.count("*").alias("n"), slope.alias("slope"))
    return out.select("row", "col", F.when(F.col("n") >= least, sign * F.col("slope") * MM_PER_RADIAN * 365.25).alias("velocity"))


def planes(ifg: DataFrame, least: int) -> DataFrame:
    """Plane of each interferogram from centred moments; null with fewer than `least` pixels. Where all pixels lie on one
    line, many planes fit alike: the one whose three coefficients are least, taken together as squares, is given."""
    ok = ifg.where(F.col("phase").isNotNull() & (F.col("phase") != 0))
    x, y, z = (F.col(c).cast("double") for c in ("col", "row", "phase"))
    m = ok.groupBy("ifg_idx").agg(
        F.count("*").alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"), F.avg(z).alias("mz"),
        F.var_pop(x).alias("xx"), F.var_pop(y).alias("yy"), F.covar_pop(x, y).alias("xy"), F.covar_pop(x, z).alias("xz"), F.covar_pop(y, z).alias("yz"),
    )
    c = F.col
    det, spread = c("xx") * c("yy") - c("xy") * c("xy"), c("xx") + c("yy")
    line = det <= 1e-12 * F.greatest(spread * spread, F.lit(1.0))
    # Along the line: its direction (u, v), the slope along it, and the value there that the plane has at the origin.
    by_x = c("xx") >= c("yy")
    du, dv = F.when(by_x, c("xx")).otherwise(c("xy")), F.when(by_x, c("xy")).otherwise(c("yy"))
    m = m.withColumns({"_line": line, "_u": F.try_divide(du, F.hypot(du, dv)), "_v": F.try_divide(dv, F.hypot(du, dv))})
    m = m.withColumn("_g", F.coalesce(F.try_divide(c("_u") * c("xz") + c("_v") * c("yz"), spread), F.lit(0.0)))
    m = m.withColumns({"_u": F.coalesce("_u", F.lit(1.0)), "_v": F.coalesce("_v", F.lit(0.0))})
    # Turning the plane about the line by t leaves its values on the line as they are; t is where the squares are least.
    rest, lever = c("mz") - c("_g") * (c("_u") * c("mx") + c("_v") * c("my")), c("_u") * c("my") - c("_v") * c("mx")
    m = m.withColumn("_t", rest * lever / (1 + lever * lever))
    enough = c("n") >= least
    a = F.when(enough & c("_line"), c("_g") * c("_u") - c("_t") * c("_v")).when(enough, (c("xz") * c("yy") - c("yz") * c("xy")) / det)
    b = F.when(enough & c("_line"), c("_g") * c("_v") + c("_t") * c("_u")).when(enough, (c("yz") * c("xx") - c("xz") * c("xy")) / det)
    return m.select("ifg_idx", "n", a.alias("slope_x"), b.alias("slope_y"), (c("mz") - a * c("mx") - b * c("my")).alias("intercept"))


def ramps(ifg: DataFrame, least: int = 100) -> DataFrame:
    """slope_x, slope_y, intercept, magnitude (peak to peak of the plane over its pixels), direction in degrees."""
    fits = planes(ifg, least)
    plane = F.col("slope_x") * F.col("col") + F.col("slope_y") * F.col("row")
    ok = ifg.where(F.col("phase").isNotNull() & (F.col("phase") != 0))
    span = ok.join(fits, "ifg_idx").groupBy("ifg_idx").agg((F.max(plane) - F.min(plane)).alias("magnitude"))
    return fits.join(span, "ifg_idx").withColumn("direction", F.degrees(F.atan2("slope_y", "slope_x")))


def deramped(ifg: DataFrame, least: int = 100) -> DataFrame:
    """phase less its plane; interferograms without a plane stay. Zeros are left out of the fit, but not here."""
    fits = planes(ifg, least).select("ifg_idx", "slope_x", "slope_y", "intercept")
    plane = F.col("slope_x") * F.col("col") + F.col("slope_y") * F.col("row") + F.col("intercept")
    return ifg.join(fits, "ifg_idx", "left").withColumn("phase", F.col("phase") - F.coalesce(plane, F.lit(0.0))).select(*ifg.columns)


def ramp_aggregate(fits: DataFrame) -> DataFrame:
    """Of magnitude, direction, coherence rows: mean magnitude, circular deviation, correlation; null of fewer than 3."""
    d = F.radians("direction")
    m = fits.where("magnitude is not null and direction is not null and coherence is not null").agg(
        F.count("*").alias("n"), F.avg("magnitude").alias("m"), F.avg(F.sin(d)).alias("s"), F.avg(F.cos(d)).alias("c"),
        F.covar_pop("magnitude", "coherence").alias("mc"), F.var_pop("magnitude").alias("vm"), F.var_pop("coherence").alias("vc"),
    )
    r = F.greatest(F.lit(1e-300), F.least(F.lit(1.0), F.sqrt(F.col("s") ** 2 + F.col("c") ** 2)))
    enough = F.col("n") >= 3
    return m.select(
        "n",
        F.when(enough, F.col("m")).alias("mean_magnitude"),
        F.when(enough, F.degrees(F.sqrt(-2 * F.log(r)))).alias("direction_sigma"),
        F.when(enough, F.try_divide(F.col("mc"), F.sqrt(F.col("vm") * F.col("vc")))).alias("correlation"),
    )


def attributed(sigma, correlation, cutoff_deg: float = 30.0, cutoff_r: float = 0.5):
    steady, tied = F.coalesce(sigma < cutoff_deg, F.lit(False)), F.coalesce(correlation > cutoff_r, F.lit(False))
    return F.when(steady & tied, "mixed").when(steady, "orbit").when(tied, "phass").otherwise("inconclusive")


def unwrap_quality(ifg: DataFrame, threshold: float = 1.0) -> DataFrame:
    """RMS about the plane, and whether it is above the threshold; 0 with fewer than 4 pixels."""
    fits = planes(ifg, 4).drop("n")
    plane = F.col("slope_x") * F.col("col") + F.col("slope_y") * F.col("row") + F.col("intercept")
    d = F.col("phase") - plane
    out = ifg.where(F.col("phase").isNotNull() & (F.col("phase") != 0)).join(fits, "ifg_idx").groupBy("ifg_idx").agg(F.coalesce(F.sqrt(F.avg(d * d)), F.lit(0.0)).alias("residual_rms"))
    return out.withColumn("flagged", F.col("residual_rms") > threshold)


def inversion_weights(pairs: list[tuple[int, int]], days: list[float]) -> dict[int, float]:
    """One weight per interferogram: what it adds to a pixel's velocity (radians a day). The network matrix is shared by
    all pixels, so its pseudo-inverse and the slope over epochs fold into one small vector on the driver."""
    import numpy as np

    a = np.zeros((len(pairs), len(days)))
    for k, (first, second) in enumerate(pairs):
        a[k, first], a[k, second] = -1, 1
    inverse = np.linalg.pinv(a[:, 1:])
    t = np.asarray(days[1:], "float64")
    slope = (t - t.mean()) / ((t - t.mean()) ** 2).sum()
    return dict(enumerate((slope @ inverse).tolist()))


def inverted_velocity(ifg: DataFrame, weights: dict[int, float]) -> DataFrame:
    """Velocity of each pixel in millimetres a year by small-baseline inversion; null phase counts as 0."""
    table = F.create_map(*[F.lit(x) for k, w in weights.items() for x in (k, w)])
    each = F.coalesce("phase", F.lit(0.0)) * F.coalesce(table[F.col("ifg_idx").cast("int")], F.lit(0.0))
    return ifg.groupBy("row", "col").agg((F.sum(each) * MM_PER_RADIAN * 365.25).alias("velocity"))


def phasor_agreement(slc: DataFrame, key: str) -> DataFrame:
    """Coherence (length of the mean unit phasor) and phase RMS of re, im against the same pixel one epoch before."""
    w = W.partitionBy("row", "col").orderBy("epoch")
    r0, i0 = F.lag("re").over(w), F.lag("im").over(w)
    x = slc.withColumn("_r", F.col("re") * r0 + F.col("im") * i0).withColumn("_i", F.col("im") * r0 - F.col("re") * i0)
    size = F.sqrt(F.col("_r") ** 2 + F.col("_i") ** 2)
    x = x.where(size > 1e-12).withColumn("_p", F.atan2("_i", "_r"))
    return x.groupBy(key).agg(F.sqrt(F.avg(F.cos("_p")) ** 2 + F.avg(F.sin("_p")) ** 2).alias("coherence"), F.sqrt(F.avg(F.col("_p") ** 2)).alias("phase_rms"))

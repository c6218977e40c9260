"""Whole comparisons of classified products: water, disturbance, thresholds by region, and how far a fit holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from . import metrics as M
from . import neighbourhood as N
from .resample import joint_best, leave_one_out

#: Fewer valid pixels than this are no agreement.
LEAST_PIXELS = 100
#: Fixed values: (region, wigt, awgt, pswt2).
THRESHOLDS = [("nam", 0.124, 0.0, -0.5), ("eu", 0.124, 0.0, -0.5)]
DEFAULT_REGION = "nam"


def water_agreement(pixels: DataFrame, reach: int = 1) -> DataFrame:
    """pixels(scene_id, row, col, cls, jrc) -> by scene the scores of two sets of pixels, off the shore (the gate) and all
    (columns that begin with full_), and how many pixels lie on the shore, valid or not. One pass over the pixels gives
    both."""
    pairs = pixels.withColumn("predicted", S.binary_water(F.col("cls"))).withColumn("reference", S.binary_reference_water(F.col("jrc")))
    shore = N.shoreline(pairs, "reference", reach)
    valid = F.col("predicted").isNotNull() & F.col("reference").isNotNull()
    whole = [c.alias(f"_full{k}") for k, c in enumerate(M.confusion(valid))]
    counts = shore.groupBy("scene_id").agg(*M.confusion(valid & ~F.col("shore")), *whole, F.count_if(F.col("shore")).alias("shore_pixels"))
    names = ["tp", "fp", "fn", "tn", "correct", "total"]
    gate = counts.withColumns(M.scores())
    scores = list(M.scores())
    gate = gate.select("scene_id", "shore_pixels", "total", *scores, *[F.col(f"_full{k}").alias(n if n != "total" else "full_total") for k, n in enumerate(names)])
    full = gate.withColumnsRenamed({n: f"_gate_{n}" for n in (*scores, "total")}).withColumn("total", F.col("full_total")).withColumns(M.scores())
    return full.select("scene_id", "shore_pixels", F.col("_gate_total").alias("total"), *[F.col(f"_gate_{n}").alias(n) for n in scores], "full_total", *[F.col(n).alias(f"full_{n}") for n in scores])


def disturbance_agreement(product: DataFrame, reference: DataFrame, factor: float = 1.0, disturbed: tuple[int, ...] = (2, 3, 4, 5, 6, 7, 8)) -> DataFrame:
    """product, reference(scene_id, row, col, status) -> by scene n_valid and the scores of disturbed against not. The
    product is taken onto the reference's grid by the nearest pixel, factor being how many of its pixels a reference pixel
    spans; only pixels valid in both count, and fewer than LEAST_PIXELS give no scores."""
    onto = N.nearest(product.withColumnRenamed("status", "value"), reference, factor)
    pairs = reference.join(onto, ["scene_id", "row", "col"], "left")
    # A pixel that is not there is no undisturbed one.
    binary = lambda c: F.when(F.col(c).isNotNull(), S.binary_disturbance(F.col(c), disturbed))
    pairs = pairs.withColumn("predicted", binary("value")).withColumn("reference", binary("status"))
    valid = F.col("predicted").isNotNull() & F.col("reference").isNotNull()
    counts = pairs.groupBy("scene_id").agg(*M.confusion(valid)).withColumns(M.scores())
    enough = F.col("total") >= LEAST_PIXELS
    return counts.select("scene_id", F.col("total").alias("n_valid"), *[F.when(enough, F.col(n)).alias(n) for n in M.scores()])


def region_thresholds(rows: DataFrame, region: Column, table: list[tuple[str, float, float, float]] = THRESHOLDS, default: str = DEFAULT_REGION) -> DataFrame:
    """rows with wigt, awgt and pswt2 of their region; a null region is the default one, an unknown one gives nulls."""
    spark = rows.sparkSession
    known = spark.createDataFrame(table, "_region string, wigt double, awgt double, pswt2 double")
    key = rows.withColumn("_region", F.lower(F.coalesce(region, F.lit(default))))
    return key.join(F.broadcast(known), "_region", "left").drop("_region")  # one row a region of a fixed list


def region_diagnostic() -> Column:
    """The five tests as bits, by the row's own wigt, awgt and pswt2; needs the index bands as columns."""
    c, single = F.col, lambda name: F.col(name).cast("float")
    tests = [
        c("mndwi") > single("wigt"),
        c("mbsrv") > c("mbsrn"),
        c("awesh") > single("awgt"),
        (c("mndwi") > S.f32(-0.44)) & (c("swir1") < 900) & (c("nir") < 1500) & (c("ndvi") < S.f32(0.7)),
        (c("mndwi") > single("pswt2")) & (c("blue") < 1000) & (c("swir1") < 3000) & (c("swir2") < 1000) & (c("nir") < 2500),
    ]
    return sum(t.cast("int") * (1 << k) for k, t in enumerate(tests))


def held_out_gap(scores: DataFrame, pair: list[str], most: float = 0.02) -> DataFrame:
    """One row: the mean f1 at the joint best point, the mean of the left-out scores, their gap, and whether it blocks."""
    folds = leave_one_out(scores, pair).agg(F.avg("left_out_f1").alias("loocv_mean_f1"), F.count("*").alias("folds"))
    best = joint_best(scores).select(F.col("mean_f1").alias("fit_mean_f1"))
    out = best.join(F.broadcast(folds)).withColumn("gap", F.col("fit_mean_f1") - F.col("loocv_mean_f1"))
    return out.withColumn("status", F.when(F.col("gap") >= most, "BLOCKER").otherwise("OK"))


def backscatter_agreement(product: DataFrame, reference: DataFrame, factor: float = 1.0) -> DataFrame:
    """product, reference(scene_id, row, col, value: power) -> by scene rmse, correlation, bias and n of decibels on the
    reference's grid (bilinear), and ssim, their structural similarity."""
    on_grid = N.bilinear(product, reference.select("scene_id", "row", "col"), factor).withColumnRenamed("value", "p")
    pairs = on_grid.join(reference.withColumnRenamed("value", "r"), ["scene_id", "row", "col"])
    pairs = pairs.select("scene_id", "row", "col", S.decibel(F.col("p")).alias("predicted"), S.decibel(F.col("r")).alias("reference"))
    return M.continuous(pairs, "scene_id").join(N.ssim(pairs), "scene_id", "left")

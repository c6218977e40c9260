"""Whole product comparisons, composed of the operators beside it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalar as S
from . import metrics as M
from . import neighbourhood as N
from .quantiles import exact_quantiles


def backscatter_agreement(product: DataFrame, reference: DataFrame, factor: float = 1.0) -> DataFrame:
    """Both in decibels on the reference grid (bilinear), then rmse, correlation and bias by scene."""
    on_grid = N.bilinear(product, reference.select("scene_id", "row", "col"), factor)
    pairs = on_grid.withColumnRenamed("value", "p").join(reference.withColumnRenamed("value", "r"), ["scene_id", "row", "col"])
    return M.continuous(pairs.select("scene_id", S.decibel(F.col("p")).alias("predicted"), S.decibel(F.col("r")).alias("reference")), "scene_id")


def point_agreement(raster: DataFrame, points: DataFrame, least: int = 100) -> DataFrame:
    """raster(row, col, value: phase rate) sampled at points(pid, x, y, reference): millimetres a year, zeros left out;
    nulls with fewer than `least` pairs."""
    s = N.sample_nearest(raster, points).join(points.select("pid", "reference"), "pid")
    m = M.continuous(s.select(F.lit(0).alias("k"), S.rate_to_mm(F.col("value")).alias("predicted"), "reference"), "k")
    ok = F.col("n") >= least
    return m.select("n", *[F.when(ok, F.col(c)).alias(c) for c in ("rmse", "correlation", "bias")])


def stable_residual(points: DataFrame, most_std: float = 2.0, least: int = 100) -> DataFrame:
    """points(value, std): mean absolute deviation from the median over stable points, with a ledger of counts."""
    stable = (F.col("std") < most_std) & F.col("value").isNotNull()
    middle = exact_quantiles(points.where(stable), "value", {"_m": 0.5})
    out = points.join(F.broadcast(middle), F.lit(True), "left").agg(
        F.count("*").alias("points"), F.count_if(F.col("std") < most_std).alias("stable"), F.count_if(stable).alias("valid"),
        F.avg(F.when(stable, F.abs(F.col("value") - F.col("_m")))).alias("residual"),
    )
    few = F.col("valid") < least
    return out.withColumn("residual", F.when(~few, F.col("residual"))).withColumn("blocker", F.when(few, "too_few_points"))


def stable_mask(pixels: DataFrame, near_coast: Column, near_water: Column, land: int = 60, most_slope: float = 10.0) -> DataFrame:
    """+ bare, gentle, coast, water and stable: bare land, slope known and gentle, far from coast and water."""
    bare, gentle = F.col("landcover") == land, F.coalesce(F.col("slope") <= most_slope, F.lit(False))
    flags = pixels.withColumn("bare", bare).withColumn("gentle", gentle).withColumn("coast", F.coalesce(near_coast, F.lit(False))).withColumn("water", F.coalesce(near_water, F.lit(False)))
    return flags.withColumn("stable", F.col("bare") & F.col("gentle") & ~F.col("coast") & ~F.col("water"))


def mask_ledger(mask: DataFrame) -> DataFrame:
    c = F.col
    return mask.agg(
        F.count_if(c("bare")).alias("bare"), F.count_if(c("slope").isNotNull()).alias("slope_known"), F.count_if(c("coast")).alias("coast"),
        F.count_if(c("water")).alias("water"), F.count_if(c("stable")).alias("stable"), F.avg(c("stable").cast("double")).alias("retention"),
    )


def terrain_summary(dem: DataFrame, value: str, dx: float, dy: float) -> DataFrame:
    """Nodata share, elevation range, slope at the median and the ninth decile."""
    s = N.slope_degrees(dem, value, dx, dy)
    q = exact_quantiles(s, "slope", {"slope_p50": 0.5, "slope_p90": 0.9}, keys=("scene_id",))
    rest = s.groupBy("scene_id").agg(F.avg(F.col(value).isNull().cast("double")).alias("nodata"), F.min(value).alias("least"), F.max(value).alias("most"))
    return rest.join(q, "scene_id", "left").select("scene_id", "nodata", "least", "most", "slope_p50", "slope_p90")


def gaussian(df: DataFrame, column: str, sigma: float, keys=("scene_id",)) -> DataFrame:
    """Gaussian smoothing with a mirrored border, cut at four sigma: weighted sums over windows along rows, then columns,
    so that a window partition is one line of pixels. Nodata counts as 0."""
    import math

    reach = int(4 * sigma + 0.5)
    w = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-reach, reach + 1)]
    w = [x / sum(w) for x in w]
    df = df.withColumn(column, F.coalesce(column, F.lit(0.0))).select(*keys, "row", "col", column)
    weights = F.array(*[F.lit(x) for x in w])
    for axis in ("col", "row"):
        other = "row" if axis == "col" else "col"
        ends = F.broadcast(df.groupBy(*keys).agg(F.min(axis).alias("_lo"), F.max(axis).alias("_hi")))  # one row a scene
        size, here = F.col("_hi") - F.col("_lo") + 1, F.col(axis)
        # Mirroring again and again is a fold of period twice the size: a pixel stands at each place that folds to it.
        turns = F.sequence(-F.ceil((reach + size) / (2 * size)).cast("int"), F.ceil((reach + size) / (2 * size)).cast("int"))
        images = F.flatten(F.transform(turns, lambda m: F.array(here + 2 * size * m, 2 * F.col("_lo") - 1 - here + 2 * size * m)))
        near = F.filter(images, lambda x: (x >= F.col("_lo") - reach) & (x <= F.col("_hi") + reach))
        line = df.join(ends, list(keys)).withColumn(axis, F.explode(near))
        around = W.partitionBy(*keys, other).orderBy(axis).rangeBetween(-reach, reach)
        taps = F.collect_list(F.struct(F.col(axis).alias("at"), F.col(column).alias("v"))).over(around)
        # At most 2 * reach + 1 taps a pixel; a pixel that is missing adds nothing.
        smooth = F.aggregate("_taps", F.lit(0.0), lambda total, t: total + t.v * F.get(weights, t.at - F.col(axis) + reach))
        line = line.withColumn("_taps", taps).where(here.between(F.col("_lo"), F.col("_hi")))
        df = line.select(*keys, "row", "col", smooth.alias(column))
    return df


def tile_cover(boxes: DataFrame, size: float) -> DataFrame:
    """boxes(id, xmin, ymin, xmax, ymax) -> (id, tile_x, tile_y) of all tiles that a box touches."""
    n = lambda c: F.floor(F.col(c) / size).cast("int")
    return boxes.withColumn("tile_x", F.explode(F.sequence(n("xmin"), n("xmax")))).withColumn("tile_y", F.explode(F.sequence(n("ymin"), n("ymax")))).select("id", "tile_x", "tile_y")


def mosaic(tiles: DataFrame) -> DataFrame:
    """tiles(rank, row, col, value): at each pixel the first tile that has it."""
    w = W.partitionBy("row", "col").orderBy("rank")
    return tiles.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def touched(pixels: DataFrame, boxes: DataFrame, size: float) -> DataFrame:
    """pixels(row, col, size 1 each) that any of boxes(xmin, ymin, xmax, ymax) touches, edges included."""
    cell = lambda lo, hi: F.sequence(F.floor(lo / size).cast("long"), F.floor(hi / size).cast("long"))
    b = boxes.withColumn("_x", F.explode(cell(F.col("xmin") - 1, F.col("xmax") + 1))).withColumn("_y", F.explode(cell(F.col("ymin") - 1, F.col("ymax") + 1)))
    p = pixels.withColumn("_x", F.floor(F.col("col") / size).cast("long")).withColumn("_y", F.floor(F.col("row") / size).cast("long"))
    hit = p.join(b, ["_x", "_y"]).where("xmin <= col + 1 and xmax >= col and ymin <= row + 1 and ymax >= row")
    return hit.select(*pixels.columns).distinct()


def sequential_pairs(pairs: DataFrame, step: int = 12, off: int = 1) -> DataFrame:
    """Pairs of dates that are a step apart, give or take `off` days."""
    return pairs.where(F.abs(F.datediff("second", "first") - step) <= off)

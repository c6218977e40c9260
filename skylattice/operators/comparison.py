"""Products brought onto a reference's form, and whole comparisons over aligned pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from . import metrics as M
from . import neighbourhood as N
from . import stacks as K
from .products import gaussian

METHODS = ("gaussian", "block_mean", "bilinear", "nearest")
POINT_SIGMA = 3.0


def prepared(native: DataFrame, reference: DataFrame, *, method: str | None = None, factor: float = 1.0) -> DataFrame:
    """native(scene_id, row, col, value) in the form of the reference, which its columns tell: grids(scene_id, height,
    width in native pixels) and pixels(scene_id, row, col) get a value for each of their cells, `factor` native pixels
    wide; points(pid, x, y in native pixels) get one each. There is no default method: none, or an unknown one, is an error."""
    if method not in METHODS:
        raise ValueError(f"method is required, one of {METHODS}; got {method!r}")
    have = set(reference.columns)
    if {"pid", "x", "y"} <= have:
        sample = {"nearest": N.sample_nearest, "bilinear": N.sample_bilinear, "block_mean": N.sample_block_mean}
        if method == "gaussian":
            return N.sample_bilinear(gaussian(native, "value", POINT_SIGMA), reference)
        return sample[method](native, reference)
    if {"scene_id", "height", "width"} <= have:
        cells = N.target_grid(reference, factor)
    elif {"scene_id", "row", "col"} <= have:
        cells = reference.select("scene_id", "row", "col")
    else:
        raise ValueError(f"a reference has scene_id with height and width or row and col, or pid, x and y; got {reference.columns}")
    if method == "nearest":
        return N.nearest(native, cells, factor)
    if method == "bilinear":
        return N.bilinear(native, cells, factor)
    if method == "gaussian":
        return N.nearest(gaussian(native, "value", 0.5 * factor), cells, factor)
    if factor != int(factor):
        raise ValueError("block_mean takes a whole number of native pixels to a cell")
    return cells.join(N.block_mean(native, int(factor)), ["scene_id", "row", "col"], "left").select("scene_id", "row", "col", "value")


def aligned(product: DataFrame, reference: DataFrame, mask: DataFrame | None = None) -> DataFrame:
    """predicted and reference of the pixels (scene_id, row, col) that are valid in both rasters and, where there is a
    mask(scene_id, row, col, keep), kept by it. One shuffle on the pixel's key for each side."""
    keys = ["scene_id", "row", "col"]
    p = product.where("value is not null").select(*keys, F.col("value").alias("predicted"))
    r = reference.where("value is not null").select(*keys, F.col("value").alias("reference"))
    both = p.join(r, keys)
    return both if mask is None else both.join(mask.where("keep").select(*keys), keys, "left_semi")


def ortho_agreement(product: DataFrame, reference: DataFrame, incidence: DataFrame | None = None, *, factor: float = 1.0, mean_incidence: float = 33.0) -> DataFrame:
    """Line-of-sight velocity against a vertical reference, by scene: product and incidence angle (degrees; the mean
    without a raster) are brought onto the reference's pixels by four-pixel means, projected to the vertical, and compared
    where both are valid: n, correlation, bias."""
    keys = ["scene_id", "row", "col"]
    on_grid = prepared(product, reference, method="bilinear", factor=factor).withColumnRenamed("value", "los")
    if incidence is None:
        on_grid = on_grid.withColumn("angle", F.lit(mean_incidence))
    else:
        on_grid = on_grid.join(prepared(incidence, reference, method="bilinear", factor=factor).withColumnRenamed("value", "angle"), keys)
    vertical = on_grid.select(*keys, S.los_to_vertical(F.col("los"), F.col("angle")).alias("value"))
    m = M.continuous(aligned(vertical, reference), "scene_id")
    return m.select("scene_id", "n", "correlation", "bias")


def slc_agreement(product: DataFrame, reference: DataFrame) -> DataFrame:
    """Complex rasters(scene_id, x, y, re, im) on their common extent, over pixels that are valid and not zero in both, by
    scene: n, amplitude_r, amplitude_rmse_db, phase_rms, coherence (the length of the mean unit phasor). Scenes without
    such a pixel have no row."""
    one = lambda d: d.select("scene_id", "x", "y", F.struct("re", "im").alias("value"))
    both = N.aligned_overlap(one(product), one(reference))
    p, r = F.col("predicted"), F.col("reference")
    size = lambda z: F.sqrt(z["re"] ** 2 + z["im"] ** 2)
    pairs = both.select("scene_id", size(p).alias("a"), size(r).alias("b"), (p["re"] * r["re"] + p["im"] * r["im"]).alias("c"), (p["im"] * r["re"] - p["re"] * r["im"]).alias("s"))
    pairs = pairs.where((F.col("a") > 0) & (F.col("b") > 0) & ~F.isnan("a") & ~F.isnan("b"))
    phase = F.atan2("s", "c")
    unit = F.sqrt(F.col("c") ** 2 + F.col("s") ** 2) > 1e-12
    sums = pairs.groupBy("scene_id").agg(
        F.count("*").alias("n"),
        F.try_divide(F.covar_pop("a", "b"), F.sqrt(F.var_pop("a") * F.var_pop("b"))).alias("amplitude_r"),
        F.sqrt(F.avg(phase**2)).alias("phase_rms"),
        F.coalesce(F.sqrt(F.avg(F.when(unit, F.cos(phase))) ** 2 + F.avg(F.when(unit, F.sin(phase))) ** 2), F.lit(0.0)).alias("coherence"),
    )
    decibels = K.amplitude_rmse_db(pairs, "scene_id").select("scene_id", F.col("rmse_db").alias("amplitude_rmse_db"))
    return sums.join(decibels, "scene_id").select("scene_id", "n", "amplitude_r", "amplitude_rmse_db", "phase_rms", "coherence")


def stack_layers(stack: DataFrame, *layers: str) -> DataFrame:
    """stack(epoch, row, col, and a struct(re, im) column for each layer, null where a file has no such layer): re and im
    of the first layer that an epoch has. A pixel that is not finite becomes 0; an epoch without any layer is an error."""
    first = F.coalesce(*[F.col(c) for c in layers])
    z = stack.withColumn("_z", F.when(first.isNull(), F.raise_error(F.lit("no layer of " + ", ".join(layers)))).otherwise(first))

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    ok = finite(F.col("_z.re")) & finite(F.col("_z.im"))
    return z.select("epoch", "row", "col", F.when(ok, F.col("_z.re")).otherwise(0.0).alias("re"), F.when(ok, F.col("_z.im")).otherwise(0.0).alias("im"))

"""Neighbourhoods and re-gridding of rasters (scene_id, row, col). Filters are separable: one window along rows, one
along columns, so a window partition is one line of pixels, never a scene."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .quantiles import exact_quantiles

KEYS = ("scene_id",)


def _along(axis: str, reach: int, keys=KEYS):
    other = "row" if axis == "col" else "col"
    return W.partitionBy(*keys, other).orderBy(axis).rangeBetween(-reach, reach)


def dilated(df: DataFrame, flag: str, out: str, reach: int, keys=KEYS) -> DataFrame:
    """out: whether flag (0/1) holds anywhere within `reach` rows and columns."""
    return df.withColumn("_a", F.max(flag).over(_along("col", reach, keys))).withColumn(out, F.max("_a").over(_along("row", reach, keys))).drop("_a")


def rescued_wetland(df: DataFrame, reach: int = 3) -> DataFrame:
    """Class 3 stays only within `reach` pixels of class 1 or 2, else it becomes 0."""
    near = dilated(df.withColumn("_core", F.col("cls").isin(1, 2).cast("int")), "_core", "_near", reach)
    return near.withColumn("cls", F.when((F.col("cls") == 3) & (F.col("_near") == 0), 0).otherwise(F.col("cls"))).drop("_core", "_near")


def shoreline(df: DataFrame, water: str, reach: int = 1) -> DataFrame:
    """+ shore: within `reach` steps (four neighbours) of both water and other pixels. Nodata counts as other."""
    df = df.withColumn("_w", (F.coalesce(F.col(water), F.lit(0)) == 1).cast("int")).withColumn("_o", 1 - F.col("_w"))
    for _ in range(reach):
        for c in ("_w", "_o"):
            df = df.withColumn(f"{c}x", F.greatest(F.max(c).over(_along("col", 1)), F.max(c).over(_along("row", 1))))
        df = df.withColumn("_w", F.col("_wx")).withColumn("_o", F.col("_ox")).drop("_wx", "_ox")
    return df.withColumn("shore", (F.col("_w") == 1) & (F.col("_o") == 1)).drop("_w", "_o")


def boxcar(df: DataFrame, columns: list[str], size: int = 5, keys=KEYS) -> DataFrame:
    """Means over size x size pixels; at a border the image is mirrored, the edge pixel twice. Only the mirrored border
    lines are added to the table, by a union for each axis, and dropped again."""
    h = size // 2
    for axis in ("col", "row"):
        other = "row" if axis == "col" else "col"
        ends = df.groupBy(*keys).agg(F.min(axis).alias("_lo"), F.max(axis).alias("_hi"))
        with_ends = df.join(F.broadcast(ends), list(keys))  # one row a scene
        low = with_ends.where(F.col(axis) < F.col("_lo") + h).withColumn(axis, 2 * F.col("_lo") - 1 - F.col(axis))
        high = with_ends.where(F.col(axis) > F.col("_hi") - h).withColumn(axis, 2 * F.col("_hi") + 1 - F.col(axis))
        padded = with_ends.unionByName(low).unionByName(high)
        w = W.partitionBy(*keys, other).orderBy(axis).rowsBetween(-h, h)
        padded = padded.select(*[F.sum(c).over(w).alias(c) if c in columns else F.col(c) for c in padded.columns])
        df = padded.where((F.col(axis) >= F.col("_lo")) & (F.col(axis) <= F.col("_hi"))).drop("_lo", "_hi")
    return df.withColumns({c: F.col(c) / (size * size) for c in columns})


def sequential_coherence(slc: DataFrame, size: int = 5) -> DataFrame:
    """slc(epoch, row, col, re, im) -> coh of each epoch with the next: boxed product over boxed powers, 0 where empty."""
    w = W.partitionBy("row", "col").orderBy("epoch")
    x = slc.withColumn("r2", F.lead("re").over(w)).withColumn("i2", F.lead("im").over(w)).where("r2 is not null")
    x = x.select(
        "epoch", "row", "col",
        (F.col("re") * F.col("r2") + F.col("im") * F.col("i2")).alias("pr"), (F.col("im") * F.col("r2") - F.col("re") * F.col("i2")).alias("pi"),
        (F.col("re") ** 2 + F.col("im") ** 2).alias("p1"), (F.col("r2") ** 2 + F.col("i2") ** 2).alias("p2"),
    )
    b = boxcar(x, ["pr", "pi", "p1", "p2"], size, keys=("epoch",))
    return b.select("epoch", "row", "col", F.coalesce(F.try_divide(F.sqrt(F.col("pr") ** 2 + F.col("pi") ** 2), F.sqrt(F.col("p1") * F.col("p2"))), F.lit(0.0)).alias("coh"))


def slope_degrees(dem: DataFrame, value: str, dx: float, dy: float) -> DataFrame:
    """Central differences, one-sided at edges; nodata is filled with the scene's median first and has no slope."""
    middle = exact_quantiles(dem, value, {"_m": 0.5}, keys=("scene_id",))  # one row a scene
    z = dem.join(middle, "scene_id", "left").withColumn("_z", F.coalesce(value, "_m"))

    def gradient(axis: str, step: float) -> Column:
        w = W.partitionBy("scene_id", "row" if axis == "col" else "col").orderBy(axis)
        a, b, here = F.lag("_z").over(w), F.lead("_z").over(w), F.col("_z")
        return F.coalesce((b - a) / (2 * step), (b - here) / step, (here - a) / step, F.lit(0.0))

    z = z.withColumn("_gx", gradient("col", dx)).withColumn("_gy", gradient("row", dy))
    return z.withColumn("slope", F.when(F.col(value).isNotNull(), F.degrees(F.atan(F.sqrt(F.col("_gx") ** 2 + F.col("_gy") ** 2))))).drop("_m", "_z", "_gx", "_gy")


def target_grid(extent: DataFrame, factor: float) -> DataFrame:
    """extent(scene_id, height, width) -> target cells (scene_id, row, col), `factor` source pixels wide each."""
    n = lambda c: F.greatest(F.lit(1), F.floor(F.col(c) / factor).cast("int"))
    rows = extent.withColumn("row", F.explode(F.sequence(F.lit(0), n("height") - 1)))
    return rows.withColumn("col", F.explode(F.sequence(F.lit(0), n("width") - 1))).select("scene_id", "row", "col")


def nearest(src: DataFrame, target: DataFrame, factor: float) -> DataFrame:
    """Value of the source pixel that holds each target cell's centre."""
    at = lambda c: F.floor((F.col(c) + 0.5) * factor).cast("int")
    t = target.select("scene_id", "row", "col", at("row").alias("_r"), at("col").alias("_c"))
    s = src.select("scene_id", F.col("row").alias("_r"), F.col("col").alias("_c"), "value")
    return t.join(s, ["scene_id", "_r", "_c"], "left").select("scene_id", "row", "col", "value")


def _corners(points: DataFrame, y: Column, x: Column) -> DataFrame:
    """Each point with its four pixels and their weights."""
    p = points.withColumn("_y", F.floor(y).cast("int")).withColumn("_x", F.floor(x).cast("int")).withColumn("_fy", y - F.floor(y)).withColumn("_fx", x - F.floor(x))
    corner = lambda dy, dx: F.struct((F.col("_y") + dy).alias("r"), (F.col("_x") + dx).alias("c"), ((F.col("_fy") if dy else 1 - F.col("_fy")) * (F.col("_fx") if dx else 1 - F.col("_fx"))).alias("w"))
    return p.withColumn("_q", F.explode(F.array(corner(0, 0), corner(0, 1), corner(1, 0), corner(1, 1))))


def bilinear(src: DataFrame, target: DataFrame, factor: float) -> DataFrame:
    """Weighted mean of the four pixels around each target centre, those with data."""
    q = _corners(target, (F.col("row") + 0.5) * factor - 0.5, (F.col("col") + 0.5) * factor - 0.5)
    q = q.select("scene_id", "row", "col", F.col("_q.r").alias("_r"), F.col("_q.c").alias("_c"), F.col("_q.w").alias("w"))
    s = src.where("value is not null").select("scene_id", F.col("row").alias("_r"), F.col("col").alias("_c"), "value")
    out = q.join(s, ["scene_id", "_r", "_c"], "left").groupBy("scene_id", "row", "col")
    return out.agg(F.try_divide(F.sum(F.col("w") * F.col("value")), F.sum(F.when(F.col("value").isNotNull(), F.col("w")))).alias("value"))


def block_mean(src: DataFrame, factor: int) -> DataFrame:
    """Mean of the source pixels whose centre lies in a target cell; nodata is left out."""
    cell = lambda c: F.expr(f"{c} div {factor}").cast("int").alias(c)
    return src.groupBy("scene_id", cell("row"), cell("col")).agg(F.avg("value").alias("value"))


def sample_nearest(src: DataFrame, points: DataFrame) -> DataFrame:
    """points(pid, x, y in pixels) + value of the pixel that holds the point; null outside."""
    p = points.withColumn("row", F.floor("y").cast("int")).withColumn("col", F.floor("x").cast("int"))
    return p.join(src.select("row", "col", "value"), ["row", "col"], "left").select("pid", "value")


def sample_bilinear(src: DataFrame, points: DataFrame) -> DataFrame:
    """Four-pixel interpolation at (x, y) counted from the first pixel; null where a pixel that weighs is missing."""
    q = _corners(points, F.col("y"), F.col("x")).select("pid", F.col("_q.r").alias("row"), F.col("_q.c").alias("col"), F.col("_q.w").alias("w"))
    q = q.join(src.select("row", "col", "value"), ["row", "col"], "left").groupBy("pid")
    lost = F.count_if(F.col("value").isNull() & (F.col("w") > 0)) > 0
    return q.agg(F.when(~lost, F.sum(F.col("w") * F.col("value"))).alias("value"))


def sample_block_mean(src: DataFrame, points: DataFrame, reach: int = 6) -> DataFrame:
    """Mean within `reach` pixels of the pixel nearest to each point. A window is worked out once, however many points
    have it. Pixels are binned by its width, so a window meets four bins by an equi-join."""
    size = 2 * reach + 1
    near_to = points.select("pid", F.bround("y").cast("int").alias("_r"), F.bround("x").cast("int").alias("_c"))
    p = near_to.select("_r", "_c").distinct()
    bins = lambda c: F.sequence(F.floor((F.col(c) - reach) / size), F.floor((F.col(c) + reach) / size))
    p = p.withColumn("_br", F.explode(bins("_r"))).withColumn("_bc", F.explode(bins("_c")))
    s = src.where("value is not null").select("row", "col", "value", F.floor(F.col("row") / size).alias("_br"), F.floor(F.col("col") / size).alias("_bc"))
    near = p.join(s, ["_br", "_bc"]).where((F.abs(F.col("row") - F.col("_r")) <= reach) & (F.abs(F.col("col") - F.col("_c")) <= reach))
    means = near.groupBy("_r", "_c").agg(F.avg("value").alias("value"))
    return near_to.join(means, ["_r", "_c"], "left").select("pid", "value")


def ssim(pairs: DataFrame, size: int = 7, k1: float = 0.01, k2: float = 0.03) -> DataFrame:
    """Structural similarity by scene: uniform windows, sample covariance, mean over the interior. Nodata counts as 0
    inside the box of valid pixels; without range it is 1 for equal images, else 0."""
    ok = F.col("predicted").isNotNull() & F.col("reference").isNotNull()
    box = pairs.where(ok).groupBy("scene_id").agg(
        F.min("row").alias("r0"), F.max("row").alias("r1"), F.min("col").alias("c0"), F.max("col").alias("c1"),
        (F.max("reference") - F.min("reference")).alias("range"), F.max(F.abs(F.col("predicted") - F.col("reference"))).alias("off"),
    )
    x = pairs.join(F.broadcast(box), "scene_id").where("row between r0 and r1 and col between c0 and c1")
    x = x.withColumn("x", F.when(ok, F.col("predicted")).otherwise(0.0)).withColumn("y", F.when(ok, F.col("reference")).otherwise(0.0))
    moments = {"ux": F.col("x"), "uy": F.col("y"), "xx": F.col("x") ** 2, "yy": F.col("y") ** 2, "xy": F.col("x") * F.col("y")}
    x, h, n = x.withColumns(moments), size // 2, size * size
    for axis in ("col", "row"):
        w = W.partitionBy("scene_id", "row" if axis == "col" else "col").orderBy(axis).rowsBetween(-h, h)
        x = x.select(*[F.sum(c).over(w).alias(c) if c in moments else F.col(c) for c in x.columns])
    x = x.where(f"row between r0 + {h} and r1 - {h} and col between c0 + {h} and c1 - {h}").withColumns({c: F.col(c) / n for c in moments})
    s = n / (n - 1)
    vx, vy, vxy = (s * (F.col(a) - F.col(b) * F.col(c)) for a, b, c in (("xx", "ux", "ux"), ("yy", "uy", "uy"), ("xy", "ux", "uy")))
    c1, c2 = (k1 * F.col("range")) ** 2, (k2 * F.col("range")) ** 2
    each = F.try_divide((2 * F.col("ux") * F.col("uy") + c1) * (2 * vxy + c2), (F.col("ux") ** 2 + F.col("uy") ** 2 + c1) * (vx + vy + c2))
    flat = F.when(F.max("off") < 1e-8, 1.0).otherwise(0.0)
    return x.groupBy("scene_id").agg(F.when(F.max("range") == 0, flat).otherwise(F.avg(each)).alias("ssim"))


def aligned_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """a, b(scene_id, x, y, value) -> pairs on the common extent, joined by rank of coordinates, y descending."""
    ends = lambda d: d.groupBy("scene_id").agg(*[f(c).alias(f"{n}{c}") for c in "xy" for n, f in (("lo", F.min), ("hi", F.max))])
    ea, eb = ends(a), ends(b)
    common = ea.join(eb.toDF("scene_id", "blox", "bhix", "bloy", "bhiy"), "scene_id").select(
        "scene_id", *[F.greatest(f"lo{c}", f"blo{c}").alias(f"lo{c}") for c in "xy"], *[F.least(f"hi{c}", f"bhi{c}").alias(f"hi{c}") for c in "xy"]
    )

    def ranked(d: DataFrame, value: str) -> DataFrame:
        d = d.join(F.broadcast(common), "scene_id").where("x between lox and hix and y between loy and hiy")  # a row a scene
        axis = lambda c, o: d.select("scene_id", c).distinct().withColumn(f"r{c}", F.row_number().over(W.partitionBy("scene_id").orderBy(o)))
        return d.join(axis("x", F.col("x")), ["scene_id", "x"]).join(axis("y", F.col("y").desc()), ["scene_id", "y"]).select("scene_id", "rx", "ry", F.col("value").alias(value))

    return ranked(a, "predicted").join(ranked(b, "reference"), ["scene_id", "rx", "ry"])

"""What is there: files and their hashes, tiles of arrays, windows of a mosaic, candidates for an area, stable terrain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import neighbourhood as N
from .polygons import polygons_meeting
from .quantiles import exact_quantiles


def provenance(spark: SparkSession, expected: DataFrame, folder: str) -> DataFrame:
    """expected(name, path, cache_mode) with sha256 of the file's content; null where there is no such file under the
    folder, whose name a path begins with. Spark's reader passes over empty files, so one of those counts as not there.
    Files are hashed where they are read; only hashes meet the list."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    hashes = files.select(_plain(F.col("path")).alias("_path"), F.sha2("content", 256).alias("sha256"))
    j = expected.withColumn("_path", _plain(F.col("path"))).join(hashes, "_path", "left")
    return j.select("name", "path", "sha256", "cache_mode")


def _plain(path: Column) -> Column:
    """Without the scheme of a local path, which readers write in two ways."""
    return F.regexp_replace(path, "^file:/+", "/")


def tiles_to_pixels(tiles: DataFrame, width: int, height: int, nodata: float | None = None) -> DataFrame:
    """tiles(scene_id, tile_row, tile_col, data array<double> row by row) -> (scene_id, row, col, value); the nodata value
    and NaN become null. A tile whose array is shorter than width x height has no pixels beyond its end."""
    p = tiles.select("scene_id", "tile_row", "tile_col", F.posexplode("data").alias("pos", "value")).where(F.col("pos") < width * height)
    value = F.when(F.isnan("value") | (F.col("value") == F.lit(nodata) if nodata is not None else F.lit(False)), None).otherwise(F.col("value"))
    row, col = F.col("tile_row") * height + F.expr(f"pos div {width}"), F.col("tile_col") * width + F.col("pos") % width
    return p.select("scene_id", row.cast("int").alias("row"), col.cast("int").alias("col"), value.alias("value"))


def clipped_windows(bounds: DataFrame, west: float, north: float, size: float, rows: int, cols: int) -> DataFrame:
    """bounds(pid, xmin, ymin, xmax, ymax) -> (pid, row_off, row_end, col_off, col_end, empty): the window of a mosaic that
    begins at (west, north), offsets rounded down and lengths up, cut to the mosaic. An empty window is told as such."""
    first_row, first_col = F.floor((F.lit(north) - F.col("ymax")) / size), F.floor((F.col("xmin") - west) / size)
    last_row, last_col = first_row + F.ceil((F.col("ymax") - F.col("ymin")) / size), first_col + F.ceil((F.col("xmax") - F.col("xmin")) / size)
    cut = {"row_off": F.greatest(F.lit(0), first_row), "row_end": F.least(F.lit(rows), last_row), "col_off": F.greatest(F.lit(0), first_col), "col_end": F.least(F.lit(cols), last_col)}
    out = bounds.select("pid", *[v.cast("long").alias(k) for k, v in cut.items()])
    return out.withColumn("empty", (F.col("row_end") <= F.col("row_off")) | (F.col("col_end") <= F.col("col_off")))


def box_ring(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return F.array(point(xmin, ymin), point(xmax, ymin), point(xmax, ymax), point(xmin, ymax))


def candidate_probe(areas: DataFrame, granules: DataFrame, listing: DataFrame, start: str, stop: str, base: float) -> DataFrame:
    """areas(aid, ring, folder), granules(bid, ring, sensing, granule), listing(folder, file) -> for each area how many
    granules of the time window meet it, the earliest one (then by name), and the first archive of its folder in the
    listing: zipped ones before unpacked ones. Areas without granules or archives stay, with 0 and nulls."""
    inside = granules.where(F.col("sensing").between(F.lit(start).cast("timestamp"), F.lit(stop).cast("timestamp")))
    # Granules of one ring are one, and so are equal areas, named by their least aid: what they tell is summed up before
    # they meet. Rings are sorted by a hash first, which is cheaper to compare.
    by_ring = lambda d: d.groupBy(F.xxhash64("ring").alias("_h"), "ring")
    told = by_ring(inside).agg(F.struct(F.count("*").alias("n"), F.min(F.struct("sensing", "granule")).alias("e")).alias("bid"))
    places = by_ring(areas).agg(F.min("aid").alias("aid"))
    met = polygons_meeting(places, told, base)
    found = met.groupBy("aid").agg(F.sum("bid.n").alias("granules"), F.min("bid.e").alias("_e")).join(places.select("aid", "ring"), "aid").drop("aid")
    archive = listing.where(F.col("file").rlike(r"^S1.*_SLC.*\.(zip|SAFE)$"))
    hits = archive.groupBy("folder").agg(F.min(F.struct((~F.col("file").endswith(".zip")).alias("unpacked"), "file"))["file"].alias("cached"))
    out = areas.select("aid", "ring", "folder").join(found, "ring", "left").join(hits, "folder", "left")
    return out.select("aid", F.coalesce("granules", F.lit(0)).alias("granules"), F.col("_e.sensing").alias("earliest"), F.col("_e.granule").alias("granule"), "cached")


def stable_terrain(dem: DataFrame, value: str, dx: float, dy: float) -> DataFrame:
    """dem(scene_id, row, col, value, stable, ramp) -> by scene the stable pixels and their share of all, and over those
    with a value the elevation range, the slope at the median and the ninth decile, and the correlation of slope and ramp
    (null of fewer than two pixels, or without spread)."""
    s = N.slope_degrees(dem, value, dx, dy)
    stable = F.coalesce(F.col("stable"), F.lit(False))
    used = stable & F.col(value).isNotNull()
    both = used & F.col("slope").isNotNull() & F.col("ramp").isNotNull() & ~F.isnan("ramp")
    x, y = F.when(both, F.col("slope")), F.when(both, F.col("ramp"))
    rest = s.groupBy("scene_id").agg(
        F.count_if(stable).alias("stable_pixels"), F.avg(stable.cast("double")).alias("retention"), F.min(F.when(used, F.col(value))).alias("least"), F.max(F.when(used, F.col(value))).alias("most"),
        F.count(x).alias("_n"), F.covar_pop(x, y).alias("_c"), F.var_pop(x).alias("_vx"), F.var_pop(y).alias("_vy"),
    )
    q = exact_quantiles(s.where(used), "slope", {"slope_p50": 0.5, "slope_p90": 0.9}, keys=("scene_id",))
    r = F.when(F.col("_n") >= 2, F.try_divide(F.col("_c"), F.sqrt(F.col("_vx") * F.col("_vy"))))
    return rest.join(q, "scene_id", "left").select("scene_id", "stable_pixels", "retention", "least", "most", "slope_p50", "slope_p90", r.alias("slope_ramp_r"))

"""Tables from files: point lists, feature collections, metric sidecars; and the grid-score sink."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.projections import from_laea

LON, LAT = ("longitude", "lon", "x_lon"), ("latitude", "lat", "y_lat")
EAST, NORTH = ("easting",), ("northing",)


# Names that a standard deviation goes by, and what is reported when none of them is there.
STD_ALIASES = ("mean_velocity_std", "velocity_std", "std_velocity", "mean_velocity_stdev")
NO_STD = "egms_l2a_schema_upstream_breakage"


def std_ledger(df: DataFrame, most: float = 2.0) -> DataFrame:
    """One row: points, the columns there are, the first alias of the standard deviation among them and how many points
    are stable by it; without an alias a blocker, and no error."""
    std = next((c for c in STD_ALIASES if c in df.columns), None)
    stable = F.count_if(F.col(std) < most) if std else F.lit(None).cast("long")
    return df.agg(
        F.count("*").alias("points"), F.lit(",".join(df.columns)).alias("columns"), F.lit(std).cast("string").alias("std_column"),
        stable.alias("stable"), F.lit(None if std else NO_STD).cast("string").alias("blocker"),
    )


def points(df: DataFrame, velocity: str = "mean_velocity") -> DataFrame:
    """lon, lat, mean_velocity, mean_velocity_std (null without such a column) of one layout, names in any case. Without
    longitude and latitude, easting and northing are taken, metres on the European equal-area grid."""
    names = {c.lower(): c for c in df.columns}
    pick = lambda options: next((names[o] for o in options if o in names), None)
    number = lambda c: F.col(f"`{c}`").try_cast("double")
    geographic, grid = (pick(LON), pick(LAT)), (pick(EAST), pick(NORTH))
    v, s = names.get(velocity), pick(STD_ALIASES)
    if not v or not (all(geographic) or all(grid)):
        raise ValueError(f"no position or {velocity} among {df.columns}")
    lon, lat = map(number, geographic) if all(geographic) else from_laea(*map(number, grid))
    std = number(s) if s else F.lit(None).cast("double")
    return df.select(lon.alias("lon"), lat.alias("lat"), number(v).alias("mean_velocity"), std.alias("mean_velocity_std"))


def read_points(spark: SparkSession, paths: list[str], velocity: str = "mean_velocity") -> DataFrame:
    """Comma-separated files, united; an error names the file whose columns do not do."""
    out = None
    for path in paths:
        try:
            one = points(spark.read.option("header", True).csv(path), velocity)
        except ValueError as e:
            raise ValueError(f"{path}: {e}") from e
        out = one if out is None else out.unionByName(one)
    return out


FEATURES = "struct<features:array<struct<id:bigint,shape:array<struct<x:double,y:double>>,centroid:struct<x:double,y:double>>>,results:array<struct<id:bigint,shape:array<struct<x:double,y:double>>,centroid:struct<x:double,y:double>>>>"


def features(json: Column) -> Column:
    """The features of a collection, under either name."""
    x = F.from_json(json, FEATURES)
    return F.explode(F.coalesce(x["features"], x["results"]))


def sidecars(manifest: DataFrame, files: DataFrame, schema: str) -> DataFrame:
    """manifest(cell, path), files(path, content): every cell, with its record, or RUN_FAILED and why."""
    j = manifest.join(files, "path", "left").withColumn("record", F.from_json("content", schema, {"mode": "PERMISSIVE"}))
    first = schema.split()[0]
    bad = F.col(f"record.{first}").isNull()
    why = F.when(F.col("content").isNull(), "missing").when(bad, "invalid")
    return j.select("cell", "path", "record", F.when(why.isNull(), "OK").otherwise("RUN_FAILED").alias("status"), why.alias("reason"))


def write_scores(scores: DataFrame, path: str) -> None:
    """Grid scores by area and season, zstandard; only the partitions that scores holds are replaced."""
    scores.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy("aoi", "season").parquet(path)


def new_folder(spark: SparkSession) -> str:
    """A new folder's name in spark.checkpoint.dir, which all executors share; unset is allowed in local mode only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"

"""Catalogue rows: aliases, names, filters, and picks with explicit tie-breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed values: (collection, product type) -> concrete collection.
COLLECTIONS = [
    ("SENTINEL-1", "IW_SLC__1S", "sentinel-1-slc"),
    ("SENTINEL-1", "IW_GRDH_1S", "sentinel-1-grd"),
    ("SENTINEL-1", "GRD", "sentinel-1-grd"),
    ("SENTINEL-2", "S2MSI2A", "sentinel-2-l2a"),
    ("SENTINEL-2", "S2MSI1C", "sentinel-2-l1c"),
    ("SENTINEL-1", None, "sentinel-1-slc"),
    ("SENTINEL-2", None, "sentinel-2-l2a"),
]


def first_column(df: DataFrame, *names: str) -> str:
    """The first of the names that df has; an error that lists df's columns otherwise."""
    for n in names:
        if n in df.columns:
            return n
    raise ValueError(f"none of {names} among {df.columns}")


def first_castable(json: Column, kind: str, *keys: str, default=None) -> Column:
    return F.coalesce(*[F.expr("null")] if not keys else [F.get_json_object(json, f"$.{k}").try_cast(kind) for k in keys], F.lit(default))


def resolved_collection(rows: DataFrame, collections: DataFrame) -> DataFrame:
    """+ resolved: by (collection, product_type); lower-case dashed names stand for themselves; else null (an error)."""
    c = collections.select(F.col("c").alias("collection"), F.col("p").alias("product_type"), "r")
    a, b = rows.alias("a"), F.broadcast(c.alias("b"))  # seven fixed rows
    j = a.join(b, (F.col("a.collection") == F.col("b.collection")) & F.col("a.product_type").eqNullSafe(F.col("b.product_type")), "left")
    own = F.when(F.col("a.collection").rlike("^[a-z0-9]+(-[a-z0-9]+)+$"), F.col("a.collection"))
    return j.select("a.*", F.coalesce(own, F.col("b.r")).alias("resolved"))


def archive_prefix(hrefs: Column) -> Column:
    """The first archive root among an array of object addresses."""
    cut = F.transform(hrefs, lambda h: F.regexp_extract(h, r"^(s3://.*?[.]SAFE)(?![^/])", 1))
    return F.get(F.filter(cut, lambda x: x != ""), 0)


def burst_id(name: Column) -> Column:
    p = F.split(name, "_")
    return F.upper(F.concat_ws("-", p[0], p[1], p[2]))


def country(lon: Column, lat: Column) -> Column:
    """Three boxes, the first that fits."""
    return (
        F.when(lon.between(20, 30) & lat.between(39, 44), "EL").when(lon.between(-10, -6) & lat.between(39, 42), "PT").when(lon.between(-10, 5) & lat.between(35, 45), "ES")
    )


def errors(rules: dict[str, Column]) -> Column:
    """Messages of the rules that are broken; empty is valid."""
    return F.filter(F.array(*[F.when(bad, F.lit(m)) for m, bad in rules.items()]), lambda x: x.isNotNull())


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key by the order, which must break all ties. Spark keeps one row a key and task before the
    shuffle, so a key with very many rows is no burden."""
    return df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")


def dominant(df: DataFrame, keys: list[str], value: str, seq: str, top: int = 1) -> DataFrame:
    """The most frequent values of each key, ties by who came first."""
    c = df.groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(seq).alias("_s"))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("n"), "_s"))
    return c.withColumn("rank", rank).where(F.col("rank") <= top).drop("_s")


def upserted(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """The last row of each key."""
    return first_by(rows, [key], F.col(seq).desc())


def complete(expected: DataFrame, present: DataFrame, group: str) -> DataFrame:
    """Whether every expected key of a group is present."""
    p = present.select(group, "key").distinct().withColumn("_there", F.lit(True))
    return expected.join(p, [group, "key"], "left").groupBy(group).agg(F.bool_and(F.col("_there").isNotNull()).alias("complete"))


def without_markers(listing: DataFrame) -> DataFrame:
    """listing(key, size) less directory markers: keys that end in a slash, or empty ones that others lie under."""
    n = F.size(F.split("key", "/"))
    above = listing.select(F.explode(F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda k: F.array_join(F.slice(F.split("key", "/"), 1, k), "/")))).alias("key")).distinct()
    empty = listing.where("size = 0").select("key").join(above, "key", "left_semi").distinct()
    return listing.where(~F.col("key").endswith("/")).join(empty, "key", "left_anti")


def matched_frame(queries: DataFrame, frames: DataFrame, tolerance_hours: int = 1, keys: list[str] | None = None) -> DataFrame:
    """queries(qid, t, keys), frames(fid, sensing, keys): the one frame of the same keys within the tolerance of the
    query's full hour. status OK, NONE or MULTIPLE. Hour buckets make the interval an equi-join."""
    hour = F.date_trunc("hour", "t")
    bucket = lambda c: F.floor(F.unix_timestamp(c) / 3600).cast("long")
    q = queries.withColumn("_h", hour).withColumn("_b", F.explode(F.sequence(bucket(F.col("_h")) - tolerance_hours, bucket(F.col("_h")) + tolerance_hours)))
    f = frames.withColumn("_b", bucket(F.col("sensing")))
    near = q.join(f, [*(keys or []), "_b"]).where(F.abs(F.unix_timestamp("sensing") - F.unix_timestamp("_h")) <= tolerance_hours * 3600)
    hits = near.groupBy("qid").agg(F.count("*").alias("n"), F.min("fid").alias("fid"))
    out = queries.select("qid").join(hits, "qid", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    status = F.when(F.col("n") == 0, "NONE").when(F.col("n") == 1, "OK").otherwise("MULTIPLE")
    return out.select("qid", "n", status.alias("status"), F.when(F.col("n") == 1, F.col("fid")).alias("fid"))


def covering(times: DataFrame, spans: DataFrame, bucket_seconds: int, keys: list[str] | None = None) -> DataFrame:
    """times(tid, t, keys) with the spans(sid, start, stop, keys) of the same keys that hold t; buckets of a span's usual
    length make it an equi-join."""
    b = lambda c: F.floor(F.unix_timestamp(c) / bucket_seconds).cast("long")
    s = spans.withColumn("_b", F.explode(F.sequence(b(F.col("start")), b(F.col("stop")))))
    return times.withColumn("_b", b(F.col("t"))).join(s, [*(keys or []), "_b"]).where("start <= t and t <= stop").drop("_b")


def orbit_file(name: Column) -> dict[str, Column]:
    """What an orbit file's name says: its type, and from when to when it is valid (null where the name does not say)."""
    kind = F.when(name.contains("POEORB"), "POEORB").when(name.contains("RESORB"), "RESORB").otherwise("UNKNOWN")
    at = lambda k: F.try_to_timestamp(F.nullif(F.regexp_extract(name, r"_V(\d{8}T\d{6})_(\d{8}T\d{6})", k), F.lit("")), F.lit("yyyyMMdd'T'HHmmss"))
    return {"type": kind, "start": at(1), "stop": at(2)}


def orbit_coverage(rows: DataFrame, name: str = "name", t: str = "t") -> DataFrame:
    """rows with type, start, stop and covers: whether the file's validity holds the time; null if the name has none."""
    rows = rows.withColumns(orbit_file(F.col(name)))
    covers = F.when(F.col("start").isNotNull() & F.col("stop").isNotNull(), F.col(t).between(F.col("start"), F.col("stop")))
    return rows.withColumn("covers", covers)


def orbit_assigned(times: DataFrame, files: DataFrame, bucket_seconds: int, keys: list[str] | None = None) -> DataFrame:
    """times(tid, t, keys) with the orbit file(name, keys) that covers each: a precise one before a restituted one, the
    latest begun before others, then by name; null where none does. Files without a window in their names cover nothing.
    One row a time and task is kept before the shuffle, so a key whose files all overlap is no burden."""
    spans = files.withColumns(orbit_file(F.col("name"))).where("start is not null and stop is not null and start <= stop")
    hits = covering(times, spans, bucket_seconds, keys)
    rank = F.when(F.col("type") == "POEORB", 0).when(F.col("type") == "RESORB", 1).otherwise(2)
    best = hits.groupBy("tid").agg(F.min(F.struct(rank.alias("rank"), (-F.unix_timestamp("start")).alias("begun"), "name", "type")).alias("_b"), F.count("*").alias("n_covering"))
    best = best.select("tid", F.col("_b.name").alias("orbit"), F.col("_b.type").alias("type"), "n_covering")
    return times.select("tid").join(best, "tid", "left").withColumn("n_covering", F.coalesce("n_covering", F.lit(0)))


def frame_at_hour(granules: DataFrame, keys: list[str], hour: int) -> DataFrame:
    """granules(keys, name, seq) -> for each of keys the frame with the most granules among those whose last granule was
    taken in the full hour; without such, among those one hour off; without these, among all. Ties go to the frame that
    came first. Granules whose names tell no frame are left out; a name without a time has the hour -1."""
    frame = F.get(F.filter(F.split("name", "_"), lambda p: p.startswith("F")), 0)
    taken = F.coalesce(F.nullif(F.regexp_extract("name", r"_\d{8}T(\d{2})\d{4}Z_", 1), F.lit("")).cast("int"), F.lit(-1))
    one = granules.select(*keys, "seq", frame.alias("frame"), taken.alias("hour")).where("frame is not null")
    frames = one.groupBy(*keys, "frame").agg(F.count("*").alias("n"), F.max_by("hour", "seq").alias("hour"), F.min("seq").alias("first"))
    off = F.abs(F.col("hour") - hour)
    tier = F.when(off == 0, 0).when(off <= 1, 1).otherwise(2)
    best = frames.groupBy(*keys).agg(F.min(F.struct(tier.alias("tier"), (-F.col("n")).alias("less"), "first", "frame", "hour")).alias("_b"))
    return best.select(*keys, F.col("_b.frame").alias("frame"), F.col("_b.hour").alias("hour"), (-F.col("_b.less")).alias("n"), F.col("_b.tier").alias("tier"))

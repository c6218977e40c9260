"""Files, tiles, windows, candidates and stable terrain over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import probes as P
from ..sources import io
from .shaping import Registry, rounded
from .tables import table, with_tables

REG = Registry()


@REG.add("select n_name as name, sha256(n_name || chr(10)) as sha256, 'reused' as cache_mode from nation union all select n_name || ' lost', null, 'missing' from nation")
def io08_file_hashes(spark, sf_dir):
    """A file for each nation, and as many that are expected but are not there."""
    n = table(spark, sf_dir, "nation").select("n_name")
    folder = io.new_folder(spark)
    n.select(F.col("n_name").alias("value"), F.col("n_name").alias("of")).repartition("of").sortWithinPartitions("of").write.partitionBy("of").text(folder)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    name = F.regexp_replace(F.url_decode(F.regexp_extract("path", "/of=([^/]*)/", 1)), "[+]", " ")
    there = files.select(name.alias("name"), "path", F.lit("reused").alias("cache_mode"))
    lost = n.select(F.concat("n_name", F.lit(" lost")).alias("name"), F.concat(F.lit(f"{folder}/lost/"), F.col("n_name")).alias("path"), F.lit("missing").alias("cache_mode"))
    return P.provenance(spark, there.unionByName(lost), folder).select("name", "sha256", "cache_mode")


@REG.add(with_tables("grid") + "select 0 as scene_id, row, col, round(value, 6) as value from grid where row < (select (max(row) + 1) // 10 * 10 from grid)")
def io01_tiles(spark, sf_dir):
    """Pixels packed into arrays of ten by ten, -9999 for nodata, and taken apart again."""
    g = table(spark, sf_dir, "grid")
    cell = F.struct((F.col("row") % 10 * 10 + F.col("col") % 10).alias("at"), F.coalesce("value", F.lit(-9999.0)).alias("v"))
    tiles = g.groupBy(F.expr("row div 10").alias("tile_row"), F.expr("col div 10").alias("tile_col")).agg(F.array_sort(F.collect_list(cell)).alias("c"), F.count("*").alias("n"))
    tiles = tiles.where("n = 100").select(F.lit(0).alias("scene_id"), "tile_row", "tile_col", F.transform("c", lambda x: x.v).alias("data"))
    return rounded(P.tiles_to_pixels(tiles, 10, 10, -9999.0))


@REG.add(
    with_tables("polygons")
    + """, w as (select id as pid, floor((60.0 - (cy + half)) / 0.25)::bigint as r0, floor((cx - half + 10.0) / 0.25)::bigint as c0, ceil(((cy + half) - (cy - half)) / 0.25)::bigint as h, ceil(((cx + half) - (cx - half)) / 0.25)::bigint as w from polygons),
c as (select pid, greatest(0, r0) as row_off, least(80, r0 + h) as row_end, greatest(0, c0) as col_off, least(120, c0 + w) as col_end from w) select *, row_end <= row_off or col_end <= col_off as empty from c"""
)
def n17_clipped_windows(spark, sf_dir):
    """Windows of a mosaic of 80 by 120 pixels; most boxes lie outside."""
    c = lambda s, axis: F.col(f"c{axis}") + s * F.col("half")
    b = table(spark, sf_dir, "polygons").select(F.col("id").alias("pid"), c(-1, "x").alias("xmin"), c(-1, "y").alias("ymin"), c(1, "x").alias("xmax"), c(1, "y").alias("ymax"))
    return P.clipped_windows(b, -10.0, 60.0, 0.25, 80, 120)


@REG.add(
    with_tables("polygons")
    + """, a as (select id as aid, cx - half as x0, cx + half as x1, cy - half as y0, cy + half as y1 from polygons),
e as (select event_id as bid, -32 + ((user_id * 7919) % 770) / 10.0 as x, 27 + ((event_id * 1047) % 450) / 10.0 as y, date_trunc('second', ts) as sensing, 'S1A_' || event_id as granule from events where ts >= '2024-01-05' and ts < '2024-01-25 00:00:01'),
m as (select aid, count(*) as granules, min(struct_pack(s := sensing, g := granule)) as e from a join e on x0 <= x + 1 and x <= x1 and y0 <= y + 0.5 and y <= y1 where sensing <= '2024-01-25' group by 1)
select a.aid, coalesce(granules, 0) as granules, epoch(m.e.s)::bigint as earliest, m.e.g as granule,
case a.aid % 4 when 1 then 'S1A_IW_SLC__1_' || a.aid || '.zip' when 2 then 'S1A_IW_SLC__2_' || a.aid || '.SAFE' when 3 then 'S1B_IW_SLC__0.zip' end as cached from a left join m using (aid)"""
)
def j13_probe_table(spark, sf_dir):
    """Each area's granules by box and time, the earliest, and the first archive in its folder."""
    k = F.col("id")
    c = lambda s, axis: F.col(f"c{axis}") + s * F.col("half")
    folder = F.concat(F.lit("safe/"), k.cast("string"))
    areas = table(spark, sf_dir, "polygons").select(k.alias("aid"), P.box_ring(c(-1, "x"), c(-1, "y"), c(1, "x"), c(1, "y")).alias("ring"), folder.alias("folder"))
    x, y = -32 + (F.col("user_id") * 7919 % 770) / 10.0, 27 + (F.col("event_id") * 1047 % 450) / 10.0
    e = table(spark, sf_dir, "events")
    granules = e.select(F.col("event_id").alias("bid"), P.box_ring(x, y, x + 1, y + 0.5).alias("ring"), F.date_trunc("second", F.col("ts").cast("timestamp")).alias("sensing"), F.concat(F.lit("S1A_"), F.col("event_id").cast("string")).alias("granule"))
    own = lambda form: F.format_string(form, k)
    files = F.when(k % 4 == 1, F.array(own("S1A_IW_SLC__1_%d.zip"), own("S1A_IW_SLC__0_%d.SAFE"))).when(k % 4 == 2, F.array(own("S1A_IW_SLC__2_%d.SAFE"), own("S1A_IW_GRDH_%d.zip"))).when(k % 4 == 3, F.array(F.lit("S1B_IW_SLC__7.zip"), F.lit("S1B_IW_SLC__0.zip"))).otherwise(F.array(F.lit("notes.txt")))
    listing = table(spark, sf_dir, "polygons").select(folder.alias("folder"), F.explode(files).alias("file"))
    return P.candidate_probe(areas, granules, listing, "2024-01-05 00:00:00", "2024-01-25 00:00:00", 1.0).withColumn("earliest", F.unix_timestamp("earliest"))


@REG.add(
    with_tables("grid")
    + """, m as (select quantile_cont(value, 0.5) as med from grid), z as (select event_id, row, col, value, coalesce(value, med) as z from grid, m),
g as (select event_id, value, coalesce((lead(z) over x - lag(z) over x) / 60.0, (lead(z) over x - z) / 30.0, (z - lag(z) over x) / 30.0, 0) as gx, coalesce((lead(z) over y - lag(z) over y) / 60.0, (lead(z) over y - z) / 30.0, (z - lag(z) over y) / 30.0, 0) as gy from z window x as (partition by row order by col), y as (partition by col order by row)),
s as (select *, event_id % 3 <> 0 as stable, case when event_id % 7 <> 0 then value / 3 + event_id % 11 end as ramp, case when value is not null then degrees(atan(sqrt(gx * gx + gy * gy))) end as slope from g),
u as (select * from s where stable and value is not null)
select (select count(*) from s where stable) as stable_pixels, (select round(avg(stable::int), 6) from s) as retention, round(min(value), 6) as least, round(max(value), 6) as most, round(quantile_cont(slope, 0.5), 5) as slope_p50, round(quantile_cont(slope, 0.9), 5) as slope_p90,
round(corr(slope, ramp), 6) as slope_ramp_r from u"""
)
def m20_stable_terrain(spark, sf_dir):
    k = F.col("event_id")
    g = table(spark, sf_dir, "grid").withColumn("scene_id", F.lit(0)).withColumns({"stable": k % 3 != 0, "ramp": F.when(k % 7 != 0, F.col("value") / 3 + k % 11)})
    out = rounded(P.stable_terrain(g, "value", 30.0, 30.0).drop("scene_id"))
    return out.withColumn("slope_p50", F.round("slope_p50", 5)).withColumn("slope_p90", F.round("slope_p90", 5))

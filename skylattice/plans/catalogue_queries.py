"""Catalogue, join and geometry operators over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalogue as C
from ..operators import geometry as G
from .shaping import Registry, rounded
from .tables import table, with_tables

REG = Registry()


@REG.add("select event_id, coalesce(try_cast(json_extract_string(props, '$.cloud') as double), try_cast(json_extract_string(props, '$.k') as double), 100.0) as cloud from events")
def a02_alias_coalesce(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", C.first_castable(F.col("props"), "double", "cloud", "k", default=100.0).alias("cloud"))


_COLL = "c as (select * from (values " + ", ".join("(" + ", ".join("null" if x is None else f"'{x}'" for x in r) + ")" for r in C.COLLECTIONS) + ") t(collection, product_type, r))"


@REG.add(
    f"with q as (select s_suppkey as id, case s_suppkey % 3 when 0 then 'SENTINEL-1' when 1 then 'SENTINEL-2' else 'sentinel-3-olci' end as collection, case s_suppkey % 4 when 0 then 'GRD' when 1 then 'S2MSI2A' when 2 then null else 'other' end as product_type from supplier), {_COLL} select id, coalesce(case when regexp_matches(q.collection, '^[a-z0-9]+(-[a-z0-9]+)+$') then q.collection end, r) as resolved from q left join c on q.collection = c.collection and q.product_type is not distinct from c.product_type"
)
def a04_resolve_collection(spark, sf_dir):
    k = F.col("s_suppkey")
    q = table(spark, sf_dir, "supplier").select(
        k.alias("id"), F.when(k % 3 == 0, "SENTINEL-1").when(k % 3 == 1, "SENTINEL-2").otherwise("sentinel-3-olci").alias("collection"),
        F.when(k % 4 == 0, "GRD").when(k % 4 == 1, "S2MSI2A").when(k % 4 == 3, "other").alias("product_type"),
    )
    return C.resolved_collection(q, spark.createDataFrame(C.COLLECTIONS, "c string, p string, r string")).select("id", "resolved")


@REG.add("select page_id, 's3://b/' || page_id || '/S1A_X.SAFE' as prefix from pages where page_id % 2 = 0 union all select page_id, null from pages where page_id % 2 <> 0")
def a05_archive_prefix(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    root = F.concat(F.lit("s3://b/"), F.col("page_id").cast("string"), F.when(F.col("page_id") % 2 == 0, "/S1A_X.SAFE/m/f.tif").otherwise("/S1A_X.SAFExy/f.tif"))
    return p.select("page_id", C.archive_prefix(F.array("url", root)).alias("prefix"))


@REG.add("select event_id, upper('t' || lpad((user_id % 175)::varchar, 3, '0') || '-' || lpad((event_id % 400000)::varchar, 6, '0') || '-iw' || (1 + event_id % 3)) as burst from events")
def a06_burst_id(spark, sf_dir):
    name = F.format_string("t%03d_%06d_iw%d", F.col("user_id") % 175, F.col("event_id") % 400000, 1 + F.col("event_id") % 3)
    return table(spark, sf_dir, "events").select("event_id", C.burst_id(name).alias("burst"))


@REG.add("select event_id, date_trunc('second', ts) as sensing, regexp_extract(event_type, '^([a-z]+)', 1) as kind from events")
def a07_name_fields(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("name", F.concat(F.col("event_type"), F.lit("_F"), F.col("event_id"), F.lit("_"), F.date_format("ts", "yyyyMMdd'T'HHmmss"), F.lit("Z")))
    return e.select("event_id", F.to_timestamp(F.regexp_extract("name", r"_(\d{8}T\d{6})Z", 1), "yyyyMMdd'T'HHmmss").alias("sensing"), F.regexp_extract("name", "^([a-z]+)", 1).alias("kind"))


@REG.add(with_tables("items") + "select id from items where orbit = 2 and cloud <= 30 and platform in ('click', 'view', 'purchase') and tile between 1 and 5")
def a09_scene_filter(spark, sf_dir):
    return table(spark, sf_dir, "items").where("orbit = 2 and cloud <= 30 and platform in ('click', 'view', 'purchase') and tile between 1 and 5").select("id")


@REG.add(with_tables("points") + "select pid, case when lon between 20 and 30 and lat between 39 and 44 then 'EL' when lon between -10 and -6 and lat between 39 and 42 then 'PT' when lon between -10 and 5 and lat between 35 and 45 then 'ES' end as country from points")
def a10_a11_country(spark, sf_dir):
    return table(spark, sf_dir, "points").select("pid", C.country(F.col("lon"), F.col("lat")).alias("country"))


@REG.add("select p_partkey, array_to_string(list_filter([case when not (32500 + p_partkey % 300 between 32601 and 32660 or 32500 + p_partkey % 300 between 32701 and 32760) then 'not UTM' end, case when not p_size between 25 and 35 then 'pixel size' end, case when p_partkey % 11 = 0 then 'no data group' end], lambda x: x is not null), '; ') as errors from part")
def a12_metadata_rules(spark, sf_dir):
    epsg = 32500 + F.col("p_partkey") % 300
    rules = {"not UTM": ~(epsg.between(32601, 32660) | epsg.between(32701, 32760)), "pixel size": ~F.col("p_size").between(25, 35), "no data group": F.col("p_partkey") % 11 == 0}
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(C.errors(rules), "; ").alias("errors"))


@REG.add("with l as (select rtrim(url, '/') as key, case when page_id % 11 = 0 then 0 else length(html) end as size from pages union all select regexp_extract(rtrim(url, '/'), '^(.*)/[^/]*$', 1) as key, 0 as size from pages), d as (select distinct key, size from l) select key, size::bigint as size from d where key not like '%/' and not (size = 0 and exists (select 1 from d e where starts_with(e.key, d.key || '/')))")
def io09_listing_cleanup(spark, sf_dir):
    p = table(spark, sf_dir, "pages").withColumn("key", F.rtrim("url", F.lit("/")))
    l = p.select("key", F.when(F.col("page_id") % 11 == 0, 0).otherwise(F.length("html")).cast("long").alias("size"))
    l = l.unionByName(p.select(F.regexp_extract("key", "^(.*)/[^/]*$", 1).alias("key"), F.lit(0).cast("long").alias("size"))).distinct()
    return C.without_markers(l)


@REG.add("with e as (select o_custkey, o_orderkey as key from orders), p as (select distinct l_orderkey as key from lineitem where l_quantity > 5) select o_custkey, bool_and(p.key is not null) as complete from e left join p using (key) group by 1")
def io10_manifest_complete(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("key"))
    p = table(spark, sf_dir, "lineitem").where("l_quantity > 5").select(F.col("l_orderkey").alias("key")).join(o, "key")
    return C.complete(o, p, "o_custkey")


@REG.add("select c_custkey % 97 as burst, max_by(c_name, c_custkey) as name, max(c_custkey) as seq from customer group by 1")
def io05_catalogue_upsert(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 97).alias("burst"), F.col("c_name").alias("name"), F.col("c_custkey").alias("seq"))
    return C.upserted(c, "burst", "seq")


@REG.add("select item_id, sha256(text) as sha256, length(text)::int as size from benchmark")
def io08_provenance(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", F.sha2("text", 256).alias("sha256"), F.char_length("text").alias("size"))


@REG.add(
    """with q as (select event_id as qid, user_id as track, ts as t from events),
f as (select event_id as fid, user_id as track, ts as sensing from events where event_type = 'view'),
h as (select qid, count(fid) as n, min(fid) as fid from q
  left join f on q.track = f.track and abs(epoch(date_trunc('second', sensing))::bigint - epoch(date_trunc('hour', t))::bigint) <= 3600 group by 1)
select qid, n, case n when 0 then 'NONE' when 1 then 'OK' else 'MULTIPLE' end as status, case n when 1 then fid end as fid from h"""
)
def j01_frame_by_hour(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumnRenamed("user_id", "track")
    frames = e.where("event_type = 'view'").select("track", F.col("event_id").alias("fid"), F.date_trunc("second", "ts").alias("sensing"))
    return C.matched_frame(e.select("track", F.col("event_id").alias("qid"), F.col("ts").alias("t")), frames, keys=["track"])


_SPANS = """s as (select event_id as sid, user_id as track, ts as start, ts + interval 2 hour as stop from events where event_type in ('view', 'click')),
q as (select event_id as tid, user_id as track, ts as t from events)"""


def _spans(spark, sf_dir):
    """All events as times, views and clicks as the start of spans of two hours."""
    e = table(spark, sf_dir, "events").withColumnRenamed("user_id", "track")
    starts = e.where("event_type in ('view', 'click')")
    s = starts.select("track", F.col("event_id").alias("sid"), F.col("ts").alias("start"), F.expr("ts + interval 2 hours").alias("stop"))
    return e.select("track", F.col("event_id").alias("tid"), F.col("ts").alias("t")), s


@REG.add(
    f"""with {_SPANS}, c as (select tid, min(sid) as first_sid, count(*) as n from q join s on q.track = s.track and t between start and stop group by 1)
select q.tid, c.first_sid, coalesce(n, 0) as n from q left join c using (tid)"""
)
def j02_j03_orbit_assignment(spark, sf_dir):
    q, s = _spans(spark, sf_dir)
    c = C.covering(q, s, 7200, keys=["track"]).groupBy("tid").agg(F.min("sid").alias("first_sid"), F.count("*").alias("n"))
    return q.select("tid").join(c, "tid", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@REG.add(
    f"""with {_SPANS}, c as (select tid, sid, row_number() over (partition by tid order by abs(epoch_us(t) - (epoch_us(start) + 3600000000)), sid) as r
from q join s on q.track = s.track and t between start and stop) select tid, sid from c where r = 1"""
)
def j04_slice_containing(spark, sf_dir):
    q, s = _spans(spark, sf_dir)
    gap = F.abs(F.unix_micros(F.col("t").cast("timestamp")) - (F.unix_micros(F.col("start").cast("timestamp")) + 3600000000))
    return C.first_by(C.covering(q, s, 7200, keys=["track"]), ["tid"], gap, F.col("sid")).select("tid", "sid")


@REG.add(with_tables("items") + ", r as (select *, row_number() over (partition by sensing::date order by (hour(sensing) = 6) desc, abs(minute(sensing) - 30), id) as k from items) select sensing::date as day, id from r where k = 1")
def j05_best_slice_a_day(spark, sf_dir):
    i = table(spark, sf_dir, "items").withColumn("day", F.to_date("sensing"))
    return C.first_by(i, ["day"], (F.hour("sensing") == 6).desc(), F.abs(F.minute("sensing") - 30), F.col("id")).select("day", "id")


@REG.add(with_tables("items") + ", d as (select tile, sensing::date as day, min(id) as id from items group by 1, 2), r as (select *, row_number() over (partition by tile order by day) as k from d) select tile, day, id from r where k <= 15")
def j06_first_dates(spark, sf_dir):
    from pyspark.sql import Window as W

    d = C.first_by(table(spark, sf_dir, "items").withColumn("day", F.to_date("sensing")), ["tile", "day"], F.col("id"))
    return d.withColumn("k", F.row_number().over(W.partitionBy("tile").orderBy("day"))).where("k <= 15").select("tile", "day", "id")


@REG.add(with_tables("items") + ", c as (select tile, platform, count(*) as n, min(id) as s from items group by 1, 2), r as (select *, row_number() over (partition by tile order by n desc, s) as rank from c) select tile, platform, n, rank::int as rank from r where rank <= 3")
def j07_j08_dominant(spark, sf_dir):
    return C.dominant(table(spark, sf_dir, "items"), ["tile"], "platform", "id", 3)


@REG.add(with_tables("items") + ", r as (select tile, orbit, id, row_number() over (partition by tile, orbit order by (month(sensing) between 1 and 6) desc, sensing, id) as k from items) select tile, orbit, id from r where k = 1")
def j09_earliest_in_season(spark, sf_dir):
    return C.first_by(table(spark, sf_dir, "items"), ["tile", "orbit"], F.month("sensing").between(1, 6).desc(), F.col("sensing"), F.col("id")).select("tile", "orbit", "id")


@REG.add(with_tables("items") + ", r as (select tile, orbit, id, case when cloud < 15 then 0 else 1 end as tier, row_number() over (partition by tile, orbit order by case when cloud < 15 then 0 else 1 end, cloud, id) as k from items where cloud < 30) select tile, orbit, id, tier from r where k = 1")
def j10_lowest_cloud(spark, sf_dir):
    i = table(spark, sf_dir, "items").where("cloud < 30").withColumn("tier", F.when(F.col("cloud") < 15, 0).otherwise(1))
    return C.first_by(i, ["tile", "orbit"], F.col("tier"), F.col("cloud"), F.col("id")).select("tile", "orbit", "id", "tier")


@REG.add(with_tables("items") + ", c as (select tile, orbit as rank, count(*) as found, min(cloud) as least_cloud from items group by 1, 2), w as (select tile, min(rank) filter (where least_cloud < 0.2) as winner from c group by 1) select c.tile, c.rank, found, round(least_cloud, 6) as least_cloud, winner from c join w using (tile) where rank <= coalesce(winner, 99)")
def j11_first_winner(spark, sf_dir):
    c = table(spark, sf_dir, "items").groupBy("tile", F.col("orbit").alias("rank")).agg(F.count("*").alias("found"), F.min("cloud").alias("least_cloud"))
    w = c.groupBy("tile").agg(F.min(F.when(F.col("least_cloud") < 0.2, F.col("rank"))).alias("winner"))
    return rounded(c.join(w, "tile").where(F.col("rank") <= F.coalesce("winner", F.lit(99))))


@REG.add(with_tables("polygons") + ", b as (select id, cx - half as x0, cx + half as x1, cy - half as y0, cy + half as y1 from polygons) select a.id as aid, b.id as bid from b a join b on a.x0 <= b.x1 and b.x0 <= a.x1 and a.y0 <= b.y1 and b.y0 <= a.y1")
def g01_boxes_meeting(spark, sf_dir):
    p = table(spark, sf_dir, "polygons")
    box = lambda name: p.select(F.col("id").alias(name), (F.col("cx") - F.col("half")).alias("xmin"), (F.col("cx") + F.col("half")).alias("xmax"), (F.col("cy") - F.col("half")).alias("ymin"), (F.col("cy") + F.col("half")).alias("ymax"))
    return G.boxes_meeting(box("aid"), box("bid"), 4.0)


@REG.add(with_tables("polygons") + ", t as (select id, cx - half - 0.2 as west, cx + half + 0.2 as east, cy - half - 0.2 as south, cy + half + 0.2 as north from polygons where id % 3 <> 0), f as (select id, cx as west, cx as east, cy as south, cy as north from polygons where id % 3 = 0 and id % 2 = 0) select p.id, round(coalesce(t.west, f.west), 4) as west, round(coalesce(t.north, f.north), 4) as north, t.id is null and f.id is null as missing from polygons p left join t using (id) left join f using (id)")
def g03_bounds_fallback(spark, sf_dir):
    p = table(spark, sf_dir, "polygons")
    t = p.where("id % 3 <> 0").select("id", (F.col("cx") - F.col("half") - 0.2).alias("tw"), (F.col("cy") + F.col("half") + 0.2).alias("tn"))
    f = p.where("id % 3 = 0 and id % 2 = 0").select("id", F.col("cx").alias("fw"), F.col("cy").alias("fn"))
    j = p.select("id").join(t, "id", "left").join(f, "id", "left")
    return rounded(j.select("id", F.coalesce("tw", "fw").alias("west"), F.coalesce("tn", "fn").alias("north"), (F.col("tw").isNull() & F.col("fw").isNull()).alias("missing")), 4)


@REG.add(with_tables("points", "polygons") + ", e as (select id, x0, y0, x1, y1 from (select id, unnest([cx - half, cx + half, cx]) as x0, unnest([cy - half, cy - half, cy + half]) as y0, unnest([cx + half, cx, cx - half]) as x1, unnest([cy - half, cy + half, cy - half]) as y1 from polygons)), c as (select pid, id, count(*) filter (where (y0 > lat) <> (y1 > lat) and lon < x0 + (lat - y0) * (x1 - x0) / nullif(y1 - y0, 0)) as n from points, e group by 1, 2) select pid, id from c where n % 2 = 1")
def g04_points_in_polygons(spark, sf_dir):
    pt = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    x, y, h = F.col("cx"), F.col("cy"), F.col("half")
    p = table(spark, sf_dir, "polygons").select("id", F.array(pt(x - h, y - h), pt(x + h, y - h), pt(x, y + h)).alias("ring"))
    return G.points_in_polygons(table(spark, sf_dir, "points").select("pid", "lon", "lat"), p, 4.0)


@REG.add(with_tables("points", "polygons") + ", s as (select cx as x0, cy as y0, cx + half as x1, cy - half as y1 from polygons), d as (select pid, lon as x, lat as y, x0, y0, x1, y1, greatest(0, least(1, ((lon - x0) * (x1 - x0) + (lat - y0) * (y1 - y0)) / ((x1 - x0) ^ 2 + (y1 - y0) ^ 2))) as t from points, s) select distinct pid from d where sqrt((x - x0 - t * (x1 - x0)) ^ 2 + (y - y0 - t * (y1 - y0)) ^ 2) <= 1.5")
def g06_distance_buffer(spark, sf_dir):
    s = table(spark, sf_dir, "polygons").select(F.col("cx").alias("x0"), F.col("cy").alias("y0"), (F.col("cx") + F.col("half")).alias("x1"), (F.col("cy") - F.col("half")).alias("y1"))
    p = table(spark, sf_dir, "points").select("pid", F.col("lon").alias("x"), F.col("lat").alias("y"))
    return G.within_distance(p, s, 1.5).select("pid")


@REG.add(with_tables("classes") + ", w as (select row, col from classes where cls = 5 and status = 0) select distinct a.event_id from classes a join w on (a.row - w.row) * (a.row - w.row) + (a.col - w.col) * (a.col - w.col) <= 9")
def g07_water_buffer(spark, sf_dir):
    return G.near_cells(table(spark, sf_dir, "classes"), (F.col("cls") == 5) & (F.col("status") == 0), 3).select("event_id")


@REG.add(with_tables("points") + "select (pid % 10) as tile, count(*) filter (where lon between -10 and 30 and lat between 35 and 60) as inside, count(*) filter (where not (lon between -10 and 30 and lat between 35 and 60)) as outside from points group by 1")
def g08_g09_bounds_clip(spark, sf_dir):
    inside = F.col("lon").between(-10, 30) & F.col("lat").between(35, 60)
    return table(spark, sf_dir, "points").groupBy((F.col("pid") % 10).alias("tile")).agg(F.count_if(inside).alias("inside"), F.count_if(~inside).alias("outside"))


# The usual series of the transverse Mercator projection, written out for SQL.
_A, _E2 = 6378137.0, (1 / 298.257223563) * (2 - 1 / 298.257223563)
_EP, _K0 = _E2 / (1 - _E2), 0.9996
_ARC = (
    f"{_A} * ({1 - _E2 / 4 - 3 * _E2**2 / 64 - 5 * _E2**3 / 256} * p - {3 * _E2 / 8 + 3 * _E2**2 / 32 + 45 * _E2**3 / 1024} * sin(2 * p)"
    f" + {15 * _E2**2 / 256 + 45 * _E2**3 / 1024} * sin(4 * p) - {35 * _E2**3 / 3072} * sin(6 * p))"
)


@REG.add(
    with_tables("points")
    + f""", z as (select pid, floor((lon + 180) / 6)::int + 1 as zone, radians(lat) as p, radians(lon - ((floor((lon + 180) / 6) + 1) * 6 - 183)) as l from points),
s as (select pid, zone, p, tan(p) ^ 2 as t, {_A} / sqrt(1 - {_E2} * sin(p) * sin(p)) as n, {_EP} * cos(p) * cos(p) as c, l * cos(p) as x, {_ARC} as m from z)
select pid, zone, round({_K0} * n * (x + (1 - t + c) * x ^ 3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * {_EP}) * x ^ 5 / 120) + 500000, 3) as easting,
round({_K0} * (m + n * tan(p) * (x ^ 2 / 2 + (5 - t + 9 * c + 4 * c * c) * x ^ 4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * {_EP}) * x ^ 6 / 720)), 3) as northing from s"""
)
def g02_project_points(spark, sf_dir):
    p = table(spark, sf_dir, "points")
    zone = F.floor((F.col("lon") + 180) / 6).cast("int") + 1
    e, n = G.mercator_utm(F.col("lon"), F.col("lat"), zone)
    return p.select("pid", zone.alias("zone"), F.round(e, 3).alias("easting"), F.round(n, 3).alias("northing"))

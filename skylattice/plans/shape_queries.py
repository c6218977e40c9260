"""Polygons and projections over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import geometry as G
from ..operators import polygons as P
from ..operators import projections as J
from ..sources import io
from .shaping import Registry, rounded
from .tables import table, with_tables

REG = Registry()


def _rings(spark, sf_dir, name):
    """(id, ring) from corners: a ring is as long as its shape has corners."""
    corner = F.struct(F.col("k"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    rows = table(spark, sf_dir, name).groupBy("id").agg(F.array_sort(F.collect_list(corner)).alias("c"))
    return rows.select("id", F.transform("c", lambda c: F.struct(c.x.alias("x"), c.y.alias("y"))).alias("ring"))


def _edges_sql(name: str, out: str) -> str:
    order = "over (partition by id order by k)"
    return f"{out} as (select id, k, x::double as ax, y::double as ay, coalesce(lead(x) {order}, first_value(x) {order})::double as bx, coalesce(lead(y) {order}, first_value(y) {order})::double as by_ from {name})"


_MEETING = f"""
, {_edges_sql('corners', 'ea')}, {_edges_sql('footprints', 'eb')},
ba as (select id, min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1 from corners group by 1),
bb as (select id, min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1 from footprints group by 1),
near as (select ba.id as aid, bb.id as bid from ba join bb on ba.x0 <= bb.x1 and bb.x0 <= ba.x1 and ba.y0 <= bb.y1 and bb.y0 <= ba.y1),
cross_ as (
  select distinct aid, bid from near join ea on ea.id = aid join eb on eb.id = bid
  where greatest(ea.ax, ea.bx) >= least(eb.ax, eb.bx) and greatest(eb.ax, eb.bx) >= least(ea.ax, ea.bx)
    and greatest(ea.ay, ea.by_) >= least(eb.ay, eb.by_) and greatest(eb.ay, eb.by_) >= least(ea.ay, ea.by_)
    and sign((ea.bx - ea.ax) * (eb.ay - ea.ay) - (ea.by_ - ea.ay) * (eb.ax - ea.ax)) * sign((ea.bx - ea.ax) * (eb.by_ - ea.ay) - (ea.by_ - ea.ay) * (eb.bx - ea.ax)) <= 0
    and sign((eb.bx - eb.ax) * (ea.ay - eb.ay) - (eb.by_ - eb.ay) * (ea.ax - eb.ax)) * sign((eb.bx - eb.ax) * (ea.by_ - eb.ay) - (eb.by_ - eb.ay) * (ea.bx - eb.ax)) <= 0
),
a_in_b as (
  select aid, bid from near join corners c on c.id = aid and c.k = 0 join eb e on e.id = bid
  where (e.ay > c.y) <> (e.by_ > c.y) and c.x < e.ax + (c.y - e.ay) * (e.bx - e.ax) / nullif(e.by_ - e.ay, 0) group by 1, 2 having count(*) % 2 = 1
),
b_in_a as (
  select aid, bid from near join footprints c on c.id = bid and c.k = 0 join ea e on e.id = aid
  where (e.ay > c.y) <> (e.by_ > c.y) and c.x < e.ax + (c.y - e.ay) * (e.bx - e.ax) / nullif(e.by_ - e.ay, 0) group by 1, 2 having count(*) % 2 = 1
)
select aid, bid from cross_ union select aid, bid from a_in_b union select aid, bid from b_in_a"""


@REG.add(with_tables("corners", "footprints") + _MEETING)
def g01_polygons_meeting(spark, sf_dir):
    a = _rings(spark, sf_dir, "corners").withColumnRenamed("id", "aid")
    b = _rings(spark, sf_dir, "footprints").withColumnRenamed("id", "bid")
    return P.polygons_meeting(a, b, 2.0)


@REG.add(
    with_tables("corners") + ", " + _edges_sql("corners", "e")
    + """, f as (select id, case when ay <= by_ then ax else bx end / 0.5 as xa, least(ay, by_) / 0.5 as ya, case when ay <= by_ then bx else ax end / 0.5 as xb, greatest(ay, by_) / 0.5 as yb from e),
r as (select *, unnest(range(floor(ya)::bigint, floor(yb)::bigint + 1)) as row from f),
s as (select *, (xb - xa) / nullif(yb - ya, 0) as slope, yb >= row + 1 as above from r),
t as (select id, row, case when ya >= row then xa else xa + (row - ya) * slope end as lo, case when above and yb > row + 1 then xa + (row + 1 - ya) * slope else xb end as hi, xb > xa and above and ya < yb as open from s),
u as (select id, row, floor(least(lo, hi))::bigint as first, case when open then ceil(hi)::bigint - 1 else floor(greatest(lo, hi))::bigint end as last from t),
touched as (select id, row, unnest(range(first, greatest(first, last) + 1)) as col from u),
box as (select id, min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1 from corners group by 1),
cells as (select id, row, unnest(range(floor(x0 / 0.5)::bigint, floor(x1 / 0.5)::bigint + 1)) as col from (select *, unnest(range(floor(y0 / 0.5)::bigint, floor(y1 / 0.5)::bigint + 1)) as row from box)),
filled as (select c.id, row, col from cells c join e on e.id = c.id where (ay > (row + 0.5) * 0.5) <> (by_ > (row + 0.5) * 0.5) and (col + 0.5) * 0.5 < ax + ((row + 0.5) * 0.5 - ay) * (bx - ax) / (by_ - ay) group by 1, 2, 3 having count(*) % 2 = 1),
both_ as (select id, row, col, false as centre from touched union all select id, row, col, true from filled)
select id, row, col, bool_or(centre) as centre from both_ group by 1, 2, 3"""
)
def g05_touched_polygons(spark, sf_dir):
    """The cells each shape touches, and whether it holds their centres too."""
    return P.covered(_rings(spark, sf_dir, "corners"), 0.5)


@REG.add(with_tables("points") + "select pid, floor((lon + 180) / 6)::int + 1 as zone, round(lon, 6) as lon, round(case when pid % 2 = 0 then lat else -lat end, 6) as lat, true as agrees from points")
def g02_grid_and_back(spark, sf_dir):
    """Points projected into their zones, half of them south of the equator, and back; agrees: with the other series."""
    south = F.col("pid") % 2 == 1
    zone = F.floor((F.col("lon") + 180) / 6).cast("int") + 1
    p = table(spark, sf_dir, "points").select("pid", F.col("lon").cast("double").alias("lon"), F.col("lat").cast("double").alias("lat"), zone.alias("zone"), south.alias("south"))
    signed = F.when(F.col("south"), -F.col("lat")).otherwise(F.col("lat"))
    east, north = J.to_utm(F.col("lon"), signed, F.col("zone"), F.col("south"))
    other_east, other_north = G.mercator_utm(F.col("lon"), F.col("lat"), F.col("zone"))
    p = p.withColumns({"east": east, "north": north, "other_east": other_east, "other_north": F.when(F.col("south"), 10000000 - other_north).otherwise(other_north)})
    lon, lat = J.from_utm(F.col("east"), F.col("north"), F.col("zone"), F.col("south"))
    agrees = (F.abs(F.col("east") - F.col("other_east")) < 0.01) & (F.abs(F.col("north") - F.col("other_north")) < 0.01)
    return rounded(p.select("pid", "zone", lon.alias("lon"), lat.alias("lat"), agrees.alias("agrees")))


@REG.add(with_tables("points") + "select round(lon, 6) as lon, round(lat, 6) as lat, round(mean_velocity, 6) as mean_velocity, case when pid % 2 = 0 then round(mean_velocity_std, 6) end as mean_velocity_std from points")
def io03_grid_points(spark, sf_dir):
    """Point files of two layouts: metres on the equal-area grid, and degrees."""
    p = table(spark, sf_dir, "points").select("pid", *[F.col(c).cast("double").alias(c) for c in ("lon", "lat", "mean_velocity", "mean_velocity_std")])
    east, north = J.to_laea(F.col("lon"), F.col("lat"))
    folder = io.new_folder(spark)
    older = p.where("pid % 2 = 0").select("pid", east.alias("easting"), north.alias("northing"), "mean_velocity", F.col("mean_velocity_std").alias("std_velocity"))
    older.write.option("header", True).csv(f"{folder}/older")
    p.where("pid % 2 = 1").select("pid", F.col("lon").alias("longitude"), F.col("lat").alias("latitude"), "mean_velocity").write.option("header", True).csv(f"{folder}/newer")
    return rounded(io.read_points(spark, [f"{folder}/older", f"{folder}/newer"]))

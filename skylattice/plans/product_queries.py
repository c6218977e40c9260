"""Whole product comparisons and the rest of the catalogue operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalogue as C
from ..operators import products as P
from .raster_queries import _PIX, _grid, _pixel_points
from .shaping import Registry, rounded
from .tables import table, with_tables

REG = Registry()


@REG.add(
    with_tables("grid")
    + """, p as (select row, col, (row + 0.5) * 1.0 - 0.5 as y, (col + 0.5) * 1.0 - 0.5 as x from grid), q as (select a.row, a.col, case when a.value > 0 then 10 * log10(a.value) end as predicted, case when a.value * 1.02 + 0.5 > 0 then 10 * log10(a.value * 1.02 + 0.5) end as reference from grid a)
select round(sqrt(avg((predicted - reference) ^ 2)), 6) as rmse, round(corr(predicted, reference), 6) as correlation, round(avg(predicted - reference), 6) as bias, count(*) as n from q where predicted is not null and reference is not null"""
)
def m10_backscatter_agreement(spark, sf_dir):
    g = _grid(spark, sf_dir).select("scene_id", "row", "col", "value")
    return rounded(P.backscatter_agreement(g, g.withColumn("value", F.col("value") * 1.02 + 0.5)).drop("scene_id"))


@REG.add(with_tables("grid", "points") + f", {_PIX}, s as (select case when value <> 0 then -value * 0.05546576 / (4 * pi()) * 1000 end as predicted, mean_velocity as reference from p join points using (pid) join grid g on g.row = floor(y) and g.col = floor(x)) select count(*) as n, round(case when count(*) >= 100 then sqrt(avg((predicted - reference) ^ 2)) end, 4) as rmse, round(case when count(*) >= 100 then corr(predicted, reference) end, 4) as correlation, round(case when count(*) >= 100 then avg(predicted - reference) end, 4) as bias from s where predicted is not null")
def m13_point_agreement(spark, sf_dir):
    p = _pixel_points(spark, sf_dir).join(table(spark, sf_dir, "points").select("pid", F.col("mean_velocity").alias("reference")), "pid")
    return rounded(P.point_agreement(_grid(spark, sf_dir), p), 4)


@REG.add(with_tables("points") + ", m as (select quantile_cont(mean_velocity, 0.5) as m from points where mean_velocity_std < 2.0) select count(*) as points, count(*) filter (where mean_velocity_std < 2.0) as stable, count(*) filter (where mean_velocity_std < 2.0) as valid, case when count(*) filter (where mean_velocity_std < 2.0) >= 100 then round(avg(abs(mean_velocity - m)) filter (where mean_velocity_std < 2.0), 6) end as residual, case when count(*) filter (where mean_velocity_std < 2.0) < 100 then 'too_few_points' end as blocker from points, m")
def m14_stable_residual(spark, sf_dir):
    return rounded(P.stable_residual(table(spark, sf_dir, "points").select(F.col("mean_velocity").alias("value"), F.col("mean_velocity_std").alias("std"))))


_LAND = "l as (select event_id, row, col, case cls % 6 when 0 then 10 when 1 then 30 when 2 then 60 when 3 then 60 when 4 then 80 else 200 end as landcover, case when event_id % 37 = 0 then null else value / 10 end as slope, row < 3 as coast, jrc = 2 as water from classes)"


def _mask(spark, sf_dir):
    c = table(spark, sf_dir, "classes")
    k = F.col("cls") % 6
    land = F.when(k == 0, 10).when(k == 1, 30).when(k.isin(2, 3), 60).when(k == 4, 80).otherwise(200)
    l = c.select("event_id", "row", "col", land.alias("landcover"), F.when(F.col("event_id") % 37 != 0, F.col("value") / 10).alias("slope"), "jrc")
    return P.stable_mask(l, F.col("row") < 3, F.col("jrc") == 2)


@REG.add(with_tables("classes") + f", {_LAND} select event_id, (landcover = 60 and coalesce(slope <= 10, false) and not coast and not water) as stable from l")
def w01_stable_mask(spark, sf_dir):
    return _mask(spark, sf_dir).select("event_id", "stable")


@REG.add(with_tables("classes") + f", {_LAND} select count(*) filter (where landcover = 60) as bare, count(slope) as slope_known, count(*) filter (where coast) as coast, count(*) filter (where water) as water, count(*) filter (where landcover = 60 and coalesce(slope <= 10, false) and not coast and not water) as stable, round(avg((landcover = 60 and coalesce(slope <= 10, false) and not coast and not water)::int), 6) as retention from l")
def m26_mask_ledger(spark, sf_dir):
    return rounded(P.mask_ledger(_mask(spark, sf_dir)))


@REG.add(with_tables("stack") + ", p as (select row, col, bool_or(coh > 0.6) as valid from stack group by 1, 2) select count(*) filter (where valid) as valid, count(*) filter (where valid) < 100 as too_few from p")
def w02_burst_valid(spark, sf_dir):
    p = table(spark, sf_dir, "stack").groupBy("row", "col").agg(F.bool_or(F.col("coh") > 0.6).alias("valid"))
    return p.agg(F.count_if("valid").alias("valid"), (F.count_if("valid") < 100).alias("too_few"))


@REG.add("with p as (select o_custkey, o_orderdate::date as first, lead(o_orderdate::date) over (partition by o_custkey order by o_orderdate, o_orderkey) as second from orders) select o_custkey, first, second from p where abs(date_diff('day', first, second) - 12) <= 3")
def w13_sequential_pairs(spark, sf_dir):
    from pyspark.sql import Window as W

    w = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("first"), F.to_date(F.lead("o_orderdate").over(w)).alias("second"))
    return P.sequential_pairs(o, 12, 3)


@REG.add(
    with_tables("grid")
    + """, m as (select quantile_cont(value, 0.5) as med from grid), z as (select row, col, value, coalesce(value, med) as z from grid, m),
g as (select value, coalesce((lead(z) over x - lag(z) over x) / 60.0, (lead(z) over x - z) / 30.0, (z - lag(z) over x) / 30.0, 0) as gx, coalesce((lead(z) over y - lag(z) over y) / 60.0, (lead(z) over y - z) / 30.0, (z - lag(z) over y) / 30.0, 0) as gy from z window x as (partition by row order by col), y as (partition by col order by row)),
s as (select value, case when value is not null then degrees(atan(sqrt(gx * gx + gy * gy))) end as slope from g) select round(avg((value is null)::int), 6) as nodata, round(min(value), 6) as least, round(max(value), 6) as most, round(quantile_cont(slope, 0.5), 5) as slope_p50, round(quantile_cont(slope, 0.9), 5) as slope_p90 from s"""
)
def m19_m20_terrain_summary(spark, sf_dir):
    t = P.terrain_summary(_grid(spark, sf_dir), "value", 30.0, 30.0).drop("scene_id")
    return rounded(t).withColumn("slope_p50", F.round("slope_p50", 5)).withColumn("slope_p90", F.round("slope_p90", 5))


@REG.add(with_tables("polygons") + " select p.id, x.x::int as tile_x, y.y::int as tile_y from polygons p, lateral (select unnest(range(floor((cx - half) / 3)::bigint, floor((cx + half) / 3)::bigint + 1)) as x) x, lateral (select unnest(range(floor((cy - half) / 3)::bigint, floor((cy + half) / 3)::bigint + 1)) as y) y")
def n16_tile_cover(spark, sf_dir):
    b = table(spark, sf_dir, "polygons").select("id", *[(F.col(f"c{c}") + s * F.col("half")).alias(f"{c}{n}") for c in "xy" for n, s in (("min", -1), ("max", 1))])
    return P.tile_cover(b.toDF("id", "xmin", "xmax", "ymin", "ymax"), 3.0)


@REG.add(with_tables("grid") + ", t as (select event_id % 3 as rank, row // 2 as row, col // 2 as col, min(event_id) as value from grid group by 1, 2, 3), r as (select *, row_number() over (partition by row, col order by rank) as k from t) select rank, row, col, value from r where k = 1 and row between 2 and 40 and col between 3 and 45")
def n16_n17_mosaic_window(spark, sf_dir):
    g = table(spark, sf_dir, "grid")
    t = g.groupBy((F.col("event_id") % 3).alias("rank"), F.expr("cast(row div 2 as int)").alias("row"), F.expr("cast(col div 2 as int)").alias("col")).agg(F.min("event_id").alias("value"))
    return P.mosaic(t).where("row between 2 and 40 and col between 3 and 45")


@REG.add(with_tables("grid", "polygons") + ", b as (select (cx + 32) as x0, (cx + 32) + half as x1, (cy - 27) as y0, (cy - 27) + half as y1 from polygons) select distinct event_id from grid, b where x0 <= col + 1 and x1 >= col and y0 <= row + 1 and y1 >= row")
def g05_all_touched(spark, sf_dir):
    x, y = F.col("cx") + 32, F.col("cy") - 27
    b = table(spark, sf_dir, "polygons").select(x.alias("xmin"), (x + F.col("half")).alias("xmax"), y.alias("ymin"), (y + F.col("half")).alias("ymax"))
    return P.touched(table(spark, sf_dir, "grid").select("event_id", "row", "col"), b, 8.0).select("event_id")


@REG.add(
    """with e as (select event_id, event_type, event_type || '_' || event_id as gid, user_id % 3 as rank from events),
l as (select gid, rank, gid || '.' || rank as name from e where event_type = 'view' union all select gid, 1, gid || '.1' from e where event_type in ('view', 'click')),
r as (select gid, name, row_number() over (partition by gid order by rank, name) as k from l)
select event_id, r.name from e left join (select * from r where k = 1) r using (gid)"""
)
def io11_cached_lookup(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.concat_ws("_", "event_type", "event_id").alias("gid"), (F.col("user_id") % 3).alias("rank"))
    l = e.where("event_type = 'view'").select("gid", "rank")
    l = l.unionByName(e.where("event_type in ('view', 'click')").select("gid", F.lit(1).cast("long").alias("rank"))).withColumn("name", F.concat_ws(".", "gid", "rank"))
    first = C.first_by(l, ["gid"], F.col("rank"), F.col("name")).select("gid", "name")
    return e.select("event_id", "gid").join(first, "gid", "left").select("event_id", "name")


@REG.add("select l_orderkey, bool_or(l_linenumber = 1) and (bool_or(l_returnflag = 'R') or bool_or(l_returnflag = 'A' and l_quantity > 0)) as valid from lineitem group by 1")
def io12_archive_check(spark, sf_dir):
    c = F.col
    ok = F.bool_or(c("l_linenumber") == 1) & (F.bool_or(c("l_returnflag") == "R") | F.bool_or((c("l_returnflag") == "A") & (c("l_quantity") > 0)))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(ok.alias("valid"))


@REG.add("with need as (select unnest(['B02', 'B03', 'B04', 'SCL']) as band), h as (select p_partkey % 100 as scene, case p_partkey % 5 when 0 then 'B02' when 1 then 'B03' when 2 then 'B04' when 3 then 'SCL' else 'B01' end as band, min(p_name || p_partkey) as path from part where p_size > 10 group by 1, 2), s as (select distinct p_partkey % 100 as scene from part) select s.scene, need.band, h.path, h.path is null as missing from s, need left join h on h.scene = s.scene and h.band = need.band")
def io13_band_inventory(spark, sf_dir):
    k = F.col("p_partkey") % 5
    p = table(spark, sf_dir, "part").withColumn("scene", F.col("p_partkey") % 100)
    band = F.when(k == 0, "B02").when(k == 1, "B03").when(k == 2, "B04").when(k == 3, "SCL").otherwise("B01")
    have = p.where("p_size > 10").groupBy("scene", band.alias("band")).agg(F.min(F.concat("p_name", F.col("p_partkey").cast("string"))).alias("path"))
    need = p.select("scene").distinct().withColumn("band", F.explode(F.array(*[F.lit(b) for b in ("B02", "B03", "B04", "SCL")])))
    return need.join(have, ["scene", "band"], "left").withColumn("missing", F.col("path").isNull())


@REG.add(with_tables("items") + ", a as (select tile, min(cloud) as least_cloud, count(*) as n, min_by(id, struct_pack(s := sensing, i := id)) as earliest from items where orbit = 1 group by 1), t as (select distinct tile from items) select tile, coalesce(n, 0) as n, earliest from t left join a using (tile)")
def j13_candidate_probe(spark, sf_dir):
    i = table(spark, sf_dir, "items")
    a = i.where("orbit = 1").groupBy("tile").agg(F.count("*").alias("n"), F.min(F.struct("sensing", "id"))["id"].alias("earliest"))
    return i.select("tile").distinct().join(a, "tile", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@REG.add("with c as (select o_custkey % 60 as cell, avg(o_totalprice) / 200000 as coh, avg(o_totalprice - 150000) / 1000 as resid, case when o_custkey % 60 % 7 = 0 then null else (o_custkey % 60 % 9)::double end as egms from orders group by o_custkey % 60) select cell, case when coh is null or resid is null or egms is null then 'BLOCKER' when coh >= 0.75 and abs(resid) <= 2 and egms <= 5 then 'PASS' else 'FAIL' end as binding from c")
def v11_candidate_binding(spark, sf_dir):
    c = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 60).alias("cell")).agg((F.avg("o_totalprice") / 200000).alias("coh"), (F.avg(F.col("o_totalprice") - 150000) / 1000).alias("resid"))
    egms = F.when(F.col("cell") % 7 != 0, (F.col("cell") % 9).cast("double"))
    ok = (F.col("coh") >= 0.75) & (F.abs("resid") <= 2) & (egms <= 5)
    return c.select("cell", F.when(F.col("coh").isNull() | F.col("resid").isNull() | egms.isNull(), "BLOCKER").when(ok, "PASS").otherwise("FAIL").alias("binding"))

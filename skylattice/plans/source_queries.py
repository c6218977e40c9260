"""Sources and report rows over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stacks as K
from ..operators import verdicts as V
from ..sources import io
from .raster_queries import _PLANE
from .shaping import Registry, rounded
from .tables import criteria, table, with_tables
from .verdict_queries import _RES, _results

REG = Registry()


@REG.add(with_tables("points") + "select round(lon, 6) as lon, round(lat, 6) as lat, round(mean_velocity, 6) as mean_velocity, case when pid % 2 = 0 then round(mean_velocity_std, 6) end as mean_velocity_std from points")
def io03_points(spark, sf_dir):
    p = table(spark, sf_dir, "points").select("pid", *[F.col(c).cast("double").alias(c) for c in ("lon", "lat", "mean_velocity", "mean_velocity_std")])
    one = p.where("pid % 2 = 0").select(F.col("lon").alias("Longitude"), F.col("lat").alias("LATITUDE"), "mean_velocity", F.col("mean_velocity_std").alias("velocity_std"))
    two = p.where("pid % 2 = 1").select("lon", "lat", F.col("mean_velocity").alias("MEAN_VELOCITY"))
    return rounded(io.points(one).unionByName(io.points(two)))


@REG.add("select s_suppkey as id, case when s_suppkey % 3 = 0 then 1 else 3 end as n_points, round(case when s_suppkey % 3 = 0 then s_acctbal else s_acctbal + 1 end, 4) as x_max from supplier")
def io04_features(spark, sf_dir):
    pt = lambda dx, dy: F.struct((F.col("s_acctbal") + dx).alias("x"), F.lit(float(dy)).alias("y"))
    one = F.struct(F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 3 != 0, F.array(pt(0, 0), pt(1, 0), pt(0, 1))).alias("shape"), pt(0, 0).alias("centroid"))
    name = F.when(F.col("s_suppkey") % 2 == 0, F.to_json(F.struct(F.array(one).alias("features")))).otherwise(F.to_json(F.struct(F.array(one).alias("results"))))
    f = table(spark, sf_dir, "supplier").select(io.features(name).alias("f"))
    ring = F.coalesce("f.shape", F.array("f.centroid"))
    return f.select("f.id", F.size(ring).alias("n_points"), F.round(F.array_max(F.transform(ring, lambda p: p["x"])), 4).alias("x_max"))


@REG.add("select e.event_id as cell, case when event_id % 9 = 0 or event_id % 7 = 0 then 'RUN_FAILED' else 'OK' end as status, case when event_id % 9 = 0 then 'missing' when event_id % 7 = 0 then 'invalid' end as reason, case when event_id % 9 <> 0 and event_id % 7 <> 0 then round(value, 4) end as f1 from events e")
def io06_sidecars(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    path = F.concat(F.lit("m/"), F.col("event_id").cast("string"))
    text = F.when(F.col("event_id") % 7 == 0, F.lit("{broken")).otherwise(F.to_json(F.struct(F.round("value", 4).alias("f1"))))
    files = e.where("event_id % 9 <> 0").select(path.alias("path"), text.alias("content"))
    out = io.sidecars(e.select(F.col("event_id").alias("cell"), path.alias("path")), files, "f1 double")
    return out.select("cell", "status", "reason", F.col("record.f1").alias("f1"))


@REG.add(_RES + " select cell, criterion, case when value is null then '--' else format('{:.4f}', value) end as shown, case when verdict in ('UNKNOWN', 'MEASUREMENT_MISSING') then 'UNKNOWN' else verdict end as verdict from w")
def v17_report_rows(spark, sf_dir):
    v = V.evaluated(_results(spark, sf_dir), criteria(spark))
    shown = F.coalesce(F.format_string("%.4f", F.col("value")), F.lit("--"))
    unknown = F.col("verdict").isin("UNKNOWN", "MEASUREMENT_MISSING")
    return v.select("cell", "criterion", F.when(F.col("value").isNull(), "--").otherwise(shown).alias("shown"), F.when(unknown, "UNKNOWN").otherwise(F.col("verdict")).alias("verdict"))


@REG.add("with b as (select o_orderkey % 50 as cell, o_totalprice / 400000 < 0.5 as ok from orders), c as (select cell, count(*) filter (where ok) as passed, count(*) as n from b group by 1) select cell, passed || '/' || n || ' PASS' || case when passed < n then ' !' else '' end as text from c")
def v06_cell_text(spark, sf_dir):
    b = table(spark, sf_dir, "orders").groupBy((F.col("o_orderkey") % 50).alias("cell")).agg(F.count_if(F.col("o_totalprice") / 400000 < 0.5).alias("passed"), F.count("*").alias("n"))
    return b.select("cell", F.concat(F.col("passed").cast("string"), F.lit("/"), F.col("n").cast("string"), F.lit(" PASS"), F.when(F.col("passed") < F.col("n"), " !").otherwise("")).alias("text"))


@REG.add(
    with_tables("ifg") + _PLANE
    + """, a as (select avg(abs(sx)) * 512 as x, avg(abs(sy)) * 512 as y, stddev_pop(degrees(atan2(sy, sx))) as sd from f) select round(-(x + y) * (365.25 / 12) * (0.05546576 / (4 * pi()) * 1000), 3) as trend, round(-x * (365.25 / 12) * (0.05546576 / (4 * pi()) * 1000), 3) as residual, round(sd, 4) as direction_sd,
abs((x + y) * (365.25 / 12) * (0.05546576 / (4 * pi()) * 1000)) > 3 or abs(x * (365.25 / 12) * (0.05546576 / (4 * pi()) * 1000)) > 2 as flagged from a"""
)
def w16_deformation_sanity(spark, sf_dir):
    r = K.ramps(table(spark, sf_dir, "ifg"), 4)
    x, y = F.avg(F.abs("slope_x")) * 512, F.avg(F.abs("slope_y")) * 512
    k = 365.25 / 12 * K.MM_PER_RADIAN
    a = r.agg((-(x + y) * k).alias("trend"), (-x * k).alias("residual"), F.stddev_pop("direction").alias("direction_sd"))
    return a.select(F.round("trend", 3).alias("trend"), F.round("residual", 3).alias("residual"), F.round("direction_sd", 4).alias("direction_sd"), ((F.abs("trend") > 3) | (F.abs("residual") > 2)).alias("flagged"))

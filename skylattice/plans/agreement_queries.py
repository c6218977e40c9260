"""Whole product comparisons over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import agreement as A
from .pixel_queries import _DIAG, _INDEX
from .shaping import Registry, rounded
from .tables import table, with_tables

REG = Registry()


def _scores_sql(where: str, prefix: str = "") -> str:
    tp, fp, fn = (f"count(*) filter (where {where} and predicted = {p} and reference = {r})" for p, r in ((1, 1), (1, 0), (0, 1)))
    right, total = f"count(*) filter (where {where} and predicted = reference)", f"count(*) filter (where {where})"
    ratio = lambda a, b: f"coalesce(round({a} / nullif({b}, 0), 6), 0)"
    return (
        f"{total} as {prefix}total, {ratio(f'2.0 * {tp}', f'2 * {tp} + {fp} + {fn}')} as {prefix}f1, {ratio(f'1.0 * {tp}', f'{tp} + {fp}')} as {prefix}precision,"
        f" {ratio(f'1.0 * {tp}', f'{tp} + {fn}')} as {prefix}recall, {ratio(f'1.0 * {right}', total)} as {prefix}accuracy"
    )


_VALID = "predicted is not null and reference is not null"


@REG.add(
    with_tables("classes")
    + f""", b as (select *, row // 20 as scene_id, case when cls in (1, 2, 3) then 1 when cls = 255 then null else 0 end as predicted, case jrc when 1 then 0 when 2 then 1 end as reference from classes),
s as (select a.event_id, max((coalesce(b.reference, 0) = 1)::int) as w, max((coalesce(b.reference, 0) <> 1)::int) as o from b a join b on a.scene_id = b.scene_id and abs(a.row - b.row) + abs(a.col - b.col) <= 1 group by 1),
j as (select b.*, (w = 1 and o = 1) as shore from b join s using (event_id))
select scene_id, count(*) filter (where shore) as shore_pixels, {_scores_sql(f'{_VALID} and not shore')}, {_scores_sql(_VALID, 'full_')} from j group by 1"""
)
def m15_water_two_sets(spark, sf_dir):
    """Water against its reference, off the shore and over all pixels, for scenes of twenty lines."""
    c = table(spark, sf_dir, "classes").withColumn("scene_id", F.expr("row div 20"))
    return rounded(A.water_agreement(c))


_STATUS = "case when event_id % 10 = 0 then 255 else (row // 5 + col // 6) % 9 end"


@REG.add(
    with_tables("classes")
    + f""", r as (select case when row = 0 then 9 else row // 20 % 5 end as scene_id, row, col, {_STATUS} as status from classes),
q as (select case when row = 0 then 9 else row // 20 % 5 end as scene_id, row, col, status from classes where event_id % 23 <> 0),
j as (select r.scene_id, case when q.status in (2,3,4,5,6,7,8) then 1 when q.status = 255 then null when q.status is not null then 0 end as predicted, case when r.status in (2,3,4,5,6,7,8) then 1 when r.status = 255 then null else 0 end as reference from r left join q using (scene_id, row, col)),
c as (select scene_id, {_scores_sql(_VALID)} from j group by 1)
select scene_id, total as n_valid, case when total >= 100 then precision end as precision, case when total >= 100 then recall end as recall, case when total >= 100 then f1 end as f1, case when total >= 100 then accuracy end as accuracy from c"""
)
def m16_disturbance_agreement(spark, sf_dir):
    """Disturbance of a product with gaps against a reference with nodata; one scene is a single line, too few pixels."""
    scene = F.expr("case when row = 0 then 9 else row div 20 % 5 end").alias("scene_id")
    c = table(spark, sf_dir, "classes")
    status = F.when(F.col("event_id") % 10 == 0, 255).otherwise((F.expr("row div 5") + F.expr("col div 6")) % 9)
    reference = c.select(scene, "row", "col", status.cast("int").alias("status"))
    return rounded(A.disturbance_agreement(c.where("event_id % 23 <> 0").select(scene, "row", "col", "status"), reference))


_REGIONS = [("nam", 0.124, 0.0, -0.5), ("eu", 0.2, 100.0, -0.4)]
_REGION_DIAG = _DIAG.replace("0.124::float", "wigt::float").replace("awesh > 0::float", "awesh > awgt::float").replace("(-0.5)::float", "pswt2::float")


@REG.add(
    with_tables("bands")
    + f""", {_INDEX}, g as (select *, case event_id % 4 when 0 then 'EU' when 1 then 'nam' when 2 then null else 'xx' end as region from i),
h as (select g.*, r.wigt, r.awgt, r.pswt2 from g left join (values {', '.join(f"('{n}', {w}::double, {a}::double, {p}::double)" for n, w, a, p in _REGIONS)}) r(region, wigt, awgt, pswt2) on r.region = lower(coalesce(g.region, 'nam'))),
d as (select event_id, case when wigt is not null then {_REGION_DIAG} end as diagnostic from h) select event_id, diagnostic, case when diagnostic is not null then {list(S.WATER_CLASS)}[diagnostic + 1] end as water_class from d"""
)
def t10_region_classes(spark, sf_dir):
    """Water classes by each region's own thresholds; no region stands for the default one, an unknown one has none."""
    k = F.col("event_id") % 4
    region = F.when(k == 0, "EU").when(k == 1, "nam").when(k == 3, "xx")
    b = table(spark, sf_dir, "bands").withColumns(S.index_bands())
    d = A.region_thresholds(b, region, _REGIONS).withColumn("diagnostic", A.region_diagnostic())
    return d.select("event_id", "diagnostic", F.when(F.col("diagnostic").isNotNull(), S.water_class(F.col("diagnostic"))).alias("water_class"))


@REG.add(
    with_tables("scores")
    + """, s as (select aoi, season, wigt, awgt, f1 from scores where wigt is not null), m as (select wigt, awgt, avg(f1) as mean_f1 from s group by 1, 2 order by 3 desc, 1, 2 limit 1),
o as (select *, (sum(f1) over w - f1) / nullif(count(*) over w - 1, 0) as others from s window w as (partition by wigt, awgt)),
r as (select *, row_number() over (partition by aoi, season order by others desc, wigt, awgt) as k from o where others is not null), l as (select avg(f1) as loocv, count(*) as folds from r where k = 1)
select folds, round(mean_f1, 6) as fit_mean_f1, round(loocv, 6) as loocv_mean_f1, round(mean_f1 - loocv, 6) as gap, case when mean_f1 - loocv >= 0.02 then 'BLOCKER' else 'OK' end as status from m, l"""
)
def c05_held_out_gap(spark, sf_dir):
    s = table(spark, sf_dir, "scores")
    return rounded(A.held_out_gap(s, ["aoi", "season"]).select("folds", "fit_mean_f1", "loocv_mean_f1", "gap", "status"))


@REG.add(
    with_tables("grid")
    + """, q as (select row, col, case when value > 0 then 10 * log10(value) end as x, case when value * 1.02 + 0.5 > 0 then 10 * log10(value * 1.02 + 0.5) end as y from grid),
v as (select row, col, x is not null and y is not null as ok, x, y from q), p as (select row, col, case when ok then x else 0.0 end as x, case when ok then y else 0.0 end as y from v),
rg as (select max(y) - min(y) as r, min(row) as r0, max(row) as r1, min(col) as c0, max(col) as c1 from v where ok),
m as (select a.row, a.col, sum(b.x) / 49 as ux, sum(b.y) / 49 as uy, sum(b.x * b.x) / 49 as xx, sum(b.y * b.y) / 49 as yy, sum(b.x * b.y) / 49 as xy from p a, rg, p b where a.row between r0 + 3 and r1 - 3 and a.col between c0 + 3 and c1 - 3 and b.row between a.row - 3 and a.row + 3 and b.col between a.col - 3 and a.col + 3 group by 1, 2),
s as (select avg(((2 * ux * uy + (0.01 * r) ^ 2) * (2 * 49.0 / 48 * (xy - ux * uy) + (0.03 * r) ^ 2)) / ((ux * ux + uy * uy + (0.01 * r) ^ 2) * (49.0 / 48 * (xx - ux * ux) + 49.0 / 48 * (yy - uy * uy) + (0.03 * r) ^ 2))) as ssim from m, rg),
c as (select sqrt(avg((x - y) ^ 2)) as rmse, corr(x, y) as correlation, avg(x - y) as bias, count(*) as n from v where ok)
select round(rmse, 6) as rmse, round(correlation, 6) as correlation, round(bias, 6) as bias, n, round(ssim, 6) as ssim from c, s"""
)
def m10_backscatter_whole(spark, sf_dir):
    """Backscatter in decibels against its reference: the agreement, and the structural similarity as its quality."""
    g = table(spark, sf_dir, "grid").select(F.lit(0).alias("scene_id"), "row", "col", "value")
    return rounded(A.backscatter_agreement(g, g.withColumn("value", F.col("value") * 1.02 + 0.5)).drop("scene_id"))

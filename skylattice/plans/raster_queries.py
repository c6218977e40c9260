"""Neighbourhood, re-grid and stack operators over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import metrics as M
from ..operators import neighbourhood as N
from ..operators import stacks as K
from .shaping import Registry, rounded
from .tables import table, with_tables

REG = Registry()


def _scene(df):
    return df.withColumn("scene_id", F.lit(0))


def _grid(spark, sf_dir):
    return _scene(table(spark, sf_dir, "grid"))


def _near(table_, flag, reach):
    """SQL: a.* with whether any pixel within reach rows and columns has the flag."""
    return f"select a.event_id, a.row, a.col, a.cls, max(({flag})::int) as near from {table_} a join {table_} b on b.row between a.row - {reach} and a.row + {reach} and b.col between a.col - {reach} and a.col + {reach} group by all"


@REG.add(with_tables("classes") + f", n as ({_near('classes', 'b.cls in (1, 2)', 3)}) select event_id, case when cls = 3 and near = 0 then 0 else cls end as cls from n")
def n01_wetland_rescue(spark, sf_dir):
    return N.rescued_wetland(_scene(table(spark, sf_dir, "classes"))).select("event_id", "cls")


@REG.add(
    with_tables("classes")
    + ", n as (select a.event_id, max((coalesce(b.jrc, 0) = 2)::int) as w, max((coalesce(b.jrc, 0) <> 2)::int) as o from classes a join classes b on abs(a.row - b.row) + abs(a.col - b.col) <= 1 group by 1) select event_id, (w = 1 and o = 1) as shore from n"
)
def n02_shoreline(spark, sf_dir):
    c = _scene(table(spark, sf_dir, "classes")).withColumn("water", (F.col("jrc") == 2).cast("int"))
    return N.shoreline(c, "water").select("event_id", "shore")


def _mirror(c, lo, hi):
    return f"case when {c} < {lo} then 2 * {lo} - 1 - ({c}) when {c} > {hi} then 2 * {hi} + 1 - ({c}) else {c} end"


_OFFSETS = "o as (select a.x as dr, b.x as dc from range(-2, 3) a(x), range(-2, 3) b(x))"


@REG.add(
    with_tables("grid")
    + f", g as (select event_id, row, col, coalesce(value, 0.0) as v from grid), e as (select max(row) as h, max(col) as w from g), {_OFFSETS}, m as (select g.event_id, {_mirror('g.row + o.dr', '0', 'e.h')} as r, {_mirror('g.col + o.dc', '0', 'e.w')} as c from g, e, o) select m.event_id, round(sum(v) / 25, 6) as mean from m join g on g.row = m.r and g.col = m.c group by 1"
)
def n03_boxcar(spark, sf_dir):
    g = _grid(spark, sf_dir).withColumn("value", F.coalesce("value", F.lit(0.0)))
    return rounded(N.boxcar(g, ["value"]).select("event_id", F.col("value").alias("mean")))


@REG.add(
    with_tables("stack")
    + f""", p as (select epoch, row, col, re, im, lead(re) over w as r2, lead(im) over w as i2 from stack window w as (partition by row, col order by epoch)),
q as (select epoch, row, col, re * r2 + im * i2 as pr, im * r2 - re * i2 as pi, re * re + im * im as p1, r2 * r2 + i2 * i2 as p2 from p where r2 is not null),
e as (select epoch, max(row) as h, max(col) as w from q group by 1), {_OFFSETS},
m as (select q.epoch, q.row, q.col, {_mirror('q.row + o.dr', '0', 'e.h')} as r, {_mirror('q.col + o.dc', '0', 'e.w')} as c from q join e using (epoch), o),
b as (select m.epoch, m.row, m.col, sum(pr) as pr, sum(pi) as pi, sum(p1) as p1, sum(p2) as p2 from m join q on q.epoch = m.epoch and q.row = m.r and q.col = m.c group by all)
select epoch, row, col, round(coalesce(sqrt(pr * pr + pi * pi) / nullif(sqrt(p1 * p2), 0), 0), 5) as coh from b"""
)
def n04_sequential_coherence(spark, sf_dir):
    return rounded(N.sequential_coherence(table(spark, sf_dir, "stack")), 5)


@REG.add(
    with_tables("grid")
    + """, m as (select quantile_cont(value, 0.5) as med from grid), z as (select event_id, row, col, value, coalesce(value, med) as z from grid, m),
g as (select event_id, value, coalesce((lead(z) over x - lag(z) over x) / 60.0, (lead(z) over x - z) / 30.0, (z - lag(z) over x) / 30.0, 0) as gx,
coalesce((lead(z) over y - lag(z) over y) / 60.0, (lead(z) over y - z) / 30.0, (z - lag(z) over y) / 30.0, 0) as gy from z window x as (partition by row order by col), y as (partition by col order by row))
select event_id, round(case when value is not null then degrees(atan(sqrt(gx * gx + gy * gy))) end, 6) as slope from g"""
)
def n05_slope(spark, sf_dir):
    return rounded(N.slope_degrees(_grid(spark, sf_dir), "value", 30.0, 30.0).select("event_id", "slope"))


_TARGET = "t as (select r.x::int as row, c.x::int as col from (select max(row) + 1 as h, max(col) + 1 as w from grid) e, lateral (select unnest(range(0, greatest(1, floor(h / {f})::int))) as x) r, lateral (select unnest(range(0, greatest(1, floor(w / {f})::int))) as x) c)"


def _target(g, factor):
    return N.target_grid(g.groupBy("scene_id").agg((F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width")), factor)


@REG.add(with_tables("grid") + f", {_TARGET.format(f='1.5')} select t.row, t.col, round(value, 6) as value from t left join grid g on g.row = floor((t.row + 0.5) * 1.5) and g.col = floor((t.col + 0.5) * 1.5)")
def n06_nearest_regrid(spark, sf_dir):
    g = _grid(spark, sf_dir)
    return rounded(N.nearest(g, _target(g, 1.5), 1.5).drop("scene_id"))


@REG.add(
    with_tables("grid")
    + f""", {_TARGET.format(f='0.7')}, p as (select row, col, (row + 0.5) * 0.7 - 0.5 as y, (col + 0.5) * 0.7 - 0.5 as x from t), d as (select a.x as dy, b.x as dx from range(0, 2) a(x), range(0, 2) b(x)),
q as (select p.row, p.col, floor(y) + dy as r, floor(x) + dx as c, (case dy when 1 then y - floor(y) else 1 - (y - floor(y)) end) * (case dx when 1 then x - floor(x) else 1 - (x - floor(x)) end) as w from p, d)
select q.row, q.col, round(sum(w * value) / nullif(sum(case when value is not null then w end), 0), 6) as value from q left join grid g on g.row = q.r and g.col = q.c group by 1, 2"""
)
def n07_bilinear_regrid(spark, sf_dir):
    g = _grid(spark, sf_dir)
    return rounded(N.bilinear(g, _target(g, 0.7), 0.7).drop("scene_id"))


@REG.add(with_tables("grid") + "select row // 3 as row, col // 3 as col, round(avg(value), 6) as value from grid group by 1, 2")
def n08_block_mean_regrid(spark, sf_dir):
    return rounded(N.block_mean(_grid(spark, sf_dir), 3).drop("scene_id"))


_PIX = "p as (select pid, (pid * 37 % 1100) / 10.0 as x, (pid * 53 % 1100) / 10.0 as y from points)"


def _pixel_points(spark, sf_dir):
    return table(spark, sf_dir, "points").select("pid", ((F.col("pid") * 37 % 1100) / 10.0).alias("x"), ((F.col("pid") * 53 % 1100) / 10.0).alias("y"))


@REG.add(with_tables("grid", "points") + f", {_PIX} select pid, round(value, 6) as value from p left join grid g on g.row = floor(y) and g.col = floor(x)")
def n11_sample_nearest(spark, sf_dir):
    return rounded(N.sample_nearest(_grid(spark, sf_dir), _pixel_points(spark, sf_dir)))


@REG.add(
    with_tables("grid", "points")
    + f""", {_PIX}, d as (select a.x as dy, b.x as dx from range(0, 2) a(x), range(0, 2) b(x)), q as (select pid, floor(y) + dy as r, floor(x) + dx as c, (case dy when 1 then y - floor(y) else 1 - (y - floor(y)) end) * (case dx when 1 then x - floor(x) else 1 - (x - floor(x)) end) as w from p, d)
select pid, round(case when count(*) filter (where value is null and w > 0) = 0 then sum(w * value) end, 6) as value from q left join grid g on g.row = r and g.col = c group by 1"""
)
def n12_sample_bilinear(spark, sf_dir):
    return rounded(N.sample_bilinear(_grid(spark, sf_dir), _pixel_points(spark, sf_dir)))


@REG.add(with_tables("grid", "points") + f", {_PIX} select pid, round(avg(value), 6) as value from p left join grid g on abs(g.row - round_even(y, 0)) <= 6 and abs(g.col - round_even(x, 0)) <= 6 and value is not null group by 1")
def n13_sample_block_mean(spark, sf_dir):
    return rounded(N.sample_block_mean(_grid(spark, sf_dir), _pixel_points(spark, sf_dir)))


@REG.add(
    with_tables("grid")
    + """, a as (select col * 5 as x, row * 5 as y, value from grid), b as (select col * 5 + 12 as x, row * 5 - 8 as y, value * 1.1 as value from grid),
e as (select greatest((select min(x) from a), (select min(x) from b)) as lx, least((select max(x) from a), (select max(x) from b)) as hx, greatest((select min(y) from a), (select min(y) from b)) as ly, least((select max(y) from a), (select max(y) from b)) as hy),
ra as (select dense_rank() over (order by x) as rx, dense_rank() over (order by y desc) as ry, value as predicted from a, e where x between lx and hx and y between ly and hy),
rb as (select dense_rank() over (order by x) as rx, dense_rank() over (order by y desc) as ry, value as reference from b, e where x between lx and hx and y between ly and hy)
select rx, ry, round(predicted, 6) as predicted, round(reference, 6) as reference from ra join rb using (rx, ry)"""
)
def n15_overlap_alignment(spark, sf_dir):
    g = _grid(spark, sf_dir)
    a = g.select("scene_id", (F.col("col") * 5).alias("x"), (F.col("row") * 5).alias("y"), "value")
    b = g.select("scene_id", (F.col("col") * 5 + 12).alias("x"), (F.col("row") * 5 - 8).alias("y"), (F.col("value") * 1.1).alias("value"))
    out = N.aligned_overlap(a, b)
    return rounded(out.select(F.col("rx").cast("long").alias("rx"), F.col("ry").cast("long").alias("ry"), "predicted", "reference"))


@REG.add(
    with_tables("grid")
    + """, q as (select row, col, coalesce(value, 0.0) as x, coalesce(value, 0.0) * 0.9 + (row % 3) as y0, value from grid), p as (select row, col, case when value is null then 0.0 else x end as x, case when value is null then 0.0 else y0 end as y from q),
rg as (select max(y0) - min(y0) as r, min(row) as r0, max(row) as r1, min(col) as c0, max(col) as c1 from q where value is not null),
m as (select a.row, a.col, sum(b.x) / 49 as ux, sum(b.y) / 49 as uy, sum(b.x * b.x) / 49 as xx, sum(b.y * b.y) / 49 as yy, sum(b.x * b.y) / 49 as xy from p a, rg, p b where a.row between r0 + 3 and r1 - 3 and a.col between c0 + 3 and c1 - 3 and b.row between a.row - 3 and a.row + 3 and b.col between a.col - 3 and a.col + 3 group by 1, 2)
select round(avg(((2 * ux * uy + (0.01 * r) ^ 2) * (2 * 49.0 / 48 * (xy - ux * uy) + (0.03 * r) ^ 2)) / ((ux * ux + uy * uy + (0.01 * r) ^ 2) * (49.0 / 48 * (xx - ux * ux) + 49.0 / 48 * (yy - uy * uy) + (0.03 * r) ^ 2))), 6) as ssim from m, rg"""
)
def m04_ssim(spark, sf_dir):
    g = _grid(spark, sf_dir).select("scene_id", "row", "col", F.col("value").alias("predicted"), (F.col("value") * 0.9 + F.col("row") % 3).alias("reference"))
    return rounded(N.ssim(g).drop("scene_id"))


@REG.add(with_tables("stack") + ", p as (select row, col, avg(coalesce(coh, 0)) as m, bool_and(coalesce(coh, 0) >= 0.6) as ok from stack group by 1, 2) select round(avg(m), 6) as mean, round(quantile_cont(m, 0.5), 6) as median, round(quantile_cont(m, 0.25), 6) as p25, round(quantile_cont(m, 0.75), 6) as p75, round(avg(ok::int), 6) as persistently_coherent_fraction, round(coalesce(quantile_cont(m, 0.5) filter (where ok), 0), 6) as median_of_persistent from p")
def w03_coherence_stats(spark, sf_dir):
    return rounded(K.coherence_stats(table(spark, sf_dir, "stack")))


@REG.add(with_tables("points") + ", a as (select quantile_cont(mean_velocity, 0.5) as m from points) select round(avg(mean_velocity - m), 6) as residual from points, a")
def w04_residual_mean(spark, sf_dir):
    return rounded(K.residual_mean(table(spark, sf_dir, "points"), "mean_velocity"))


_UNWRAP = """, d as (select row, col, epoch, days, phase, phase - lag(phase) over w as d from stack window w as (partition by row, col order by epoch)),
m as (select *, (d + pi()) - floor((d + pi()) / (2 * pi())) * 2 * pi() - pi() as dm from d), f as (select *, coalesce(case when abs(d) < pi() then 0 else (case when dm = -pi() and d > 0 then pi() else dm end) - d end, 0) as fix from m),
u as (select row, col, epoch, days, phase, phase + sum(fix) over (partition by row, col order by epoch) as unwrapped from f)"""
_MM = "(0.05546576 / (4 * pi()) * 1000)"


@REG.add(with_tables("stack") + _UNWRAP + f" select row, col, epoch, round(unwrapped, 6) as unwrapped from u")
def w05_temporal_unwrap(spark, sf_dir):
    return rounded(K.unwrapped(table(spark, sf_dir, "stack")).select("row", "col", "epoch", "unwrapped"))


@REG.add(with_tables("stack") + _UNWRAP + f", v as (select row, col, count(unwrapped) as n, regr_slope(unwrapped, days) as s from u group by 1, 2), p as (select row, col, count(phase) as n, regr_slope(phase, days) as s from u group by 1, 2) select v.row, v.col, round(case when v.n >= 3 then -v.s * {_MM} * 365.25 end, 5) as velocity, round(case when p.n >= 3 then p.s * {_MM} * 365.25 end, 5) as plain from v join p on v.row = p.row and v.col = p.col")
def w06_w07_velocity(spark, sf_dir):
    u = K.unwrapped(table(spark, sf_dir, "stack"))
    plain = K.velocity(u, "phase", sign=1.0).withColumnRenamed("velocity", "plain")
    return rounded(K.velocity(u).join(plain, ["row", "col"]), 5)


_PLANE = """, m as (select ifg_idx, count(*) as n, avg(col) as mx, avg(row) as my, avg(phase) as mz, var_pop(col) as xx, var_pop(row) as yy, covar_pop(col, row) as xy, covar_pop(col, phase) as xz, covar_pop(row, phase) as yz from ifg where phase <> 0 group by 1),
f as (select ifg_idx, n, (xz * yy - yz * xy) / (xx * yy - xy * xy) as sx, (yz * xx - xz * xy) / (xx * yy - xy * xy) as sy, mz - (xz * yy - yz * xy) / (xx * yy - xy * xy) * mx - (yz * xx - xz * xy) / (xx * yy - xy * xy) * my as c from m where n >= 4)"""


@REG.add(with_tables("ifg") + _PLANE + " select f.ifg_idx, f.n, round(sx, 6) as slope_x, round(sy, 6) as slope_y, round(c, 6) as intercept, round(max(sx * col + sy * row) - min(sx * col + sy * row), 6) as magnitude, round(degrees(atan2(sy, sx)), 5) as direction from f join ifg using (ifg_idx) where phase <> 0 group by f.ifg_idx, f.n, sx, sy, c")
def w08_ramp_fit(spark, sf_dir):
    return rounded(K.ramps(table(spark, sf_dir, "ifg"), 4)).withColumn("direction", F.round("direction", 5))


@REG.add(with_tables("ifg") + _PLANE + " select ifg_idx, row, col, round(phase - coalesce(sx * col + sy * row + c, 0), 6) as phase from ifg left join f using (ifg_idx)")
def w09_deramp(spark, sf_dir):
    return rounded(K.deramped(table(spark, sf_dir, "ifg"), 4).drop("coh"))


_AGG = """, g as (select f.ifg_idx, max(sx * col + sy * row) - min(sx * col + sy * row) as magnitude, atan2(sy, sx) as d, avg(coh) as coherence from f join ifg using (ifg_idx) where phase <> 0 group by f.ifg_idx, sx, sy),
a as (select count(*) as n, avg(magnitude) as mean_magnitude, degrees(sqrt(-2 * ln(least(1, sqrt(avg(sin(d)) ^ 2 + avg(cos(d)) ^ 2))))) as sigma, corr(magnitude, coherence) as r from g)"""


@REG.add(with_tables("ifg") + _PLANE + _AGG + " select n, round(mean_magnitude, 5) as mean_magnitude, round(sigma, 4) as direction_sigma, round(r, 4) as correlation, case when sigma < 30 and r > 0.5 then 'mixed' when sigma < 30 then 'orbit' when r > 0.5 then 'phass' else 'inconclusive' end as source from a")
def w10_w11_ramp_attribution(spark, sf_dir):
    i = table(spark, sf_dir, "ifg")
    coh = i.where("phase <> 0").groupBy("ifg_idx").agg(F.avg("coh").alias("coherence"))
    a = K.ramp_aggregate(K.ramps(i, 4).join(coh, "ifg_idx")).withColumn("source", K.attributed(F.col("direction_sigma"), F.col("correlation")))
    return a.select("n", F.round("mean_magnitude", 5).alias("mean_magnitude"), F.round("direction_sigma", 4).alias("direction_sigma"), F.round("correlation", 4).alias("correlation"), "source")


@REG.add(with_tables("ifg") + _PLANE + " select ifg_idx, round(sqrt(avg((phase - sx * col - sy * row - c) ^ 2)), 6) as residual_rms, sqrt(avg((phase - sx * col - sy * row - c) ^ 2)) > 0.1 as flagged from f join ifg using (ifg_idx) where phase <> 0 group by 1")
def w15_unwrap_quality(spark, sf_dir):
    return rounded(K.unwrap_quality(table(spark, sf_dir, "ifg"), 0.1))


def _sbas():
    return K.inversion_weights([(k, k + 1) for k in range(9)], [12.0 * k for k in range(10)])


@REG.add(
    with_tables("ifg")
    + f", w as (select * from (values {', '.join(f'({k}, {w!r}::double)' for k, w in _sbas().items())}) t(ifg_idx, w)) select row, col, round(sum(coalesce(phase, 0) * w) * {_MM} * 365.25, 5) as velocity from ifg join w using (ifg_idx) group by 1, 2"
)
def w14_small_baseline(spark, sf_dir):
    return rounded(K.inverted_velocity(table(spark, sf_dir, "ifg"), _sbas()), 5)


@REG.add(
    with_tables("stack")
    + ", p as (select epoch, re * lag(re) over w + im * lag(im) over w as r, im * lag(re) over w - re * lag(im) over w as i from stack window w as (partition by row, col order by epoch)), q as (select epoch, atan2(i, r) as a from p where sqrt(r * r + i * i) > 1e-12) select epoch, round(sqrt(avg(cos(a)) ^ 2 + avg(sin(a)) ^ 2), 6) as coherence, round(sqrt(avg(a * a)), 6) as phase_rms from q group by 1"
)
def t16_m11_phasor_agreement(spark, sf_dir):
    return rounded(K.phasor_agreement(table(spark, sf_dir, "stack"), "epoch"))


@REG.add(
    with_tables("classes")
    + """, b as (select *, case when status in (2,3,4,5,6,7,8) then 1 when status = 255 then null else 0 end as predicted, case jrc when 1 then 0 when 2 then 1 end as reference from classes),
s as (select a.event_id, max((coalesce(b.reference, 0) = 1)::int) as w, max((coalesce(b.reference, 0) <> 1)::int) as o from b a join b on abs(a.row - b.row) + abs(a.col - b.col) <= 1 group by 1), j as (select b.*, (w = 1 and o = 1) as shore from b join s using (event_id)),
c as (select count(*) filter (where predicted = 1 and reference = 1 and not shore) as tp, count(*) filter (where predicted = 1 and reference = 0 and not shore) as fp, count(*) filter (where predicted = 0 and reference = 1 and not shore) as fn, count(*) filter (where predicted = 0 and reference = 0 and not shore) as tn, count(*) filter (where predicted = reference and not shore) as correct, count(*) filter (where not shore) as total, count(*) filter (where shore) as shore from j)
select shore, total, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1, round(coalesce(correct / nullif(total, 0), 0), 6) as accuracy from c"""
)
def m15_m16_water_agreement(spark, sf_dir):
    c = _scene(table(spark, sf_dir, "classes")).withColumn("predicted", S.binary_disturbance(F.col("status"))).withColumn("reference", S.binary_reference_water(F.col("jrc")))
    j = N.shoreline(c, "reference")
    counts = j.groupBy("scene_id").agg(*M.confusion(~F.col("shore")), F.count_if(F.col("shore")).alias("shore")).withColumns(M.scores())
    return rounded(counts.select("shore", "total", "f1", "accuracy"))

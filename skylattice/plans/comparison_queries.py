"""Re-gridding by method and reference form, and whole comparisons, over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import comparison as X
from .raster_queries import _PIX, _TARGET, _grid, _pixel_points
from .shaping import Registry, rounded
from .tables import table, with_tables

REG = Registry()


def smooth_sql(name: str, sigma: float) -> str:
    """SQL: <name>(row, col, value), the grid under a Gaussian cut at four sigma, mirrored at the borders, nodata as 0."""
    reach = int(4 * sigma + 0.5)
    fold = lambda x, n: f"least((({x}) % (2 * {n}) + 2 * {n}) % (2 * {n}), 2 * {n} - 1 - (({x}) % (2 * {n}) + 2 * {n}) % (2 * {n}))"
    return f"""{name}k as (select k, exp(-0.5 * (k / {sigma}) ^ 2) / sum(exp(-0.5 * (k / {sigma}) ^ 2)) over () as w from range({-reach}, {reach + 1}) t(k)),
{name}e as (select max(row) + 1 as h, max(col) + 1 as n from grid),
{name}a as (select g.row, g.col, sum(w * coalesce(s.value, 0)) as value from grid g cross join {name}e cross join {name}k
  left join grid s on s.row = g.row and s.col = {fold('g.col + k', 'n')} group by 1, 2),
{name} as (select g.row, g.col, sum(w * coalesce(s.value, 0)) as value from grid g cross join {name}e cross join {name}k
  left join {name}a s on s.col = g.col and s.row = {fold('g.row + k', 'h')} group by 1, 2)"""


def corners_sql(name: str, source: str, y: str, x: str, keys: str) -> str:
    """SQL: <name>(keys, row, col, w), the four pixels around (y, x) of each row of source."""
    side = lambda v, d: f"case {d} when 1 then ({v}) - floor({v}) else 1 - (({v}) - floor({v})) end"
    return f"""{name} as (select {keys}, floor({y}) + dy as r, floor({x}) + dx as c, ({side(y, 'dy')}) * ({side(x, 'dx')}) as w
  from {source} cross join (select a.x as dy, b.x as dx from range(0, 2) a(x), range(0, 2) b(x)) d)"""


@REG.add(
    with_tables("grid")
    + f", {smooth_sql('s', 1.0)}, {_TARGET.format(f='2.0')} select t.row, t.col, round(s.value, 6) as value from t left join s on s.row = floor((t.row + 0.5) * 2.0) and s.col = floor((t.col + 0.5) * 2.0)"
)
def n09_gaussian_regrid(spark, sf_dir):
    g = _grid(spark, sf_dir).select("scene_id", "row", "col", "value")
    return rounded(X.prepared(g, _extent(g), method="gaussian", factor=2.0).drop("scene_id"))


def _extent(g):
    return g.groupBy("scene_id").agg((F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width"))


@REG.add(
    with_tables("grid", "points")
    + f", {_PIX}, {smooth_sql('s', 3.0)}, {corners_sql('q', 'p', 'y', 'x', 'pid')} "
    + "select pid, round(case when count(*) filter (where value is null and w > 0) = 0 then sum(w * value) end, 6) as value from q left join s on s.row = r and s.col = c group by 1"
)
def n14_sample_gaussian(spark, sf_dir):
    g = _grid(spark, sf_dir).select("scene_id", "row", "col", "value")
    return rounded(X.prepared(g, _pixel_points(spark, sf_dir), method="gaussian"))


@REG.add(
    with_tables("grid")
    + f", {smooth_sql('s', 1.0)}, {_TARGET.format(f='2.0')}, {corners_sql('q', 't', '(row + 0.5) * 2.0 - 0.5', '(col + 0.5) * 2.0 - 0.5', 'row, col')}"
    + """, u as (
select 'nearest' as method, t.row, t.col, g.value from t left join grid g on g.row = floor((t.row + 0.5) * 2.0) and g.col = floor((t.col + 0.5) * 2.0)
union all select 'gaussian', t.row, t.col, s.value from t left join s on s.row = floor((t.row + 0.5) * 2.0) and s.col = floor((t.col + 0.5) * 2.0)
union all select 'block_mean', t.row, t.col, avg(g.value) from t left join grid g on g.row // 2 = t.row and g.col // 2 = t.col group by 2, 3
union all select 'bilinear', q.row, q.col, sum(w * value) / nullif(sum(case when value is not null then w end), 0) from q left join grid g on g.row = r and g.col = c group by 2, 3)
select method, row, col, round(value, 6) as value from u"""
)
def n10_prepared_pixels(spark, sf_dir):
    g = _grid(spark, sf_dir).select("scene_id", "row", "col", "value")
    one = [X.prepared(g, _extent(g), method=m, factor=2.0).withColumn("method", F.lit(m)) for m in X.METHODS]
    return rounded(reduce(lambda a, b: a.unionByName(b), one).select("method", "row", "col", "value"))


@REG.add(
    with_tables("grid", "points")
    + f", {_PIX}, {smooth_sql('s', 3.0)}, {corners_sql('q', 'p', 'y', 'x', 'pid')}"
    + """, u as (
select 'nearest' as method, pid, value from p left join grid g on g.row = floor(y) and g.col = floor(x)
union all select 'gaussian', pid, case when count(*) filter (where value is null and w > 0) = 0 then sum(w * value) end from q left join s on s.row = r and s.col = c group by 2
union all select 'bilinear', pid, case when count(*) filter (where value is null and w > 0) = 0 then sum(w * value) end from q left join grid g on g.row = r and g.col = c group by 2
union all select 'block_mean', pid, avg(value) from p left join grid g on abs(g.row - round_even(y, 0)) <= 6 and abs(g.col - round_even(x, 0)) <= 6 and value is not null group by 2)
select method, pid, round(value, 6) as value from u"""
)
def n10_prepared_points(spark, sf_dir):
    g = _grid(spark, sf_dir).select("scene_id", "row", "col", "value")
    one = [X.prepared(g, _pixel_points(spark, sf_dir), method=m).withColumn("method", F.lit(m)) for m in X.METHODS]
    return rounded(reduce(lambda a, b: a.unionByName(b), one).select("method", "pid", "value"))


@REG.add(
    with_tables("grid")
    + f""", t as (select row // 2 as row, col // 2 as col, avg(value) * 1.1 as reference from grid group by 1, 2),
{corners_sql('q', 't', '(row + 0.5) * 2.0 - 0.5', '(col + 0.5) * 2.0 - 0.5', 'row, col, reference')},
v as (select q.row, q.col, reference, sum(w * value) / nullif(sum(case when value is not null then w end), 0) as los, sum(w * (30 + (g.row + g.col) % 10)) / sum(case when g.row is not null then w end) as angle
  from q left join grid g on g.row = r and g.col = c group by 1, 2, 3),
m as (select los / cos(radians(angle)) as predicted, reference from v where los is not null and angle is not null and reference is not null)
select count(*) as n, round(corr(predicted, reference), 6) as correlation, round(avg(predicted - reference), 6) as bias from m"""
)
def m12_ortho_agreement(spark, sf_dir):
    g = _grid(spark, sf_dir)
    cell = lambda c: F.expr(f"cast({c} div 2 as int)").alias(c)
    reference = g.groupBy("scene_id", cell("row"), cell("col")).agg((F.avg("value") * 1.1).alias("value"))
    angle = g.select("scene_id", "row", "col", (30 + (F.col("row") + F.col("col")) % 10).cast("double").alias("value"))
    product = g.select("scene_id", "row", "col", "value")
    return rounded(X.ortho_agreement(product, reference, angle, factor=2.0).drop("scene_id"))


@REG.add(
    with_tables("stack")
    + """, a as (select epoch, col * 5 as x, row * 5 as y, re * 4 as re, im * 4 as im from stack), b as (select epoch, col * 5 + 10 as x, row * 5 - 5 as y, re * 5 + 0.2 as re, im * 3 - 0.1 as im from stack),
p as (select epoch, sqrt(a.re ^ 2 + a.im ^ 2) as a, sqrt(b.re ^ 2 + b.im ^ 2) as b, a.re * b.re + a.im * b.im as c, a.im * b.re - a.re * b.im as s from a join b using (epoch, x, y)),
v as (select * from p where a > 0 and b > 0), n as (select *, count(*) filter (where a > 5 and b > 5) over (partition by epoch) > 100 as strong from v)
select epoch, count(*) as n, round(corr(a, b), 6) as amplitude_r, round(sqrt(avg((20 * log10(a) - 20 * log10(b)) ^ 2) filter (where not strong or (a > 5 and b > 5))), 6) as amplitude_rmse_db,
round(sqrt(avg(atan2(s, c) ^ 2)), 6) as phase_rms, round(sqrt(avg(cos(atan2(s, c))) ^ 2 + avg(sin(atan2(s, c))) ^ 2), 6) as coherence from n group by 1"""
)
def m11_slc_agreement(spark, sf_dir):
    s = table(spark, sf_dir, "stack").withColumnRenamed("epoch", "scene_id")
    c = F.col
    a = s.select("scene_id", (c("col") * 5).alias("x"), (c("row") * 5).alias("y"), (c("re") * 4).alias("re"), (c("im") * 4).alias("im"))
    b = s.select("scene_id", (c("col") * 5 + 10).alias("x"), (c("row") * 5 - 5).alias("y"), (c("re") * 5 + 0.2).alias("re"), (c("im") * 3 - 0.1).alias("im"))
    return rounded(X.slc_agreement(a, b).withColumnRenamed("scene_id", "epoch"))


@REG.add(
    with_tables("stack")
    + """ select epoch, row, col, round(case when (row * 10 + col) % 37 = 0 or (row * 10 + col) % 41 = 0 then 0 else re * (1 + epoch % 3) end, 6) as re,
round(case when (row * 10 + col) % 37 = 0 or (row * 10 + col) % 41 = 0 then 0 else im * (1 + epoch % 3) end, 6) as im from stack"""
)
def io02_stack_ingest(spark, sf_dir):
    k, e = F.col("row") * 10 + F.col("col"), F.col("epoch") % 3
    re = F.when(k % 37 == 0, F.lit(float("nan"))).otherwise(F.col("re"))
    im = F.when(k % 41 == 0, F.lit(float("inf"))).otherwise(F.col("im"))
    layer = lambda at, times: F.when(at, F.struct((re * times).alias("re"), (im * times).alias("im")))
    # Epochs hold other layers: the second is there in two of three, behind the first in one of them.
    s = table(spark, sf_dir, "stack").select("epoch", "row", "col", layer(e == 0, 1).alias("vv"), layer(e <= 1, 2).alias("hh"), layer(e == 2, 3).alias("grid_vv"), layer(F.lit(False), 4).alias("grid_hh"))
    return rounded(X.stack_layers(s, "vv", "hh", "grid_vv", "grid_hh"))


@REG.add(
    with_tables("grid", "classes")
    + """, m as (select row, col, status <> 0 as keep from classes), p as (select g.row, g.col, g.value as predicted, c.value * 1.1 + c.cls as reference from grid g join classes c using (row, col) join m using (row, col) where keep and g.value is not null and c.cls <> 4)
select row, col, round(predicted, 6) as predicted, round(reference, 6) as reference from p"""
)
def j12_pair_alignment(spark, sf_dir):
    g = _grid(spark, sf_dir).select("scene_id", "row", "col", "value")
    c = table(spark, sf_dir, "classes").withColumn("scene_id", F.lit(0))
    reference = c.select("scene_id", "row", "col", F.when(F.col("cls") != 4, F.col("value") * 1.1 + F.col("cls")).alias("value"))
    out = X.aligned(g, reference, c.select("scene_id", "row", "col", (F.col("status") != 0).alias("keep")))
    return rounded(out.select("row", "col", "predicted", "reference"))

"""Scalar operators and agreement metrics over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import metrics as M
from .shaping import Registry, rounded
from .tables import CRITERIA_SQL, criteria, sql_text, table, with_tables

REG = Registry()
_SCORES = """round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall,
round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1, round(coalesce(correct / nullif(total, 0), 0), 6) as accuracy"""
_COUNTS = """count(*) filter (where predicted = 1 and reference = 1) as tp, count(*) filter (where predicted = 1 and reference = 0) as fp,
count(*) filter (where predicted = 0 and reference = 1) as fn, count(*) filter (where predicted = 0 and reference = 0) as tn,
count(*) filter (where predicted = reference) as correct, count(*) as total"""


@REG.add(
    with_tables("pairs", "binary_pairs")
    + f""", a as (select scene_id, sqrt(avg((predicted - reference) ^ 2)) as rmse, corr(predicted, reference) as correlation, avg(predicted - reference) as bias from pairs group by 1),
    c as (select scene_id, {_COUNTS} from binary_pairs group by 1),
    m as (select a.scene_id, a.rmse, a.correlation, a.bias, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as f1, coalesce(correct / nullif(total, 0), 0) as accuracy from a join c on a.scene_id = c.scene_id),
    l as (unpivot m on rmse, correlation, bias, f1, accuracy into name measurement value value)
    select l.scene_id, criterion, kind, round(value, 6) as value, case comparator when '>' then value > threshold when '>=' then value >= threshold when '<' then value < threshold else value <= threshold end as pass
    from l join {CRITERIA_SQL} on measurement = replace(replace(replace(replace(list_last(string_split(criterion, '.')), '_db_max', ''), '_mm_yr_max', ''), '_min', ''), '_max', '')
    where criterion in ('rtc.rmse_db_max', 'rtc.correlation_min', 'disp.correlation_min', 'disp.bias_mm_yr_max', 'dist.f1_min', 'dist.accuracy_min', 'dswx.f1_min')"""
)
def flagship_verdicts(spark, sf_dir):
    agreement = M.continuous(table(spark, sf_dir, "pairs"), "scene_id").join(M.classification(table(spark, sf_dir, "binary_pairs"), "scene_id"), "scene_id")
    long = agreement.unpivot("scene_id", ["rmse", "correlation", "bias", "f1", "accuracy"], "measurement", "value")
    wanted = criteria(spark).where(F.col("criterion").isin("rtc.rmse_db_max", "rtc.correlation_min", "disp.correlation_min", "disp.bias_mm_yr_max", "dist.f1_min", "dist.accuracy_min", "dswx.f1_min"))
    key = F.regexp_replace(F.regexp_replace(F.element_at(F.split("criterion", "[.]"), -1), "_(min|max)$", ""), "_(db|mm_yr)$", "")
    v, t = F.col("value"), F.col("threshold")
    ok = F.when(F.col("comparator") == ">", v > t).when(F.col("comparator") == ">=", v >= t).when(F.col("comparator") == "<", v < t).otherwise(v <= t)
    out = long.join(F.broadcast(wanted.withColumn("measurement", key)), "measurement")  # sixteen fixed rows
    return rounded(out.select("scene_id", "criterion", "kind", "value", ok.alias("pass")))


@REG.add(with_tables("pairs") + "select scene_id, round(sqrt(avg((predicted - reference) ^ 2)), 6) as rmse, round(corr(predicted, reference), 6) as correlation, round(avg(predicted - reference), 6) as bias, count(*) as n from pairs where predicted is not null and reference is not null group by 1")
def m01_m03_continuous(spark, sf_dir):
    return rounded(M.continuous(table(spark, sf_dir, "pairs"), "scene_id"))


@REG.add(with_tables("binary_pairs") + f", c as (select scene_id, {_COUNTS} from binary_pairs group by 1) select *, {_SCORES} from c")
def m05_m09_classification(spark, sf_dir):
    return rounded(M.classification(table(spark, sf_dir, "binary_pairs"), "scene_id"))


@REG.add(with_tables("grid") + "select event_id, round(case when value > 0 then 10 * log10(value) end, 6) as db, round(case when value > 0 then 20 * log10(value) end, 6) as amplitude_db from grid")
def t01_decibel(spark, sf_dir):
    return rounded(table(spark, sf_dir, "grid").select("event_id", S.decibel(F.col("value")).alias("db"), S.decibel(F.col("value"), 20.0).alias("amplitude_db")))


@REG.add(with_tables("grid") + ", s as (select event_id % 8 as scene_id, value as a, value * 0.9 + 1 as b, count(*) filter (where value > 5 and value * 0.9 + 1 > 5) over (partition by event_id % 8) as strong from grid where value > 0) select scene_id, count(*) as n, round(sqrt(avg((20 * log10(a) - 20 * log10(b)) ^ 2)), 6) as rmse_db from s where strong <= 100 or (a > 5 and b > 5) group by 1")
def t02_amplitude_rmse(spark, sf_dir):
    from ..operators.stacks import amplitude_rmse_db

    g = table(spark, sf_dir, "grid").where("value > 0").select((F.col("event_id") % 8).alias("scene_id"), F.col("value").alias("a"), (F.col("value") * 0.9 + 1).alias("b"))
    return rounded(amplitude_rmse_db(g, "scene_id"))


@REG.add(with_tables("points") + "select pid, round(mean_velocity / cos(radians(33.0 + pid % 5)), 6) as vertical, round(case when mean_velocity <> 0 then -mean_velocity * 0.05546576 / (4 * pi()) * 1000 end, 6) as mm_yr from points")
def t03_t04_velocity(spark, sf_dir):
    p = table(spark, sf_dir, "points")
    return rounded(p.select("pid", S.los_to_vertical(F.col("mean_velocity"), F.lit(33.0) + F.col("pid") % 5).alias("vertical"), S.rate_to_mm(F.col("mean_velocity")).alias("mm_yr")))


@REG.add(with_tables("bands") + ", o as (select * from (values (0, -1000), (1, 200), (2, -50)) t(scene_id, offs)) select event_id, greatest(0, least(65535, blue + coalesce(offs, 0))) as blue, greatest(0, least(65535, nir + coalesce(offs, 0))) as nir from bands left join o using (scene_id)")
def t05_reflectance_offset(spark, sf_dir):
    offsets = spark.createDataFrame([(0, -1000), (1, 200), (2, -50)], "scene_id long, offs int")
    b = table(spark, sf_dir, "bands").join(F.broadcast(offsets), "scene_id", "left")
    return b.select("event_id", *[S.offset_reflectance(F.col(c), F.col("offs")).alias(c) for c in ("blue", "nir")])


_XCAL = ", ".join(f"cast(trunc(greatest(0::float, least(65535::float, {b}::float * {s}::float + {i * 10000!r}::float))) as int) as {b}" for b, (s, i) in S.CROSS_CALIBRATION.items())


@REG.add(with_tables("bands") + f"select event_id, {_XCAL} from bands")
def t06_cross_calibration(spark, sf_dir):
    return table(spark, sf_dir, "bands").select("event_id", *[S.cross_calibrated(F.col(b), b).alias(b) for b in S.CROSS_CALIBRATION])


_INDEX = """i as (select *, (green::float - swir1::float) / (green::float + swir1::float + 1e-10::float) as mndwi, (nir::float - red::float) / (nir::float + red::float + 1e-10::float) as ndvi,
green::float + red::float as mbsrv, nir::float + swir1::float as mbsrn, blue::float + 2.5::float * green::float - 1.5::float * (nir::float + swir1::float) - 0.25::float * swir2::float as awesh from bands)"""
_DIAG = """(mndwi > 0.124::float)::int + 2 * (mbsrv > mbsrn)::int + 4 * (awesh > 0::float)::int + 8 * (mndwi > (-0.44)::float and swir1 < 900 and nir < 1500 and ndvi < 0.7::float)::int
+ 16 * (mndwi > (-0.5)::float and blue < 1000 and swir1 < 3000 and swir2 < 1000 and nir < 2500)::int"""


@REG.add(with_tables("bands") + f", {_INDEX} select event_id, round(mndwi::double, 4) as mndwi, round(ndvi::double, 4) as ndvi, mbsrv::double as mbsrv, mbsrn::double as mbsrn, round(awesh::double, 4) as awesh from i")
def t07_index_bands(spark, sf_dir):
    b = table(spark, sf_dir, "bands").withColumns(S.index_bands())
    return rounded(b.select("event_id", "mndwi", "ndvi", "mbsrv", "mbsrn", "awesh"), 4)


@REG.add(with_tables("bands") + f", {_INDEX}, d as (select event_id, scl, {_DIAG} as diagnostic from i), c as (select *, {list(S.WATER_CLASS)}[diagnostic + 1] as cls from d), k as (select *, case when scl in (3, 8, 9, 10) then 255 else cls end as masked from c) select event_id, diagnostic, cls as water_class, masked, case when masked in (1, 2, 3) then 1 when masked = 255 then null else 0 end as water from k")
def t08_t12_water_class(spark, sf_dir):
    b = table(spark, sf_dir, "bands").withColumns(S.index_bands()).withColumn("diagnostic", S.diagnostic())
    b = b.withColumn("water_class", S.water_class(F.col("diagnostic"))).withColumn("masked", S.cloud_masked(F.col("water_class"), F.col("scl")))
    return b.select("event_id", "diagnostic", "water_class", "masked", S.binary_water(F.col("masked")).alias("water"))


@REG.add(with_tables("classes") + "select jrc, status, count(*) as n, sum(case jrc when 1 then 0 when 2 then 1 end)::bigint as water, sum(case when status in (2,3,4,5,6,7,8) then 1 when status = 255 then null else 0 end)::bigint as disturbed from classes group by 1, 2")
def t13_t14_binarise(spark, sf_dir):
    c = table(spark, sf_dir, "classes")
    return c.groupBy("jrc", "status").agg(F.count("*").alias("n"), F.sum(S.binary_reference_water(F.col("jrc"))).alias("water"), F.sum(S.binary_disturbance(F.col("status"))).alias("disturbed"))


@REG.add(with_tables("ifg") + "select ifg_idx, count(case when coh >= 0.3 then phase end) as kept, round(avg(case when coh >= 0.3 then phase end), 6) as mean_phase, round(avg(case when coh > 0 then coh end), 6) as mean_coherence from ifg group by 1")
def t15_w12_coherence_mask(spark, sf_dir):
    i = table(spark, sf_dir, "ifg")
    masked = S.coherence_masked(F.col("phase"), F.col("coh"))
    return rounded(i.groupBy("ifg_idx").agg(F.count(masked).alias("kept"), F.avg(masked).alias("mean_phase"), F.avg(F.when(F.col("coh") > 0, F.col("coh"))).alias("mean_coherence")))


@REG.add(with_tables("points") + """select pid, (case when lat >= 0 then 32600 else 32700 end + case when lat >= 56 and lat < 64 and lon >= 3 and lon < 12 then 32 when lat >= 72 and lon >= 0 and lon < 9 then 31 when lat >= 72 and lon >= 9 and lon < 21 then 33
when lat >= 72 and lon >= 21 and lon < 33 then 35 when lat >= 72 and lon >= 33 and lon < 42 then 37 else least(60, floor((lon + 180) / 6)::int + 1) end)::int as epsg,
trunc((lon + 180) / 10)::int as tile_x, trunc((80 - lat) / 10)::int as tile_y,
case when floor(lat / 3) >= 0 then 'N' else 'S' end || lpad(abs((floor(lat / 3) * 3)::int)::varchar, 2, '0') || case when floor(lon / 3) >= 0 then 'E' else 'W' end || lpad(abs((floor(lon / 3) * 3)::int)::varchar, 3, '0') as land_tile,
(trunc((lon + 180) * 175 / 360)::int % 175 + 1)::int as track from points""")
def t17_t20_tiles(spark, sf_dir):
    p = table(spark, sf_dir, "points")
    x, y = S.ten_degree_tile(F.col("lon"), F.col("lat"))
    return p.select("pid", S.utm_epsg(F.col("lon"), F.col("lat")).alias("epsg"), x.alias("tile_x"), y.alias("tile_y"), S.land_cover_tile(F.col("lon"), F.col("lat")).alias("land_tile"), S.track(F.col("lon")).alias("track"))


@REG.add(with_tables("polygons") + "select id, trunc(2 * half * 111 * cos(radians(cy)) * 2 * half * 111 * 300 * 0.3)::bigint as ceiling from polygons")
def t21_point_ceiling(spark, sf_dir):
    p = table(spark, sf_dir, "polygons")
    return p.select("id", S.stable_point_ceiling(F.col("cx") - F.col("half"), F.col("cy") - F.col("half"), F.col("cx") + F.col("half"), F.col("cy") + F.col("half")).alias("ceiling"))


@REG.add(with_tables("classes") + "select cls, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 6) as percent from classes group by 1")
def m17_class_histogram(spark, sf_dir):
    return rounded(M.class_shares(table(spark, sf_dir, "classes"), "cls"))


@REG.add(with_tables("grid") + "select event_id % 8 as scene_id, count(*) as n, round(min(value), 6) as least, round(max(value), 6) as most, round(avg(value), 6) as mean, round(stddev_pop(value), 6) as std, round(max(value) - min(value), 6) as relief from grid where value is not null and value <> 0 group by 1")
def m18_m21_raster_summary(spark, sf_dir):
    g = table(spark, sf_dir, "grid").where("value is not null and value <> 0")
    v = F.col("value")
    return rounded(g.groupBy((F.col("event_id") % 8).alias("scene_id")).agg(F.count("*").alias("n"), F.min(v).alias("least"), F.max(v).alias("most"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), (F.max(v) - F.min(v)).alias("relief")))


@REG.add(with_tables("classes") + "select cls, round(count(*) filter (where status in (2, 3)) / nullif(count(*) filter (where status = 0), 0), 6) as wet_dry, count(*) filter (where status = 0) = 0 as infinite, round(avg((jrc = 0)::int), 6) as unknown from classes group by 1")
def m22_m23_ratios(spark, sf_dir):
    c = table(spark, sf_dir, "classes")
    wet, dry = F.count_if(F.col("status").isin(2, 3)), F.count_if(F.col("status") == 0)
    return rounded(c.groupBy("cls").agg(F.try_divide(wet, dry).alias("wet_dry"), (dry == 0).alias("infinite"), F.avg((F.col("jrc") == 0).cast("int")).alias("unknown")))


@REG.add(with_tables("items") + "select tile, year(sensing)::int as year, least(count(*) filter (where cloud < 15), 50) as cloud_free from items group by 1, 2")
def m24_cloud_free(spark, sf_dir):
    i = table(spark, sf_dir, "items")
    return i.groupBy("tile", F.year("sensing").alias("year")).agg(F.least(F.count_if(F.col("cloud") < 15), F.lit(50).cast("long")).alias("cloud_free"))


@REG.add(with_tables("stack") + ", e as (select min(coh) as lo, max(coh) as hi from stack) select least(49, floor((coh - lo) / ((hi - lo) / 50)))::int as bin, count(*) as n from stack, e where coh is not null group by 1")
def m25_coherence_histogram(spark, sf_dir):
    return M.histogram(table(spark, sf_dir, "stack"), "coh", 50)


@REG.add(with_tables("grid") + "select count(*) as total, count(value) as finite, count(*) filter (where value is null) as nodata from grid")
def a08_io01_ingest(spark, sf_dir):
    g = table(spark, sf_dir, "grid").select(S.finite(F.coalesce(F.col("value"), F.lit(float("nan")))).alias("value"))
    return g.agg(F.count("*").alias("total"), F.count("value").alias("finite"), F.count_if(F.col("value").isNull()).alias("nodata"))

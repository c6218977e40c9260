"""Orbit files and frames by their names, and planes through pixels on a line."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalogue as C
from ..operators import stacks as K
from .shaping import Registry, rounded
from .tables import table

REG = Registry()

_FILES = """select event_id as fid, user_id as track, 'S1A_OPER_AUX_' || case event_id % 3 when 0 then 'POEORB' when 1 then 'RESORB' else 'PREORB' end || '_OPOD' ||
case when event_id % 11 = 0 then '' when event_id % 13 = 0 then '_V20249999T000000_20240101T000000' else '_V' || strftime(ts, '%Y%m%dT%H%M%S') || '_' || strftime(ts + interval 1 hour * (1 + event_id % 30), '%Y%m%dT%H%M%S') end || '.EOF' as name,
event_id % 11 = 0 or event_id % 13 = 0 as unread, date_trunc('second', ts) as start, date_trunc('second', ts + interval 1 hour * (1 + event_id % 30)) as stop from events where event_type in ('view', 'click')"""


def _orbits(spark, sf_dir):
    """A file's name for each view or click: valid from then for up to thirty hours; some names tell no window, or no date."""
    e = table(spark, sf_dir, "events").where("event_type in ('view', 'click')")
    k, stamp = F.col("event_id"), "yyyyMMdd'T'HHmmss"
    stop = F.expr("ts + make_interval(0, 0, 0, 0, 1 + event_id % 30, 0, 0)")
    window = F.when(k % 11 == 0, "").when(k % 13 == 0, "_V20249999T000000_20240101T000000").otherwise(F.concat(F.lit("_V"), F.date_format("ts", stamp), F.lit("_"), F.date_format(stop, stamp)))
    kind = F.when(k % 3 == 0, "POEORB").when(k % 3 == 1, "RESORB").otherwise("PREORB")
    return e.select(k.alias("fid"), F.col("user_id").alias("track"), F.concat(F.lit("S1A_OPER_AUX_"), kind, F.lit("_OPOD"), window, F.lit(".EOF")).alias("name"), "ts")


@REG.add(
    f"""with f as ({_FILES}), q as (select event_id as fid, ts + interval 5 hour as t from events)
select fid, case when name like '%POEORB%' then 'POEORB' when name like '%RESORB%' then 'RESORB' else 'UNKNOWN' end as type, case when not unread then epoch(start)::bigint end as start, case when not unread then epoch(stop)::bigint end as stop,
case when not unread then t between start and stop end as covers from f join q using (fid)"""
)
def j02_orbit_names(spark, sf_dir):
    """Each file's type and window, and whether it covers a time five hours after it began."""
    files = _orbits(spark, sf_dir).withColumn("t", F.expr("cast(ts + interval 5 hours as timestamp)"))
    out = C.orbit_coverage(files)
    stop = F.when(F.col("start").isNotNull(), F.unix_timestamp("stop"))
    return out.select("fid", "type", F.unix_timestamp("start").alias("start"), stop.alias("stop"), "covers")


@REG.add(
    f"""with f as ({_FILES}), q as (select event_id as tid, user_id as track, ts as t from events),
r as (select q.tid, f.name, case f.fid % 3 when 0 then 'POEORB' when 1 then 'RESORB' else 'UNKNOWN' end as type, start from q join f on f.track = q.track and not unread and t between start and stop),
b as (select tid, count(*) as n_covering, min(struct_pack(k := case type when 'POEORB' then 0 when 'RESORB' then 1 else 2 end, s := -epoch(start)::bigint, name := name, type := type)) as b from r group by 1)
select q.tid, b.b.name as orbit, b.b.type as type, coalesce(n_covering, 0) as n_covering from q left join b using (tid)"""
)
def j02_orbit_assigned(spark, sf_dir):
    """The best orbit file of each event's track that covers it."""
    times = table(spark, sf_dir, "events").select(F.col("event_id").alias("tid"), F.col("user_id").alias("track"), F.col("ts").cast("timestamp").alias("t"))
    return C.orbit_assigned(times, _orbits(spark, sf_dir).select("track", "name"), 6 * 3600, keys=["track"])


@REG.add(
    """with g as (select user_id as k, event_id as seq, 'F' || lpad((event_id % 9)::varchar, 5, '0') as frame, case when event_id % 17 = 0 then -1 else hour(ts) end as h from events where event_id % 19 <> 0),
f as (select k, frame, count(*) as n, max_by(h, seq) as h, min(seq) as s from g group by 1, 2), t as (select *, case when abs(h - 14) = 0 then 0 when abs(h - 14) <= 1 then 1 else 2 end as tier from f),
r as (select *, row_number() over (partition by k order by tier, n desc, s) as place from t) select k, frame, h::int as hour, n, tier::int as tier from r where place = 1"""
)
def j07_frame_at_hour(spark, sf_dir):
    """Each user's dominant frame for a pass at 14 h; some names tell no time, some no frame."""
    k = F.col("event_id")
    frame = F.concat(F.lit("F"), F.lpad((k % 9).cast("string"), 5, "0"))
    time = F.when(k % 17 == 0, "VV").otherwise(F.concat(F.lit("VV_"), F.date_format("ts", "yyyyMMdd'T'HHmmss"), F.lit("Z")))
    name = F.concat(F.lit("L3_DISP_IW_"), F.when(k % 19 != 0, frame).otherwise("X"), F.lit("_"), time, F.lit("_v1"))
    return C.frame_at_hour(table(spark, sf_dir, "events").select(F.col("user_id").alias("k"), k.alias("seq"), name.alias("name")), ["k"], 14)


@REG.add(
    """with e as (select (user_id % 30)::int as ifg_idx, (event_id % 50)::double as x, value from events),
p as (select ifg_idx, case when ifg_idx % 3 = 0 then 7.0 when ifg_idx % 3 = 1 then x else 2 * x + 3 end as y, case when ifg_idx % 3 = 1 then 4.0 else x end as x, value / 100 + 1 as z from e),
m as (select ifg_idx, count(*) as n, avg(x) as mx, avg(y) as my, avg(z) as mz, case ifg_idx % 3 when 0 then 1.0 when 1 then 0.0 else 1 / sqrt(5.0::double) end as u, case ifg_idx % 3 when 0 then 0.0 when 1 then 1.0 else 2 / sqrt(5.0::double) end as v from p group by ifg_idx),
g as (select m.*, (select regr_slope(z, u * x + v * y) from p where p.ifg_idx = m.ifg_idx) as g from m),
t as (select *, mz - g * (u * mx + v * my) as rest, u * my - v * mx as lever from g), s as (select *, rest * lever / (1 + lever * lever) as turn from t)
select ifg_idx, n, round(g * u - turn * v, 6) as slope_x, round(g * v + turn * u, 6) as slope_y, round(mz - (g * u - turn * v) * mx - (g * v + turn * u) * my, 6) as intercept from s where n >= 20"""
)
def w08_line_fit(spark, sf_dir):
    """Planes through pixels of one row, one column or one slanted line: of all that fit, the least one."""
    i = (F.col("user_id") % 30).cast("int")
    x = (F.col("event_id") % 50).cast("int")
    row, col = F.when(i % 3 == 0, 7).when(i % 3 == 1, x).otherwise(2 * x + 3), F.when(i % 3 == 1, 4).otherwise(x)
    p = table(spark, sf_dir, "events").select(i.alias("ifg_idx"), row.alias("row"), col.alias("col"), (F.col("value") / 100 + 1).alias("phase"))
    return rounded(K.planes(p, 20).where("slope_x is not null").select("ifg_idx", "n", "slope_x", "slope_y", "intercept"))

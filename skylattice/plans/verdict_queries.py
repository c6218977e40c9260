"""Resampling, search and verdict operators over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import resample as R
from ..operators import verdicts as V
from .shaping import Registry, rounded
from .tables import CRITERIA_SQL, criteria, table, with_tables

REG = Registry()
_COUNTS = """count(*) filter (where predicted = 1 and reference = 1) as tp, count(*) filter (where predicted = 1 and reference = 0) as fp,
count(*) filter (where predicted = 0 and reference = 1) as fn, count(*) filter (where predicted = 0 and reference = 0) as tn, count(*) filter (where predicted = reference) as correct, count(*) as total"""
_PAIRS = ", p as (select row, col, case when status in (2,3,4,5,6,7,8) then 1 when status = 255 then null else 0 end as predicted, case jrc when 1 then 0 when 2 then 1 end as reference from classes)"


def _pairs(spark, sf_dir):
    return table(spark, sf_dir, "classes").select("row", "col", S.binary_disturbance(F.col("status")).alias("predicted"), S.binary_reference_water(F.col("jrc")).alias("reference"))


def _extent(pairs):
    r = pairs.agg(F.max("row") + 1, F.max("col") + 1).first()
    return r[0], r[1]


@REG.add(with_tables("classes") + _PAIRS + f", e as (select (max(row) + 1) // 7 as nr, (max(col) + 1) // 7 as nc from p) select ((row // 7) * nc + col // 7)::bigint as block, {_COUNTS} from p, e where row < nr * 7 and col < nc * 7 group by 1")
def b01_block_counts(spark, sf_dir):
    p = _pairs(spark, sf_dir)
    return R.block_counts(p, *_extent(p), 7)


@REG.add(
    with_tables("classes") + _PAIRS
    + f""", e as (select (max(row) + 1) // 7 as nr, (max(col) + 1) // 7 as nc from p), b as (select ((row // 7) * nc + col // 7)::bigint as block, {_COUNTS} from p, e where row < nr * 7 and col < nc * 7 group by 1),
d as (select r as replicate, block, (block * 31 + r * 17) % 3 as times from b, range(0, 100) t(r)), s as (select replicate, sum(tp * times) as tp, sum(fp * times) as fp, sum(fn * times) as fn, sum(correct * times) as correct, sum(total * times) as total from d join b using (block) group by 1
union all select -1, sum(tp), sum(fp), sum(fn), sum(correct), sum(total) from b), m as (select replicate, coalesce(tp / nullif(tp + fp, 0), 0) as precision, coalesce(tp / nullif(tp + fn, 0), 0) as recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as f1, coalesce(correct / nullif(total, 0), 0) as accuracy from s),
l as (unpivot m on precision, recall, f1, accuracy into name metric value v) select metric, round(max(v) filter (where replicate = -1), 6) as point, round(quantile_cont(v, 0.025) filter (where replicate >= 0), 6) as lower, round(quantile_cont(v, 0.975) filter (where replicate >= 0), 6) as upper from l group by 1"""
)
def b02_block_bootstrap(spark, sf_dir):
    p = _pairs(spark, sf_dir)
    blocks = R.block_counts(p, *_extent(p), 7)
    return rounded(R.bootstrap(blocks, 100, lambda replicate, block: (block * 31 + replicate * 17) % 3))


@REG.add()
def b01_bootstrap_scaled(spark, sf_dir):
    """500 replicates, each of as many draws as there are whole blocks; no SQL draws the same."""
    p = _pairs(spark, sf_dir)
    height, width = _extent(p)
    return rounded(R.bootstrap_exact(R.block_counts(p, height, width, 7), (height // 7) * (width // 7)))


@REG.add(
    with_tables("classes")
    + """, e as (select status, max(row) + 1 as height, max(col) + 1 as width from classes group by 1 union all select -1, 3660, 3660 from region where r_regionkey = 0)
select status, (height // 33) * (width // 33) as kept, (height // 33 + 1) * (width // 33 + 1) - (height // 33) * (width // 33) as dropped,
case when (height // 33) * (width // 33) = 0 then 'raster (' || height || 'x' || width || ') too small for blocks of 33x33 pixels' end as error from e"""
)
def b01_block_grid(spark, sf_dir):
    """Blocks of a kilometre at 30 m that each class's extent keeps and drops, and those of a whole tile."""
    e = table(spark, sf_dir, "classes").groupBy("status").agg((F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width"))
    tile = table(spark, sf_dir, "region").where("r_regionkey = 0").select(F.lit(-1).alias("status"), F.lit(3660).alias("height"), F.lit(3660).alias("width"))
    return R.block_grid(e.unionByName(tile), 33).select("status", "kept", "dropped", "error")


#: The thresholds of the whole grid: 45 by 31.
_W, _A = [round(0.08 + 0.005 * k, 3) for k in range(45)], [round(-0.2 + 0.01 * k, 2) for k in range(31)]
_BITS = "(mbsrv > mbsrn)::int + 2 * (mndwi > -0.44 and swir1 < 900 and nir < 1500 and ndvi < 0.7)::int + 4 * (mndwi > -0.44 and blue < 1000 and swir1 < 3000 and swir2 < 1000 and nir < 2500)::int"


def _class_rules() -> list[list[bool]]:
    """For each value of the three other bits, whether the class is water by which of the two thresholds are passed."""
    def water(bit0: int, rest: int, bit2: int) -> bool:
        return S.WATER_CLASS[bit0 + 2 * (rest & 1) + 4 * bit2 + 8 * (rest >> 1 & 1) + 16 * (rest >> 2)] in (1, 2, 3)

    return [[water(0, r, 0), water(1, r, 0), water(0, r, 1), water(1, r, 1)] for r in range(8)]


@REG.add(
    with_tables("bands")
    + f""", i as (select scene_id, (green - swir1) / (green + swir1 + 1e-10) as mndwi, (nir - red) / (nir + red + 1e-10) as ndvi, green + red as mbsrv, nir + swir1 as mbsrn,
  (blue + 2.5 * green - 1.5 * (nir + swir1) - 0.25 * swir2) / 10000 as awesh, blue, nir, swir1, swir2, (event_id % 3 = 0)::int as reference from bands where scl not in (3, 8, 9, 10)),
p as (select scene_id, mndwi, awesh, {_BITS} as rest, reference from i),
g as (select w.wigt, a.awgt from (select unnest({_W})::double as wigt) w, (select unnest({_A})::double as awgt) a),
c as (select scene_id, wigt, awgt, ({list(S.WATER_CLASS)}[1 + (mndwi > wigt)::int + 2 * (rest & 1) + 4 * (awesh > awgt)::int + 8 * ((rest >> 1) & 1) + 16 * (rest >> 2)] in (1, 2, 3))::int as predicted, reference from p, g),
s as (select scene_id, wigt, awgt, {{_COUNTS}} from c group by all) select scene_id, wigt, awgt, tp, fp, fn, tn, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1, round(coalesce(correct / nullif(total, 0), 0), 6) as accuracy from s""".replace("{_COUNTS}", _COUNTS)
)
def c01_grid_search(spark, sf_dir):
    """All 1,395 points of the grid, all five bits; the fixed thresholds stay as they are."""
    c = F.col
    b = table(spark, sf_dir, "bands").where(~c("scl").isin(*S.CLOUDS))
    b = b.withColumns({
        "mndwi": (c("green") - c("swir1")) / (c("green") + c("swir1") + 1e-10), "ndvi": (c("nir") - c("red")) / (c("nir") + c("red") + 1e-10),
        "awesh": (c("blue") + 2.5 * c("green") - 1.5 * (c("nir") + c("swir1")) - 0.25 * c("swir2")) / 10000,
    })
    bits = [
        c("green") + c("red") > c("nir") + c("swir1"),
        (c("mndwi") > -0.44) & (c("swir1") < 900) & (c("nir") < 1500) & (c("ndvi") < 0.7),
        (c("mndwi") > -0.44) & (c("blue") < 1000) & (c("swir1") < 3000) & (c("swir2") < 1000) & (c("nir") < 2500),
    ]
    rest = sum(b_.cast("int") * (1 << k) for k, b_ in enumerate(bits))
    p = b.select("scene_id", "mndwi", "awesh", rest.alias("rest"), (c("event_id") % 3 == 0).cast("int").alias("reference"))
    return rounded(R.grid_search(p, _W, _A, ["scene_id"], _class_rules()).select("scene_id", "wigt", "awgt", "tp", "fp", "fn", "tn", "f1", "accuracy"))


_BEST = ", b as (select wigt, awgt, avg(f1) as mean_f1 from scores group by 1, 2 order by 3 desc, 1, 2 limit 1)"


@REG.add(with_tables("scores") + _BEST + ", e as (select min(wigt) as w0, max(wigt) as w1, min(awgt) as a0, max(awgt) as a1 from scores) select round(wigt, 6) as wigt, round(awgt, 6) as awgt, case when least(abs(wigt - w0), abs(wigt - w1), abs(awgt - a0), abs(awgt - a1)) < 1e-9 then 'BLOCKER' else 'OK' end as status from b, e")
def c02_c04_joint_best(spark, sf_dir):
    s = table(spark, sf_dir, "scores")
    return rounded(R.at_edge(R.joint_best(s), s))


@REG.add(with_tables("scores") + _BEST + " select aoi, round(avg(f1) filter (where season = 0), 6) as wet, round(avg(f1) filter (where season = 1), 6) as dry, round(avg(f1), 6) as mean from scores group by 1")
def c03_by_area(spark, sf_dir):
    s = table(spark, sf_dir, "scores")
    return rounded(s.groupBy("aoi").agg(F.avg(F.when(F.col("season") == 0, F.col("f1"))).alias("wet"), F.avg(F.when(F.col("season") == 1, F.col("f1"))).alias("dry"), F.avg("f1").alias("mean")))


_CV = "cv as (select p_size % 5 as aoi, 0.08::double + 0.005::double * (p_partkey % 9) as wigt, -0.2::double + 0.01::double * (p_partkey % 7) as awgt, avg(p_retailprice) as f1 from part group by 1, 2, 3)"


@REG.add(f"with {_CV}, o as (select *, (sum(f1) over w - f1) / nullif(count(*) over w - 1, 0) as others from cv window w as (partition by wigt, awgt)), r as (select *, row_number() over (partition by aoi order by round(others, 9) desc, wigt, awgt) as k from o where others is not null) select aoi, round(wigt, 6) as wigt, round(awgt, 6) as awgt, round(f1, 4) as left_out_f1, round(others, 4) as fitted_f1 from r where k = 1")
def c05_leave_one_out(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    cv = p.groupBy((F.col("p_size") % 5).alias("aoi"), (F.lit(0.08) + F.lit(0.005) * (F.col("p_partkey") % 9)).alias("wigt"), (F.lit(-0.2) + F.lit(0.01) * (F.col("p_partkey") % 7)).alias("awgt")).agg(F.avg("p_retailprice").alias("f1"))
    out = R.leave_one_out(cv, ["aoi"])
    return out.select("aoi", F.round("wigt", 6).alias("wigt"), F.round("awgt", 6).alias("awgt"), F.round("left_out_f1", 4).alias("left_out_f1"), F.round("fitted_f1", 4).alias("fitted_f1"))


@REG.add(with_tables("scores") + _BEST + " select s.aoi, round(avg(s.f1), 6) as held_out_f1 from scores s join b on s.wigt = b.wigt group by 1")
def c06_held_out(spark, sf_dir):
    s = table(spark, sf_dir, "scores")
    return rounded(s.join(F.broadcast(R.joint_best(s).select("wigt")), "wigt").groupBy("aoi").agg(F.avg("f1").alias("held_out_f1")))


@REG.add("select l_orderkey, sha256(string_agg(p, chr(10) order by p)) as hash from (select distinct l_orderkey, l_partkey::varchar as p from lineitem) group by 1")
def c07_fit_set_hash(spark, sf_dir):
    return R.set_hash(table(spark, sf_dir, "lineitem"), "l_partkey", "l_orderkey")


@REG.add(with_tables("scores") + ", m as (select round(wigt, 6) as wigt, null::double as awgt, avg(f1) as f1 from scores group by 1 union all select null, round(awgt, 6), avg(f1) from scores group by 2) select wigt, awgt, round(f1, 6) as f1 from m")
def c08_marginals(spark, sf_dir):
    s = table(spark, sf_dir, "scores").select(F.round("wigt", 6).alias("wigt"), F.round("awgt", 6).alias("awgt"), "f1")
    return rounded(s.groupingSets([["wigt"], ["awgt"]], "wigt", "awgt").agg(F.avg("f1").alias("f1")))


@REG.add("select p_partkey, concat_ws('; ', case when p_size % 10 < 3 then 'cloud-free < 3' end, case when p_retailprice / 1000 < 1.2 then 'ratio < 1.2' end, case when p_size > 40 then 'unknown > 20 %' end) as reasons from part")
def c09_screening(spark, sf_dir):
    c = F.col
    return table(spark, sf_dir, "part").select("p_partkey", F.concat_ws("; ", F.when(c("p_size") % 10 < 3, "cloud-free < 3"), F.when(c("p_retailprice") / 1000 < 1.2, "ratio < 1.2"), F.when(c("p_size") > 40, "unknown > 20 %")).alias("reasons"))


@REG.add(with_tables("items") + ", f as (select * from (values (0, 'glint'), (0, 'ice'), (1, 'turbid'), (2, 'glint')) t(orbit, flag)), g as (select orbit, string_agg(flag, ',' order by flag) as flags from f group by 1) select id, coalesce(flags, 'clean') as flags, coalesce(case when cloud < 50 then cloud end, 99.0) as cloud, case when cloud < 50 then 'live' else 'fallback' end as origin from items left join g using (orbit)")
def c10_c11_flags(spark, sf_dir):
    f = spark.createDataFrame([(0, "glint"), (0, "ice"), (1, "turbid"), (2, "glint")], "orbit long, flag string")
    g = f.groupBy("orbit").agg(F.array_join(F.array_sort(F.collect_list("flag")), ",").alias("flags"))
    live = F.when(F.col("cloud") < 50, F.col("cloud"))
    return table(spark, sf_dir, "items").join(F.broadcast(g), "orbit", "left").select("id", F.coalesce("flags", F.lit("clean")).alias("flags"), F.coalesce(live, F.lit(99.0)).alias("cloud"), F.when(live.isNotNull(), "live").otherwise("fallback").alias("origin"))


def _results(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    m = F.create_map(F.lit("rmse_db"), F.col("x") / 400000, F.lit("correlation"), F.col("y"), F.lit("coherence"), F.col("x") / 250000)
    ids = F.array(*[F.lit(c) for c in ("rtc.rmse_db_max", "disp.correlation_min", "cslc.selfconsistency.coherence_min", "dist.f1_min", "no.such_max", "rtc.eu.investigation_rmse_db_min")])
    return o.groupBy(F.concat_ws(":", "o_orderstatus", "o_orderpriority").alias("cell")).agg(F.round(F.avg("o_totalprice"), 4).alias("x"), F.avg((F.col("o_custkey") % 2).cast("double")).alias("y")).select("cell", m.alias("measurements"), ids.alias("criterion_ids"))


_RES = f"""with r as (select o_orderstatus || ':' || o_orderpriority as cell, round(avg(o_totalprice), 4) as x, avg((o_custkey % 2)::double) as y from orders group by 1),
e as (select cell, unnest([0, 1, 2, 3, 4, 5])::int as place, unnest(['rtc.rmse_db_max', 'disp.correlation_min', 'cslc.selfconsistency.coherence_min', 'dist.f1_min', 'no.such_max', 'rtc.eu.investigation_rmse_db_min']) as criterion, x, y from r),
v as (select cell, place, e.criterion, kind, case place when 0 then x / 400000 when 1 then y when 2 then x / 250000 end as value, comparator, threshold from e left join {CRITERIA_SQL} on criteria.criterion = e.criterion),
w as (select *, case when threshold is null then 'UNKNOWN' when value is null then 'MEASUREMENT_MISSING' when kind = 'CALIBRATING' then 'CALIBRATING' when case comparator when '>' then value > threshold when '>=' then value >= threshold when '<' then value < threshold else value <= threshold end then 'PASS' else 'FAIL' end as verdict from v)"""


@REG.add(_RES + " select cell, place, criterion, kind, round(value, 6) as value, verdict from w")
def v01_v02_evaluate(spark, sf_dir):
    return rounded(V.evaluated(_results(spark, sf_dir), criteria(spark)).select("cell", "place", "criterion", "kind", "value", "verdict"))


@REG.add(
    _RES
    + """, t as (select cell, place, kind = 'CALIBRATING' as open, case when value is null then 'MEASUREMENT_MISSING:' || regexp_replace(string_split(criterion, '.')[-1], '_(min|max)$', '')
else format('{:.4g}', value) || ' (' || comparator || ' ' || format('{:.4g}', threshold) || ' ' || case when case comparator when '>' then value > threshold when '>=' then value >= threshold when '<' then value < threshold else value <= threshold end then 'PASS' else 'FAIL' end
  || case when kind = 'CALIBRATING' then ' (CALIBRATING — binds v1.2)' else '' end || ')' end as t from w where threshold is not null and kind <> 'INVESTIGATION_TRIGGER')
select cell, case when bool_or(open) then '*' else '' end || string_agg(t, ' / ' order by place) || case when bool_or(open) then '*' else '' end as text from t group by 1"""
)
def v03_v05_matrix(spark, sf_dir):
    return V.rendered(V.evaluated(_results(spark, sf_dir), criteria(spark)))


@REG.add("with b as (select o_orderkey % 50 as cell, o_orderkey as burst, o_totalprice / 400000 as rmse, 1 - o_totalprice / 4e7 as r from orders), v as (select *, rmse < 0.5 and r > 0.99 as pass, rmse >= 0.15 or r < 0.999 as look from b) select cell, count(*) filter (where pass) as passed, bool_or(look) as investigate, round(coalesce(max(rmse) filter (where pass), -1), 6) as worst_rmse, coalesce(max_by(burst, rmse) filter (where pass), -1) as worst_burst from v group by 1")
def v07_v08_burst_rollup(spark, sf_dir):
    b = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 50).alias("cell"), F.col("o_orderkey").alias("burst"), (F.col("o_totalprice") / 400000).alias("rmse"), (1 - F.col("o_totalprice") / 4e7).alias("r"))
    ok, look = (F.col("rmse") < 0.5) & (F.col("r") > 0.99), (F.col("rmse") >= 0.15) | (F.col("r") < 0.999)
    worst = F.max(F.when(ok, F.struct("rmse", "burst")))
    return rounded(b.groupBy("cell").agg(F.count_if(ok).alias("passed"), F.bool_or(look).alias("investigate"), F.coalesce(worst["rmse"], F.lit(-1.0)).alias("worst_rmse"), F.coalesce(worst["burst"], F.lit(-1)).alias("worst_burst")))


@REG.add(
    """with a as (select o_custkey || '/' || o_orderpriority as cell, case o_orderstatus when 'O' then 'PASS' when 'F' then 'FAIL' else 'CALIBRATING' end as s from orders),
b as (select cell, list_sort(list_distinct(list(s))) as s from a group by 1) select cell, case when len(s) = 1 then s[1] when list_contains(s, 'BLOCKER') then 'BLOCKER'
when list_contains(s, 'FAIL') and not list_contains(s, 'PASS') and not list_contains(s, 'CALIBRATING') then 'FAIL' else 'MIXED' end as status from b"""
)
def v09_status_rollup(spark, sf_dir):
    s = F.when(F.col("o_orderstatus") == "O", "PASS").when(F.col("o_orderstatus") == "F", "FAIL").otherwise("CALIBRATING")
    cell = F.concat_ws("/", "o_custkey", "o_orderpriority")
    a = table(spark, sf_dir, "orders").groupBy(cell.alias("cell")).agg(F.collect_set(s).alias("s"))  # of a fixed list of words
    return a.select("cell", V.status(F.col("s")).alias("status"))


@REG.add("select o_custkey % 40 as cell, round(min(o_totalprice), 6) as least, min(struct_pack(v := o_totalprice, k := o_orderkey)).k as least_at, round(max(abs(o_totalprice - 150000)), 6) as off, max(struct_pack(v := abs(o_totalprice - 150000), k := o_orderkey)).k as off_at from orders group by 1")
def v10_worst(spark, sf_dir):
    p, k = F.col("o_totalprice"), F.col("o_orderkey")
    off = F.abs(p - 150000)
    return rounded(table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 40).alias("cell")).agg(F.min(p).alias("least"), F.min(F.struct(p.alias("v"), k.alias("k")))["k"].alias("least_at"), F.max(off).alias("off"), F.max(F.struct(off.alias("v"), k.alias("k")))["k"].alias("off_at")))


@REG.add(with_tables("scores") + ", e as (select aoi, avg(f1) as f1 from scores group by 1) select aoi, round(f1, 6) as f1, case when f1 > 0.9 then 'PASS' when f1 >= 0.85 then 'ml' else 'calibration' end as path, f1 < 0.85 as regression from e")
def v12_v13_upgrade_path(spark, sf_dir):
    e = table(spark, sf_dir, "scores").groupBy("aoi").agg(F.avg("f1").alias("f1"))
    return rounded(e.select("aoi", "f1", V.upgrade_path(F.col("f1")).alias("path"), (F.col("f1") < 0.85).alias("regression")))


@REG.add("with c as (select c_custkey as id, case c_custkey % 2 when 0 then 'spurt' else 'phass' end as candidate, case when c_custkey % 7 = 0 then null else (c_custkey % 100) / 100.0 end as r, case when c_custkey % 5 = 0 then null else (c_custkey % 60) / 10.0 end as ramp, case c_custkey % 3 when 0 then 'inconclusive' else 'orbit' end as source from customer) select id, case when r is null and ramp is null then 'BLOCKER' when case candidate when 'spurt' then coalesce(r >= 0.7 and ramp < 5 and source = 'inconclusive', false) else coalesce(r >= 0.5, false) or coalesce(ramp < 1, false) end then 'PASS' else 'FAIL' end as status from c")
def v14_unwrapper_status(spark, sf_dir):
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(k.alias("id"), F.when(k % 2 == 0, "spurt").otherwise("phass").alias("candidate"), F.when(k % 7 != 0, (k % 100) / 100.0).alias("r"), F.when(k % 5 != 0, (k % 60) / 10.0).alias("ramp"), F.when(k % 3 == 0, "inconclusive").otherwise("orbit").alias("source"))
    return c.select("id", V.unwrapper_status(F.col("candidate"), F.col("r"), F.col("ramp"), F.col("source")).alias("status"))


@REG.add("with d as (select s_suppkey as id, (s_suppkey % 11) / 100.0 as dr, (s_suppkey % 3) / 1.5 as db, (s_suppkey % 4) / 2.0 as dm, (s_suppkey % 13)::double as dp from supplier), s as (select id, list_filter([case when dr >= 0.05 then 'r' end, case when db >= 1 then 'bias' end, case when dm >= 1 then 'rmse' end, case when dp >= 5 then 'ramp' end], lambda x: x is not null) as s from d) select id, array_to_string(s, ',') as signals, len(s) >= 2 as meaningful, case when len(s) < 2 then 4 else 5 end as causes from s")
def v15_v16_correction_delta(spark, sf_dir):
    k = F.col("s_suppkey")
    d = {"r": (k % 11) / 100.0, "bias": (k % 3) / 1.5, "rmse": (k % 4) / 2.0, "ramp": (k % 13).cast("double")}
    p = table(spark, sf_dir, "supplier").select(k.alias("id"), *[F.lit(0.0).alias(f"base_{m}") for m in d], *[x.alias(f"variant_{m}") for m, x in d.items()])
    out = V.correction_delta(p, {"r": 0.05, "bias": 1.0, "rmse": 1.0, "ramp": 5.0})
    return out.select("id", "signals", "meaningful", F.when(~F.col("meaningful"), 4).otherwise(5).alias("causes"))


@REG.add(with_tables("pairs") + ", d as (select scene_id, predicted - reference as d, predicted, reference from pairs) select scene_id, round(greatest(max(abs(d)), 1e-9), 4) as half_range, round(regr_slope(predicted, reference), 6) as slope, round(min(least(predicted, reference)), 4) as lo, round(max(greatest(predicted, reference)), 4) as hi from d group by 1")
def v18_v19_difference_and_fit(spark, sf_dir):
    p, r = F.col("predicted"), F.col("reference")
    out = table(spark, sf_dir, "pairs").groupBy("scene_id").agg(F.greatest(F.max(F.abs(p - r)), F.lit(1e-9)).alias("half_range"), F.regr_slope(p, r).alias("slope"), F.min(F.least(p, r)).alias("lo"), F.max(F.greatest(p, r)).alias("hi"))
    return out.select("scene_id", F.round("half_range", 4).alias("half_range"), F.round("slope", 6).alias("slope"), F.round("lo", 4).alias("lo"), F.round("hi", 4).alias("hi"))


@REG.add("select c_custkey, round(coalesce(o.v, c_acctbal), 4) as value, case when o.v is null then 'own' else 'reused' end as origin from customer left join (select o_custkey, max(o_totalprice) as v from orders where o_orderstatus = 'F' and o_orderpriority = '1-URGENT' group by 1) o on o_custkey = c_custkey")
def v20_measurement_reuse(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'F' and o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("v"))
    j = table(spark, sf_dir, "customer").join(o, "c_custkey", "left")
    return j.select("c_custkey", F.round(F.coalesce("v", "c_acctbal"), 4).alias("value"), F.when(F.col("v").isNull(), "own").otherwise("reused").alias("origin"))

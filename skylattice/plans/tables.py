"""The engine's tables, derived from the given ones with integer arithmetic; each with the same text in SQL.

Nodata is NULL throughout. Rasters are long tables keyed by (scene_id, row, col).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

W = 100  # columns of the raster that events fill, row by row

PAIRS = """select l_suppkey % 8 as scene_id, l_extendedprice as predicted, l_quantity * p_retailprice as reference
from lineitem join part on l_partkey = p_partkey"""
BINARY = """select l_suppkey % 8 as scene_id, case when l_linenumber % 5 = 0 then null when l_discount > 0.05 then 1 else 0 end as predicted,
case when l_tax > 0.04 then 1 else 0 end as reference from lineitem"""
GRID = f"""select event_id, cast(div(event_id, {W}) as int) as row, cast(event_id % {W} as int) as col, case when event_id % 37 = 0 then null else value end as value from events"""
BANDS = f"""select event_id, cast(div(event_id, {W}) as int) as row, cast(event_id % {W} as int) as col, event_id % 4 as scene_id,
cast((event_id * 37) % 3000 as int) as blue, cast((event_id * 53) % 4000 as int) as green, cast((event_id * 71) % 3500 as int) as red,
cast((event_id * 97) % 5000 as int) as nir, cast((event_id * 113) % 4500 as int) as swir1, cast((event_id * 131) % 3000 as int) as swir2,
cast((div(event_id, {W}) + 3 * (event_id % {W})) % 12 as int) as scl from events"""
CLASSES = f"""select event_id, cast(div(event_id, {W}) as int) as row, cast(event_id % {W} as int) as col,
cast((div(div(event_id, {W}), 6) + 2 * div(event_id % {W}, 5)) % 9 as int) as cls, cast((div(div(event_id, {W}), 4) + div(event_id % {W}, 7)) % 9 as int) as status,
cast((div(div(event_id, {W}), 3) + div(event_id % {W}, 4)) % 3 as int) as jrc, value from events"""
STACK = """select event_id % 10 as epoch, cast(div(div(event_id, 10), 10) as int) as row, cast(div(event_id, 10) % 10 as int) as col,
value / 50 as phase, cos(value / 50) * (1 + div(div(event_id, 10), 10) % 3) as re, sin(value / 50) * (1 + div(div(event_id, 10), 10) % 3) as im,
12 * (event_id % 10) as days, 1 - (value % 100) / 250 as coh from events"""
IFG = """select event_id % 10 as ifg_idx, cast(div(div(event_id, 10), 10) as int) as row, cast(div(event_id, 10) % 10 as int) as col,
0.05 * (div(event_id, 10) % 10) + 0.03 * div(div(event_id, 10), 10) + 0.001 * value as phase, 1 - (value % 100) / 250 as coh from events where event_id % 10 < 9"""
POINTS = """select c_custkey as pid, -32 + cast(77 * ((c_custkey * 7919) % 10007) as double) / 10007 as lon, 27 + cast(45 * ((c_custkey * 104729) % 10007) as double) / 10007 as lat,
c_acctbal / 1000 as mean_velocity, cast(c_custkey % 40 as double) / 10 as mean_velocity_std from customer"""
POLYGONS = """select s_suppkey as id, -32 + cast(77 * ((s_suppkey * 7919) % 10007) as double) / 10007 as cx, 27 + cast(45 * ((s_suppkey * 104729) % 10007) as double) / 10007 as cy,
cast(0.5 as double) + s_suppkey % 3 as half from supplier"""
ITEMS = """select event_id as id, ts as sensing, value % 100 as cloud, user_id % 5 as orbit, event_type as platform, user_id % 7 as tile from events"""
SCORES = """select p_size % 5 as aoi, div(p_size, 5) % 2 as season, cast(0.08 as double) + cast(0.005 as double) * (p_size % 45) as wigt, cast(-0.2 as double) + cast(0.01 as double) * (p_partkey % 31) as awgt,
avg(cast((p_partkey * 31) % 997 as double) / 997) as f1 from part group by 1, 2, 3, 4"""
# Shapes by their corners, in order; coordinates are quarters, so that touching is exact.
CORNERS = """select s_suppkey as id, k, cast((s_suppkey * 7919) % 797 as double) / 4 + (1 + s_suppkey % 3 + case when s_suppkey % 29 = 0 then 12 else 0 end) * dx as x,
cast((s_suppkey * 10477) % 613 as double) / 4 + (1 + s_suppkey % 3 + case when s_suppkey % 29 = 0 then 12 else 0 end) * dy as y
from supplier join (values (0, 0, 0.0, 0.0), (0, 1, 4.0, 0.0), (0, 2, 0.0, 4.0), (1, 0, 0.0, 0.0), (1, 1, 4.0, 0.0), (1, 2, 4.0, 1.0), (1, 3, 1.0, 1.0), (1, 4, 1.0, 4.0), (1, 5, 0.0, 4.0),
(2, 0, 0.0, 0.0), (2, 1, 4.0, 3.75), (2, 2, 4.0, 4.0), (3, 0, 0.0, 0.0), (3, 1, 2.0, 0.0), (3, 2, 2.0, 2.0), (3, 3, 0.0, 2.0)) t(kind, k, dx, dy) on s_suppkey % 4 = kind"""
FOOTPRINTS = """select c_custkey as id, k, cast((c_custkey * 3571) % 809 as double) / 4 + dx as x, cast((c_custkey * 2741) % 631 as double) / 4 + dy as y
from customer join (values (0, 0, 0.0, 0.0), (0, 1, 3.0, 1.0), (0, 2, 3.5, 2.0), (0, 3, 0.5, 1.0), (1, 0, 0.0, 0.0), (1, 1, 0.25, 0.0), (1, 2, 0.25, 0.25), (1, 3, 0.0, 0.25), (2, 0, 0.0, 0.0), (2, 1, 5.0, 0.25), (2, 2, 5.0, 0.5)) t(kind, k, dx, dy) on c_custkey % 3 = kind"""

ALL = {
    "pairs": PAIRS, "binary_pairs": BINARY, "grid": GRID, "bands": BANDS, "classes": CLASSES, "stack": STACK, "ifg": IFG,
    "points": POINTS, "polygons": POLYGONS, "corners": CORNERS, "footprints": FOOTPRINTS, "items": ITEMS, "scores": SCORES,
}


def _spark_text(text: str) -> str:
    """div(a, b) is a function in neither dialect in the same way: here it becomes the integer division of Spark."""
    return _rewrite(text, lambda a, b: f"(({a}) div ({b}))")


def _rewrite(text: str, made) -> str:
    while (at := text.find("div(")) >= 0:
        depth, comma, k = 0, 0, at + 3
        for k in range(at + 3, len(text)):
            depth += {"(": 1, ")": -1}.get(text[k], 0)
            if depth == 1 and text[k] == ",":
                comma = k
            if depth == 0:
                break
        text = text[:at] + made(text[at + 4 : comma], text[comma + 1 : k].strip()) + text[k + 1 :]
    return text


def sql_text(text: str) -> str:
    return _rewrite(text, lambda a, b: f"(({a}) // ({b}))")


def with_tables(*names: str) -> str:
    """WITH clause of the named tables, for the SQL of a query."""
    return "with " + ", ".join(f"{n} as ({sql_text(ALL[n])})" for n in names) + " "


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or one of those above."""
    if name not in ALL:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = _spark_text(ALL[name])
    sources = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "part", "events", "customer", "supplier") if f" {t}" in text}
    for t in sources:
        text = text.replace(f"from {t}", f"from {{{t}}}").replace(f"join {t}", f"join {{{t}}}")
    return spark.sql(text, **sources)


# Criteria (name, threshold, comparator, kind).
CRITERIA = [
    ("rtc.rmse_db_max", 0.5, "<", "BINDING"),
    ("rtc.correlation_min", 0.99, ">", "BINDING"),
    ("rtc.eu.investigation_rmse_db_min", 0.15, ">=", "INVESTIGATION_TRIGGER"),
    ("rtc.eu.investigation_r_max", 0.999, "<", "INVESTIGATION_TRIGGER"),
    ("cslc.amplitude_r_min", 0.6, ">", "BINDING"),
    ("cslc.amplitude_rmse_db_max", 4.0, "<", "BINDING"),
    ("cslc.selfconsistency.coherence_min", 0.7, ">", "CALIBRATING"),
    ("cslc.selfconsistency.residual_mm_yr_max", 5.0, "<", "CALIBRATING"),
    ("disp.correlation_min", 0.92, ">", "BINDING"),
    ("disp.bias_mm_yr_max", 3.0, "<", "BINDING"),
    ("disp.selfconsistency.coherence_min", 0.7, ">", "CALIBRATING"),
    ("disp.selfconsistency.residual_mm_yr_max", 5.0, "<", "CALIBRATING"),
    ("dist.f1_min", 0.80, ">", "BINDING"),
    ("dist.accuracy_min", 0.85, ">", "BINDING"),
    ("dswx.f1_min", 0.90, ">", "BINDING"),
    ("dswx.nam.investigation_f1_max", 0.85, "<", "INVESTIGATION_TRIGGER"),
]


def criteria(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CRITERIA, "criterion string, threshold double, comparator string, kind string")


CRITERIA_SQL = "(values " + ", ".join(f"('{n}', {t}::double, '{c}', '{k}')" for n, t, c, k in CRITERIA) + ") criteria(criterion, threshold, comparator, kind)"

"""Streaming operators over the given tables, run until all that is there has been seen; and the score sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalogue as C
from ..sources import io
from ..streaming import streams as T
from .shaping import Registry, rounded
from .tables import table, with_tables

REG = Registry()


@REG.add("select distinct user_id as id from events")
def sx1_new_items(spark, sf_dir):
    e = T.table_stream(spark, f"{sf_dir}/events.parquet").select(F.col("user_id").alias("id"), F.col("ts").cast("timestamp").alias("sensing"))
    return T.run_available(T.new_items(e), io.new_folder(spark)).select("id")


@REG.add(
    """with p as (select ts, (value > 100)::int as predicted, (user_id % 2)::int as reference from events),
d as (select date_trunc('day', ts) as day, count(*) filter (where predicted = 1 and reference = 1) as tp, count(*) filter (where predicted = 1 and reference = 0) as fp,
  count(*) filter (where predicted = 0 and reference = 1) as fn, count(*) filter (where predicted = reference) as correct, count(*) as total from p group by 1)
select epoch(day)::bigint as day, total, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1, round(correct / total, 6) as accuracy
from d where day + interval 1 day <= (select max(ts) - interval 1 day from events)"""
)
def sx2_daily_agreement(spark, sf_dir):
    e = T.table_stream(spark, f"{sf_dir}/events.parquet")
    pairs = e.select(F.col("ts").cast("timestamp").alias("ts"), (F.col("value") > 100).cast("int").alias("predicted"), (F.col("user_id") % 2).cast("int").alias("reference"))
    days = T.run_available(T.daily_agreement(pairs), io.new_folder(spark))
    return rounded(days.withColumn("day", F.unix_timestamp("day")))


@REG.add(
    """select user_id as stack, lag(epoch_us(ts)) over (partition by user_id order by ts) as first, epoch_us(ts) as second, false as late from events
qualify first is null or first < second"""
)
def sx3_epoch_pairs(spark, sf_dir):
    e = T.table_stream(spark, f"{sf_dir}/events.parquet").select(F.col("user_id").alias("stack"), F.unix_micros(F.col("ts").cast("timestamp")).alias("epoch"))
    return T.run_available(T.epoch_pairs(e), io.new_folder(spark))


@REG.add(with_tables("scores") + "select aoi, season, round(wigt, 6) as wigt, round(awgt, 6) as awgt, round(f1, 6) as f1 from scores")
def io07_score_sink(spark, sf_dir):
    """Grid scores written by area and season, and read back."""
    path = io.new_folder(spark) + "/scores"
    scores = table(spark, sf_dir, "scores")
    io.write_scores(scores, path)
    return rounded(spark.read.schema(scores.schema).parquet(path).select("aoi", "season", "wigt", "awgt", "f1"))


@REG.add("select s_suppkey as id, 's' || s_name as name from supplier union all select c_custkey, 'c' || c_name from customer union all select p_partkey, 'p' || p_name from part")
def a01_first_column(spark, sf_dir):
    """Three tables that name the same two fields differently."""
    out = None
    for name in ("supplier", "customer", "part"):
        t = table(spark, sf_dir, name)
        key, title = C.first_column(t, "s_suppkey", "c_custkey", "p_partkey"), C.first_column(t, "s_name", "c_name", "p_name")
        one = t.select(F.col(key).alias("id"), F.concat(F.lit(name[0]), F.col(title)).alias("name"))
        out = one if out is None else out.unionByName(one)
    return out


@REG.add(
    with_tables("points")
    + """select 'aliased' as source, count(*) as points, 'velocity_std' as std_column, count(*) filter (where mean_velocity_std < 2.0) as stable, null::varchar as blocker from points
union all select 'without', count(*), null, null, 'egms_l2a_schema_upstream_breakage' from points"""
)
def a03_std_alias(spark, sf_dir):
    p = table(spark, sf_dir, "points")
    aliased = io.std_ledger(p.withColumnRenamed("mean_velocity_std", "velocity_std")).withColumn("source", F.lit("aliased"))
    without = io.std_ledger(p.drop("mean_velocity_std")).withColumn("source", F.lit("without"))
    return aliased.unionByName(without).drop("columns")

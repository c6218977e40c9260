"""Polygons against polygons and against grids. A polygon is one ring, array<struct<x,y>>, its last point joined to its
first; a null or empty ring meets nothing and covers nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from . import ring_pairs
from .geometry import dealt_in_lots

#: No extent is so large: 2 ** MOST_LEVELS times the base.
MOST_LEVELS = 60

#: Rows of one side of a cell that meet as many of the other in one go.
LOT = 12_000

#: Pairs of boxes that a task looks at.
PAIRS = 1 << 24


def edges(ring: Column) -> Column:
    """array<struct<a, b>>: the ring's sides."""
    n = F.size(ring)
    side = lambda k: F.struct(F.get(ring, k).alias("a"), F.get(ring, F.when(k + 1 == n, 0).otherwise(k + 1)).alias("b"))
    return F.transform(F.sequence(F.lit(0), n - 1), side)


def with_bounds(df: DataFrame, ring: str = "ring") -> DataFrame:
    xs, ys = F.transform(ring, lambda p: p.x), F.transform(ring, lambda p: p.y)
    bounds = {"xmin": F.array_min(xs), "xmax": F.array_max(xs), "ymin": F.array_min(ys), "ymax": F.array_max(ys)}
    return df.where(F.size(ring) > 0).withColumns(bounds)


def _level(base: float) -> Column:
    extent = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    return F.when(extent <= base, 0).otherwise(F.least(F.lit(MOST_LEVELS), F.ceil(F.log2(extent / base)))).cast("int")


def _keyed(df: DataFrame, levels: list[int], base: float, both: bool) -> DataFrame:
    """A row for each cell that a box meets, on its own level and all coarser ones that there are; a cell of a level is
    as large as the boxes there, so these are four at most on each. In turn 0 of a level the left shapes of the level
    meet the right ones that are no larger, in turn 1 smaller left shapes the right ones of the level: shapes of which
    neither is of the level are not paired there. both: the right side, whose shapes of the level take both turns."""
    up = F.filter(F.array(*[F.lit(k) for k in levels]), lambda k: k >= F.col("own"))
    cell = lambda c: F.floor(F.col(c) / F.col("size")).cast("long")
    rows = df.withColumn("own", _level(base)).withColumn("level", F.explode(up)).withColumn("size", F.lit(float(base)) * F.pow(F.lit(2.0), F.col("level")))
    level = F.col("own") == F.col("level")
    turns = F.when(level, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))) if both else F.array(F.when(level, 0).otherwise(1))
    rows = rows.withColumn("turn", F.explode(turns))
    return rows.withColumn("cx", F.explode(F.sequence(cell("xmin"), cell("xmax")))).withColumn("cy", F.explode(F.sequence(cell("ymin"), cell("ymax"))))


def polygons_meeting(a: DataFrame, b: DataFrame, base: float, exact: bool = True) -> DataFrame:
    """a(aid, ring), b(bid, ring) -> (aid, bid) of each pair of rows that meet, once; touching counts.

    Shapes meet in the cells of the coarser one's level, so a large shape is a few rows and a small one no more than four
    a level that occurs; base is about the size of the smallest shapes. A pair is told in one cell only, the one that
    holds the lower left corner of what the boxes share, so nothing is made distinct. exact=False compares boxes alone."""
    a, b = with_bounds(a.select("aid", "ring")), with_bounds(b.select("bid", "ring"))
    present = a.select(_level(base).alias("k")).unionByName(b.select(_level(base).alias("k"))).distinct().collect()  # MOST_LEVELS at most
    levels = sorted(r.k for r in present)
    if not levels:
        return a.select("aid").limit(0).crossJoin(b.select("bid").limit(0))
    keys = ["level", "turn", "cx", "cy"]
    low = lambda c, axis: (F.floor(F.col(f"{axis}min") / F.col("size")) == F.col(c)).alias(f"low_{axis}")
    named = lambda d, of: d.select(*keys, f"{of}id", low("cx", "x"), low("cy", "y"), "ring")
    left, right, tasks = dealt_in_lots(named(_keyed(a, levels, base, False), "a"), named(_keyed(b, levels, base, True), "b"), keys, LOT, PAIRS)
    keys = [*keys, "_pl", "_pr"]
    rows = left.withColumn("right", F.lit(False)).unionByName(right.withColumn("right", F.lit(True)), allowMissingColumns=True)
    rows = rows.repartition(tasks, *keys).sortWithinPartitions(*keys, "right")
    schema = StructType([a.schema["aid"], StructField("bids", ArrayType(b.schema["bid"].dataType, b.schema["bid"].nullable))])
    met = rows.mapInArrow(lambda batches: ring_pairs.meeting(batches, keys, exact), schema)
    return met.select("aid", F.explode("bids").alias("bid"))


def touched_spans(polygons: DataFrame, size: float) -> DataFrame:
    """polygons(id, ring) -> (id, row, first, last): the cells that the sides pass through, side by side and row by row. A
    cell holds its lower and left border, not its upper and right one."""
    e = polygons.where(F.size("ring") > 0).select("id", F.explode(edges(F.col("ring"))).alias("e"))
    rises = F.col("e.a.y") <= F.col("e.b.y")
    end = lambda first, axis: F.when(rises, F.col(f"e.{'a' if first else 'b'}.{axis}")).otherwise(F.col(f"e.{'b' if first else 'a'}.{axis}")) / float(size)
    e = e.select("id", end(True, "x").alias("xa"), end(True, "y").alias("ya"), end(False, "x").alias("xb"), end(False, "y").alias("yb"))
    e = e.withColumn("row", F.explode(F.sequence(F.floor("ya").cast("long"), F.floor("yb").cast("long"))))
    slope = (F.col("xb") - F.col("xa")) / F.nullif(F.col("yb") - F.col("ya"), F.lit(0.0))
    at_low = F.when(F.col("ya") >= F.col("row"), F.col("xa")).otherwise(F.col("xa") + (F.col("row") - F.col("ya")) * slope)
    above = F.col("yb") >= F.col("row") + 1  # the side leaves the row upwards: its point there is the next row's
    at_high = F.when(above & (F.col("yb") > F.col("row") + 1), F.col("xa") + (F.col("row") + 1 - F.col("ya")) * slope).otherwise(F.col("xb"))
    right = F.col("xb") > F.col("xa")
    first = F.floor(F.least(at_low, at_high)).cast("long")
    last = F.when(right & above & (F.col("ya") < F.col("yb")), F.ceil(at_high) - 1).otherwise(F.floor(F.greatest(at_low, at_high))).cast("long")
    return e.select("id", "row", first.alias("first"), F.greatest(first, last).alias("last"))


def filled_spans(polygons: DataFrame, size: float) -> DataFrame:
    """(id, row, first, last): the cells whose centres lie inside, by the even-odd rule, one row of the grid at a time."""
    p = with_bounds(polygons.select("id", "ring"))
    row = lambda c: F.floor(F.col(c) / float(size)).cast("long")
    p = p.withColumn("row", F.explode(F.sequence(row("ymin"), row("ymax")))).withColumn("y", (F.col("row") + 0.5) * float(size))
    y = F.col("y")
    crossing = F.filter(edges(F.col("ring")), lambda e: (e.a.y > y) != (e.b.y > y))
    xs = F.array_sort(F.transform(crossing, lambda e: e.a.x + F.try_divide((y - e.a.y) * (e.b.x - e.a.x), e.b.y - e.a.y)))
    p = p.withColumn("xs", xs).where(F.size("xs") > 1)
    p = p.withColumn("k", F.explode(F.sequence(F.lit(0), F.size("xs") - 2, F.lit(2))))
    column = lambda k: F.get("xs", k) / float(size) - 0.5
    spans = p.select("id", "row", F.ceil(column(F.col("k"))).cast("long").alias("first"), (F.ceil(column(F.col("k") + 1)) - 1).cast("long").alias("last"))
    return spans.where("first <= last")


def covered(polygons: DataFrame, size: float) -> DataFrame:
    """(id, row, col, centre) of the cells that a side passes through or whose centres lie inside; centre: whether it
    does. Spans are brought together by row, and only then become cells: no cell is shuffled or kept to be told apart."""
    of = lambda d, centre: d.select("id", "row", F.struct("first", "last", F.lit(centre).alias("centre")).alias("s"))
    spans = of(filled_spans(polygons, size), True).unionByName(of(touched_spans(polygons, size), False))
    rows = spans.groupBy("id", "row").agg(F.collect_set("s").alias("s"))
    columns = lambda centre: F.array_distinct(F.flatten(F.transform(F.filter("s", lambda s: s.centre == centre), lambda s: F.sequence(s.first, s.last))))
    rows = rows.select("id", "row", columns(True).alias("f"), columns(False).alias("t"))
    cells = rows.select("id", "row", F.size("f").alias("n"), F.posexplode(F.concat("f", F.array_except("t", "f"))).alias("k", "col"))
    return cells.select("id", "row", "col", (F.col("k") < F.col("n")).alias("centre"))


def rasterised(polygons: DataFrame, size: float, all_touched: bool = False) -> DataFrame:
    """(id, row, col) of the cells of a grid of the given size that a polygon covers: those whose centres it holds, and
    with all_touched those too that a side passes through."""
    if all_touched:
        return covered(polygons, size).drop("centre")
    return filled_spans(polygons, size).select("id", "row", F.explode(F.sequence("first", "last")).alias("col"))

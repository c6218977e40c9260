"""Joins by cells where cells are full, rings are long and places are repeated."""

import random
from collections import Counter

from pyspark.sql import functions as F

from skylattice.operators import geometry as G
from skylattice.operators import neighbourhood as N
from skylattice.operators import polygons as P
from skylattice.operators import probes

from .test_shapes import meet_by_hand


def test_full_cells(spark):
    """All pairs of a cell, once each, however small the lots."""
    a = spark.range(230).select(F.when(F.col("id") < 200, 0).otherwise(F.col("id")).alias("c"), F.col("id").alias("i"))
    b = spark.range(150).select((F.col("id") % 2 * 205).alias("c"), F.col("id").alias("j"))
    want = Counter((i, j) for i in range(230) for j in range(150) if (0 if i < 200 else i) == j % 2 * 205 and i <= j)
    for lot in (7, 2000):
        assert Counter((r.i, r.j) for r in G.met_in_cells(a, b, ["c"], F.col("i") <= F.col("j"), lot=lot).collect()) == want
        assert {r.i for r in G.met_in_cells(a, b, ["c"], F.col("i") <= F.col("j"), "left_semi", lot).collect()} == {i for i, _ in want}


def test_long_rings_and_full_levels(spark, monkeypatch):
    """Rings of many corners, more pairs of sides than are compared at a time, and lots smaller than a cell's rows."""
    rng = random.Random(3)
    wavy = lambda x, y, n: [(x + (2 + k % 2) * (k if k < n else 2 * n - k) / n, y + (0.25 if k < n else 1.5) + k % 3 / 8) for k in range(2 * n)]
    a = [(k, wavy(rng.uniform(0, 6), rng.uniform(0, 6), rng.choice([2, 20]))) for k in range(20)]
    b = [(k, wavy(rng.uniform(0, 6), rng.uniform(0, 6), rng.choice([2, 40]))) for k in range(20)]
    monkeypatch.setattr(G.met_in_cells, "__defaults__", (None, "inner", 5))
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} long, ring array<struct<x:double,y:double>>")
    got = Counter(map(tuple, P.polygons_meeting(frame(a, "aid"), frame(b, "bid"), 0.5).collect()))
    assert got == Counter((i, j) for i, p in a for j, q in b if meet_by_hand(p, q))


def test_probe_of_repeated_rings(spark):
    """100,000 granules of one ring over 400 equal areas: what they tell is summed up once, not pair by pair."""
    box = lambda x: probes.box_ring(F.lit(x), F.lit(0.0), F.lit(x + 1), F.lit(1.0))
    areas = spark.range(400).select(F.col("id").alias("aid"), box(0.0).alias("ring"), F.lit("f").alias("folder"))
    areas = areas.unionByName(spark.range(400, 401).select(F.col("id").alias("aid"), box(9.0).alias("ring"), F.lit("f").alias("folder")))
    stamp = F.to_timestamp(F.when(F.col("id") % 7 == 3, "2024-06-02").otherwise("2024-06-03"))
    granules = spark.range(100_000).select(F.col("id").alias("bid"), box(0.5).alias("ring"), stamp.alias("sensing"), F.format_string("g%06d", "id").alias("granule"))
    listing = spark.createDataFrame([("f", "S1A_SLC_1.zip")], "folder string, file string")
    got = {r.aid: (r.granules, r.granule, r.cached) for r in probes.candidate_probe(areas, granules, listing, "2024-05-01", "2024-10-31", 1.0).collect()}
    assert got == {k: (100_000, "g000003", "S1A_SLC_1.zip") for k in range(400)} | {400: (0, None, "S1A_SLC_1.zip")}


def test_points_of_repeated_places(spark):
    """4,000 points of one place in 2,500 equal triangles: one test, ten million pairs. Rows that repeat stay pairs of their own."""
    at = lambda x, y: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"))
    points = spark.range(4000).select(F.col("id").alias("pid"), F.lit(0.5).alias("lon"), F.lit(0.25).alias("lat"))
    triangles = spark.range(2500).select("id", F.array(at(0.0, 0.0), at(2.0, 0.0), at(0.0, 2.0)).alias("ring"))
    assert G.points_in_polygons(points, triangles, 4.0).count() == 10_000_000
    odd = spark.createDataFrame([(1, 0.5, 0.25), (1, 0.5, 0.25), (2, None, 0.25), (3, 1.5, 1.5), (4, 0.5, 0.0)], "pid long, lon double, lat double")
    rings = spark.createDataFrame([(7, [(0.0, 0.0), (2.0, 0.0), (0.0, 2.0)]), (8, []), (9, None)], "id long, ring array<struct<x:double,y:double>>")
    assert sorted(map(tuple, G.points_in_polygons(odd, rings, 4.0).collect())) == [(1, 7), (1, 7), (4, 7)]


def test_boxes_of_repeated_rows(spark):
    """Each pair of rows once, over several cells and with rows that repeat: nothing is made distinct."""
    rng = random.Random(8)
    boxes = [(k % 40, x, y, x + rng.choice([0, 1, 9]), y + rng.choice([0, 2])) for k, x, y in ((k, rng.randrange(-20, 20) / 2, rng.randrange(-6, 6) / 2) for k in range(60))]
    boxes += boxes[:3]
    frame = lambda name: spark.createDataFrame([(k, *map(float, b)) for k, *b in boxes], f"{name} long, xmin double, ymin double, xmax double, ymax double")
    want = Counter((p[0], q[0]) for p in boxes for q in boxes if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4])
    assert Counter(map(tuple, G.boxes_meeting(frame("aid"), frame("bid"), 2.0).collect())) == want


def test_distance_of_repeated_places(spark):
    """20,000 pixels of one place by 20,000 equal segments: looked at once, not 400 million times."""
    pixels = spark.range(20_000).select(F.col("id").alias("pid"), F.when(F.col("id") % 4 == 0, 9.0).otherwise(0.5).alias("x"), F.lit(1.0).alias("y"))
    segments = spark.range(20_000).select(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(2.0).alias("x1"), F.lit(0.0).alias("y1"))
    assert G.within_distance(pixels, segments, 1.0).count() == 15_000


def test_block_mean_of_repeated_places(spark):
    """A point of a place that many have, beside one that is null and one far off."""
    grid = spark.range(400).select(F.lit(0).alias("scene_id"), (F.col("id") / 20).cast("int").alias("row"), (F.col("id") % 20).cast("int").alias("col"), F.when(F.col("id") % 7 > 0, F.col("id").cast("double")).alias("value"))
    points = spark.range(1_000_000).select(F.col("id").alias("pid"), F.when(F.col("id") == 1, None).when(F.col("id") == 2, 90.0).otherwise(9.5).alias("x"), F.lit(10.5).alias("y"))
    means = N.sample_block_mean(grid, points).groupBy("value").count().collect()
    near = [v for v in range(400) if v % 7 and abs(v // 20 - 10) <= 6 and abs(v % 20 - 10) <= 6]
    assert {(r.value and round(r.value, 9), r["count"]) for r in means} == {(None, 2), (round(sum(near) / len(near), 9), 999_998)}


def test_covered_cells(spark):
    """Each cell once with whether its centre is inside, a row of the grid being told by its spans."""
    ring = [(0.0, 0.0), (6.0, 0.0), (6.0, 4.0), (3.0, 1.25), (0.0, 4.0)]
    shapes = spark.createDataFrame([(1, ring), (2, [(0.1, 0.1), (6.3, 4.05), (6.3, 4.1)]), (3, [])], "id long, ring array<struct<x:double,y:double>>")
    rows = P.covered(shapes, 1.0).collect()
    assert len({(r.id, r.row, r.col) for r in rows}) == len(rows)
    assert {(r.id, r.row, r.col) for r in rows if r.centre} == {tuple(r) for r in P.rasterised(shapes, 1.0).collect()}
    spans = {(r.id, r.row, c) for r in P.touched_spans(shapes, 1.0).collect() for c in range(r.first, r.last + 1)}
    assert {(r.id, r.row, r.col) for r in rows} == spans | {(r.id, r.row, r.col) for r in rows if r.centre} and not any(r.centre for r in rows if r.id == 2)

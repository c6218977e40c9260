"""Polygons, projections, block draws and the threshold grid against brute force."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylattice.operators import polygons as P
from skylattice.operators import projections as J
from skylattice.operators import resample as R
from skylattice.plans import verdict_queries
from skylattice.sources import io

RING = "ring array<struct<x:double,y:double>>"


def side(p, q, r):
    return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])


def sides(ring):
    return list(zip(ring, ring[1:] + ring[:1], strict=True))


def sign(x):
    return (x > 0) - (x < 0)


def meet_by_hand(a, b):
    for (p, q), (r, s) in itertools.product(sides(a), sides(b)):
        boxes = all(max(p[k], q[k]) >= min(r[k], s[k]) and max(r[k], s[k]) >= min(p[k], q[k]) for k in (0, 1))
        if boxes and sign(side(p, q, r)) * sign(side(p, q, s)) <= 0 and sign(side(r, s, p)) * sign(side(r, s, q)) <= 0:
            return True
    return inside(a[0], b) or inside(b[0], a)


def inside(p, ring):
    n = sum((a[1] > p[1]) != (b[1] > p[1]) and p[0] < a[0] + (p[1] - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for a, b in sides(ring))
    return n % 2 == 1


def shapes(rng, n, large):
    kinds = [[(0, 0), (4, 0), (0, 4)], [(0, 0), (4, 0), (4, 1), (1, 1), (1, 4), (0, 4)], [(0, 0), (4, 3.75), (4, 4)], [(0, 0), (2, 0), (2, 2), (0, 2)], [(0, 0)], [(0, 0), (3, 0)]]
    out = []
    for k in range(n):
        x, y, scale = rng.randrange(-80, 80) / 4, rng.randrange(-80, 80) / 4, large if rng.random() < 0.05 else rng.choice([0.25, 1, 2])
        out.append((k, [(x + scale * dx, y + scale * dy) for dx, dy in rng.choice(kinds)]))
    return out


def test_polygons_meeting(spark):
    rng = random.Random(5)
    a, b = shapes(rng, 90, 12), shapes(rng, 120, 40)
    frame = lambda rows, name: spark.createDataFrame([*rows, (900, None), (901, [])], f"{name} long, {RING}")
    for base in (0.5, 4.0):
        got = Counter(map(tuple, P.polygons_meeting(frame(a, "aid"), frame(b, "bid"), base).collect()))
        assert got == Counter((i, j) for i, p in a for j, q in b if meet_by_hand(p, q))
    ell, corner = [(0, 0), (4, 0), (4, 1), (1, 1), (1, 4), (0, 4)], [(2, 2), (3, 2), (2, 3)]
    touching, beside = [(1.0, 2.0), (2.0, 2.0), (2.0, 3.0)], [(1.25, 2.0), (2.0, 2.0), (2.0, 3.0)]
    one = spark.createDataFrame([(1, [tuple(map(float, p)) for p in ell])], f"aid long, {RING}")
    two = spark.createDataFrame([(k, [tuple(map(float, p)) for p in r]) for k, r in enumerate([corner, touching, beside])], f"bid long, {RING}")
    assert [r.bid for r in P.polygons_meeting(one, two, 1.0).collect()] == [1]
    assert sorted(r.bid for r in P.polygons_meeting(one, two, 1.0, exact=False).collect()) == [0, 1, 2]
    assert P.polygons_meeting(one.limit(0), two.limit(0), 1.0).count() == 0 and P.polygons_meeting(one, two.limit(0), 1.0).count() == 0


def test_touched_cells(spark):
    """A sliver that holds no centre is found; dense points along the sides lie in the touched cells, and hardly any other is."""
    rng = random.Random(1)
    rings = [(k, [(rng.uniform(-9, 9), rng.uniform(-9, 9)) for _ in range(rng.choice([3, 3, 4]))]) for k in range(30)]
    rings += [(100, [(0.1, 0.1), (6.3, 4.05), (6.3, 4.1)]), (101, [(0.0, 0.0), (3.0, 0.0), (3.0, 3.0), (0.0, 3.0)]), (102, [(0.5, 2.0), (3.5, 2.0)])]
    frame = spark.createDataFrame([*rings, (200, []), (201, None)], f"id long, {RING}")
    touched, centres = {}, {}
    for r in P.touched_spans(frame, 1.0).collect():
        touched.setdefault(r.id, set()).update((r.row, c) for c in range(r.first, r.last + 1))
    for r in P.rasterised(frame, 1.0).collect():
        centres.setdefault(r.id, set()).add((r.row, r.col))
    every = {}
    for r in P.rasterised(frame, 1.0, all_touched=True).collect():
        assert (r.row, r.col) not in every.setdefault(r.id, set())
        every[r.id].add((r.row, r.col))
    for k, ring in rings:
        sampled = {(math.floor(a[1] + (b[1] - a[1]) * t / 4000), math.floor(a[0] + (b[0] - a[0]) * t / 4000)) for a, b in sides(ring) for t in range(4001)}
        assert sampled <= touched[k] and len(touched[k] - sampled) <= 2
        assert centres.get(k, set()) == {(r, c) for r in range(-10, 10) for c in range(-10, 10) if inside((c + 0.5, r + 0.5), ring)}
        assert every[k] == touched[k] | centres.get(k, set())
    assert 100 not in centres and len(every[100]) > 6
    assert touched[101] == {(r, c) for r in range(4) for c in range(4) if r in (0, 3) or c in (0, 3)} and 200 not in every


def test_projections(spark):
    rng = random.Random(2)
    rows = [(rng.uniform(-180, 180), rng.uniform(-80, 84)) for _ in range(500)]
    p = spark.createDataFrame(rows, "lon double, lat double").withColumn("zone", (F.floor((F.col("lon") + 180) / 6) + 1).cast("int")).withColumn("south", F.col("lat") < 0)
    east, north = J.to_utm(F.col("lon"), F.col("lat"), F.col("zone"), F.col("south"))
    p = p.withColumns({"e": east, "n": north})
    lon, lat = J.from_utm(F.col("e"), F.col("n"), F.col("zone"), F.col("south"))
    for r in p.withColumns({"lon2": lon, "lat2": lat}).collect():
        assert abs(r.lon - r.lon2) < 1e-9 and abs(r.lat - r.lat2) < 1e-9 and 160000 < r.e < 840000 and r.n > 0
    # A point of zone 31 (48.8583 N, 2.2945 E) to the decimetre, and the origin of the equal-area grid.
    one = spark.createDataFrame([(2.2945, 48.8583)], "lon double, lat double")
    e, n = one.select(*J.to_utm(F.col("lon"), F.col("lat"), F.lit(31), F.lit(False))).first()
    assert abs(e - 448251.8) < 0.2 and abs(n - 5411943.8) < 0.2
    europe = spark.createDataFrame([(10.0, 52.0), *[(rng.uniform(-31, 44), rng.uniform(27, 71)) for _ in range(500)]], "lon double, lat double")
    europe = europe.withColumns(dict(zip(("e", "n"), J.to_laea(F.col("lon"), F.col("lat")), strict=True)))
    back = europe.withColumns(dict(zip(("lon2", "lat2"), J.from_laea(F.col("e"), F.col("n")), strict=True))).collect()
    assert (round(back[0].e, 6), round(back[0].n, 6)) == (4321000.0, 3210000.0)
    assert all(abs(r.lon - r.lon2) < 1e-9 and abs(r.lat - r.lat2) < 1e-9 for r in back)


def test_point_layouts(spark):
    row = spark.createDataFrame([(4321000.0, 3210000.0, 1.5, 0.3)], "Easting double, NORTHING double, mean_velocity double, mean_velocity_stdev double")
    got = io.points(row).first()
    assert (round(got.lon, 9), round(got.lat, 9), got.mean_velocity, got.mean_velocity_std) == (10.0, 52.0, 1.5, 0.3)
    assert io.points(row.withColumnRenamed("mean_velocity_stdev", "rmse")).first().mean_velocity_std is None
    with pytest.raises(ValueError):
        io.points(row.drop("NORTHING"))


def test_exact_draws(spark):
    """Each replicate draws as many blocks as there are, the same ones however the rows are dealt."""
    rng = np.random.default_rng(4)
    for kept in (1, 5, 128, 129, 1000):
        tp, total = rng.integers(0, 50, kept), np.full(kept, 60)
        rows = [(int(k), int(tp[k]), 3, 2, int(55 - tp[k]), int(tp[k]), 1) for k in range(kept)]
        blocks = spark.createDataFrame(rows, "block long, tp long, fp long, fn long, tn long, correct long, total long")
        sums = {r.replicate: (r.tp, r.total) for r in R.bootstrap_sums(blocks, kept, 40, seed=3).collect()}
        assert len(sums) == 40 and all(n == kept for _, n in sums.values()) and total.sum()
        assert sums == {r.replicate: (r.tp, r.total) for r in R.bootstrap_sums(blocks.repartition(7), kept, 40, seed=3).collect()}
        if kept > 128:
            assert sums != {r.replicate: (r.tp, r.total) for r in R.bootstrap_sums(blocks, kept, 40, seed=4).collect()}
            means = np.array([t for t, _ in sums.values()]) / kept
            assert abs(means.mean() - tp.mean()) < 4 * tp.std() / math.sqrt(40 * kept) and 0.5 < means.std() * math.sqrt(kept) / tp.std() < 1.6
    gaps = blocks.where("block % 3 <> 0")
    assert all(r.total <= 1000 for r in R.bootstrap_sums(gaps, 1000, 10).collect())
    grid = {r.height: (r.kept, r.dropped, r.error) for r in R.block_grid(spark.createDataFrame([(3660, 3660), (32, 500)], "height int, width int"), 33).collect()}
    assert grid[3660] == (12100, 221, None) and grid[32][0] == 0 and "too small" in grid[32][2]
    one = {r.metric: r for r in R.bootstrap_exact(blocks, 1000, 200).collect()}
    assert all(r.lower <= r.point <= r.upper for r in one.values()) and one["f1"].upper - one["f1"].lower < 0.1
    with pytest.raises(ValueError):
        R.bootstrap_exact(blocks, 0)


def test_threshold_grid(spark):
    rng = random.Random(9)
    rows = [(k % 2, rng.choice([0.1, 0.2, 0.25, 0.3, rng.random()]), rng.choice([-0.1, 0.0, 0.1, rng.uniform(-1, 1)]), rng.randrange(8), rng.choice([0, 1, 1, None])) for k in range(600)]
    w, a = [0.1, 0.2, 0.3], [-0.1, 0.0, 0.1, 0.2]
    rules = verdict_queries._class_rules()
    got = R.grid_search(spark.createDataFrame(rows, "scene int, mndwi double, awesh double, rest int, reference int"), w, a, ["scene"], rules).collect()
    assert len(got) == 2 * 12
    for r in got:
        mine = [(rules[rest][(m > r.wigt) + 2 * (s > r.awgt)], ref) for scene, m, s, rest, ref in rows if scene == r.scene]
        want = [sum(p == x and ref == y for p, ref in mine) for x, y in ((True, 1), (True, 0), (False, 1), (False, 0))]
        assert [r.tp, r.fp, r.fn, r.tn] == want

"""Provenance, tiles, windows, candidates and stable terrain on small inputs."""

import hashlib
import math

from pyspark.sql import functions as F

from skylattice.operators import probes


def test_provenance(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.bin").write_bytes(b"\x00\xff")
    (tmp_path / "y y.txt").write_bytes(b"y")
    expected = spark.createDataFrame([("x", f"{tmp_path}/a/x.bin", "fresh"), ("y", f"file:{tmp_path}/y y.txt", "reused"), ("z", f"{tmp_path}/none", "missing")], "name string, path string, cache_mode string")
    got = {r.name: (r.sha256, r.cache_mode) for r in probes.provenance(spark, expected, str(tmp_path)).collect()}
    assert got == {"x": (hashlib.sha256(b"\x00\xff").hexdigest(), "fresh"), "y": (hashlib.sha256(b"y").hexdigest(), "reused"), "z": (None, "missing")}


def test_tiles(spark):
    tiles = spark.createDataFrame([(1, 0, 0, [1.0, 2.0, 3.0, 4.0, 5.0, -1.0]), (1, 1, 2, [math.nan, 7.0]), (1, 5, 5, [])], "scene_id int, tile_row int, tile_col int, data array<double>")
    got = {(r.row, r.col): r.value for r in probes.tiles_to_pixels(tiles, 3, 2, -1.0).collect()}
    assert got == {(0, 0): 1.0, (0, 1): 2.0, (0, 2): 3.0, (1, 0): 4.0, (1, 1): 5.0, (1, 2): None, (2, 6): None, (2, 7): 7.0}


def test_windows(spark):
    boxes = [(1, 0.5, 8.5, 2.0, 9.75), (2, -5.0, 0.0, 50.0, 90.0), (3, 20.0, 0.0, 30.0, 5.0), (4, 10.0, 9.0, 11.0, 9.5)]
    got = {r.pid: tuple(r)[1:] for r in probes.clipped_windows(spark.createDataFrame(boxes, "pid int, xmin double, ymin double, xmax double, ymax double"), 0.0, 10.0, 1.0, 10, 10).collect()}
    assert got == {1: (0, 2, 0, 2, False), 2: (0, 10, 0, 10, False), 3: (5, 10, 20, 10, True), 4: (0, 1, 10, 10, True)}


def test_candidates(spark):
    box = probes.box_ring(*[F.col(c) for c in ("x0", "y0", "x1", "y1")])
    sides = "x0 double, y0 double, x1 double, y1 double"
    areas = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0, "f1"), (2, 5.0, 5.0, 6.0, 6.0, "f2"), (3, 9.0, 9.0, 9.5, 9.5, None)], f"aid int, {sides}, folder string").withColumn("ring", box)
    found = [(1, 1.0, 1.0, 2.0, 2.0, "2024-06-02", "b"), (2, 0.5, 0.5, 0.6, 0.6, "2024-06-02", "a"), (3, 0.0, 0.0, 9.0, 9.0, "2023-06-02", "old"), (4, 5.5, 5.5, 5.6, 5.6, "2024-06-09", "c")]
    granules = spark.createDataFrame(found, f"bid int, {sides}, sensing string, granule string").withColumn("ring", box).withColumn("sensing", F.to_timestamp("sensing"))
    listing = spark.createDataFrame([("f1", "S1A_SLC_1.SAFE"), ("f1", "S1A_SLC_2.zip"), ("f2", "other.zip"), ("f9", "S1A_SLC.zip")], "folder string, file string")
    got = {r.aid: (r.granules, r.granule, r.cached) for r in probes.candidate_probe(areas, granules, listing, "2024-05-01", "2024-10-31", 1.0).collect()}
    assert got == {1: (2, "a", "S1A_SLC_2.zip"), 2: (1, "c", None), 3: (0, None, None)}


def test_stable_terrain(spark):
    rows = [(0, r, c, float(10 * c), r > 0, float(c % 2)) for r in range(5) for c in range(5)]
    got = probes.stable_terrain(spark.createDataFrame(rows, "scene_id int, row int, col int, value double, stable boolean, ramp double"), "value", 10.0, 10.0).first()
    assert (got.stable_pixels, got.retention, got.least, got.most) == (20, 0.8, 0.0, 40.0)
    assert abs(got.slope_p50 - 45) < 1e-9 and got.slope_ramp_r is None

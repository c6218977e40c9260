"""Whole comparisons on small scenes."""

import random

from pyspark.sql import functions as F

from skylattice.operators import agreement


def test_disturbance(spark):
    rng = random.Random(1)
    reference = [(s, r, c, rng.choice([0, 1, 2, 8, 255, None])) for s in (1, 2) for r in range(20 if s == 1 else 8) for c in range(12)]
    product = [(s, r, c, rng.choice([0, 1, 3, 255])) for s in (1, 2) for r in range(10 if s == 1 else 4) for c in range(6)]
    schema = "scene_id int, row int, col int, status int"
    got = {r.scene_id: r for r in agreement.disturbance_agreement(spark.createDataFrame(product[:-3], schema), spark.createDataFrame(reference, schema), 0.5).collect()}
    of = {(s, r, c): v for s, r, c, v in product[:-3]}
    binary = lambda v: None if v in (None, 255) else int(v in range(2, 9))
    for scene in (1, 2):
        pairs = [(binary(of.get((s, r // 2, c // 2))), binary(v)) for s, r, c, v in reference if s == scene]
        pairs = [p for p in pairs if None not in p]
        assert got[scene].n_valid == len(pairs)
        if len(pairs) < 100:
            assert got[scene].f1 is None and got[scene].accuracy is None
        else:
            tp, wrong = sum(p == (1, 1) for p in pairs), sum(a != b for a, b in pairs)
            assert abs(got[scene].f1 - 2 * tp / (2 * tp + wrong)) < 1e-12 and abs(got[scene].accuracy - 1 + wrong / len(pairs)) < 1e-12
    assert {len(reference) > 0, got[2].n_valid < 100} == {True}


def test_water_sets(spark):
    """Left half water in the reference, the product one column too wide: only the shore is wrong."""
    rows = [(0, r, c, 1 if c <= 5 else 0, 2 if c < 5 else 1) for r in range(10) for c in range(10)]
    got = agreement.water_agreement(spark.createDataFrame(rows, "scene_id int, row int, col int, cls int, jrc int")).first()
    assert (got.shore_pixels, got.total, got.full_total, got.f1, got.full_f1) == (20, 80, 100, 1.0, 100 / 110)
    assert got.full_accuracy == 0.9 and got.full_recall == 1.0


def test_regions(spark):
    rows = spark.createDataFrame([(1, "EU"), (2, None), (3, "asia")], "k int, r string")
    got = {r.k: (r.wigt, r.pswt2) for r in agreement.region_thresholds(rows, F.col("r"), [("nam", 0.1, 0.0, -0.5), ("eu", 0.3, 0.0, -0.4)]).collect()}
    assert got == {1: (0.3, -0.4), 2: (0.1, -0.5), 3: (None, None)}


def test_held_out_gap(spark):
    rows = [(a, w, f) for a, f1s in enumerate([(0.9, 0.5), (0.8, 0.5), (0.1, 0.7)]) for w, f in zip((0.1, 0.2), f1s, strict=True)]
    got = agreement.held_out_gap(spark.createDataFrame([(a, w, 0.0, f) for a, w, f in rows], "aoi int, wigt double, awgt double, f1 double"), ["aoi"]).first()
    # Left out: area 0 by the others' best 0.2 (0.45 against 0.6), area 1 by 0.2 (0.5 against 0.6), area 2 by 0.1 (0.85).
    assert abs(got.loocv_mean_f1 - (0.5 + 0.5 + 0.1) / 3) < 1e-12 and abs(got.fit_mean_f1 - 0.6) < 1e-12 and got.status == "BLOCKER" and got.folds == 3

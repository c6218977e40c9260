"""The results matrix record by record, event roll-ups, names, and planes through pixels on a line."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylattice.functions.texts import significant
from skylattice.operators import catalogue, matrix, stacks
from skylattice.plans.tables import CRITERIA

SELF = {"worst_coherence_median_of_persistent": 0.78, "worst_residual_mm_yr": 2.1, "worst_aoi": "SoCal"}
AREA = {"status": "CALIBRATING", "product_quality": {"measurements": {"egms_l2a_stable_ps_residual_mm_yr": -1.26}}}
#: record, region -> shape, product quality, reference agreement.
RECORDS = [
    ({"unblock_condition": "scenes are there"}, "nam", "rtc_deferred", "—", "DEFERRED — scenes are there"),
    ({"per_burst": [], "pass_count": 3, "total": 5, "any_investigation_required": True}, "eu", "rtc", "—", "3/5 PASS (2 FAIL) ⚠"),
    ({"per_burst": [], "pass_count": 5, "total": 5, "any_investigation_required": False}, "eu", "rtc", "—", "5/5 PASS"),
    ({"per_event": [], "pass_count": 1, "total": 3, "worst_f1": 0.0708, "worst_event_id": "a|b", "any_chained_run_failed": True}, "eu", "dist", "—", "1/3 PASS (2 FAIL) | worst f1=0.071 (a|b) ⚠"),
    ({"reference_source": None, "cmr_probe_outcome": "operational_not_found", "cell_status": "DEFERRED"}, "nam", "dist_deferred", "—", "DEFERRED (CMR: operational_not_found)"),
    ({"thresholds_used": {}, "loocv_gap": 0.0312, "cell_status": "BLOCKER"}, "eu", "dswx_held_out", "—", "BLOCKER [LOOCV gap=0.031 (>= 0.02)]"),
    ({"thresholds_used": {}, "loocv_gap": 0.01, "cell_status": "FAIL", "named_upgrade_path": "ML", "reference_agreement": {"measurements": {"f1": 0.816}}}, "eu", "dswx_held_out", "—", "F1=0.816 FAIL — named upgrade: ML | LOOCV gap=0.010"),
    ({"selected_aoi": None, "candidates_attempted": [{"a": 1}, {"a": 2}], "cell_status": "BLOCKER"}, "nam", "dswx", "—", "BLOCKER [no candidate scene found among 2 attempts]"),
    (
        {"selected_aoi": "tahoe", "candidates_attempted": [], "cell_status": "PASS", "reference_agreement": {"measurements": {"f1": 0.925}}, "regression": {"f1_below_regression_threshold": True}}, "nam", "dswx", "—",
        "F1=0.925 PASS [aoi=tahoe] INVESTIGATION_REQUIRED",
    ),
    (
        {"per_aoi": [AREA, {"status": "BLOCKER"}], "total": 2, "any_blocker": True, "product_quality_aggregate": SELF, "reference_agreement_aggregate": {"worst_amp_r": 0.79, "worst_amp_rmse_db": 3.77}}, "nam", "cslc",
        "*1/2 CALIBRATING, 1/2 BLOCKER — binds v1.2 | coh=0.78 / resid=2.1 mm/yr (SoCal)* ⚠", "*amp_r=0.79 / amp_rmse=3.8 dB*",
    ),
    (
        {"per_aoi": [AREA], "total": 1, "any_blocker": False, "product_quality_aggregate": {}, "candidate_binding": {"verdict": "BINDING BLOCKER", "blocker": {"reason_code": "Mojave_frame"}}}, "eu", "cslc",
        "BINDING BLOCKER / coh=— / resid=— / egms_resid=1.3 mm/yr / blocker=Mojave_frame ⚠", "unavailable=Mojave_frame",
    ),
    (
        {
            "ramp_attribution": {"attributed_source": "phass"}, "per_aoi": [], "cell_status": "BLOCKER", "product_quality": {"measurements": {"residual_mm_yr": -0.1}, "coherence_source": "fresh"},
            "candidate_outcomes": [{"candidate": "other", "status": "PASS"}, {"candidate": "spurt_native", "status": "PASS", "partial_metrics": True}],
            "reference_agreement": {"measurements": {"correlation": 0.0365}, "criterion_ids": ["disp.correlation_min", "disp.bias_mm_yr_max", "nothing.known_min"]},
        },
        "nam", "disp", "*coh=— / resid=-0.1 mm/yr / attr=phass / cand=spurt:PASS* (CALIBRATING — needs 3rd AOI before binding; see DISP_UNWRAPPER_SELECTION_BRIEF.md)* ⚠",
        "0.0365 (> 0.92 FAIL) / MEASUREMENT_MISSING:bias_mm_yr / UNKNOWN_CRITERION:nothing.known_min",
    ),
    (
        {"product_quality": {"measurements": {}, "criterion_ids": []}, "reference_agreement": {"measurements": {"rmse_db": 123456.0, "correlation": 1.0}, "criterion_ids": ["rtc.eu.investigation_r_max", "rtc.rmse_db_max", "rtc.correlation_min"]}},
        "nam", "plain", "—", "1.235e+05 (< 0.5 FAIL) / 1 (> 0.99 PASS)",
    ),
    ({"ramp_attribution": {}, "per_burst": [], "pass_count": 1, "total": 1}, "nam", "rtc", "—", "1/1 PASS"),
    ({"per_aoi": "wrong"}, "eu", "RUN_FAILED", "RUN_FAILED (metrics.json invalid)", "RUN_FAILED"),
    ([1, 2], "eu", "RUN_FAILED", "RUN_FAILED (metrics.json invalid)", "RUN_FAILED"),
    (None, "eu", "RUN_FAILED", "RUN_FAILED (metrics.json missing)", "RUN_FAILED"),
]


def test_matrix(spark):
    cells = spark.createDataFrame([(k, "cslc", r[1], f"eval-{k}/metrics.json") for k, r in enumerate(RECORDS)] + [(99, "x", "eu", "eval-99/metrics.json")], "k int, product string, region string, path string")
    files = spark.createDataFrame([(f"eval-{k}/metrics.json", json.dumps(r[0])) for k, r in enumerate(RECORDS) if r[0] is not None] + [("eval-99/metrics.json", "{broken")], "path string, content string")
    got = {r.k: r for r in matrix.matrix(cells, files, CRITERIA).collect()}
    for k, (_, _, shape, pq, ra) in enumerate(RECORDS):
        assert (got[k].shape, got[k].pq, got[k].ra) == (shape, pq, ra), k
    assert got[3].line == "| CSLC | EU | — | 1/3 PASS (2 FAIL) \\| worst f1=0.071 (a\\|b) ⚠ |"
    assert got[99].pq == "RUN_FAILED (metrics.json invalid)" and len(got) == len(RECORDS) + 1


@pytest.mark.parametrize("value", [0.0, -0.0, 1.0, -2.5, 0.92, 12345.678, 9999.6, 99994.0, 0.0001234567, 0.00001234567, 1e-300, -1e20, 100.0, 1234.0, 3.0000001, float("inf"), float("nan")])
def test_significant_digits(spark, value):
    assert spark.range(1).select(significant(F.lit(value))).first()[0] == f"{value:.4g}"


def test_event_rollup(spark):
    events = [("a", "x", 0.9, 0.9, 0.9, 0.9, None), ("a", "y", 0.81, 0.86, 0.71, 0.51, "skipped"), ("b", "x", 0.8, 0.9, 0.9, 0.9, "failed"), ("c", "q", 0.9, 0.9, 0.9, 0.9, "structurally_valid"), ("c", "p", 0.9, 0.9, 0.9, 0.5, None)]
    rows = spark.createDataFrame(events, "cell string, event string, f1 double, accuracy double, precision double, recall double, chained string")
    got = {r.cell: (r.passed, r.total, r.status, r.worst_event, r.any_chained_run_failed) for r in matrix.event_rollup(rows, ["cell"]).collect()}
    assert got == {"a": (2, 2, "PASS", "y", False), "b": (0, 1, "FAIL", "x", True), "c": (1, 2, "MIXED", "p", False)}


def test_orbit_names(spark):
    names = ["S1A_OPER_AUX_POEORB_OPOD_20240121T070543_V20231231T225942_20240102T005942.EOF", "S1A_OPER_AUX_RESORB_OPOD_V20240101T030000_20240101T070000.EOF", "S1A_RESORB_V20240101T040000_20240101T070000.EOF", "POEORB.EOF", "x_V20249999T000000_20240101T000000"]
    files = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, i int")
    rows = {r.i: r for r in catalogue.orbit_coverage(files.withColumn("t", F.to_timestamp(F.lit("2024-01-01 05:00:00")))).collect()}
    assert [(rows[i].type, rows[i].covers) for i in range(5)] == [("POEORB", True), ("RESORB", True), ("RESORB", True), ("POEORB", None), ("UNKNOWN", None)]
    times = spark.createDataFrame([(1, "2024-01-01 05:00:00"), (2, "2024-01-05 00:00:00"), (3, "2024-01-01 07:00:00")], "tid int, t string").withColumn("t", F.to_timestamp("t"))
    got = {r.tid: (r.orbit, r.n_covering) for r in catalogue.orbit_assigned(times, files.select("name"), 3600).collect()}
    assert got == {1: (names[0], 3), 2: (None, 0), 3: (names[0], 3)}
    only = {r.tid: r.orbit for r in catalogue.orbit_assigned(times, files.where("i > 0").select("name"), 3600).collect()}
    assert only == {1: names[2], 2: None, 3: names[2]}


def test_frames(spark):
    named = lambda k, f, h: f"L3_{f}_VV_20230805T{h:02d}0045Z_{k}"
    rows = [("exact", named(k, "F1", 14), k) for k in range(2)] + [("exact", named(k, "F2", 15), k) for k in range(5)]
    rows += [("near", named(k, "F3", 13), k) for k in range(2)] + [("near", named(9 + k, "F4", 2), 9 + k) for k in range(5)]
    rows += [("any", named(k, "F5", 3), k) for k in range(2)] + [("any", named(5 + k, "F6", 2), 5 + k) for k in range(2)]
    rows += [("last", named(0, "F7", 14), 0), ("last", named(1, "F7", 3), 1), ("last", named(2, "F8", 15), 2), ("none", "nothing", 0)]
    got = {r.k: (r.frame, r.n, r.tier) for r in catalogue.frame_at_hour(spark.createDataFrame(rows, "k string, name string, seq int"), ["k"], 14).collect()}
    assert got == {"exact": ("F1", 2, 0), "near": ("F3", 2, 1), "any": ("F5", 2, 2), "last": ("F8", 1, 1)}


def test_planes_on_a_line(spark):
    """Equal to the least-squares solution of least norm for one row, one column and slanted lines."""
    rng = np.random.default_rng(5)
    lines = [(np.arange(150), np.full(150, 7)), (np.full(150, 4), np.arange(150)), (np.arange(150), 2 * np.arange(150) + 3), (3 * np.arange(150), 1000 - np.arange(150)), (rng.integers(0, 60, 150), rng.integers(0, 60, 150))]
    rows, want = [], {}
    for k, (x, y) in enumerate(lines):
        z = 0.3 * x - 0.2 * y + rng.normal(size=150) + 5
        rows += [(k, int(r), int(c), float(v)) for r, c, v in zip(y, x, z, strict=True)]
        want[k] = np.linalg.lstsq(np.column_stack([x, y, np.ones(150)]).astype(float), z, rcond=None)[0]
    got = stacks.planes(spark.createDataFrame(rows, "ifg_idx int, row int, col int, phase double"), 100).collect()
    for r in got:
        assert [r.slope_x, r.slope_y, r.intercept] == pytest.approx(want[r.ifg_idx], abs=1e-8)
    few = stacks.planes(spark.createDataFrame(rows[:50], "ifg_idx int, row int, col int, phase double"), 100).first()
    assert few.slope_x is None


def test_coherence_stats_either_way(spark):
    rng = np.random.default_rng(3)
    rows = [(r, c, float(x)) for r in range(12) for c in range(9) for x in rng.uniform(0.5, 1, 3)] + [(0, 0, None)]
    stack = spark.createDataFrame(rows, "row int, col int, coh double")
    one, other = stacks.coherence_stats(stack).first(), stacks.coherence_stats(stack, small=0).first()
    assert one.asDict() == pytest.approx(other.asDict()) and 0 < one.persistently_coherent_fraction < 1
    empty = stacks.coherence_stats(stack.limit(0)).first()
    assert set(empty.asDict().values()) == {0.0}


def test_negative_zero_in_records(spark):
    """A negative zero keeps its sign, a text that looks like one is left alone, and exponents too."""
    known = [("a_max", 1.0, "<", "BINDING"), ("b_max", 1.0, "<", "BINDING"), ("c_max", 1.0, "<", "BINDING"), ("d_max", 1.0, "<", "BINDING")]
    side = '{"measurements":{"a":-0.0,"b": -0 ,"c":1e-0,"d":-0.05},"criterion_ids":["a_max","b_max","c_max","d_max"]}'
    files = [("p", f'{{"note":"x\\":-0.0,","product_quality":{side},"reference_agreement":{side}}}'), ("q", '{"unblock_condition":"at: -0.0, \\"-0\\" -0.0","n":-0.0}')]
    cells = spark.createDataFrame([("rtc", "eu", "p"), ("rtc", "eu", "q")], "product string, region string, path string")
    got = {r.path: (r.pq, r.ra) for r in matrix.matrix(cells, spark.createDataFrame(files, "path string, content string"), known).collect()}
    text = "-0 (< 1 PASS) / -0 (< 1 PASS) / 1 (< 1 FAIL) / -0.05 (< 1 PASS)"
    assert got == {"p": (text, text), "q": ("—", 'DEFERRED — at: -0.0, "-0" -0.0')}

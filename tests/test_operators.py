"""Operators on literal tables, against values worked out by hand or with numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylattice.operators import comparison, metrics, neighbourhood, products, quantiles, resample, stacks, verdicts
from skylattice.plans.tables import criteria
from skylattice.streaming import streams


def pairs(spark, p, r):
    return spark.createDataFrame([(0, a, b) for a, b in zip(p, r, strict=True)], "scene_id int, predicted double, reference double")


def test_continuous(spark):
    a = metrics.continuous(pairs(spark, [1.0, 2.0, 3.0, None], [1.1, 2.1, 3.1, 9.0]), "scene_id").first()
    assert a.rmse == pytest.approx(0.1) and a.bias == pytest.approx(-0.1) and a.correlation == pytest.approx(1) and a.n == 3
    one = metrics.continuous(pairs(spark, [1.0], [2.0]), "scene_id").first()
    flat = metrics.continuous(pairs(spark, [1.0, 1.0], [2.0, 3.0]), "scene_id").first()
    assert one.correlation == 0.0 and flat.correlation is None


def test_classification(spark):
    m = metrics.classification(pairs(spark, [1.0, 1.0, 0.0, 0.0, None], [1.0, 0.0, 1.0, 0.0, 1.0]), "scene_id").first()
    assert (m.f1, m.precision, m.recall, m.accuracy) == (0.5, 0.5, 0.5, 0.4)
    assert metrics.classification(pairs(spark, [0.0], [0.0]), "scene_id").first().f1 == 0.0


def grid(spark, values):
    return spark.createDataFrame([(0, int(r), int(c), float(v)) for (r, c), v in np.ndenumerate(values)], "scene_id int, row int, col int, value double")


def test_boxcar_mirrors_its_border(spark):
    x = np.random.default_rng(0).random((9, 7))
    p = np.pad(x, 2, mode="symmetric")
    want = np.array([[p[r : r + 5, c : c + 5].mean() for c in range(7)] for r in range(9)])
    got = {(r.row, r.col): r.value for r in neighbourhood.boxcar(grid(spark, x), ["value"]).collect()}
    assert len(got) == 63 and all(got[k] == pytest.approx(v) for k, v in np.ndenumerate(want))


def test_wetland_and_shore(spark):
    cls = np.zeros((9, 9))
    cls[0, 0], cls[0, 3], cls[8, 8] = 1, 3, 3
    out = {(r.row, r.col): r.cls for r in neighbourhood.rescued_wetland(grid(spark, cls).withColumn("cls", F.col("value").cast("int"))).collect()}
    assert out[(0, 3)] == 3 and out[(8, 8)] == 0
    none = neighbourhood.shoreline(grid(spark, np.ones((4, 4))), "value")
    assert none.where("shore").count() == 0


def test_unwrap_and_ramp(spark):
    rng = np.random.default_rng(2)
    phase = rng.normal(0, 4, (6, 10))
    rows = [(e, k, 0, 12 * e, float(phase[k, e])) for k in range(6) for e in range(10)]
    u = stacks.unwrapped(spark.createDataFrame(rows, "epoch int, row int, col int, days int, phase double"))
    got = {(r.row, r.epoch): r.unwrapped for r in u.collect()}
    want = np.unwrap(phase, axis=1)
    assert all(got[k] == pytest.approx(v) for k, v in np.ndenumerate(want))
    plane = [(0, r, c, 0.05 * c + 0.03 * r + 7) for r in range(20) for c in range(20)]
    f = stacks.ramps(spark.createDataFrame(plane, "ifg_idx int, row int, col int, phase double")).first()
    assert f.slope_x == pytest.approx(0.05) and f.slope_y == pytest.approx(0.03) and f.intercept == pytest.approx(7) and f.direction == pytest.approx(math.degrees(math.atan2(0.03, 0.05)))
    few = spark.createDataFrame(plane[:50], "ifg_idx int, row int, col int, phase double")
    assert stacks.ramps(few).first().slope_x is None


def test_inversion_is_least_squares():
    days = [0.0, 12.0, 24.0, 48.0]
    links = [(0, 1), (1, 2), (2, 3), (0, 2), (1, 3)]
    phase = np.random.default_rng(4).normal(size=5)
    a = np.zeros((5, 4))
    for k, (i, j) in enumerate(links):
        a[k, i], a[k, j] = -1, 1
    x = np.linalg.lstsq(a[:, 1:], phase, rcond=None)[0]
    w = stacks.inversion_weights(links, days)
    assert sum(w[k] * phase[k] for k in range(5)) == pytest.approx(np.polyfit(days[1:], x, 1)[0])


def test_blocks_equal_pixels(spark):
    rng = np.random.default_rng(6)
    p, r = rng.integers(0, 2, (14, 21)), rng.integers(0, 2, (14, 21))
    df = spark.createDataFrame([(int(a), int(b), float(p[a, b]), float(r[a, b])) for a in range(14) for b in range(21)], "row int, col int, predicted double, reference double")
    blocks = resample.block_counts(df, 14, 21, 7)
    assert blocks.count() == 6
    b = {x.metric: x for x in resample.bootstrap(blocks, 200, resample.poisson_times()).collect()}
    assert b["accuracy"].point == pytest.approx((p == r).mean()) and b["f1"].lower < b["f1"].point < b["f1"].upper
    times = resample.poisson_times()
    drawn = spark.range(400).select(times(F.lit(1), F.col("id")).alias("t"), times(F.lit(2), F.col("id")).alias("u")).collect()
    assert abs(np.mean([x.t for x in drawn]) - 1) < 0.2 and [x.t for x in drawn] != [x.u for x in drawn]


@pytest.mark.parametrize("small", [0, 10**6])
def test_exact_quantiles(spark, small):
    rng = np.random.default_rng(12)
    values = {0: rng.normal(size=3000), 1: np.round(rng.exponential(3, 2500)), 2: np.array([4.0]), 3: np.full(1500, -1.5)}
    rows = [(k, float(v)) for k, vs in values.items() for v in vs] + [(0, None), (9, None)]
    df = spark.createDataFrame(rows, "k int, v double").repartition(5)
    shares = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = {r.k: tuple(r)[1:] for r in quantiles.exact_quantiles(df, "v", shares, keys=("k",), small=small).collect()}
    assert set(got) == set(values)
    for k, vs in values.items():
        assert got[k] == pytest.approx([np.quantile(vs, p) for p in shares.values()])
    every = quantiles.exact_quantiles(df, "v", shares, small=small).collect()
    assert [tuple(r) for r in every] == [pytest.approx([np.quantile(np.concatenate(list(values.values())), p) for p in shares.values()])]
    assert quantiles.exact_quantiles(df.where("v is null"), "v", shares, keys=("k",), small=small).count() == 0


@pytest.mark.parametrize(("sigma", "size"), [(1.0, 9), (3.0, 4), (0.5, 1)])
def test_gaussian_by_hand(spark, sigma, size):
    z = np.random.default_rng(13).normal(size=(size, size + 2))
    rows = [(0, r, c, None if (r, c) == (0, 1) else float(z[r, c])) for r in range(size) for c in range(size + 2)]
    z[0, 1] = 0
    reach = int(4 * sigma + 0.5)
    w = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    w /= w.sum()
    for axis in (1, 0):
        padded = np.pad(z, [(reach, reach) if a == axis else (0, 0) for a in (0, 1)], mode="symmetric")
        z = np.apply_along_axis(lambda line: np.convolve(line, w, "valid"), axis, padded)
    got = products.gaussian(spark.createDataFrame(rows, "scene_id int, row int, col int, v double"), "v", sigma).collect()
    assert len(got) == z.size and all(r.v == pytest.approx(z[r.row, r.col]) for r in got)


def test_prepared_needs_a_method_and_a_form(spark):
    native = spark.createDataFrame([(0, 0, 0, 1.0)], "scene_id int, row int, col int, value double")
    for method in (None, "cubic"):
        with pytest.raises(ValueError, match="method"):
            comparison.prepared(native, native, method=method)
    with pytest.raises(ValueError, match="reference"):
        comparison.prepared(native, native.select("value"), method="nearest")
    with pytest.raises(Exception, match="no layer"):
        comparison.stack_layers(spark.createDataFrame([(0, 0, 0, None)], "epoch int, row int, col int, vv struct<re: double, im: double>"), "vv").collect()


def test_late_epochs_are_told_apart(spark, tmp_path):
    schema = "stack long, epoch long"
    out = []
    for rows in ([(1, 10), (1, 20), (2, 5)], [(1, 15), (1, 30), (1, 30), (2, 6)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        out = streams.run_available(streams.epoch_pairs(source), str(tmp_path / "run")).collect()
    assert sorted((r.stack, r.first, r.second, r.late) for r in out if r["first"] is not None) == [(1, 10, 20, False), (1, 20, 30, False), (2, 5, 6, False)]
    assert sorted((r.stack, r.second, r.late) for r in out if r["first"] is None) == [(1, 10, False), (1, 15, True), (1, 30, True), (2, 5, False)]


def test_verdicts(spark):
    r = spark.createDataFrame([("a", {"rmse_db": 0.1}, ["rtc.rmse_db_max", "nope_min", "dist.f1_min"])], "cell string, measurements map<string,double>, criterion_ids array<string>")
    assert [x.verdict for x in verdicts.evaluated(r, criteria(spark)).orderBy("place").collect()] == ["PASS", "UNKNOWN", "MEASUREMENT_MISSING"]
    with pytest.raises(Exception, match="UNKNOWN"):
        verdicts.evaluated(r, criteria(spark), strict=True).collect()
    assert "PASS" in verdicts.rendered(verdicts.evaluated(r, criteria(spark))).first().text


def test_streams(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 01:00:00"), (2, "2024-01-02 00:00:00"), (3, "2024-03-01 00:00:00")]
    df = spark.createDataFrame(rows, "id int, t string").select("id", F.to_timestamp("t").alias("sensing"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))

    def run(stream, name):
        q = stream.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(90)
        return spark.table(name).collect()

    assert sorted(r.id for r in run(streams.new_items(source), "items")) == [1, 2, 3]
    scored = source.select(F.col("sensing").alias("ts"), F.lit(1).alias("predicted"), (F.col("id") % 2).alias("reference"))
    days = run(streams.daily_agreement(scored), "days")
    assert {r.day.day: r.total for r in days if r.day.month == 1} == {1: 2, 2: 1}


def test_files(spark, tmp_path):
    from skylattice.sources import io

    (tmp_path / "a.csv").write_text("Longitude,LATITUDE,mean_velocity,velocity_std\n1.5,2.5,3,0.5\n")
    (tmp_path / "b.csv").write_text("lon,lat,mean_velocity\n1,2,-3\n")
    (tmp_path / "c.csv").write_text("easting,mean_velocity\n1,2\n")
    got = io.read_points(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).orderBy("lon").collect()
    assert [tuple(r) for r in got] == [(1.0, 2.0, -3.0, None), (1.5, 2.5, 3.0, 0.5)]
    with pytest.raises(ValueError, match="c.csv"):
        io.read_points(spark, [str(tmp_path / "c.csv")])
    df = spark.createDataFrame([(1, 0, 0.5), (1, 1, 0.6), (2, 0, 0.7)], "aoi int, season int, f1 double")
    io.write_scores(df, str(tmp_path / "s"))
    io.write_scores(df.where("aoi = 1 and season = 0").withColumn("f1", F.lit(0.9)), str(tmp_path / "s"))
    assert sorted(r.f1 for r in spark.read.parquet(str(tmp_path / "s")).collect()) == [0.6, 0.7, 0.9]

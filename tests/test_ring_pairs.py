"""Lots of rings against each other: by forms and offsets where coordinates are whole, one by one where they are not."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skylattice.operators import geometry as G
from skylattice.operators import polygons as P
from skylattice.operators import ring_pairs as R
from skylattice.operators import rings

from .test_shapes import meet_by_hand, shapes

RING = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))


@pytest.fixture
def tested(monkeypatch):
    """How many pairs of rings are tested, by a worker that knows nothing yet."""
    n, meet = Counter(), rings.meet
    monkeypatch.setattr(R, "_known", [])
    monkeypatch.setattr(rings, "meet", lambda a, b: n.update(pairs=len(a.n)) or meet(a, b))
    return n


def batches(lots, rows=7):
    """[(a, b)] with a, b of (id, ring) -> Arrow batches as Spark gives them."""
    flat = [(k, right, i, ring) for k, lot in enumerate(lots) for right in (False, True) for i, ring in lot[right]]
    struct = [[{"x": float(x), "y": float(y)} for x, y in r[3]] for r in flat]
    own = lambda right: pa.array([r[2] if r[1] == right else None for r in flat], pa.int64())
    yes = pa.array([True] * len(flat))
    table = pa.table({"cell": [r[0] for r in flat], "right": [r[1] for r in flat], "aid": own(False), "bid": own(True), "low_x": yes, "low_y": yes, "ring": pa.array(struct, RING)})
    return [pa.RecordBatch.from_pylist([], table.schema), *table.to_batches(max_chunksize=rows)]


def met(lots, rows=7):
    return Counter((r["aid"], j) for b in R.meeting(batches(lots, rows), ["cell"], True) for r in b.to_pylist() for j in r["bids"])


def by_hand(lots):
    return Counter((i, j) for a, b in lots for i, p in a for j, q in b if meet_by_hand(p, q))


def test_equal_offsets_once(tested):
    """250,000 pairs of two forms on a grid of 10 by 10 places: no more tests than offsets, and the right pairs."""
    square, hook = [(0, 0), (2.5, 0), (2.5, 2.5), (0, 2.5)], [(0, 0), (3, 0), (3, 0.5), (0.5, 0.5), (0.5, 3)]
    rng = random.Random(6)
    place = lambda form: [(x + dx, y + dy) for x, y in [(rng.randrange(10) / 2, rng.randrange(10) / 2)] for dx, dy in form]
    a, b = [(k, place(square)) for k in range(500)], [(k, place(hook)) for k in range(500)]
    many = lambda rows: Counter(tuple(r) for _, r in rows).items()
    want = sum(meet_by_hand(p, q) * n * m for p, n in many(a) for q, m in many(b))
    assert met([(a, b)], 400).total() == want and 0 < tested["pairs"] <= 19 * 19
    before = tested["pairs"]
    assert met([(a, b)], 400).total() == want and tested["pairs"] == before


@pytest.mark.parametrize("step", [0.25, 0.1, 1 / 3, 2.0**-21, 3e7])
def test_lots_of_shapes(tested, monkeypatch, step):
    """Many small lots and large ones, on grids that halves reach and on others; the same whatever is kept."""
    rng = random.Random(7)
    moved = lambda n: [(k, [(4 * step * x, 4 * step * y) for x, y in ring]) for k, ring in shapes(rng, n, 12)]
    lots = [(moved(rng.choice([0, 1, 9])), moved(rng.choice([0, 1, 9]))) for _ in range(12)] + [(moved(70), moved(80)), (moved(3), [])]
    want = by_hand(lots)
    assert want and met(lots) == want
    for name, value in (("SMALL", 20), ("BOXES", 30), ("TESTS", 5), ("ROWS", 3), ("OFFSETS", 900), ("KEPT", 5000), ("FORMS", 4)):
        monkeypatch.setattr(R, name, value)
        monkeypatch.setattr(R, "_known", [])
        assert met(lots) == want and met(lots) == want


def test_odd_corners(tested):
    """Missing corners and such that are no numbers: only sides that are whole count."""
    nan, box = float("nan"), [(0, 0), (2, 0), (2, 2), (0, 2)]
    a, b = [(1, box), (2, [(nan, nan)]), (3, [(1, 1), (nan, 1), (5, 5), (1, 5)])], [(1, [(1, 1)]), (2, [(2, 2), (3, nan), (3, 3)]), (3, [(nan, 0)])]
    sides = lambda ring: rings.sides(pa.array([[{"x": float(x), "y": float(y)} for x, y in ring]], RING))
    want = Counter((i, j) for i, p in a for j, q in b if rings.meet(sides(p), sides(q))[0])
    assert want[1, 1] and want[1, 2] and met([(a, b)]) == want


def test_full_cell_in_lots(spark, monkeypatch):
    """Cells of more rows than a lot, ids of any type: all pairs once. 10,000,000 pairs of one place come out of 6,500 rows."""
    rng = random.Random(4)
    a, b = shapes(rng, 60, 12), shapes(rng, 70, 12)
    frame = lambda rows, name, kind: spark.createDataFrame([(kind(k), [(x / 8, y / 8) for x, y in r]) for k, r in rows], f"{name} {'string' if kind is str else 'struct<n:long>'}, ring array<struct<x:double,y:double>>")
    monkeypatch.setattr(P, "LOT", 9)
    for few in (50_000, 0):
        monkeypatch.setattr(G, "FEW", few)
        got = Counter((int(r.aid), r.bid.n) for r in P.polygons_meeting(frame(a, "aid", str), frame(b, "bid", lambda k: (k,)), 2.0).collect())
        assert got == Counter((i, j) for i, p in a for j, q in b if meet_by_hand(p, q))
    monkeypatch.setattr(P, "LOT", 1000)
    at = lambda x, y: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"))
    ring = F.array(at(0.5, 0.25), at(1.5, 0.25), at(0.5, 1.25))
    assert P.polygons_meeting(spark.range(4000).select(F.col("id").alias("aid"), ring.alias("ring")), spark.range(2500).select(F.col("id").alias("bid"), ring.alias("ring")), 2.0).count() == 10_000_000


def test_whole_multiples():
    """Coordinates whose products would be rounded are not told by form."""
    assert R._bits(np.array([0.25, -3.0])) == 2 and R._bits(np.array([0.0, 7.0])) == 0
    assert R._bits(np.array([0.1])) is None and R._bits(np.array([2.0**25])) is None and R._bits(np.array([2.0**6, 2.0**-20])) is None and R._bits(np.array([np.nan])) is None

"""Line dedup against brute force, with runs that many partitions share."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from skylattice.llm import lines

from .test_operators import SCHEMA, key, rows_of, sample

BLANK = " \t\n\x0b\x0c\r"
AZ = {b: b + 32 for b in range(65, 91)}


def by_hand(rows, least_documents=3):
    holders = defaultdict(set)
    split = [(i, (t or "").split("\n")) for i, t in rows]
    place = lambda i: lines.NO_ID if i is None else i
    key_of = lambda x: x.strip(BLANK).translate(AZ)
    for i, parts in split:
        for x in parts:
            holders[key_of(x)].add(place(i))
    out = []
    for i, parts in split:
        kept = [x for x in parts if not (len(key_of(x)) >= 20 and len(holders[key_of(x)]) >= least_documents and place(i) < max(holders[key_of(x)]))]
        out.append((i, len(parts), len(parts) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=key)


def lined():
    rng = random.Random(4)
    pool = [f"Line number {k} of the common ones" for k in range(30)] + ["  padded LINE that is long enough\t\r", "padded line THAT is long enough", "éàü" * 6 + "é", "éàü" * 7]
    pool += ["the hot line, in every document there is", "short", "", "x" * 20, "x" * 19, " " + "x" * 19]
    rows = [(i, "\n".join([pool[34]] * rng.randrange(1, 4) + rng.choices(pool, k=rng.randrange(0, 25)))) for i in range(400)]
    rows += [(7, rows[7][1]), (7, rows[9][1]), (None, rows[3][1]), (None, rows[4][1]), (900, None), (901, ""), (902, "\n\n"), (903, pool[34] + "\n" + pool[34]), (-5, "\n".join([pool[34]] * 3000))]
    rows += [(1000 + i, t) for i, t in enumerate(r[1] for r in sample())]
    return rows


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_lines(spark, parts):
    rows = lined()
    table = spark.createDataFrame([(i, t, "en", "a", 1, 1, "k", 2, "h", 3) for i, t in rows], SCHEMA)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kept = lines.line_dedup(table).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = Counter((i, sha) for i, _, _, sha in by_hand(rows))
    assert Counter((r.doc_id, hashlib.sha256(r.kept.encode()).hexdigest()) for r in kept) == want


def test_bitmaps_and_query(spark, tmp_path):
    rows = lined()
    table = spark.createDataFrame(rows, "doc_id long, text string")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    out = lines.op12_line_dedup(spark, str(tmp_path))
    assert rows_of(out.select("doc_id", "n_lines", "n_dropped", "kept_sha256")) == by_hand(rows)
    for r in lines.keep_bitmaps(table).collect():
        assert (~lines.unpacked(r.keep, r.n_lines)).sum() == r.n_dropped > 0
    gone = [0, 9, 10]
    assert np.flatnonzero(~lines.unpacked(lines.packed(11, gone), 11)).tolist() == gone
    assert lines.line_dedup(table.limit(0)).count() == 0


def test_stream_in_any_batches():
    """However a sorted partition is cut into batches, what it tells is what the whole run tells."""
    rng = np.random.default_rng(2)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        rows = sorted((int(a), int(b), -int(d), int(p)) for a, b, d, p in zip(rng.integers(0, 4, n), rng.integers(0, 2, n), rng.integers(0, 4, n), range(n), strict=True))
        columns = [np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array([-r[2] for r in rows]), np.zeros(n, "int64"), np.array([r[3] for r in rows], "int32"), np.ones(n, "int32")]
        stream, at = lines.Stream(3), 0
        while at < n:
            step = int(rng.integers(1, 9))
            stream.batch([c[at : at + step] for c in columns])
            at += step
        stream.close(at_end=True)
        marked = [(int(m[0][k]), *(int(m[j][k]) for j in (1, 2, 3, 5))) for m in stream.marks for k in range(len(m[0]))]
        runs = defaultdict(list)
        for a, b, d, p in rows:
            runs[a, b].append((-d, p))
        order = list(runs)
        dropped = {(a, b, d, p) for kind, a, b, d, p in marked if kind == lines.DROPPED}
        undecided = {(a, b, d, p) for kind, a, b, d, p in marked if kind == lines.OPEN}
        edges = defaultdict(set)
        for kind, a, b, d, _ in marked:
            if kind == lines.EDGE:
                edges[a, b].add(d)
        for k, members in runs.items():
            documents = {d for d, _ in members}
            gone = {(*k, d, p) for d, p in members if len(documents) >= 3 and d < max(documents)}
            got = {x for x in dropped if x[:2] == k}
            if k in (order[0], order[-1]):
                assert edges[k] <= documents and len(edges[k]) == min(3, len(documents))
                settled = {x for x in undecided if x[:2] == k and len(edges[k]) >= 3 and x[2] < max(edges[k])}
                assert got | settled == gone
            else:
                assert got == gone and not {x for x in undecided if x[:2] == k}

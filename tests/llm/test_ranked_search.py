"""Ranked search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np

from skylattice.llm import ranked_search as search

from .test_operators import SCHEMA, sample

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
AZ = {b: b + 32 for b in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(AZ))


def by_hand(docs, items, top=10):
    split = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(n > 0 for _, _, n in split), sum(n for _, _, n in split)
    df = Counter(t for _, c, _ in split for t in c)
    out = Counter()
    for item_id, text in items:
        found = []
        for i, c, n in split:
            m = 100 - 90 + (90 * n * n_docs) // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                found.append((-score, i is not None, i))
        for rank, (score, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1):
            out[item_id, rank, i, -score] += 1
    return out


def tables():
    rng = random.Random(6)
    pool = [f"t{k}" for k in range(300)] + ["Straße", "ÉTÉ", "été", "co", "op", "2024"]
    line = lambda n: rng.choice([" ", "-", ", "]).join(rng.choices(pool, weights=[1 / (k + 1) for k in range(len(pool))], k=n))
    docs = [(i, line(rng.randrange(0, 120))) for i in range(400)]
    docs += [(500 + k, docs[3][1]) for k in range(40)] + [(None, docs[3][1]), (None, docs[5][1]), (3, docs[3][1]), (600, None), (601, ""), (602, "., !"), (603, line(5000)), (604, "T1 " * 3000)]
    docs += [r[:2] for r in sample()]
    items = [(k, line(rng.randrange(1, 40))) for k in range(25)] + [(25, docs[3][1]), (26, None), (27, ""), (28, "nobody knows"), (28, "t1 T1 t2"), (None, "t5"), (29, "w1 w2 w3 éé")]
    return docs, items


def got(df):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def test_ranked_search(spark):
    docs, items = tables()
    table = spark.createDataFrame([(i, t, "en", "a", 1, 1, "k", 2, "h", 3) for i, t in docs], SCHEMA).repartition(5)
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, doc_id int, score int")
    want = by_hand(docs, items)
    assert got(search.ranked_search(table, asked)) == want
    assert got(search.ranked_search(table, asked, batch_items=7)) == want
    assert got(search.ranked_search(table, asked, top=3)) == by_hand(docs, items, 3)
    assert not got(search.ranked_search(table.limit(0), asked)) and not got(search.ranked_search(table, asked.limit(0)))


def test_query(spark, tmp_path):
    docs, items = tables()
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items[:20], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert got(search.op13_ranked_search(spark, str(tmp_path))) == by_hand(docs, items[:20])


def test_bounds_and_threshold():
    """A bound is never below the score, and few documents are scored."""
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 2**63, 3000).astype("uint64")
    weights = rng.integers(1, 20000, 3000)
    rows, scored = [], []
    for doc in range(1500):
        chosen = np.sort(rng.choice(3000, 80, replace=False))
        counts = rng.integers(1, 9, 80)
        order = np.argsort(hashes[chosen])
        t, c = hashes[chosen][order], counts[order]
        width = search.sketch_width(80)
        impacts = search.impact(c, int(c.sum()), 1500, 500000)
        drawn = search.sketch(t, impacts, width)
        for at in search.cells(t, width):
            assert np.all(drawn[at].astype("int64") * search.STEP >= impacts)
        rows.append((doc, int(c.sum()), width, t.tobytes(), c.astype("<i4").tobytes(), drawn.tobytes()))
    items = []
    for _ in range(10):
        chosen = rng.choice(3000, 30, replace=False)
        order = np.argsort(hashes[chosen])
        items.append(search.Item(hashes[chosen][order], weights[chosen][order]))
    s = search.Search(items, 1500, 500000)
    for k in range(0, 1500, 500):
        s.batch(*zip(*rows[k : k + 500], strict=True))
    for item, best in zip(items, s.best, strict=True):
        every = search.Search(items, 1500, 500000)
        scored = sorted(((every.score(item, np.frombuffer(r[3], "<u8"), np.frombuffer(r[4], "<i4"), r[1]), -r[0]) for r in rows), reverse=True)
        assert sorted(best, reverse=True) == scored[:10]
    assert s.scored < 1500 * 10 / 4

"""Phrase collocations against counting everything by hand."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from skylattice.llm import phrases

from .test_operators import SCHEMA, rows_of, sample

AZ = {b: b + 32 for b in range(65, 91)}


def counts_by_hand(rows, longest=3):
    counts = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(AZ)):
            ws = re.findall(r"[^ \t]+", piece)
            for m in range(1, longest + 1):
                counts.update(("und" if lang is None else lang, *ws[i : i + m]) for i in range(len(ws) - m + 1))
    return counts


def by_hand(rows, longest=3, least=10, top=2000, percent=50):
    f = counts_by_hand(rows, longest)
    totals = Counter()
    for p, a in f.items():
        if len(p) == 2:
            totals[p[0]] += a
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    inside = Counter()
    for p, a in candidates.items():
        for m in range(2, len(p) - 1):
            for i in range(1, len(p) - m + 1):
                q = (p[0], *p[i : i + m])
                inside[q] = max(inside[q], a)
    out = []
    for p, a in candidates.items():
        if 100 * inside[p] >= percent * a:
            continue
        cuts = [(f[p[: k + 1]], f[(p[0], *p[k + 1 :])]) for k in range(1, len(p) - 1)]
        score, _, l, r = min((1000000 * a * a // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
        out.append((p[0], -score, -a, " ".join(p[1:]).encode(), l, r))
    rank, done = Counter(), []
    for lang, score, a, phrase, l, r in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            done.append((lang, rank[lang], phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(done)


def texts():
    rng = random.Random(8)
    pool = [f"w{k}" for k in range(40)] + ["Über", "über", "The", "the", "co-op", "x\x00y", " "]
    rows = []
    for k in range(150):
        words = [rng.choice(pool[: 5 + k % 42]) for _ in range(rng.randrange(0, 90))]
        rows.append((rng.choice(["en", "en", "de", None, "", "und"]), "".join(w + rng.choice([" ", " ", " ", "\t", ", ", ".", "\n", "\r\n", "  "]) for w in words)))
    return rows + [("en", None), (None, None), ("xx", ""), ("yy", " .,\n"), ("en", "a a " * 40 + "a"), ("fr", "only once here")] + [("de", "New York City is")] * 12


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "a", 1, 1, "k", 2, "h", 3) for i, (lang, t) in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize(("longest", "shards", "slot_bits"), [(3, 3, 24), (3, 1, 6), (4, 2, 8), (1, 2, 12)])
def test_counts(spark, longest, shards, slot_bits):
    """Whatever the number of shards, and however many phrases share a slot."""
    rows = texts()
    got = phrases.count_phrases(frame(spark, rows), longest=longest, shards=shards, slot_bits=slot_bits)
    want = {(" ".join(p[1:]), p[0], len(p) - 1): a for p, a in counts_by_hand(rows, longest).items() if a >= 10}
    assert {(r.phrase, r.lang, r.words): r.a for r in got.phrases.collect()} == want
    totals = Counter()
    for p, a in counts_by_hand(rows, 1).items():
        totals[p[0]] += a
    assert {r.lang: r.n for r in got.totals.collect() if r.n} == dict(totals)
    assert got.scans >= shards


def test_collocations(spark):
    rows = texts() + [(lang, text) for _, text, lang, *_ in sample()]
    table = frame(spark, rows)
    assert rows_of(phrases.collocations(phrases.count_phrases(table, longest=4, shards=2), top=7)) == by_hand(rows, longest=4, top=7)
    assert phrases.collocations(phrases.count_phrases(table.limit(0), shards=1)).count() == 0


def test_query(spark, tmp_path):
    rows = texts()
    frame(spark, rows).select("doc_id", "text", "lang").write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(phrases.op11_phrases(spark, str(tmp_path))) == by_hand(rows)


def test_products_beyond_64_bits(spark):
    a, l, r = 9 * 10**9, 10**10, 9 * 10**9 + 1
    counted = phrases.Counted(
        spark.createDataFrame([("en", 2, "x y", a), ("en", 1, "x", l), ("en", 1, "y", r)], "lang string, words int, phrase string, a long"),
        spark.createDataFrame([("en", l + r)], "lang string, n long"),
        1,
    )
    assert rows_of(phrases.collocations(counted)) == [("en", 1, "x y", a, l, r, l + r, 1000000 * a * a // (l * r))]


def test_a_longer_phrase_starts_after_its_parts():
    """A phrase of two starts in the scan after both words have reached the threshold, not where one has not."""
    words = phrases.Reader().read(["en"], [b"a b. a c"]).keys
    slots = np.full(2**16, phrases.NEVER, "uint8")
    shift = np.uint64(48)
    slots[words[0] >> shift], slots[words[1] >> shift] = 1, 4
    length, at, keys, start = next(iter(phrases.phrases_of(words, slots, 2)))
    assert (length, at.tolist(), start.tolist(), len(keys)) == (2, [0], [5], 1)


def test_tokens_in_stretches(monkeypatch):
    """Words have one key wherever a stretch ends; texts, languages and lengths are told apart."""
    rng = random.Random(2)
    texts = [" ".join("abcé"[: rng.randrange(1, 5)] * rng.randrange(1, 30) for _ in range(rng.randrange(0, 60))) + rng.choice(["", " ", ".", "\n"]) for _ in range(30)] + ["x" * 5000 + " y", None, "", " . "]
    langs = [rng.choice(["en", "de", None]) for _ in texts]
    data = [None if t is None else t.encode() for t in texts]
    want = phrases.Reader().read(langs, data)
    for stretch in (1, 7, 100, 4000):
        monkeypatch.setattr(phrases, "STRETCH", stretch)
        got = phrases.Reader().read(langs, data)
        assert got.keys.tolist() == want.keys.tolist() and got.of.tolist() == want.of.tolist() and got.starts.tolist() == want.starts.tolist()
    seen = {}
    for k in np.flatnonzero(want.keys).tolist():
        word = langs[want.of[k]], want.text(k, 1)
        assert seen.setdefault(int(want.keys[k]), word) == word
    assert len(seen) == len(set(seen.values())) and want.text(0, 1) == texts[0].split()[0]

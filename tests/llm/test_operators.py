"""The operators on small tables with every awkward case, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skylattice.llm import bwt, fingerprints, licenses, mixing, ngram_join, packing, quality_model, quality_rules, repeats, token_counts, tokenfiles, toxicity
from skylattice.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, key string, size int, hits string, rid int"


def words(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def sample():
    rng = random.Random(3)
    base, passage = words(rng, 300), words(rng, 120)
    texts = [base, base, base.replace("w1", "x1", 2), base + " end", None, "", " \n\t", "one two", "One TWO", "a b c d", words(rng, 9000), "é" * 50 + " ñ"]
    texts += [words(rng, 200) + " " + passage + " " + words(rng, 150) for _ in range(4)]
    texts += [words(rng, rng.randrange(1, 400)) for _ in range(25)]
    edited = base.split()
    for k in range(12):
        copy = list(edited)
        for j in range(8):
            copy[rng.randrange(300)] = f"z{k}{j}"
        texts.append(" ".join(copy))
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[10]), (None, None)]
    sources = ["a", "b", None, "c"]
    return [(i, t, "en", sources[k % 4], len(t or ""), 1, "k", 2, "h", 3) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(sample(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 4 > 0), int(i % 5 == 0)) for i in range(30)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


def key(row):
    return tuple((x is None, x) for x in row)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


def counts_by_hand(text):
    ws = WORD.findall(text or "")
    windows = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    cover = {j for i in range(len(ws) - 7) if windows[tuple(ws[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(ws), sum(map(len, ws)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab \n#é\t", max_size=120))
def test_quality_counts(text):
    assert quality_rules.text_counts(text)[:5] == counts_by_hand(text)


def test_quality_rules(spark, docs, empty, labels):
    out = quality_rules.quality_rules(docs, labels)
    got = rows_of(out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    assert got == sorted(((r[0], *counts_by_hand(r[1])) for r in sample()), key=key)
    for r in out.collect():
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.base_failed and r.kept)
    assert quality_rules.quality_rules(empty, labels).count() == 0
    assert quality_rules.quality_rules(docs, labels.limit(0)).where("kept <> (not base_failed)").count() == 0
    kept = quality_rules.passing(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(key((r.doc_id,)) for r in kept.collect()) == sorted(key((r.doc_id,)) for r in out.where("kept").collect())


def test_rules_find_a_conjunction():
    rng = np.random.default_rng(1)
    x = {"a": rng.random(3000), "b": rng.random(3000)}
    y = (x["a"] > 0.7) & (x["b"] <= 0.4)
    rules = quality_rules.learn_rules(x, y)
    hit = np.any([r.holds(x) for r in rules], axis=0)
    assert (hit == y).mean() > 0.98 and quality_rules.learn_rules(x, np.zeros(3000, bool)) == []


def test_rules_are_one_ordered_expression(spark):
    d, l = learnable(spark)
    out = quality_rules.quality_rules(d, l)
    names = list(quality_rules.measures())
    rows = quality_rules.text_stats(d).withColumns(quality_rules.measures()).join(l.where("quality is not null"), "doc_id").orderBy("doc_id", "quality").toPandas()
    rows = rows[(rows.n_words >= 20) & (100 * rows.n_repeat_words <= 30 * rows.n_words)]
    rules = quality_rules.learn_rules({n: rows[n].to_numpy("float64") for n in names}, (rows["quality"] == 0).to_numpy())
    assert rules
    want = {}
    for _, r in rows.iterrows():
        hit = [k for k, rule in enumerate(rules, 1) if all(r[n] <= at if op == "<=" else r[n] > at for n, op, at in rule.conditions)]
        want[int(r.doc_id)] = hit[0] if hit else 0
    got = {r.doc_id: (r.rule, r.kept) for r in out.where("not base_failed").collect()}
    assert {k: v[0] for k, v in got.items()} == want and all(v[1] == (v[0] == 0) for v in got.values())


def removed_by_hand(rows, length=400):
    seen = Counter()
    data = [(t or "").encode() for _, t in rows]
    for d in data:
        seen.update(d[i : i + length] for i in range(len(d) - length + 1))
    out = []
    for (i, _), d in zip(rows, data, strict=True):
        gone = np.zeros(len(d), bool)
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                gone[k : k + length] = True
        runs = int(np.count_nonzero(np.diff(gone.astype(int), prepend=0) == 1))
        out.append((i, len(d), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(d, "uint8")[~gone].tobytes()).hexdigest()))
    return sorted(out, key=key)


def test_suffix_dedup(spark, docs, empty):
    from pyspark.sql import functions as F

    digest = lambda d: rows_of(d.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)))
    small = [r[:2] for r in sample()]
    assert digest(repeats.remove_repeats(docs)) == removed_by_hand(small)
    assert repeats.remove_repeats(empty).count() == 0
    runs = [(1, "ab" * 900), (2, "a" * 1000), (3, "x" + "ab" * 230), (4, "q" * 399), (5, "q" * 399)]
    assert digest(repeats.remove_repeats(spark.createDataFrame(runs, "doc_id long, text string"))) == removed_by_hand(runs)
    cut = repeats.without_repeats(docs)
    assert cut.columns == docs.columns and cut.where("text is not null and n_chars <> char_length(text)").count() == 0


def test_suffix_dedup_tells_of_shorter_passages(spark):
    rng = random.Random(21)
    passage = words(rng, 60)[:330]
    line = words(rng, 20)[:120]
    texts = [f"{words(rng, 80)} {passage} {words(rng, 30)}" for _ in range(3)] + [f"{words(rng, 70)} {line} {words(rng, 60)}" for _ in range(3)]
    texts += [words(rng, 90), f"{line} {words(rng, 30)} {line}", None, words(rng, 10)]
    for texts_ in (texts, [*texts, texts[6]]):
        rows = [(i, t) for i, t in enumerate(texts_)]
        got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        copies = {6, len(texts)} if len(texts_) > len(texts) else set()
        assert {r.doc_id for r in got if r.n_shared_windows > 0} == {0, 1, 2} | copies
        assert {r.doc_id for r in got if r.n_removed > 0} == copies


def test_suffix_dedup_of_a_crowded_core(spark, monkeypatch):
    rng = random.Random(8)
    passage = words(rng, 90)[:420]
    texts = [words(rng, 40) + f" {i} " + passage[: 385 + i % 36] + f" {i * 7} " + words(rng, 40) for i in range(90)]
    rows = [(i, t) for i, t in enumerate([*texts, *texts[:5], words(rng, 200), None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole, one_by_one, crowded = repeats._repeated_windows, repeats._windows_one_by_one, []
    most = 12

    def few(strings, *rest):
        assert strings.groupBy("core").count().where(f"count > {most}").count() == 0
        return whole(strings, *rest)

    def many(strings):
        crowded.append(strings.groupBy("core").count().where(f"count > {most}").count())
        return one_by_one(strings)

    monkeypatch.setattr(repeats, "_repeated_windows", few)
    monkeypatch.setattr(repeats, "_windows_one_by_one", many)
    for cores in (1_000_000, 0):
        out = repeats.remove_repeats(docs, most_strings=most, broadcast_cores=cores)
        kept = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in out.collect()]
        assert sorted(kept, key=key) == removed_by_hand(rows)
    assert len(crowded) == 2 and min(crowded) > 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=5, max_size=12), min_size=1, max_size=12), st.integers(6, 60))
def test_bwt_merge_finds_repeats(strings, shard):
    depth = 5
    got = bwt.repeated([np.array(s, "uint16") for s in strings], np.ones(len(strings)), depth, shard)
    seen = Counter(tuple(s[i : i + depth]) for s in strings for i in range(len(s) - depth + 1))
    assert [g.tolist() for g in got] == [[seen[tuple(s[i : i + depth])] > 1 for i in range(len(s) - depth + 1)] for s in strings]


def joined_by_hand(rows, n=4, percent=85):
    def shingles(t):
        ws = [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").translate({k: k + 32 for k in range(65, 91)})) if w]
        return {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} if len(ws) >= n else {tuple(ws)} if ws else set()

    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, len(sets[k]), least.get(root(k), i)) for k, (i, _) in enumerate(rows)), key=key)


@pytest.mark.parametrize("options", [{}, {"few": 2, "tries": 1, "kept": 2, "broadcast_rows": 0}])
def test_ngram_join(spark, docs, empty, options):
    assert rows_of(ngram_join.ngram_join(docs, **options)) == joined_by_hand([r[:2] for r in sample()])
    if not options:
        assert ngram_join.ngram_join(empty).count() == 0
        kept = ngram_join.one_of_each(docs)
        assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {0, 4, 5}


def _bridge():
    """Two texts that only the one between links, by 4-word shingles at 85 %."""
    base = words(random.Random(6), 200, 10**6).split()
    return " ".join([f"a{k}" for k in range(10)] + base[10:]), " ".join(base), " ".join(base[:-10] + [f"b{k}" for k in range(10)])


def test_ngram_join_through_a_null_id(spark):
    a, base, b = _bridge()
    rows = [(1, a), (None, base), (2, b), (3, words(random.Random(7), 90))]
    got = rows_of(ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "component_id"))
    assert got == sorted([(1, 1), (None, 1), (2, 1), (3, 3)], key=key)


def test_one_of_each_decides_by_row(spark):
    a, base, b = _bridge()
    other, clean, lone = (words(random.Random(s), 90) for s in (11, 12, 13))
    rows = [(1, a), (None, base), (2, b), (2, clean), (4, other), (4, other + " end"), (None, lone), (None, lone + " end"), (5, ""), (5, "")]
    got = ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.text for r in got if r.doc_id in (1, 2)), key=str) == sorted([a, clean])
    assert sum(r.doc_id == 4 for r in got) == 1 and sum(r.doc_id is None for r in got) == 1


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 30)] + [(100, 101), (101, 100), (5, 5), (200, 150), (200, 151)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(31), 0), 100: 100, 101: 100, 200: 150, 150: 150, 151: 150}


def test_token_counts_follow_the_tokenizer():
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    pieces = [("▁", -3.0), ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("▁a", -5.0), ("ba", -3.5), ("aba", -6.0), ("▁ab", -7.0), (",", -1.0), ("é", -1.5)]
    t = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], unk_id=0, byte_fallback=False))
    t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(r"[\x20\x09-\x0D]+"), "removed"), pre_tokenizers.Metaspace(prepend_scheme="always", split=False)])
    counter = token_counts.Counter(pieces, byte_pieces=False)
    rng = random.Random(5)
    for _ in range(600):
        text = "".join(rng.choice("aabb,é q漢") for _ in range(rng.randrange(0, 25)))
        assert counter.text(text)[0] == len(t.encode(text).ids), text
    assert counter.text(None) == (0, 0.0, 0)


def test_token_counts_query(docs, empty):
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    out = token_counts.token_counts(docs, model)
    assert out.count() == docs.count() and out.where("n_words = 0 and n_tokens <> 0").count() == 0
    assert token_counts.token_counts(empty, model).count() == 0


def test_fingerprints(spark, docs, empty):
    from pyspark.sql import functions as F

    rows = sorted([r[:2] for r in sample()], key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""), reverse=True)
    for size in (3, 2000):
        pairs = fingerprints.with_next(docs, [F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text")], range_rows=size)
        got = Counter((r.own.doc_id, r.own.text, r.next.doc_id, r.next.text) for r in pairs.collect())
        assert got == Counter((a[0], a[1] or "", b[0], b[1] or "") for a, b in zip(rows, rows[1:] + rows[:1], strict=True))
    assert fingerprints.with_next(empty, [F.col("doc_id"), F.col("text")]).count() == 0
    ws = [f"w{k}" for k in range(100)]
    part = lambda a, b: " ".join(ws[a:b])
    df = spark.createDataFrame([(part(0, 60), part(20, 80), part(0, 80), part(56, 80)), ("", None, "", "")], "a string, b string, c string, d string")
    sk = df.select(*[fingerprints.sketch(F.col(c)).alias(c) for c in "abcd"])
    r = sk.select(
        fingerprints.resemblance(F.col("a"), F.col("b")).alias("j"), fingerprints.containment(F.col("a"), F.col("c")).alias("c"), fingerprints.distinct_shingles(F.col("a")).alias("n"),
        (fingerprints.merged(F.col("a"), F.col("d")) == F.col("c")).alias("m"),
    ).collect()
    assert r[0].j == pytest.approx(36 / 76) and r[0].c == pytest.approx(1) and r[0].n == 56 and r[0].m and r[1].j == 1.0 and r[1].n == 0
    long = spark.createDataFrame([(1, " ".join(f"u{k}" for k in range(5000))), (1, " ".join(f"u{k}" for k in range(2500, 7500)))], "k int, t string")
    both = fingerprints.merge_rows(long.select("k", fingerprints.sketch(F.col("t")).alias("s")), "k", "s")
    assert abs(both.select(fingerprints.distinct_shingles(F.col("sketch"))).first()[0] / 7492 - 1) < 0.3


def test_license_scan(docs, empty):
    s = licenses.Scanner(licenses.TEMPLATES)
    assert s.text("x\nReleased under the MIT License.\ny")[3] == "MIT"
    assert s.text("Licensed under the Apache License, version 2.0")[3] == "Apache-2.0"
    assert s.text("words " * 5000 + "This work is licensed under the GNU General Public License, version 3.")[3] == "GPL-3.0"
    assert s.text("he has a license to fish here")[1] == 0 and s.text(None) == (0, 0, None, None, None, None)
    assert licenses.license_scan(docs).count() == docs.count() and licenses.license_scan(empty).count() == 0


@pytest.mark.parametrize("width", [40, 60, 80])
def test_license_scan_of_wrapped_notices(width):
    import textwrap

    s = licenses.Scanner(licenses.TEMPLATES)
    rng = random.Random(width)
    for name, template in licenses.TEMPLATES.items():
        for before in (0, 3, 200):
            text = f"{words(rng, before)} {template} {words(rng, before)}"
            for mark in ("", "# ", " * "):
                wrapped = "\n".join(mark + x for x in textwrap.wrap(text, width, break_long_words=False, break_on_hyphens=False))
                assert s.text(wrapped)[3] == name, (name, before, mark)


def test_license_scan_returns_every_notice():
    s = licenses.Scanner(licenses.TEMPLATES)
    two = s.text("Released under the MIT License.\nLicensed under the Apache License, Version 2.0.")
    assert two[1:3] == (2, "Apache-2.0,MIT")
    rng = random.Random(4)
    names = list(licenses.TEMPLATES)
    for k in range(40):
        chosen = rng.sample(names, len(names) if k == 0 else rng.randrange(1, 9))
        got = s.text(f"\n{words(rng, rng.choice([0, 2, 30]))}\n".join(licenses.TEMPLATES[n] for n in chosen))
        assert got[1:3] == (len(chosen), ",".join(sorted(chosen))), chosen
    again = s.text(("Released under the MIT License. " + words(rng, 100) + "\n") * 6)
    assert again[1:3] == (6, "MIT")


def test_license_templates_of_ones_own(spark):
    """Templates without any of the usual words bring cues of their own, whichever words a notice lacks."""
    own = {"house": "Copying this document elsewhere needs written consent from the archive in Ghent, Belgium", "short": "Keep inside", "MIT": licenses.TEMPLATES["MIT"]}
    s = licenses.Scanner(own)
    rng = random.Random(8)
    body = own["house"].split()
    for k in range(30):
        lost = rng.sample(range(len(body)), 2)
        kept = [w for i, w in enumerate(body) if i not in lost]
        assert s.text(f"{words(rng, 200)}\n{' '.join(kept)}\n{words(rng, k)}")[1:4] == (1, "house", "house"), kept
    assert s.text("x y Keep inside. z")[3] == "short" and s.text("Keep outside")[1] == 0
    got = licenses.license_scan(spark.createDataFrame([(1, own["house"]), (2, "nothing")], "doc_id long, text string"), own).orderBy("doc_id").collect()
    assert [r.license for r in got] == ["house", None]


def test_license_templates_are_ranked():
    s = licenses.Scanner(licenses.TEMPLATES)
    for k, (name, template) in enumerate(licenses.TEMPLATES.items()):
        saved = [len(c.compress(template.encode())) for _, _, c in s.known]
        assert s.ranked(template) == sorted(range(len(saved)), key=lambda i: (saved[i], i)) and saved[k] == min(saved), name


def _common(a, b):
    """Longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b, 1):
            last, row[k] = row[k], last + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abcde"), min_size=1, max_size=7), st.lists(st.sampled_from("abcdex"), max_size=14), st.sampled_from([0.2, 0.35, 0.6]))
def test_license_matches_are_the_best_alignments(template, block, most):
    got = {end: (begin, n) for begin, end, n in licenses.Scanner({}, most_differences=most).matches(template, block)}
    cost = lambda b, e: len(template) + e - b - 2 * _common(template, block[b:e])
    for end in range(1, len(block) + 1):
        least = min(cost(b, end) for b in range(end + 1))
        if least <= most * len(template) and end in got:
            begin, n = got[end]
            assert n == least == cost(begin, end)
        elif end in got:
            raise AssertionError((end, got[end], least))
        elif least <= most * len(template):
            assert cost(end, end) == least  # only the empty stretch does it


def _auc(y, z):
    r = np.argsort(np.argsort(z)) + 1
    return (r[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())


def learnable(spark):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(500):
        bad, low = i % 6 == 0, i % 7 == 0
        text = words(rng, 80, 300)
        if bad:
            text += " foul" + rng.choice("xyz") + " nasty foul" + rng.choice("uvw")
        if low:
            text = text.upper() + " !!! ###"
        rows.append((i, text))
        labels.append((i, int(not low), int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifiers(spark, docs, empty, labels):
    d, l = learnable(spark)
    for f, label, fold in ((toxicity.toxicity, "toxic", (5, 0)), (quality_model.quality_scores, "quality", (3, 1))):
        rows = f(d, l).join(l, "doc_id").where("held_out").collect()
        assert all(zlib.crc32(str(r.doc_id).encode()) % fold[0] == fold[1] for r in rows)
        assert _auc(np.array([r[label] == 1 for r in rows]), np.array([r.score for r in rows])) > 0.95
        assert f(empty, labels).count() == 0
        for out in (f(docs, labels), f(docs, labels.limit(0))):
            assert out.count() == docs.count() and out.where("score is null or score < 0 or score > 1 or predicted <> cast(score >= 0.5 as int)").count() == 0


def test_machine_scores_are_sums_over_all_pairs():
    rng = np.random.default_rng(3)
    found = [sorted(rng.choice(40, rng.integers(0, 9), replace=False).tolist()) for _ in range(80)]
    dense = rng.normal(size=(80, 3))
    dense[4, 1] = np.nan
    y = rng.integers(0, 2, 80).astype("float64")
    m = quality_model.fit_machine(found, dense, y, epochs=2, batch=16, support=2)
    for f, d in zip(found, m.dense(dense), strict=True):
        x = {m.place[k]: 1 / max(1, len(f)) ** 0.5 for k in f if k in m.place} | {len(m.place) + i: v for i, v in enumerate(d)}
        z = m.bias + sum(m.w[i] * v for i, v in x.items()) + sum(m.v[i] @ m.v[j] * x[i] * x[j] for i in x for j in x if i < j)
        assert m.one(f, d) == pytest.approx(1 / (1 + np.exp(-z)))


def test_quality_model_learns_a_pair():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 2, 2000), rng.integers(0, 2, 2000)
    found = [[k for k, on in ((1, p), (2, q), (3, True)) if on] for p, q in zip(a, b, strict=True)]
    y = (a ^ b).astype("float64")  # no sum of single features tells it
    m = quality_model.fit_machine(found, np.zeros((2000, 1)), y, epochs=60, rate=0.05)
    assert np.mean([(m.one(f, np.zeros(1)) >= 0.5) == t for f, t in zip(found, y, strict=True)]) > 0.95


def test_nnpu_gradient_follows_the_risk():
    """One plain step: the weights move against the gradient of the risk, or of what is below zero in it."""
    rng = np.random.default_rng(8)
    toxic, rest = ([sorted(rng.choice(12, 4, replace=False).tolist()) for _ in range(k)] for k in (6, 15))
    prior, n = 0.3, 12

    def risk(w, bias):
        z = lambda rows: np.array([sum(w[k] for k in r) + bias for r in rows])
        plus = prior * np.logaddexp(0, -z(toxic)).mean()
        minus = np.logaddexp(0, z(rest)).mean() - prior * np.logaddexp(0, z(toxic)).mean()
        return (plus + minus if minus >= 0 else -minus), minus

    start = np.log(prior / (1 - prior))
    one, bias = toxicity.fit_nnpu(toxic, rest, prior, steps=1, decay=0.0, support=1)
    for k in range(n):
        up, down = np.zeros(n), np.zeros(n)
        up[k], down[k] = 1e-5, -1e-5
        slope = (risk(up, start)[0] - risk(down, start)[0]) / 2e-5
        assert abs(slope) < 1e-9 or np.sign(one.get(k, 0.0)) == -np.sign(slope)
    # However long it is fitted, the unlabelled risk does not run below zero for good.
    weights, bias = toxicity.fit_nnpu(toxic, rest, prior, steps=400, decay=0.0, support=1)
    assert risk(np.array([weights.get(k, 0.0) for k in range(n)]), bias)[1] > -0.1


def test_mixing(spark, docs, empty):
    out = mixing.mix(docs, block_words=16, shard_slots=64, bucket_rows=7)
    got = out.documents.collect()
    hand = Counter((r[0], len(WORD.findall(r[1] or "")), r[3]) for r in sample())
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter({(a, b): 0 for a, b, _ in hand} | Counter({k: v for k, v in Counter((a, b) for (a, b, _), n in hand.items() for _ in range(n)).items()}))
    sizes = Counter()
    for (_, size, source), n in hand.items():
        sizes[source] += size * n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, full = dict.fromkeys(order, 0.0), set()
    while True:  # share by weight, cut at twice the size, share the excess again
        left = 1.5 * sum(sizes.values()) - sum(2.0 * sizes[s] for s in full)
        each = left / sum(weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and each * weight[s] > 2.0 * sizes[s] + 1e-9}
        target = {s: 2.0 * sizes[s] if s in full else each * weight[s] for s in order}
        if not over:
            break
        full |= over
    taken, targets = Counter(), {}
    for r in got:
        assert r.taken <= 2 * r["size"]
        taken[r.source_size] += r.taken
        targets[r.source_size] = r.target
    for s in order:
        assert targets[sizes[s]] == pytest.approx(target[s]) and abs(taken[sizes[s]] - target[s]) <= 40
    assert rows_of(mixing.mix(docs, block_words=16, shard_slots=64, bucket_rows=7).documents) == sorted((tuple(r) for r in got), key=key)
    assert out.slots.groupBy("shard").count().where("count > 64").count() == 0
    mixed = mixing.mixed_texts(docs, block_words=16)
    assert mixed.columns == docs.columns
    assert sum(len(WORD.findall(r.text)) for r in mixed.collect()) == mixing.mix(docs, block_words=16).documents.agg({"taken": "sum"}).first()[0]
    assert mixing.mix(empty).documents.count() == 0 and mixing.mixed_texts(empty).count() == 0


def test_mixed_texts_of_rows_with_one_id(spark):
    """Rows that share doc_id and word count in several sources, some of them never taken: each source's words are its own."""
    text = lambda mark, n, k=0: " ".join(f"{mark}{k}x{i}" for i in range(n))
    rows = [(1, text("a", 200), "a"), (1, text("b", 200), "b"), (None, text("a", 50, 1), "a"), (None, text("b", 50, 1), "b")]
    rows += [(2, text("c", 40), "c")] * 3 + [(2, text("c", 40), "d")] + [(5, text("d", 40, k), "d") for k in range(6)]
    table = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    for seed in (1, 2, 3):
        mix = mixing.mix(table, block_words=16, seed=seed, row=all_columns_hash(table))
        want = Counter()
        for r in mix.pieces.join(mix.slots.select("sid", "source").distinct(), "sid").collect():
            want[r.source] += r.times * (r.to_word - r.from_word)
        got = Counter()
        for r in mixing.mixed_texts(table, block_words=16, seed=seed).collect():
            n = len(WORD.findall(r.text))
            got[r.source] += n
            assert any(r.text in t for i, t, s in rows if (i, s) == (r.doc_id, r.source))
        assert got == +want


def all_columns_hash(table):
    from pyspark.sql import functions as F

    return F.xxhash64(*table.columns)


def test_permutation(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 7, 100):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5)).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))


def test_packing(spark, docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    odd = ["J̌ x <|endoftext|> <|ENDOFTEXT|>a it's I'LL, don't. foo,'s é é x\x1cy İ ΑΣ 12.5% 漢字,です。", "", "a\x85b", "x" * 3000, "Été, ÀÉÎ. ß, ñ,. Ünï...\n", "a.b, c.,d ,e 'll. re's,"]
    texts = odd + [r[1] or "" for r in sample()]
    ids = [np.frombuffer(b, "<u4").tolist() for b in tokenfiles.WordIds(path).ids_bytes(texts)]
    assert ids == [t.encode(x, add_special_tokens=False).ids for x in texts]
    got = packing.pack_documents(docs, path).collect()
    want = Counter()
    for doc, text, *_ in sample():
        x = t.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(x), 2048):
            part = np.array(x[k : k + 2048], "<u4")
            want[(doc, k // 2048, k, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048
    least = max(sum(r.length for r in got) / 2048, sum(r.length > 1024 for r in got))
    assert len(bins) <= least + 2 and packing.pack_documents(empty, path).count() == 0


@pytest.mark.parametrize(("histogram", "least"), [({1: 5000}, 3), ({2: 3000}, 3), ({2000: 3, 1: 4000}, 5), ({3: 5000}, 8), ({2048: 2, 1: 1}, 3), ({7: 4000, 5: 4000, 1: 3}, 24)])
def test_packing_of_very_many_short_pieces(histogram, least):
    patterns = packing.pack_histogram(histogram)
    total = Counter()
    for p, n in patterns:
        total.update({k: v * n for k, v in Counter(p).items()})
    assert total == Counter(histogram) and all(sum(p) <= 2048 for p, _ in patterns) and sum(n for _, n in patterns) == least


def test_packing_of_empty_texts(spark):
    rows = [(i, None if i % 2 else "") for i in range(5000)] + [(5000, "one two three")]
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string")).groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert len(got) == 3 and max(r[1] for r in got) <= 2048


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=9))
def test_pack_histogram_is_near_the_best(lengths):
    patterns = packing.pack_histogram(Counter(lengths), 12)
    assert Counter(x for p, n in patterns for x in p for _ in range(n)) == Counter(lengths) and all(sum(p) <= 12 for p, _ in patterns)

    def best(items, bins, limit):
        if not items:
            return len(bins)
        if len(bins) >= limit:
            return limit
        out = limit
        for k in {b: i for i, b in enumerate(bins)}.values():
            if bins[k] + items[0] <= 12:
                out = min(out, best(items[1:], bins[:k] + [bins[k] + items[0]] + bins[k + 1 :], out))
        return min(out, best(items[1:], [*bins, items[0]], out))

    assert sum(n for _, n in patterns) <= best(sorted(lengths, reverse=True), [], len(lengths) + 1) + 1

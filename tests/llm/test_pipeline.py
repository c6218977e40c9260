"""The pipeline on a small table, stage by stage against brute force, and its queries by name."""

import hashlib
import re
from collections import Counter

import pytest

import corpus_pipeline
from skylattice.llm import quality_rules, queries, repeats
from skylattice.llm.shared import written

from .test_operators import SCHEMA, WORD, joined_by_hand, removed_by_hand, sample


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([r[:5] for r in sample() if r[0] is not None], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = [r for r in docs.collect() if (c := quality_rules.text_counts(r.text))[0] >= 20 and 100 * c[4] <= 30 * c[0]]
    stages = dict(corpus_pipeline.STAGES)
    first = written(stages["quality rules"](spark, docs, folder))
    assert Counter((r.doc_id, r.text) for r in first.collect()) == Counter((r.doc_id, r.text) for r in kept)
    second = written(stages["n-gram Jaccard join"](spark, first, folder))
    groups = joined_by_hand([(r.doc_id, r.text) for r in kept], 5, 80)
    assert sorted(r.doc_id for r in second.collect()) == sorted({c for _, _, c in groups})
    third = written(stages["suffix-array dedup"](spark, second, folder))
    removed = {i: n for i, _, n, _, _ in removed_by_hand([(r.doc_id, r.text) for r in second.collect()], repeats.PASSAGE)}
    before = {r.doc_id: r.text for r in second.collect()}
    for r in third.collect():
        assert len(r.text.encode()) == len(before[r.doc_id].encode()) - removed[r.doc_id] and r.n_chars == len(r.text)
    fourth = written(stages["mixing sources to target weights"](spark, third, folder))
    assert first.columns == second.columns == third.columns == fourth.columns == columns
    whole = {r.doc_id: r.text for r in third.collect()}
    taken = Counter()
    for r in fourth.collect():
        assert r.text in whole[r.doc_id] and r.n_chars == len(r.text)
        taken[r.doc_id] += len(WORD.findall(r.text))
    assert all(n <= 2 * len(WORD.findall(whole[i])) for i, n in taken.items())
    last = stages["best-fit packing"](spark, fourth, folder)
    assert last.where("piece = 0").count() == fourth.count() and last.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0
    assert corpus_pipeline.run(spark, folder).count() == last.count()


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op11_phrases", "op13_ranked_search"}))
def test_queries_give_every_document(spark, folder, name):
    docs = Counter(r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    out = queries.QUERIES[name](spark, folder)
    got = Counter(r.doc_id for r in (out.where("piece = 0") if name == "op10_pack" else out).select("doc_id").collect())
    assert got == docs


def test_fingerprint_query_by_hand(spark, folder):
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect()), reverse=True)

    def shingles(text):
        ws = WORD.findall(text)
        return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()

    want = []
    for (i, text), (_, following) in zip(docs, docs[1:] + docs[:1], strict=True):
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        a, b, c = shingles(text), shingles(edited), shingles(following)
        near = [len(a & x) / len(a | x) if a | x else 1.0 for x in (b, c)]
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), *near, max(len(a | b), len(a | c))))
    got = sorted((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in queries.QUERIES["op5_fingerprints"](spark, folder).collect())
    for g, w in zip(got, sorted(want), strict=True):
        assert g[:3] == w[:3] and g[3:] == pytest.approx(w[3:5], abs=1e-9 if w[5] <= 128 else 0.25)


def test_names():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14)) and SCHEMA

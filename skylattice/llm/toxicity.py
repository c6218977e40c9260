"""Toxicity scores by non-negative positive-unlabelled learning.

A linear classifier over hashed words and beginnings of words is fitted with numpy from confirmed toxic texts and a sample of unlabelled ones.
Its risk is pi * R(toxic, +) + max(0, R(unlabelled, -) - pi * R(toxic, -)), where pi is the share of toxic texts: what
toxic texts add to the unlabelled risk is taken off, and when that estimate turns negative, which is overfitting, its
gradient is reversed. The loss is logistic, so the score estimates the probability of label 1.

Labels that are not toxic serve for one number only, pi. Fitting takes at most `positives` and `unlabelled` rows (a
documented bound); scoring takes every row. Defined results: a null or empty text has no words and gets the score of the
bias alone; without toxic labels every score is 0; rows that repeat are scored each; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_batch, held_out, label_sample, read_table, written
from .wordhash import CACHE_WORDS, WordHash

FEATURES = 1 << 20
FOLD = (5, 0)


def _sparse(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, rows), "int64", len(rows))
    flat = np.fromiter((k for r in rows for k in r), "int64", int(sizes.sum()))
    return np.repeat(np.arange(len(rows)), sizes), flat


def fit_nnpu(toxic: list[list[int]], unlabelled: list[list[int]], prior: float, *, steps: int = 300, rate: float = 0.1, decay: float = 2e-4, beta: float = 0.0, support: int = 3) -> tuple[dict[int, float], float]:
    """({feature: weight}, bias) by full-batch Adam. Features that fewer than `support` texts hold get no weight. The
    estimate of the unlabelled risk may fall to -beta before its gradient is reversed; 0 is the non-negative estimator."""
    row, flat = _sparse(toxic + unlabelled)
    names, column, held = np.unique(flat, return_inverse=True, return_counts=True)
    ok = held[column] >= support
    row, flat = row[ok], flat[ok]
    names, column = np.unique(flat, return_inverse=True)
    n, n_toxic = len(toxic) + len(unlabelled), len(toxic)
    is_toxic = np.arange(n) < n_toxic
    w = np.zeros(len(names) + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        z = np.bincount(row, w[column], n) + w[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        minus = np.logaddexp(0, z)  # loss of calling a text clean
        negative = minus[~is_toxic].mean() - prior * minus[is_toxic].mean()
        g = np.zeros(n)
        if negative >= -beta:
            g[is_toxic] = (prior * (p[is_toxic] - 1) - prior * p[is_toxic]) / n_toxic
            g[~is_toxic] = p[~is_toxic] / len(unlabelled)
        else:
            g[is_toxic] = prior * p[is_toxic] / n_toxic
            g[~is_toxic] = -p[~is_toxic] / len(unlabelled)
        grad = np.append(np.bincount(column, g[row], len(names)), g.sum())
        grad[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return {int(k): float(x) for k, x in zip(names, w[:-1], strict=True) if abs(x) > 1e-6}, float(w[-1])


class Marks:
    """features(text): numbers for what a text holds once, twice or four times: words, and beginnings of words (three to
    seven characters), which catch a stem in all its forms. `keep`: only these numbers are given."""

    def __init__(self, keep: set[int] | None = None):
        self.keep, self.hashed = keep, WordHash(FEATURES)
        self.cache: dict[bytes, list[int]] = {}

    def numbers(self, word: bytes) -> list[int]:
        got = self.cache.get(word)
        if got is None:
            text = word.decode("utf-8", "replace")
            starts = {b"^" + text[:k].encode() for k in range(3, 8) if k <= len(text)}
            got = [zlib.crc32(x) % FEATURES * 3 for x in (word, *starts)]
            if self.keep is not None:
                got = [k for k in got if k in self.keep or k + 1 in self.keep or k + 2 in self.keep]
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            self.cache[word] = got
        return got

    def features(self, text: str | None) -> list[int]:
        counts: dict[int, int] = {}
        for word, n in Counter(self.hashed.words(text)).items():
            for k in self.numbers(word):
                counts[k] = counts.get(k, 0) + n
        out = [k + level for k, n in counts.items() for level, least in enumerate((1, 2, 4)) if n >= least]
        return sorted(out if self.keep is None else self.keep.intersection(out))


def _features(docs: DataFrame) -> DataFrame:
    def start():
        marks = Marks()
        return lambda doc_ids, ys, texts: [doc_ids, ys, [marks.features(t) for t in texts]]

    return by_batch(docs, ["doc_id", "_y", "text"], "doc_id long, y int, features array<int>", start, rows=200)


def fit(docs: DataFrame, labels: DataFrame, *, positives: int = 3000, unlabelled: int = 5000, fold: tuple[int, int] = FOLD, screened: int = 20_000, least_z: float = 4.0, **options):
    """Weights and bias from the rows outside the held-out fold. Of the features, those that toxic texts hold more often
    than unlabelled ones by `least_z` standard errors are screened in on Spark, `screened` at most."""
    toxic = label_sample(labels.where("toxic = 1"), "toxic", positives, fold)
    seen = labels.where(~held_out(F.col("doc_id"), *fold)).agg(F.avg(F.when(F.col("toxic").isin(0, 1), F.col("toxic")).cast("double"))).first()[0]
    plain = docs.where(~held_out(F.col("doc_id"), *fold)).select("doc_id").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(unlabelled)
    chosen = toxic.unionByName(plain.withColumn("_y", F.lit(0)))
    # Broadcast: at most positives + unlabelled rows of two numbers.
    sample = written(_features(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")))
    n = dict(sample.groupBy("y").count().collect())
    if not n.get(1) or not n.get(0) or not seen:
        return {}, -np.inf
    each = sample.select("doc_id", "y", F.explode("features").alias("feature"))
    p1, p0 = F.sum("y") / F.lit(n[1]), (F.sum(1 - F.col("y")) + 0.5) / F.lit(n[0] + 1)
    z = (F.col("p1") - F.col("p0")) / F.sqrt(F.col("p0") * (1 - F.least(F.col("p0"), F.lit(0.999))) * (1 / n[1] + 1 / n[0]))
    counted = each.groupBy("feature").agg(p1.alias("p1"), p0.alias("p0"), F.sum("y").alias("held")).where("held >= 3")
    kept = counted.withColumn("z", z).where(F.col("z") >= least_z).orderBy(F.desc("z"), "feature").limit(screened)
    found = each.join(F.broadcast(kept.select("feature")), "feature").groupBy("doc_id", "y").agg(F.collect_set("feature").alias("features"))
    rows = sample.select("doc_id", "y").distinct().join(found, ["doc_id", "y"], "left").collect()
    rows.sort(key=lambda r: (r.doc_id, r.y))
    first, rest = [sorted(r.features or []) for r in rows if r.y], [sorted(r.features or []) for r in rows if not r.y]
    return fit_nnpu(first, rest, min(0.99, float(seen)), **options)


def score_toxicity(docs: DataFrame, model: tuple[dict[int, float], float]) -> DataFrame:
    """(doc_id, score) for every row."""
    weights, bias = model
    sent = docs.sparkSession.sparkContext.broadcast(weights)  # at most as many entries as the fit screens in

    def start():
        known = sent.value
        marks = Marks(set(known))

        def work(doc_ids, texts):
            z = np.array([bias + sum([known[k] for k in marks.features(t)]) for t in texts])
            return [doc_ids, 1 / (1 + np.exp(-np.clip(z, -500, 500))) * np.isfinite(z)]

        return work

    return by_batch(docs, ["doc_id", "text"], "doc_id long, score double", start)


def toxicity(docs: DataFrame, labels: DataFrame, fold: tuple[int, int] = FOLD, **options) -> DataFrame:
    scored = score_toxicity(docs, fit(docs, labels, fold=fold, **options))
    return scored.select("doc_id", held_out(F.col("doc_id"), *fold).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))

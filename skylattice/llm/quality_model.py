"""Quality scores by a factorisation machine.

A text is a sparse vector: its hashed words (each distinct word 1 / sqrt(number of distinct words)), measures of its
structure, and metadata columns that the caller names; numbers are standardised. The machine adds to a linear model
the interactions of all pairs, each the product of two vectors of low rank, in linear time by
sum over pairs = (square of the sum - sum of squares) / 2. It is fitted with numpy by Adam over small batches on the logistic loss.

Fitting takes at most `sample` labelled rows (a documented bound); scoring takes every row. Defined results: a null text
is empty and has no words; a text of any length is read whole; a null metadatum counts as its mean; without labels of both kinds every score is the share of
label 1 (1.0 without labels at all); rows that repeat are scored each; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality_rules import text_counts
from .shared import by_batch, held_out, label_sample, read_table
from .wordhash import WordHash

FEATURES = 1 << 18
FOLD = (3, 1)


def structure(text: str | None) -> list[float]:
    words, chars, symbols, dup_lines, repeats, lines, distinct, upper, digits, points, top, longest = text_counts(text)
    w, c, n = max(words, 1), max(chars, 1), max(lines, 1)
    return [
        np.log1p(words), min(1.0, 20 * symbols / c), upper / c, digits / c, points / w, chars / w, distinct / w**0.5,
        top / w, repeats / w, dup_lines / n, min(50.0, w / n), min(40.0, longest) / 40, float(words < 20),
    ]


def _rows(docs: DataFrame, metadata: list[str], more: list[str]) -> DataFrame:
    """doc_id, the columns of `more`, distinct words as features, dense numbers."""

    def start():
        hashed = WordHash(FEATURES)

        def work(doc_ids, ys, texts, *meta):
            found = [sorted({hashed.number(w) for w in set(hashed.words(t))}) for t in texts]
            dense = [structure(t) + [float("nan") if m[i] is None else float(m[i]) for m in meta] for i, t in enumerate(texts)]
            return [doc_ids, ys, found, dense]

        return work

    return by_batch(docs, ["doc_id", *more, "text", *metadata], "doc_id long, y int, found array<int>, dense array<double>", start, rows=200)


class Machine:
    """score(found, dense): probabilities."""

    def __init__(self, names, mean, scale, bias, w, v):
        self.place = {int(k): i for i, k in enumerate(names)}
        self.mean, self.scale, self.bias, self.w, self.v = mean, scale, bias, w, v

    def dense(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((np.where(np.isnan(rows), self.mean, rows) - self.mean) / self.scale, -8, 8)

    def one(self, found: list[int], dense: np.ndarray) -> float:
        place = self.place
        idx = [place[k] for k in found if k in place]
        n = len(place)
        x = np.concatenate([np.full(len(idx), 1 / max(1, len(found)) ** 0.5), dense])
        idx = np.concatenate([np.array(idx, "int64"), np.arange(n, n + len(dense))])
        vx = self.v[idx] * x[:, None]
        z = self.bias + self.w[idx] @ x + 0.5 * float((vx.sum(0) ** 2).sum() - (vx * vx).sum())
        return float(1 / (1 + np.exp(-max(-50.0, min(50.0, z)))))


def pair_scores(w: np.ndarray, v: np.ndarray, bias: float, column: np.ndarray, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(z, vx, total) of rows that begin at `starts` in column and x: the linear part and half of (square of the sum less
    sum of squares), which is the sum over all pairs."""
    vx = v[column] * x[:, None]
    total = np.add.reduceat(vx, starts)
    pairs = 0.5 * ((total**2).sum(1) - np.add.reduceat((vx * vx).sum(1), starts))
    return bias + np.add.reduceat(w[column] * x, starts) + pairs, vx, total


def fit_machine(found: list[list[int]], dense: np.ndarray, y: np.ndarray, *, rank: int = 6, epochs: int = 16, batch: int = 512, rate: float = 0.02, decay: float = 1e-4, support: int = 5, seed: int = 7) -> Machine:
    """Adam over batches of rows in a seeded order; features that fewer than `support` rows hold are left out."""
    mean = np.nan_to_num(np.nanmean(dense, 0)) if len(dense) else np.zeros(dense.shape[1])
    scale = np.where((s := np.nanstd(dense, 0)) > 1e-9, s, 1.0)
    sizes = np.fromiter(map(len, found), "int64", len(found))
    row, flat = np.repeat(np.arange(len(found)), sizes), np.fromiter((k for r in found for k in r), "int64", int(sizes.sum()))
    names, column, held = np.unique(flat, return_inverse=True, return_counts=True)
    ok = held[column] >= support
    row, flat = row[ok], flat[ok]
    names, column = np.unique(flat, return_inverse=True)
    n, d, width = len(found), dense.shape[1], len(names)
    machine = Machine(names, mean, scale, 0.0, None, None)
    numbers = machine.dense(dense)
    row = np.concatenate([row, np.repeat(np.arange(n), d)])
    x = np.concatenate([1 / np.sqrt(np.maximum(sizes, 1))[row[: len(column)]], numbers.ravel()]).astype("float32")
    column = np.concatenate([column, np.tile(np.arange(width, width + d), n)])
    by_row = np.argsort(row, kind="stable")
    row, column, x = row[by_row], column[by_row], x[by_row]
    starts = np.flatnonzero(np.diff(row, prepend=-1))  # each row has its dense numbers
    lengths = np.diff(np.append(starts, len(row)))
    rng = np.random.default_rng(seed)
    w, v, bias = np.zeros(width + d), rng.normal(0, 0.02, (width + d, rank)), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (w, v)]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, batch):
            step += 1
            rows = order[at : at + batch]
            size = lengths[rows]
            begin = np.append(0, np.cumsum(size))[:-1]
            take = np.repeat(starts[rows] - begin, size) + np.arange(int(size.sum()))
            c, xs, own = column[take], x[take], np.repeat(np.arange(len(rows)), size)
            z, vx, total = pair_scores(w, v, bias, c, xs, begin)
            g = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y[rows]) / len(rows)
            gx = g[own] * xs
            each = gx[:, None] * (total[own] - vx)
            gw = np.bincount(c, gx, width + d)
            gv = np.stack([np.bincount(c, each[:, k], width + d) for k in range(rank)], 1)
            for (a, b), p, grad in zip(moments, (w, v), (gw + decay * w, gv + decay * v), strict=True):
                a += 0.1 * (grad - a)
                b += 0.01 * (grad * grad - b)
                p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
            bias -= rate * float(g.sum())
    machine.bias, machine.w, machine.v = bias, w, v
    return machine


def quality_scores(docs: DataFrame, labels: DataFrame, *, metadata: tuple[str, ...] = (), sample: int = 6000, fold: tuple[int, int] = FOLD, **options) -> DataFrame:
    """doc_id, held_out, score, predicted. `metadata` names numeric columns of docs to use besides the text."""
    # Broadcast: at most `sample` rows of two numbers.
    chosen = F.broadcast(label_sample(labels, "quality", sample, fold))
    rows = _rows(docs.select("doc_id", "text", *metadata).join(chosen, "doc_id"), list(metadata), ["_y"]).collect()
    rows.sort(key=lambda r: (r.doc_id, r.y, r.found))
    y = np.array([r.y for r in rows], "float64")
    constant = float(y.mean()) if len(y) else 1.0
    machine = fit_machine([r.found for r in rows], np.array([r.dense for r in rows]), y, **options) if 0 < constant < 1 else None
    sent = docs.sparkSession.sparkContext.broadcast(machine)  # at most the distinct words of `sample` rows

    def start():
        m, hashed = sent.value, WordHash(FEATURES)

        def work(doc_ids, texts, *meta):
            if m is None:
                return [doc_ids, [constant] * len(doc_ids)]
            found = [{hashed.number(w) for w in set(hashed.words(t))} for t in texts]
            dense = np.array([structure(t) + [float("nan") if c[i] is None else float(c[i]) for c in meta] for i, t in enumerate(texts)])
            return [doc_ids, [m.one(f, d) for f, d in zip(found, m.dense(dense), strict=True)] if len(doc_ids) else []]

        return work

    scored = by_batch(docs, ["doc_id", "text", *metadata], "doc_id long, score double", start, rows=500)
    return scored.select("doc_id", held_out(F.col("doc_id"), *fold).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_quality_model(spark, sf_dir: str) -> DataFrame:
    """n_chars is the one metadatum: lang, source and doc_id are barred."""
    docs = read_table(spark, sf_dir, "documents")
    return quality_scores(docs, read_table(spark, sf_dir, "labels"), metadata=("n_chars",))

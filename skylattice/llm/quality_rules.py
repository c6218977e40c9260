"""Quality rules: learned decision lists over text statistics.

Every whole text gives counts (base rules among them). From labelled counts, sequential covering learns an ordered list
of rules, each a conjunction of thresholds that rejects: a conjunction is grown condition by condition on two thirds of
the rows by information gain, pruned on the last third, and kept if it is precise there; the rows it covers are taken
out, and the next rule is learned on the rest. The list becomes one Spark CASE expression, applied to all documents.

Defined results: a null text has no words (and fails the base rules); without labels, or with labels of one kind, the
list is empty and whatever passes the base rules is kept; rows that repeat are scored each; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import by_batch, give_back, label_sample, read_table, written

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
STATS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_distinct long, n_upper long, n_digits long, n_points long, top_word long, longest_word long"
_UPPER, _DIGITS, _POINTS = bytes(range(65, 91)), b"0123456789", b".,;:!?"


def repeat_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of 8 that occur twice or more, the first occurrence included. Equal windows get equal
    numbers by three doublings, so nothing is hashed."""
    n = len(ids)
    if n <= window:
        return 0
    width = 1
    while width < window:
        pair = ids[:-width] * np.int64(n + 1) + ids[width:]
        values, ids, counts = np.unique(pair, return_inverse=True, return_counts=True)
        if len(values) == len(pair):
            return 0
        width *= 2
    again = np.flatnonzero(counts[ids] > 1)
    cover = np.zeros(n + 1, "int64")
    np.add.at(cover, again, 1)
    np.add.at(cover, again + window, -1)
    return int(np.count_nonzero(np.cumsum(cover)))


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of STATS after doc_id, for one whole text."""
    text = text or ""
    data = text.encode("utf-8", "replace")
    words = data.split()  # bytes.split() cuts at space and tab to carriage return
    in_words = sum(map(len, words))
    without = lambda drop: len(data) - len(data.translate(None, drop))
    lines = [x for x in data.split(b"\n") if x.strip()]
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), "int64", len(words))
    repeated = repeat_words(ids) if len(seen) < len(words) else 0
    top = int(np.bincount(ids).max()) if len(ids) else 0
    return (
        len(words), len(text) - (len(data) - in_words), without(SYMBOLS), len(lines) - len(set(lines)), repeated, len(lines),
        len(seen), without(_UPPER), without(_DIGITS), without(_POINTS), top, max(map(len, words), default=0),
    )


def text_stats(docs: DataFrame) -> DataFrame:
    """STATS of docs(doc_id, text)."""

    def start():
        def work(doc_ids, texts):
            return [doc_ids, *zip(*map(text_counts, texts), strict=True)]

        return work

    return by_batch(docs, ["doc_id", "text"], STATS, start)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def measures() -> dict[str, Column]:
    """What rules set thresholds on: shares, which do not grow with a text."""
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    return {
        "symbols_a_char": F.col("n_symbols") / chars,
        "capitals_a_char": F.col("n_upper") / chars,
        "digits_a_char": F.col("n_digits") / chars,
        "points_a_word": F.col("n_points") / words,
        "chars_a_word": F.col("word_chars") / words,
        "distinct_a_word": F.col("n_distinct") / F.sqrt(words),
        "top_word_share": F.col("top_word") / words,
        "repeats_a_word": F.col("n_repeat_words") / words,
        "repeated_lines": F.col("n_dup_lines") / lines,
        "longest_word": F.col("longest_word").cast("double"),
        "words": F.col("n_words").cast("double"),
    }


@dataclass(frozen=True)
class Rule:
    """Rejects where every (measure, "<=" or ">", threshold) holds."""

    conditions: tuple[tuple[str, str, float], ...]
    covered: int
    precision: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for name, op, at in self.conditions:
            out &= x[name] <= at if op == "<=" else x[name] > at
        return out

    def column(self) -> Column:
        parts = [F.col(n) <= F.lit(at) if op == "<=" else F.col(n) > F.lit(at) for n, op, at in self.conditions]
        out = parts[0]
        for p in parts[1:]:
            out &= p
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {op} {at:.6g}" for n, op, at in self.conditions)


def _grow(x: dict[str, np.ndarray], y: np.ndarray, most: int, cuts: int) -> list[tuple[str, str, float]]:
    """Add the condition of the largest information gain for y, while it gains."""
    inside, conditions = np.ones(len(y), bool), []
    while len(conditions) < most:
        p, n = y[inside].sum(), (~y[inside]).sum()
        if not p or not n:
            break
        before, best = np.log2(p / (p + n)), (1e-9, None)
        for name, values in x.items():
            v, t = values[inside], y[inside]
            points = np.unique(np.quantile(v, np.linspace(0, 1, cuts + 2)[1:-1]))
            # Quantiles miss a rare tail, so cuts between neighbouring rejected values are tried as well.
            points = np.unique(np.concatenate([points, np.quantile(v[t], np.linspace(0, 1, cuts))]))
            order = np.argsort(v, kind="stable")
            k = np.searchsorted(v[order], points, "right")
            hits = np.concatenate([[0], np.cumsum(t[order])])
            for op, pos, all_ in (("<=", hits[k], k), (">", p - hits[k], len(v) - k)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pos > 0, pos * (np.log2(pos / np.maximum(all_, 1)) - before), 0)
                j = int(np.argmax(gain))
                if gain[j] > best[0]:
                    best = (gain[j], (name, op, float(points[j])))
        if best[1] is None:
            break
        conditions.append(best[1])
        name, op, at = best[1]
        v = x[name][inside]  # the threshold goes midway between the values that it parts
        at = float((v[v <= at].max() + v[v > at].min()) / 2)
        conditions[-1] = (name, op, at)
        inside &= x[name] <= at if op == "<=" else x[name] > at
    return conditions


def learn_rules(x: dict[str, np.ndarray], y: np.ndarray, *, most_rules: int = 12, most_conditions: int = 4, cuts: int = 64, least_precision: float = 0.9, least_covered: int = 3) -> list[Rule]:
    """An ordered list of rules that reject. x: the measures of labelled rows; y: true where a row is to be rejected."""
    rules: list[Rule] = []
    left = np.arange(len(y))
    prune_row = np.arange(len(y)) % 3 == 2
    while len(rules) < most_rules and y[left].any():
        grow, prune = left[~prune_row[left]], left[prune_row[left]]
        at = lambda rows: {k: v[rows] for k, v in x.items()}
        conditions = _grow(at(grow), y[grow], most_conditions, cuts)
        if not conditions:
            break

        def worth(c, rows=prune):
            hit = Rule(tuple(c), 0, 0).holds(at(rows))
            p, n = int(y[rows][hit].sum()), int((~y[rows][hit]).sum())
            return (p - n) / max(1, p + n), p

        while len(conditions) > 1 and worth(conditions[:-1]) >= worth(conditions):
            conditions = conditions[:-1]
        hit = Rule(tuple(conditions), 0, 0).holds(at(left))
        right = int(y[left][hit].sum())
        precision = right / max(1, int(hit.sum()))
        if right < least_covered or precision < least_precision or (len(prune) and worth(conditions)[1] and worth(conditions)[0] < 2 * least_precision - 1):
            break
        rules.append(Rule(tuple(conditions), int(hit.sum()), precision))
        left = left[~hit]
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The place of the first rule that holds (from 1), 0 if none: one ordered CASE expression."""
    out = None
    for k, rule in enumerate(rules, 1):
        out = F.when(rule.column(), F.lit(k)) if out is None else out.when(rule.column(), F.lit(k))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def quality_rules(docs: DataFrame, labels: DataFrame, *, sample: int = 50_000, **options) -> DataFrame:
    """Counts, base_failed, rule (which learned rule rejects, 0 for none) and kept for every row of docs. The list is
    learned from at most `sample` labelled rows that pass the base rules (labels.quality 0: reject)."""
    stats = written(text_stats(docs)).withColumn("base_failed", base_failed()).withColumns(measures())
    names = list(measures())
    train = stats.where(~F.col("base_failed")).join(label_sample(labels, "quality", sample), "doc_id").select("doc_id", *names, "_y").toPandas()
    train = train.sort_values(["doc_id", "_y"])  # the split into rows to grow and to prune on is the same in every run
    rules = learn_rules({n: train[n].to_numpy("float64") for n in names}, (train["_y"] == 0).to_numpy(), **options)
    out = stats.withColumn("rule", verdict(rules)).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def passing(docs: DataFrame, labels: DataFrame, *, sample: int = 50_000, **options) -> DataFrame:
    """The rows of docs that quality_rules keeps, with all their columns; texts are read once and not moved. Only what
    is labelled is read before, to learn the list."""
    # Broadcast: at most `sample` rows of two numbers.
    chosen = label_sample(labels, "quality", sample)
    train = text_stats(docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id"))
    names = list(measures())
    train = train.where(~base_failed()).withColumns(measures()).join(chosen, "doc_id").select("doc_id", *names, "_y").toPandas().sort_values(["doc_id", "_y"])
    rules = learn_rules({n: train[n].to_numpy("float64") for n in names}, (train["_y"] == 0).to_numpy(), **options)
    fields = STATS.split(", ", 1)[1]
    columns = [f.split()[0] for f in fields.split(", ")]

    @F.arrow_udf(fields)
    def counts(texts):
        import pyarrow as pa

        found = list(zip(*(text_counts(t) for t in texts.to_pylist()), strict=True)) or [[]] * len(columns)
        out = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], columns)
        give_back()
        return out

    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    stats = docs.select(whole, counts("text").alias("_stats")).select("_row", "_stats.*").withColumn("base_failed", base_failed())
    kept = stats.withColumns(measures()).where(~F.col("base_failed") & (verdict(rules) == 0))
    return kept.select("_row.*")


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))

"""Ranked lexical search by hashed max-sketches.

Terms are runs of letters and digits of ASCII and of all other characters, A-Z lower-cased. A document's impact for a
term grows with how often it holds the term and falls with the document's length; a score is the sum of weight times
impact over an item's terms, in integers.

The index has a row for each document: the number of its terms, the distinct terms as 64-bit hashes with their counts,
and a sketch. The sketch has two rows of some coordinates for each distinct term (a power of two in all), a byte each;
terms fold into a coordinate of each row by parts of their hash, and a coordinate keeps the largest impact of its terms,
rounded up. So the sum of an item's weights times the lesser of its terms' two coordinates is never below the document's
score. Tasks look up all items of a
batch in the sketches of many documents at once, and score the documents of each item exactly in descending order of
their bounds, until the bound falls below the tenth best score the task has met. A task gives out ten documents an item
at most, and the best of those are the result. Documents with equal terms have equal scores, so of those only the ten
with the least doc_id are held.

Items are taken in batches of a fixed number, whose terms with their weights are all that tasks are sent.

Defined results: a null text has no terms; a document without terms is never found, an item without terms finds
nothing, and neither does an item whose terms no document holds. Rows with one doc_id are documents of their own; a null
doc_id comes before all others at equal scores. Each row of the items is an item of its own, whatever its item_id.
Other columns of an input are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import by_batch, read_table, tidy, written

TOP = 10
#: Items of a batch: what tasks are sent at once.
BATCH_ITEMS = 500
#: Coordinates of a sketch's row for each distinct term, at least, and the least and most of all. The second row takes the
#: hash from another bit on.
SPREAD = 8
NARROWEST, WIDEST = 64, 2**16
SECOND = np.uint64(32)
#: No impact reaches a million; so much of it is one step of a sketch's byte.
STEP = 3922
#: Documents whose sketches are looked up together.
BLOCK = 2000
CACHE_TERMS = 200_000

_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
INDEX = "doc_id long, n long, width int, terms binary, counts binary, sketch binary"
#: Stands for a null doc_id: before all others.
NO_ID = -(2**63)
FOUND = "item long, doc_id long, score long"


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_PLAIN).split()


class Hashes(dict):
    """64-bit hashes of terms."""

    def __init__(self):
        import xxhash

        self.digest = xxhash.xxh3_64_intdigest

    def __missing__(self, term: bytes) -> int:
        if len(self) >= CACHE_TERMS:
            self.clear()
        got = self[term] = self.digest(term)
        return got


def impact(count, n, n_docs: int, n_terms: int):
    """Whole numbers; count and n may be arrays."""
    m = 100 - 90 + (90 * n * n_docs) // n_terms
    return (1_000_000_000 * count) // (1000 * count + 8 * m)


@dataclass
class Statistics:
    """Of all documents: how many have a term, their terms with repeats, and (hash, df) of every term."""

    n_docs: int
    n_terms: int
    df: DataFrame


TERM, DOCS, TERMS = 0, 1, 2


def statistics(docs: DataFrame) -> Statistics:
    """Counted inside tasks first, so that a frequent term is a row or a few a task."""

    @tidy
    def run(batches):
        import pyarrow as pa

        hashes, df, n_docs, n_terms = Hashes(), Counter(), 0, 0

        def given(kinds, keys, n):
            arrays = [np.array(kinds, "int32"), np.array(keys, "uint64").view("int64"), np.array(n, "int64")]
            return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["kind", "hash", "df"])

        def terms():
            for k in range(0, len(df), 100_000):
                part = list(itertools.islice(df.items(), k, k + 100_000))
                yield given([TERM] * len(part), *zip(*part, strict=True))
            df.clear()

        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = terms_of(text)
                if found:
                    n_docs += 1
                    n_terms += len(found)
                    df.update(map(hashes.__getitem__, set(found)))
            if len(df) > 500_000:
                yield from terms()
        yield from terms()
        yield given([DOCS, TERMS], [0, 0], [n_docs, n_terms])

    counted = docs.select("text").mapInArrow(run, "kind int, hash long, df long").groupBy("kind", "hash").agg(F.sum("df").alias("df"))
    counted = written(counted)
    totals = {r.kind: r.df for r in counted.where(F.col("kind") != TERM).collect()}  # two rows
    return Statistics(totals.get(DOCS, 0), totals.get(TERMS, 0), counted.where(F.col("kind") == TERM).select("hash", "df"))


def sketch_width(n_distinct: int) -> int:
    return min(WIDEST, max(NARROWEST, 1 << (SPREAD * n_distinct - 1).bit_length()))


def cells(terms: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The coordinates of terms in the two rows of a sketch, counted through."""
    mask = np.uint64(width - 1)
    return (terms & mask).astype("int64"), ((terms >> SECOND) & mask).astype("int64") + width


def sketch(terms: np.ndarray, impacts: np.ndarray, width: int) -> np.ndarray:
    """A byte a coordinate: the largest impact of the terms that fold into it, in steps, rounded up."""
    out, steps = np.zeros(2 * width, "uint8"), ((impacts + (STEP - 1)) // STEP).astype("uint8")
    for at in cells(terms, width):
        np.maximum.at(out, at, steps)
    return out


def build_index(docs: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """INDEX of docs(doc_id, text): a row for each document with a term."""

    def start():
        hashes = Hashes()

        def work(doc_ids, texts):
            out = [[] for _ in range(6)]
            for doc, text in zip(doc_ids, texts, strict=True):
                found = terms_of(text)
                if not found:
                    continue
                count = Counter(found)
                terms = np.fromiter(map(hashes.__getitem__, count), "uint64", len(count))
                counts = np.fromiter(count.values(), "int64", len(count))
                order = np.argsort(terms)
                terms, counts, width = terms[order], counts[order], sketch_width(len(count))
                drawn = sketch(terms, impact(counts, len(found), n_docs, n_terms), width)
                row = (doc, len(found), width, terms.astype("<u8").tobytes(), counts.astype("<i4").tobytes(), drawn.tobytes())
                for column, x in zip(out, row, strict=True):
                    column.append(x)
            return out

        return work

    return by_batch(docs, [F.col("doc_id").cast("long").alias("doc_id"), "text"], INDEX, start)


@dataclass
class Item:
    """An item's distinct terms, ascending, and their weights."""

    terms: np.ndarray
    weights: np.ndarray


class Search:
    """What a task has found: the best documents of each item so far."""

    def __init__(self, items: list[Item], n_docs: int, n_terms: int, top: int = TOP):
        self.items, self.n_docs, self.n_terms, self.top = items, n_docs, n_terms, top
        self.best: list[list[tuple[int, int]]] = [[] for _ in items]  # heaps of (score, - doc_id)
        self.scored = 0

    def score(self, item: Item, terms: np.ndarray, counts: np.ndarray, n: int) -> int:
        self.scored += 1
        at = np.searchsorted(terms, item.terms)
        at[at == len(terms)] = 0
        held = terms[at] == item.terms
        return int(np.sum(item.weights[held] * impact(counts[at[held]].astype("int64"), n, self.n_docs, self.n_terms)))

    def block(self, n: list[int], terms: list[bytes], counts: list[bytes], sketches: list[bytes], ids: list[list[int]]) -> None:
        """Documents of different terms, all of one sketch width; ids: of each, the doc_ids that have these terms."""
        width = len(sketches[0]) // 2
        table = np.ascontiguousarray(np.frombuffer(b"".join(sketches), "uint8").reshape(-1, 2 * width).T)
        for item, best in zip(self.items, self.best, strict=True):
            # Whole numbers far below 2 ** 53, so doubles are exact.
            first, second = cells(item.terms, width)
            bounds = item.weights.astype("float64") @ np.minimum(table[first], table[second]) * STEP
            least = best[0][0] if len(best) == self.top else 1
            rows = np.flatnonzero(bounds >= least)
            for row in rows[np.argsort(-bounds[rows], kind="stable")].tolist():
                if len(best) == self.top and bounds[row] < best[0][0]:
                    break
                score = self.score(item, np.frombuffer(terms[row], "<u8"), np.frombuffer(counts[row], "<i4"), n[row])
                if score > 0:
                    for doc in ids[row]:
                        entry = (score, -doc)
                        if len(best) < self.top:
                            heapq.heappush(best, entry)
                        elif entry > best[0]:
                            heapq.heapreplace(best, entry)
                        else:
                            break

    def batch(self, doc_ids, n, widths, terms, counts, sketches) -> None:
        same: dict = {}
        for row, (k, t, c) in enumerate(zip(n, terms, counts, strict=True)):
            same.setdefault((k, t, c), []).append(row)
        groups = defaultdict(list)
        for rows in same.values():
            groups[widths[rows[0]]].append((rows[0], heapq.nsmallest(self.top, (NO_ID if doc_ids[r] is None else doc_ids[r] for r in rows))))
        for members in groups.values():
            first = [row for row, _ in members]
            self.block([n[r] for r in first], [terms[r] for r in first], [counts[r] for r in first], [sketches[r] for r in first], [ids for _, ids in members])


def _searched(index: DataFrame, items: list[Item], n_docs: int, n_terms: int, top: int) -> DataFrame:
    """FOUND: each task's best documents of each item."""

    @tidy
    def run(batches):
        import pyarrow as pa

        search = Search(items, n_docs, n_terms, top)
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK):
                search.batch(*[c.to_pylist() for c in batch.slice(k, BLOCK).columns])
        found = [(k, None if doc == -NO_ID else -doc, score) for k, best in enumerate(search.best) for score, doc in best]
        columns = list(zip(*found, strict=True)) if found else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, "int64") for c in columns], names=["item", "doc_id", "score"])

    return index.select("doc_id", "n", "width", "terms", "counts", "sketch").mapInArrow(run, FOUND)


def weighted(spark, texts: list[str | None], stats: Statistics) -> list[Item]:
    """A batch of items with the weights of their terms; terms that no document holds are left out."""
    digest = Hashes()
    items = [sorted({digest[t] for t in terms_of(text)}) for text in texts]
    wanted = np.unique(np.array([h for hashes in items for h in hashes], "uint64")).view("int64")
    asked = spark.createDataFrame([(int(h),) for h in wanted], "hash long")
    # Broadcast and collected: the terms of one batch of items.
    df = {r.hash % 2**64: r.df for r in stats.df.join(F.broadcast(asked), "hash").collect()}
    weight = {h: math.floor(1000 * math.log((2 * stats.n_docs + 2) / (2 * n + 1))) for h, n in df.items()}
    held = [[h for h in hashes if h in weight] for hashes in items]
    return [Item(np.array(hashes, "uint64"), np.array([weight[h] for h in hashes], "int64")) for hashes in held]


def ranked_search(docs: DataFrame, items: DataFrame, *, top: int = TOP, batch_items: int = BATCH_ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of docs(doc_id, text) for each row of items(item_id, text)."""
    spark = docs.sparkSession
    kind = dict(items.dtypes)["item_id"]
    stats = statistics(docs)
    index = written(build_index(docs, stats.n_docs, stats.n_terms))
    found = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    rows = items.select("item_id", "text").toLocalIterator()
    while batch := list(itertools.islice(rows, batch_items)):
        asked = weighted(spark, [r.text for r in batch], stats)
        best = _searched(index, asked, stats.n_docs, stats.n_terms, top)
        order = W.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(k, r.item_id) for k, r in enumerate(batch)], f"item long, item_id {kind}")
        found = found.unionByName(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return found


def op13_ranked_search(spark, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH docs_ AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
counts_ AS (SELECT d, doc_id, n, term, count(*) AS tf FROM (SELECT d, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM docs_) GROUP BY d, doc_id, n, term),
all_ AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM (SELECT len(terms)::BIGINT AS n FROM docs_ WHERE len(terms) > 0)),
items_ AS (
  SELECT i, item_id, unnest(list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
  FROM (SELECT row_number() OVER () AS i, * FROM benchmark)
),
weights_ AS (
  SELECT term, floor(1000 * ln((2.0 * docs + 2) / (2.0 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counts_ GROUP BY term), all_
),
scores_ AS (
  SELECT i, item_id, d, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // all_.terms))))::BIGINT AS score
  FROM items_ JOIN weights_ USING (term) JOIN counts_ USING (term), all_ GROUP BY i, item_id, d, doc_id
),
ranked_ AS (SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scores_ WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked_ WHERE rank <= 10
"""

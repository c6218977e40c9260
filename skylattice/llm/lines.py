"""Line dedup: lines that many documents hold stay in one of them only; the result is a keep bitmap a document, not text.

A line's key is the line without white space at its ends, A-Z lower-cased; lines with short keys are never touched.
Each other line is a row of 128 bits of its key's hash, its document and its position. Rows are range-partitioned and
sorted by hash, document (largest first) and position, so the first document of a run of equal hashes is the one that
keeps its lines, and one pass over a sorted partition, holding back the lines of a run's second document at most, tells
which rows go. Ranges may end inside a run, so a line that most documents hold is many tasks' work: rows of a
partition's first run, and what its last run leaves open, are settled by the first three documents of each such run,
two runs a task.

Defined results: a null text is one empty line. Rows with one doc_id are one document when documents are counted; a
null doc_id is one as well and less than any other. Rows that repeat get the same bitmap. Other columns of an input are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_batch, read_table, tidy, written

LEAST_CHARS = 20
LEAST_DOCUMENTS = 3
BLANK = b" \t\n\x0b\x0c\r"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Stands for a null doc_id: below all others.
NO_ID = -(2**63)
DROPPED, OPEN, EDGE = 0, 1, 2
MARKS = "kind byte, h1 long, h2 long, doc long, text_hash long, pos int, n_lines int"


def _doc():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))


def line_rows(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(h1, h2, doc, text_hash, pos, n_lines): a row for each line whose key has least_chars code points or more."""

    def start():
        import xxhash

        def work(doc_ids, hashes, texts):
            h1, h2, doc, text_hash, pos, n_lines = out = [], [], [], [], [], []
            for d, h, text in zip(doc_ids, hashes, texts, strict=True):
                lines = (text or "").encode("utf-8", "replace").translate(LOWER).split(b"\n")
                for k, line in enumerate(lines):
                    if len(line) < least_chars:
                        continue
                    key = line.strip(BLANK)
                    if len(key) < least_chars or (not key.isascii() and len(key.decode()) < least_chars):
                        continue
                    both = xxhash.xxh3_128_digest(key)
                    h1.append(int.from_bytes(both[:8], "big", signed=True))
                    h2.append(int.from_bytes(both[8:], "big", signed=True))
                    doc.append(d)
                    text_hash.append(h)
                    pos.append(k)
                    n_lines.append(len(lines))
            return out

        return work

    columns = [_doc().alias("doc"), F.xxhash64("text").alias("text_hash"), "text"]
    return by_batch(docs, columns, "h1 long, h2 long, doc long, text_hash long, pos int, n_lines int", start)


class Stream:
    """One pass over a sorted partition. marks: what was found since it was last taken, as arrays by column of MARKS."""

    def __init__(self, least: int):
        self.least = least
        self.marks: list[tuple] = []
        self.key: tuple[int, int] | None = None
        self.first = True  # the run that is open is the partition's first
        self.docs: list[int] = []  # its first documents, no more than `least`
        self.seen = 0  # how many documents it has
        self.last_doc = 0
        self.held: list[list[np.ndarray]] = []  # its undecided rows: those of all documents but one, while few are seen

    def mark(self, kind: int, rows: list[np.ndarray]) -> None:
        if len(rows[0]):
            self.marks.append((np.full(len(rows[0]), kind, "int8"), *rows))

    def feed(self, rows: list[np.ndarray]) -> None:
        """More rows of the run that is open."""
        doc = rows[2]
        new = np.diff(doc, prepend=self.last_doc) != 0
        new[0] |= self.seen == 0
        rank = self.seen - 1 + np.cumsum(new)
        if self.seen < self.least:
            self.docs += doc[new].tolist()[: self.least - self.seen]
        self.seen, self.last_doc = int(rank[-1]) + 1, int(doc[-1])
        if self.first:
            self.mark(OPEN, rows)
            return
        later = [c[rank > 0] for c in rows]
        if self.seen >= self.least:
            for held in self.held:
                self.mark(DROPPED, held)
            self.held = []
            self.mark(DROPPED, later)
        elif len(later[0]):
            self.held.append(later)

    def close(self, at_end: bool = False) -> None:
        if self.key is not None and (self.first or at_end):
            for held in self.held:
                self.mark(OPEN, held)
            n = len(self.docs)
            filled = [np.full(n, x, "int64") for x in self.key] + [np.array(self.docs, "int64"), np.zeros(n, "int64")]
            self.mark(EDGE, [*filled, np.zeros(n, "int32"), np.zeros(n, "int32")])
        self.first = self.first and self.key is None
        self.key, self.docs, self.seen, self.held = None, [], 0, []

    def whole_runs(self, rows: list[np.ndarray], starts: np.ndarray) -> None:
        """Runs that begin and end here."""
        doc = rows[2]
        new = np.diff(doc, prepend=doc[0]) != 0
        new[starts] = True
        c = np.cumsum(new)
        sizes = np.diff(starts, append=len(doc))
        rank = c - np.repeat(c[starts], sizes)
        many = np.repeat(rank[np.append(starts[1:], len(doc)) - 1] + 1 >= self.least, sizes)
        gone = many & (rank > 0)
        self.mark(DROPPED, [x[gone] for x in rows])

    def batch(self, rows: list[np.ndarray]) -> None:
        h1, h2 = rows[:2]
        if not len(h1):
            return
        new = np.empty(len(h1), bool)
        new[0] = self.key != (int(h1[0]), int(h2[0]))
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        starts = np.flatnonzero(new)
        if not len(starts):
            self.feed(rows)
            return
        if starts[0]:
            self.feed([x[: starts[0]] for x in rows])
        if self.key is None and len(starts) > 1:  # the partition's first run ends here
            self.open([x[starts[0] : starts[1]] for x in rows])
            starts = starts[1:]
        self.close()
        if len(starts) > 1:
            self.whole_runs([x[starts[0] : starts[-1]] for x in rows], starts[:-1] - starts[0])
        self.open([x[starts[-1] :] for x in rows])

    def open(self, rows: list[np.ndarray]) -> None:
        self.key = int(rows[0][0]), int(rows[1][0])
        self.feed(rows)


def _streamed(lines: DataFrame, least: int) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    wanted = to_arrow_schema(StructType.fromDDL(MARKS))

    @tidy
    def run(batches):
        import pyarrow as pa

        stream = Stream(least)

        def taken():
            for m in stream.marks:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(m, wanted, strict=True)], schema=wanted)
            stream.marks = []

        for batch in batches:
            stream.batch([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            yield from taken()
        stream.close(at_end=True)
        yield from taken()

    return lines.mapInArrow(run, MARKS)


def dropped_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(doc, text_hash, pos, n_lines) of all lines that go."""
    order = ["h1", "h2", F.col("doc").desc(), "text_hash", "pos"]
    lines = line_rows(docs, least_chars).repartitionByRange(*order).sortWithinPartitions(*order)
    marks = written(_streamed(lines, least_documents))
    edges = marks.where(F.col("kind") == EDGE).groupBy("h1", "h2").agg(F.max("doc").alias("keeper"), F.size(F.collect_set("doc")).alias("documents"))
    # Broadcast: two runs a task at most.
    edges = F.broadcast(edges.where(F.col("documents") >= least_documents))
    settled = marks.where(F.col("kind") == OPEN).join(edges, ["h1", "h2"]).where(F.col("doc") < F.col("keeper"))
    columns = ["doc", "text_hash", "pos", "n_lines"]
    return marks.where(F.col("kind") == DROPPED).select(*columns).unionByName(settled.select(*columns))


def packed(n_lines: int, gone: list[int]) -> bytes:
    """A keep bitmap: a bit a line, the first line highest, deflated."""
    keep = np.ones(n_lines, bool)
    keep[gone] = False
    return zlib.compress(np.packbits(keep).tobytes())


def unpacked(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), "uint8"), count=n_lines).astype(bool)


def keep_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(doc, text_hash, n_lines, n_dropped, keep) of each text that loses lines, told by its doc_id (a null one is NO_ID)
    and the xxhash64 of its text. All others keep every line."""
    gone = dropped_lines(docs, least_chars, least_documents).groupBy("doc", "text_hash", "n_lines").agg(F.collect_set("pos").alias("gone"))

    def start():
        def work(doc, text_hash, n_lines, positions):
            return [doc, text_hash, n_lines, [len(p) for p in positions], [packed(n, p) for n, p in zip(n_lines, positions, strict=True)]]

        return work

    return by_batch(gone, ["doc", "text_hash", "n_lines", "gone"], "doc long, text_hash long, n_lines int, n_dropped int, keep binary", start)


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """docs(doc_id, text) with n_dropped and keep, both null where every line stays."""
    d = docs.select("doc_id", "text", _doc().alias("doc"), F.xxhash64("text").alias("text_hash"))
    return d.join(bitmaps.drop("n_lines"), ["doc", "text_hash"], "left").select("doc_id", "text", "n_dropped", "keep")


def kept_text(text: str | None, bitmap: bytes | None) -> str:
    """The lines of a text that its bitmap keeps."""
    if bitmap is None:
        return text or ""
    lines = (text or "").split("\n")
    return "\n".join(line for line, stays in zip(lines, unpacked(bitmap, len(lines)).tolist(), strict=True) if stays)


def line_dedup(docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(doc_id, kept): every text without the lines that go."""
    rows = with_bitmaps(docs, keep_bitmaps(docs, least_chars, least_documents))

    def start():
        def work(doc_ids, texts, bitmaps):
            return [doc_ids, [kept_text(*x) for x in zip(texts, bitmaps, strict=True)]]

        return work

    return by_batch(rows, ["doc_id", "text", "keep"], "doc_id long, kept string", start)


def op12_line_dedup(spark, sf_dir: str) -> DataFrame:
    """What each document of the table keeps of its lines."""
    docs = read_table(spark, sf_dir, "documents")

    def start():
        def work(doc_ids, texts, n_dropped, bitmaps):
            n_lines = [(t or "").count("\n") + 1 for t in texts]
            kept = [hashlib.sha256(kept_text(*x).encode("utf-8", "replace")).hexdigest() for x in zip(texts, bitmaps, strict=True)]
            return [doc_ids, n_lines, [n or 0 for n in n_dropped], kept]

        return work

    rows = with_bitmaps(docs, keep_bitmaps(docs))
    return by_batch(rows, ["doc_id", "text", "n_dropped", "keep"], "doc_id long, n_lines long, n_dropped long, kept_sha256 string", start)


OP12_SQL = r"""
WITH rows_ AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines_ AS (
  SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM rows_
),
keys_ AS (
  SELECT r, doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines_
),
common_ AS (SELECT key, max(doc_id) AS keeper FROM keys_ WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked_ AS (SELECT k.*, coalesce(c.keeper <> k.doc_id, false) AS gone FROM keys_ k LEFT JOIN common_ c USING (key))
SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM (
  SELECT r, doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
  FROM marked_ GROUP BY r, doc_id
)
"""

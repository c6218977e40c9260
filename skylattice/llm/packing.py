"""Best-fit packing of token sequences, by bin completion over the histogram of lengths.

Only how many pieces there are of each length matters to a packing, and lengths are at most the capacity. So the pieces
are counted by length on Spark, the counts (at most `capacity` of them, however large the table) are packed into
patterns with multiplicities, and each piece finds its place by its length and its rank within that length.

A pattern fills a sequence around the largest length left. Fillings are enumerated by branch and bound: longer lengths
first; dominated fillings (one piece or a pair where a longer one fits as well) are passed over; a branch is cut when
the waste it must leave exceeds that of the incumbent; the best-fit filling is the first incumbent. A pattern is
repeated as long as its lengths last, so there are not many more patterns than lengths.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import by_batch, read_table, written
from .tokenfiles import CACHE_WORDS, WordIds

CAPACITY = 2048
END = 0


def best_filling(counts: dict[int, int], lengths: list[int], room: int, nodes: int) -> list[int]:
    """Lengths (ascending in `lengths`, with counts) that leave the least of `room`; of equal waste the first found,
    which holds the longest pieces. A branch takes all its copies of a length at once, so branches are no deeper than
    there are different lengths in a filling (63 for 2048). After `nodes` branches the best so far is given: the filling
    may then waste more than it must, and a table may need more sequences; no piece is lost."""
    best: list[tuple[int, int]] = []
    best_waste = room
    left = nodes

    def search(room: int, upto: int, chosen: list[tuple[int, int]]) -> bool:
        """True when nothing better is possible or the nodes are used up."""
        nonlocal best, best_waste, left
        if room < best_waste:
            best, best_waste = list(chosen), room
            if room == 0:
                return True
        left -= 1
        if left <= 0:
            return True
        k = min(upto, bisect.bisect_right(lengths, room) - 1)
        while k >= 0:
            length = lengths[k]
            for copies in range(min(counts[length], room // length), 0, -1):
                rest = room - copies * length
                # What no shorter length can fill is waste for sure.
                sure = rest if k == 0 or rest < lengths[0] else 0
                if sure < best_waste:
                    chosen.append((length, copies))
                    done = search(rest, k - 1, chosen)
                    chosen.pop()
                    if done:
                        return True
                if k == 0:
                    break  # fewer copies leave more
                if copies == 1 and rest < lengths[0]:
                    # Alone in the room: every shorter single piece is dominated; only fillings of two or more remain.
                    k = min(k, bisect.bisect_right(lengths, room - lengths[0]) if lengths[0] * 2 <= room else 0)
            k -= 1
        return False

    search(room, len(lengths) - 1, [])
    return [length for length, copies in best for _ in range(copies)]


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY, nodes: int = 3000) -> list[tuple[list[int], int]]:
    """[(lengths of a sequence, how many such sequences)] for {length: number of pieces}."""
    counts = {k: v for k, v in histogram.items() if v > 0}
    if any(not 0 < k <= capacity for k in counts):
        raise ValueError("lengths go from 1 to the capacity")
    lengths = sorted(counts)
    patterns = []
    while lengths:
        top = lengths[-1]
        counts[top] -= 1
        pattern = [top] + best_filling(counts, lengths, capacity - top, nodes)
        counts[top] += 1
        need: dict[int, int] = {}
        for k in pattern:
            need[k] = need.get(k, 0) + 1
        times = min(counts[k] // n for k, n in need.items())
        patterns.append((pattern, times))
        for k, n in need.items():
            counts[k] -= n * times
            if not counts[k]:
                del counts[k]
                del lengths[bisect.bisect_left(lengths, k)]
    return patterns


def _places(patterns: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: from which rank on, the first sequence and the offset."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rank = taken.get(length, 0)
            out.setdefault(length, []).append((rank, sequence, offset))
            taken[length] = rank + times
            offset += length
        sequence += times
    return {k: tuple(np.array(v, "int64").T) for k, v in out.items()}


def pack(pieces: DataFrame, *, capacity: int = CAPACITY, nodes: int = 3000, bucket_rows: int = 20_000) -> DataFrame:
    """pieces(length int, ...) with lengths of 1 to capacity -> + sequence_id, offset (both long). Rows that repeat are
    pieces of their own; an empty table stays empty. Ranks within a length are two-level, by a hash bucket, so that a
    length that very many pieces share is no single task's work. Rows need a column `key` (long) to be dealt by."""
    n_rows = pieces.count()
    buckets = max(1, -(-n_rows // bucket_rows))
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    sizes = dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    histogram = {r[0]: r[1] for r in sizes.groupBy("length").agg(F.sum("_n")).collect()}  # at most capacity rows
    places = _places(pack_histogram(histogram, capacity, nodes))
    before = F.sum("_n").over(W.partitionBy("length").orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")
    offsets = sizes.select("length", "_bucket", before.alias("_before"))
    rank = F.row_number().over(W.partitionBy("length", "_bucket").orderBy("key")) - 1
    ranked = dealt.withColumn("_rank", rank).join(offsets, ["length", "_bucket"]).withColumn("_rank", F.col("_rank") + F.col("_before"))

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(length, rank):
        import pyarrow as pa

        n, r = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        sequence, offset = np.zeros(len(n), "int64"), np.zeros(len(n), "int64")
        order = np.argsort(n, kind="stable")
        edges = np.flatnonzero(np.diff(n[order], prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            rows = order[a:b]
            ranks, first, at = places[int(n[rows[0]])]
            k = np.searchsorted(ranks, r[rows], "right") - 1
            sequence[rows], offset[rows] = first[k] + r[rows] - ranks[k], at[k]
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    placed = ranked.withColumn("_at", place("length", "_rank"))
    own = [F.col(f"`{c}`") for c in pieces.columns if c not in ("sequence_id", "offset")]
    return placed.select(*own, F.col("_at.sequence_id").alias("sequence_id"), F.col("_at.offset").alias("offset"))


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, cache_words: int = CACHE_WORDS) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, piece, start, length, ids_crc32): each text's ids and a closing id 0, cut every
    `capacity` ids. A null text is empty: its only id is 0. cache_words trades a worker's memory for time, never ids."""

    def start():
        words = WordIds(tokenizer, cache_words)
        end, step = np.array([END], "<u4").tobytes(), 4 * capacity

        def work(doc_ids, texts):
            rows = []
            for doc, ids in zip(doc_ids, words.ids_bytes(texts), strict=True):
                data = ids + end
                for k in range(0, len(data), step):
                    part = data[k : k + step]
                    rows.append((doc, k // step, k // 4, len(part) // 4, zlib.crc32(part)))
            return list(zip(*rows, strict=True)) if rows else [[]] * 5

        return work

    return by_batch(docs, ["doc_id", "text"], "doc_id long, piece int, start long, length long, ids_crc32 long", start)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, nodes: int = 3000, cache_words: int = CACHE_WORDS) -> DataFrame:
    """Tokenize, cut and pack all documents. Rows with one doc_id are documents of their own."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    pieces = written(token_pieces(docs, tokenizer, capacity, cache_words))
    keyed = pieces.withColumn("key", F.xxhash64("doc_id", "piece"))
    return pack(keyed, capacity=capacity, nodes=nodes).drop("key")


def op10_pack(spark, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 2048 tokens."""
    return pack_documents(read_table(spark, sf_dir, "documents"))

"""Suffix-array dedup: bytes that lie in a 400-byte string which starts anywhere else too are removed.

Equal strings must meet in one task without moving all suffixes. Each window of a given size is anchored at the least
hash of the 24-byte strings inside it, which depends on nothing outside; an anchor serves the next windows too, so there
are two anchors to a window's bytes. Windows of an anchor that lie alike around it share a core, a long string known
from the anchor:

1. Windows of 240 bytes: cores of 146 bytes or more that occur nowhere else are passed over (rows dealt by ranges of the
   core's hash, so that a frequent core is no single task's). A 400-byte window all of whose 240-byte windows have a core
   elsewhere goes on.
2. What is left is keyed by cores of 377 bytes. With the core as one symbol, the 24 windows around it are strings of at
   most 47 symbols, each window being 24 of them. Equal strings are counted before they move.
3. In each task the strings are laid out in shards; each shard's Burrows-Wheeler transform is sorted once, and the shards
   are merged by interleave refinement (see bwt). Places whose common prefix reaches 24 symbols are intervals of equal
   windows; an interval of two windows or more is repeated, and its windows are removed where they occur.
4. A core with very many different strings (the edge of a passage that many documents share) would fill a task. Such
   cores are found by a sample of the strings' hashes before anything is dealt; their windows are dealt one by one, by
   core, offset and a hash of the 23 bytes around the core, and counted before they move, so equal windows still meet.

Copies of a text are one text that counts as often as it occurs. Defined results: a null text is empty; documents shorter
than 400 bytes lose nothing; rows that repeat are documents of their own, so long ones are removed in each; other columns
are ignored. Texts and cores are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bwt import repeated
from .shared import WORD, by_batch, discard, give_back, read_table, tidy, written

LENGTH = 400
#: Windows of the first step. A passage of over 50 words is this long or longer, whatever is removed.
PASSAGE = 240
GRAM = 24
COARSE, FINE = 95, 24
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_PLACE_BITS = 22


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 24 bytes from each offset on."""
    n = len(data) - 7
    eight = np.empty(n, "uint64")
    for k in range(8):
        part = data[k : k + (n - k + 7) // 8 * 8]
        eight[k::8] = part[: len(part) // 8 * 8].view("<u8")[: len(eight[k::8])]
    m = len(data) - GRAM + 1
    h = eight[:m] * _A
    h ^= h >> np.uint64(29)
    h += eight[8 : 8 + m] * _B
    h ^= h >> np.uint64(32)
    h += eight[16 : 16 + m]
    h *= _C
    h ^= h >> np.uint64(31)
    return h


def anchors(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first, last): runs of window starts with one anchor, for all starts 0..len(data) - length."""
    width, total = length - GRAM + 1, len(data) - length + 1
    found = []
    step = (1 << _PLACE_BITS) - length
    for begin in range(0, max(0, total), step):
        part = np.frombuffer(data, "uint8", min(len(data), begin + step + length - 1) - begin, begin)
        h = _gram_hashes(part)
        n = len(h) - width + 1
        # The least of each `width` hashes, the leftmost of equal ones: least of a block's end and the next one's start.
        packed = (h & ~np.uint64((1 << _PLACE_BITS) - 1)) | np.arange(len(h), dtype="uint64")
        blocks = -(-len(h) // width)
        padded = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[: len(h)] = packed
        grid = padded.reshape(blocks, width)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])
        place = (least & np.uint64((1 << _PLACE_BITS) - 1)).astype("int64")
        edge = np.flatnonzero(np.diff(place)) + 1
        first = np.append(0, edge)
        found.append((place[first] + begin, first + begin, np.append(edge, n) - 1 + begin))
    if not found:
        none = np.zeros(0, "int64")
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _classes(anchor: int, first: int, last: int, width: int):
    """(class, lo, hi): the offsets anchor - start of a run, cut at multiples of width."""
    lo, top = anchor - last, anchor - first
    while lo <= top:
        c = lo // width
        hi = min(top, (c + 1) * width - 1)
        yield c, lo, hi
        lo = hi + 1


def _core_rows(docs: DataFrame, length: int) -> DataFrame:
    """(core, rid, at) for each anchor of windows of `length` and coarse class; at packs anchor and offsets."""

    def start():
        import xxhash

        digest = xxhash.xxh3_64_intdigest

        def work(rids, texts):
            cores, owners, ats = [], [], []
            for rid, text in zip(rids, texts, strict=True):
                data = (text or "").encode("utf-8", "replace")
                if len(data) < length:
                    continue
                for anchor, first, last in zip(*(x.tolist() for x in anchors(data, length)), strict=True):
                    for c, lo, hi in _classes(anchor, first, last, COARSE):
                        begin = anchor - c * COARSE
                        cores.append(digest(data[begin : begin + length - COARSE + 1], seed=c) - (1 << 63))
                        owners.append(rid)
                        ats.append(anchor << 20 | lo << 10 | hi)
            return [cores, owners, ats]

        return work

    return by_batch(docs, ["rid", "text"], "core long, rid long, at long", start)


def _not_alone(rows: DataFrame) -> DataFrame:
    """(core, rid, at) of rows whose core other rows have too, and a few more where a task or batch ends."""

    @tidy
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            core = batch.column(0).to_numpy(zero_copy_only=False)
            if len(core):
                equal = core[1:] == core[:-1]
                keep = np.append(False, equal) | np.append(equal, False)
                keep[0] = keep[-1] = True
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in batch.columns], names=["core", "rid", "at"])

    return rows.repartitionByRange("core", "rid", "at").sortWithinPartitions("core").mapInArrow(run, "core long, rid long, at long")


def _shared_places(docs: DataFrame, length: int, broadcast_rows: int) -> DataFrame:
    """docs(rid, text) -> (rid, ats, shared): the window starts of a text that have a core elsewhere, packed, and how many
    of them have it in another document."""
    rows = written(_core_rows(docs, length))  # dealing by ranges reads them twice
    # Copies of a text have one rid.
    found = written(_not_alone(rows).groupBy("core", "rid", "at").agg(F.count("*").alias("copies")))
    discard(rows)
    across = (F.min("rid") < F.max("rid")) | (F.max("copies") > 1)
    cores = written(found.groupBy("core").agg(F.sum("copies").alias("n"), across.alias("across")).where("n > 1").select("core", "across"))
    cores = F.broadcast(cores) if cores.count() <= broadcast_rows else cores.hint("merge")
    windows = F.expr("(at & 1023) - ((at >> 10) & 1023) + 1")
    # At most a few for each 95 bytes of a text; each window start is in one of them.
    places = found.join(cores, "core").groupBy("rid").agg(F.collect_list("at").alias("ats"), F.sum(F.when(F.col("across"), windows).otherwise(0)).alias("shared"))
    out = written(places)
    discard(found)
    return out


def candidate_runs(data: bytes, ats, length: int, passage: int) -> list[tuple[int, int, int]]:
    """(anchor, first, last) of the runs of window starts to look at: all windows of `passage` bytes inside a window of
    `length` are among ats."""
    total, inside = len(data) - length + 1, length - passage + 1
    if total <= 0:
        return []
    x = np.array(ats, "int64")
    change = np.zeros(len(data) - passage + 2, "int32")
    np.add.at(change, (x >> 20) - (x & 1023), 1)
    np.add.at(change, (x >> 20) - (x >> 10 & 1023) + 1, -1)
    found = np.append(0, np.cumsum(np.cumsum(change[:-1]) > 0))
    ok = found[inside : inside + total] - found[:total] == inside
    if not ok.any():
        return []
    anchor, first, last = anchors(data, length)
    own = np.where(ok, np.repeat(anchor, last - first + 1), -1)
    edge = np.flatnonzero(np.diff(own)) + 1
    begin, end = np.append(0, edge), np.append(edge, total) - 1
    keep = own[begin] >= 0
    return list(zip(own[begin][keep].tolist(), begin[keep].tolist(), end[keep].tolist(), strict=True))


def _window_rows(docs: DataFrame, length: int, passage: int) -> DataFrame:
    """docs(rid, text, copies, ats) -> (core, left, right, whole, rid, at, copies): the fine classes. left ends where the
    core begins; whole is a hash of all three; at is the text position where left begins."""

    def start():
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        size = length - FINE + 1

        def work(rids, texts, copies, ats):
            out = []
            for rid, text, n, packed in zip(rids, texts, copies, ats, strict=True):
                data = (text or "").encode("utf-8", "replace")
                for anchor, first, last in candidate_runs(data, packed, length, passage):
                    for c, a, b in _classes(anchor, first, last, FINE):
                        begin = anchor - c * FINE
                        core = digest(data[begin : begin + size], seed=c) - (1 << 63)
                        left, right = data[anchor - b : begin], data[begin + size : anchor - a + length]
                        out.append((core, left, right, digest(left + b"|" + right, seed=(core ^ len(left)) & 0xFFFFFFFF) - (1 << 63), rid, anchor - b, n))
            return list(zip(*out, strict=True)) if out else [[]] * 7

        return work

    schema = "core long, left binary, right binary, whole long, rid long, at long, copies long"
    return by_batch(docs, ["rid", "text", "copies", "ats"], schema, start, rows=200)


def _repeated_windows(strings: DataFrame, shard_symbols: int, task_symbols: int) -> DataFrame:
    """strings(core, left, right, whole, n) -> (core, whole, mask): bit k of mask says that the window k bytes after
    left's first byte is repeated. Cores come together; shards of several cores are merged at a time."""

    def solve(cores, lefts, rights, wholes, counts):
        ids = {c: 257 + i for i, c in enumerate(dict.fromkeys(cores))}  # a core is a symbol above the bytes
        laid = []
        for c, left, right in zip(cores, lefts, rights, strict=True):
            x = np.empty(len(left) + 1 + len(right), "uint16")
            x[: len(left)] = np.frombuffer(left, "uint8")
            x[len(left)] = ids[c] - 1
            x[len(left) + 1 :] = np.frombuffer(right, "uint8")
            laid.append(x + 1)
        for core, whole, flags in zip(cores, wholes, repeated(laid, np.array(counts), FINE, shard_symbols), strict=True):
            mask = int(np.bitwise_or.reduce(np.left_shift(1, np.flatnonzero(flags)))) if flags.any() else 0
            if mask:
                yield core, whole, mask

    @tidy
    def run(batches):
        import pyarrow as pa

        rows, symbols, last, n_cores = [], 0, None, 0

        def flush():
            got = list(solve(*zip(*rows, strict=True)))
            if got:
                return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*got, strict=True)], names=["core", "whole", "mask"])
            return None

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != last:
                    if symbols >= task_symbols or n_cores >= 60_000:
                        if out := flush():
                            yield out
                        rows, symbols, n_cores = [], 0, 0
                    last, n_cores = row[0], n_cores + 1
                rows.append(row)
                symbols += len(row[1]) + len(row[2]) + 2
        if rows and (out := flush()):
            yield out

    return strings.select("core", "left", "right", "whole", "n").mapInArrow(run, "core long, whole long, mask long")


def _crowded_cores(rows: DataFrame, most_strings: int) -> DataFrame:
    """(core) of cores with more than about most_strings different strings, from one string in most_strings / 32. Which
    way a core goes does not change the result."""
    share = max(1, most_strings // 32)
    sample = rows.where(F.pmod("whole", F.lit(share)) == 0).select("core", "whole").distinct()
    return sample.groupBy("core").agg((F.count("*") * share).alias("n")).where(F.col("n") > most_strings).select("core")


def _windows_one_by_one(counted: DataFrame) -> DataFrame:
    """strings(core, left, right, whole, n) -> (core, whole, mask), as _repeated_windows, with no group of a core: each
    window is a row, and what comes together is (core, window). A window that comes once gives its bit back."""
    size = F.length("left") + F.length("right") - (FINE - 2)
    around = F.expr(f"concat(substring(left, k + 1, length(left) - k), substring(right, 1, k + {FINE - 1} - length(left)))")
    rows = counted.select("core", "whole", "left", "right", "n", F.explode(F.sequence(F.lit(0), (size - 1).cast("int"))).alias("k"))
    windows = rows.select("core", F.xxhash64(F.length("left") - F.col("k"), around).alias("window"), "whole", "k", "n")
    single = windows.groupBy("core", "window").agg(F.sum("n").alias("n"), F.min("whole").alias("whole"), F.min("k").alias("k")).where("n = 1")
    every = counted.select("core", "whole", (F.expr("shiftleft(1L, cast(length(left) + length(right) as int) - %d)" % (FINE - 2)) - 1).alias("all"), F.lit(0).cast("long").alias("one"))
    ones = single.select("core", "whole", F.lit(0).cast("long").alias("all"), F.expr("shiftleft(1L, k)").alias("one"))
    both = every.union(ones).groupBy("core", "whole").agg(F.bit_or("all").alias("all"), F.bit_or("one").alias("one"))
    return both.select("core", "whole", F.col("all").bitwiseAND(F.bitwise_not("one")).alias("mask")).where("mask <> 0")


def spans_of(ats: list[int], masks: list[int], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(begins, ends) of the removed runs: windows that overlap or touch are one."""
    bits = (np.array(masks, "int64")[:, None] >> np.arange(FINE)) & 1
    row, k = np.nonzero(bits)
    starts = np.unique(np.array(ats, "int64")[row] + k)
    edge = np.flatnonzero(np.diff(starts) > length)
    return starts[np.append(0, edge + 1)], starts[np.append(edge, len(starts) - 1)] + length


def removed_spans(docs: DataFrame, *, length: int = LENGTH, passage: int = PASSAGE, shard_symbols: int = 100_000, task_symbols: int = 400_000, most_strings: int = 2048, broadcast_cores: int = 1_000_000) -> DataFrame:
    """docs(rid, text), rid a hash of the text -> (rid, begins, ends, shared) of the texts that lose bytes or share
    windows of `passage` bytes: removed runs (null: none), and how many windows share a core with another document."""
    passage = min(passage, length)
    places = _shared_places(docs, passage, broadcast_cores)
    # Of the copies of a text one is kept before texts move.
    texts = docs.where(F.octet_length("text") >= length).groupBy("rid").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    rows = written(_window_rows(texts.join(places.hint("merge"), "rid"), length, passage))
    # Equal strings are counted first; a core that comes once only has nothing to be equal to.
    count = lambda r: r.groupBy("core", "left", "right", "whole").agg(F.sum("copies").alias("n"))
    crowded, few = written(_crowded_cores(rows, most_strings)), rows
    n = crowded.count()
    if n:
        crowded = F.broadcast(crowded) if n <= broadcast_cores else crowded
        few = rows.join(crowded, "core", "left_anti")
    dealt = count(few).repartition("core").sortWithinPartitions("core", "whole")
    masks = _repeated_windows(dealt, shard_symbols, task_symbols)
    if n:
        masks = masks.union(_windows_one_by_one(count(rows.join(crowded, "core", "left_semi"))))
    masks = written(masks)
    hit = rows.select("core", "whole", "rid", "at").join(masks, ["core", "whole"])
    hits = hit.groupBy("rid").agg(F.collect_list("at").alias("ats"), F.collect_list("mask").alias("masks"))  # at most one for each byte of a text

    def start():
        def work(rids, ats, masks_):
            spans = [spans_of(a, m, length) for a, m in zip(ats, masks_, strict=True)]
            return [rids, [s[0].tolist() for s in spans], [s[1].tolist() for s in spans]]

        return work

    spans = by_batch(hits, ["rid", "ats", "masks"], "rid long, begins array<long>, ends array<long>", start, rows=500)
    out = written(spans.join(places.select("rid", "shared"), "rid", "full").where("begins is not null or shared > 0"))
    discard(rows, masks, places)
    return out


def _with_spans(docs: DataFrame, columns: list[str], length: int, broadcast_rows: int, **options) -> DataFrame:
    docs = docs.select(*columns, F.xxhash64("text").alias("rid"))
    spans = removed_spans(docs.select("rid", "text"), length=length, **options)
    n = spans.agg(F.coalesce(F.sum(1 + F.coalesce(F.size("begins"), F.lit(0))), F.lit(0))).first()[0]
    return docs.join(F.broadcast(spans) if n <= broadcast_rows else spans.hint("merge"), "rid", "left")


def cut(data: bytes, begins, ends) -> tuple[bytes, int, int]:
    """(what is left, bytes removed, removed runs)."""
    if begins is None or not len(begins):
        return data, 0, 0
    kept = b"".join([data[a:b] for a, b in zip([0, *ends], [*begins, len(data)], strict=True)])
    return kept, len(data) - len(kept), len(begins)


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, broadcast_rows: int = 1_000_000, **options) -> DataFrame:
    """doc_id, kept (binary: the bytes that stay), n_bytes, n_removed, n_spans for every row of docs(doc_id, text), and
    n_shared_windows: how many 240-byte windows have a core of 146 bytes or more in another document as well. It is above
    0 for every text that shares 240 bytes with another one, though nothing is removed for fewer than 400."""
    joined = _with_spans(docs, ["doc_id", "text"], length, broadcast_rows, **options)

    def start():
        def work(doc_ids, texts, begins, ends, shared):
            data = [(t or "").encode("utf-8", "replace") for t in texts]
            out = [cut(*x) for x in zip(data, begins, ends, strict=True)]
            return [doc_ids, [o[0] for o in out], [len(d) for d in data], [o[1] for o in out], [o[2] for o in out], [n or 0 for n in shared]]

        return work

    return by_batch(joined, ["doc_id", "text", "begins", "ends", "shared"], "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long, n_shared_windows long", start, rows=200)


def without_repeats(docs: DataFrame, *, length: int = LENGTH, broadcast_rows: int = 1_000_000, **options) -> DataFrame:
    """docs with repeated bytes removed from `text` (a character that is cut is dropped) and n_chars, where it is a
    column, counted again. Documents left without a word by it go; all other rows and columns stay."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    joined = _with_spans(docs.select("doc_id", "text", whole), ["doc_id", "text", "_row"], length, broadcast_rows, **options)

    @F.arrow_udf("string")
    def rest(texts, begins, ends):
        import pyarrow as pa

        rows = zip(texts.to_pylist(), begins.to_pylist(), ends.to_pylist(), strict=True)
        out = pa.array([t if a is None or not t else cut(t.encode("utf-8", "replace"), a, b)[0].decode("utf-8", "ignore") for t, a, b in rows], pa.string())
        give_back()
        return out

    hit = F.col("begins").isNotNull()
    # Only texts that lose something go through Python.
    out = joined.select("_row", hit.alias("_hit"), F.when(hit, rest(F.when(hit, F.col("text")), "begins", "ends")).otherwise(F.col("text")).alias("_text")).where(~F.col("_hit") | F.col("_text").rlike(WORD))
    kinds = dict(docs.dtypes)
    own = {"text": F.col("_text"), "n_chars": F.when(F.col("_hit"), F.char_length("_text")).otherwise(F.col("_row.n_chars")).cast(kinds["n_chars"]) if "n_chars" in kinds else None}
    return out.select(*[own[c].alias(c) if own.get(c) is not None else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Digest of what is left of every document."""
    out = remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_shared_windows")

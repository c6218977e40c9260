"""Document fingerprints: bottom-k sketches of word shingles, with DataFrame functions only.

A text's shingles are its runs of five words (a shorter text is one shingle; a text without words has none). Each
shingle is hashed to 48 bits; the sketch is the k smallest distinct hashes in ascending order. Sketches of parts merge
into the sketch of the whole (`merged`, or `merge_rows` as an aggregate), and estimate resemblance, containment and the
number of distinct shingles. Up to k distinct shingles every estimate is exact.

Defined results: a null text counts as empty; two empty sketches resemble each other fully (equal texts have equal
fingerprints); an empty sketch is contained in anything. Other columns of an input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import SPACE, read_table

SHINGLE_WORDS = 5
K = 128
BITS = 48


def sketch(text: Column, k: int = K, words: int = SHINGLE_WORDS) -> Column:
    """array<long>: the k smallest distinct shingle hashes of a text."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), f"^[{SPACE}]+|[{SPACE}]+$", "")
    hashed = F.transform(F.split(plain, f"[{SPACE}]+"), lambda w: F.xxhash64(w))

    def shingle(h: Column) -> Column:
        def one(first: Column, i: Column) -> Column:
            mixed = F.xxhash64(first, *[F.get(h, i + j) for j in range(1, words)])
            return F.shiftrightunsigned(mixed, 64 - BITS)

        # A short text is one shingle: get() beyond the end is null, which the hash skips.
        return F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - (words - 1), F.lit(1))), one)

    none = F.array().cast("array<bigint>")
    # The hashes of the words are bound by a one-element transform, so that they are computed once.
    bound = F.transform(F.array(hashed), shingle)[0]
    return F.when(plain == "", none).otherwise(smallest(F.array_distinct(bound), k))


def smallest(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(hashes), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return smallest(F.array_union(a, b), k)


def merge_rows(df: DataFrame, key: str, sketch_column: str, k: int = K) -> DataFrame:
    """(key, sketch): the sketches of each key's rows merged. Hashes are made distinct before the shuffle and at most k
    of each key leave a task, so a key with very many rows is no burden."""
    hashes = df.select(F.col(key).alias("key"), F.explode_outer(sketch_column).alias("hash")).distinct()
    rank = F.row_number().over(W.partitionBy("key").orderBy(F.col("hash").asc_nulls_last()))
    kept = hashes.withColumn("rank", rank).where(F.col("rank") <= k)
    return kept.groupBy("key").agg(F.sort_array(F.collect_list("hash")).alias("sketch")).withColumnRenamed("key", key)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Of the k smallest hashes of both together, the share that both hold."""
    def share(both: Column) -> Column:
        union = smallest(F.array_union(both.a, both.b), k)
        shared = F.size(F.array_intersect(F.array_intersect(both.a, both.b), union))
        return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(shared / F.greatest(F.size(union), F.lit(1)))

    return F.transform(F.array(F.struct(a.alias("a"), b.alias("b"))), share)[0]


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: the size below k, else from the k-th smallest hash."""
    kth = (F.element_at(a, -1) + 1) / F.lit(float(2**BITS))
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((F.size(a) - 1) / kth)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds too."""
    both = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """Twelve hexadecimal digits a hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), BITS // 4, "0")), "")


def _range(key: Column, cuts: list[int]) -> Column:
    """How many cuts lie below key, by halving the ascending cuts."""
    if not cuts:
        return F.lit(0)
    table = F.array(*[F.lit(c) for c in cuts])
    found, step = F.lit(0), 1 << (len(cuts).bit_length() - 1)

    def halved(by: int):
        # get() beyond the end is null, which is not below.
        return lambda f: F.when(F.get(table, f + (by - 1)) < key, f + by).otherwise(f)

    while step:
        found = F.transform(F.array(found), halved(step))[0]
        step //= 2
    return found


def with_next(docs: DataFrame, own: list[Column], range_rows: int = 2000, most_ranges: int = 20_000) -> DataFrame:
    """(own, next): structs of the columns `own` (text among them) of each document and of the next one, by descending
    doc_id, after the last the first. Documents are dealt into ranges of doc_id, and the top row of a range also goes to
    the range above, whose last row it follows: ranges are worked alone, and a row moves once. Rows with one doc_id go by
    text; a null doc_id is last."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    ids = docs.select(key.alias("id"))
    parts = min(most_ranges, max(1, ids.count() // range_rows))
    cuts = ids.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)], 10_000)).first()[0] if parts > 1 else []
    cuts = sorted(set(cuts))
    tops = ids.groupBy(_range(F.col("id"), cuts).alias("range")).agg(F.max("id").alias("top"))
    ranges = W.orderBy("range")
    lowest = F.min("range").over(ranges.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    tops = tops.select("range", "top", F.coalesce(F.lead("range").over(ranges), lowest).alias("up"))
    rows = docs.select(key.alias("id"), _range(key, cuts).alias("range"), F.struct(*own).alias("own"))
    here = F.struct(F.col("range").alias("at"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("up").alias("at"), F.lit(True).alias("guest"))
    # Broadcast: at most most_ranges rows of three numbers.
    dealt = rows.join(F.broadcast(tops), "range").select(
        "id", "own", F.explode(F.when(F.col("id") == F.col("top"), F.array(here, guest)).otherwise(F.array(here))).alias("to")
    )
    order = W.partitionBy("to.at").orderBy("to.guest", F.col("id").desc(), F.col("own.text").desc_nulls_last())
    return dealt.select("own", F.lead("own").over(order).alias("next"), F.col("to.guest").alias("guest")).where(~F.col("guest")).drop("guest")


def op5_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprint every document and its edited text: the last third replaced by the start of the next document."""
    docs = read_table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    # Only texts move; a sketch is cheaper to make again than to shuffle.
    pairs = with_next(docs, [F.col("doc_id"), text.alias("text")])
    n, third = F.char_length("own.text"), F.floor(F.char_length("own.text") / 3).cast("int")
    edited = F.concat(F.substring(F.col("own.text"), F.lit(1), n - third), F.substring(F.col("next.text"), F.lit(1), third))
    rows = pairs.withColumn("edited", edited)
    for name, of in (("own_sketch", "own.text"), ("next_sketch", "next.text"), ("edited_sketch", "edited")):
        rows = rows.withColumn(name, sketch(F.col(of)))
    return rows.select(
        F.col("own.doc_id").alias("doc_id"),
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("own_sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("own_sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("own_sketch"), F.col("next_sketch")).alias("near_next"),
    )

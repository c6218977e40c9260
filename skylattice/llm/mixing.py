"""Mixing sources to target weights with DataFrame operations only.

The words of each source, its documents put one after another, are cut into blocks of a fixed length. Output shards
have a fixed number of slots. Each slot draws a source, so the counts per shard are multinomial; a small surplus of the
sources drawn too often is handed to those drawn too seldom, so that the whole mix meets the targets. The j-th slot of
a source takes the block at place j of a pseudorandom permutation of its block numbers (a new permutation for each
pass over the source), and a join by block number brings in the words.

Defined results: a null text has no words; a document without words takes nothing; a null source is a source of its own,
ordered last; rows that repeat are separate documents; an empty table gives an empty mix. Other columns of the input
are ignored by `mix` and carried by `mixed_texts`, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import SPACE, read_table, word_count, written


@dataclass
class Mix:
    """documents: a row per document with what is taken of it; slots: the mix itself (shard, slot, source, block);
    pieces: which words of which document each block holds, with the passes that take it; row is the document's hash."""

    documents: DataFrame
    slots: DataFrame
    pieces: DataFrame


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, limit: float) -> DataFrame:
    """sizes(source, source_size) -> + sid, weight, target. Targets share share * all sizes by weight; none is above
    limit * its size: what is cut off goes to the others by weight (water filling, in closed form over the sources
    ordered by how soon they are full). One row per source goes through the window, whatever the table's size."""
    ordered = sizes.withColumn("sid", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())).cast("long") - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    full = ordered.withColumn("weight", weight).withColumn("_full", F.col("source_size") * F.lit(float(limit)))
    by_full = W.orderBy(F.col("_full") / F.col("weight"), "sid")
    everything = by_full.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) * F.lit(float(share))
        - F.coalesce(F.sum("_full").over(by_full.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    ) / F.sum("weight").over(by_full.rowsBetween(0, W.unboundedFollowing))
    leveled = full.withColumn("_level", level)
    return leveled.withColumn("target", F.least("_full", F.max("_level").over(everything) * F.col("weight"))).drop("_full", "_level")


def permuted(index: Column, size: Column, *key: Column, rounds: int = 24) -> Column:
    """A pseudorandom permutation of 0..size-1 at index: the swap-or-not shuffle. In each round a number and its mirror
    at a keyed point are exchanged, or not, by a keyed bit of the larger of the two."""

    def one_round(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(*key, r), size) - x, size)
        return F.when(F.xxhash64(*key, r, F.greatest(x, mirror)) % 2 == 0, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index, one_round)


def _draw(sources: DataFrame, n_slots: int, n_sources: int, shard_slots: int, seed: int) -> DataFrame:
    """(shard, slot, sid, nth): a source for each slot, drawn by quota, and its number within that source."""
    spark = sources.sparkSession
    upto = F.sum("quota").over(W.orderBy("sid").rowsBetween(W.unboundedPreceding, 0))
    ranges = sources.select("sid", "quota", (upto - F.col("quota")).alias("lo"), upto.alias("hi")).where("quota > 0")
    width = max(1, -(-n_slots // max(1, 4 * n_sources)))  # a draw meets the few sources of its bin only
    binned = ranges.withColumn("bin", F.explode(F.expr(f"sequence(lo div {width}L, (hi - 1) div {width}L)")))
    slots = spark.range(n_slots).select(
        F.expr(f"id div {shard_slots}L").alias("shard"),
        F.col("id").alias("slot"),
        F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(max(1, n_slots))).alias("draw"),
    )
    drawn = (
        slots.withColumn("bin", F.expr(f"draw div {width}L"))
        .join(binned, "bin")
        .where("draw >= lo and draw < hi")
        .select("shard", "slot", "sid", "quota")
    )
    counts = drawn.groupBy("shard", "sid").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("sid").orderBy("shard").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")
    nth = F.row_number().over(W.partitionBy("shard", "sid").orderBy("slot")) - 1
    numbered = (
        drawn.withColumn("k", nth)
        .join(counts.select("shard", "sid", before.alias("base")), ["shard", "sid"])
        .select("shard", "slot", "sid", "quota", (F.col("base") + F.col("k")).alias("nth"))
    )
    got = counts.groupBy("sid").agg(F.sum("n").alias("got"))
    over = W.orderBy("sid").rowsBetween(W.unboundedPreceding, 0)
    balance = (
        ranges.join(got, "sid", "left")
        .select("sid", "quota", F.coalesce("got", F.lit(0)).alias("got"))
        .withColumn("surplus", F.greatest(F.col("got") - F.col("quota"), F.lit(0)))
        .withColumn("missing", F.greatest(F.col("quota") - F.col("got"), F.lit(0)))
        .withColumn("surplus_from", F.sum("surplus").over(over) - F.col("surplus"))
        .withColumn("missing_from", F.sum("missing").over(over) - F.col("missing"))
    )
    spare = (
        numbered.where("nth >= quota")
        .join(balance.select("sid", "surplus_from"), "sid")
        .select("shard", "slot", (F.col("surplus_from") + F.col("nth") - F.col("quota")).alias("place"))
    )
    needs = (
        balance.where("missing > 0")
        .select("sid", "got", "missing_from", F.explode(F.expr("sequence(0L, missing - 1)")).alias("i"))
        .select("sid", (F.col("missing_from") + F.col("i")).alias("place"), (F.col("got") + F.col("i")).alias("nth"))
    )
    moved = spare.join(needs, "place").select("shard", "slot", "sid", "nth")
    return numbered.where("nth < quota").select("shard", "slot", "sid", "nth").unionByName(moved)


def mix(
    docs: DataFrame,
    *,
    block_words: int = 2048,
    shard_slots: int = 65536,
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    limit: float = 2.0,
    seed: int = 20240607,
    bucket_rows: int = 5000,
    row: Column | None = None,
) -> Mix:
    """Mix docs(doc_id, text, source). A source's words come within about a block of its target. row tells documents
    apart, a long; else a hash of doc_id, source and text does."""
    row = F.xxhash64("doc_id", "source", "text") if row is None else row
    sized = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), row.alias("row")))
    n_rows = sized.count()
    n_buckets = min(100_000, max(1, -(-n_rows // bucket_rows)))
    sized = sized.withColumn("bucket", F.pmod("row", F.lit(n_buckets)))
    segments = sized.groupBy("source", "bucket").agg(F.sum("size").alias("segment_size"))
    sources = source_targets(segments.groupBy("source").agg(F.sum("segment_size").alias("source_size")), weights, share, limit)
    blocks = F.expr(f"cast(ceil(source_size / {float(block_words)}D) as long)")
    quota = F.least(F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long"), F.floor(F.col("blocks") * F.lit(float(limit))))
    sources = written(sources.withColumn("blocks", blocks).withColumn("quota", F.when(F.col("source_size") > 0, quota).otherwise(F.lit(0)).cast("long")))
    n_slots, n_sources = sources.agg(F.coalesce(F.sum("quota"), F.lit(0)), F.count("*")).first()

    # Where each document lies in its source's words: whole segments before it, then the documents before it.
    segment_from = F.sum("segment_size").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)) - F.col("segment_size")
    at = segments.select("source", "bucket", segment_from.alias("segment_from"))
    s, a = sources.alias("s"), at.alias("a")
    at = a.join(s, F.col("a.source").eqNullSafe(F.col("s.source"))).select("a.*", "s.sid", "s.source_size", "s.target")
    inside = F.sum("size").over(W.partitionBy("source", "bucket").orderBy("row").rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    d, a = sized.withColumn("inside", inside).alias("d"), at.alias("a")
    placed = d.join(a, F.col("d.source").eqNullSafe(F.col("a.source")) & (F.col("d.bucket") == F.col("a.bucket"))).select(
        "d.doc_id", "d.size", "d.row", "a.sid", "a.source_size", "a.target", (F.col("a.segment_from") + F.col("d.inside")).alias("start")
    )

    drawn = _draw(sources.select("sid", "quota"), int(n_slots), int(n_sources), shard_slots, seed)
    index, turn = F.col("nth") % F.col("blocks"), F.expr("nth div blocks")
    slots = drawn.join(sources.select("sid", "source", "blocks"), "sid").select(
        "shard", "slot", "sid", "source", permuted(index, F.col("blocks"), F.lit(seed), F.col("sid"), turn).alias("block")
    )
    times = slots.groupBy("sid", "block").agg(F.count("*").alias("times"))

    b = block_words
    spread = placed.withColumn("block", F.explode_outer(F.expr(f"if(size > 0, sequence(start div {b}L, (start + size - 1) div {b}L), null)")))
    pieces = spread.join(times, ["sid", "block"], "left").select(
        "sid", "start", "doc_id", "size", "row", "source_size", "target", "block",
        F.coalesce("times", F.lit(0)).alias("times"),
        (F.greatest(F.expr(f"block * {b}L"), F.col("start")) - F.col("start")).alias("from_word"),
        (F.least(F.expr(f"(block + 1) * {b}L"), F.col("start") + F.col("size")) - F.col("start")).alias("to_word"),
    )
    taken = F.coalesce(F.sum(F.col("times") * (F.col("to_word") - F.col("from_word"))), F.lit(0)).cast("long")
    # Documents without words may share a place with another; only those are told apart by nothing but their row.
    with_words = pieces.where("size > 0").groupBy("sid", "start", "doc_id", "size", "source_size", "target").agg(taken.alias("taken"))
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    without = placed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return Mix(with_words.select(columns).unionByName(without.select(columns)), slots, pieces.where("size > 0"))


def mixed_texts(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows with the columns of docs: one row for each run of a document's words that a pass takes. A text
    keeps the white space between its words; n_chars, where it is a column, counts the row's own characters.

    A document is told by a hash of all its columns (maps left out), so what repeats is the same row: its runs are all
    cut from one copy."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind])
    pieces = mix(docs, row=row, **options).pieces.where("times > 0")
    turns = pieces.withColumn("turn", F.explode(F.expr("sequence(1L, times)")))
    by_turn = W.partitionBy("sid", "start", "turn").orderBy("block")
    runs = (
        turns.withColumn("run", F.col("block") - F.row_number().over(by_turn))
        .groupBy("row", "sid", "start", "size", "turn", "run")
        .agg(F.min("from_word").alias("from_word"), F.max("to_word").alias("to_word"))
        .select(F.col("row").alias("_of"), "size", "from_word", "to_word")
    )
    mine = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(mine, row.alias("_hash"), word_count(F.col("text")).alias("_size")).where("_size > 0")
    rows = rows.withColumn("_nth", F.row_number().over(W.partitionBy("_hash").orderBy("_size"))).where("_nth = 1")
    joined = rows.join(runs, F.col("_hash") == F.col("_of"))
    words = F.split(F.regexp_replace(F.col("_row.text"), f"^[{SPACE}]+", ""), f"(?<=[{SPACE}])(?=[^{SPACE}])")
    cut = F.array_join(F.slice(words, (F.col("from_word") + 1).cast("int"), (F.col("to_word") - F.col("from_word")).cast("int")), "")
    whole = (F.col("from_word") == 0) & (F.col("to_word") == F.col("size"))
    text = F.when(whole, F.col("_row.text")).otherwise(cut)
    out = joined.withColumn("_text", text)
    kinds = dict(docs.dtypes)
    own = {"text": F.col("_text"), "n_chars": F.char_length("_text").cast(kinds.get("n_chars", "long"))}
    return out.select(*[own[c].alias(c) if c in own else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def op8_mix_sources(spark, sf_dir: str) -> DataFrame:
    """Mix all documents, in blocks of 64 words."""
    return mix(read_table(spark, sf_dir, "documents"), block_words=64).documents

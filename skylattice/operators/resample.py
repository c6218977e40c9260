"""Block bootstrap, threshold grid search and leave-one-out checks, all on additive counts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .metrics import confusion, scores

COUNTS = ("tp", "fp", "fn", "tn", "correct", "total")


def block_counts(pairs: DataFrame, height: int, width: int, size: int) -> DataFrame:
    """Confusion counts of each whole block of size x size pixels; the ragged border is left out."""
    rows, cols = height // size, width // size
    whole = pairs.where((F.col("row") < rows * size) & (F.col("col") < cols * size))
    return whole.groupBy((F.expr(f"row div {size}") * cols + F.expr(f"col div {size}")).cast("long").alias("block")).agg(*confusion())


def bootstrap(blocks: DataFrame, replicates: int, times, level: float = 0.95) -> DataFrame:
    """blocks(block, counts): point, lower and upper of each score. times(replicate, block) says how often a replicate
    draws a block. A replicate adds up its blocks' counts, partly before the one shuffle; no pixel is copied, and one
    pass gives all scores."""
    total = blocks.agg(*[F.sum(c).alias(c) for c in COUNTS]).withColumns(scores())
    each = blocks.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1)))).withColumn("times", times(F.col("replicate"), F.col("block")))
    reps = each.where("times > 0").groupBy("replicate").agg(*[F.sum(F.col(c) * F.col("times")).alias(c) for c in COUNTS]).withColumns(scores())
    return _intervals(total, reps, level)


def _intervals(total: DataFrame, reps: DataFrame, level: float) -> DataFrame:
    names, low = list(scores()), (1 - level) / 2
    bounds = reps.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("v")) for n in names])).alias("m")).groupBy("m.metric").agg(
        F.percentile("m.v", F.lit(low)).alias("lower"), F.percentile("m.v", F.lit(1 - low)).alias("upper")
    )  # of `replicates` numbers a metric
    point = total.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("point")) for n in names])).alias("m")).select("m.*")
    return point.join(bounds, "metric")


def poisson_times(seed: int = 0):
    """times(replicate, block): Poisson of mean 1 from a hash: no list of draws, so any number of blocks will do."""
    steps, p, term = [], 0.0, 0.36787944117144233
    for k in range(12):
        p += term
        steps.append(p)
        term /= k + 1

    def times(replicate: Column, block: Column) -> Column:
        u = (F.xxhash64(F.lit(seed), replicate, block).bitwiseAND(F.lit((1 << 52) - 1)) + 0.5) / float(1 << 52)
        # Drawn once a row, then compared with all steps.
        return F.transform(F.array(u), lambda x: sum((F.when(x > s, 1).otherwise(0) for s in steps), F.lit(0)))[0]

    return times


BLOCKS_A_GROUP = 128


def block_grid(extents: DataFrame, size: int) -> DataFrame:
    """extents(..., height, width) with how many whole blocks a bootstrap keeps, how many it drops (the ragged border,
    counted as a strip on two sides whether or not it is empty) and, where no block is whole, why it cannot run."""
    rows, cols = F.expr(f"height div {size}"), F.expr(f"width div {size}")
    kept = rows * cols
    small = F.format_string(f"raster (%dx%d) too small for blocks of {size}x{size} pixels", "height", "width")
    return extents.withColumns({"kept": kept, "dropped": (rows + 1) * (cols + 1) - kept, "error": F.when(kept == 0, small)})


def _multinomial(seed: int, group: int, n_groups: int, kept: int, size: int, replicates: int, cache: dict) -> np.ndarray:
    """How many of its `kept` draws each replicate takes from a group of blocks. The groups are the leaves of a binary
    tree; at a node the draws go left or right binomially, by a stream of random numbers that the seed and the node
    alone decide. So any task can work out any group by itself, and over all groups a replicate draws `kept` blocks."""
    lo, hi, node = 0, n_groups, 1
    draws = np.full(replicates, kept, "int64")
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = cache.get(node)
        if left is None:
            share = min(kept, mid * size) - lo * size
            whole = min(kept, hi * size) - lo * size
            left = cache[node] = np.random.Generator(np.random.Philox(key=[seed, node])).binomial(draws, share / whole)
        if group < mid:
            draws, hi, node = left, mid, 2 * node
        else:
            draws, lo, node = draws - left, mid, 2 * node + 1
    return draws


def bootstrap_sums(blocks: DataFrame, kept: int, replicates: int, seed: int = 0) -> DataFrame:
    """(replicate, counts): the counts of each replicate's `kept` draws with replacement from blocks(block, counts), whose
    numbers lie below kept; a block without a row counts nothing. The same seed draws the same blocks, however the rows
    are dealt. Groups of blocks are the rows that move; a task gives one row a replicate."""
    columns = [F.col(c).cast("long").alias(c) for c in COUNTS]
    groups = blocks.groupBy(F.expr(f"block div {BLOCKS_A_GROUP}").alias("group")).agg(F.collect_list(F.struct((F.col("block") % BLOCKS_A_GROUP).alias("at"), *columns)).alias("blocks"))
    n_groups = -(-kept // BLOCKS_A_GROUP)

    def run(batches):
        import pyarrow as pa

        total, cache = np.zeros((replicates, len(COUNTS)), "int64"), {}
        for batch in batches:
            for group, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                size = min(kept, (group + 1) * BLOCKS_A_GROUP) - group * BLOCKS_A_GROUP
                counts = np.zeros((size, len(COUNTS)), "int64")
                for r in rows:
                    counts[r["at"]] += [r[c] for c in COUNTS]
                draws = _multinomial(seed, group, n_groups, kept, BLOCKS_A_GROUP, replicates, cache)
                leaf = np.random.Generator(np.random.Philox(key=[seed, 2**63 + group]))
                total += leaf.multinomial(draws, np.full(size, 1 / size)) @ counts
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(replicates))] + [pa.array(np.ascontiguousarray(c)) for c in total.T], names=["replicate", *COUNTS])

    sums = groups.mapInArrow(run, "replicate long, " + ", ".join(f"{c} long" for c in COUNTS))
    return sums.groupBy("replicate").agg(*[F.sum(c).alias(c) for c in COUNTS])


def bootstrap_exact(blocks: DataFrame, kept: int, replicates: int = 500, seed: int = 0, level: float = 0.95) -> DataFrame:
    """(metric, point, lower, upper) of each score: percentile intervals over replicates of exactly `kept` draws."""
    if kept < 1:
        raise ValueError("no whole block: see block_grid")
    total = blocks.agg(*[F.sum(c).alias(c) for c in COUNTS]).withColumns(scores())
    return _intervals(total, bootstrap_sums(blocks, kept, replicates, seed).withColumns(scores()), level)


def threshold_bins(value: Column, thresholds: list[float]) -> Column:
    """How many of the ascending thresholds lie strictly below the value."""
    return sum((F.when(value > F.lit(t), 1).otherwise(0) for t in thresholds), F.lit(0))


def grid_search(pixels: DataFrame, wigt: list[float], awgt: list[float], keys: list[str], by_bits: list[list[bool]]) -> DataFrame:
    """Scores at every (wigt, awgt). pixels: keys, mndwi, awesh, rest (which of the rules by_bits holds for the pixel's
    other bits) and reference 0/1. A rule says whether a pixel is water if it passes [neither, the first, the second,
    both] of the two thresholds.

    One pass bins both indices by the thresholds they pass. Each (keys, rest, reference) then is a table of bins of fixed
    size, whatever the number of pixels; running sums along its two axes leave in each bin how many pixels pass both of
    its thresholds, so a grid point reads one bin of each table instead of adding them all up."""
    hist = pixels.groupBy(*keys, "rest", "reference", threshold_bins(F.col("mndwi"), wigt).alias("wb"), threshold_bins(F.col("awesh"), awgt).alias("ab")).agg(F.count("*").alias("n"))
    tables = [*keys, "rest", "reference"]
    every = hist.select(*tables).distinct()
    every = every.withColumn("wb", F.explode(F.sequence(F.lit(0), F.lit(len(wigt))))).withColumn("ab", F.explode(F.sequence(F.lit(0), F.lit(len(awgt)))))
    dense = every.join(hist, [*tables, "wb", "ab"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    down = W.partitionBy(*tables, "ab")
    dense = dense.withColumns({"below": F.sum("n").over(down.orderBy(F.desc("wb"))), "column": F.sum("n").over(down)})
    across = W.partitionBy(*tables, "wb")
    running = across.orderBy(F.desc("ab"))
    dense = dense.withColumns({"both": F.sum("below").over(running), "first": F.sum("below").over(across), "second": F.sum("column").over(running), "every": F.sum("column").over(across)})
    at = dense.where("wb > 0 and ab > 0")
    wet = lambda k: F.element_at(F.array(*[F.lit(rule[k]) for rule in by_bits]), F.col("rest") + 1).cast("int")
    both, first, second = F.col("both"), F.col("first"), F.col("second")
    water = wet(3) * both + wet(1) * (first - both) + wet(2) * (second - both) + wet(0) * (F.col("every") - first - second + both)
    value = lambda list_, at_: F.element_at(F.array(*[F.lit(float(v)) for v in list_]), F.col(at_))
    hit = lambda p, r: F.sum(F.when(F.col("reference") == r, water if p else F.col("every") - water).otherwise(0))
    counts = at.groupBy(*keys, value(wigt, "wb").alias("wigt"), value(awgt, "ab").alias("awgt")).agg(hit(1, 1).alias("tp"), hit(1, 0).alias("fp"), hit(0, 1).alias("fn"), hit(0, 0).alias("tn"))
    return counts.withColumn("correct", F.col("tp") + F.col("tn")).withColumn("total", F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).withColumns(scores())


def joint_best(scores_: DataFrame) -> DataFrame:
    """The point of the largest mean f1 over all pairs; ties go to the least thresholds."""
    mean = scores_.groupBy("wigt", "awgt").agg(F.avg("f1").alias("mean_f1"))
    return mean.orderBy(F.desc("mean_f1"), "wigt", "awgt").limit(1)


def at_edge(best: DataFrame, scores_: DataFrame) -> DataFrame:
    ends = scores_.agg(F.min("wigt").alias("w0"), F.max("wigt").alias("w1"), F.min("awgt").alias("a0"), F.max("awgt").alias("a1"))
    near = lambda x, *e: F.lit(False) if not e else (F.abs(F.col(x) - F.col(e[0])) < 1e-9) | (F.abs(F.col(x) - F.col(e[1])) < 1e-9)
    return best.join(F.broadcast(ends)).select("wigt", "awgt", F.when(near("wigt", "w0", "w1") | near("awgt", "a0", "a1"), "BLOCKER").otherwise("OK").alias("status"))


def leave_one_out(scores_: DataFrame, pair: list[str]) -> DataFrame:
    """For each pair, the best point of all others and the left-out score there. Others' means are (sum - own) / (n - 1),
    so nothing is fitted again."""
    w = W.partitionBy("wigt", "awgt")
    rest = scores_.withColumn("others", F.try_divide(F.sum("f1").over(w) - F.col("f1"), F.count("*").over(w) - 1)).where("others is not null")
    rank = F.row_number().over(W.partitionBy(*pair).orderBy(F.desc("others"), "wigt", "awgt"))
    return rest.withColumn("_k", rank).where("_k = 1").select(*pair, "wigt", "awgt", F.col("f1").alias("left_out_f1"), F.col("others").alias("fitted_f1"))


def set_hash(df: DataFrame, column: str, *keys: str) -> DataFrame:
    """keys, hash: SHA-256 of the sorted distinct ids of each key, one a line. A fit set is as large as a report's list
    of areas; there may be any number of sets."""
    ids = F.array_sort(F.collect_set(F.col(column).cast("string")))
    return df.groupBy(*keys).agg(F.sha2(F.array_join(ids, "\n"), 256).alias("hash"))

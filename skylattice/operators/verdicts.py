"""Verdicts on measurements, and their roll-up into a product by region matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.texts import significant

#: Fixed value: when criteria that are still being calibrated begin to bind.
BINDS = "v1.2"


def measurement_key(criterion: Column) -> Column:
    """Last part of a criterion's name without _min or _max."""
    return F.regexp_replace(F.element_at(F.split(criterion, "[.]"), -1), "_(min|max)$", "")


def passes(value: Column, comparator: Column, threshold: Column) -> Column:
    return F.when(comparator == ">", value > threshold).when(comparator == ">=", value >= threshold).when(comparator == "<", value < threshold).when(comparator == "<=", value <= threshold)


def evaluated(results: DataFrame, criteria: DataFrame, strict: bool = False) -> DataFrame:
    """results(cell, measurements map, criterion_ids array) -> a row per criterion with verdict PASS, FAIL, CALIBRATING,
    UNKNOWN or MEASUREMENT_MISSING; strict raises on the last two."""
    each = results.select("cell", "measurements", F.posexplode("criterion_ids").alias("place", "criterion"))
    c = F.broadcast(criteria)  # a registry of sixteen rows
    j = each.join(c, "criterion", "left").withColumn("value", F.try_element_at("measurements", measurement_key(F.col("criterion"))))
    ok = passes(F.col("value"), F.col("comparator"), F.col("threshold"))
    verdict = (
        F.when(F.col("threshold").isNull(), "UNKNOWN").when(F.col("value").isNull(), "MEASUREMENT_MISSING").when(F.col("kind") == "CALIBRATING", "CALIBRATING").when(ok, "PASS").otherwise("FAIL")
    )
    if strict:
        verdict = F.when(verdict.isin("UNKNOWN", "MEASUREMENT_MISSING"), F.raise_error(F.concat(verdict, F.lit(": "), F.col("criterion")))).otherwise(verdict)
    return j.select("cell", "place", "criterion", "kind", "value", "comparator", "threshold", verdict.alias("verdict"))


def rendered(verdicts: DataFrame) -> DataFrame:
    """One text a cell: known criteria in order, investigation triggers left out, in italics if any is being calibrated; an
    em dash if none is left."""
    calibrating = F.col("kind") == "CALIBRATING"
    result = F.concat(F.when(passes(F.col("value"), F.col("comparator"), F.col("threshold")), "PASS").otherwise("FAIL"), F.when(calibrating, f" (CALIBRATING — binds {BINDS})").otherwise(""))
    one = F.concat(significant(F.col("value")), F.lit(" ("), F.col("comparator"), F.lit(" "), significant(F.col("threshold")), F.lit(" "), result, F.lit(")"))
    text = F.when(F.col("value").isNull(), F.concat(F.lit("MEASUREMENT_MISSING:"), measurement_key(F.col("criterion")))).otherwise(one)
    shown = verdicts.where("threshold is not null and kind <> 'INVESTIGATION_TRIGGER'")
    cells = shown.groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("place", text.alias("t")))).alias("ts"), F.bool_or(calibrating).alias("open"))
    joined = F.array_join(F.transform("ts", lambda x: x.t), " / ")
    joined = F.when(F.col("open"), F.concat(F.lit("*"), joined, F.lit("*"))).otherwise(joined)
    all_cells = verdicts.select("cell").distinct().join(cells, "cell", "left")
    return all_cells.select("cell", F.regexp_replace(F.coalesce(joined, F.lit("—")), r"\|", r"\\|").alias("text"))


def status(statuses: Column) -> Column:
    """Of a set of statuses: all alike, or the mixture's name."""
    s = F.array_sort(F.array_distinct(statuses))
    return (
        F.when(F.size(s) == 0, "FAIL").when(F.size(s) == 1, s[0]).when(F.array_contains(s, "BLOCKER"), "BLOCKER").when(F.array_contains(s, "FAIL") & ~F.array_contains(s, "PASS") & ~F.array_contains(s, "CALIBRATING"), "FAIL").otherwise("MIXED")
    )


def upgrade_path(f1: Column) -> Column:
    return F.when(f1 > 0.9, "PASS").when(f1 >= 0.85, "ml").otherwise("calibration")


def unwrapper_status(candidate: Column, r: Column, ramp: Column, source: Column) -> Column:
    no = F.lit(False)
    spurt = F.coalesce((r >= 0.7) & (ramp < 5) & (source == "inconclusive"), no)
    phass = F.coalesce(r >= 0.5, no) | F.coalesce(ramp < 1, no)
    good = F.when(candidate == "spurt", spurt).otherwise(phass)
    return F.when(r.isNull() & ramp.isNull(), "BLOCKER").when(good, "PASS").otherwise("FAIL")


def correction_delta(pairs: DataFrame, steps: dict[str, float]) -> DataFrame:
    """base_<m> and variant_<m> columns: which measures differ by their step or more; meaningful if two or more do."""
    signals = F.filter(F.array(*[F.when(F.abs(F.col(f"variant_{m}") - F.col(f"base_{m}")) >= s, F.lit(m)) for m, s in steps.items()]), lambda x: x.isNotNull())
    return pairs.withColumn("signals", F.array_join(signals, ",")).withColumn("meaningful", F.size(signals) >= 2)

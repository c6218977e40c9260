"""The results matrix: one row a cell, from metric records of several shapes.

A record is JSON. Which shape it has is told by its keys, in a fixed order; a shape whose own fields are not there is
passed over, what no shape fits is a plain record of measurements and criteria, and what is not that either, or is
missing, shows as RUN_FAILED. Records are read once, as VARIANT, and all cells are one projection: no shape is a job of
its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.texts import bound, significant
from .verdicts import BINDS, measurement_key, passes

DASH = "—"
#: Up to a negative zero: what is neither a text nor a sign, whole texts, and signs of exponents and other numbers.
_TO_NEGATIVE_ZERO = r'(?s)\G((?:[^"\-]++|"(?:[^"\\]++|\\.)*+"|(?<=[eE])-|-(?!0(?:\.0+)?(?![0-9.eE])))*+)-0(?:\.0+)?(?![0-9.eE])'
WARNING = " ⚠"


def parsed(text: Column) -> Column:
    """JSON as VARIANT. A negative zero is written with an exponent first: without one it is read as a decimal or a whole
    number, which have no such sign."""
    return F.try_parse_json(F.when(text.contains("-0"), F.regexp_replace(text, _TO_NEGATIVE_ZERO, "$1-0e0")).otherwise(text))


def fixed(value: Column, digits: int, sign: bool = False) -> Column:
    return F.when(value.isNull() | F.isnan(value), "nan").otherwise(F.format_string(f"%{'+' if sign else ''}.{digits}f", value))


def shown(form: str, value: Column) -> Column:
    """The number in a text, null without one."""
    return F.when(value.isNotNull(), F.format_string(form, value))


def registry(criteria: list[tuple[str, float, str, str]]) -> Column:
    """A map from (criterion, threshold, comparator, kind): a list of fixed length."""
    one = lambda t, c, k: F.struct(F.lit(float(t)).alias("threshold"), F.lit(c).alias("comparator"), F.lit(k).alias("kind"))
    return F.create_map(*[x for n, t, c, k in criteria for x in (F.lit(n), one(t, c, k))])


def measurement(criterion: Column, measurements: Column, known: Column) -> Column:
    """value (comparator threshold verdict) of one criterion."""
    def text(x: Column) -> Column:
        verdict = F.when(passes(x.v, x.c.comparator, x.c.threshold), "PASS").otherwise("FAIL")
        verdict = F.concat(verdict, F.when(x.c.kind == "CALIBRATING", f" (CALIBRATING {DASH} binds {BINDS})").otherwise(""))
        whole = F.concat(significant(x.v), F.lit(" ("), x.c.comparator, F.lit(" "), significant(x.c.threshold), F.lit(" "), verdict, F.lit(")"))
        missing = F.concat(F.lit("MEASUREMENT_MISSING:"), measurement_key(criterion))
        return F.when(x.c.isNull(), F.concat(F.lit("UNKNOWN_CRITERION:"), criterion)).when(x.v.isNull(), missing).otherwise(whole)

    return bound(F.struct(F.try_element_at(known, criterion).alias("c"), F.try_element_at(measurements, measurement_key(criterion)).alias("v")), text)


def column(side: Column, known: Column) -> Column:
    """One side of a plain cell: its gates in order, without investigation triggers and unknown criteria, in italics if
    any is being calibrated; a dash if none is left."""
    kind = lambda c: F.try_element_at(known, c)["kind"]
    gates = F.filter(side["criterion_ids"], lambda c: kind(c) != "INVESTIGATION_TRIGGER")
    body = F.array_join(F.transform(gates, lambda c: measurement(c, side["measurements"], known)), " / ")
    body = F.when(F.exists(gates, lambda c: kind(c) == "CALIBRATING"), F.concat(F.lit("*"), body, F.lit("*"))).otherwise(body)
    return F.when(F.size(gates) > 0, body).otherwise(DASH)


SIDE = "struct<measurements:map<string,double>,criterion_ids:array<string>>"


@dataclass
class Shape:
    """keys: what a record must have to be of this shape; valid: that its own fields are there; pq, ra: its two columns."""

    name: str
    keys: tuple[str, ...]
    valid: Column
    pq: Column
    ra: Column


def _joined(*parts: Column) -> Column:
    """Parts that are not null, with slashes."""
    return F.array_join(F.array_compact(F.array(*parts)), " / ")


def _passed(passed: Column, total: Column) -> Column:
    failed = F.when(passed < total, F.format_string(" (%d FAIL)", total - passed)).otherwise("")
    return F.concat(F.format_string("%d/%d PASS", passed, total), failed)


def _candidates(outcomes: Column) -> Column:
    """Outcomes of the two unwrapping candidates, in this order; a star marks partial metrics."""
    def one(name: str, label: str) -> Column:
        found = F.filter(outcomes, lambda o: o.candidate == name)
        told = lambda o: F.concat(F.lit(label + ":"), o.status, F.when(o.partial_metrics, "*").otherwise(""))
        return F.when(F.size(found) > 0, told(F.element_at(found, -1)))

    some = F.array_compact(F.array(one("spurt_native", "spurt"), one("phass_post_deramp", "deramp")))
    return F.when(F.size(some) > 0, F.concat(F.lit("cand="), F.array_join(some, ",")))


def shapes(v: Column, region: Column, known: Column) -> list[Shape]:
    """All shapes of the variant v but the plain one, in the order they are tried."""
    get = lambda path, kind: F.try_variant_get(v, f"$.{path}", kind)
    text, number, flag = (lambda p, k=k: get(p, k) for k in ("string", "double", "boolean"))
    lit, dash = F.lit, F.lit(DASH)
    measured = lambda side, name: F.try_element_at(get(f"{side}.measurements", "map<string,double>"), lit(name))
    upgrade = F.coalesce(F.concat(lit(f" {DASH} named upgrade: "), F.nullif(text("named_upgrade_path"), lit(""))), lit(""))
    f1 = fixed(measured("reference_agreement", "f1"), 3)

    coh, resid = measured("product_quality", "coherence_median_of_persistent"), measured("product_quality", "residual_mm_yr")
    outcomes = get("candidate_outcomes", "array<struct<candidate:string,status:string,partial_metrics:boolean>>")
    disp = _joined(
        F.coalesce(F.concat(shown("coh=%.2f ([", coh), text("product_quality.coherence_source"), lit("])")), lit(f"coh={DASH}")),
        F.coalesce(shown("resid=%+.1f mm/yr", resid), lit(f"resid={DASH}")),
        F.concat(lit("attr="), text("ramp_attribution.attributed_source")),
        F.concat(lit("era5="), text("era5_diagnostic.mode")),
        F.concat(lit("signals="), F.size(get("era5_diagnostic.improvement_signals", "array<string>")).cast("string")),
        F.when(get("cause_assessment.eliminated_causes", "array<string>") == F.array(lit("tropospheric")), "narrowed=tropospheric"),
        _candidates(outcomes),
    )
    status = text("cell_status")
    disp = F.concat(lit("*"), disp, lit(f" (CALIBRATING {DASH} needs 3rd AOI before binding; see DISP_UNWRAPPER_SELECTION_BRIEF.md)*"), F.when(status == "BLOCKER", WARNING).otherwise(""))
    agreement = get("reference_agreement", SIDE)
    disp_ra = F.transform(agreement.criterion_ids, lambda c: measurement(c, agreement.measurements, known))
    disp_ra = F.when(F.size(disp_ra) > 0, F.array_join(disp_ra, " / ")).otherwise(DASH)

    passed, total = get("pass_count", "int"), get("total", "int")
    events = F.concat(_passed(passed, total), F.format_string(" | worst f1=%.3f (%s)", number("worst_f1"), text("worst_event_id")), F.when(flag("any_chained_run_failed"), WARNING).otherwise(""))

    attempts = F.size(get("candidates_attempted", "array<variant>"))
    look = flag("regression.f1_below_regression_threshold") & ~F.coalesce(flag("regression.investigation_resolved"), lit(False))
    water = F.when(status == "BLOCKER", F.format_string("BLOCKER [no candidate scene found among %d attempts]", attempts)).otherwise(
        F.concat(lit("F1="), f1, lit(" "), status, lit(" [aoi="), F.coalesce(text("selected_aoi"), lit("None")), lit("]"), upgrade, F.when(look, " INVESTIGATION_REQUIRED").otherwise(""))
    )
    gap = fixed(number("loocv_gap"), 3)
    held_out = F.when(status == "BLOCKER", F.concat(lit("BLOCKER [LOOCV gap="), gap, lit(" (>= 0.02)]"))).otherwise(F.concat(lit("F1="), f1, lit(" "), status, upgrade, lit(" | LOOCV gap="), gap))

    areas = get("per_aoi", "array<struct<status:string,product_quality:struct<measurements:map<string,double>>>>")
    verdict, blocker = text("candidate_binding.verdict"), text("candidate_binding.blocker.reason_code")
    binding = verdict.isNotNull()
    points = F.filter(F.transform(areas, lambda a: F.abs(F.try_element_at(a.product_quality.measurements, lit("egms_l2a_stable_ps_residual_mm_yr")))), lambda x: x.isNotNull())
    metrics = [
        F.coalesce(shown("coh=%.2f", number("product_quality_aggregate.worst_coherence_median_of_persistent")), lit(f"coh={DASH}")),
        F.coalesce(shown("resid=%.1f mm/yr", number("product_quality_aggregate.worst_residual_mm_yr")), lit(f"resid={DASH}")),
        F.when((F.lower(region) == "eu") & (F.size(points) > 0), F.format_string("egms_resid=%.1f mm/yr", F.array_max(points))),
    ]
    area = F.coalesce(F.concat(lit(" ("), F.nullif(text("product_quality_aggregate.worst_aoi"), lit("")), lit(")")), lit(""))
    n = lambda s: F.size(F.filter(areas, lambda a: a.status == s))
    tally = lambda s, always=False: F.when(lit(always) | (n(s) > 0), F.format_string(f"%d/%d {s}", n(s), total))
    label = F.concat(F.array_join(F.array_compact(F.array(tally("CALIBRATING", True), tally("BLOCKER"), tally("FAIL"))), ", "), lit(f" {DASH} binds {BINDS}"))
    r, rmse = number("reference_agreement_aggregate.worst_amp_r"), number("reference_agreement_aggregate.worst_amp_rmse_db")
    amplitude = F.when(r.isNotNull() | rmse.isNotNull(), _joined(shown("amp_r=%.2f", r), shown("amp_rmse=%.1f dB", rmse)))
    unavailable = F.when(F.lower(blocker).contains("mojave") | F.lower(blocker).contains("opera"), F.concat(lit("unavailable="), blocker))
    warn = F.when(flag("any_blocker") | F.coalesce(verdict == "BINDING BLOCKER", lit(False)), WARNING).otherwise("")
    bound_pq = F.concat(_joined(verdict, *metrics, F.concat(lit("blocker="), blocker)), area, warn)
    open_pq = F.concat(lit("*"), label, lit(" | "), _joined(*metrics), area, lit("*"), warn)
    consistency_pq = F.when(binding, bound_pq).otherwise(open_pq)
    consistency_ra = F.when(binding, F.coalesce(amplitude, unavailable, dash)).otherwise(F.coalesce(F.concat(lit("*"), amplitude, lit("*")), dash))

    bursts = F.concat(_passed(passed, total), F.when(flag("any_investigation_required"), WARNING).otherwise(""))
    counted = passed.isNotNull() & total.isNotNull()
    return [
        Shape("rtc_deferred", ("unblock_condition",), lit(True), dash, F.concat(lit(f"DEFERRED {DASH} "), text("unblock_condition"))),
        Shape("disp", ("ramp_attribution",), text("ramp_attribution.attributed_source").isNotNull() & agreement.isNotNull(), disp, disp_ra),
        Shape("dist", ("per_event",), counted & number("worst_f1").isNotNull(), dash, events),
        Shape("dist_deferred", ("reference_source", "cmr_probe_outcome"), lit(True), dash, F.concat(F.coalesce(status, lit("DEFERRED")), lit(" (CMR: "), text("cmr_probe_outcome"), lit(")"))),
        Shape("dswx", ("selected_aoi", "candidates_attempted"), status.isNotNull(), dash, water),
        Shape("dswx_held_out", ("thresholds_used", "loocv_gap"), status.isNotNull() & number("loocv_gap").isNotNull(), dash, held_out),
        Shape("cslc", ("per_aoi",), areas.isNotNull() & total.isNotNull() & F.coalesce(verdict.isin("BINDING PASS", "BINDING FAIL", "BINDING BLOCKER"), lit(True)), consistency_pq, consistency_ra),
        Shape("rtc", ("per_burst",), counted, dash, bursts),
    ]


def matrix(cells: DataFrame, files: DataFrame, criteria: list[tuple[str, float, str, str]]) -> DataFrame:
    """cells(product, region, path), files(path, content) -> each cell with shape, pq and ra, its two columns' texts, and
    line, its row of a Markdown table."""
    known = registry(criteria)
    j = cells.join(files.select("path", "content"), "path", "left").withColumn("_v", parsed(F.col("content")))
    v = F.col("_v")
    has = lambda key: F.try_variant_get(v, f"$.{key}", "variant").isNotNull()
    every = shapes(v, F.col("region"), known)
    fits = {}
    for s in every:
        fit = F.coalesce(s.valid, F.lit(False))
        for key in s.keys:
            fit = has(key) & fit
        fits[s.name] = fit
    own = F.lit(False)
    for key in {k for s in every for k in s.keys}:
        own = own | has(key)
    pq, ra = F.try_variant_get(v, "$.product_quality", SIDE), F.try_variant_get(v, "$.reference_agreement", SIDE)
    plain = pq.measurements.isNotNull() & ra.measurements.isNotNull() & ~own
    shape = F.lit(None).cast("string")
    for s in reversed(every):
        shape = F.when(fits[s.name], s.name).otherwise(shape)
    shape = F.coalesce(shape, F.when(plain, "plain"), F.lit("RUN_FAILED"))
    # Fixed by the shape alone from here on, so that the keys are looked at once.
    j = j.withColumn("shape", shape)
    why = F.concat(F.element_at(F.split("path", "/"), -1), F.when(F.col("content").isNull(), " missing").otherwise(" invalid"))
    text_pq, text_ra = F.concat(F.lit("RUN_FAILED ("), why, F.lit(")")), F.lit("RUN_FAILED")
    for s in [Shape("plain", (), plain, column(pq, known), column(ra, known)), *every]:
        text_pq, text_ra = F.when(F.col("shape") == s.name, s.pq).otherwise(text_pq), F.when(F.col("shape") == s.name, s.ra).otherwise(text_ra)
    out = j.select(*[F.col(f"`{c}`") for c in cells.columns], "shape", text_pq.alias("pq"), text_ra.alias("ra"))
    escaped = lambda c: F.regexp_replace(c, r"\|", r"\\|")
    line = F.concat_ws("", F.lit("| "), F.upper("product"), F.lit(" | "), F.upper("region"), F.lit(" | "), escaped("pq"), F.lit(" | "), escaped("ra"), F.lit(" |"))
    return out.withColumn("line", line)


def event_rollup(events: DataFrame, keys: list[str]) -> DataFrame:
    """events(keys, event, f1, accuracy, precision, recall, chained: how a chained run ended, null without one) -> one row
    for each of keys: how many events pass all four criteria, the cell's status, its worst event by f1 (then by name) and
    whether any chained run failed."""
    ok = (F.col("f1") > 0.80) & (F.col("accuracy") > 0.85) & (F.col("precision") > 0.70) & (F.col("recall") > 0.50)
    worst = F.min(F.struct("f1", "event"))
    failed = F.coalesce(~F.col("chained").isin("structurally_valid", "skipped"), F.lit(False))
    cells = events.groupBy(*keys).agg(F.count_if(F.coalesce(ok, F.lit(False))).alias("passed"), F.count("*").alias("total"), worst.alias("_w"), F.bool_or(failed).alias("any_chained_run_failed"))
    status = F.when(F.col("passed") == F.col("total"), "PASS").when(F.col("passed") == 0, "FAIL").otherwise("MIXED")
    return cells.withColumns({"status": status, "worst_event": F.col("_w.event"), "worst_f1": F.col("_w.f1")}).drop("_w")

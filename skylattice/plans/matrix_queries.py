"""The results matrix over records of all shapes, and event roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matrix as M
from .shaping import Registry, rounded
from .tables import CRITERIA, table

REG = Registry()


def _records(spark, sf_dir):
    """A cell and its record for each customer: twelve kinds, by the customer's number; one kind has no file."""
    c, lit = F.col, F.lit
    t = table(spark, sf_dir, "customer").select(c("c_custkey").alias("k"))
    t = t.withColumns({"x": (c("k") * 37 % 997) / 997.0, "y": (c("k") * 53 % 991) / 991.0, "kind": c("k") % 12})
    k, x, y = c("k"), c("x"), c("y")
    only = lambda when, v: F.when(when, v)
    put = lambda **fields: F.to_json(F.struct(*[v.alias(n) for n, v in fields.items()]))
    s = lambda **fields: F.struct(*[v.alias(n) for n, v in fields.items()])
    ids = lambda *names: F.array(*map(lit, names))
    good = F.when(x > 0.5, "PASS").otherwise("FAIL")
    area = lambda status, **m: s(status=status, product_quality=s(measurements=s(**m) if m else s(other=lit(1.0))))
    kinds = [
        put(unblock_condition=F.concat(lit("data | of "), k.cast("string"))),
        put(
            ramp_attribution=s(attributed_source=lit("orbit")),
            product_quality=s(measurements=s(coherence_median_of_persistent=only(k % 3 != 0, x), residual_mm_yr=only(k % 5 != 0, 20 * y - 10)), coherence_source=lit("fresh")),
            reference_agreement=s(measurements=s(correlation=x, bias_mm_yr=only(k % 3 != 1, 5 * y)), criterion_ids=ids("disp.correlation_min", "disp.bias_mm_yr_max")),
            era5_diagnostic=only(k % 4 == 1, s(mode=lit("on"), improvement_signals=ids("r", "bias"))),
            cause_assessment=only(k % 7 == 0, s(eliminated_causes=ids("tropospheric"))),
            candidate_outcomes=only(k % 2 == 1, F.array(s(candidate=lit("phass_post_deramp"), status=lit("FAIL"), partial_metrics=lit(True)), s(candidate=lit("spurt_native"), status=lit("PASS"), partial_metrics=lit(False)))),
            cell_status=F.when(k % 13 == 0, "BLOCKER").otherwise("MIXED"),
        ),
        put(per_event=F.array(lit(1)), pass_count=k % 5, total=lit(4), worst_f1=x, worst_event_id=F.concat(lit("e"), k.cast("string")), any_chained_run_failed=k % 3 == 0),
        put(reference_source=lit("r"), cmr_probe_outcome=lit("not_found"), cell_status=only(k % 2 == 0, lit("PASS"))),
        put(
            cell_status=F.when(k % 5 == 0, "BLOCKER").otherwise(good), selected_aoi=F.concat(lit("a"), (k % 3).cast("string")), candidates_attempted=F.transform(F.sequence(lit(0), (k % 4).cast("int")), lambda i: s(n=i)),
            named_upgrade_path=only(k % 7 < 3, lit("ML")), regression=s(f1_below_regression_threshold=x < 0.3, investigation_resolved=k % 8 == 0), reference_agreement=s(measurements=s(f1=x), criterion_ids=ids()),
        ),
        put(thresholds_used=s(wigt=lit(0.3)), loocv_gap=y / 10, cell_status=F.when(k % 7 == 0, "BLOCKER").otherwise(good), named_upgrade_path=only(k % 7 < 3, lit("ML")), reference_agreement=s(measurements=s(f1=only(k % 9 != 0, x)), criterion_ids=ids())),
        put(
            per_aoi=F.array(area(lit("CALIBRATING"), egms_l2a_stable_ps_residual_mm_yr=-3 * y), area(F.when(k % 9 == 0, "BLOCKER").otherwise("CALIBRATING"), egms_l2a_stable_ps_residual_mm_yr=only(k % 7 == 0, 5 * x)), area(F.when(k % 5 == 0, "FAIL").otherwise("CALIBRATING"), egms_l2a_stable_ps_residual_mm_yr=lit(None).cast("double"))),
            total=lit(3), any_blocker=k % 9 == 0,
            product_quality_aggregate=s(worst_coherence_median_of_persistent=only(k % 7 != 0, x), worst_residual_mm_yr=9 * y, worst_aoi=only(k % 8 != 6, lit("SoCal"))),
            reference_agreement_aggregate=s(worst_amp_r=only(k % 4 != 2, y), worst_amp_rmse_db=only(k % 5 == 1, 4 * x)),
            candidate_binding=only(k % 5 < 2, s(verdict=F.when(k % 5 == 1, "BINDING BLOCKER").otherwise("BINDING PASS"), blocker=only(k % 5 == 1, s(reason_code=lit("opera_frame"))))),
        ),
        put(per_burst=F.array(lit(1)), pass_count=k % 6, total=lit(5), any_investigation_required=k % 5 < 2),
        put(
            product_quality=s(measurements=s(coherence=x), criterion_ids=ids("cslc.selfconsistency.coherence_min", "no.such_max")),
            reference_agreement=s(measurements=s(rmse_db=F.when(k % 5 == 0, y).when(k % 5 == 1, y * 1e5).when(k % 5 == 2, y * 1e-6).when(k % 5 == 3, -y * 100), correlation=x), criterion_ids=ids("rtc.rmse_db_max", "rtc.correlation_min", "rtc.eu.investigation_rmse_db_min")),
        ),
        lit("{broken"),
        lit(None).cast("string"),
        put(per_burst=F.array(lit(1)), any_investigation_required=lit(False)),
    ]
    content = F.lit(None).cast("string")
    for n, text in enumerate(kinds):
        content = F.when(c("kind") == n, text).otherwise(content)
    path = F.concat(lit("eval/"), k.cast("string"), lit("/metrics.json"))
    rows = t.select("k", path.alias("path"), content.alias("content"))
    cells = rows.select("k", lit("dswx").alias("product"), F.when(k % 16 < 8, "eu").otherwise("nam").alias("region"), "path")
    return cells, rows.where("content is not null").select("path", "content")


_CELLS = """with t as (select c_custkey as k, (c_custkey * 37 % 997) / 997.0::double as x, (c_custkey * 53 % 991) / 991.0::double as y, c_custkey % 12 as kind, case when c_custkey % 16 < 8 then 'eu' else 'nam' end as region from customer),
u as (select *, case when x > 0.5 then 'PASS' else 'FAIL' end as good, case when k % 7 < 3 then ' — named upgrade: ML' else '' end as upgrade,
  case k % 5 when 0 then y when 1 then y * 1e5::double when 2 then y * 1e-6::double when 3 then -y * 100 end as rmse,
  case when k % 7 <> 0 then format('coh={:.2f}', x) else 'coh=—' end || format(' / resid={:.1f} mm/yr', 9 * y) || case when region = 'eu' then format(' / egms_resid={:.1f} mm/yr', greatest(3 * y, case when k % 7 = 0 then 5 * x else 0 end)) else '' end as metrics,
  case when k % 8 <> 6 then ' (SoCal)' else '' end as area, case when k % 4 <> 2 then format('amp_r={:.2f}', y) end as r, case when k % 5 = 1 then format('amp_rmse={:.1f} dB', 4 * x) end as amp from t),
v as (select *, nullif(concat_ws(' / ', r, amp), '') as amplitude, '3/3' as dummy, (3 - (k % 9 = 0)::int - (k % 5 = 0)::int) as n_cal from u),
w as (select k, kind, region,
case kind when 0 then 'rtc_deferred' when 1 then 'disp' when 2 then 'dist' when 3 then 'dist_deferred' when 4 then 'dswx' when 5 then 'dswx_held_out' when 6 then 'cslc' when 7 then 'rtc' when 8 then 'plain' else 'RUN_FAILED' end as shape,
case kind
when 1 then '*' || concat_ws(' / ', case when k % 3 <> 0 then format('coh={:.2f} ([fresh])', x) else 'coh=—' end, case when k % 5 <> 0 then format('resid={:+.1f} mm/yr', 20 * y - 10) else 'resid=—' end, 'attr=orbit', case when k % 4 = 1 then 'era5=on / signals=2' end,
  case when k % 7 = 0 then 'narrowed=tropospheric' end, case when k % 2 = 1 then 'cand=spurt:PASS,deramp:FAIL*' end) || ' (CALIBRATING — needs 3rd AOI before binding; see DISP_UNWRAPPER_SELECTION_BRIEF.md)*' || case when k % 13 = 0 then ' ⚠' else '' end
when 6 then case when k % 5 < 2 then case when k % 5 = 1 then 'BINDING BLOCKER' else 'BINDING PASS' end || ' / ' || metrics || case when k % 5 = 1 then ' / blocker=opera_frame' else '' end || area || case when k % 9 = 0 or k % 5 = 1 then ' ⚠' else '' end
  else '*' || n_cal || '/3 CALIBRATING' || case when k % 9 = 0 then ', 1/3 BLOCKER' else '' end || case when k % 5 = 0 then ', 1/3 FAIL' else '' end || ' — binds v1.2 | ' || metrics || area || '*' || case when k % 9 = 0 then ' ⚠' else '' end end
when 8 then '*' || format('{:.4g}', x) || ' (> 0.7 ' || case when x > 0.7 then 'PASS' else 'FAIL' end || ' (CALIBRATING — binds v1.2))*'
when 9 then 'RUN_FAILED (metrics.json invalid)' when 10 then 'RUN_FAILED (metrics.json missing)' when 11 then 'RUN_FAILED (metrics.json invalid)' else '—' end as pq,
case kind when 0 then 'DEFERRED — data | of ' || k
when 1 then format('{:.4g}', x) || ' (> 0.92 ' || case when x > 0.92 then 'PASS' else 'FAIL' end || ') / ' || case when k % 3 <> 1 then format('{:.4g}', 5 * y) || ' (< 3 ' || case when 5 * y < 3 then 'PASS' else 'FAIL' end || ')' else 'MEASUREMENT_MISSING:bias_mm_yr' end
when 2 then (k % 5) || '/4 PASS' || case when k % 5 < 4 then ' (' || (4 - k % 5) || ' FAIL)' else '' end || format(' | worst f1={:.3f} (e', x) || k || ')' || case when k % 3 = 0 then ' ⚠' else '' end
when 3 then case when k % 2 = 0 then 'PASS' else 'DEFERRED' end || ' (CMR: not_found)'
when 4 then case when k % 5 = 0 then 'BLOCKER [no candidate scene found among ' || (k % 4 + 1) || ' attempts]' else format('F1={:.3f} ', x) || good || ' [aoi=a' || (k % 3) || ']' || upgrade || case when x < 0.3 and k % 8 <> 0 then ' INVESTIGATION_REQUIRED' else '' end end
when 5 then case when k % 7 = 0 then format('BLOCKER [LOOCV gap={:.3f} (>= 0.02)]', y / 10) else 'F1=' || case when k % 9 <> 0 then format('{:.3f}', x) else 'nan' end || ' ' || good || upgrade || format(' | LOOCV gap={:.3f}', y / 10) end
when 6 then case when k % 5 < 2 then coalesce(amplitude, case when k % 5 = 1 then 'unavailable=opera_frame' end, '—') else coalesce('*' || amplitude || '*', '—') end
when 7 then (k % 6) || '/5 PASS' || case when k % 6 < 5 then ' (' || (5 - k % 6) || ' FAIL)' else '' end || case when k % 5 < 2 then ' ⚠' else '' end
when 8 then case when rmse is null then 'MEASUREMENT_MISSING:rmse_db' else format('{:.4g}', rmse) || ' (< 0.5 ' || case when rmse < 0.5 then 'PASS' else 'FAIL' end || ')' end || ' / ' || format('{:.4g}', x) || ' (> 0.99 ' || case when x > 0.99 then 'PASS' else 'FAIL' end || ')'
else 'RUN_FAILED' end as ra from v)"""


@REG.add(_CELLS + " select k, shape, pq, ra, '| DSWX | ' || upper(region) || ' | ' || replace(pq, '|', '\\|') || ' | ' || replace(ra, '|', '\\|') || ' |' as line from w")
def v05_v06_matrix(spark, sf_dir):
    cells, files = _records(spark, sf_dir)
    return M.matrix(cells, files, CRITERIA).select("k", "shape", "pq", "ra", "line")


@REG.add(
    """with e as (select o_custkey % 200 as cell, o_orderkey as event, 0.7 + (o_orderkey % 31) / 100.0 as f1, 0.8 + (o_orderkey % 17) / 80.0 as accuracy, 0.6 + (o_orderkey % 41) / 100.0 as precision, 0.45 + (o_orderkey % 43) / 80.0 as recall,
  case o_orderkey % 97 when 1 then 'failed' when 2 then 'skipped' when 3 then 'structurally_valid' end as chained from orders where o_custkey % 5 = 0 or o_orderkey % 3 = 0),
p as (select *, f1 > 0.8 and accuracy > 0.85 and precision > 0.7 and recall > 0.5 as ok from e),
c as (select cell, count(*) filter (where ok) as passed, count(*) as total, min(f1) as worst_f1, coalesce(bool_or(chained = 'failed'), false) as any_chained_run_failed, min(struct_pack(f1 := f1, event := event)).event as worst_event from p group by 1)
select cell, passed, total, case when passed = total then 'PASS' when passed = 0 then 'FAIL' else 'MIXED' end as status, worst_event, round(worst_f1, 6) as worst_f1, any_chained_run_failed from c"""
)
def v12_event_rollup(spark, sf_dir):
    c, k = F.col, F.col("o_orderkey")
    chained = F.when(k % 97 == 1, "failed").when(k % 97 == 2, "skipped").when(k % 97 == 3, "structurally_valid")
    o = table(spark, sf_dir, "orders").where((c("o_custkey") % 5 == 0) | (k % 3 == 0))
    e = o.select((c("o_custkey") % 200).alias("cell"), k.alias("event"), (0.7 + (k % 31) / 100.0).alias("f1"), (0.8 + (k % 17) / 80.0).alias("accuracy"), (0.6 + (k % 41) / 100.0).alias("precision"), (0.45 + (k % 43) / 80.0).alias("recall"), chained.alias("chained"))
    return rounded(M.event_rollup(e, ["cell"]).select("cell", "passed", "total", "status", "worst_event", "worst_f1", "any_chained_run_failed"))

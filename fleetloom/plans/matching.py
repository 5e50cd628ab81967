"""Cohort, cascade, nearest-configuration and attribute-diff queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom.functions import config_key as K
from fleetloom.functions import labels as L
from fleetloom.operators import cohorts as H
from fleetloom.operators import pairing as G
from fleetloom.operators.compliance import count_by
from fleetloom.operators.similar import NO_CANDIDATE, blended_score, nearest_config
from fleetloom.plans import params as P
from fleetloom.plans.compliance import _STEPS as _DASHBOARD
from fleetloom.plans.compliance import _base
from fleetloom.plans.inventory import _state
from fleetloom.plans.views_sql import with_views
from fleetloom.session import materialize
from fleetloom.sources import domain as D

ASSEMBLY_FROM = "1998-03-17"
OVERRIDES = {"motor": "MOT-2", "battery": "BAT-MAX", "badging": "ACTBDG-BRT", "audio": "AUD-P01", "roof": "ROOF-FGP"}


def _inputs(spark: SparkSession, root: str, run: DataFrame) -> H.CohortInputs:
    """Lists and lookups of the purposes, taken from the run itself."""
    return H.CohortInputs(
        assembly_from=ASSEMBLY_FROM,
        dc_map=D.dc_map(spark, root),
        regions=D.dc_regions(spark),
        retry_ids=run.filter("hold_type = 'QUALITY'").select("oms_order_id"),
        delayed=run.filter("expected_general_assembly_date < date '1997-01-01'").select("oms_order_id"),
        cancelled=run.filter("question1_response is not null or cancel_code is not null"),
        last_saved=run.withColumn("financial_status", F.lit("CONFIGURED")),
        overrides=OVERRIDES,
    )


def _cohort(spark: SparkSession, root: str, purpose: str) -> DataFrame:
    run = D.matching_run(spark, root)
    return H.select_cohort(run, purpose, _inputs(spark, root, run))


def cohort(spark: SparkSession, root: str, purpose: str) -> DataFrame:
    df = _cohort(spark, root, purpose)
    extra = [c for c in ("distribution_center", "dc_region") if c in df.columns]
    return df.select("oms_order_id", "financial_status", "motor", "atp", *extra)


def supply_pool(spark: SparkSession, root: str, purpose: str) -> DataFrame:
    run = D.matching_run(spark, root)
    df = H.select_supply(run, purpose, _inputs(spark, root, run))
    extra = [c for c in ("dc_region",) if c in df.columns]
    return df.select("oms_order_id", "vehicle_status_code", "distribution_center", *extra)


def hold_report(spark: SparkSession, root: str) -> DataFrame:
    return H.cohort_counts(_cohort(spark, root, "hold_strategy_matched_at_normal"))


def other_generation(spark: SparkSession, root: str) -> DataFrame:
    run = D.matching_run(spark, root)
    mapping = run.filter("build_batch <> 5").select("oms_order_id", "items_vehicle_generation_id").distinct()
    return H.drop_generation(run, mapping, "GEN-2").select("oms_order_id", "items_vehicle_generation_id")


def _cascade(spark: SparkSession, root: str, purpose: str, order: Sequence[str] = G.STEP_ORDER) -> DataFrame:
    local = purpose in H.LOCAL_KEY_PURPOSES
    steps = G.step_keys(local, order)
    run = D.matching_run(spark, root)
    inputs = _inputs(spark, root, run)

    def side(df: DataFrame) -> DataFrame:
        grouped = G.add_groups(df, P.GROUPS)
        keys = sorted({c for cols in steps.values() for c in cols})
        return grouped.select(F.col("oms_order_id").alias("id"), F.col("oms_order_id").alias("ord"), *keys)

    demand = side(H.select_cohort(run, purpose, inputs))
    supply = side(H.select_supply(run, purpose, inputs))
    return G.cascade_match(demand, supply, steps)


def cascade_match(spark: SparkSession, root: str) -> DataFrame:
    return _cascade(spark, root, "anywhere_to_anywhere")


def cascade_match_optional(spark: SparkSession, root: str) -> DataFrame:
    """Exact matches, then the steps that are not part of the usual order."""
    return _cascade(spark, root, "anywhere_to_anywhere", ("exact_matches", *G.OPTIONAL_STEPS))


def cascade_match_local(spark: SparkSession, root: str) -> DataFrame:
    return _cascade(spark, root, "unmatched_configured_customers_local_sc")


BLOCK = ("model_powertrain", "model_year", "country", "paint_id")


def _firm_and_catalog(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    firm = _base(spark, root).filter(
        (F.col("inventory_policy_compliance") == L.NOT_COMPLIANT)
        & (F.col("production_zone") == L.DASHBOARD_ZONES.frozen_no_vin)
    )
    # Read for its keys and for the answer: written once instead of joined twice.
    return materialize(firm), D.item_master(spark, root).filter("is_inventory_policy_eligible = 1")


def _nearest(spark: SparkSession, root: str, block=BLOCK, **options) -> DataFrame:
    firm, catalog = _firm_and_catalog(spark, root)
    return nearest_config(firm, catalog, block, **options)


_RESULT = ("vehicle_id", "config_string", "best_match_config_string", "best_match_score")


def nearest(spark: SparkSession, root: str) -> DataFrame:
    return _nearest(spark, root).select(*_RESULT)


def nearest_without_paint(spark: SparkSession, root: str) -> DataFrame:
    return _nearest(spark, root, BLOCK[:3], no_candidate=None).select(*_RESULT)


# Suggested option → option of the vehicle.
PAIRS = {
    "marketing_exterior": "paint_id",
    "marketing_interior": "interior_id",
    "marketing_wheel": "wheels_id",
    "marketing_tonneau": "tonneau_id",
    "marketing_badging": "accents_and_badging_id",
    "marketing_roof": "roof_id",
    "marketing_audio": "audio_id",
    "marketing_utility": "utility_panel_id",
}
_DECODED = {"exterior": "marketing_exterior", "interior": "marketing_interior", "wheels": "marketing_wheel",
            "tonneau": "marketing_tonneau", "badging": "marketing_badging", "roof": "marketing_roof",
            "audio": "marketing_audio", "utility": "marketing_utility"}


def attribute_diff(spark: SparkSession, root: str) -> DataFrame:
    """Only what has to change on each non-compliant firm unit, with the new region, model and tyres."""
    suggested = _nearest(spark, root, no_candidate=None)
    parts = K.decode_config("best_match_config_string")
    decoded = suggested.withColumns({_DECODED[k]: c for k, c in parts.items() if k in _DECODED} | {
        "suggested_model_year": parts["model_year"],
        "suggested_country": K.region_code(parts["country"]),
        "suggested_model_powertrain": K.model_words(parts["model_powertrain"]),
    })
    atp = K.atp_for_wheels(F.coalesce("marketing_wheel", F.lit("")), ("WHL-2", "WHL-3"))
    return K.blank_unchanged(decoded.withColumn("marketing_atp", atp), PAIRS).select(
        "vehicle_id", "suggested_model_year", "suggested_country", "suggested_model_powertrain", "marketing_atp", *PAIRS
    )


def configs_before(spark: SparkSession, root: str) -> DataFrame:
    return count_by(_nearest(spark, root), ["config_string"], "vehicle_id", "vehicle_id_count").orderBy("config_string")


def configs_after(spark: SparkSession, root: str) -> DataFrame:
    return count_by(
        _nearest(spark, root), ["best_match_config_string"], "vehicle_id", "vehicle_id_count"
    ).orderBy("best_match_config_string")


def reconfiguration_priority(spark: SparkSession, root: str) -> DataFrame:
    """Suggestions scored by similarity, scarcity and share of demand."""
    state = materialize(_state(spark, root).select(F.col("config_string").alias("c"), "dos", "demand"))
    total, longest = state.agg(F.sum("demand"), F.max("dos")).first()
    joined = _nearest(spark, root, no_candidate=None).join(
        state, F.col("best_match_config_string") == F.col("c"), "left"
    )
    score = blended_score(
        F.col("best_match_score"), F.coalesce("dos", F.lit(0.0)), longest or 0.0,
        F.coalesce("demand", F.lit(0)) / F.lit(float(total or 1)),
    )
    return joined.select("vehicle_id", "best_match_config_string", F.round(score, 6).alias("priority"))


# ---- SQL twins -------------------------------------------------------------------------------

_UNREADY = "('CUSTOMER_NOT_READY_TO_CONFIRM','CUSTOMER_UNRESPONSIVE')"
_MATCHED = "coalesce(match_status in ('REAL','PREDICTIVE'), false)"
_OPEN = f"""financial_status in ('CONFIGURED','ORDERED') and not {_MATCHED} and build_type_internal = 'Customer Configured'
  and not coalesce(fulfillment_status in {_UNREADY}, false)"""
_LATE = "oms_order_id in (select oms_order_id from matching_run where expected_general_assembly_date < date '1997-01-01')"
_RETRY = "oms_order_id in (select oms_order_id from matching_run where hold_type = 'QUALITY')"
_PLAIN = "oms_order_id, financial_status, motor, atp"


def _cohort_sql(where: str, dc: str = "zip") -> str:
    """dc: where the distribution centre comes from — zip, stored, none or region (zip + region)."""
    cols, joins = _PLAIN, ""
    if dc in ("zip", "region"):
        cols, joins = cols + ", coalesce(dc, '8101') as distribution_center", " left join dc_map on ship_to_zipcode = customer_zip"
    if dc == "region":
        cols += ", dc_region"
        joins += " left join dc_regions on distribution_center_text = coalesce(dc, '8101')"
    if dc == "stored":
        cols += ", distribution_center"
    return with_views("matching_run dc_map dc_regions", f"""select {cols} from
  (select * from matching_run where items_vehicle_generation_id = 'GEN-2') m{joins} where {where}""")


_SAVED_SQL = with_views("matching_run", f"""select s.oms_order_id, 'RESERVED' as financial_status, 'MOT-2' as motor, s.atp, s.distribution_center
from matching_run s join matching_run n on n.oms_order_id = s.oms_order_id where n.items_vehicle_generation_id = 'GEN-2'
  and n.financial_status = 'RESERVED' and s.build_type_internal = 'Customer Configured'
  and not coalesce(s.fulfillment_status in {_UNREADY}, false) and s.build_batch <> -2""")
_PULL = f"{_MATCHED} and vehicle_status_code in (300,310,315)"
_READY = f"expected_general_assembly_date >= date '{ASSEMBLY_FROM}' and {_OPEN}"


def _cancelled_sql(reason: str, code: str) -> str:
    return with_views("matching_run", f"""select oms_order_id, financial_status, motor, coalesce(atp,'ATP-NULL') as atp, distribution_center
from matching_run where (question1_response is not null or cancel_code is not null) and (question1_response = '{reason}' or cancel_code = '{code}')""")


_COHORT_SQL = {
    "pull_forward_from_local_sc": _cohort_sql(_PULL),
    "pull_forward_from_normal": _cohort_sql(_PULL),
    "retry_matching_normal": _cohort_sql(_RETRY),
    "retry_matching_local_sc": _cohort_sql(_RETRY),
    "customer_not_ready_to_confirm_unresponsive_normal": _cohort_sql(f"fulfillment_status in {_UNREADY}", "stored"),
    "last_saved_config_normal": _SAVED_SQL,
    "last_saved_config_local_sc_random_config": _SAVED_SQL,
    "unmatched_configured_customers_normal": _cohort_sql(_READY),
    "unmatched_configured_customers_local_sc": _cohort_sql(_READY),
    "hold_strategy_matched_at_normal": _cohort_sql(
        f"{_MATCHED} and build_batch <> -2 and vehicle_status_code in (100,200,210,300,310,315,320,400)", "none"),
    "customer_cancelled_bc_price_normal": _cancelled_sql("The price is not what I expected", "Pricing"),
    "customer_cancelled_bc_delivery_normal": _cancelled_sql("Delivery isn''t soon enough", "Delivery date"),
    "unmatched_configured_customers_regionalized": _cohort_sql(_OPEN, "region"),
    "anywhere_to_anywhere": _cohort_sql(_OPEN, "stored"),
    "delayed_at_risk_customers_normal": _cohort_sql(_LATE, "stored"),
    "delayed_at_risk_customers_local_sc": _cohort_sql(_LATE),
    "headlight_cmte_issue_normal": _cohort_sql(_LATE, "stored"),
}
_POOL = f"""select *, regexp_replace(distribution_center, '\\.0$', '') as dc0 from matching_run where hold_type is null
  and vehicle_status <> 'PRODUCTION_CONTROL_FROZEN' and vehicle_usage = 'CUSTOMER_DELIVERY'
  and build_type_internal in ('Unallocated','Shop') and not {_MATCHED} and vehicle_architecture = 'GEN-2'"""
_LOCAL = "vehicle_status_code in (410,420,430,440,450,460)"


def _pool_sql(where: str, region: bool = False) -> str:
    cols, joins = "oms_order_id, vehicle_status_code, dc0 as distribution_center", ""
    if region:
        cols, joins = cols + ", dc_region", " left join dc_regions on distribution_center_text = dc0"
    return with_views("matching_run dc_regions", f"select {cols} from pool{joins} where {where}", {"pool": _POOL})


def _groups_sql() -> str:
    cols = []
    for name, (source, mapping) in P.GROUPS.items():
        whens = " ".join(f"when {source} = '{a}' then '{b}'" for a, b in mapping.items())
        cols.append(f"case {whens} else 'any' end as {name}" if whens else f"'any' as {name}")
    return ", ".join(cols)


# Keys of the optional steps, written out.
_OPTIONAL_KEYS = {
    "exact_matches": "sku trim motor battery exterior interior wheels offroad atp tonneau build_country roof audio utility badging",
    "dual_dualper_quad_agnostic": "sku trim battery exterior interior wheels offroad atp tonneau build_country roof audio utility badging agnostic_motor",
    "battery_flexible": "sku trim motor exterior interior wheels offroad atp tonneau build_country roof audio utility badging",
    "battery_flex_ext_int_whl": "sku trim motor exterior interior wheels tonneau build_country",
    "battery_flex_ext_int_whl_aud_roof": "sku trim motor exterior interior wheels tonneau build_country roof audio",
    "battery_flex_ext_int": "sku trim motor exterior interior tonneau build_country",
    "exterior_interior_wheels_agnostic": "sku trim motor battery offroad atp tonneau build_country roof audio utility badging",
    "exterior_interior_agnostic": "sku trim motor battery wheels offroad atp tonneau build_country roof audio utility badging",
    "exterior_agnostic": "sku trim motor battery interior wheels offroad atp tonneau build_country roof audio utility badging",
    "battery_constant": "sku battery tonneau build_country agnostic_motor exterior_agnostic_grouped interior_agnostic_grouped",
    "only_location_based": "sku tonneau build_country exterior_agnostic_grouped interior_agnostic_grouped",
}


def _cascade_sql(local: bool, demand: str, supply: str, steps: Mapping[str, Sequence[str]] | None = None) -> str:
    steps = steps or G.step_keys(local)
    ctes = {
        "pool": _POOL,
        "d0": f"select oms_order_id as id, *, {_groups_sql()} from ({demand})",
        "s0": f"select oms_order_id as id, *, {_groups_sql()} from ({supply})",
    }
    found = []
    for i, (name, cols) in enumerate(steps.items(), 1):
        key = "||'|'||".join(f"coalesce({c},'~')" for c in cols)
        for side in "ds":
            ctes[f"{side}k{i}"] = (f"select id, k, row_number() over (partition by k order by id) as rn "
                                   f"from (select id, {key} as k from {side}{i - 1})")
        ctes[f"m{i}"] = f"select a.id, b.id as supply_id, '{name}' as match_step from dk{i} a join sk{i} b on a.k = b.k and a.rn = b.rn"
        ctes[f"d{i}"] = f"select * from d{i - 1} where id not in (select id from m{i})"
        ctes[f"s{i}"] = f"select * from s{i - 1} where id not in (select supply_id from m{i})"
        found.append(f"select * from m{i}")
    body = f"select d0.id, supply_id, match_step from d0 left join ({' union all '.join(found)}) m on m.id = d0.id"
    return with_views("matching_run dc_map dc_regions", body, ctes)


_ANY = f"select * from matching_run where items_vehicle_generation_id = 'GEN-2' and {_OPEN}"
_LOCAL_DEMAND = f"""select m.* exclude (distribution_center), coalesce(dc,'8101') as distribution_center
  from (select * from matching_run where items_vehicle_generation_id = 'GEN-2' and {_READY}) m left join dc_map on ship_to_zipcode = customer_zip"""
_LOCAL_SUPPLY = f"select * exclude (distribution_center), dc0 as distribution_center from pool where {_LOCAL}"

_NEAR_STEPS = {
    "scoped": _DASHBOARD["scoped"].replace("paint_id, interior_id,", "paint_id, interior_id, wheels_id, tonneau_id, accents_and_badging_id, roof_id, audio_id, utility_panel_id, "
              "case when charging_port_id = 'CHRG-NACS01' then replace(model_year,'2025','2026') else model_year end as model_year,", 1),
    "base": _DASHBOARD["base"],
    "firm": "select * from base where inventory_policy_compliance = 'Not Compliant' and production_zone = '4. Firm'",
    "catalog": "select * from item_master where is_inventory_policy_eligible = 1",
}


def _near_steps(paint: bool) -> dict[str, str]:
    cols = BLOCK if paint else BLOCK[:3]
    on = " and ".join(f"c.{x} = u.{x}" for x in cols)
    score = ("cast(floor(100.0::double * (greatest(length(u.cfg), length(c.config_string)) - levenshtein(u.cfg, c.config_string))"
             " / greatest(length(u.cfg), length(c.config_string)) + 0.5) as int)")
    keys = ", ".join(cols)
    return _NEAR_STEPS | {
        "scored": f"""select u.*, c.config_string as other, {score} as score from (select distinct {keys}, cfg from firm) u
  join (select distinct {keys}, config_string from catalog) c on {on}""",
        "best": f"select * from (select *, row_number() over (partition by {keys}, cfg order by score desc, other) as rn from scored) where rn = 1",
        "near": f"""select f.*, other, coalesce(score, 0) as score from firm f left join
  (select {keys}, cfg, other, score from best) b on f.cfg = b.cfg and {' and '.join(f'f.{x} = b.{x}' for x in cols)}""",
    }


def _near_sql(body: str, paint: bool = True, extra: dict[str, str] | None = None, views: str = "item_master vehicles") -> str:
    return with_views(views, body, _near_steps(paint) | (extra or {}))


def _diff_sql() -> str:
    changed = ", ".join(
        f"nullif(nullif(regexp_extract(other, '_({prefix}-[^_]*)', 1), ''), {PAIRS[_DECODED[name]]}) as {_DECODED[name]}"
        for prefix, name in K.OPTION_PREFIXES.items()
    )
    return _near_sql(f"""select vehicle_id, split_part(other,'_',1) as suggested_model_year,
  case split_part(other,'_',2) when 'US' then 'RGN-USA' when 'CA' then 'RGN-CAN' end as suggested_country,
  replace(split_part(other,'_',3), ' ', '_') as suggested_model_powertrain,
  case when regexp_extract(other, '_(WHL-[^_]*)', 1) in ('WHL-2','WHL-3') then 'ATP-001' else 'ATP-NULL' end as marketing_atp,
  {changed} from near""")


def _priority_sql() -> str:
    from fleetloom.plans.inventory import _STATE

    extra = _STATE | {"picture": "select config_string, supply/velocity as dos, demand from state",
                      "whole": "select sum(demand)::double as total, max(dos) as longest from picture"}
    return _near_sql("""select vehicle_id, other as best_match_config_string, round(score / 100.0::double * 0.6::double
  + (1 - coalesce(dos, 0) / longest) * 0.2::double + coalesce(demand, 0) / total * 0.2::double, 6) as priority
from near n left join picture p on p.config_string = n.other, whole""", extra=extra, views="item_master vehicles forecast")


QUERIES = {
    **{f"cohort_{p}": (partial(cohort, purpose=p), sql) for p, sql in _COHORT_SQL.items()},
    "supply_pool_normal": (partial(supply_pool, purpose="retry_matching_normal"), _pool_sql(
        "vehicle_status_code in (320,400,420,430,440,450,460) and dc0 = '8101'")),
    "supply_pool_local": (partial(supply_pool, purpose="retry_matching_local_sc"), _pool_sql(_LOCAL)),
    "supply_pool_regional": (partial(supply_pool, purpose="anywhere_to_anywhere"), _pool_sql(_LOCAL, True)),
    "hold_report": (hold_report, with_views("matching_run", f"""
select delivery_location_name, count(unique_build_id) as builds from matching_run where items_vehicle_generation_id = 'GEN-2'
  and {_MATCHED} and build_batch <> -2 and vehicle_status_code in (100,200,210,300,310,315,320,400) group by 1""")),
    "other_generation": (other_generation, with_views("matching_run", """
select oms_order_id, case when build_batch <> 5 then items_vehicle_generation_id end as items_vehicle_generation_id
from matching_run where items_vehicle_generation_id <> 'GEN-2' or build_batch = 5""")),
    "cascade_match": (cascade_match, _cascade_sql(False, _ANY, f"select * from pool where {_LOCAL}")),
    "cascade_match_optional": (cascade_match_optional, _cascade_sql(
        False, _ANY, f"select * from pool where {_LOCAL}", {step: keys.split() for step, keys in _OPTIONAL_KEYS.items()})),
    "cascade_match_local": (cascade_match_local, _cascade_sql(True, _LOCAL_DEMAND, _LOCAL_SUPPLY)),
    "nearest_config": (nearest, _near_sql(f"""select vehicle_id, cfg as config_string,
  coalesce(other, '{NO_CANDIDATE}') as best_match_config_string, score as best_match_score from near""")),
    "nearest_config_without_paint": (nearest_without_paint, _near_sql(
        "select vehicle_id, cfg as config_string, other as best_match_config_string, score as best_match_score from near", False)),
    "attribute_diff": (attribute_diff, _diff_sql()),
    "configs_before": (configs_before, _near_sql("select cfg as config_string, count(*) as vehicle_id_count from near group by 1")),
    "configs_after": (configs_after, _near_sql(
        f"select coalesce(other, '{NO_CANDIDATE}') as best_match_config_string, count(*) as vehicle_id_count from near group by 1")),
    "reconfiguration_priority": (reconfiguration_priority, _priority_sql()),
}

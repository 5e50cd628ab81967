"""SQL twins of the views in ``sources/domain.py``, as named common table expressions."""

from __future__ import annotations

from fleetloom.sources.domain import SERVICE_LEVELS

UNIT_ID = "l_orderkey||'-'||l_linenumber||'-'||l_partkey||'-'||l_suppkey||'-'||strftime(l_shipdate, '%Y%m%d')"
OPTIONS_KEY = (
    "model_powertrain||'_'||paint_id||'_'||interior_id||'_'||wheels_id||'_'||audio_id||'_'||"
    "roof_id||'_'||tonneau_id||'_'||accents_and_badging_id||'_'||utility_panel_id"
)
STATUS_LIST = (
    "['PRODUCTION_CONTROL_FROZEN','DELIVERED','PRODUCTION_STARTED','FACTORY_GATED','DECOMMISSIONED',"
    "'CREATED','IN_TRANSIT_TO_DISTRIBUTION_CENTER','VEHICLE_PREPPED']"
)

VIEWS = {
    "parts": """
select p_partkey, case when p_partkey % 2 = 0 then 'M1' else 'M2' end as model, p_type as powertrain,
  (case when p_partkey % 2 = 0 then 'M1' else 'M2' end)||' '||p_type as model_powertrain,
  'EXP-'||upper(split_part(p_name,' ',1)) as paint_id,
  'INT-'||(cast(substr(p_brand,7) as int) % 3) as interior_id,
  'WHL-'||(p_size % 5) as wheels_id,
  case when cast(substr(p_brand,7) as int) % 3 = 2 then 'AUD-P01' else 'AUD-STD' end as audio_id,
  case when p_size % 2 = 0 then 'ROOF-FGP' else 'ROOF-DGP' end as roof_id,
  case when p_size % 2 = 0 then 'TON-NULL' else 'TON-P02' end as tonneau_id,
  case when p_size % 5 < 2 then 'ACTBDG-DRK' else 'ACTBDG-BRT' end as accents_and_badging_id,
  case when p_size % 5 = 4 then 'UTL-NULL' when p_partkey % 2 = 0 then 'UTL-S01' else 'UTL-T01' end as utility_panel_id,
  case when p_size % 5 <> 4 then 1 else 0 end as is_inventory_policy_eligible,
  case when cast(substr(p_brand,7) as int) % 3 <> 1 then 1 else 0 end as is_product_plan_eligible,
  case when p_size % 5 = 0 then 'A1' when p_size % 5 < 3 then 'B1' else 'C1' end as sku_classification
from part""",
    "item_master": f"""
select distinct * exclude (p_partkey), '2026' as model_year, 'US' as country,
  '2026_US_'||{OPTIONS_KEY} as config_string,
  case when is_inventory_policy_eligible = 1 then 'Inventory Policy Compliant' else 'Not Compliant' end as compliance
from parts""",
    "vehicles": f"""
select *, model_year||'_US_'||{OPTIONS_KEY} as config_string from (
select {UNIT_ID} as vehicle_id,
  case when l_returnflag <> 'N' then 'VIN'||{UNIT_ID} end as vin,
  model, powertrain, model_powertrain, paint_id, interior_id, wheels_id, audio_id, roof_id, tonneau_id,
  accents_and_badging_id, utility_panel_id,
  case when l_linenumber % 2 = 0 or l_linenumber = 7 then '2025' else '2026' end as model_year,
  case when l_suppkey % 31 = 1 then null when l_suppkey % 10 = 0 then 'CA' else 'US' end as country,
  case when l_linenumber % 2 = 0 then 'CHRG-NACS01' else 'CHRG-CCS01' end as charging_port_id,
  {STATUS_LIST}[cast((l_orderkey*7+l_partkey) % 8 as int)+1] as vehicle_status,
  case when l_suppkey % 11 = 1 then 'CANCELED' else 'ACTIVE' end as vehicle_record_status,
  case when l_partkey % 13 = 1 then 'INTERNAL' else 'CUSTOMER_DELIVERY' end as vehicle_usage,
  case when l_partkey % 53 = 1 then 'GEN-1' else 'GEN-2' end as vehicle_generation,
  case when l_suppkey % 19 = 1 then null when l_suppkey % 17 = 1 then 'NON_SALEABLE' else 'SALEABLE' end as vin_salability,
  (case when l_suppkey % 23 = 1 then null when l_suppkey % 3 = 0 then '8101' else cast(8000 + l_suppkey % 20 as varchar) end)
    ||(case when l_linenumber = 5 then '.0' else '' end) as distribution_center,
  case when l_linestatus = 'F' then 'REAL' end as match_status,
  case when l_linestatus = 'F' then 1 else 0 end as is_matched,
  case when (l_orderkey*7+l_partkey) % 8 = 1 then 1 else 0 end as is_delivered,
  case when l_partkey % 29 = 1 then 'US_FLEET_20250201' when cast(l_quantity as int) % 4 = 0 then 'US_Custom_20250101'
    when cast(l_quantity as int) % 4 = 1 then 'US_Inventory_20250115'
    when cast(l_quantity as int) % 4 = 2 then 'US_Launch-Order_soon' end as metadata_source_order,
  case when l_partkey % 41 = 1 then 'BLD-LAUNCH' else 'BLD-'||model end as build_id,
  cast(l_shipdate as date) as expected_ga_in_date,
  case when l_returnflag <> 'N' then cast(l_shipdate as date) end as actual_ga_in_date,
  cast(l_shipdate as date) + 7 as expected_factory_gate_date,
  case when l_returnflag <> 'N' then cast(l_shipdate as date) + 7 end as actual_factory_gate_date,
  cast(l_shipdate as date) - 14 as expected_build_date_ip,
  'L'||s_nationkey as location_id, n_name as location_name,
  case when r_regionkey < 3 then 'US'||r_name when r_regionkey = 3 then r_name end as comm_ops_region
from lineitem join parts on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
  join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)""",
    "forecast": f"""
select l_linenumber as id, {UNIT_ID} as order_id, cast(l_shipdate as date) as order_date,
  case when l_suppkey % 4 = 1 then '2025' else '2026' end||'_US_'||{OPTIONS_KEY} as config_string, model_powertrain,
  '2026' as model_year,
  case when l_suppkey % 31 = 1 then null when l_suppkey % 10 = 0 then 'CA' else 'US' end as country
from lineitem join parts on l_partkey = p_partkey where l_linestatus = 'O'""",
    "order_lines": f"""
select *, model_year||'_US_'||{OPTIONS_KEY} as config_string from (
select {UNIT_ID} as order_id, cast(o_orderdate as date) as order_date,
  case when l_linenumber = 7 then 'Reservation' else 'Order' end as order_type,
  case when l_suppkey % 9 = 1 then 'CUSTOMER_UNRESPONSIVE' when l_suppkey % 9 = 2 then 'CANCELLED'
    when l_suppkey % 9 = 3 then null else 'IN_PROGRESS' end as fulfillment_status,
  case when l_partkey % 17 = 1 then 1 else 0 end as is_cancelled,
  case when l_suppkey % 10 = 0 then 'CA' else 'US' end as country,
  lpad(cast(o_custkey % 100000 as varchar), 5, '0')||(case when o_custkey % 7 = 0 then '-1234' else '' end) as zip_code,
  case when l_suppkey % 6 = 0 then 'Plant Normal' else 'Site '||(l_suppkey % 12) end as location_name,
  case when l_linenumber % 2 = 0 then '2025' else '2026' end as model_year,
  case when l_partkey % 53 = 1 then 'GEN-1' else 'GEN-2' end as vehicle_generation,
  model, powertrain, model_powertrain, paint_id, interior_id, wheels_id, audio_id, roof_id, tonneau_id,
  accents_and_badging_id, utility_panel_id
from lineitem join orders on l_orderkey = o_orderkey join parts on l_partkey = p_partkey)""",
    "zip_map": """
select case when instr(zip5,'-') > 0 then split_part(zip5,'-',1) when zip5[1] = '0' then substr(zip5,2) else zip5 end as customer_zip_code,
  case when nationkey % 5 = 0 then '8101' else cast(8100 + nationkey as varchar) end as sap_sc_code,
  case when nationkey % 5 = 0 then 'Normal' else 'SC-'||n_name end as sc_name
from (select lpad(cast(c_custkey % 100000 as varchar), 5, '0') as zip5, min(c_nationkey) as nationkey
  from customer group by 1) join nation on nationkey = n_nationkey""",
    "lanes": """
select cast(8100 + n_nationkey as double) as location_id, 'SC-'||n_name as location_name,
  case when n_nationkey % 6 = 5 then 'Spot' else 'Contracted' end as lane_type, date '2001-06-01' as month,
  cast(n_nationkey * 3 + 7 as double) as total_lead_time
from nation""",
    "service_levels": """
select * from (values {}) as t(location_type, model, sku_class, service_level, annual_demand_threshold, ss_coverage_max)
""".format(", ".join(f"('{a}','{b}','{c}',{d}::double,{e}::double,{f}::double)" for a, b, c, d, e, f in SERVICE_LEVELS)),
    "revenue": f"""
select l_orderkey as oms_order_id, {UNIT_ID} as row_id,
  case l_linenumber % 6 when 0 then '12+0' when 1 then '9+3' when 2 then '6+6' when 3 then '3+9' when 4 then '0+12' end as forecast_version,
  case when l_linenumber % 6 <> 5 then 2024 + cast(l_suppkey as int) % 2 end as forecast_version_year,
  l_extendedprice as revenue, l_extendedprice as base_price,
  case when l_suppkey % 8 <> 1 then l_tax * 1000 end as options,
  -l_extendedprice * l_discount as total_discount,
  case when l_suppkey % 5 <> 1 then l_discount * 100 end as referral_discount,
  case when l_suppkey % 7 <> 1 then -l_tax * 200 end as price_adjustments,
  case when l_partkey % 4 = 1 then l_tax * 500 end as lease_down_payment_credit,
  case when l_partkey % 6 = 1 then l_discount * 300 end as lease_subvention,
  case when l_partkey % 9 = 1 then l_discount * 400 end as apr_subvention
from lineitem""",
    "placed_orders": """
select o_orderkey as order_id, cast(o_orderdate as date) as order_date,
  case when o_orderkey % 11 = 1 then 'Reservation' else 'Order' end as order_type,
  case when o_orderkey % 23 = 1 then 'GEN-1' else 'GEN-2' end as vehicle_generation,
  'M'||(o_orderkey % 2 + 1)||' '||o_orderpriority as model_powertrain,
  case o_orderstatus when 'F' then 'Lease' when 'O' then 'Loan' end as payment_type,
  case when o_custkey % 10 = 0 then 'CA' else 'US' end as country
from orders""",
    "marketing_daily": """
select cast(l_shipdate as date) as date_pt,
  sum(case when l_returnflag = 'A' then cast(round(l_extendedprice * 100) as bigint) end) as spend_search,
  sum(case when l_returnflag = 'R' then cast(round(l_extendedprice * 100) as bigint) end) as spend_social,
  count(case when l_returnflag = 'A' then 1 end) as clicks_search,
  count(case when l_returnflag = 'R' then 1 end) as clicks_social,
  sum(cast(l_quantity as bigint)) as impressions_search,
  count(case when l_linestatus = 'F' then 1 end) as drives_demo,
  count(case when l_linestatus = 'O' then 1 end) as drives_total,
  count(distinct l_suppkey) as leads_web, sum(l_linenumber) as leads_total, sum(l_suppkey % 50) as opens_email,
  sum(l_partkey % 20) as foot_traffic, sum(l_orderkey % 30) as web_traffic_total,
  count(distinct l_orderkey) as orders_total
from lineitem group by 1""",
    "matching_run": f"""
select {UNIT_ID} as oms_order_id,
  case l_linenumber % 3 when 0 then 'Unallocated' when 1 then 'Customer Configured' else 'Shop' end as build_type_internal,
  case l_orderkey % 4 when 2 then 'ORDERED' when 3 then 'RESERVED' else 'CONFIGURED' end as financial_status,
  case when l_suppkey % 9 = 1 then 'CUSTOMER_UNRESPONSIVE' when l_suppkey % 9 = 2 then 'CUSTOMER_NOT_READY_TO_CONFIRM'
    when l_suppkey % 9 = 3 then null else 'IN_PROGRESS' end as fulfillment_status,
  case when l_linestatus = 'F' then (case when l_linenumber % 2 = 0 then 'PREDICTIVE' else 'REAL' end) end as match_status,
  [100,200,210,300,310,315,320,400,410,420,430,440,450,460][cast((l_orderkey+l_partkey) % 14 as int)+1] as vehicle_status_code,
  {STATUS_LIST}[cast((l_orderkey*7+l_partkey) % 8 as int)+1] as vehicle_status,
  case when l_partkey % 13 = 1 then 'INTERNAL' else 'CUSTOMER_DELIVERY' end as vehicle_usage,
  case when l_suppkey % 7 = 1 then 'QUALITY' end as hold_type,
  case when l_partkey % 25 = 1 then -2 else l_partkey % 25 end as build_batch,
  case when l_partkey % 53 = 1 then 'GEN-1' else 'GEN-2' end as vehicle_architecture,
  case when l_partkey % 53 = 1 then 'GEN-1' else 'GEN-2' end as items_vehicle_generation_id,
  cast(l_shipdate as date) as expected_general_assembly_date,
  case when l_linenumber = 5 then '8101.0' when l_suppkey % 3 = 0 then '8101' else cast(8000 + l_suppkey % 20 as varchar) end as distribution_center,
  lpad(cast(o_custkey % 100000 as varchar), 5, '0') as ship_to_zipcode,
  'Site '||(l_suppkey % 12) as delivery_location_name,
  case when l_partkey % 7 <> 1 then {UNIT_ID} end as unique_build_id,
  case when l_linenumber = 1 then (case l_partkey % 3 when 0 then 'The price is not what I expected' when 1 then 'Delivery isn''t soon enough' else 'Other' end) end as question1_response,
  case when l_linenumber = 2 then (case l_partkey % 3 when 0 then 'Pricing' when 1 then 'Delivery date' else 'Other' end) end as cancel_code,
  model as sku, powertrain as trim, 'MOT-'||substr(interior_id,5) as motor,
  case when powertrain in ('LARGE','MEDIUM') then 'BAT-MAX' else 'BAT-STD' end as battery,
  paint_id as exterior, interior_id as interior, wheels_id as wheels,
  case when wheels_id = 'WHL-3' then 'ORD-001' end as offroad,
  case when wheels_id = 'WHL-3' then 'ATP-001' when wheels_id <> 'WHL-2' then 'ATP-NULL' end as atp,
  tonneau_id as tonneau, case when l_suppkey % 10 = 0 then 'RGN-CAN' else 'RGN-USA' end as build_country,
  roof_id as roof, audio_id as audio, utility_panel_id as utility, accents_and_badging_id as badging
from lineitem join orders on l_orderkey = o_orderkey join parts on l_partkey = p_partkey""",
    "dc_map": """
select lpad(cast(n as varchar), 5, '0') as customer_zip,
  case when n % 3 = 0 then '8101' else cast(8000 + n % 20 as varchar) end as dc
from (select distinct c_custkey % 100000 as n from customer) where n % 4 <> 1""",
    "dc_regions": """
select '8101' as distribution_center_text, 'Central' as dc_region union all
select cast(8000 + i as varchar), case when i % 2 = 0 then 'East' else 'West' end from range(18) t(i)""",
}
_NEEDS = {
    "item_master": ("parts",),
    "vehicles": ("parts",),
    "forecast": ("parts",),
    "order_lines": ("parts",),
    "matching_run": ("parts",),
}


def with_views(views: str, body: str, steps: dict[str, str] | None = None) -> str:
    """``body`` behind the named views and further named ``steps``, in dependency order."""
    names: list[str] = []
    for v in views.split():
        names += [n for n in (*_NEEDS.get(v, ()), v) if n not in names]
    ctes = {n: VIEWS[n] for n in names} | (steps or {})
    return "with " + ",\n".join(f"{n} as ({sql})" for n, sql in ctes.items()) + "\n" + body


# Statuses of built units.
_BUILT = ("'PRODUCTION_STARTED','ARRIVED_AT_DISTRIBUTION_CENTER','FACTORY_GATED','FACTORY_OK','GENERAL_ASSEMBLY_COMPLETED',"
          "'IN_TRANSIT_TO_DISTRIBUTION_CENTER','INTERNAL_RECEIVED','PDI_COMPLETED','PDI_STARTED','RETURNED','STAGED_FOR_PDI','VEHICLE_PREPPED'")


def zone_sql(no_vin: str, with_vin: str, normal: str, field: str | None, liquid: str) -> str:
    """Production stage with the given labels; no split by site without ``field``."""
    built = f"vehicle_status in ({_BUILT}) and vin is not null"
    dc = "regexp_replace(distribution_center, '\\.0$', '')"
    stage = f"when {built} then '{normal}'" if field is None else (
        f"when {built} and {dc} = '8101' then '{normal}' when {built} and {dc} <> '8101' then '{field}'")
    return f"""case when vehicle_status = 'PRODUCTION_CONTROL_FROZEN' and vin is null then '{no_vin}'
  when vehicle_status = 'PRODUCTION_CONTROL_FROZEN' then '{with_vin}' when vehicle_status = 'DELIVERED' then 'Delivered'
  {stage} when vehicle_status = 'DECOMMISSIONED' then 'Decommissioned'
  when vehicle_status = 'CREATED' and vehicle_record_status = 'ACTIVE' then '{liquid}' else 'Investigate' end"""

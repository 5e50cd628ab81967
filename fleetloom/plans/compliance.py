"""Compliance dashboard queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom.functions import labels as L
from fleetloom.functions.config_key import short_config
from fleetloom.operators import compliance as C
from fleetloom.operators.joins import option_list
from fleetloom.plans import params as P
from fleetloom.plans.views_sql import with_views, zone_sql
from fleetloom.sources import domain as D

SELECTED = (L.DASHBOARD_ZONES.frozen_vin, L.DASHBOARD_ZONES.frozen_no_vin)
# Regions of the test tables stand in for the four delivery regions.
COHORTS = dict(list(C.COHORTS.items())[:8]) | {
    "africa": (None, None, "AFRICA"),
    "america": (None, None, "AMERICA"),
    "asia": (None, None, "ASIA"),
    "canada": (None, None, "Canada"),
}
# Zone names of the stored table.
STORED_ZONES = L.ZoneLabels("Firm", "Frozen/ VINned", "Already Built/ WIP", None, "Liquid")
STORED_BUCKETS = {"built": ["Already Built/ WIP"], "frozen": ["Frozen/ VINned"], "firm": ["Firm"]}
SPLIT_BUCKETS = {
    "built": [L.DASHBOARD_ZONES.built, L.DASHBOARD_ZONES.built_field],
    "frozen": [L.DASHBOARD_ZONES.frozen_vin],
    "firm": [L.DASHBOARD_ZONES.frozen_no_vin],
}


def _base(spark: SparkSession, root: str) -> DataFrame:
    return C.dashboard_vehicles(
        D.vehicles(spark, root, sites=True), D.item_master(spark, root), P.EXCLUDE_SOURCE, P.LAUNCH_SOURCE, P.LAUNCH_BUILDS
    )


def production_zone_counts(spark: SparkSession, root: str) -> DataFrame:
    v = D.vehicles(spark, root)
    zones = v.withColumns({
        "planning_zone": L.production_zone(L.PLANNING_ZONES),
        "dashboard_zone": L.production_zone(L.DASHBOARD_ZONES),
        "vin_status": L.vin_status(),
    })
    return zones.groupBy("planning_zone", "dashboard_zone", "vin_status").agg(F.count(F.lit(1)).alias("vehicles"))


def sequence_dates(spark: SparkSession, root: str) -> DataFrame:
    v = D.vehicles(spark, root).withColumn("production_zone", L.production_zone(L.PLANNING_ZONES))
    month = F.trunc(L.sequence_date(P.RUN_DATE), "month").alias("sequence_month")
    return v.groupBy("production_zone", month).agg(F.count(F.lit(1)).alias("vehicles"))


def source_orders(spark: SparkSession, root: str) -> DataFrame:
    parts = [c.alias(n) for n, c in L.source_order_parts().items()]
    return (
        D.vehicles(spark, root)
        .select("metadata_source_order", *parts, L.custom_flag(rule="planning").alias("planning_flag"),
                L.custom_flag(rule="dashboard").alias("dashboard_flag"))
        .groupBy("metadata_source_order", "intended_order", "custom_v_inventory_split", "freeze_date",
                 "planning_flag", "dashboard_flag")
        .agg(F.count(F.lit(1)).alias("vehicles"))
    )


def compliance_kpis(spark: SparkSession, root: str) -> DataFrame:
    return C.cohort_kpis(_base(spark, root), COHORTS).withColumn("ratio", F.round("ratio", 6))


def kpi_boxes(spark: SparkSession, root: str) -> DataFrame:
    return C.kpi_boxes(_base(spark, root), SELECTED)


def orders_by_flag(spark: SparkSession, root: str) -> DataFrame:
    frozen = _base(spark, root).filter(F.col("production_zone") == L.DASHBOARD_ZONES.frozen_vin)
    return C.count_by(frozen, ["custom_v_inventory_flag", "inventory_policy_compliance"])


def vins_by_flag(spark: SparkSession, root: str) -> DataFrame:
    cols = ["production_zone", "custom_v_inventory_flag", "inventory_policy_compliance"]
    return C.count_by(_base(spark, root), cols, "vin", "vin_count")


def site_compliance(spark: SparkSession, root: str) -> DataFrame:
    field = C.field_vehicles(D.vehicles(spark, root, sites=True), D.item_master(spark, root))
    return C.compliance_table(field, ["location_name", "location_id", "location_region"])


def region_compliance(spark: SparkSession, root: str) -> DataFrame:
    field = C.field_vehicles(D.vehicles(spark, root, sites=True), D.item_master(spark, root), "other")
    return C.compliance_table(field, ["location_region"]).orderBy("location_region")


def _field_of_one_model(spark: SparkSession, root: str, missing_region: str | None = None) -> DataFrame:
    return C.field_vehicles(D.vehicles(spark, root, sites=True), D.item_master(spark, root), missing_region, ["M1"])


def site_compliance_of_model(spark: SparkSession, root: str) -> DataFrame:
    """Site compliance of the listed models only."""
    return C.compliance_table(_field_of_one_model(spark, root), ["location_name", "location_id", "location_region"])


def region_compliance_of_model(spark: SparkSession, root: str) -> DataFrame:
    return C.compliance_table(_field_of_one_model(spark, root, "other"), ["location_region"]).orderBy("location_region")


def _launch(df: DataFrame) -> DataFrame:
    return df.filter(
        L.launch_flag(P.LAUNCH_SOURCE, P.LAUNCH_BUILDS)
        & (F.col("vehicle_status") != "CREATED")
        & (F.col("vehicle_record_status") != "CANCELED")
        & F.col("config_string").isNotNull()
    ).withColumn("pair", L.pair_label(P.PAINT_PAIRS)).withColumn(
        "config", short_config(("country", "model", "pair"))
    )


def launch_pivot_by_label(spark: SparkSession, root: str) -> DataFrame:
    v = D.vehicles(spark, root).withColumn("production_zone", L.production_zone(STORED_ZONES))
    delivered = _launch(v).filter((F.col("vehicle_usage") == "CUSTOMER_DELIVERY") & (F.col("wheels_id") != "WHL-3"))
    return C.distinct_pivot(delivered, ["config"], STORED_BUCKETS).orderBy(F.desc("config"))


def launch_pivot_dashboard(spark: SparkSession, root: str) -> DataFrame:
    by = ["config", "country", "model", "paint_id", "interior_id"]
    return C.distinct_pivot(_launch(_base(spark, root)), by, SPLIT_BUCKETS).drop("country", "model", "paint_id", "interior_id")


def launch_pivot_stored(spark: SparkSession, root: str) -> DataFrame:
    by = ["config", "country", "model", "paint_id", "interior_id"]
    df = _launch(_base(spark, root)).withColumn("stored_zone", L.production_zone(STORED_ZONES))
    return C.distinct_pivot(df, by, STORED_BUCKETS, zone="stored_zone").drop("country", "model", "paint_id", "interior_id")


def compliance_by_month(spark: SparkSession, root: str) -> DataFrame:
    df = _base(spark, root).withColumn("month", F.trunc("sequence_date", "month"))
    shared = C.with_share(df, ["month", "inventory_policy_compliance"], "vin", ["month"])
    return shared.withColumn("share", F.round("share", 6))


def compliance_by_zone(spark: SparkSession, root: str) -> DataFrame:
    by = ["production_zone", "model_powertrain", "inventory_policy_compliance"]
    shared = C.with_share(_base(spark, root), by, "vehicle_id", ["production_zone", "model_powertrain"])
    return shared.withColumn("share", F.round("share", 6))


def zone_options(spark: SparkSession, root: str) -> DataFrame:
    return option_list(_base(spark, root), "production_zone")


PLANNING_SQL = zone_sql("Frozen", "Firm/ VINned", "Already Built/ WIP", None, "Liquid")
DASHBOARD_SQL = zone_sql("4. Firm", "3. Frozen/VINned", "1. Already Built/ WIP at Normal", "2. Already Built/ WIP in Field", "5. Liquid")
STORED_SQL = zone_sql("Firm", "Frozen/ VINned", "Already Built/ WIP", None, "Liquid")
REGION_SQL = "case when substr(comm_ops_region,1,2) = 'US' then substr(comm_ops_region,3) else comm_ops_region end"
ROLLED_SQL = "case when charging_port_id = 'CHRG-NACS01' then replace(config_string,'2025','2026') else config_string end"
LAUNCH_SQL = f"(metadata_source_order like '{P.LAUNCH_SOURCE}' or build_id in ('BLD-LAUNCH'))"
# Statuses and usages of the scope.
SCOPE_SQL = """vehicle_generation = 'GEN-2' and vehicle_status not in ('DECOMMISSIONED','DELIVERED')
  and vehicle_record_status = 'ACTIVE' and vehicle_usage = 'CUSTOMER_DELIVERY'"""
_PAIR = ("country||' | '||model||' | '||(case when paint_id = 'EXP-BLUE' and interior_id = 'INT-2' then 'Blue x Slate' "
         "when paint_id = 'EXP-GREEN' and interior_id = 'INT-1' then 'Green x Black' else 'Other' end)")
_STEPS = {
    "scoped": f"""select vehicle_id, vin, country, model, model_powertrain, paint_id, interior_id, build_id, metadata_source_order,
  vehicle_status, vehicle_record_status, {DASHBOARD_SQL} as production_zone, {STORED_SQL} as stored_zone,
  case when metadata_source_order like '%Custom%' or metadata_source_order like '%Order%' then 'Custom' else 'Inventory' end as custom_v_inventory_flag,
  {REGION_SQL} as location_region, {ROLLED_SQL} as cfg, expected_ga_in_date as sequence_date
  from vehicles where {SCOPE_SQL} and is_matched = 0 and coalesce(metadata_source_order,'missing') not like '{P.EXCLUDE_SOURCE}'""",
    "base": """select s.*, i.compliance as inventory_policy_compliance from scoped s left join item_master i on s.cfg = i.config_string""",
    "field": f"""select f.*, coalesce(i.compliance,'Not Compliant') as comp from (select *, {DASHBOARD_SQL} as zone, {REGION_SQL} as region,
  {ROLLED_SQL} as cfg from vehicles where {SCOPE_SQL} and match_status is null) f left join item_master i on f.cfg = i.config_string
  where zone = '2. Already Built/ WIP in Field'""",
}
_YES = "inventory_policy_compliance = 'Inventory Policy Compliant'"


def _sql(body: str) -> str:
    return with_views("item_master vehicles", body, _STEPS)


def _cohorts_sql() -> str:
    rows = []
    for name, (zone, flag, region) in COHORTS.items():
        conds = [f"{c} = '{v}'" for c, v in zip(("production_zone", "custom_v_inventory_flag", "location_region"), (zone, flag, region)) if v]
        rows.append(f"""select '{name}' as cohort, count(*) filter (where {_YES}) as compliant_qty, count(*) as total_qty
  from base where {' and '.join(conds) or 'true'}""")
    return _sql("select *, round(r,6) as ratio, cast(trunc(r*100) as int)||'%' as percent_text from (select *, "
                "coalesce(compliant_qty / nullif(total_qty,0), 0.0) as r from (" + " union all ".join(rows) + ")"
                ")").replace("select *, round(r,6)", "select * exclude (r), round(r,6)")


def _pivot_sql(source: str, by: str, built: str, frozen: str, firm: str, zone: str = "production_zone", extra: str = "true") -> str:
    named = ",".join(f"'{z}'" for z in (*built.split("|"), frozen, firm))
    built = ",".join(f"'{z}'" for z in built.split("|"))
    return f"""select {_PAIR} as config, count(distinct vehicle_id) filter (where {zone} in ({built})) as built,
  count(distinct vehicle_id) filter (where {zone} = '{frozen}') as frozen, count(distinct vehicle_id) filter (where {zone} = '{firm}') as firm,
  count(distinct vehicle_id) filter (where {zone} not in ({named})) as others, count(distinct vehicle_id) as supply
from {source} where {LAUNCH_SQL} and vehicle_status <> 'CREATED' and vehicle_record_status <> 'CANCELED' and {extra} group by {by}"""


_TABLE = """count(*) filter (where comp = 'Inventory Policy Compliant') as compliant_vehicles,
  count(*) filter (where comp = 'Not Compliant') as non_compliant_vehicles, count(*) as total_vehicles,
  round(count(*) filter (where comp = 'Inventory Policy Compliant') * 100.0::double / count(*), 2) as percent_compliant from field"""
# Zone names, and the date that places a unit of each.
_SEQ = f"""case when zone in ('Frozen','Firm/ VINned') then expected_ga_in_date
  when vehicle_status in ('GENERAL_ASSEMBLY_COMPLETED','FACTORY_OK','PRODUCTION_STARTED') or zone = 'Already Built/ WIP' then actual_ga_in_date
  when zone = 'Liquid' then expected_build_date_ip else date '{P.RUN_DATE}' end"""

QUERIES = {
    "production_zone_counts": (production_zone_counts, with_views("vehicles", f"""
select {PLANNING_SQL} as planning_zone, {DASHBOARD_SQL} as dashboard_zone,
  case when vin is not null then 'vin_created' else 'vin_not_created' end as vin_status, count(*) as vehicles from vehicles group by 1,2,3""")),
    "sequence_dates": (sequence_dates, with_views("vehicles", f"""
select zone as production_zone, cast(date_trunc('month', {_SEQ}) as date) as sequence_month, count(*) as vehicles
from (select *, {PLANNING_SQL} as zone from vehicles) group by 1,2""")),
    "source_orders": (source_orders, with_views("vehicles", """
select metadata_source_order, split_part(metadata_source_order,'_',1) as intended_order,
  split_part(metadata_source_order,'_',2) as custom_v_inventory_split,
  cast(try_strptime(split_part(metadata_source_order,'_',3), '%Y%m%d') as date) as freeze_date,
  case when lower(metadata_source_order) like '%custom%' then 'Custom' else 'Inventory' end as planning_flag,
  case when metadata_source_order like '%Custom%' or metadata_source_order like '%Order%' then 'Custom' else 'Inventory' end as dashboard_flag,
  count(*) as vehicles from vehicles group by all""")),
    "compliance_kpis": (compliance_kpis, _cohorts_sql()),
    "kpi_boxes": (kpi_boxes, _sql(f"""select count(distinct cfg) as distinct_configs, count(*) filter (where {_YES}) as compliant_vehicles,
  count(*) as total_vehicles from base where production_zone in ('3. Frozen/VINned','4. Firm')""")),
    "orders_by_flag": (orders_by_flag, _sql("""select custom_v_inventory_flag, inventory_policy_compliance, count(*) as order_count
from base where production_zone = '3. Frozen/VINned' group by 1,2""")),
    "vins_by_flag": (vins_by_flag, _sql("""select production_zone, custom_v_inventory_flag, inventory_policy_compliance, count(vin) as vin_count
from base group by 1,2,3""")),
    "site_compliance": (site_compliance, _sql(f"select location_name, location_id, region as location_region, {_TABLE} group by 1,2,3")),
    "region_compliance": (region_compliance, _sql(f"select coalesce(region,'other') as location_region, {_TABLE} group by 1")),
    "site_compliance_of_model": (site_compliance_of_model, _sql(
        f"select location_name, location_id, region as location_region, {_TABLE} where model = 'M1' group by 1,2,3")),
    "region_compliance_of_model": (region_compliance_of_model, _sql(
        f"select coalesce(region,'other') as location_region, {_TABLE} where model = 'M1' group by 1")),
    "launch_pivot_by_label": (launch_pivot_by_label, with_views("vehicles", _pivot_sql(
        f"(select *, {STORED_SQL} as production_zone from vehicles)", "1", "Already Built/ WIP", "Frozen/ VINned", "Firm",
        extra="vehicle_usage = 'CUSTOMER_DELIVERY' and wheels_id <> 'WHL-3'"))),
    "launch_pivot_dashboard": (launch_pivot_dashboard, _sql(_pivot_sql(
        "base", "country, model, paint_id, interior_id", "1. Already Built/ WIP at Normal|2. Already Built/ WIP in Field",
        "3. Frozen/VINned", "4. Firm"))),
    "launch_pivot_stored": (launch_pivot_stored, _sql(_pivot_sql(
        "base", "country, model, paint_id, interior_id", "Already Built/ WIP", "Frozen/ VINned", "Firm", "stored_zone"))),
    "compliance_by_month": (compliance_by_month, _sql("""select month, inventory_policy_compliance, vehicles,
  round(vehicles / nullif(sum(vehicles) over (partition by month), 0), 6) as share from (
  select cast(date_trunc('month', sequence_date) as date) as month, inventory_policy_compliance, count(vin) as vehicles from base group by 1,2)""")),
    "compliance_by_zone": (compliance_by_zone, _sql("""select *, round(vehicles / sum(vehicles) over (partition by production_zone, model_powertrain), 6) as share
from (select production_zone, model_powertrain, inventory_policy_compliance, count(vehicle_id) as vehicles from base group by 1,2,3)""")),
    "zone_options": (zone_options, _sql("select distinct production_zone from base")),
}

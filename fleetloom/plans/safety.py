"""Safety stock queries."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom.functions import labels as L
from fleetloom.functions.config_key import CONFIG_PARTS, remap_config
from fleetloom.operators import safety_stock as S
from fleetloom.operators.ordered import first_per_key
from fleetloom.plans import params as P
from fleetloom.plans.views_sql import OPTIONS_KEY, with_views
from fleetloom.session import materialize
from fleetloom.sources import domain as D


def _orders(spark: SparkSession, root: str) -> DataFrame:
    return D.order_lines(spark, root).filter(L.open_orders(*P.HISTORY, ("US", "CA"), ("2025", "2026")))


def _remap(spark: SparkSession, root: str) -> DataFrame:
    lines = D.order_lines(spark, root).filter("vehicle_generation = 'GEN-2' and order_type = 'Order'")
    return remap_config(lines.withColumn("country", F.lit("US")), P.REMAP)


def remap(spark: SparkSession, root: str) -> DataFrame:
    return _remap(spark, root)


def open_order_counts(spark: SparkSession, root: str) -> DataFrame:
    return _orders(spark, root).groupBy("model_year", "country").agg(F.count(F.lit(1)).alias("orders"))


def zip_codes(spark: SparkSession, root: str) -> DataFrame:
    z = D.order_lines(spark, root).select("zip_code", L.normalize_zip("zip_code").alias("zip"))
    return z.groupBy("zip").agg(F.count(F.lit(1)).alias("orders"))


def demand_history(spark: SparkSession, root: str, flags_by: str = "successor") -> DataFrame:
    items = materialize(D.item_master(spark, root))
    history = S.demand_history(
        _orders(spark, root), materialize(_remap(spark, root)), items, items, D.zip_map(spark, root), flags_by=flags_by
    )
    return history.select(
        "order_id", "order_week", S.KEY, "sap_sc_code", "location_type", "sku_classification",
        "inventory_policy_compliance", "product_plan_compliance", *CONFIG_PARTS,
    )


def _weekly(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Weekly orders per key and the number of order weeks."""
    orders = _orders(spark, root)
    weeks = materialize(S.week_count(orders))
    daily = S.daily_orders(orders, materialize(_remap(spark, root)), D.zip_map(spark, root))
    return materialize(S.weekly_orders(daily)), weeks


def daily_orders(spark: SparkSession, root: str) -> DataFrame:
    daily = S.daily_orders(_orders(spark, root), materialize(_remap(spark, root)), D.zip_map(spark, root))
    return daily.select(S.KEY, "order_date", "num_orders_on_date")


def weekly_demand_view(spark: SparkSession, root: str) -> DataFrame:
    view = S.weekly_view(*_weekly(spark, root))
    return view.withColumn("avg_orders_per_week", F.round("avg_orders_per_week", 6))


def dense_weekly_demand(spark: SparkSession, root: str) -> DataFrame:
    """A row per key and week, zero where nothing was ordered."""
    return S.dense_demand(_weekly(spark, root)[0])


def weekly_demand_stats(spark: SparkSession, root: str) -> DataFrame:
    stats = S.weekly_stats(*_weekly(spark, root))
    return stats.select(S.KEY, "average_weekly_demand", "annualized_demand",
                        F.round("standard_deviation_of_weekly_demand", 3).alias("sigma"))


def lane_lead_time(spark: SparkSession, root: str) -> DataFrame:
    return S.lane_weeks(D.lanes(spark, root), P.LANE_MONTH)


def service_level_z(spark: SparkSession, root: str) -> DataFrame:
    """z per service level and how many configurations of the item master use it."""
    levels = D.service_levels(spark)
    classes = D.item_master(spark, root).selectExpr("model", "substr(sku_classification, 1, 1) as sku_class")
    used = classes.join(F.broadcast(levels), ["model", "sku_class"]).groupBy("service_level").agg(
        F.count(F.lit(1)).alias("configs")
    )
    return used.join(S.service_level_z(levels), "service_level").withColumn("z", F.round("z", 6))


def safety_stock(spark: SparkSession, root: str) -> DataFrame:
    levels = D.service_levels(spark)
    keyed = S.add_parameters(
        S.weekly_stats(*_weekly(spark, root)), D.item_master(spark, root), levels,
        S.lane_weeks(D.lanes(spark, root), P.LANE_MONTH), model_chars=2,
    )
    timed = S.assign_lead_time(keyed, P.LEAD_TIME_FACTORY, P.SIGMA_FACTORY, P.SIGMA_FIELD)
    stocked = S.final_safety_stock(S.raw_safety_stock(timed, S.service_level_z(levels)))
    unique = first_per_key(stocked, [S.KEY], ["mapped_config_string"])
    return unique.select(
        S.KEY, "sku_class_letter", "service_level", "z_score", "lead_time",
        F.round("lead_time_std", 6).alias("lead_time_std"), "raw_safety_stock_units",
        "rounded_safety_stock_units", "rounded_safety_stock_coverage", "final_safety_stock_units",
        F.round("final_safety_stock_coverage_weeks", 6).alias("final_safety_stock_coverage_weeks"),
    )


def _case(col: str, values: dict[str, str], otherwise: str) -> str:
    whens = " ".join(f"when {col} = '{a}' then '{b}'" for a, b in values.items())
    return f"case {whens} else {otherwise} end" if whens else otherwise


def _listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_R = P.REMAP
_PREMIUM = f"powertrain in ({_listed(_R.premium_powertrains)})"
_PACKAGE = f"{_PREMIUM} and (audio_id = 'AUD-P01' or roof_id = 'ROOF-DGP')"
_REMAP_SQL = f"""select distinct cfg0 as config_string_original, model_year||'_US_'||{OPTIONS_KEY} as mapped_config_string,
  model_year, 'US' as country, model_powertrain, paint_id, interior_id, wheels_id, audio_id, roof_id, tonneau_id,
  accents_and_badging_id, utility_panel_id from (
  select config_string as cfg0, replace(model_year,'2025','2026') as model_year, model_powertrain, paint_id,
  {_case('interior_id', _R.interior, 'interior_id')} as interior_id,
  case when {_PREMIUM} and wheels_id = 'WHL-0' then 'WHL-2' else wheels_id end as wheels_id,
  case when {_PACKAGE} then 'AUD-P01' else audio_id end as audio_id,
  case when {_PACKAGE} then 'ROOF-DGP' else roof_id end as roof_id,
  case when model_powertrain in ({_listed(_R.tonneau_models)}) or tonneau_id = 'TON-NULL' then 'TON-P02' else tonneau_id end as tonneau_id,
  {_case('powertrain', _R.badging, 'accents_and_badging_id')} as accents_and_badging_id,
  case when config_string in ({_listed(_R.base_configs)}) then 'UTL-NULL'
    else {_case('model_powertrain', _R.utility, 'utility_panel_id')} end as utility_panel_id
  from order_lines where model_year = '2025' and vehicle_generation = 'GEN-2' and order_type = 'Order')"""
_ZIP = "case when instr({0},'-') > 0 then split_part({0},'-',1) when {0}[1] = '0' then substr({0},2) else {0} end"
_ATTRS = [c for c in CONFIG_PARTS if c != "country"]
_STEPS = {
    "remap": _REMAP_SQL,
    "open_orders": f"""select * from order_lines where order_date between date '{P.HISTORY[0]}' and date '{P.HISTORY[1]}'
  and country in ('US','CA') and is_cancelled = 0 and order_type <> 'Reservation' and model_year in ('2025','2026')
  and fulfillment_status not in ('CANCELLED','CUSTOMER_NOT_READY_TO_CONFIRM','CUSTOMER_UNRESPONSIVE')""",
    "weeks": "select count(distinct date_trunc('week', order_date)) as num_of_weeks from open_orders",
    "history": f"""select o.order_id, o.order_date, cast(date_trunc('week', o.order_date) as date) as order_week,
  coalesce(r.mapped_config_string, o.config_string) as mapped, z.sap_sc_code, z.sc_name,
  coalesce(r.mapped_config_string, o.config_string)||' | '||z.sc_name as {S.KEY}, coalesce(r.country, o.country) as country,
  r.mapped_config_string as successor, o.location_name,
  {', '.join(f'coalesce(r.{c}, o.{c}) as {c}' for c in _ATTRS)}
  from open_orders o left join remap r on o.config_string = r.config_string_original
  join zip_map z on z.customer_zip_code = {_ZIP.format('o.zip_code')} where z.sap_sc_code <> '8101'""",
    "weekly": f"""select {S.KEY}, min(mapped) as mapped, min(sap_sc_code) as sap_sc_code, min(sc_name) as sc_name, order_week,
  count(*) as x from history group by {S.KEY}, order_week""",
    "dense": f"""select k.{S.KEY}, w.order_week, coalesce(x, 0) as x from (select distinct {S.KEY} from weekly) k
  cross join (select distinct order_week from weekly) w left join weekly q on q.{S.KEY} = k.{S.KEY} and q.order_week = w.order_week""",
    "stats": f"""select w.{S.KEY}, min(mapped) as mapped, min(sap_sc_code) as sap_sc_code, min(sc_name) as sc_name,
  round(sum(x)::double / any_value(num_of_weeks), 4) as mu, round(sum(x)::double / any_value(num_of_weeks) * 52, 4) as annual
  from weekly w, weeks group by 1""",
    "sigmas": f"select {S.KEY}, round(stddev_samp(x), 4) as sd from dense group by 1",
    "lane_weeks": f"""select cast(cast(location_id as bigint) as varchar) as location_id, location_name, round(total_lead_time/7, 0) as total_lead_time
  from lanes where lane_type = 'Contracted' and month = date '{P.LANE_MONTH}'""",
    # z from tables of the normal distribution, not from the code under test.
    "z_table": """select * from (values (0.85::double, 1.0364333894937894::double), (0.90, 1.2815515655446008),
  (0.95, 1.6448536269514715), (0.98, 2.053748910631822)) as t(sl, z)""",
    "stocked": f"""select *, round_even(z, 3) as z_score, round_even(u, 3) as raw, cast(round_even(u, 0) as bigint) as units,
  cast(round_even(cast(round_even(u, 0) as bigint) / nullif(mu, 0), 0) as bigint) as cover from (
  select *, z * sqrt(lt * sd * sd + (lt_sd * mu) * (lt_sd * mu)) as u from (
  select s.*, g.sd, substr(i.sku_classification,1,1) as letter, v.service_level, v.annual_demand_threshold as threshold,
  v.ss_coverage_max as cap, z.z, l.total_lead_time as lt, {P.SIGMA_FIELD}::double * l.total_lead_time as lt_sd
  from stats s join sigmas g on g.{S.KEY} = s.{S.KEY} left join item_master i on i.config_string = s.mapped
  left join service_levels v on v.location_type = (case when s.sc_name like '%Normal%' then 'Normal' else 'Field' end)
    and v.model = substr(i.model_powertrain,1,2) and v.sku_class = substr(i.sku_classification,1,1)
  left join lane_weeks l on l.location_id = s.sap_sc_code left join z_table z on z.sl = v.service_level))""",
    "final": """select *, case when annual <= threshold then 0 when cover >= cap then cast(round_even(cap * mu, 0) as bigint)
  when cover < cap then units end as fin from stocked""",
}


def _sql(body: str) -> str:
    return with_views("order_lines zip_map item_master lanes service_levels", body, _STEPS)


def _history_sql(flagged: str) -> str:
    return _sql(f"""
select h.order_id, order_week, {S.KEY}, sap_sc_code, case when location_name like '%Normal%' then 'Normal' else 'Field' end as location_type,
  i.sku_classification, coalesce(i.compliance,'Not Compliant') as inventory_policy_compliance,
  case when i.is_product_plan_eligible = 1 then 'Product Plan Compliant' else 'Not Compliant' end as product_plan_compliance,
  {', '.join('h.' + c for c in CONFIG_PARTS)} from history h left join item_master i on i.config_string = {flagged}""")


QUERIES = {
    "remap_config": (remap, _sql("select * from remap")),
    "open_order_counts": (open_order_counts, _sql("select model_year, country, count(*) as orders from open_orders group by 1,2")),
    "zip_codes": (zip_codes, _sql(f"select {_ZIP.format('zip_code')} as zip, count(*) as orders from order_lines group by 1")),
    "demand_history": (demand_history, _history_sql("h.successor")),
    "demand_history_either_key": (partial(demand_history, flags_by="either"), _history_sql("h.mapped")),
    "daily_orders": (daily_orders, _sql(f"select {S.KEY}, order_date, count(*) as num_orders_on_date from history group by 1,2")),
    "weekly_demand_view": (weekly_demand_view, _sql(f"""
select {S.KEY}, order_week, x as weekly_orders, cast(sum(x) over (partition by {S.KEY}) as bigint) as total_orders, num_of_weeks,
  round(sum(x) over (partition by {S.KEY}) / num_of_weeks, 6) as avg_orders_per_week from weekly, weeks""")),
    "dense_weekly_demand": (dense_weekly_demand, _sql(
        f"select {S.KEY}, cast(order_week as date) as order_week, cast(x as bigint) as weekly_orders from dense")),
    "weekly_demand_stats": (weekly_demand_stats, _sql(f"""
select s.{S.KEY}, mu as average_weekly_demand, annual as annualized_demand, round(sd, 3) as sigma
from stats s join sigmas g on g.{S.KEY} = s.{S.KEY}""")),
    "lane_lead_time": (lane_lead_time, with_views("lanes", "select * from lane_weeks", {"lane_weeks": _STEPS["lane_weeks"]})),
    "service_level_z": (service_level_z, _sql("""
select service_level, count(*) as configs, round(any_value(z), 6) as z from item_master i join service_levels s
  on s.model = i.model and s.sku_class = substr(i.sku_classification, 1, 1) join z_table on sl = service_level group by 1""")),
    "safety_stock": (safety_stock, _sql(f"""
select {S.KEY}, letter as sku_class_letter, service_level, z_score, lt as lead_time, round(lt_sd, 6) as lead_time_std,
  raw as raw_safety_stock_units, units as rounded_safety_stock_units, cover as rounded_safety_stock_coverage,
  fin as final_safety_stock_units, round(coalesce(fin / nullif(mu, 0), 0), 6) as final_safety_stock_coverage_weeks from final""")),
}

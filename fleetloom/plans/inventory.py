"""Supply, demand, days of supply, allocation and freeze queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom.functions import labels as L
from fleetloom.functions.config_key import (
    INSTRUCTION_PREFIXES, build_option_id, decode_config, encode_config, region_code, roll_model_year,
)
from fleetloom.operators import allocate as A
from fleetloom.operators import supply_demand as SD
from fleetloom.operators.joins import enrich, small
from fleetloom.operators.pairing import exact_match
from fleetloom.operators.similar import similar_match
from fleetloom.plans import params as P
from fleetloom.plans.views_sql import with_views, zone_sql
from fleetloom.session import materialize
from fleetloom.sources import domain as D


def build_plan(spark: SparkSession, root: str) -> DataFrame:
    """Planned units per model: a tenth of the model's forecast lines, none for one model."""
    units = F.floor(F.count(F.lit(1)) / 10)
    plan = D.forecast(spark, root).groupBy("model_powertrain").agg(units.alias("n"))
    planned = F.when(F.col("model_powertrain") == "M2 PROMO", 0).otherwise(F.col("n"))
    # A row per model, used by every step below: written once instead of recounted.
    return materialize(plan.select("model_powertrain", planned.alias("units")))


def _context(spark: SparkSession, root: str):
    plan = build_plan(spark, root)
    models = SD.active_keys(plan)
    items = materialize(SD.eligible_items(D.item_master(spark, root), models))
    return plan, models, items


def active_models(spark: SparkSession, root: str) -> DataFrame:
    return SD.active_keys(build_plan(spark, root))


def supply_by_config(spark: SparkSession, root: str) -> DataFrame:
    _, models, items = _context(spark, root)
    supply = SD.supply_by_config(
        D.vehicles(spark, root), items, models, P.TARGET, P.EXCLUDE_SOURCE,
        exclude_countries=(), extra=("metadata_source_order",),
    )
    return supply


def demand_velocity(spark: SparkSession, root: str) -> DataFrame:
    _, models, items = _context(spark, root)
    demand = SD.demand_velocity(
        D.forecast(spark, root), items, models, P.AS_OF, P.TARGET, P.FORECAST_ID, exclude_countries=()
    )
    return demand.withColumn("velocity", F.round("velocity", 9))


def _state(spark: SparkSession, root: str, basis: str = "supply") -> DataFrame:
    return _state_and_plan(spark, root, basis)[0]


def _state_and_plan(spark: SparkSession, root: str, basis: str = "supply") -> tuple[DataFrame, DataFrame]:
    plan, models, items = _context(spark, root)
    supply = SD.supply_by_config(
        D.vehicles(spark, root), items, models, P.TARGET, P.EXCLUDE_SOURCE, compliant_only=True
    )
    demand = SD.demand_velocity(
        D.forecast(spark, root), items, models, P.AS_OF, P.TARGET, P.FORECAST_ID, compliant_only=True
    )
    excluded = D.item_master(spark, root).filter(
        (F.col("paint_id") == P.EXCLUDED_PAINT) & (F.col("wheels_id") == "WHL-0")
    )
    return SD.days_of_supply(items, supply, demand, P.DAILY_RATE, excluded, basis), plan


def days_of_supply(spark: SparkSession, root: str) -> DataFrame:
    return _state(spark, root).withColumns(
        {c: F.round(c, 6) for c in ("velocity", "dos", "report_dos")}
    )


def days_of_net_supply(spark: SparkSession, root: str) -> DataFrame:
    return _state(spark, root, "net_supply").select("config_string", F.round("dos", 6).alias("dos"))


def _allocated(spark: SparkSession, root: str) -> DataFrame:
    return A.allocate_units(*_state_and_plan(spark, root))


def allocate_units(spark: SparkSession, root: str) -> DataFrame:
    return _allocated(spark, root).select(
        "config_string", "model_powertrain", "net_supply", "added_volume", "new_net_supply",
        F.round("new_dos", 6).alias("new_dos"),
    )


def apportion_units(spark: SparkSession, root: str) -> DataFrame:
    """The plan split over each model's configurations by their share of its demand."""
    state, plan = _state_and_plan(spark, root)
    return A.apportion_units(state.withColumn("weight", F.col("demand")), plan)


def allocate_or_apportion(spark: SparkSession, root: str) -> DataFrame:
    """Stock of large powertrains counts as none here, so that both ways are taken."""
    state, plan = _state_and_plan(spark, root)
    no_stock = F.col("model_powertrain").like("% LARGE%")
    return A.allocate_or_apportion(state.withColumn("supply", F.when(no_stock, 0).otherwise(F.col("supply"))), plan)


def unplaced_units(spark: SparkSession, root: str) -> DataFrame:
    state, plan = _state_and_plan(spark, root)
    return A.unplaced_units(state.filter(~F.col("model_powertrain").like("M1 L%")), plan)


def expand_units(spark: SparkSession, root: str) -> DataFrame:
    return A.expand_units(_allocated(spark, root)).select("config_string", "unit")


BUILD_OPTIONS = {"M1 LARGE": "BLD-DM1", "M1 PROMO": "BLD-TM1", "M2 LARGE": "BLD-DM2", "M2 SMALL": "BLD-QM2"}
PAINT_BUILDS = {("M1", "EXP-GREEN"): "BLD-TDM1", ("M2", "EXP-GREEN"): "BLD-TDM2"}
SKU_PARTS = ("model_powertrain", "paint_id", "interior_id", "wheels_id", "tonneau_id",
             "accents_and_badging_id", "roof_id", "audio_id", "utility_panel_id")


def planned_units(spark: SparkSession, root: str) -> DataFrame:
    """Planned units with the attributes of their configuration."""
    items = D.item_master(spark, root).filter("is_inventory_policy_eligible = 1")
    attributes = items.select("config_string", "model", "powertrain", "country", *SKU_PARTS[1:])
    units = enrich(_planned(spark, root).drop("ord"), small(attributes), {"config_string": "config_string"})
    return units.withColumns({
        "production_zone": F.lit("Liquid/To Freeze"),
        "build_country": region_code(F.col("country")),
        "build_option_id": build_option_id(BUILD_OPTIONS, PAINT_BUILDS),
        "sku_string": encode_config(SKU_PARTS, " - "),
    }).select("id", "production_zone", "config_string", "model_powertrain", "powertrain", "build_country",
              "build_option_id", "sku_string")


def current_supply(spark: SparkSession, root: str) -> DataFrame:
    _, models, _ = _context(spark, root)
    return SD.current_supply(D.vehicles(spark, root), models, P.TARGET)


def liquid_vehicles(spark: SparkSession, root: str) -> DataFrame:
    """Units still liquid, with rolled-forward keys; a 2026 key keeps the planned year only."""
    return (
        D.vehicles(spark, root)
        .filter(F.col("vehicle_generation") == "GEN-2")
        .withColumn("production_zone", L.production_zone(L.PLANNING_ZONES))
        .filter(F.col("production_zone") == "Liquid")
        .select("vehicle_id", roll_model_year("config_string").alias("config_string"))
    )


def _planned(spark: SparkSession, root: str) -> DataFrame:
    """Planned units; ``ord`` sorts in planning order, by configuration and number."""
    units = A.expand_units(_allocated(spark, root))
    number = F.col("unit").cast("string")
    # The number of digits (19 at most) in front makes numbers of any size sort as text.
    ranked = F.concat(F.lpad(F.length(number).cast("string"), 2, "0"), number)
    return units.select(
        F.concat("config_string", F.lit("#"), number).alias("id"),
        F.concat("config_string", F.lit("#"), ranked).alias("ord"), "config_string", "model_powertrain",
    )


def _exact(spark: SparkSession, root: str) -> DataFrame:
    stock = liquid_vehicles(spark, root).select(
        F.col("vehicle_id").alias("id"), F.col("vehicle_id").alias("ord"), "config_string"
    )
    # Read twice below; written once so that the allocation does not run twice.
    return exact_match(materialize(_planned(spark, root)), stock, "config_string")


def exact_match_planned(spark: SparkSession, root: str) -> DataFrame:
    return _exact(spark, root).select("id", F.col("supply_id").alias("vehicle_id"))


def _unused(spark: SparkSession, root: str, exact: DataFrame) -> DataFrame:
    """Liquid vehicles of compliant configurations that no exact match took."""
    items = D.item_master(spark, root).filter("is_inventory_policy_eligible = 1").select("config_string")
    used = exact.filter("supply_id is not null").select(F.col("supply_id").alias("vehicle_id"))
    return liquid_vehicles(spark, root).join(items, "config_string", "left_semi").join(used, "vehicle_id", "left_anti")


def _similar(spark: SparkSession, root: str) -> DataFrame:
    """Exact matches plus, for the rest, the most similar unused compliant vehicle."""
    exact = materialize(_exact(spark, root))
    stock = _unused(spark, root, exact)

    def split(df: DataFrame, key: str, order: str) -> DataFrame:
        year = F.split_part("config_string", F.lit("_"), F.lit(1))
        return df.select(
            F.col(key).alias("id"), F.col(order).alias("ord"), year.alias("block"),
            F.trim(F.substr("config_string", F.length(year) + 1)).alias("text"),
        )

    wanting = exact.filter("supply_id is null")
    close = similar_match(split(wanting, "id", "ord"), split(stock, "vehicle_id", "vehicle_id"))
    return enrich(
        exact, close.select("id", "similar_id", F.concat("block", "similar_text").alias("similar_config")), {"id": "id"}
    )


def similar_match_planned(spark: SparkSession, root: str) -> DataFrame:
    return _similar(spark, root).select("id", "config_string", F.col("supply_id").alias("vehicle_id"),
                                        "similar_id", "similar_config")


def _instruction(matched: DataFrame, suggested: str | None) -> DataFrame:
    vehicle = F.col("supply_id") if suggested is None else F.coalesce("supply_id", suggested)
    action = F.when(F.col("supply_id").isNotNull(), "Freeze").otherwise("Reconfigure then freeze")
    return matched.select(
        "id", vehicle.alias("vehicle_id"), action.alias("action"),
        F.col("config_string").alias("configuration_string"), "model_powertrain",
    )


def freeze_instructions(spark: SparkSession, root: str) -> DataFrame:
    """One instruction per planned unit with the attributes to build."""
    plan = _instruction(_similar(spark, root), "similar_id")
    build = D.vehicles(spark, root).select(
        "vehicle_id", F.lit("SWUP-NULL").alias("build_software_upgrade_id"),
        F.col("model").alias("build_model"), F.col("powertrain").alias("build_powertrain"),
        F.col("build_id").alias("build_option_id"), F.col("charging_port_id").alias("build_charger_id"),
    )
    parts = {f"build_{k}": v for k, v in decode_config("configuration_string", INSTRUCTION_PREFIXES).items() if k != "model_year"}
    return enrich(plan.withColumns(parts), build, {"vehicle_id": "vehicle_id"}).select(
        "id", F.col("vehicle_id"), "action", "configuration_string", "build_model_powertrain",
        "build_model", "build_powertrain", "build_country", "build_exterior", "build_interior",
        "build_wheels", "build_tonneau", "build_badging", "build_roof", "build_audio",
        "build_utility", "build_camp_speaker", "build_software_upgrade_id", "build_option_id", "build_charger_id",
    )


def freeze_summary(spark: SparkSession, root: str) -> DataFrame:
    """Units with a vehicle, exact or similar, per model and configuration, most first.

    Which vehicle a unit gets does not matter for the count, so configurations are counted and no unit
    is paired.
    """
    stock = liquid_vehicles(spark, root).groupBy("config_string").agg(F.count(F.lit(1)).alias("n"))
    items = D.item_master(spark, root).filter("is_inventory_policy_eligible = 1")
    year = F.split_part("config_string", F.lit("_"), F.lit(1))
    planned = _allocated(spark, root).select("config_string", "model_powertrain", "added_volume")
    counted = A.covered_counts(planned, materialize(stock), items, year)
    return (
        counted.filter("model_powertrain is not null and config_string is not null")
        .select("model_powertrain", "config_string", F.col("covered").alias("vehicle_id_count"))
        .orderBy(F.desc("model_powertrain"), F.desc("vehicle_id_count"))
    )


def config_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    """Decode every configuration key and encode it again."""
    items = D.item_master(spark, root).select("config_string")
    decoded = items.select("config_string", *[c.alias(n) for n, c in decode_config("config_string").items()])
    order = ("model_year", "country", "model_powertrain", "exterior", "interior", "wheels",
             "audio", "roof", "tonneau", "badging", "utility")
    return decoded.withColumn("encoded", encode_config(order))


_PLAN = """select model_powertrain, case when model_powertrain = 'M2 PROMO' then 0 else cast(floor(count(*)/10.0) as bigint) end as units
  from forecast group by 1"""
_MODELS = "select model_powertrain from plan where units <> 0"
_ITEMS = """select config_string, model_powertrain, compliance as inventory_policy_compliance from item_master
  where model_year = '2026' and is_inventory_policy_eligible = 1 and country not in ('CA')
  and model_powertrain in (select model_powertrain from models)"""
# Statuses of units that are not available.
_GONE = "('CREATED','DECOMMISSIONED','RETURNED','INTERNAL_RECEIVED','DELIVERED')"
_AVAILABLE = f"""select vehicle_id, model_powertrain, country, metadata_source_order,
  case when charging_port_id = 'CHRG-NACS01' then replace(config_string,'2025','2026') else config_string end as config_string,
  case when charging_port_id = 'CHRG-NACS01' then replace(model_year,'2025','2026') else model_year end as model_year
  from vehicles where metadata_source_order not like '{P.EXCLUDE_SOURCE}' and match_status is null and is_delivered = 0
  and vin_salability <> 'NON_SALEABLE'
  and vehicle_status not in {_GONE}
  and vehicle_record_status = 'ACTIVE' and vehicle_usage = 'CUSTOMER_DELIVERY'
  and coalesce(actual_factory_gate_date, expected_factory_gate_date) < date '{P.TARGET}'
  and model_powertrain in (select model_powertrain from models)"""
_DUE = f"""select * replace (replace(config_string, '2025', '2026') as config_string) from forecast where model_year = '2026' and id = {P.FORECAST_ID}
  and order_date > date '{P.AS_OF}' and order_date <= date '{P.TARGET}'
  and model_powertrain in (select model_powertrain from models)"""
_DAYS = f"datediff('day', date '{P.AS_OF}', date '{P.TARGET}')"
_BASE = {"plan": _PLAN, "models": _MODELS, "items": _ITEMS, "available": _AVAILABLE, "due": _DUE}
_STATE = _BASE | {
    "s": """select a.config_string, count(*) as supply from available a join items i on a.config_string = i.config_string
  where a.model_year = '2026' and a.country not in ('CA') group by 1""",
    "d": f"""select f.config_string, count(*) as demand, count(*) / cast({_DAYS} as double) as velocity from due f
  join items i on f.config_string = i.config_string where f.country not in ('CA') group by 1""",
    "state0": f"""select i.config_string, i.model_powertrain, i.inventory_policy_compliance, coalesce(supply,0) as supply,
  coalesce(demand,0) as demand, coalesce(supply,0) - coalesce(demand,0) as net_supply,
  coalesce(velocity,0) as v0 from items i left join s on s.config_string = i.config_string
  left join d on d.config_string = i.config_string where i.config_string not in (
  select config_string from item_master where paint_id = '{P.EXCLUDED_PAINT}' and wheels_id = 'WHL-0')""",
    "state": f"""select *, coalesce(supply / nullif(v0,0), 0) as report_dos,
  case when v0 = 0 then 1.0::double/{P.DAILY_RATE}::double else v0 end as velocity from state0""",
}
_ALLOC = _STATE | {
    "ladder": """select config_string, model_powertrain, report_dos, j, (j + net_supply) / velocity as lvl, units
  from (select st.*, p.units, unnest(generate_series(0, p.units - 1)) as j from state st
  join plan p on p.model_powertrain = st.model_powertrain where p.units > 0)""",
    "taken": """select config_string, count(*) as won from (select *, row_number() over (partition by model_powertrain
  order by lvl, report_dos, config_string, j) as place from ladder) where place <= units group by 1""",
    "allocated": """select st.config_string, st.model_powertrain, st.net_supply, coalesce(won,0) as added_volume,
  st.net_supply + coalesce(won,0) as new_net_supply, (st.net_supply + coalesce(won,0)) / velocity as new_dos
  from state st join plan p on p.model_powertrain = st.model_powertrain
  left join taken t on t.config_string = st.config_string where p.units > 0""",
}
_RATED = _ALLOC | {
    "quota": """select st.config_string, st.model_powertrain, st.demand, p.units,
  cast(sum(st.demand) over (partition by st.model_powertrain) as bigint) as total, count(*) over (partition by st.model_powertrain) as n
  from state st join plan p on p.model_powertrain = st.model_powertrain where p.units > 0""",
    "quota2": """select *, case when total > 0 then units * demand else units end as part, case when total > 0 then total else n end as whole from quota""",
    "quota3": """select *, units - sum(part // whole) over (partition by model_powertrain) as spare,
  row_number() over (partition by model_powertrain order by part % whole desc, config_string) as place from quota2""",
    "rated": """select config_string, model_powertrain, cast(demand as bigint) as weight,
  cast(part // whole + case when place <= spare then 1 else 0 end as bigint) as added_volume from quota3""",
    "bare": """select model_powertrain from state group by 1
  having coalesce(sum(case when model_powertrain like '% LARGE%' then 0 else supply end), 0) = 0""",
}
_EXACT = _ALLOC | {
    "planned": """select config_string||'#'||unit as id, unit, config_string, model_powertrain
  from (select *, unnest(generate_series(1, added_volume)) as unit from allocated where added_volume > 0)""",
    "liquid": """select vehicle_id,
  case when charging_port_id = 'CHRG-NACS01' then replace(config_string,'2025','2026') else config_string end as config_string
  from vehicles where vehicle_generation = 'GEN-2' and vehicle_status = 'CREATED' and vehicle_record_status = 'ACTIVE'""",
    "matched": """select d.id, d.unit, d.config_string, d.model_powertrain, v.vehicle_id from
  (select *, row_number() over (partition by config_string order by unit) as rn from planned) d left join
  (select *, row_number() over (partition by config_string order by vehicle_id) as rn from liquid) v
  on v.config_string = d.config_string and v.rn = d.rn""",
}


def _sql(body: str, steps: dict[str, str]) -> str:
    return with_views("item_master vehicles forecast", body, steps)


QUERIES = {
    "active_models": (active_models, with_views("forecast", "select * from models", {"plan": _PLAN, "models": _MODELS})),
    "supply_by_config": (supply_by_config, _sql("""
select a.config_string, a.model_year, a.model_powertrain, a.metadata_source_order,
  coalesce(i.inventory_policy_compliance,'Not Compliant') as inventory_policy_compliance, count(*) as supply
from available a left join items i on a.config_string = i.config_string where a.model_year = '2026' group by all""", _BASE)),
    "demand_velocity": (demand_velocity, _sql(f"""
select f.config_string, f.model_powertrain, coalesce(i.inventory_policy_compliance,'Not Compliant') as inventory_policy_compliance,
  count(*) as demand, round(count(*) / cast({_DAYS} as double), 9) as velocity
from due f left join items i on f.config_string = i.config_string group by 1,2,3""", _BASE)),
    "days_of_supply": (days_of_supply, _sql("""
select config_string, model_powertrain, inventory_policy_compliance, supply, demand, net_supply,
  round(velocity,6) as velocity, round(report_dos,6) as report_dos, round(supply/velocity,6) as dos from state""", _STATE)),
    "days_of_net_supply": (days_of_net_supply, _sql(
        "select config_string, round(net_supply/velocity,6) as dos from state", _STATE)),
    "allocate_units": (allocate_units, _sql("""
select config_string, model_powertrain, net_supply, added_volume, new_net_supply, round(new_dos,6) as new_dos from allocated""", _ALLOC)),
    "apportion_units": (apportion_units, _sql("select config_string, model_powertrain, weight, added_volume from rated", _RATED)),
    "allocate_or_apportion": (allocate_or_apportion, _sql("""
select config_string, model_powertrain, added_volume from allocated where model_powertrain not in (select * from bare)
union all select config_string, model_powertrain, added_volume from rated where model_powertrain in (select * from bare)""", _RATED)),
    "unplaced_units": (unplaced_units, _sql("""
select * from plan where units > 0 and model_powertrain not in (
  select model_powertrain from state where model_powertrain not like 'M1 L%')""", _STATE)),
    "expand_units": (expand_units, _sql("""
select config_string, cast(unnest(generate_series(1, added_volume)) as bigint) as unit from allocated where added_volume > 0""", _ALLOC)),
    "planned_units": (planned_units, _sql("""
select id, 'Liquid/To Freeze' as production_zone, p.config_string, p.model_powertrain, powertrain, 'RGN-USA' as build_country,
  case when paint_id = 'EXP-GREEN' then 'BLD-TD'||model when p.model_powertrain = 'M1 LARGE' then 'BLD-DM1'
    when p.model_powertrain = 'M1 PROMO' then 'BLD-TM1' when p.model_powertrain = 'M2 LARGE' then 'BLD-DM2'
    when p.model_powertrain = 'M2 SMALL' then 'BLD-QM2' end as build_option_id,
  p.model_powertrain||' - '||paint_id||' - '||interior_id||' - '||wheels_id||' - '||tonneau_id||' - '||accents_and_badging_id
    ||' - '||roof_id||' - '||audio_id||' - '||utility_panel_id as sku_string
from planned p join item_master i on i.config_string = p.config_string""", _EXACT)),
    "current_supply": (current_supply, _sql(f"""
select vehicle_id, {zone_sql('Firm', 'Frozen/VINned', 'Already Built/ WIP at Normal', 'Already Built/ WIP in Field', 'Liquid')} as production_zone,
  case when charging_port_id = 'CHRG-NACS01' then replace(config_string,'2025','2026') else config_string end as config_string,
  {', '.join(SD.UNIT_COLUMNS)} from vehicles where match_status is null and is_delivered = 0 and vin_salability <> 'NON_SALEABLE'
  and vehicle_status not in {_GONE} and vehicle_usage = 'CUSTOMER_DELIVERY'
  and coalesce(actual_factory_gate_date, expected_factory_gate_date) < date '{P.TARGET}'
  and model_powertrain in (select model_powertrain from models)
  and (case when charging_port_id = 'CHRG-NACS01' then replace(model_year,'2025','2026') else model_year end) = '2026'""", _BASE)),
    "exact_match": (exact_match_planned, _sql("select id, vehicle_id from matched", _EXACT)),
    "freeze_summary": (freeze_summary, _sql("""
select model_powertrain, config_string, count(*) filter (where vehicle_id is not null or turn <= n) as vehicle_id_count
from (select *, split_part(config_string, '_', 1) as block, row_number() over (
    partition by vehicle_id is null, split_part(config_string, '_', 1) order by config_string, unit) as turn from matched) m
left join (select split_part(config_string, '_', 1) as block, count(*) as n from liquid
  where config_string in (select config_string from item_master where is_inventory_policy_eligible = 1)
  and vehicle_id not in (select vehicle_id from matched where vehicle_id is not null) group by 1) u using (block)
group by 1,2""", _EXACT)),
    "similar_match": (similar_match_planned, None),
    "freeze_instructions": (freeze_instructions, None),
    "config_roundtrip": (config_roundtrip, with_views("item_master", """
select config_string, config_string as encoded, model_year, country, model_powertrain, paint_id as exterior,
  interior_id as interior, wheels_id as wheels, audio_id as audio, roof_id as roof, tonneau_id as tonneau,
  accents_and_badging_id as badging, utility_panel_id as utility from item_master""")),
}

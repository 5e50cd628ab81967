"""Inventory-policy compliance by stage, site, region and time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetloom.functions import labels as L
from fleetloom.functions.config_key import roll_model_year
from fleetloom.operators.joins import enrich, small
from fleetloom.sources.tables import inline_table


def compliant(col: str = "inventory_policy_compliance") -> Column:
    return F.col(col) == L.COMPLIANT


def in_scope(unmatched: Column, generation: str = "GEN-2", models: Sequence[str] | None = None) -> Column:
    """Customer vehicles of the generation, and of ``models`` if given, that exist and are not yet
    handed over. An empty list of models leaves nothing."""
    listed = F.lit(True) if models is None else F.col("model").isin(*models) if models else F.lit(False)
    return (
        listed
        & (F.col("vehicle_generation") == generation)
        & ~F.col("vehicle_status").isin("DECOMMISSIONED", "DELIVERED")
        & (F.col("vehicle_record_status") == "ACTIVE")
        & (F.col("vehicle_usage") == "CUSTOMER_DELIVERY")
        & unmatched
    )


def policy_flags(item_master: DataFrame) -> DataFrame:
    return item_master.select(
        "config_string", L.compliance_flag("is_inventory_policy_eligible").alias("inventory_policy_compliance")
    )


def dashboard_vehicles(
    vehicles: DataFrame, item_master: DataFrame, exclude_source: str, launch_source: str,
    launch_builds: Sequence[str], models: Sequence[str] | None = None,
) -> DataFrame:
    """Unmatched vehicles in scope with stage, flags, region and compliance (NULL if unknown).

    A NULL source order is kept, unlike in the supply view.
    """
    keep = in_scope(F.col("is_matched") == 0, models=models) & ~F.coalesce(
        "metadata_source_order", F.lit("missing")
    ).like(exclude_source)
    scoped = (
        vehicles.filter(keep & F.col("config_string").isNotNull() & F.col("model_powertrain").isNotNull())
        .withColumns({
            "production_zone": L.production_zone(L.DASHBOARD_ZONES),
            "custom_v_inventory_flag": L.custom_flag(rule="dashboard"),
            "launch_edition": L.launch_flag(launch_source, launch_builds),
            "location_region": L.location_region("comm_ops_region"),
            "config_string": roll_model_year("config_string"),
            "model_year": roll_model_year("model_year"),
            "sequence_date": F.col("expected_ga_in_date"),
            "vin_status": L.vin_status(),
        })
    )
    return enrich(scoped, small(policy_flags(item_master)), {"config_string": "config_string"})


# Cohorts of the ratio and quantity boxes: name → (stage, order kind, region).
_Z = L.DASHBOARD_ZONES
COHORTS: dict[str, tuple[str | None, str | None, str | None]] = {
    "frozen": (_Z.frozen_vin, None, None),
    "frozen_custom": (_Z.frozen_vin, "Custom", None),
    "frozen_inventory": (_Z.frozen_vin, "Inventory", None),
    "firm": (_Z.frozen_no_vin, None, None),
    "built_normal": (_Z.built, None, None),
    "built_field": (_Z.built_field, None, None),
    "liquid": (_Z.liquid, None, None),
    "overall": (None, None, None),
    "canada": (None, None, "Canada"),
    "central": (None, None, "Central"),
    "east": (None, None, "East"),
    "west": (None, None, "West"),
}


def cohort_kpis(df: DataFrame, cohorts: Mapping[str, tuple] = COHORTS) -> DataFrame:
    """Compliant and total vehicles, ratio and truncated percentage of every cohort.

    One pass over the vehicles makes a small cell table; cohorts are unions of its cells.
    Cohorts without vehicles report zeros.
    """
    dims = ("production_zone", "custom_v_inventory_flag", "location_region")
    cells = df.groupBy(*dims).agg(
        F.count_if(compliant()).alias("compliant_qty"), F.count(F.lit(1)).alias("total_qty")
    )
    member = []
    for name, wanted in cohorts.items():
        hit = F.lit(True)
        for dim, value in zip(dims, wanted):
            if value is not None:
                hit = hit & (F.col(dim) == value)
        member.append(F.when(hit, name))
    summed = (
        cells.withColumn("cohort", F.explode(F.array_compact(F.array(*member))))
        .groupBy("cohort")
        .agg(F.sum("compliant_qty").alias("compliant_qty"), F.sum("total_qty").alias("total_qty"))
    )
    names = inline_table(df.sparkSession, [(n,) for n in cohorts], "cohort string")
    full = names.join(summed, "cohort", "left").fillna(0, ["compliant_qty", "total_qty"])
    ratio = F.coalesce(F.try_divide("compliant_qty", "total_qty"), F.lit(0.0))
    return full.withColumn("ratio", ratio).withColumn("percent_text", percent_text(F.col("ratio")))


def percent_text(ratio: Column) -> Column:
    """Whole percent, truncated."""
    return F.concat((ratio * 100).cast("int").cast("string"), F.lit("%"))


def kpi_boxes(df: DataFrame, zones: Sequence[str]) -> DataFrame:
    """Distinct configurations, compliant and all vehicles in the selected stages."""
    return df.filter(F.col("production_zone").isin(*zones)).agg(
        F.count_distinct("config_string").alias("distinct_configs"),
        F.count_if(compliant()).alias("compliant_vehicles"),
        F.count(F.lit(1)).alias("total_vehicles"),
    )


def count_by(df: DataFrame, cols: Sequence[str], counted: str | None = None, name: str = "order_count") -> DataFrame:
    """Rows (or non-NULL values of ``counted``) per combination; a NULL category is a category."""
    what = F.lit(1) if counted is None else F.col(counted)
    return df.groupBy(*cols).agg(F.count(what).alias(name))


def compliance_table(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Compliant, other and all vehicles with the rounded percentage."""
    return df.groupBy(*by).agg(
        F.count_if(compliant()).alias("compliant_vehicles"),
        F.count_if(F.col("inventory_policy_compliance") == L.NOT_COMPLIANT).alias("non_compliant_vehicles"),
        F.count("vehicle_id").alias("total_vehicles"),
        F.round(F.try_divide(F.count_if(compliant()) * F.lit(100.0), F.count("vehicle_id")), 2).alias("percent_compliant"),
    )


def field_vehicles(
    vehicles: DataFrame, item_master: DataFrame, missing_region: str | None = None, models: Sequence[str] | None = None,
) -> DataFrame:
    """Unmatched vehicles built or in progress in the field; unknown items are not compliant."""
    field = (
        vehicles.filter(in_scope(F.col("match_status").isNull(), models=models))
        .withColumn("production_zone", L.production_zone(L.DASHBOARD_ZONES))
        .filter(F.col("production_zone") == L.DASHBOARD_ZONES.built_field)
        .select(
            "vehicle_id", "location_id", "location_name",
            L.location_region("comm_ops_region", missing_region).alias("location_region"),
            roll_model_year("config_string").alias("config_string"),
        )
    )
    flagged = enrich(field, small(policy_flags(item_master)), {"config_string": "config_string"})
    return flagged.withColumn(
        "inventory_policy_compliance", F.coalesce("inventory_policy_compliance", F.lit(L.NOT_COMPLIANT))
    )


def distinct_pivot(
    df: DataFrame, by: Sequence[str], buckets: Mapping[str, Sequence[str]], entity: str = "vehicle_id",
    zone: str = "production_zone", other: str = "others", total: str = "supply",
) -> DataFrame:
    """Distinct entities per stage bucket, in none of the buckets, and overall.

    Entities are reduced to one row first, so the counts need no further distinct.
    """
    named = [z for zones in buckets.values() for z in zones]
    flags = {name: F.col(zone).isin(*zones) for name, zones in buckets.items()}
    flags[other] = ~F.col(zone).isin(*named)
    per_entity = df.filter(F.col(entity).isNotNull()).groupBy(*by, entity).agg(
        *[F.max(F.when(hit, 1).otherwise(0)).alias(name) for name, hit in flags.items()]
    )
    return per_entity.groupBy(*by).agg(
        *[F.sum(name).alias(name) for name in flags], F.count(F.lit(1)).alias(total)
    )


def with_share(df: DataFrame, by: Sequence[str], value: str, within: Sequence[str]) -> DataFrame:
    """Counted ``value`` per combination of ``by`` and its share of the ``within`` total."""
    counted = df.groupBy(*by).agg(F.count(value).alias("vehicles"))
    total = F.sum("vehicles").over(Window.partitionBy(*within))
    return counted.withColumn("share", F.try_divide(F.col("vehicles"), total))

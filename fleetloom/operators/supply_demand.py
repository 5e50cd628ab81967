"""Supply, demand, velocity and days of supply per configuration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom.functions import labels as L
from fleetloom.functions.config_key import roll_model_year
from fleetloom.operators.joins import drop_listed


def active_keys(plan: DataFrame) -> DataFrame:
    """Models with planned units."""
    return plan.filter(F.col("units") != 0).select("model_powertrain")


def eligible_items(
    item_master: DataFrame, models: DataFrame, model_year: str = "2026",
    exclude_countries: Sequence[str] = ("CA",),
) -> DataFrame:
    """Policy-eligible configurations of the planned models, with their flag."""
    keep = (
        (F.col("model_year") == model_year)
        & (F.col("is_inventory_policy_eligible") == 1)
        & ~F.col("country").isin(*exclude_countries)
    )
    return (
        item_master.filter(keep)
        .join(models, "model_powertrain", "left_semi")
        .select("config_string", "model_powertrain",
                L.compliance_flag("is_inventory_policy_eligible").alias("inventory_policy_compliance"))
    )


def demand_velocity(
    forecast: DataFrame, items: DataFrame, models: DataFrame, as_of: str, target: str,
    forecast_id: int, model_year: str = "2026", exclude_countries: Sequence[str] = ("CA",),
    compliant_only: bool = False, roll: bool = True,
) -> DataFrame:
    """Forecast orders after ``as_of`` up to ``target`` and their daily rate, per configuration.

    With ``roll`` keys of the year before count as this year's.
    """
    due = (
        (F.col("model_year") == model_year)
        & (F.col("id") == forecast_id)
        & (F.col("order_date") > F.lit(as_of).cast("date"))
        & (F.col("order_date") <= F.lit(target).cast("date"))
    )
    if exclude_countries:
        due = due & ~F.col("country").isin(*exclude_countries)
    days = F.datediff(F.lit(target).cast("date"), F.lit(as_of).cast("date"))
    # Count first: the joins below then see one row per configuration.
    counted = (
        forecast.filter(due)
        .withColumn("config_string", roll_model_year("config_string", port=None) if roll else F.col("config_string"))
        .groupBy("config_string", "model_powertrain")
        .agg(F.count("order_id").alias("demand"))
        .join(models, "model_powertrain", "left_semi")
    )
    return _flag(counted, items, compliant_only).withColumn("velocity", F.try_divide("demand", days))


def supply_by_config(
    vehicles: DataFrame, items: DataFrame, models: DataFrame, cutoff: str,
    exclude_source: str = "%FLEET%", model_year: str = "2026",
    exclude_countries: Sequence[str] = ("CA",), compliant_only: bool = False,
    extra: Sequence[str] = (), require_active: bool = True,
) -> DataFrame:
    """Available units per (rolled-forward) configuration."""
    keep = L.available_supply(cutoff, exclude_source, require_active)
    if exclude_countries:
        keep = keep & ~F.col("country").isin(*exclude_countries)
    rolled = vehicles.filter(keep).select(
        roll_model_year("config_string").alias("config_string"),
        roll_model_year("model_year").alias("model_year"),
        "model_powertrain", "vehicle_id", *extra,
    )
    counted = (
        rolled.filter(F.col("model_year") == model_year)
        .groupBy("config_string", "model_year", "model_powertrain", *extra)
        .agg(F.count("vehicle_id").alias("supply"))
        .join(models, "model_powertrain", "left_semi")
    )
    return _flag(counted, items, compliant_only)


# Columns of the unit-level supply list behind the stage.
UNIT_COLUMNS = (
    "model_powertrain", "model", "powertrain", "country", "paint_id", "interior_id", "wheels_id", "tonneau_id",
    "accents_and_badging_id", "roof_id", "audio_id", "utility_panel_id",
)


def current_supply(vehicles: DataFrame, models: DataFrame, cutoff: str, model_year: str = "2026") -> DataFrame:
    """Unit list of the supply, whatever its record status and source, with its stage."""
    units = vehicles.filter(L.available_supply(cutoff, None, require_active=False)).select(
        "vehicle_id", L.production_zone(L.PLAIN_ZONES).alias("production_zone"),
        roll_model_year("config_string").alias("config_string"),
        roll_model_year("model_year").alias("model_year"), *UNIT_COLUMNS,
    )
    kept = units.filter(F.col("model_year") == model_year).drop("model_year")
    return kept.join(models, "model_powertrain", "left_semi")


def _flag(df: DataFrame, items: DataFrame, compliant_only: bool) -> DataFrame:
    """Compliance of a configuration; unknown ones are not compliant."""
    flags = items.select("config_string", "inventory_policy_compliance")
    if compliant_only:
        return df.join(flags.filter(F.col("inventory_policy_compliance") == L.COMPLIANT), "config_string")
    flagged = df.join(flags, "config_string", "left")
    return flagged.withColumn(
        "inventory_policy_compliance",
        F.coalesce("inventory_policy_compliance", F.lit(L.NOT_COMPLIANT)),
    )


def merge_supply_demand(supply: DataFrame, demand: DataFrame) -> DataFrame:
    """Full outer join on the configuration with zeros for the missing side."""
    s, d = supply.alias("s"), demand.alias("d")

    def either(col: str) -> Column:
        return F.coalesce(F.col(f"s.{col}"), F.col(f"d.{col}")).alias(col)

    joined = s.join(d, F.col("s.config_string") == F.col("d.config_string"), "full")
    return joined.select(
        either("config_string"), either("model_powertrain"), either("inventory_policy_compliance"),
        F.coalesce("s.supply", F.lit(0)).alias("supply"),
        F.coalesce("d.demand", F.lit(0)).alias("demand"),
        F.coalesce("d.velocity", F.lit(0.0)).alias("velocity"),
    ).withColumn("net_supply", F.col("supply") - F.col("demand"))


def days_of_supply(
    items: DataFrame, supply: DataFrame, demand: DataFrame, daily_rate: float,
    excluded: DataFrame | None = None, basis: str = "supply",
) -> DataFrame:
    """The full picture: every eligible item with supply, demand, velocity and days of supply.

    ``report_dos`` is the figure before the velocity repair, by which reports are ordered. A
    velocity of zero becomes ``1 / daily_rate``, and ``dos`` is then ``basis / velocity``.
    """
    if basis not in ("supply", "net_supply"):
        raise ValueError(f"unknown basis {basis!r}")
    merged = merge_supply_demand(supply, demand).select(
        "config_string", "supply", "demand", "velocity", "net_supply"
    )
    full = items.join(merged, "config_string", "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("supply", "demand", "velocity", "net_supply")}
    )
    if excluded is not None:
        full = drop_listed(full, excluded, {"config_string": "config_string"})
    repaired = F.when(F.col("velocity") == 0, F.lit(1.0 / daily_rate)).otherwise(F.col("velocity"))
    return (
        full.withColumn("report_dos", F.coalesce(F.try_divide("supply", "velocity"), F.lit(0.0)))
        .withColumn("velocity", repaired)
        .withColumn("dos", F.coalesce(F.try_divide(basis, "velocity"), F.lit(0.0)))
    )

"""Flags, stages and statuses derived from single rows (Column builders)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPLIANT = "Inventory Policy Compliant"
NOT_COMPLIANT = "Not Compliant"
PLAN_COMPLIANT = "Product Plan Compliant"

# Vehicle statuses that count as built or in progress once a VIN exists.
BUILT_STATUSES = (
    "PRODUCTION_STARTED",
    "ARRIVED_AT_DISTRIBUTION_CENTER",
    "FACTORY_GATED",
    "FACTORY_OK",
    "GENERAL_ASSEMBLY_COMPLETED",
    "IN_TRANSIT_TO_DISTRIBUTION_CENTER",
    "INTERNAL_RECEIVED",
    "PDI_COMPLETED",
    "PDI_STARTED",
    "RETURNED",
    "STAGED_FOR_PDI",
    "VEHICLE_PREPPED",
)
# Statuses whose sequence date is the actual start of general assembly.
ASSEMBLY_STATUSES = ("GENERAL_ASSEMBLY_COMPLETED", "FACTORY_OK", "PRODUCTION_STARTED")
# Statuses that take a unit out of the sellable supply.
UNAVAILABLE_STATUSES = ("CREATED", "DECOMMISSIONED", "RETURNED", "INTERNAL_RECEIVED", "DELIVERED")


@dataclass(frozen=True)
class ZoneLabels:
    """Names of the production stages. ``built_field`` is None where stages do not split by site."""

    frozen_no_vin: str
    frozen_vin: str
    built: str
    built_field: str | None
    liquid: str
    delivered: str = "Delivered"
    decommissioned: str = "Decommissioned"
    other: str = "Investigate"


# The three label sets in use. Note that the two sets with a site split call
# the frozen unit without a VIN "Firm"; the older set calls it "Frozen".
PLANNING_ZONES = ZoneLabels("Frozen", "Firm/ VINned", "Already Built/ WIP", None, "Liquid")
DASHBOARD_ZONES = ZoneLabels(
    "4. Firm",
    "3. Frozen/VINned",
    "1. Already Built/ WIP at Normal",
    "2. Already Built/ WIP in Field",
    "5. Liquid",
)
PLAIN_ZONES = ZoneLabels(
    "Firm",
    "Frozen/VINned",
    "Already Built/ WIP at Normal",
    "Already Built/ WIP in Field",
    "Liquid",
)


def compliance_flag(eligible: Column | str, label: str = COMPLIANT) -> Column:
    col = F.col(eligible) if isinstance(eligible, str) else eligible
    return F.when(col == 1, F.lit(label)).otherwise(F.lit(NOT_COMPLIANT))


def clean_code(col: Column | str) -> Column:
    """Numeric codes that travelled through floats: ``8101.0`` reads as ``8101``."""
    return F.regexp_replace(F.col(col).cast("string") if isinstance(col, str) else col, r"\.0$", "")


def production_zone(labels: ZoneLabels = DASHBOARD_ZONES, factory: str = "8101") -> Column:
    """Stage of a unit from status, VIN, record status and (for split label sets) its centre."""
    status, vin = F.col("vehicle_status"), F.col("vin")
    frozen = status == "PRODUCTION_CONTROL_FROZEN"
    built = status.isin(*BUILT_STATUSES) & vin.isNotNull()
    centre = clean_code("distribution_center")
    zone = (
        F.when(frozen & vin.isNull(), labels.frozen_no_vin)
        .when(frozen, labels.frozen_vin)
        .when(status == "DELIVERED", labels.delivered)
    )
    if labels.built_field is None:
        zone = zone.when(built, labels.built)
    else:
        zone = zone.when(built & (centre == factory), labels.built)
        zone = zone.when(built & (centre != factory), labels.built_field)
    return (
        zone.when(status == "DECOMMISSIONED", labels.decommissioned)
        .when((status == "CREATED") & (F.col("vehicle_record_status") == "ACTIVE"), labels.liquid)
        .otherwise(labels.other)
    )


def vin_status() -> Column:
    return F.when(F.col("vin").isNotNull(), "vin_created").otherwise("vin_not_created")


def sequence_date(run_date: str, labels: ZoneLabels = PLANNING_ZONES, zone: str = "production_zone") -> Column:
    """Date a unit enters (or entered) production; ``run_date`` stands in where none applies."""
    z, status = F.col(zone), F.col("vehicle_status")
    built = [b for b in (labels.built, labels.built_field) if b]
    return (
        F.when(z.isin(labels.frozen_no_vin, labels.frozen_vin), F.col("expected_ga_in_date"))
        .when(status.isin(*ASSEMBLY_STATUSES) | z.isin(*built), F.col("actual_ga_in_date"))
        .when(z == labels.liquid, F.col("expected_build_date_ip"))
        .otherwise(F.lit(run_date).cast("date"))
    )


def source_order_parts(col: str = "metadata_source_order") -> dict[str, Column]:
    """``order_split_yyyyMMdd`` → intended order, split and freeze date (NULL when unreadable)."""
    parts = F.split(F.col(col), "_")
    return {
        "intended_order": F.get(parts, 0),
        "custom_v_inventory_split": F.get(parts, 1),
        "freeze_date": F.to_date(F.try_to_timestamp(F.get(parts, 2), F.lit("yyyyMMdd"))),
    }


def custom_flag(col: str = "metadata_source_order", rule: str = "dashboard") -> Column:
    """Custom or Inventory. ``planning`` looks for *custom* in any case, ``dashboard`` for
    *Custom* or *Order* as written."""
    c = F.col(col)
    if rule == "planning":
        hit = F.lower(c).like("%custom%")
    elif rule == "dashboard":
        hit = c.like("%Custom%") | c.like("%Order%")
    else:
        raise ValueError(f"unknown rule {rule!r}")
    return F.when(hit, "Custom").otherwise("Inventory")


def launch_flag(pattern: str, build_ids: Sequence[str]) -> Column:
    """Launch-edition units, by source order text or build option."""
    return F.col("metadata_source_order").like(pattern) | F.col("build_id").isin(*build_ids)


def pair_label(pairs: Mapping[tuple[str, str], str], other: str = "Other") -> Column:
    """Label of a (paint, interior) pair."""
    label = None
    for (paint, interior), name in pairs.items():
        hit = (F.col("paint_id") == paint) & (F.col("interior_id") == interior)
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return F.lit(other) if label is None else label.otherwise(other)


def location_region(col: str, missing: str | None = None) -> Column:
    """Region without its ``US`` prefix; ``missing`` names the NULL region for roll-ups."""
    c = F.col(col)
    region = F.when(F.substring(c, 1, 2) == "US", F.substr(c, F.lit(3))).otherwise(c)
    return region if missing is None else F.coalesce(region, F.lit(missing))


def location_type(col: str, pattern: str = "%Normal%", factory: str = "Normal", field: str = "Field") -> Column:
    return F.when(F.col(col).like(pattern), factory).otherwise(field)


def normalize_zip(col: str) -> Column:
    """ZIP+4 keeps the part before the dash; otherwise one leading zero is dropped."""
    z = F.col(col)
    return (
        F.when(F.instr(z, "-") > 0, F.split_part(z, F.lit("-"), F.lit(1)))
        .when(z.startswith("0"), F.substr(z, F.lit(2)))
        .otherwise(z)
    )


def available_supply(cutoff: str, exclude_source: str | None, require_active: bool = True) -> Column:
    """Units that can still be sold and leave the factory before ``cutoff``.

    SQL three-valued logic is meant: a NULL source order (where one is excluded), saleability or
    status drops the row.
    """
    gate = F.coalesce(F.col("actual_factory_gate_date"), F.col("expected_factory_gate_date"))
    keep = (
        F.col("match_status").isNull()
        & (F.col("is_delivered") == 0)
        & (F.col("vin_salability") != "NON_SALEABLE")
        & ~F.col("vehicle_status").isin(*UNAVAILABLE_STATUSES)
        & (F.col("vehicle_usage") == "CUSTOMER_DELIVERY")
        & (gate < F.lit(cutoff).cast("date"))
    )
    if exclude_source is not None:
        keep = keep & ~F.col("metadata_source_order").like(exclude_source)
    return keep & (F.col("vehicle_record_status") == "ACTIVE") if require_active else keep


# Fulfilment states of orders that do not count as demand.
CLOSED_FULFILLMENT = ("CANCELLED", "CUSTOMER_NOT_READY_TO_CONFIRM", "CUSTOMER_UNRESPONSIVE")


def open_orders(start: str, end: str, countries: Sequence[str], years: Sequence[str]) -> Column:
    """Orders (not reservations) placed within the inclusive range and still in force."""
    return (
        F.col("order_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
        & F.col("country").isin(*countries)
        & (F.col("is_cancelled") == 0)
        & (F.col("order_type") != "Reservation")
        & F.col("model_year").isin(*years)
        & ~F.col("fulfillment_status").isin(*CLOSED_FULFILLMENT)
    )


def not_in(col: str, values: Sequence) -> Column:
    """Exclusion that keeps NULLs, as a data-frame ``~isin`` does."""
    return ~F.coalesce(F.col(col).isin(*values), F.lit(False))

"""Which orders and which vehicles take part in a recommendation run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom.functions.labels import clean_code, not_in
from fleetloom.operators.joins import enrich, keep_listed, one_to_one, small

# The purposes of a run.
PURPOSES = (
    "pull_forward_from_local_sc",
    "pull_forward_from_normal",
    "retry_matching_normal",
    "retry_matching_local_sc",
    "customer_not_ready_to_confirm_unresponsive_normal",
    "last_saved_config_normal",
    "unmatched_configured_customers_normal",
    "unmatched_configured_customers_local_sc",
    "hold_strategy_matched_at_normal",
    "customer_cancelled_bc_price_normal",
    "customer_cancelled_bc_delivery_normal",
    "unmatched_configured_customers_regionalized",
    "anywhere_to_anywhere",
    "last_saved_config_local_sc_random_config",
    "delayed_at_risk_customers_normal",
    "delayed_at_risk_customers_local_sc",
    "headlight_cmte_issue_normal",
)
# Purposes whose matching key includes the distribution centre.
LOCAL_KEY_PURPOSES = (
    "pull_forward_from_local_sc",
    "retry_matching_local_sc",
    "unmatched_configured_customers_local_sc",
    "delayed_at_risk_customers_local_sc",
    "unmatched_configured_customers_regionalized",
)
# Vehicle status codes before the factory gate, at the factory, past the gate, at local centres.
PRE_GATE_CODES = (300, 310, 315)
FACTORY_CODES = (100, 200, 210, 300, 310, 315, 320, 400)
POST_GATE_CODES = (320, 400, 420, 430, 440, 450, 460)
LOCAL_CODES = (410, 420, 430, 440, 450, 460)
# Customer states and cancellation reasons.
UNREADY = ("CUSTOMER_NOT_READY_TO_CONFIRM", "CUSTOMER_UNRESPONSIVE")
MATCHED = ("REAL", "PREDICTIVE")
PRICE_REASONS = ("The price is not what I expected", "The price exceeds my budget or expectations")
DELIVERY_REASONS = ("Delivery isn't soon enough",)
# Options a cancelled order must name.
REQUIRED_OPTIONS = ("trim", "exterior", "interior", "wheels", "motor", "battery")


@dataclass(frozen=True)
class CohortInputs:
    """Tables and settings of the purposes that need more than the matching run."""

    generation: str = "GEN-2"
    customer_build: str = "Customer Configured"
    pool_builds: Sequence[str] = ("Unallocated", "Shop")
    factory: str = "8101"
    assembly_from: str = "2025-03-17"
    dc_map: DataFrame | None = None  # customer_zip, dc
    regions: DataFrame | None = None  # distribution_center_text, dc_region
    retry_ids: DataFrame | None = None  # oms_order_id
    delayed: DataFrame | None = None  # oms_order_id
    cancelled: DataFrame | None = None  # cancelled orders with options and reasons
    last_saved: DataFrame | None = None  # last configured state per order
    overrides: dict[str, str] = field(default_factory=dict)


def _matched() -> Column:
    return F.col("match_status").isin(*MATCHED)


def _unmatched_configured(inputs: CohortInputs) -> Column:
    return (
        F.col("financial_status").isin("CONFIGURED", "ORDERED")
        & not_in("match_status", MATCHED)
        & (F.col("build_type_internal") == inputs.customer_build)
        & not_in("fulfillment_status", UNREADY)
    )


def _need(table: DataFrame | None, what: str) -> DataFrame:
    if table is None:
        raise ValueError(f"this purpose needs {what}")
    return table


def add_distribution_center(orders: DataFrame, dc_map: DataFrame, default: str = "8101") -> DataFrame:
    """Replace the centre by the one serving the ship-to zip."""
    located = enrich(
        orders.drop("distribution_center"), small(dc_map), {"ship_to_zipcode": "customer_zip"}
    )
    return located.withColumn("distribution_center", F.coalesce("dc", F.lit(default))).drop("dc")


def add_region(df: DataFrame, regions: DataFrame) -> DataFrame:
    return enrich(df, small(regions, computed=False), {"distribution_center": "distribution_center_text"})


def _last_saved(orders: DataFrame, inputs: CohortInputs) -> DataFrame:
    """Orders now RESERVED whose last saved state was a configured build."""
    saved = _need(inputs.last_saved, "last_saved").filter(
        (F.col("financial_status") == "CONFIGURED")
        & (F.col("build_type_internal") == inputs.customer_build)
        & F.col("build_country").isin("US", "CA", "RGN-USA", "RGN-CAN")
        & not_in("fulfillment_status", UNREADY)
        & not_in("build_batch", [-2])
    ).drop("financial_status")
    now = orders.filter(F.col("financial_status") == "RESERVED").select("oms_order_id", "financial_status")
    both = one_to_one(now, saved, ["oms_order_id"])
    return both.withColumns({c: F.lit(v) for c, v in inputs.overrides.items()})


def _cancelled(inputs: CohortInputs, reasons: Sequence[str], code: str) -> DataFrame:
    cancelled = _need(inputs.cancelled, "cancelled")
    filled = cancelled.withColumns(
        {"atp": F.coalesce("atp", F.lit("ATP-NULL")), "offroad": F.coalesce("offroad", F.lit("ORD-NULL"))}
    )
    return filled.dropna(subset=list(REQUIRED_OPTIONS)).filter(
        F.col("question1_response").isin(*reasons) | (F.col("cancel_code") == code)
    )


def select_cohort(run: DataFrame, purpose: str, inputs: CohortInputs) -> DataFrame:
    """Order side of a run."""
    if purpose not in PURPOSES:
        raise ValueError(f"unknown purpose {purpose!r}")
    orders = run.filter(F.col("items_vehicle_generation_id") == inputs.generation)

    def with_dc(df: DataFrame) -> DataFrame:
        return add_distribution_center(df, _need(inputs.dc_map, "dc_map"), inputs.factory)

    if purpose.startswith("pull_forward"):
        return with_dc(orders.filter(_matched() & F.col("vehicle_status_code").isin(*PRE_GATE_CODES)))
    if purpose.startswith("retry_matching"):
        return with_dc(_listed(orders, _need(inputs.retry_ids, "retry_ids")))
    if purpose.startswith("customer_not_ready"):
        return orders.filter(F.col("fulfillment_status").isin(*UNREADY))
    if purpose.startswith("last_saved_config"):
        return _last_saved(orders, inputs)
    if purpose.startswith("hold_strategy"):
        return orders.filter(
            _matched() & not_in("build_batch", [-2]) & F.col("vehicle_status_code").isin(*FACTORY_CODES)
        ).drop("distribution_center")
    if purpose.startswith("customer_cancelled_bc_price"):
        return _cancelled(inputs, PRICE_REASONS, "Pricing")
    if purpose.startswith("customer_cancelled_bc_delivery"):
        return _cancelled(inputs, DELIVERY_REASONS, "Delivery date")
    if purpose == "anywhere_to_anywhere":
        return orders.filter(_unmatched_configured(inputs))
    if purpose == "unmatched_configured_customers_regionalized":
        return add_region(with_dc(orders.filter(_unmatched_configured(inputs))), _need(inputs.regions, "regions"))
    if purpose.startswith("unmatched_configured"):
        ready = F.col("expected_general_assembly_date") >= F.lit(inputs.assembly_from).cast("date")
        return with_dc(orders.filter(ready & _unmatched_configured(inputs)))
    late = _listed(orders, _need(inputs.delayed, "delayed"))
    return with_dc(late) if purpose == "delayed_at_risk_customers_local_sc" else late


def _listed(orders: DataFrame, ids: DataFrame) -> DataFrame:
    text = ids.select(F.col("oms_order_id").cast("string").alias("oms_order_id"))
    return keep_listed(orders, text, {"oms_order_id": "oms_order_id"})


def drop_generation(run: DataFrame, mapping: DataFrame, generation: str) -> DataFrame:
    """The opposite generation filter, with the generation looked up per order."""
    known = enrich(run.drop("items_vehicle_generation_id"), mapping, {"oms_order_id": "oms_order_id"})
    return known.filter(not_in("items_vehicle_generation_id", [generation]))


def cohort_counts(cohort: DataFrame) -> DataFrame:
    """Builds per delivery location (rows without a build id do not count)."""
    return (
        cohort.filter(F.col("delivery_location_name").isNotNull())
        .groupBy("delivery_location_name")
        .agg(F.count("unique_build_id").alias("builds"))
    )


def select_supply(run: DataFrame, purpose: str, inputs: CohortInputs) -> DataFrame:
    """Vehicle side of a run."""
    free = run.withColumn("distribution_center", clean_code("distribution_center")).filter(
        F.col("hold_type").isNull()
        & not_in("vehicle_status", ["PRODUCTION_CONTROL_FROZEN"])
        & (F.col("vehicle_usage") == "CUSTOMER_DELIVERY")
        & F.col("build_type_internal").isin(*inputs.pool_builds)
        & not_in("match_status", MATCHED)
        & (F.col("vehicle_architecture") == inputs.generation)
    )
    if "normal" in purpose:
        return free.filter(
            F.col("vehicle_status_code").isin(*POST_GATE_CODES)
            & (F.col("distribution_center") == inputs.factory)
        )
    local = free.filter(F.col("vehicle_status_code").isin(*LOCAL_CODES))
    return local if "local_sc" in purpose else add_region(local, _need(inputs.regions, "regions"))

"""Weekly demand statistics and safety stock per configuration and location."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom.functions import labels as L
from fleetloom.functions.config_key import CONFIG_PARTS
from fleetloom.functions.distributions import normal_quantile
from fleetloom.operators.joins import enrich, small

FACTORY = "8101"
KEY = "unique_config_string_location"


def week_count(orders: DataFrame) -> DataFrame:
    """One row: the number of different order weeks (a distinct count over all rows)."""
    return orders.agg(F.count_distinct(F.trunc("order_date", "week")).alias("num_of_weeks"))


def demand_history(
    orders: DataFrame, remap: DataFrame, items: DataFrame, plan: DataFrame, zips: DataFrame,
    factory: str = FACTORY, flags_by: str = "successor",
) -> DataFrame:
    """Orders with successor configuration, compliance, class and field location.

    Orders of the factory and of zips without a service centre drop out. The location type is that of
    the order's own ``location_name``. Flags and class are those of the successor, so orders without one
    are not compliant and have no class; ``flags_by="either"`` takes the ordered configuration there.
    """
    if flags_by not in ("successor", "either"):
        raise ValueError(f"unknown flags_by {flags_by!r}")
    attributes = [c for c in CONFIG_PARTS]
    new = remap.select(
        "config_string_original", "mapped_config_string",
        *[F.col(c).alias(f"new_{c}") for c in attributes],
    )
    mapped = enrich(orders, small(new), {"config_string": "config_string_original"}).withColumns(
        {c: F.coalesce(f"new_{c}", c) for c in attributes}
        | {"_flagged": F.col("mapped_config_string") if flags_by == "successor" else F.coalesce("mapped_config_string", "config_string"),
           "mapped_config_string": F.coalesce("mapped_config_string", "config_string")}
    ).drop(*[f"new_{c}" for c in attributes])
    located = locate(mapped, zips, factory)
    flags = items.select(
        "config_string", "sku_classification",
        L.compliance_flag("is_inventory_policy_eligible").alias("inventory_policy_compliance"),
    )
    plans = plan.select(
        "config_string", L.compliance_flag("is_product_plan_eligible", L.PLAN_COMPLIANT).alias("product_plan_compliance")
    )
    flagged = enrich(located, small(flags), {"_flagged": "config_string"})
    flagged = enrich(flagged, small(plans), {"_flagged": "config_string"}).drop("_flagged")
    return flagged.withColumns({
        c: F.coalesce(c, F.lit(L.NOT_COMPLIANT)) for c in ("inventory_policy_compliance", "product_plan_compliance")
    } | {"order_week": F.trunc("order_date", "week"), "location_type": L.location_type("location_name")})


def locate(orders: DataFrame, zips: DataFrame, factory: str = FACTORY) -> DataFrame:
    """Field service centre of an order and its configuration-location key."""
    zipped = orders.withColumn("order_zip", L.normalize_zip("zip_code"))
    located = enrich(zipped, small(zips), {"order_zip": "customer_zip_code"}, how="inner").filter(
        L.clean_code("sap_sc_code") != factory
    )
    return located.withColumn(KEY, F.concat("mapped_config_string", F.lit(" | "), "sc_name"))


def daily_orders(
    orders: DataFrame, remap: DataFrame, zips: DataFrame, factory: str = FACTORY
) -> DataFrame:
    """Orders per day, configuration and location.

    Orders are counted per raw configuration and zip before any lookup, so the lookups and the
    final count see a fraction of the rows and no configuration or zip can be hot.
    """
    counted = orders.groupBy("config_string", "zip_code", "order_date").agg(F.count("order_id").alias("n"))
    new = remap.select("config_string_original", "mapped_config_string")
    mapped = enrich(counted, small(new), {"config_string": "config_string_original"}).withColumn(
        "mapped_config_string", F.coalesce("mapped_config_string", "config_string")
    )
    return (
        locate(mapped, zips, factory)
        .groupBy(KEY, "order_date")
        .agg(F.sum("n").alias("num_orders_on_date"), *_labels())
    )


def _labels() -> list[Column]:
    """What names a key. Centres with several codes keep the first, so that no key is split."""
    return [F.min(c).alias(c) for c in ("mapped_config_string", "sap_sc_code", "sc_name")]


def weekly_orders(daily: DataFrame) -> DataFrame:
    return daily.groupBy(KEY, F.trunc("order_date", "week").alias("order_week")).agg(
        F.sum("num_orders_on_date").alias("weekly_orders"), *_labels()
    )


def weekly_view(weekly: DataFrame, weeks: DataFrame) -> DataFrame:
    """Weekly counts with the key's total and its average over all weeks."""
    totals = weekly.groupBy(KEY).agg(F.sum("weekly_orders").alias("total_orders"))
    return (
        weekly.select(KEY, "order_week", "weekly_orders")
        .join(totals, KEY)
        .withColumn("num_of_weeks", weeks.scalar())
        .withColumn("avg_orders_per_week", F.col("total_orders") / F.col("num_of_weeks"))
    )


def week_calendar(weekly: DataFrame, kind: str = "observed") -> DataFrame:
    """One row with the array of weeks: those with an order, or all from first to last."""
    if kind == "observed":
        return weekly.agg(F.sort_array(F.collect_set("order_week")).alias("weeks"))
    if kind == "full":
        span = weekly.agg(F.min("order_week").alias("a"), F.max("order_week").alias("b"))
        return span.select(F.sequence("a", "b", F.expr("interval 7 days")).alias("weeks"))
    raise ValueError(f"unknown calendar {kind!r}")


def dense_demand(weekly: DataFrame, calendar: str = "observed") -> DataFrame:
    """A row per key and calendar week, zero where nothing was ordered.

    The zero rows are the result here; statistics do not need them (see weekly_stats). Each
    key's weeks are laid over its calendar inside the row, so there is no join of keys and weeks.
    """
    by_key = weekly.groupBy(KEY).agg(
        F.map_from_entries(F.collect_list(F.struct("order_week", "weekly_orders"))).alias("orders")
    )
    return (
        by_key.withColumn("weeks", week_calendar(weekly, calendar).scalar())
        .select(KEY, "orders", F.explode("weeks").alias("order_week"))
        .select(KEY, "order_week", F.coalesce(F.try_element_at("orders", "order_week"), F.lit(0)).alias("weekly_orders"))
    )


def weekly_stats(weekly: DataFrame, weeks: DataFrame, calendar: str = "observed") -> DataFrame:
    """Average, annualised demand and standard deviation of zero-filled weekly orders per key.

    With S and Q the sum and the sum of squares over the weeks with orders and W all weeks, the
    zero-filled sample variance is (Q - S²/W) / (W - 1): no zero row has to exist.
    """
    span = week_calendar(weekly, calendar).select(F.size("weeks").alias("W"))
    x = F.col("weekly_orders").cast("double")
    sums = weekly.groupBy(KEY).agg(F.sum(x).alias("S"), F.sum(x * x).alias("Q"), *_labels())
    variance = F.try_divide(F.col("Q") - F.col("S") * F.col("S") / F.col("W"), F.col("W") - 1)
    average = F.col("S") / F.col("num_of_weeks")
    return sums.withColumns({"W": span.scalar(), "num_of_weeks": weeks.scalar()}).select(
        KEY, "mapped_config_string", "sap_sc_code", "sc_name",
        F.round(average, 4).alias("average_weekly_demand"),
        F.round(average * 52, 4).alias("annualized_demand"),
        # Rounding may leave a tiny negative variance; a single week has none at all.
        F.round(F.when(F.col("W") > 1, F.sqrt(F.greatest(variance, F.lit(0.0)))), 4)
        .alias("standard_deviation_of_weekly_demand"),
    )


def lane_weeks(lanes: DataFrame, month: str) -> DataFrame:
    """Contracted lead time in whole weeks."""
    kept = (F.col("lane_type") == "Contracted") & (F.col("month") == F.lit(month).cast("date"))
    return lanes.filter(kept).select(
        F.col("location_id").cast("double").cast("long").cast("string").alias("location_id"),
        "location_name", F.round(F.col("total_lead_time") / 7, 0).alias("total_lead_time"),
    )


def add_parameters(
    stats: DataFrame, items: DataFrame, levels: DataFrame, lanes: DataFrame, model_chars: int = 3
) -> DataFrame:
    """Class, service level, thresholds and lane lead time of every key."""
    classes = items.select("config_string", "sku_classification", "model_powertrain")
    keyed = enrich(stats, small(classes), {"mapped_config_string": "config_string"}).withColumns({
        "model": F.substring("model_powertrain", 1, model_chars),
        "location_type": L.location_type("sc_name"),
        "sku_class_letter": F.substring("sku_classification", 1, 1),
    })
    on = {"location_type": "location_type", "model": "model", "sku_class_letter": "sku_class"}
    levelled = enrich(keyed, small(levels, computed=False), on, check_unique=True)
    lane = lanes.select("location_id", "total_lead_time")
    return enrich(levelled, small(lane, computed=False), {"sap_sc_code": "location_id"}, check_unique=True)


def assign_lead_time(
    df: DataFrame, factory_weeks: float, sigma_factory: float, sigma_field: float, factory: str = FACTORY
) -> DataFrame:
    at_factory = F.coalesce(L.clean_code("sap_sc_code") == factory, F.lit(False))
    weeks = F.when(at_factory, F.lit(factory_weeks)).otherwise(F.col("total_lead_time"))
    sigma = F.when(at_factory, F.lit(sigma_factory)).otherwise(F.lit(sigma_field))
    return df.withColumn("lead_time", weeks).withColumn("lead_time_std", sigma * F.col("lead_time"))


def service_level_z(levels: DataFrame) -> DataFrame:
    """z of every distinct service level."""
    known = levels.select("service_level").distinct().filter("service_level > 0 and service_level < 1")
    return known.withColumn("z", normal_quantile(F.col("service_level")))


def raw_safety_stock(df: DataFrame, z: DataFrame) -> DataFrame:
    """z · sqrt(LT · σ² + (σ_LT · μ)²), rounded half-even as the calculator does."""
    with_z = enrich(df, small(z), {"service_level": "service_level"})
    sigma, mean = F.col("standard_deviation_of_weekly_demand"), F.col("average_weekly_demand")
    noise = F.col("lead_time") * sigma * sigma + F.pow(F.col("lead_time_std") * mean, F.lit(2.0))
    units = F.col("z") * F.sqrt(noise)
    return with_z.withColumns({
        "z_score": F.bround("z", 3),
        "raw_safety_stock_units": F.bround(units, 3),
        "rounded_safety_stock_units": F.bround(units, 0).cast("long"),
    }).withColumn(
        "rounded_safety_stock_coverage",
        F.bround(F.try_divide("rounded_safety_stock_units", mean), 0).cast("long"),
    ).drop("z")


def final_safety_stock(df: DataFrame) -> DataFrame:
    """No stock for slow movers, stock capped at the maximum coverage, NULL where inputs lack."""
    mean, cap = F.col("average_weekly_demand"), F.col("ss_coverage_max")
    coverage = F.col("rounded_safety_stock_coverage")
    final: Column = (
        F.when(F.col("annualized_demand") <= F.col("annual_demand_threshold"), F.lit(0))
        .when(coverage >= cap, F.bround(cap * mean, 0).cast("long"))
        .when(coverage < cap, F.col("rounded_safety_stock_units"))
    )
    stocked = df.withColumn("final_safety_stock_units", final)
    weeks = F.try_divide("final_safety_stock_units", mean)
    return stocked.withColumn("final_safety_stock_coverage_weeks", F.coalesce(weeks, F.lit(0.0)))

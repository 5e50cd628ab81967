"""Order-level facts from versioned revenue, and their roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetloom.operators.ordered import first_per_key

# Forecast versions from the most to the least complete year.
VERSION_ORDER = ("12+0", "9+3", "6+6", "3+9", "0+12")
GRAINS = ("week", "month", "quarter")


def version_order() -> list[Column]:
    """Sort keys of a version: NULL years first, then the latest year, then NULL and the
    completest version."""
    version, year = F.col("forecast_version"), F.col("forecast_version_year")
    place = F.when(version.isNull(), 0)
    for i, name in enumerate(VERSION_ORDER, 1):
        place = place.when(version == name, i)
    return [year.isNotNull(), -year, place.otherwise(len(VERSION_ORDER) + 1)]


def version_ranking(revenue: DataFrame) -> DataFrame:
    """All versions ranked. The window is global but runs over the distinct versions only."""
    versions = revenue.select("forecast_version", "forecast_version_year").distinct()
    order = [*version_order(), F.col("forecast_version")]
    return versions.withColumn(
        "forecast_version_rank", F.row_number().over(Window.orderBy(*order)).cast("long")
    )


def packed_version() -> Column:
    """The version order as one number, the smallest first: the year above the place of the version."""
    known, year, place = version_order()
    return F.when(~known, 0).otherwise(F.lit(1 << 40) + year.cast("long")) * 8 + place.cast("long")


def latest_version(revenue: DataFrame, key: str = "oms_order_id", tie: str = "row_id") -> DataFrame:
    """The row of the best version per order (ties: the lowest ``tie``).

    The version order is one long, so its minimum per order is a hash aggregate that tasks combine before
    they send; rows meet it in a join on the order, and only equal versions of one order are compared
    by ``tie``.
    """
    ranked = revenue.withColumn("_rank", packed_version())
    best = ranked.groupBy(key).agg(F.min("_rank").alias("_rank"))
    left = ranked.join(best.select(F.col(key).alias("_key"), F.col("_rank").alias("_best")), (F.col(key).eqNullSafe(F.col("_key"))) & (F.col("_rank") == F.col("_best")))
    return first_per_key(left.select(*revenue.columns), [key], [tie])


MONEY = ("revenue", "base_price", "referral_discount", "price_adjustments", "lease_down_payment_credit",
         "lease_subvention", "apr_subvention")


def normalize_money(df: DataFrame, key: str = "oms_order_id") -> DataFrame:
    """Missing money is zero; a total price is zero unless both of its parts are known."""

    def amount(col: Column, name: str) -> Column:
        return F.coalesce(col, F.lit(0)).cast("double").alias(name)

    return df.select(
        F.col(key).alias("order_id"),
        *[amount(F.col(c), c) for c in MONEY],
        amount(F.col("base_price") + F.col("options"), "total_price"),
        amount(F.col("options"), "options_price"),
        amount(F.abs("total_discount"), "total_discount"),
    )


def order_fact(
    orders: DataFrame, revenue: DataFrame, since: str, models: Sequence[str] | None = None,
    generation: str = "GEN-2",
) -> DataFrame:
    """Orders with calendar columns, payment type and the money of their latest version."""
    keep = (
        (F.col("order_type") == "Order")
        & (F.col("vehicle_generation") == generation)
        & (F.col("order_date") >= F.lit(since).cast("date"))
    )
    if models is not None:
        keep = keep & F.col("model_powertrain").isin(*models)
    money = normalize_money(latest_version(revenue))
    return (
        orders.filter(keep)
        .join(money, "order_id", "left")
        .withColumns({f"order_{g}": F.trunc("order_date", g) for g in GRAINS})
        .withColumn("payment_type", F.coalesce("payment_type", F.lit("Cash")))
    )


def period_rollup(fact: DataFrame, grain: str = "month") -> DataFrame:
    """Distinct orders and mean discount per period; a missing period drops out."""
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}")
    period = f"order_{grain}"
    return fact.filter(F.col(period).isNotNull()).groupBy(period).agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.bround(F.avg("total_discount"), 0).alias("avg_total_discount"),
    )


# Total column → text its parts contain in their names.
NAME_PATTERNS = {
    "total_spend": "spend",
    "total_clicks": "click",
    "total_impressions": "impression",
    "total_drives": "drives",
    "total_leads": "leads",
}
# Monthly measure → daily column.
MONTHLY_MEASURES = {
    "total_spend": "total_spend",
    "total_clicks": "total_clicks",
    "total_impressions": "total_impressions",
    "total_drives": "total_drives",
    "total_leads": "total_leads",
    "email_opens": "opens_email",
    "foot_traffic": "foot_traffic",
    "web_traffic": "web_traffic_total",
    "order_total": "orders_total",
}


def row_totals(df: DataFrame, exclude_totals: bool = False) -> DataFrame:
    """Sum the columns whose names contain a pattern; NULL counts as zero.

    Columns that are totals themselves also contain the pattern, so they count twice unless
    ``exclude_totals`` is set.
    """
    totals = {}
    for name, pattern in NAME_PATTERNS.items():
        cols = [c for c in df.columns if pattern in c and not (exclude_totals and "total" in c)]
        total: Column = F.lit(0)
        for c in cols:
            total = total + F.coalesce(c, F.lit(0))
        totals[name] = total
    return df.withColumns(totals)


def monthly_marketing(daily: DataFrame, exclude_totals: bool = False) -> DataFrame:
    sums = [F.sum(c).alias(n) for n, c in MONTHLY_MEASURES.items()]
    return row_totals(daily, exclude_totals).groupBy(F.trunc("date_pt", "month").alias("month")).agg(*sums)


MODEL_COLUMNS = (
    "order_month", "total_orders", "avg_total_discount", "total_spend", "total_clicks",
    "total_drives", "total_leads", "email_opens", "foot_traffic",
)


def model_input(monthly_orders: DataFrame, marketing: DataFrame) -> DataFrame:
    """One row per month with orders, discount and marketing measures."""
    joined = monthly_orders.join(marketing, F.col("order_month") == F.col("month"), "left")
    return joined.select(*MODEL_COLUMNS)


def lag_features(df: DataFrame, cols: Sequence[str], periods: int, order: str = "order_month") -> DataFrame:
    """Values of ``periods`` rows earlier; rows with any gap drop out.

    The window is global over one row per period, which is a short table at any scale.
    """
    w = Window.orderBy(order)
    lagged = df.withColumns({f"{c}_lag_{periods}": F.lag(c, periods).over(w) for c in cols})
    return lagged.dropna()


def holiday_flag(col: str = "order_month", months: Sequence[int] = (10, 11, 12)) -> Column:
    return F.when(F.month(col).isin(*months), 1).otherwise(0)

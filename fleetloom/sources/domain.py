"""Domain views derived from the star-schema tables in a data folder.

Every column comes from integer and text arithmetic on the tables' keys, so another SQL
engine derives the same values; ``plans/views_sql.py`` holds the SQL twin of each view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom.functions import labels as L
from fleetloom.sources.tables import inline_table, load_table

STATUSES = (
    "PRODUCTION_CONTROL_FROZEN", "DELIVERED", "PRODUCTION_STARTED", "FACTORY_GATED",
    "DECOMMISSIONED", "CREATED", "IN_TRANSIT_TO_DISTRIBUTION_CENTER", "VEHICLE_PREPPED",
)
STATUS_CODES = (100, 200, 210, 300, 310, 315, 320, 400, 410, 420, 430, 440, 450, 460)
VERSIONS = ("12+0", "9+3", "6+6", "3+9", "0+12")
SERVICE_LEVELS = (
    ("Field", "M1", "A", 0.95, 4.0, 6.0),
    ("Field", "M1", "B", 0.90, 3.0, 8.0),
    ("Field", "M2", "A", 0.98, 4.0, 6.0),
    ("Field", "M2", "B", 0.90, 3.0, 4.0),
    ("Field", "M2", "C", 0.85, 2.0, 12.0),
)


UNIT_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, date_format(l_shipdate, 'yyyyMMdd'))"
OPTIONS = (
    "model_powertrain", "paint_id", "interior_id", "wheels_id", "audio_id", "roof_id",
    "tonneau_id", "accents_and_badging_id", "utility_panel_id",
)
OPTIONS_KEY = " || '_' || ".join(OPTIONS)


def _pick(values: tuple, index: str) -> str:
    items = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"get(array({items}), cast({index} as int))"


STATUS = _pick(STATUSES, "(l_orderkey * 7 + l_partkey) % 8")
COUNTRY = "case when l_suppkey % 31 = 1 then null when l_suppkey % 10 = 0 then 'CA' else 'US' end"
SHIPPED = "cast(l_shipdate as date)"
BUILT = f"case when l_returnflag <> 'N' then {SHIPPED} end"


SITE_COLUMNS = (
    "'L' || s_nationkey as location_id",
    "n_name as location_name",
    "case when r_regionkey < 3 then 'US' || r_name when r_regionkey = 3 then r_name end as comm_ops_region",
)


def parts(spark: SparkSession, root: str) -> DataFrame:
    """One row per part with the option attributes it stands for."""
    model = "if(p_partkey % 2 = 0, 'M1', 'M2')"
    brand = "cast(substr(p_brand, 7) as int) % 3"
    return load_table(spark, "part", root).selectExpr(
        "p_partkey",
        f"{model} as model",
        "p_type as powertrain",
        f"{model} || ' ' || p_type as model_powertrain",
        "'EXP-' || upper(split_part(p_name, ' ', 1)) as paint_id",
        f"'INT-' || {brand} as interior_id",
        "'WHL-' || p_size % 5 as wheels_id",
        f"if({brand} = 2, 'AUD-P01', 'AUD-STD') as audio_id",
        "if(p_size % 2 = 0, 'ROOF-FGP', 'ROOF-DGP') as roof_id",
        "if(p_size % 2 = 0, 'TON-NULL', 'TON-P02') as tonneau_id",
        "if(p_size % 5 < 2, 'ACTBDG-DRK', 'ACTBDG-BRT') as accents_and_badging_id",
        f"case when p_size % 5 = 4 then 'UTL-NULL' when {model} = 'M1' then 'UTL-S01' else 'UTL-T01' end as utility_panel_id",
        "if(p_size % 5 <> 4, 1, 0) as is_inventory_policy_eligible",
        f"if({brand} <> 1, 1, 0) as is_product_plan_eligible",
        "case when p_size % 5 = 0 then 'A1' when p_size % 5 < 3 then 'B1' else 'C1' end as sku_classification",
    )


def item_master(spark: SparkSession, root: str) -> DataFrame:
    """One row per configuration of the 2026 model year."""
    return (
        parts(spark, root)
        .drop("p_partkey")
        .distinct()
        .selectExpr("*", "'2026' as model_year", "'US' as country", f"'2026_US_' || {OPTIONS_KEY} as config_string")
    )


def _lines_with_parts(spark: SparkSession, root: str, where: str = "true") -> DataFrame:
    line = load_table(spark, "lineitem", root).filter(where)
    return line.join(parts(spark, root), line.l_partkey == F.col("p_partkey"))


def _lines_of_orders(spark: SparkSession, root: str, *columns: str) -> DataFrame:
    """Lines with parts and ``columns`` of their orders. Orders are joined while the rows are narrow and
    narrow them down; the wide options of a part come last, so no shuffle carries them."""
    orders = load_table(spark, "orders", root).select("o_orderkey", *columns)
    line = load_table(spark, "lineitem", root).join(orders, F.expr("l_orderkey = o_orderkey"))
    return line.join(parts(spark, root), line.l_partkey == F.col("p_partkey"))


def vehicles(spark: SparkSession, root: str, sites: bool = False) -> DataFrame:
    """One row per vehicle. Even line numbers carry the new port and are stored as 2025.

    ``sites`` adds the location columns, which cost another join.
    """
    year = "if(l_linenumber % 2 = 0 or l_linenumber = 7, '2025', '2026')"
    centre = "case when l_suppkey % 23 = 1 then null when l_suppkey % 3 = 0 then '8101' else cast(8000 + l_suppkey % 20 as string) end"
    base = _lines_with_parts(spark, root)
    if sites:
        supplier = load_table(spark, "supplier", root).select("s_suppkey", "s_nationkey")
        # 25 nations and 5 regions, whatever the scale.
        nation = F.broadcast(load_table(spark, "nation", root))
        region = F.broadcast(load_table(spark, "region", root))
        base = (
            base.join(supplier, F.expr("l_suppkey = s_suppkey"))
            .join(nation, F.expr("s_nationkey = n_nationkey"))
            .join(region, F.expr("n_regionkey = r_regionkey"))
        )
    return base.selectExpr(
        f"{UNIT_ID} as vehicle_id",
        f"case when l_returnflag <> 'N' then 'VIN' || {UNIT_ID} end as vin",
        "model", "powertrain", *OPTIONS,
        f"{year} as model_year",
        f"{year} || '_US_' || {OPTIONS_KEY} as config_string",
        f"{COUNTRY} as country",
        "if(l_linenumber % 2 = 0, 'CHRG-NACS01', 'CHRG-CCS01') as charging_port_id",
        f"{STATUS} as vehicle_status",
        "if(l_suppkey % 11 = 1, 'CANCELED', 'ACTIVE') as vehicle_record_status",
        "if(l_partkey % 13 = 1, 'INTERNAL', 'CUSTOMER_DELIVERY') as vehicle_usage",
        "if(l_partkey % 53 = 1, 'GEN-1', 'GEN-2') as vehicle_generation",
        "case when l_suppkey % 19 = 1 then null when l_suppkey % 17 = 1 then 'NON_SALEABLE' else 'SALEABLE' end as vin_salability",
        f"{centre} || if(l_linenumber = 5, '.0', '') as distribution_center",
        "case when l_linestatus = 'F' then 'REAL' end as match_status",
        "if(l_linestatus = 'F', 1, 0) as is_matched",
        f"if({STATUS} = 'DELIVERED', 1, 0) as is_delivered",
        "case when l_partkey % 29 = 1 then 'US_FLEET_20250201' when cast(l_quantity as int) % 4 = 0 then 'US_Custom_20250101'"
        " when cast(l_quantity as int) % 4 = 1 then 'US_Inventory_20250115'"
        " when cast(l_quantity as int) % 4 = 2 then 'US_Launch-Order_soon' end as metadata_source_order",
        "if(l_partkey % 41 = 1, 'BLD-LAUNCH', 'BLD-' || model) as build_id",
        f"{SHIPPED} as expected_ga_in_date",
        f"{BUILT} as actual_ga_in_date",
        f"date_add({SHIPPED}, 7) as expected_factory_gate_date",
        f"date_add({BUILT}, 7) as actual_factory_gate_date",
        f"date_sub({SHIPPED}, 14) as expected_build_date_ip",
        *(SITE_COLUMNS if sites else ()),
    )


def forecast(spark: SparkSession, root: str) -> DataFrame:
    """Forecast order lines; ``id`` numbers the forecast run."""
    return _lines_with_parts(spark, root, "l_linestatus = 'O'").selectExpr(
        "l_linenumber as id",
        f"{UNIT_ID} as order_id",
        f"{SHIPPED} as order_date",
        # Some lines still carry the key of the year before.
        f"if(l_suppkey % 4 = 1, '2025', '2026') || '_US_' || {OPTIONS_KEY} as config_string",
        "model_powertrain",
        "'2026' as model_year",
        f"{COUNTRY} as country",
    )


def order_lines(spark: SparkSession, root: str) -> DataFrame:
    """Customer orders at unit grain with configuration and zip code."""
    year = "if(l_linenumber % 2 = 0, '2025', '2026')"
    return (
        _lines_of_orders(spark, root, "o_custkey", "o_orderdate")
        .selectExpr(
            f"{UNIT_ID} as order_id",
            "cast(o_orderdate as date) as order_date",
            "if(l_linenumber = 7, 'Reservation', 'Order') as order_type",
            "case when l_suppkey % 9 = 1 then 'CUSTOMER_UNRESPONSIVE' when l_suppkey % 9 = 2 then 'CANCELLED'"
            " when l_suppkey % 9 = 3 then null else 'IN_PROGRESS' end as fulfillment_status",
            "if(l_partkey % 17 = 1, 1, 0) as is_cancelled",
            "if(l_suppkey % 10 = 0, 'CA', 'US') as country",
            "lpad(o_custkey % 100000, 5, '0') || if(o_custkey % 7 = 0, '-1234', '') as zip_code",
            "if(l_suppkey % 6 = 0, 'Plant Normal', 'Site ' || l_suppkey % 12) as location_name",
            f"{year} as model_year",
            "if(l_partkey % 53 = 1, 'GEN-1', 'GEN-2') as vehicle_generation",
            f"{year} || '_US_' || {OPTIONS_KEY} as config_string",
            "model", "powertrain", *OPTIONS,
        )
    )


def zip_map(spark: SparkSession, root: str) -> DataFrame:
    """Customer zip → service centre; at most 100,000 rows by construction."""
    nation = load_table(spark, "nation", root)
    site = (
        load_table(spark, "customer", root)
        .selectExpr("lpad(c_custkey % 100000, 5, '0') as zip5", "c_nationkey")
        .groupBy("zip5")
        .agg(F.min("c_nationkey").alias("nationkey"))
    )
    return (
        site.join(F.broadcast(nation), F.expr("nationkey = n_nationkey"))
        .withColumn("customer_zip_code", L.normalize_zip("zip5"))
        .selectExpr(
            "customer_zip_code",
            "if(nationkey % 5 = 0, '8101', cast(8100 + nationkey as string)) as sap_sc_code",
            "if(nationkey % 5 = 0, 'Normal', 'SC-' || n_name) as sc_name",
        )
    )


def lanes(spark: SparkSession, root: str) -> DataFrame:
    """Contracted lead time in days per service centre and month."""
    return load_table(spark, "nation", root).selectExpr(
        "cast(8100 + n_nationkey as double) as location_id",
        "'SC-' || n_name as location_name",
        "if(n_nationkey % 6 = 5, 'Spot', 'Contracted') as lane_type",
        "date '2001-06-01' as month",
        "cast(n_nationkey * 3 + 7 as double) as total_lead_time",
    )


def service_levels(spark: SparkSession) -> DataFrame:
    return inline_table(
        spark, SERVICE_LEVELS,
        "location_type string, model string, sku_class string, service_level double,"
        " annual_demand_threshold double, ss_coverage_max double",
    )


def revenue(spark: SparkSession, root: str) -> DataFrame:
    """Money per order and forecast version; several versions of one order occur."""
    return load_table(spark, "lineitem", root).selectExpr(
        "l_orderkey as oms_order_id",
        f"{UNIT_ID} as row_id",
        f"{_pick(VERSIONS, 'l_linenumber % 6')} as forecast_version",
        "case when l_linenumber % 6 <> 5 then 2024 + cast(l_suppkey as int) % 2 end as forecast_version_year",
        "l_extendedprice as revenue",
        "l_extendedprice as base_price",
        "case when l_suppkey % 8 <> 1 then l_tax * 1000 end as options",
        "-l_extendedprice * l_discount as total_discount",
        "case when l_suppkey % 5 <> 1 then l_discount * 100 end as referral_discount",
        "case when l_suppkey % 7 <> 1 then -l_tax * 200 end as price_adjustments",
        "case when l_partkey % 4 = 1 then l_tax * 500 end as lease_down_payment_credit",
        "case when l_partkey % 6 = 1 then l_discount * 300 end as lease_subvention",
        "case when l_partkey % 9 = 1 then l_discount * 400 end as apr_subvention",
    )


def placed_orders(spark: SparkSession, root: str) -> DataFrame:
    """Orders as the volume model sees them."""
    return load_table(spark, "orders", root).selectExpr(
        "o_orderkey as order_id",
        "cast(o_orderdate as date) as order_date",
        "if(o_orderkey % 11 = 1, 'Reservation', 'Order') as order_type",
        "if(o_orderkey % 23 = 1, 'GEN-1', 'GEN-2') as vehicle_generation",
        "'M' || (o_orderkey % 2 + 1) || ' ' || o_orderpriority as model_powertrain",
        "case o_orderstatus when 'F' then 'Lease' when 'O' then 'Loan' end as payment_type",
        "if(o_custkey % 10 = 0, 'CA', 'US') as country",
    )


def marketing_daily(spark: SparkSession, root: str) -> DataFrame:
    """One row per day with metric columns, pre-totalled ones included."""
    # Whole cents in integer arithmetic: sums do not depend on the order of the rows.
    cents = "cast(round(l_extendedprice * 100) as bigint)"
    metrics = {
        "spend_search": f"sum(case when l_returnflag = 'A' then {cents} end)",
        "spend_social": f"sum(case when l_returnflag = 'R' then {cents} end)",
        "clicks_search": "count(case when l_returnflag = 'A' then 1 end)",
        "clicks_social": "count(case when l_returnflag = 'R' then 1 end)",
        "impressions_search": "sum(cast(l_quantity as bigint))",
        "drives_demo": "count(case when l_linestatus = 'F' then 1 end)",
        "drives_total": "count(case when l_linestatus = 'O' then 1 end)",
        "leads_web": "count(distinct l_suppkey)",
        "leads_total": "sum(l_linenumber)",
        "opens_email": "sum(l_suppkey % 50)",
        "foot_traffic": "sum(l_partkey % 20)",
        "web_traffic_total": "sum(l_orderkey % 30)",
        "orders_total": "count(distinct l_orderkey)",
    }
    return (
        load_table(spark, "lineitem", root)
        .groupBy(F.expr(SHIPPED).alias("date_pt"))
        .agg(*[F.expr(e).alias(n) for n, e in metrics.items()])
    )


def matching_run(spark: SparkSession, root: str) -> DataFrame:
    """Daily matching run: order and vehicle rows with their option columns."""
    return (
        _lines_of_orders(spark, root, "o_custkey")
        .selectExpr(
            f"{UNIT_ID} as oms_order_id",
            f"{_pick(('Unallocated', 'Customer Configured', 'Shop'), 'l_linenumber % 3')} as build_type_internal",
            f"{_pick(('CONFIGURED', 'CONFIGURED', 'ORDERED', 'RESERVED'), 'l_orderkey % 4')} as financial_status",
            "case when l_suppkey % 9 = 1 then 'CUSTOMER_UNRESPONSIVE' when l_suppkey % 9 = 2 then 'CUSTOMER_NOT_READY_TO_CONFIRM'"
            " when l_suppkey % 9 = 3 then null else 'IN_PROGRESS' end as fulfillment_status",
            "case when l_linestatus = 'F' then if(l_linenumber % 2 = 0, 'PREDICTIVE', 'REAL') end as match_status",
            f"{_pick(STATUS_CODES, '(l_orderkey + l_partkey) % 14')} as vehicle_status_code",
            f"{STATUS} as vehicle_status",
            "if(l_partkey % 13 = 1, 'INTERNAL', 'CUSTOMER_DELIVERY') as vehicle_usage",
            "case when l_suppkey % 7 = 1 then 'QUALITY' end as hold_type",
            "if(l_partkey % 25 = 1, -2, l_partkey % 25) as build_batch",
            "if(l_partkey % 53 = 1, 'GEN-1', 'GEN-2') as vehicle_architecture",
            "if(l_partkey % 53 = 1, 'GEN-1', 'GEN-2') as items_vehicle_generation_id",
            f"{SHIPPED} as expected_general_assembly_date",
            "case when l_linenumber = 5 then '8101.0' when l_suppkey % 3 = 0 then '8101'"
            " else cast(8000 + l_suppkey % 20 as string) end as distribution_center",
            "lpad(o_custkey % 100000, 5, '0') as ship_to_zipcode",
            "'Site ' || l_suppkey % 12 as delivery_location_name",
            f"case when l_partkey % 7 <> 1 then {UNIT_ID} end as unique_build_id",
            """case when l_linenumber = 1 then case l_partkey % 3 when 0 then 'The price is not what I expected'
               when 1 then "Delivery isn't soon enough" else 'Other' end end as question1_response""",
            "case when l_linenumber = 2 then case l_partkey % 3 when 0 then 'Pricing' when 1 then 'Delivery date' else 'Other' end end as cancel_code",
            "model as sku",
            "powertrain as trim",
            "'MOT-' || substr(interior_id, 5) as motor",
            "if(powertrain in ('LARGE', 'MEDIUM'), 'BAT-MAX', 'BAT-STD') as battery",
            "paint_id as exterior",
            "interior_id as interior",
            "wheels_id as wheels",
            "case when wheels_id = 'WHL-3' then 'ORD-001' end as offroad",
            "case when wheels_id = 'WHL-3' then 'ATP-001' when wheels_id <> 'WHL-2' then 'ATP-NULL' end as atp",
            "tonneau_id as tonneau",
            "if(l_suppkey % 10 = 0, 'RGN-CAN', 'RGN-USA') as build_country",
            "roof_id as roof",
            "audio_id as audio",
            "utility_panel_id as utility",
            "accents_and_badging_id as badging",
        )
    )


def dc_map(spark: SparkSession, root: str) -> DataFrame:
    """Customer zip → distribution centre; some zips are missing on purpose."""
    zips = load_table(spark, "customer", root).selectExpr("c_custkey % 100000 as n").distinct()
    return zips.filter("n % 4 <> 1").selectExpr(
        "lpad(n, 5, '0') as customer_zip",
        "if(n % 3 = 0, '8101', cast(8000 + n % 20 as string)) as dc",
    )


def dc_regions(spark: SparkSession) -> DataFrame:
    """Distribution centre → delivery region."""
    rows = [("8101", "Central")] + [(str(8000 + i), ("East", "West")[i % 2]) for i in range(18)]
    return inline_table(spark, rows, "distribution_center_text string, dc_region string")

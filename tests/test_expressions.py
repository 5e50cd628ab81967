import datetime as dt

from pyspark.sql import functions as F

from fleetloom.functions import config_key as K
from fleetloom.functions import labels as L

UNIT = "vin string, vehicle_status string, vehicle_record_status string, distribution_center string"


def values(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_zones(spark):
    rows = [
        (None, "PRODUCTION_CONTROL_FROZEN", "ACTIVE", None),
        ("v", "PRODUCTION_CONTROL_FROZEN", "ACTIVE", None),
        ("v", "DELIVERED", "ACTIVE", None),
        ("v", "FACTORY_GATED", "ACTIVE", "8101.0"),
        ("v", "FACTORY_GATED", "ACTIVE", "8005"),
        ("v", "FACTORY_GATED", "ACTIVE", None),
        (None, "FACTORY_GATED", "ACTIVE", "8101"),
        ("v", "DECOMMISSIONED", "ACTIVE", None),
        (None, "CREATED", "ACTIVE", None),
        (None, "CREATED", "CANCELED", None),
        (None, None, None, None),
    ]
    df = spark.createDataFrame(rows, UNIT)
    assert values(df, L.production_zone(L.DASHBOARD_ZONES)) == [
        "4. Firm", "3. Frozen/VINned", "Delivered", "1. Already Built/ WIP at Normal",
        "2. Already Built/ WIP in Field", "Investigate", "Investigate", "Decommissioned", "5. Liquid",
        "Investigate", "Investigate",
    ]
    assert values(df, L.production_zone(L.PLANNING_ZONES))[:6] == [
        "Frozen", "Firm/ VINned", "Delivered", "Already Built/ WIP", "Already Built/ WIP", "Already Built/ WIP"
    ]


def test_source_order(spark):
    df = spark.createDataFrame([("US_Custom_20250102",), ("US_x",), ("US",), ("a_b_soon",), (None,)], "metadata_source_order string")
    got = df.select(*[c.alias(n) for n, c in L.source_order_parts().items()]).collect()
    assert [tuple(r) for r in got] == [
        ("US", "Custom", dt.date(2025, 1, 2)), ("US", "x", None), ("US", None, None), ("a", "b", None), (None, None, None)
    ]


def test_custom_flag(spark):
    df = spark.createDataFrame([("custom",), ("My Order",), ("Custom",), (None,)], "metadata_source_order string")
    assert values(df, L.custom_flag(rule="planning")) == ["Custom", "Inventory", "Custom", "Inventory"]
    assert values(df, L.custom_flag(rule="dashboard")) == ["Inventory", "Custom", "Custom", "Inventory"]


def test_zip_region_and_codes(spark):
    df = spark.createDataFrame([("33076-4619",), ("01234",), ("01234-5678",), ("00123",), ("9",), (None,)], "z string")
    assert values(df, L.normalize_zip("z")) == ["33076", "1234", "01234", "0123", "9", None]
    df = spark.createDataFrame([("USWest",), ("Canada",), (None,)], "r string")
    assert values(df, L.location_region("r")) == ["West", "Canada", None]
    assert values(df, L.location_region("r", "other")) == ["West", "Canada", "other"]
    df = spark.createDataFrame([("8101.0",), ("81010",), (None,)], "c string")
    assert values(df, L.clean_code("c")) == ["8101", "81010", None]


def test_null_rules(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert values(df.filter(L.not_in("x", ["a"])), "x") == ["b", None]
    df = spark.createDataFrame([(1,), (0,), (None,)], "e int")
    assert values(df, L.compliance_flag("e")) == [L.COMPLIANT, L.NOT_COMPLIANT, L.NOT_COMPLIANT]


def test_sequence_date(spark):
    days = [dt.date(2025, 1, i) for i in (1, 2, 3)]
    rows = [("Frozen", "PRODUCTION_CONTROL_FROZEN", *days), ("Already Built/ WIP", "FACTORY_OK", *days),
            ("Investigate", "PRODUCTION_STARTED", *days), ("Liquid", "CREATED", *days), ("Delivered", "DELIVERED", *days)]
    df = spark.createDataFrame(rows, "production_zone string, vehicle_status string, expected_ga_in_date date, actual_ga_in_date date, expected_build_date_ip date")
    assert values(df, L.sequence_date("2025-06-01")) == [days[0], days[1], days[1], days[2], dt.date(2025, 6, 1)]


def test_available_supply_drops_nulls(spark):
    ok = dict(metadata_source_order="US_x_1", match_status=None, is_delivered=0, vin_salability="S", vehicle_status="FACTORY_OK",
              vehicle_usage="CUSTOMER_DELIVERY", vehicle_record_status="ACTIVE", actual_factory_gate_date=None,
              expected_factory_gate_date=dt.date(2025, 1, 1))
    changes = [{}, {"metadata_source_order": None}, {"metadata_source_order": "a_FLEET"}, {"vin_salability": None},
               {"match_status": "REAL"}, {"vehicle_status": "RETURNED"}, {"expected_factory_gate_date": None},
               {"actual_factory_gate_date": dt.date(2026, 1, 1)}, {"vehicle_record_status": "CANCELED"}]
    schema = ("metadata_source_order string, match_status string, is_delivered int, vin_salability string, vehicle_status string, vehicle_usage string,"
              "vehicle_record_status string, actual_factory_gate_date date, expected_factory_gate_date date")
    df = spark.createDataFrame([tuple((ok | c).values()) for c in changes], schema)
    assert df.filter(L.available_supply("2025-06-01", "%FLEET%")).count() == 1
    assert df.filter(L.available_supply("2025-06-01", "%FLEET%", require_active=False)).count() == 2


CONFIG = "2026_US_M1 Quad Max_EXP-A_INT-B_WHL-0AD_AUD-C_ROOF-D_TON-NULL_ACTBDG-E_UTL-F"


def test_decode(spark):
    df = spark.createDataFrame([(CONFIG,), ("2026_CA",), ("y_US_m_EXP-1_EXP-2_INTX",), (None,)], "c string")
    got = df.select(*[c.alias(n) for n, c in K.decode_config("c").items()]).collect()
    assert got[0].asDict() == dict(model_year="2026", country="US", model_powertrain="M1 Quad Max", exterior="EXP-A", interior="INT-B",
                                   wheels="WHL-0AD", audio="AUD-C", roof="ROOF-D", tonneau="TON-NULL", badging="ACTBDG-E", utility="UTL-F")
    assert got[1].exterior is None and got[1].model_powertrain is None
    assert (got[2].exterior, got[2].interior) == ("EXP-2", None)
    assert set(got[3]) == {None}
    loose = df.select(K.decode_config("c", strict=False)["interior"]).collect()
    assert loose[2][0] == "INTX"


def test_encode_and_rules(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    assert values(df, K.encode_config(("x", "y"))) == ["a_b", None]
    df = spark.createDataFrame([("US",), ("CA",), ("DE",), (None,)], "c string")
    assert values(df, K.region_code(F.col("c"))) == ["RGN-USA", "RGN-CAN", "RGN-DE", None]
    df = spark.createDataFrame([("WHL-0AD",), ("WHL-2",), (None,)], "w string")
    assert values(df, K.atp_for_wheels(F.col("w"))) == ["ATP-001", "ATP-NULL", "ATP-NULL"]
    df = spark.createDataFrame([("M1", "M1 Max", "EXP-C"), ("M1", "M1 Max", "x"), ("M2", "M2 Max", "x")], "model string, model_powertrain string, paint_id string")
    assert values(df, K.build_option_id({"M1 Max": "B1"}, {("M1", "EXP-C"): "B0"})) == ["B0", "B1", None]
    df = spark.createDataFrame([("2025_2025", "CHRG-NACS01"), ("2025", None)], "c string, charging_port_id string")
    assert values(df, K.roll_model_year("c")) == ["2026_2026", "2025"]
    assert values(df, K.roll_model_year("c", port=None)) == ["2026_2026", "2026"]
    assert values(spark.createDataFrame([("A B C D",)], "m string"), K.model_words(F.col("m"))) == ["A_B_C"]


def test_remap(spark):
    rules = K.RemapRules(interior={"INT-V": "INT-P"}, premium_powertrains=("Large",), premium_wheels={"WHL-0": "WHL-2"},
                         badging={"Tri": "ACTBDG-DRK"}, tonneau_models=("T Large",), base_configs=("base",), utility={"S Std": "UTL-S01"})
    cols = ["config_string", "model_year", "country", "powertrain", "model_powertrain", *K.CONFIG_PARTS[3:]]
    rows = [
        ("c1", "2025", "US", "Large", "T Large", "EXP", "INT-V", "WHL-0", "AUD-S", "ROOF-DGP", "TON-NULL", "ACTBDG-X", "UTL-0"),
        ("c2", "2025", "US", "Tri", "S Tri", "EXP", "INT-Q", "WHL-0", "AUD-P01", "ROOF-F", "TON-P01", "ACTBDG-X", "UTL-0"),
        ("base", "2025", "US", "Std", "S Std", "EXP", "INT-Q", "WHL-0", "AUD-S", "ROOF-F", "TON-NULL", "ACTBDG-X", "UTL-NULL"),
        ("c4", "2025", "US", "Std", "S Std", "EXP", "INT-Q", "WHL-0", "AUD-S", "ROOF-F", "TON-NULL", "ACTBDG-X", "UTL-0"),
        ("c5", "2026", "US", "Std", "S Std", "EXP", "INT-Q", "WHL-0", "AUD-S", "ROOF-F", "TON-NULL", "ACTBDG-X", "UTL-0"),
    ]
    df = spark.createDataFrame(rows * 2, ", ".join(f"{c} string" for c in cols))
    got = {r.config_string_original: r.mapped_config_string for r in K.remap_config(df, rules).collect()}
    assert got == {
        "c1": "2026_US_T Large_EXP_INT-P_WHL-2_AUD-P01_ROOF-DGP_TON-P02_ACTBDG-X_UTL-0",
        "c2": "2026_US_S Tri_EXP_INT-Q_WHL-0_AUD-P01_ROOF-F_TON-P02_ACTBDG-DRK_UTL-0",
        "base": "2026_US_S Std_EXP_INT-Q_WHL-0_AUD-S_ROOF-F_TON-NULL_ACTBDG-X_UTL-NULL",
        "c4": "2026_US_S Std_EXP_INT-Q_WHL-0_AUD-S_ROOF-F_TON-NULL_ACTBDG-X_UTL-S01",
    }


def test_blank_unchanged(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", None), (None, "b")], "n string, o string")
    assert values(K.blank_unchanged(df, {"n": "o"}), "n") == [None, "a", "a", None]

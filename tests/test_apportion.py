import random

from fleetloom.functions import config_key as K
from fleetloom.operators import pairing as G
from fleetloom.operators.allocate import allocate_or_apportion, allocate_units, apportion_units
from fleetloom.operators.safety_stock import demand_history
from fleetloom.plans import matching
from fleetloom.plans import params as P

STATE = "config_string string, model_powertrain string, supply long, demand long, net_supply long, velocity double, report_dos double"
PLAN = "model_powertrain string, units long"


def by_remainder(weights, plan):
    """Largest remainder, model by model."""
    out = {}
    for model, units in plan:
        rows = sorted((c, max(w or 0, 0)) for c, m, w in weights if m == model)
        if not rows or not units or units < 0:
            continue
        total = sum(w for _, w in rows)
        if not total:
            rows, total = [(c, 1) for c, _ in rows], len(rows)
        split = {c: units * w // total for c, w in rows}
        spare = units - sum(split.values())
        for c, w in sorted(rows, key=lambda r: (-(units * r[1] % total), r[0]))[:spare]:
            split[c] += 1
        out |= split
    return out


def test_units_by_take_rate(spark):
    rng = random.Random(7)
    weights = [(f"c{m}-{c:02d}", f"m{m}", rng.choice([0, None, 1, 2, 3, 50, 10 ** 12])) for m in range(8) for c in range(rng.randrange(1, 20))]
    weights += [("z1", "zero", 0), ("z2", "zero", None), ("z3", "zero", 0), ("t1", "tie", 1), ("t2", "tie", 1)]
    plan = [(f"m{m}", rng.choice([0, 1, 7, 1000])) for m in range(8)] + [("zero", 5), ("tie", 3), ("none", 4), ("m9", None)]
    got = apportion_units(
        spark.createDataFrame(weights, "config_string string, model_powertrain string, weight long"), spark.createDataFrame(plan, PLAN)
    ).collect()
    assert {r.config_string: r.added_volume for r in got} == by_remainder(weights, plan)
    for model, units in plan:
        mine = [r.added_volume for r in got if r.model_powertrain == model]
        assert not mine or sum(mine) == units
    assert apportion_units(spark.createDataFrame([], "config_string string, model_powertrain string, weight long"),
                           spark.createDataFrame(plan, PLAN)).count() == 0


def test_models_without_supply_follow_the_take_rate(spark):
    state = spark.createDataFrame([
        ("a1", "a", 4, 1, 3, 0.5, 8.0), ("a2", "a", 0, 2, -2, 1.0, 0.0),
        ("b1", "b", 0, 3, -3, 0.5, 0.0), ("b2", "b", 0, 1, -1, 0.5, 0.0), ("b3", "b", None, 0, 0, 0.5, 0.0),
    ], STATE)
    plan = spark.createDataFrame([("a", 5), ("b", 6)], PLAN)
    got = {r.config_string: r.added_volume for r in allocate_or_apportion(state, plan).collect()}
    filled = {r.config_string: r.added_volume for r in allocate_units(state, plan.filter("model_powertrain = 'a'")).collect()}
    assert got == filled | {"b1": 5, "b2": 1, "b3": 0}  # 4.5 and 1.5: the tie goes to the lower key


def test_flags_of_the_successor_or_of_either_key(spark):
    parts = [c for c in K.CONFIG_PARTS if c != "country"]
    orders = spark.createDataFrame(
        [(1, "old", "01000", "Plant Normal", "CA"), (2, "same", "01000", "Site 3", "US"), (3, "old", "01000", None, "US")],
        "order_id int, config_string string, zip_code string, location_name string, country string",
    ).selectExpr("*", "date '2000-01-05' as order_date", *[f"'x' as {c}" for c in parts])
    remap = spark.createDataFrame([("old", "new", "US")], "config_string_original string, mapped_config_string string, country string").selectExpr(
        "*", *[f"'y' as {c}" for c in parts])
    items = spark.createDataFrame([("new", "A1", 1, 1), ("same", "B1", 1, 0)],
                                  "config_string string, sku_classification string, is_inventory_policy_eligible int, is_product_plan_eligible int")
    zips = spark.createDataFrame([("1000", "8102", "SC")], "customer_zip_code string, sap_sc_code string, sc_name string")

    def run(**how):
        rows = demand_history(orders, remap, items, items, zips, **how).orderBy("order_id").collect()
        return [(r.sku_classification, r.inventory_policy_compliance, r.location_type, r.country) for r in rows]

    first, last = ("A1", "Inventory Policy Compliant", "Normal", "US"), ("A1", "Inventory Policy Compliant", "Field", "US")
    assert run() == [first, (None, "Not Compliant", "Field", "US"), last]
    assert run(flags_by="either") == [first, ("B1", "Inventory Policy Compliant", "Field", "US"), last]


def test_camp_speaker(spark):
    df = spark.createDataFrame([("2026_US_M1_EXP-A_SPKR-1",), ("2026_US_M1_EXP-A",)], "c string")
    assert [r[0] for r in df.select(K.decode_config("c", K.INSTRUCTION_PREFIXES)["camp_speaker"]).collect()] == ["SPKR-1", None]


def test_optional_steps_have_the_written_keys():
    """The twin leaves out groupings that are the same for all rows."""
    keys = G.step_keys(order=("exact_matches", *G.OPTIONAL_STEPS))
    constant = {name for name, (source, _) in P.GROUPS.items() if not source}
    assert {k: sorted(set(v) - constant) for k, v in keys.items()} == {k: sorted(v.split()) for k, v in matching._OPTIONAL_KEYS.items()}

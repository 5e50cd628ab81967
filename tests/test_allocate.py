import random

import pytest

from fleetloom.operators.allocate import allocate_units, expand_units, unplaced_units


def greedy(state, plan):
    """The literal loop: one unit at a time to the lowest level."""
    added = {}
    for model, units in plan:
        rows = sorted((r for r in state if r[1] == model), key=lambda r: (r[4], r[0]))
        n = {r[0]: 0 for r in rows}
        for _ in range(units if rows else 0):
            best = min(rows, key=lambda r: (n[r[0]] + r[2]) / r[3])
            n[best[0]] += 1
        added |= n if units else {}
    return added


@pytest.mark.parametrize("seed,hot", [(1, False), (2, False), (3, True), (4, True)])
def test_allocation_equals_the_greedy_loop(spark, seed, hot, request):
    if hot:
        request.getfixturevalue("hot_groups")
    rng = random.Random(seed)
    state, plan = [], []
    for m in range(6):
        for c in range(rng.randrange(1, 25)):
            velocity = rng.choice([1 / 60, 0.1, 0.5, 1.0, 2.25, rng.random() + 0.01])
            net = rng.randrange(-20, 40)
            state.append((f"c{m}-{c:02d}", f"m{m}", net, velocity, max(net, 0) / velocity))
        plan.append((f"m{m}", rng.choice([0, 1, 7, 150, 400])))
    plan.append(("m-without-config", 5))
    s = spark.createDataFrame(state, "config_string string, model_powertrain string, net_supply int, velocity double, report_dos double")
    p = spark.createDataFrame(plan, "model_powertrain string, units int")
    result = allocate_units(s, p).collect()
    assert {r.config_string: r.added_volume for r in result} == greedy(state, plan)
    for model, units in plan[:-1]:
        assert sum(r.added_volume for r in result if r.model_powertrain == model) == units
    assert [r.units for r in unplaced_units(s, p).collect()] == [5]


def test_ties_go_to_the_lower_report_figure_then_key(spark):
    s = spark.createDataFrame(
        [("b", "m", 0, 1.0, 0.0), ("a", "m", 0, 1.0, 0.0), ("c", "m", 0, 1.0, -1.0)],
        "config_string string, model_powertrain string, net_supply int, velocity double, report_dos double",
    )
    p = spark.createDataFrame([("m", 2)], "model_powertrain string, units int")
    assert {r.config_string: r.added_volume for r in allocate_units(s, p).collect()} == {"a": 1, "b": 0, "c": 1}


def test_expand_skips_zero(spark):
    df = spark.createDataFrame([("a", 2), ("b", 0)], "c string, added_volume int")
    assert sorted((r.c, r.unit) for r in expand_units(df).collect()) == [("a", 1), ("a", 2)]

import random

import pytest

from fleetloom.operators.pairing import (
    COMMON_OPTIONS, RELAXATIONS, STEP_ORDER, add_groups, cascade_match, exact_match, step_keys,
)


@pytest.mark.parametrize("hot", [False, True])
def test_exact_match_equals_the_loop(spark, hot, request):
    if hot:
        request.getfixturevalue("hot_groups")
    rng = random.Random(5)

    def key():
        return rng.choice(["hot", "hot", "a", "b", "c", None])

    demand = [(f"d{i:03d}", f"d{i:03d}", key()) for i in range(120)]
    supply = [(f"v{i:03d}", f"v{i:03d}", key()) for i in range(100)]
    used, want = set(), {}
    for d, _, k in demand:
        hit = next((v for v, _, s in supply if k is not None and s == k and v not in used), None)
        want[d] = hit
        used.add(hit)
    twice = supply + supply[:10]  # repeated ids count once
    schema = "id string, ord string, k string"
    got = exact_match(spark.createDataFrame(demand, schema), spark.createDataFrame(twice, schema), "k").collect()
    assert {r.id: r.supply_id for r in got} == want


@pytest.mark.parametrize("hot", [False, True])
def test_cascade_equals_the_loop(spark, hot, request):
    if hot:
        request.getfixturevalue("hot_groups")
    rng = random.Random(6)
    steps = {"all": ["a", "b", "c"], "same as all": ["a", "b", "c", "g"], "no c": ["a", "b"], "a": ["a"], "g": ["g"]}

    def row(prefix, i):
        a, b, c = rng.choice("xxy"), rng.choice(["p", "q", None]), rng.choice("1234")
        return (f"{prefix}{i:03d}", f"{prefix}{i:03d}", a, b, c, "any" if a == "x" else "other")

    demand, supply = [row("d", i) for i in range(80)], [row("v", i) for i in range(70)]
    names = ["id", "ord", "a", "b", "c", "g"]
    want, used = {d[0]: (None, None) for d in demand}, set()
    for name, cols in steps.items():
        at = [names.index(c) for c in cols]
        for d in demand:
            if want[d[0]][0] is None:
                hit = next((v for v in supply if v[0] not in used and all(v[i] == d[i] for i in at)), None)
                if hit:
                    used.add(hit[0])
                    want[d[0]] = (hit[0], name)
    schema = ", ".join(f"{n} string" for n in names)
    got = cascade_match(spark.createDataFrame(demand, schema), spark.createDataFrame(supply, schema), steps).collect()
    assert {r.id: (r.supply_id, r.match_step) for r in got} == want
    matched = [r.supply_id for r in got if r.supply_id]
    assert len(matched) == len(set(matched))


def test_cascade_without_supply(spark):
    d = spark.createDataFrame([("d", "d", "x")], "id string, ord string, a string")
    assert [tuple(r) for r in cascade_match(d, d.limit(0), {"s": ["a"]}).collect()] == [("d", None, None)]


def test_step_keys():
    plain, local = step_keys(), step_keys(local=True)
    assert list(plain) == list(STEP_ORDER) and plain["exact_matches"] == list(COMMON_OPTIONS)
    assert plain["powertrain_constant"] == ["sku", "motor", "battery", "tonneau", "build_country"]
    assert local["tonneau_agnostic"][-2:] == ["utility_panel_agnostic", "distribution_center"]
    assert "utility_panel_agnostic" not in local["utility_panel_agnostic"]
    optional = [s for s in RELAXATIONS if s not in STEP_ORDER]
    assert len(optional) == 10
    assert "distribution_center" not in step_keys(True, optional)["exterior_agnostic"]


def test_groups(spark):
    df = spark.createDataFrame([("r",), ("z",), (None,)], "o string")
    got = add_groups(df, {"g": ("o", {"r": "warm"}), "t": ("", {})}).collect()
    assert [(r.g, r.t) for r in got] == [("warm", "any"), ("any", "any"), ("any", "any")]

import random

import pytest

from fleetloom.functions.text import clean, overlap_bounds, ratio
from fleetloom.operators import similar as S


def config(rng):
    return "_".join(["", rng.choice(["M1 LARGE", "M2 SMALL"]), "EXP-" + rng.choice(["RED", "BLUE", "TEAL"]),
                     "INT-" + rng.choice("0123"), "WHL-" + rng.choice("01234"), "TON-" + rng.choice(["NULL", "P02"])])


def serial(demand, supply):
    """The literal loop over demands in order."""
    free, out = list(supply), {}
    for d in sorted(demand, key=lambda r: (r[1], r[0])):
        here = [v for v in free if v[2] == d[2]]
        best = max(here, key=lambda v: ratio(clean(d[3]), clean(v[3])), default=None)
        out[d[0]] = best and best[0]
        if best:
            free.remove(best)
    return out


@pytest.mark.parametrize("seed,group_rows,n_d,n_v,hot", [
    (1, 20_000, 60, 90, False), (2, 40, 60, 90, False), (3, 24, 70, 40, True), (4, 60, 40, 300, False),
])
def test_similar_match_equals_the_loop(spark, seed, group_rows, n_d, n_v, hot, request):
    if hot:
        request.getfixturevalue("hot_groups")
    rng = random.Random(seed)
    common = config(rng)  # a third of all rows share one text
    demand = [(f"d{i:03d}", rng.randrange(500), rng.choice(["2025", "2026", "2026"]),
               common if i % 3 == 0 else config(rng)) for i in range(n_d)]
    supply = [(f"v{i:03d}", i, "2026" if i % 4 else "2025", common if i % 3 == 0 else config(rng)) for i in range(n_v)]
    schema = "id string, ord int, block string, text string"
    got = S.similar_match(spark.createDataFrame(demand, schema), spark.createDataFrame(supply, schema), group_rows=group_rows).collect()
    assert {r.id: r.similar_id for r in got} == serial(demand, supply)


@pytest.mark.parametrize("scorer", ["levenshtein", "ratio"])
def test_nearest_config(spark, scorer, monkeypatch):
    monkeypatch.setattr(S, "LEFT_CHUNK", 3)
    monkeypatch.setattr(S, "RIGHT_CHUNK", 4)
    monkeypatch.setattr(S, "HOT_CHUNKS", 2)  # salted path

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        longest = max(len(a), len(b))
        return int(100 * (longest - row[-1]) / longest + 0.5)

    score = {"levenshtein": lev, "ratio": lambda a, b: ratio(clean(a), clean(b))}[scorer]
    rng = random.Random(9)
    units = [(f"u{i}", "B" if i % 5 else "C", config(rng)) for i in range(30)] + [("none", "Z", config(rng)), ("null", None, "x")]
    catalog = [("B" if i % 4 else "C", config(rng)) for i in range(40)]
    got = S.nearest_config(
        spark.createDataFrame(units, "id string, blk string, config_string string"),
        spark.createDataFrame(catalog, "blk string, config_string string"), ["blk"], scorer,
    ).collect()
    assert len(got) == len(units)
    for r in got:
        choices = sorted({c for b, c in catalog if b == r.blk})
        best = max(choices, key=lambda c: score(r.config_string, c), default=None)
        assert r.best_match_config_string == (best or S.NO_CANDIDATE)
        assert r.best_match_score == (score(r.config_string, best) if best else 0)


def test_nearest_by_edits_equals_all_pairs(spark):
    """Keys of different lengths and numbers of options, near ties, and blocks without a close key."""
    from fleetloom.functions.text import levenshtein_score
    from pyspark.sql import functions as F

    rng = random.Random(4)

    def key():
        parts = [rng.choice(("US", "CA", "")), rng.choice(("A", "AB", "ABC", "B")), rng.choice(("x", "xy", "yx", "É漢")), rng.choice("0123")]
        return "_".join(parts[:rng.randrange(1, 5)]) * rng.choice((1, 1, 1, 4))

    left = spark.createDataFrame(sorted({(str(i % 3), key()) for i in range(150)}), "block string, text string")
    right = spark.createDataFrame(sorted({(str(i % 2), key()) for i in range(80)} | {("2", "Z" * 40)}), "block string, text string")
    got = {(r.block, r.text): (r.best.other, -r.best.loss) for r in S._nearest_by_edits(left, right).collect()}
    pairs = left.join(right.withColumnRenamed("text", "other"), "block").select("block", "text", "other", levenshtein_score(F.col("text"), F.col("other")).alias("score"))
    expected = {}
    for r in pairs.collect():
        now = expected.get((r.block, r.text))
        if now is None or r.score > now[1] or r.score == now[1] and r.other.encode() < now[0].encode():
            expected[r.block, r.text] = (r.other, r.score)
    assert got == expected
    assert len(got) > 80


def test_scorers():
    assert clean("A-b_C ") == "a b_c"
    assert ratio("abcd", "bcde") == 75 and ratio("", "a") == 0
    rng = random.Random(3)
    texts = [config(rng) for _ in range(50)]
    for t, bounds in zip(texts[:10], overlap_bounds(texts[:10], texts)):
        assert all(b >= ratio(t, o) for b, o in zip(bounds, texts))

import random

import pytest
from pyspark.sql import functions as F

from fleetloom.operators.ordered import first_per_key, number_rows
from fleetloom.session import materialize, scratch_dir


def expected(rows):
    out = {}
    for key in {r[0] for r in rows}:
        total = 0
        for i, r in enumerate(sorted((r for r in rows if r[0] == key), key=lambda r: r[1]), 1):
            total += r[2]
            out[r[1]] = (i, total)
    return out


@pytest.fixture
def rows():
    rng = random.Random(1)
    # A third of all rows share one key.
    return [("hot" if i % 3 == 0 else f"k{rng.randrange(6)}" if i % 7 else None, i, rng.randrange(9)) for i in range(400)]


@pytest.mark.parametrize("hot", [False, True])
def test_number_rows(spark, rows, hot, request):
    if hot:
        request.getfixturevalue("hot_groups")
    df = spark.createDataFrame(rows, "k string, o int, v int").repartition(4)
    got = {r.o: (r.rn, r.total) for r in number_rows(df, ["k"], ["o"], "rn", {"total": "v"}).collect()}
    assert got == expected(rows)


def test_number_rows_descending_hot(spark, rows, hot_groups):
    df = spark.createDataFrame(rows, "k string, o int, v int").filter("k = 'hot'")
    got = [r.o for r in number_rows(df, ["k"], [F.desc("o")], "rn").orderBy("rn").collect()]
    assert got == sorted(got, reverse=True)


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", None, "z"), ("b", 0, "w")], "k string, o int, v string")
    assert {(r.k, r.v) for r in first_per_key(df, ["k"], ["o", "v"]).collect()} == {("a", "y"), ("b", "z")}


def test_materialize_uses_the_named_folder(spark):
    df = materialize(spark.range(3))
    assert df.inputFiles()[0].startswith("file://" + scratch_dir(spark))
    assert df.count() == 3

import pytest
from pyspark.sql import types as T

from fleetloom.operators import cohorts as H
from fleetloom.operators import compliance as C
from fleetloom.operators import joins as J
from fleetloom.sources import domain
from fleetloom.sources.tables import inline_table, load_file, load_table, run_sql, save


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("01", 1), ("2", None)], "id string, n int")
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        save(df, path, fmt)
        schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType())])
        assert sorted(map(tuple, load_file(spark, path, fmt, schema).collect())) == [("01", 1), ("2", None)]
    with pytest.raises(ValueError):
        load_file(spark, "x", "xlsx")
    with pytest.raises(ValueError):
        load_file(spark, "x", "csv")


def test_parameterised_query(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c'", 3)], "k string, n int")
    got = run_sql(spark, "select n from {t} where array_contains(:keys, k) and n >= :low", {"keys": ["b", "c'"], "low": 2}, {"t": df})
    assert sorted(r.n for r in got.collect()) == [2, 3]


def test_inline_table(spark):
    df = inline_table(spark, [("it's", 1.5, None), ("b\\", float("inf"), 2)], "a string, b double, c int")
    assert [tuple(r) for r in df.collect()] == [("it's", 1.5, None), ("b\\", float("inf"), 2)]


def test_key_checks(spark):
    one = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    two = spark.createDataFrame([(1, "p"), (1, "q")], "k int, w string")
    with pytest.raises(ValueError):
        J.one_to_one(one, two, ["k"])
    with pytest.raises(ValueError):
        J.enrich(one, two, {"k": "k"}, check_unique=True)
    assert J.one_to_one(one, one.withColumnRenamed("v", "w"), ["k"]).count() == 2


def test_null_safe_enrich_and_lists(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, n int")
    dim = spark.createDataFrame([(None, "null"), ("a", "A")], "k string, label string")
    assert [r.label for r in J.enrich(df, dim, {"k": "k"}).orderBy("n").collect()] == [None, "A"]
    assert [r.label for r in J.enrich(df, dim, {"k": "k"}, null_safe=True).orderBy("n").collect()] == ["null", "A"]
    listed = spark.createDataFrame([("a",)], "c string")
    assert [r.n for r in J.drop_listed(df, listed, {"k": "c"}).collect()] == [1]
    assert [r.n for r in J.keep_listed(df, listed, {"k": "c"}).collect()] == [2]


def test_small_keeps_large_dimensions_unhinted(spark):
    big = J.small(spark.range(50), limit=10)
    assert "hint" not in big._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" in J.small(spark.range(5), limit=10)._jdf.queryExecution().logical().toString().lower()


def test_kpis_of_empty_cohorts_are_zero(spark):
    df = spark.createDataFrame(
        [("4. Firm", "Custom", "East", C.L.COMPLIANT)] * 2 + [("4. Firm", "Custom", None, None)],
        "production_zone string, custom_v_inventory_flag string, location_region string, inventory_policy_compliance string")
    got = {r.cohort: (r.compliant_qty, r.total_qty, r.percent_text) for r in C.cohort_kpis(df).collect()}
    assert got["firm"] == (2, 3, "66%") and got["east"] == (2, 2, "100%")
    assert got["liquid"] == (0, 0, "0%") and len(got) == 12


def test_distinct_pivot_counts_a_repeated_vehicle_once(spark):
    df = spark.createDataFrame([("c", "v1", "A"), ("c", "v1", "A"), ("c", "v1", "B"), ("c", "v2", "Z"), ("c", None, "A")],
                               "config string, vehicle_id string, production_zone string")
    r = C.distinct_pivot(df, ["config"], {"a": ["A"], "b": ["B"]}).first()
    assert (r.a, r.b, r.others, r.supply) == (1, 1, 1, 2)


def test_cohorts_need_their_tables(spark):
    run = spark.createDataFrame([("1", "GEN-2")], "oms_order_id string, items_vehicle_generation_id string")
    with pytest.raises(ValueError):
        H.select_cohort(run, "delayed_at_risk_customers_normal", H.CohortInputs())
    with pytest.raises(ValueError):
        H.select_cohort(run, "nonsense", H.CohortInputs())
    ids = spark.createDataFrame([(1,), (9,)], "oms_order_id long")
    assert H.select_cohort(run, "delayed_at_risk_customers_normal", H.CohortInputs(delayed=ids)).count() == 1


@pytest.mark.parametrize("view", [domain.order_lines, domain.matching_run])
def test_orders_are_joined_before_the_wide_parts(spark, tmp_path, view):
    """The options of a part come last, so no shuffle of the lines by order carries them."""
    spark.sql("select 1L l_orderkey, 1 l_linenumber, 1L l_partkey, 1L l_suppkey, date'1999-05-05' l_shipdate, 'F' l_linestatus, 'N' l_returnflag, 3.0 l_quantity"
              ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("select 1L p_partkey, 'blue x' p_name, 'Brand#12' p_brand, 'LARGE' p_type, 3 p_size").write.parquet(f"{tmp_path}/part.parquet")
    spark.sql("select 1L o_orderkey, 1L o_custkey, date'1999-05-01' o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    rows = view(spark, str(tmp_path))
    joins = [x for x in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in x]
    assert "p_partkey" in joins[0] and "o_orderkey" in joins[1]
    assert rows.count() == 1

"""Properties: fold balance, save/load equality, idempotence, blend weights, AUC vs MLlib,
stream vs batch, input order independence, and plan shape (no single-task windows, no Python UDFs)."""

import pytest
from pyspark.sql import functions as F

from conftest import MID, SMALL
from lathe.operators import blend as BL, metrics as M, ranks as R, profile as P
from lathe.operators.stats import Winsorizer, WinsorizerModel
from lathe.registry.base import table
from lathe.session import scratch_path


def test_stratified_fold_sizes_differ_by_at_most_one(spark):
    c = table(spark, MID, "customer")
    f = R.kfold(c, "c_custkey", 5, 7, strata="c_mktsegment")
    sizes = f.groupBy("c_mktsegment", "fold").count().groupBy("c_mktsegment").agg(
        (F.max("count") - F.min("count")).alias("d"), F.count(F.lit(1)).alias("k")).collect()
    assert all(r["d"] <= 1 and r["k"] == 5 for r in sizes)
    assert f.count() == c.count()


def test_hash_rank_is_a_permutation(spark):
    o = table(spark, MID, "orders").select("o_orderkey")
    r = R.hash_rank(o, "o_orderkey", 3)
    row = r.agg(F.min("hash_rank"), F.max("hash_rank"), F.count_distinct("hash_rank"), F.count(F.lit(1))).first()
    assert tuple(row) == (1, 15000, 15000, 15000)


def test_saved_and_reloaded_state_transforms_the_same(spark):
    li = table(spark, SMALL, "lineitem").select("l_extendedprice", "l_quantity")
    m = Winsorizer(["l_extendedprice", "l_quantity"], 0.01, 0.99).fit(li)
    m2 = WinsorizerModel.load(spark, m.save(spark, scratch_path(spark, "t-state")))
    a = m.transform(li).exceptAll(m2.transform(li)).count()
    assert a == 0 and m.state.stats == m2.state.stats


def test_transform_is_idempotent(spark):
    li = table(spark, SMALL, "lineitem").select("l_extendedprice")
    m = Winsorizer(["l_extendedprice"], 0.05, 0.95).fit(li)
    once = m.transform(li)
    assert once.exceptAll(m.transform(once)).count() == 0


def test_blend_weights_sum_to_one_and_grid_size(spark):
    assert len(BL.simplex_grid(3, 0.05)) == 231
    assert all(abs(sum(w) - 1) < 1e-9 for w in BL.simplex_grid(3, 0.05))
    df = spark.range(0, 200).select(F.col("id"), (F.col("id") % 2).alias("y"),
                                    ((F.col("id") % 7) / 7.0).alias("a"), ((F.col("id") % 2) * 0.5 + (F.col("id") % 5) / 10.0).alias("b"))
    w = BL.blend_weights_rmse(df, ["a", "b"], "y")
    assert abs(sum(w) - 1) < 1e-9


def test_rank_auc_equals_mllib_exact_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    o = table(spark, MID, "orders")
    df = o.select((F.col("o_orderstatus") == "F").cast("double").alias("y"),
                  F.round(F.col("o_totalprice") / 1e5, 1).alias("s"))   # heavy ties
    ours = M.roc_auc(df, "s", "y").first()["auc"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0)
    assert ours == pytest.approx(ev.evaluate(df), abs=1e-12)


def test_input_order_does_not_matter(spark):
    li = table(spark, SMALL, "lineitem").select("l_extendedprice", "l_quantity")
    a = P.describe_numeric(li).collect()
    b = P.describe_numeric(li.repartition(7, "l_quantity").sortWithinPartitions(F.rand(3))).collect()
    def rnd(rows):
        return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)
    assert rnd(a) == rnd(b)


def test_stream_output_equals_batch(spark):
    import __spark_entry__ as E
    q = E.queries()
    s = q["st1_stream_scoring_events"](spark, SMALL)
    b = q["st1_batch_scoring_events"](spark, SMALL)
    assert s.count() == b.count() and s.exceptAll(b).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _windows(node):
    """(partition spec is empty, order spec) of every logical window below a plan node."""
    found = []
    if node.nodeName() == "Window":
        found.append((node.partitionSpec().isEmpty(), node.orderSpec().mkString(",")))
    kids = node.children()
    for i in range(kids.size()):
        found += _windows(kids.apply(i))
    return found


def _assert_no_single_task_window(df):
    """Every window has a partition key, except over tables of counts per range bucket or per md5 prefix (at most 65,536 rows)."""
    windows = _windows(df._jdf.queryExecution().optimizedPlan())
    bad = [order for empty, order in windows if empty and not order.startswith(("bucket#", "__bucket#", "_hb#"))]
    assert not bad, bad


def test_the_window_check_can_fail(spark):
    from pyspark.sql import Window
    df = spark.range(10).withColumn("r", F.row_number().over(Window.orderBy("id")))
    with pytest.raises(AssertionError):
        _assert_no_single_task_window(df)


@pytest.mark.parametrize("name", ["w2_avg_rank", "w4_stratified_kfold", "w5_sample_n", "a9_spearman_matrix",
                                  "a33_roc_auc", "w1_f32_f33_vertex_angles", "x11_route_curviness", "m13_blend_weights_auc"])
def test_no_unpartitioned_window_and_no_python_udf(spark, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SMALL)
    plan = _plan(df)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan
    _assert_no_single_task_window(df)


def test_filters_and_columns_reach_the_scan(spark):
    from lathe.sources.files import read_table
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    li = read_table(spark, SMALL, "lineitem", where=F.col("l_quantity") > 10)
    df = li.where(F.col("l_returnflag") == "R").select("l_orderkey", "l_quantity")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,10.0)" in plan and "EqualTo(l_returnflag,R)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in plan


def test_folds_do_not_depend_on_input_order(spark):
    o = table(spark, MID, "orders").select("o_orderkey", "o_orderstatus")
    a = R.kfold(o, "o_orderkey", 5, 11, strata="o_orderstatus")
    b = R.kfold(o.repartition(7, "o_orderstatus").sortWithinPartitions(F.rand(5)), "o_orderkey", 5, 11, strata="o_orderstatus")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_missing_values_stay_missing(spark):
    from lathe.functions import scalars as S
    df = spark.createDataFrame([(None, 0.5, True, None), (4.0, None, False, "rain")], "x double, i double, b boolean, s string")
    r = df.select(S.guarded_log1p("x").alias("f2"), S.sqrt_clipped("x").alias("f5"), S.square_clipped("x").alias("f5b"), S.expm1_clipped("x").alias("f6"),
                  S.to_model_space("x", "sqrt").alias("f7"), S.to_model_space("x", "log1p").alias("f7b"), S.hinge_above("x", 1.0).alias("f17"),
                  S.hinge_below("x", 1.0).alias("f17b"), S.floored_ratio("x", "i", 0.01, 0.0, 100.0).alias("f14"), S.string_interaction("s", "b").alias("f23")).collect()
    assert r[0].f2 == 0.0 and all(r[0][c] is None for c in ("f5", "f5b", "f6", "f7", "f7b", "f17", "f17b", "f14"))
    assert r[1].f14 is None and r[1].f17 == 3.0 and r[1].f17b == 0.0
    assert [x.f23 for x in r] == ["nan_True", "rain_False"]


def test_squared_error_weights_stay_in_the_simplex(spark):
    from lathe.operators.blend import blend_weights_rmse
    df = spark.createDataFrame([(1.0, 2.0, 0.0), (2.0, 3.0, 1.0), (3.0, 4.1, 2.0)], "a double, b double, y double")
    w = blend_weights_rmse(df, ["a", "b"], "y")
    assert w == [1.0, 0.0]

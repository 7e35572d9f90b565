"""Plans that must hold at scale: hot keys, grouped distributions, ranks of rows, Spearman with missing values, blend bounds."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from lathe.operators import blend as BL, clean, encode as E, joins as J, metrics as M, profile as P, ranks as R, relate as REL
from lathe.registry.base import table
from lathe.session import clear_scratch, scratch_folder, written


def _nodes(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot(spark):
    """Half the rows under one key, ties, missing keys and values, and names that the operators use themselves."""
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"k": ["hot"] * 600 + [f"k{i % 40}" for i in range(560)] + [None] * 40, "x": np.round(rng.normal(size=1200), 1),
                        "y": rng.integers(0, 2, 1200), "fold": np.arange(1200) % 4, "_n": 1, "n": 2, "value": 3, "bucket": 4})
    pdf.loc[::17, "x"] = np.nan
    return spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x"))), pdf


def test_a_hot_key_is_dealt_over_tasks_by_its_count(spark):
    rows = spark.range(10_000).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("key"))
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = R.join_by_counts(rows, counts, ["key"], "n", F.col("id"), hot_rows=100)
        assert out.count() == 10_000 and out.where("top < id").count() == 0
        most = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert most < 10_000 / 4  # 5,000 rows of one key would be in one of 8 tasks
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("limit", [1_000_000, 50])
def test_joins_back_with_half_the_rows_under_one_key(hot, monkeypatch, limit):
    monkeypatch.setattr(R, "HOT_ROWS", limit)
    df, pdf = hot
    kept = J.keep_frequent(df, "k", 15).toPandas()
    often = pdf["k"].value_counts()
    assert len(kept) == pdf["k"].isin(often[often >= 15].index).sum() and list(kept.columns) == list(df.columns)
    got = REL.collapse_rare(df, "k", 15).groupBy("k").count().toPandas().set_index("k")["count"].to_dict()
    want = pdf["k"].where(pdf["k"].isin(often[often >= 15].index), "__OTHER__").value_counts().to_dict()
    assert got == want
    rate = {r["k"]: (r["n"], r["rate"]) for r in REL.target_rate_by_category(df, "k", "y", 15, 50).collect()}
    d = pdf.assign(k=pdf["k"].where(pdf["k"].isin(often[often >= 15].index), "__OTHER__")).groupby("k")["y"].agg(["size", "mean"])
    assert rate == {k: (r["size"], pytest.approx(r["mean"])) for k, r in d.iterrows()}
    te = E.target_mean_encode(df, "k", "y", "fold").toPandas()
    assert list(te.columns) == [*df.columns, "k_te"] and len(te) == 1200
    for _, r in te.sample(60, random_state=1).iterrows():
        other = pdf[pdf["fold"] != r["fold"]]
        same = other[other["k"] == r["k"]] if r["k"] is not None and not pd.isna(r["k"]) else other.iloc[:0]
        assert r["k_te"] == pytest.approx((same if len(same) else other)["y"].mean())


@pytest.mark.parametrize("by", [None, "k"])
@pytest.mark.parametrize("rows", [1_000_000, 9])
def test_row_ranks_equal_pandas(hot, monkeypatch, by, rows):
    monkeypatch.setattr(R, "TARGET_BUCKET_ROWS", rows)
    monkeypatch.setattr(R, "HOT_ROWS", max(rows, 50))
    df, pdf = hot
    got = R.avg_rank_column(df.withColumn("i", F.monotonically_increasing_id()), "x", "r", by=by).toPandas()
    assert len(got) == 1200
    g = got.groupby(by)["x"] if by else got["x"]
    want = g.rank(method="average")
    assert np.allclose(got["r"].astype(float), want, equal_nan=True)


def test_row_ranks_of_other_types(spark):
    big = 1 << 53
    df = spark.createDataFrame([(v,) for v in [big, big + 1, big + 1, big + 2, 5, None, big]], "v long")
    got = sorted((r.v, r.v_rank) for r in R.avg_rank_column(df, "v").collect() if r.v is not None)
    assert got == [(5, 1.0), (big, 2.5), (big, 2.5), (big + 1, 4.5), (big + 1, 4.5), (big + 2, 6.0)]
    days = spark.sql("select date'2020-01-01' + cast(id % 3 as int) as d from range(6)")
    assert sorted(r.d_rank for r in R.avg_rank_column(days, "d").collect()) == [1.5, 1.5, 3.5, 3.5, 5.5, 5.5]
    assert R.avg_rank_column(df.where("v < 0"), "v").count() == 0


def test_ranks_need_no_join_on_the_value(spark):
    df = table(spark, SMALL, "lineitem").select("l_orderkey", "l_quantity")
    plan = _nodes(R.avg_rank_column(df, "l_quantity"))
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


@pytest.mark.parametrize("rows", [1_000_000, 11])
def test_grouped_distributions_equal_pandas(hot, monkeypatch, rows):
    monkeypatch.setattr(R, "TARGET_BUCKET_ROWS", rows)
    df, pdf = hot
    d = pdf.dropna(subset=["k", "x"])
    q = {(r["k"], r["q_index"]): r["value"] for r in R.quantiles(df, ["x"], [0.0, 0.3, 0.5, 1.0], by="k").collect()}
    want = d.groupby("k")["x"].quantile([0.0, 0.3, 0.5, 1.0])
    assert len(q) == len(want) and all(q[k, [0.0, 0.3, 0.5, 1.0].index(p)] == pytest.approx(v) for (k, p), v in want.items())
    v = REL.violin_stats(df, "k", "x", 7)
    assert "percentile" not in _nodes(v["box"])
    for r in v["box"].collect():
        x = d[d["k"] == r["k"]]["x"]
        q1, q3 = x.quantile(0.25), x.quantile(0.75)
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        assert (r["whisker_lo"], r["whisker_hi"], r["outliers"], r["n"]) == (inside.min(), inside.max(), len(x) - len(inside), len(x))
    dens = v["density"].groupBy("k").agg(F.sum("n").alias("n"), F.sum(F.col("density") * (F.col("hi") - F.col("lo"))).alias("area")).collect()
    assert {r["k"]: r["n"] for r in dens} == d.groupby("k").size().to_dict()
    assert all(r["area"] is None or r["area"] == pytest.approx(1.0) for r in dens)


def _edges(x, q):
    """Distinct linear quantile edges at i/q."""
    x, out = np.sort(x), []
    for i in range(q + 1):
        h = (len(x) - 1) * (i / q)
        lo, hi = x[int(np.floor(h))], x[int(np.ceil(h))]
        out.append(lo + (h - np.floor(h)) * (hi - lo))
    return np.unique(out)


def test_trend_bins_equal_brute_force(hot):
    df, pdf = hot
    got = {(r["k"], r["bin"]): r for r in REL.numeric_by_category_trend(df, "x", "k", "y", q=6, min_count=14).collect()}
    often = pdf["k"].value_counts()
    keys = set()
    for k in often[often >= 14].index:
        d = pdf[(pdf["k"] == k)].dropna(subset=["x"])
        edges = _edges(d["x"].to_numpy(), min(6, d["x"].nunique()))
        codes = np.searchsorted(edges[1:-1], d["x"].to_numpy(), side="left")
        for b, part in d.groupby(codes):
            keys.add((k, b))
            assert got[k, b]["n"] == len(part) and got[k, b]["mean_target"] == pytest.approx(part["y"].mean())
            assert got[k, b]["center"] == pytest.approx((edges[b] + edges[b + 1]) / 2)
    assert set(got) == keys and len({k for k, _ in keys}) > 30


def test_spearman_with_missing_values_equals_pandas(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame(np.round(rng.normal(size=(400, 6)), 1), columns=list("abcdef"))
    pdf["b"] += pdf["a"]
    for c, step in (("c", 5), ("d", 5), ("e", 3)):  # c and d miss the same rows
        pdf.loc[::step, c] = np.nan
    pdf["f"] = 2.0
    df = spark.createDataFrame(pdf).select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in pdf.columns])
    assert set(P._missing_patterns(df, list("abcdef")).items()) == {("c", "c"), ("d", "c"), ("e", "e")}
    want = pdf.corr(method="spearman")
    got = {(r["a"], r["b"]): r["rho"] for r in P.spearman_matrix(df).collect()}
    assert got.keys() == set(itertools.combinations("abcdef", 2))
    for (a, b), v in got.items():
        assert (v is None and "f" in (a, b)) or v == pytest.approx(want.loc[a, b], abs=1e-9)
    target = {r["feature"]: r["rho"] for r in P.spearman_with_target(df, ["a", "c", "e"], "b").collect()}
    assert target == {c: pytest.approx(want.loc[c, "b"], abs=1e-9) for c in "ace"}


def _scores(spark, n=600):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, n)
    pdf = pd.DataFrame({"y": y, "a": 0.4 * y + 0.6 * rng.random(n), "b": 0.3 * y + 0.7 * rng.random(n), "c": rng.random(n)})
    return spark.createDataFrame(pdf).withColumn("a", F.when(F.rand(1) > 0.02, F.col("a")))


@pytest.mark.parametrize("bins", [(1024, 16384), (3,), (1,), (8, 16)])
def test_bounded_blend_finds_the_winner_of_all_weights(spark, monkeypatch, bins):
    monkeypatch.setattr(BL, "BOUND_BINS", bins)
    df = written(_scores(spark), "scores")
    best = BL.blend_auc_grid(df, ["a", "b", "c"], "y", 0.1).orderBy(F.desc("auc"), "weight_id").first()
    left = BL.undecided_weights(df, ["a", "b", "c"], "y", 0.1)
    assert best["weight_id"] in left and (len(left) < 66 or bins == (1,))
    got = BL.blend_weights(df, ["a", "b", "c"], "y", 0.1).first()
    assert (got["weight_id"], got["auc"]) == (best["weight_id"], best["auc"])
    known = df.dropna()
    score = sum(F.lit(best[f"w_{p}"]) * F.col(p) for p in "abc")
    assert M.roc_auc(known.withColumn("s", score), "s", "y").first()["auc"] == pytest.approx(best["auc"], abs=1e-12)


def test_blend_bounds_do_not_depend_on_the_passes(spark, monkeypatch):
    """A pass over the rows counts under a few weights only (its groups stay few); scores are placed as by a search in the knots."""
    rows = BL._labelled(_scores(spark), ["a", "b", "c"], "y")
    n, points = rows.count(), dict(enumerate(BL.simplex_grid(3, 0.25)))
    knots = BL._knots(rows, 3, 0.0, 1.0)
    once = BL._auc_bounds(rows, n, points, 64, knots)
    scored, seen = BL._scored, []
    monkeypatch.setattr(BL, "PASS_SCORES", 0)
    monkeypatch.setattr(BL, "PASS_GROUPS", 256)
    monkeypatch.setattr(BL, "_scored", lambda rows, some: seen.append(len(some)) or scored(rows, some))
    assert BL._auc_bounds(rows, n, points, 64, knots) == once and set(once) == set(points)
    assert seen == [2] * 7 + [1]
    for ends in (knots, [0.0, 1.0], [0.0, 0.3, 0.7, 1.0]):
        got = BL._placed(scored(rows, points), ends).select("_s", "_at").toPandas()
        at = np.clip(np.searchsorted(ends, got["_s"], side="right") - 1, 0, len(ends) - 2)
        low, high = np.asarray(ends)[at], np.asarray(ends)[at + 1]
        assert np.allclose(got["_at"], at + np.clip((got["_s"] - low) / (high - low), 0, 1), atol=1e-12)
    assert BL.undecided_weights(_scores(spark).withColumn("c", F.lit(float("inf"))), ["a", "b", "c"], "y", 0.25) == sorted(points)


def test_blend_of_one_class_or_equal_scores(spark):
    df = spark.createDataFrame([(1, 0.5, 0.5), (0, 0.5, 0.5), (1, 0.5, 0.5)], "y int, a double, b double")
    assert BL.blend_weights(df, ["a", "b"], "y", 0.5).first()["auc"] == 0.5
    assert BL.blend_weights(df.where("y = 1"), ["a", "b"], "y", 0.5).first()["auc"] is None


def test_clear_scratch_removes_the_written_tables(spark):
    df = written(spark.range(3), "to-clear")
    assert df.count() == 3
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert fs.exists(path) and clear_scratch(spark) and not fs.exists(path) and not clear_scratch(spark)


@pytest.mark.parametrize("limit", [1_000_000, 1000])
def test_codes_of_200_000_categories(spark, monkeypatch, limit):
    monkeypatch.setattr(R, "HOT_ROWS", limit)
    df = spark.range(200_000).select(F.format_string("c%07d", F.col("id") * 7 % 200_000).alias("c"), F.lit(1).alias("n")) \
        .union(spark.range(5_000).select(F.lit("c0000003").alias("c"), F.lit(1).alias("n"))).union(spark.sql("select cast(null as string), 1"))
    model = E.fit_category_table(df, "c")
    assert model.size == 200_000
    out = model.transform(df)
    assert out.count() == 205_001 and out.where("c_code <> cast(substr(c, 2) as long)").count() == 0
    assert out.where("c is null and c_code is null").count() == 1
    new = spark.createDataFrame([("c0000005",), ("zz",), (None,)], "c string")
    assert [r.category for r in model.unseen(new).collect()] == ["zz"]
    with pytest.raises(Exception, match="unseen label"):
        model.transform(new).collect()
    model.handle_invalid = "keep"
    assert sorted(str(r.c_code) for r in model.transform(new).collect()) == ["200000", "5", "None"]
    assert dict(E.cast_category(new, {"c": model}).dtypes)["c"] == "int"
    assert E.fit_category_table(df.where("n > 1"), "c").size == 0


def test_distinct_counts_up_to_a_bound(spark):
    from lathe.operators import columns as C
    df = spark.range(30_000).select((F.col("id") % 20).alias("few"), F.col("id").alias("many"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("v"), F.col("id") % 21)).alias("s"),
                                    F.when(F.col("id") % 2 == 0, "").alias("empty"), (F.col("id") % 2 == 0).alias("b"), (F.col("id") % 3000 / 7).alias("d"),
                                    F.lit(None).cast("int").alias("none"))
    want = {"few": 20, "many": 30_000, "s": 14, "empty": 1, "b": 2, "d": 3000, "none": 0}
    assert C.distinct_counts(df, df.columns) == want
    assert C.distinct_up_to(df, df.columns, 20) == {c: n if n <= 20 else None for c, n in want.items()}
    assert C.distinct_up_to(df, ["many", "d"], 3000) == {"many": None, "d": 3000}
    assert "Expand" not in _nodes(df.agg(F.theta_sketch_agg("few", 12)))
    assert C.is_regression(df, "many") and not C.is_regression(df, "few") and C.is_discrete_numeric(df, "few")


def test_rank_tasks_stay_small_as_the_table_grows(spark, monkeypatch):
    """The window of the row ranks and the join of a row's ranks deal rows into tasks of bounded size."""
    from lathe.operators import profile, ranks
    monkeypatch.setattr(ranks, "TASK_ROWS", 1000)
    monkeypatch.setattr(ranks, "TARGET_BUCKET_ROWS", 1000)
    df = spark.range(40_000).select(F.col("id"), F.hash("id").cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"),
                                    F.when(F.col("id") % 3 == 0, F.hash("id", "id").cast("double")).alias("z"))
    for col in ("x", "z"):
        out = ranks.avg_rank_column(df, col)
        per_task = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert per_task < 20_000 and out.select(F.spark_partition_id().alias("p")).distinct().count() >= 10, (col, per_task)
        want = df.where(F.col(col).isNotNull()).toPandas().set_index("id")[col].rank()
        got = out.where(F.col(col).isNotNull()).toPandas().set_index("id")[f"{col}_rank"]
        assert (got.sort_index() == want.sort_index()).all()
    parts = []
    monkeypatch.setattr(profile, "dealt", lambda d, rows, *by: parts.append((rows, by)) or ranks.dealt(d, rows, *by))
    rho = {(r.a, r.b): r.rho for r in profile.spearman_matrix(df, ["x", "y", "z"]).collect()}
    assert len(parts) == 1 and parts[0][0] >= 40_000 * 3 and parts[0][1] == ("_row",)
    want = df.toPandas()[["x", "y", "z"]].corr("spearman")
    assert all(abs(rho[k] - want.loc[k]) < 1e-9 for k in rho)


def test_road_table_runs_once(spark):
    """The rows that the bin edges and the projection need come from one written table: no join, no distinct is left."""
    from lathe.plans import road as RD
    r = spark.range(500).select((F.col("id") % 3).cast("string").alias("road_type"), (F.col("id") % 2).cast("string").alias("lighting"), F.lit("w").alias("weather"),
                                F.lit("t").alias("time_of_day"), (F.col("id") % 10 / 10.0).alias("curvature"), (F.col("id") % 50).cast("int").alias("speed_limit"),
                                (F.col("id") % 2 == 0).alias("holiday"))
    twice = r.unionByName(r)
    out = RD.RoadFeaturesModel().transform(twice, drop_duplicates=True)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan and "parquet" in plan
    assert out.count() == r.distinct().count() and {x[0] for x in out.select("curvature_bin").distinct().collect()} == {"low", "medium", "high"}
    kept = RD.RoadFeaturesModel(RD.fit_quantile_binner(r, "curvature")).transform(r)
    assert "parquet" not in kept._jdf.queryExecution().optimizedPlan().toString()  # fitted edges: a projection, usable on streams


def test_blend_bounds_settle_scores_that_crowd(spark):
    """A few far scores and no signal: bins follow the scores, few weights are left to rank exactly."""
    from lathe.operators import blend as BL
    df = spark.range(20_000, numPartitions=4).select((F.rand(1) < 0.33).cast("int").alias("y"), *[(F.lit(0.33) + sd * F.randn(k)).alias(p)
                                                     for k, (p, sd) in enumerate((("a", 0.03), ("b", 0.001), ("c", 0.0003)), 2)])
    df = df.withColumn("a", F.when(F.rand(9) < 0.0005, F.lit(0.95)).otherwise(F.col("a"))).checkpoint()
    left = BL.undecided_weights(df, ["a", "b", "c"], "y", 0.25)
    assert len(left) <= 4
    best = BL.blend_auc_grid(df, ["a", "b", "c"], "y", 0.25).orderBy(F.desc("auc"), "weight_id").first()
    assert best["weight_id"] in left and BL.blend_weights(df, ["a", "b", "c"], "y", 0.25).first()["auc"] == pytest.approx(best["auc"], abs=1e-15)


def test_wide_rows_round_like_round_outside_the_one_large_method(spark):
    """Ties, numbers next to ties, large, tiny and missing numbers round as ``r6`` does; few numbers take the slow path."""
    from lathe.registry.base import r6
    from lathe.registry.composites import _round_doubles
    ties = [k / 2e6 for k in range(-41, 42)] + [1.0000005, 2.0000015, 123456.7890125, 0.1234565, 99999.9999995]
    odd = [0.0, -0.0, 1e-7, -1e-7, 5e-324, 1e5, 100000.00000049, 123456789.123456789, -98765432109.87654, 1e17, 1e300, -1e300, float("inf"), float("-inf"), float("nan"), None]
    near = [float(np.nextafter(t, s)) for t in ties for s in (-np.inf, np.inf)]
    rng = np.random.default_rng(5)
    values = ties + odd + near + [float(v) for v in np.concatenate([rng.normal(0, s, 2000) for s in (1e-5, 1, 1e4, 1e6)])]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "x double, i int").withColumn("f", F.col("x").cast("float"))
    out = _round_doubles(df)
    assert [(n, t) for n, t in out.dtypes] == [("x", "double"), ("i", "int"), ("f", "double")]
    want = df.select(r6("x").alias("x"), "i", r6("f").alias("f"))
    key = lambda r: (repr(r["x"]), r["i"], repr(r["f"]))
    assert list(map(key, out.orderBy("i").collect())) == list(map(key, want.orderBy("i").collect()))
    wide = spark.range(10).select(*[(F.col("id") / (k + 3)).alias(f"x{k}") for k in range(30)])
    assert _round_doubles(wide)._jdf.queryExecution().executedPlan().nodeName() == "Project"  # not in one generated method


def test_the_learners_sample_does_not_copy_the_table(spark, monkeypatch):
    from lathe.plans import models as MD
    df = spark.range(30_000, numPartitions=3).select(F.rand(3).alias("a"), F.rand(4).alias("b")).withColumn("y", F.col("a") * 3 + F.col("b")).checkpoint()
    sizes = []

    def recorded(d, name):
        out = written(d, name)
        sizes.append(out.count())
        return out
    monkeypatch.setattr(MD, "written", recorded)
    assert MD.top_features_by_importance(df, ["a", "b"], "y", 2, rounds=1, fit_rows=500) == ["a", "b"]
    assert max(sizes) < 2000 and sizes[-1] == 500
    numbered = written(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    for n in (1, 500, 30_000, 40_000):
        want = R.sample_n(numbered, n, "_row", 42).drop("_row")
        got = MD._first_by_hash(df, n, 42)
        assert sorted(got.collect()) == sorted(want.collect()) and got.count() == min(n, 30_000)
    assert MD._first_by_hash(df.limit(0), 5, 42).count() == 0
    monkeypatch.setattr(MD.math, "sqrt", lambda _: -49.0)  # a bound below the wanted number is widened
    assert sorted(MD._first_by_hash(df, 500, 42).collect()) == sorted(R.sample_n(numbered, 500, "_row", 42).drop("_row").collect())

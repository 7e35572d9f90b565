"""Edge rows every operator family must handle (NULL/NaN, constants, ties, zero divisors,
bad dates, bin edges, text numbers, unseen categories, tiny strata, short routes, one-class AUC)."""

import json
import math

import pytest
from pyspark.sql import functions as F

from lathe.functions import geo as G, scalars as S
from lathe.operators import encode as EN, metrics as M, profile as P, ranks as R
from lathe.operators.stats import Winsorizer, clip
from lathe.plans.road import fit_quantile_binner
from lathe.sources.files import nan_to_null


def test_nan_becomes_null_and_aggregates_ignore_it(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "x double")
    clean = nan_to_null(df)
    assert clean.where(F.col("x").isNull()).count() == 2
    row = P.describe_numeric(clean, ["x"]).first()
    assert row["count"] == 2 and row["mean"] == 2.0 and row["p50"] == 2.0


def test_all_null_and_constant_columns(spark):
    df = spark.createDataFrame([(None, 5.0), (None, 5.0), (None, 5.0)], "a double, b double")
    d = {r["column"]: r for r in P.describe_numeric(df, ["a", "b"]).collect()}
    assert d["a"]["count"] == 0 and d["a"]["p50"] is None
    assert d["b"]["std"] == 0.0 and d["b"]["p25"] == 5.0
    corr = P.pearson_matrix(df.withColumn("c", F.lit(1.0) + F.monotonically_increasing_id()), ["b", "c"]).first()
    assert corr["r"] is None  # constant column: NULL, not an error


def test_single_row_and_empty_table(spark):
    one = spark.createDataFrame([(2.0,)], "x double")
    assert P.describe_numeric(one, ["x"]).first()["std"] is None
    empty = spark.createDataFrame([], "x double")
    assert P.missing_summary(empty, ["x"]).first()["missing"] == 0
    assert P.duplicate_row_count(empty).first()["duplicates"] == 0


def test_average_rank_with_heavy_ties(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 1.0, 2.0, 3.0, 3.0, 3.0, None]], "x double")
    got = sorted((r["x"], r["x_rank"]) for r in R.avg_rank_column(df, "x").collect() if r["x"] is not None)
    assert got == [(1.0, 1.5), (1.0, 1.5), (2.0, 3.0), (3.0, 5.0), (3.0, 5.0), (3.0, 5.0)]


def test_rank_plan_with_many_buckets_equals_exact(spark, monkeypatch):
    monkeypatch.setattr(R, "TARGET_BUCKET_ROWS", 7)
    df = spark.range(0, 500).select((F.col("id") % 97 * 1.5).alias("x"), (F.col("id") * 0.25).alias("y"))
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    a = {(r["column"], r["q_index"]): r["value"] for r in R.quantiles(df, ["x", "y"], probs, mode="exact").collect()}
    b = {(r["column"], r["q_index"]): r["value"] for r in R.quantiles(df, ["x", "y"], probs, mode="rank").collect()}
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_zero_divisor_and_log1p_domain(spark):
    df = spark.createDataFrame([(1.0, 0.0, -1.0), (4.0, 2.0, -2.0)], "a double, b double, c double")
    r = df.select(S.ratio("a", "b").alias("r"), S.log1p("c").alias("l"), S.guarded_log1p("c").alias("g")).collect()
    assert r[0]["r"] is None and r[1]["r"] == 2.0
    assert r[0]["l"] is None and r[1]["l"] is None
    assert r[0]["g"] == 0.0


def test_null_safe_clip(spark):
    df = spark.createDataFrame([(None,), (0.5,), (9.0,)], "x double")
    got = [r[0] for r in df.select(clip(F.col("x"), F.lit(1.0), F.lit(2.0))).collect()]
    assert got == [None, 1.0, 2.0]


@pytest.mark.parametrize("pdays,label", [(-1, "NotContacted"), (0, "NotContacted"), (1, "Recent"), (90, "Recent"),
                                         (91, "WithinHalfYear"), (365, "WithinYear"), (1000, "LongAgo"),
                                         (1001, None), (None, "NotContacted")])
def test_pdays_bins(spark, pdays, label):
    df = spark.createDataFrame([(pdays,)], "p int")
    got = df.select(S.fixed_bins(F.coalesce("p", F.lit(-1)), S.PDAYS_EDGES, S.PDAYS_LABELS)).first()[0]
    assert got == label


@pytest.mark.parametrize("month,day,doy,invalid", [("feb", 29, 60, False), ("feb", 30, 60, True), ("FEB", 31, 60, True),
                                                   ("apr", 31, 121, True), ("jan", 0, 1, True), ("xyz", 5, None, None)])
def test_calendar_edges(spark, month, day, doy, invalid):
    df = spark.createDataFrame([(month, day)], "month string, day int")
    m = S.month_number("month")
    r = df.select(S.day_of_year(S.safe_date(m, "day")).alias("d"), S.invalid_date(m, "day").alias("bad")).first()
    assert r["d"] == doy and r["bad"] == invalid


@pytest.mark.parametrize("text,value", [("1,234.5", 1234.5), ("abc", None), ("", None), ("5.36e-06", 5.36e-06), ("nan", None)])
def test_coerce_numeric(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(S.coerce_numeric("t")).first()[0] == value


def test_one_hot_unseen_and_label_encoder_error(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    oh = EN.fit_one_hot(train, "c")
    rows = oh.transform(test).collect()
    assert [(r["c_a"], r["c_b"]) for r in rows] == [(1, 0), (0, 0), (0, 0)]
    assert oh.transform(oh.transform(test)).columns == oh.transform(test).columns
    le = EN.fit_label_encoder(train, "c")
    with pytest.raises(Exception):
        le.transform(test).collect()
    keep = EN.fit_label_encoder(train, "c", handle_invalid="keep")
    assert [r["c_code"] for r in keep.transform(test).collect()] == [0, 2, 2]


def test_quantile_bins_fallbacks(spark):
    same = spark.createDataFrame([(1.0,)] * 10, "x double")
    assert fit_quantile_binner(same, "x").edges is None
    few = spark.createDataFrame([(float(i),) for i in range(5)], "x double")
    assert fit_quantile_binner(few, "x").edges is None
    dup = spark.createDataFrame([(0.0,)] * 8 + [(1.0,), (2.0,)], "x double")   # 0 and 25 % edges coincide
    b = fit_quantile_binner(dup, "x")
    assert b.edges is None
    got = {r[0] for r in dup.select(b.expr()).collect()}
    assert got == {"medium"}
    ok = spark.createDataFrame([(float(i),) for i in range(20)] + [(None,)], "x double")
    labels = [r[0] for r in ok.select(fit_quantile_binner(ok, "x").expr()).collect()]
    assert labels.count("nan") == 1 and set(labels) == {"low", "medium", "high", "nan"}


def test_qcut_code_drops_duplicate_edges(spark):
    df = spark.createDataFrame([(v,) for v in [1.0] * 6 + [2.0, 3.0, 4.0, 5.0]], "x double")
    e = R.qcut_edges(df, "x", 4).first()["edges"]
    assert e == sorted(set(e))
    codes = [r[0] for r in df.crossJoin(R.qcut_edges(df, "x", 4)).select(R.qcut_code(F.col("x"), F.col("edges"))).collect()]
    assert min(codes) == 0 and max(codes) == len(e) - 2


def test_strata_smaller_than_k_and_sample_larger_than_table(spark):
    df = spark.createDataFrame([(i, "a" if i < 3 else "b") for i in range(20)], "id long, s string")
    f = R.kfold(df, "id", 5, 42, strata="s")
    sizes = {(r["s"], r["fold"]): r["count"] for r in f.groupBy("s", "fold").count().collect()}
    assert sum(v for (s, _), v in sizes.items() if s == "a") == 3 and max(v for (s, _), v in sizes.items() if s == "a") == 1
    assert R.sample_n(df, 100, "id").count() == 20


def _route(coords):
    return json.dumps({"type": "LineString", "coordinates": coords})


def test_route_edge_cases(spark):
    routes = spark.createDataFrame([
        (1, _route([[-99.0, 40.0], [-99.0, 40.01], [-99.0, 40.02]])),               # straight line
        (2, _route([[-99.0, 40.0], [-99.0, 40.01], [-99.0, 40.0]])),                # U-turn
        (3, _route([[-99.0, 40.0], [-99.0, 40.0], [-99.0, 40.01]])),                # repeated vertex
        (4, _route([[-99.0, 40.0], [-99.0, 40.01]])),                               # two vertices
        (5, _route([[-99.0, 40.0]])),                                               # one vertex
        (6, _route([])),                                                             # none
        (7, _route([[150.0, -33.0], [150.01, -33.0], [150.01, -33.01]])),           # south, right angle-ish
    ], "route_id int, geojson string")
    v = G.parse_routes(routes)
    from lathe.functions.geo import utm_zone
    ang = {(r["route_id"], r["seq"]): r["angle_deg"] for r in G.vertex_angles(
        v.withColumnRenamed("lng", "x").withColumnRenamed("lat", "y")).collect()}
    assert abs(ang[(1, 1)] - 180.0) < 1e-9
    assert ang[(2, 1)] == 0.0
    assert ang[(3, 1)] == 0.0
    assert ang[(4, 0)] == 180.0 and ang[(4, 1)] == 180.0 and ang[(5, 0)] == 180.0
    assert abs(ang[(7, 1)] - 90.0) < 1e-6
    cur = {r["route_id"]: r for r in G.route_curviness(routes).collect()}
    assert 6 not in cur and cur[1]["curviness"] == pytest.approx(0.0, abs=1e-6)
    assert cur[2]["curviness"] == 1.0


@pytest.mark.parametrize("lat,lng,zone", [(45.0, -180.0, 1), (45.0, 180.0, 60), (45.0, -174.0, 1), (45.0, -173.9, 2),
                                          (91.0, 10.0, None), (-33.0, 151.0, 56), (10.0, 181.0, None)])
def test_utm_zone_edges(spark, lat, lng, zone):
    df = spark.createDataFrame([(lat, lng)], "lat double, lng double")
    assert df.select(G.utm_zone("lat", "lng")).first()[0] == zone


def test_utm_series_on_central_meridian(spark):
    df = spark.createDataFrame([(45.0, -99.0)], "lat double, lng double")
    e, n = G.utm_project(F.col("lat"), F.col("lng"), G.utm_zone("lat", "lng"), F.col("lat") < 0)
    r = df.select(e.alias("e"), n.alias("n")).first()
    assert r["e"] == pytest.approx(500000.0, abs=1e-6)
    assert r["n"] == pytest.approx(4982950.4002, abs=1e-3)


def test_auc_one_class_and_all_equal(spark):
    one = spark.createDataFrame([(0.1, 1), (0.5, 1)], "s double, y int")
    assert M.roc_auc(one, "s", "y").first()["auc"] is None
    flat = spark.createDataFrame([(0.3, 1), (0.3, 0), (0.3, 0), (0.3, 1)], "s double, y int")
    assert M.roc_auc(flat, "s", "y").first()["auc"] == 0.5


def test_winsorizer_on_nan_column(spark):
    df = nan_to_null(spark.createDataFrame([(float("nan"),), (1.0,), (2.0,), (None,)], "x double"))
    m = Winsorizer(["x"], 0.0, 1.0).fit(df)
    assert sorted(r[0] for r in m.transform(df).collect() if r[0] is not None) == [1.0, 2.0]


@pytest.mark.parametrize("finish,error", [(1_000_000, R.SKETCH_ERROR), (20, R.SKETCH_ERROR), (0, 1e-4), (5, 1e-9)])
def test_selected_quantiles_equal_exact_with_ties(spark, monkeypatch, finish, error):
    # few finishing rows make several narrowing rounds; a claimed error that is too small makes brackets miss, which must be widened
    monkeypatch.setattr(R, "FINISH_ROWS", finish)
    monkeypatch.setattr(R, "SKETCH_ERROR", error)
    monkeypatch.setattr(R, "SKETCH_SIZE", 64 if error < 1e-3 else R.SKETCH_SIZE)
    df = spark.range(0, 3000).select((F.round((F.col("id") * 7919 % 1000) / 1000.0, 2)).alias("x"),
                                     (F.col("id") % 3 * 1.0).alias("y"), (F.col("id") * 17 % 2999 - 0.5).alias("z"),
                                     F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).when(F.col("id") % 5 == 1, F.col("id")).alias("u"),
                                     F.lit(None).cast("double").alias("none"))
    probs = [i / 10 for i in range(11)] + [0.002, 0.998] if finish > 1000 else [0.1, 0.998]  # each narrowing round compiles an aggregate per position
    exact = df.withColumn("u", F.when(~F.isnan("u"), F.col("u")))
    a = {(r["column"], r["q_index"]): r["value"] for r in R.quantiles(exact, ["x", "y", "z", "u"], probs, mode="exact").collect()}
    b = {(r["column"], r["q_index"]): r["value"] for r in R.quantiles(df, ["x", "y", "z", "u", "none"], probs, mode="auto").collect()}
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)
    assert R.quantiles(df.limit(0), ["x"], probs).count() == 0

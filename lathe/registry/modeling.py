"""Model queries (M1-M12, M15-M19, S5, K3), over whole tables with the operators' own sizes: 20 rounds of depth 5 (the
learner's defaults), 5 folds, 5 seeds, a blend step of 0.05, 10 search points. Scores depend on MLlib's learners and are
checked by rows; ids, folds, labels and score ranges, the scoring contract and the squared-error blend are checked by SQL."""

import json

from pyspark.sql import functions as F

from lathe.operators.blend import apply_blend, blend_weights
from lathe.plans import audio as AU, bank as BK, models as MD, road as RD
from lathe.registry.base import register, table
from lathe.registry.core import PRED_SQL, SEED, _md5_order
from lathe.session import scratch_path

BIN_FEATS = ["o_totalprice", "c_acctbal", "c_nationkey", "o_orderpriority"]
REG_FEATS = ["c_acctbal", "c_nationkey", "o_custkey", "o_orderpriority"]
K = 5
#: Rounds that the folds of M10 may take: twice the least number of rounds of the final model, so that what they find counts.
CV_ROUNDS = 100


def orders_frame(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("id"), "o_totalprice", "c_acctbal", "c_nationkey", "o_custkey", "o_orderpriority",
        (F.col("o_orderstatus") == "F").cast("int").alias("y"), "o_orderdate")


def _binary(spark, sf):
    return MD.prepare(orders_frame(spark, sf), BIN_FEATS, "y", ["o_orderpriority"], k=K, stratify=True)


def _regression(spark, sf):
    return MD.prepare(orders_frame(spark, sf), REG_FEATS, "o_totalprice", ["o_orderpriority"], k=K)


@register("m1_m9_boosted_binary_oof")
def m1_binary(spark, sf):
    x, _ = _binary(spark, sf)
    return MD.cross_validate(x, "y", "binary", "gbt", K).oof


@register("m1_m9_oof_rows", f"""SELECT o_orderkey AS id, CAST((row_number() OVER (PARTITION BY o_orderstatus = 'F' ORDER BY {_md5_order('o_orderkey', SEED)}) - 1) % 5 AS INT) AS fold,
  CAST(o_orderstatus = 'F' AS INT) AS y, TRUE AS in_range FROM orders JOIN customer ON o_custkey = c_custkey""")
def m1_rows(spark, sf):
    """Id, fold and label of every out-of-fold score, and whether the score is a probability."""
    x, _ = _binary(spark, sf)
    oof = MD.cross_validate(x, "y", "binary", "lr", K).oof
    return oof.select("id", F.col("fold").cast("int"), F.col("y").cast("int"), F.col("score").between(0, 1).alias("in_range"))


@register("m2_boosted_regression_oof")
def m2_regression(spark, sf):
    x, _ = _regression(spark, sf)
    return MD.cross_validate(x, "o_totalprice", "regression", "gbt", K).oof


def _families(spark, sf):
    """Three families cross-validated on the same folds, and their blend weights: (models, weights, oof, featurizer)."""
    x, fm = _binary(spark, sf)
    models, oof = {}, None
    for fam in ("gbt", "rf", "lr"):
        cv = MD.cross_validate(x, "y", "binary", fam, K)
        models |= {(fam, i): m for i, m in enumerate(cv.models)}
        part = cv.oof.select("id", "y", F.col("score").alias(f"p_{fam}"))
        oof = part if oof is None else oof.join(part.drop("y"), "id")
    preds = ["p_gbt", "p_rf", "p_lr"]
    w = blend_weights(oof, preds, "y", 0.05).first()
    return models, {p[2:]: w[f"w_{p}"] for p in preds}, oof, fm


@register("m3_m13_m14_family_blend")
def m3_families(spark, sf):
    _, weights, oof, _ = _families(spark, sf)
    return apply_blend(oof, {f"p_{f}": w for f, w in weights.items()}).select("id", "y", "blend")


@register("m12_m14_saved_blend_scoring")
def m12_blend(spark, sf):
    """Three families x five folds saved with their weights, reloaded from the folder, scored and written as CSV."""
    from lathe.sources import files as IO
    models, weights, _, fm = _families(spark, sf)
    path = MD.save_blend_ensemble(models, weights, fm, MD.ScoringContract(BIN_FEATS, ["o_orderpriority"], "y", spark.version), scratch_path(spark, "ensemble"))
    scored = MD.score_saved_ensemble(spark, path, orders_frame(spark, sf), "binary")
    out = IO.write_predictions(scored.select("id", "prediction"), scratch_path(spark, "ensemble-predictions"))
    return IO.read_table_csv(spark, out, schema="id bigint, prediction double")


@register("m4_class_weighting")
def m4_weights(spark, sf):
    x, _ = _binary(spark, sf)
    return MD.cross_validate(MD.class_weight_col(x, "y"), "y", "binary", "gbt", K, weight="weight").oof


@register("m5_m6_categorical_subsampling")
def m5_subsample(spark, sf):
    x, _ = _binary(spark, sf)
    return MD.cross_validate(x, "y", "binary", "gbt", K, subsamplingRate=0.8, featureSubsetStrategy="sqrt", maxBins=32).oof


@register("m7_m8_early_stopping_cv_score")
def m7_early(spark, sf):
    x, _ = _regression(spark, sf)
    cv = MD.cross_validate(x, "o_totalprice", "regression", "gbt", K, early_stopping=True)
    rows = [(i, float(m), int(b)) for i, (m, b) in enumerate(zip(cv.fold_metrics, cv.best_iterations, strict=True))]
    return spark.createDataFrame(rows, "fold int, rmse double, best_iteration int")


@register("m10_refit_with_cv_rounds")
def m10_refit(spark, sf):
    x, _ = _regression(spark, sf)
    cv = MD.cross_validate(x, "o_totalprice", "regression", "gbt", K, early_stopping=True, maxIter=CV_ROUNDS)
    model, rounds = MD.refit_with_cv_rounds(x, "o_totalprice", "regression", cv)
    return model.transform(x).select("id", "prediction", F.lit(rounds).alias("rounds"))


def _by_date(df):
    cut = F.lit("1997-01-01").cast("timestamp")
    return df.where(F.col("o_orderdate") < cut), df.where(F.col("o_orderdate") >= cut)


@register("m11_seed_fold_ensemble")
def m11_ensemble(spark, sf):
    train, test = _by_date(orders_frame(spark, sf))
    _, pred = MD.seed_fold_ensemble(train, ["c_acctbal", "c_nationkey", "o_custkey"], "o_totalprice", test)
    return pred


@register("m11_fold_matrix", f"""WITH e AS (SELECT list_sort(list_distinct(quantile_cont(o_totalprice, [{', '.join(str(i / 12) for i in range(13))}]))) AS edges FROM orders),
b AS (SELECT o_orderkey, o_totalprice, CAST(len(list_filter(edges[2:len(edges) - 1], lambda v: v < o_totalprice)) AS INT) AS bin FROM orders, e)
SELECT o_orderkey AS id, """ + ", ".join(f"CAST((row_number() OVER (PARTITION BY bin ORDER BY {_md5_order('o_orderkey', s)}) - 1) % 5 AS INT) AS fold_{s}" for s in range(42, 47)) + " FROM b")
def m11_folds(spark, sf):
    """Five fold numbers a row, one per seed, stratified on quantile bins of the price."""
    x = MD.fold_matrix(table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice"), "o_totalprice", range(42, 47))
    return x.select("id", *[F.col("folds")[i].alias(f"fold_{42 + i}") for i in range(5)])


@register("m12_s5_predict_saved_ensemble")
def m12_saved(spark, sf):
    x, fm = _binary(spark, sf)
    cv = MD.cross_validate(x, "y", "binary", "gbt", K)
    path = scratch_path(spark, "models")
    MD.save_models({("gbt", i): m for i, m in enumerate(cv.models)}, path)
    models = MD.load_model_folder(spark, path)
    new = fm.transform(orders_frame(spark, sf)).select("id", MD.FEATURES)
    return MD.predict_ensemble([models[("gbt", i)] for i in range(K)], new, "binary").select("id", "prediction")


@register("m15_k3_feature_importance")
def m15_importance(spark, sf):
    x, _ = _regression(spark, sf)
    m = MD.fit_model(MD.estimator("gbt", "regression", "o_totalprice"), x)
    return spark.createDataFrame(MD.feature_importances(m, REG_FEATS), "feature string, importance double")


@register("m16_compare_target_transforms")
def m16_modes(spark, sf):
    x, _ = _regression(spark, sf)
    rows = [(mode, float(MD.cross_validate(x, "o_totalprice", "regression", "gbt", K, target_mode=mode).mean_metric)) for mode in ("raw", "sqrt", "log1p")]
    return spark.createDataFrame(rows, "target_mode string, cv_rmse double")


@register("m17_parameter_search")
def m17_search(spark, sf):
    """Ten points, the first a given start; deep trees with few bins or shallow ones with many, never both."""
    x, _ = _binary(spark, sf)
    space = {"stepSize": ("loguniform", 0.05, 0.3), "subsamplingRate": ("uniform", 0.6, 0.9),
             "growth": ("branch", {"deep": {"maxDepth": ("int", 4, 6)}, "wide": {"maxBins": ("int", 32, 128), "minInstancesPerNode": ("int", 1, 20)}})}
    start = {"stepSize": 0.1, "subsamplingRate": 0.8, "maxDepth": 5}
    _, points, metrics, _ = MD.parameter_search(x.withColumn("fold", F.col("fold").cast("int")), "y", "binary", space, start=start, maxIter=5)
    return spark.createDataFrame([(i, json.dumps(p, sort_keys=True), float(m)) for i, (p, m) in enumerate(zip(points, metrics, strict=True))],
                                 "trial int, params string, cv_auc double")


@register("m18_holdout_scoring")
def m18_holdout(spark, sf):
    train, holdout = _by_date(orders_frame(spark, sf))
    keep = ["id", "y", *BIN_FEATS]
    return MD.holdout_score(train.select(keep), holdout.select(keep), lambda _: lambda df: df, "y", "binary", ["o_orderpriority"])[1]


@register("m18_holdout_bank_features")
def m18_bank(spark, sf):
    """Bank features (X4) fitted on the earlier half by id, applied to both; five boosted models score the later half."""
    bank = BK.bank_like(table(spark, sf, "orders"), table(spark, sf, "customer"))
    half = bank.agg(F.max("id")).first()[0] // 2
    scored, _ = MD.holdout_score(bank.where(F.col("id") <= half), bank.where(F.col("id") > half), lambda t: BK.fit_bank_features(t).transform, "y", "binary")
    return scored.select("id", F.col("y").cast("int"), "score")


@register("m18_holdout_audio_features")
def m18_audio(spark, sf):
    """Audio features (X6) fitted on one half of the tracks, applied to the other; metrics on the unseen half."""
    li = table(spark, sf, "lineitem")
    audio = AU.audio_like(li).withColumn("id", F.monotonically_increasing_id()).checkpoint(eager=True)
    train, holdout = audio.where("id % 2 = 0"), audio.where("id % 2 = 1")

    def fit(t):
        model = AU.fit_audio_v2(t.drop("id"), "BeatsPerMinute", top_features=["Energy", "MoodScore", "VocalContent"])
        return lambda df: model.transform(df, drop_target=False)
    return MD.holdout_score(train, holdout, fit, "BeatsPerMinute", "regression")[1]


@register("m18_holdout_road_features")
def m18_road(spark, sf):
    """Road features (X7) with fitted bin edges and categories, applied to the other half."""
    road = RD.road_like(table(spark, sf, "lineitem"), table(spark, sf, "orders")).withColumn("id", F.monotonically_increasing_id()).checkpoint(eager=True)

    def fit(t):
        return RD.RoadFeaturesModel(RD.fit_quantile_binner(t, "curvature")).transform
    return MD.holdout_score(road.where("id % 2 = 0"), road.where("id % 2 = 1"), fit, "accident_risk", "regression")[1]


@register("m19_scoring_contract", "SELECT id, c_acctbal, c_nationkey, o_totalprice FROM (SELECT o_orderkey AS id, c_acctbal, c_nationkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey)")
def m19_contract(spark, sf):
    contract = MD.ScoringContract(["c_acctbal", "c_nationkey", "o_totalprice"], [], "y", spark.version)
    c2 = MD.ScoringContract.load(spark, contract.save(spark, scratch_path(spark, "contract")))
    return c2.check(orders_frame(spark, sf))


#: The best point of the triangle of weights: every corner, edge optimum and the inner optimum, by their squared error.
M13_RMSE_SQL = f"""WITH p AS (SELECT CAST(y AS DOUBLE) AS y, p_a AS a, p_b AS b, p_c AS c FROM {PRED_SQL}),
g AS (SELECT sum(a*a) AS aa, sum(b*b) AS bb, sum(c*c) AS cc, sum(a*b) AS ab, sum(a*c) AS ac, sum(b*c) AS bc, sum(a*y) AS ya, sum(b*y) AS yb, sum(c*y) AS yc FROM p),
n AS (SELECT *, aa + cc - 2*ac AS s11, bb + cc - 2*bc AS s22, ab - ac - bc + cc AS s12, ya - yc - ac + cc AS r1, yb - yc - bc + cc AS r2 FROM g),
w AS (SELECT 1.0::DOUBLE AS wa, 0.0::DOUBLE AS wb, 0.0::DOUBLE AS wc UNION ALL SELECT 0, 1, 0 UNION ALL SELECT 0, 0, 1
  UNION ALL SELECT (bb - ab + ya - yb) / (aa + bb - 2*ab), 1 - (bb - ab + ya - yb) / (aa + bb - 2*ab), 0 FROM n
  UNION ALL SELECT r1 / s11, 0, 1 - r1 / s11 FROM n UNION ALL SELECT 0, r2 / s22, 1 - r2 / s22 FROM n
  UNION ALL SELECT (r1*s22 - r2*s12) / (s11*s22 - s12*s12), (r2*s11 - r1*s12) / (s11*s22 - s12*s12),
    1 - (r1*s22 - r2*s12) / (s11*s22 - s12*s12) - (r2*s11 - r1*s12) / (s11*s22 - s12*s12) FROM n),
best AS (SELECT wa, wb, wc FROM w, g WHERE wa >= -1e-9 AND wb >= -1e-9 AND wc >= -1e-9
  ORDER BY wa*wa*aa + wb*wb*bb + wc*wc*cc + 2*(wa*wb*ab + wa*wc*ac + wb*wc*bc) - 2*(wa*ya + wb*yb + wc*yc) LIMIT 1)
SELECT 'p_a' AS model, round(wa, 6) + 0.0 AS weight FROM best UNION ALL SELECT 'p_b', round(wb, 6) + 0.0 FROM best UNION ALL SELECT 'p_c', round(wc, 6) + 0.0 FROM best"""


@register("m13_blend_weights_rmse", M13_RMSE_SQL)
def m13_rmse(spark, sf):
    """Squared-error blend: least-squares weights in [0, 1] summing to one from one Gram aggregate."""
    from lathe.operators.blend import blend_weights_rmse
    from lathe.registry.core import predictions
    w = blend_weights_rmse(predictions(spark, sf), ["p_a", "p_b", "p_c"], "y")
    return spark.createDataFrame([(m, round(float(x), 6) + 0.0) for m, x in zip(["p_a", "p_b", "p_c"], w, strict=True)], "model string, weight double")

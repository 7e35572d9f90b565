"""Model work: folds cover every row once, OOF scores beat the trivial predictor, saved models
score like the originals, and the scoring contract rejects missing features."""

import pytest
from pyspark.sql import functions as F

from conftest import MID, SMALL
from lathe.operators.metrics import rmse, roc_auc
from lathe.plans import models as MD
from lathe.registry.modeling import orders_frame
from lathe.session import scratch_path


@pytest.fixture(scope="module")
def frame(spark):
    df = orders_frame(spark, MID)
    # a learnable regression target derived from the table itself
    return df.withColumn("t", F.col("c_acctbal") / 1000.0 + F.col("c_nationkey") * 0.5) \
             .withColumn("yy", ((F.col("c_acctbal") > 4500) != (F.col("o_custkey") % 10 == 0)).cast("int"))


def test_oof_covers_every_row_once_and_beats_mean(spark, frame):
    x, _ = MD.prepare(frame, ["c_acctbal", "c_nationkey", "o_custkey"], "t", k=3)
    cv = MD.cross_validate(x, "t", "regression", "gbt", 3, maxIter=10, maxDepth=3)
    oof = cv.oof
    assert oof.count() == frame.count() and oof.select("id").distinct().count() == frame.count()
    mean = oof.agg(F.avg("t")).first()[0]
    base = rmse(oof.withColumn("m", F.lit(mean)), "m", "t").first()["rmse"]
    assert cv.mean_metric < 0.5 * base


def test_binary_oof_auc_above_chance(spark, frame):
    x, _ = MD.prepare(frame, ["o_totalprice", "c_acctbal", "o_orderpriority"], "yy", ["o_orderpriority"], k=3, stratify=True)
    cv = MD.cross_validate(x, "yy", "binary", "gbt", 3, maxIter=5, maxDepth=3)
    assert all(m > 0.7 for m in cv.fold_metrics)
    assert roc_auc(cv.oof, "score", "yy").first()["auc"] > 0.7


def test_saved_models_score_like_originals(spark, frame):
    from pyspark.ml.regression import GBTRegressionModel
    x, _ = MD.prepare(frame, ["c_acctbal", "c_nationkey"], "t", k=2)
    cv = MD.cross_validate(x, "t", "regression", "gbt", 2, maxIter=3, maxDepth=2)
    paths = MD.save_models({("gbt", i): m for i, m in enumerate(cv.models)}, scratch_path(spark, "t-models"))
    loaded = MD.load_models(paths, {"gbt": GBTRegressionModel})
    a = MD.predict_ensemble(cv.models, x.select("id", MD.FEATURES), "regression")
    b = MD.predict_ensemble([loaded[("gbt", i)] for i in range(2)], x.select("id", MD.FEATURES), "regression")
    assert a.exceptAll(b).count() == 0


def test_model_folder_and_best_round(spark, frame):
    x, _ = MD.prepare(frame, ["c_acctbal", "o_custkey"], "o_totalprice", k=2)  # a target without signal: early rounds are best
    cv = MD.cross_validate(x, "o_totalprice", "regression", "gbt", 2, early_stopping=True, maxIter=4, maxDepth=2)
    for f, (m, b) in enumerate(zip(cv.models, cv.best_iterations)):
        assert m.getNumTrees == b
        refit = MD.estimator("gbt", "regression", "o_totalprice", maxIter=b, maxDepth=2).fit(x.where(F.col("fold") != f))
        scored = refit.transform(x.where(F.col("fold") == f))
        assert rmse(scored, "prediction", "o_totalprice").first()["rmse"] == pytest.approx(cv.fold_metrics[f])
    lr = MD.estimator("lr", "regression", "o_totalprice").fit(x)
    path = scratch_path(spark, "t-folder")
    MD.save_models({("gbt", 0): cv.models[0], ("lr", 0): lr}, path)
    loaded = MD.load_model_folder(spark, path)
    for key, m in ((("gbt", 0), cv.models[0]), (("lr", 0), lr)):
        a, b = (MD.predict_ensemble([k], x.select("id", MD.FEATURES), "regression") for k in (m, loaded[key]))
        assert a.exceptAll(b).count() == 0


def test_scoring_contract_rejects_missing_feature(spark, frame):
    c = MD.ScoringContract(["c_acctbal", "not_there"], [], "t")
    with pytest.raises(ValueError):
        c.check(frame)
    assert MD.ScoringContract(["c_nationkey", "c_acctbal"], [], "t").check(frame).columns == ["id", "c_nationkey", "c_acctbal"]


def test_random_search_is_seeded_and_clamps_start(spark):
    space = {"stepSize": ("loguniform", 0.01, 0.3), "maxDepth": ("int", 2, 6), "subsamplingRate": ("uniform", 0.5, 0.9)}
    a = MD.random_search_grid(space, 5, 7, start={"subsamplingRate": 1.0, "maxDepth": 4})
    b = MD.random_search_grid(space, 5, 7, start={"subsamplingRate": 1.0, "maxDepth": 4})
    assert a == b and a[0]["subsamplingRate"] == 0.9 and len(a) == 5


def test_boosted_model_cut_to_its_first_rounds(spark, frame):
    x, _ = MD.prepare(frame, ["c_acctbal", "c_nationkey"], "yy", k=2)
    full = MD.estimator("gbt", "binary", "yy", maxIter=4, maxDepth=2).fit(x)
    cut, refit = MD.first_rounds(full, 2), MD.estimator("gbt", "binary", "yy", maxIter=2, maxDepth=2).fit(x)
    assert cut.getNumTrees == 2 and MD.first_rounds(full, 4) is full
    a, b = (MD.predict_ensemble([m], x.select("id", MD.FEATURES), "binary") for m in (cut, refit))
    assert a.exceptAll(b).count() == 0


def test_folds_of_every_seed_are_balanced_by_target_bin(spark, frame):
    from lathe.operators.ranks import safe_stratify_bins
    x = frame.select("id", "t")
    m = MD.fold_matrix(x, "t", (1, 2, 3), 5)
    binned = safe_stratify_bins(m, "t")
    for i in range(3):
        sizes = binned.groupBy("bin", F.col("folds")[i].alias("f")).count().groupBy("bin").agg((F.max("count") - F.min("count")).alias("d"), F.count("*").alias("k"))
        assert all(r["d"] <= 1 and r["k"] == 5 for r in sizes.collect())
    assert m.where(F.col("folds")[0] != F.col("folds")[1]).count() > 0 and m.columns == ["id", "t", "folds"]


def test_search_never_draws_the_inactive_branch(spark):
    space = {"stepSize": ("uniform", 0.1, 0.2), "growth": ("branch", {"deep": {"maxDepth": ("int", 4, 6)}, "wide": {"maxBins": ("int", 32, 64), "minInstancesPerNode": ("int", 1, 9)}})}
    pts = MD.random_search_grid(space, 40, 3, start={"stepSize": 0.5, "maxDepth": 9})
    assert pts[0] == {"stepSize": 0.2, "maxDepth": 6} and len(pts) == 40
    kinds = {frozenset(p) for p in pts}
    assert kinds == {frozenset({"stepSize", "maxDepth"}), frozenset({"stepSize", "maxBins", "minInstancesPerNode"})}
    assert MD.random_search_grid(space, 1, 3, start={"maxBins": 40, "minInstancesPerNode": 2}) == [{"maxBins": 40, "minInstancesPerNode": 2}]


def test_saved_families_score_like_their_parts(spark, frame):
    feats = ["c_acctbal", "c_nationkey", "o_orderpriority"]
    x, fm = MD.prepare(frame, feats, "yy", ["o_orderpriority"], k=2)
    models = {(f, i): m for f, p in (("gbt", dict(maxIter=2, maxDepth=2)), ("lr", dict(maxIter=5))) for i, m in enumerate(MD.cross_validate(x, "yy", "binary", f, 2, **p).models)}
    path = MD.save_blend_ensemble(models, {"gbt": 0.75, "lr": 0.25}, fm, MD.ScoringContract(feats, ["o_orderpriority"], "yy"), scratch_path(spark, "t-ensemble"))
    got = MD.score_saved_ensemble(spark, path, frame, "binary")
    assert got.count() == frame.count() and got.where(~F.col("prediction").between(0, 1)).count() == 0
    z = fm.transform(frame).select("id", MD.FEATURES)
    for f in ("gbt", "lr"):
        z = MD.predict_ensemble([models[f, 0], models[f, 1]], z, "binary", f"p_{f}")
    want = z.select("id", (0.75 * F.col("p_gbt") + 0.25 * F.col("p_lr")).alias("w"))
    assert got.join(want, "id").where(F.abs(F.col("w") - F.col("prediction")) > 1e-12).count() == 0
    with pytest.raises(ValueError):
        MD.score_saved_ensemble(spark, path, frame.drop("c_acctbal"), "binary")


@pytest.mark.parametrize("task,label", [("binary", "y"), ("regression", "t")])
def test_boosted_fits_learn_from_cells_whose_number_does_not_grow(spark, monkeypatch, task, label):
    df = spark.range(20_000).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") * 37 % 11).cast("double").alias("b"),
                                    (F.col("id") % 3).cast("string").alias("c"), (1.0 + F.col("id") % 2).alias("w"), (F.xxhash64("id") % 5 / 1.0).alias("noise"))
    df = df.withColumn("t", F.col("a") * F.col("b") + F.col("noise")).withColumn("y", (F.col("t") > 20).cast("int"))
    x, _ = MD.prepare(df, ["a", "b", "c"], label, ["c"], k=3)
    x = x.join(df.select("id", "w"), "id").checkpoint()
    est = MD.estimator("gbt", task, label).setWeightCol("w")
    rows = MD.cross_validate(x, label, task, "gbt", 3, weight="w", maxIter=4)
    monkeypatch.setattr(MD, "CELL_ROWS", 0)
    once, twice = MD.row_cells(x, est, ["fold"]), MD.row_cells(x.unionByName(x), est, ["fold"])
    assert once.count() == twice.count() < 2_000
    assert twice.agg(F.sum("_n")).first()[0] == pytest.approx(2 * df.agg(F.sum("w")).first()[0])
    cells = MD.cross_validate(x, label, task, "gbt", 3, weight="w", maxIter=4)
    both = rows.oof.join(cells.oof.withColumnRenamed("score", "other"), "id")
    assert both.count() == 20_000 and both.where(F.abs(F.col("score") - F.col("other")) > 1e-9).count() == 0
    assert cells.models[0].getMaxBins() == 32


@pytest.mark.parametrize("task,label,weight", [("binary", "y", None), ("regression", "t", None), ("binary", "y", "w")])
def test_early_stopping_judges_rounds_of_models_learned_from_cells(spark, monkeypatch, task, label, weight):
    df = spark.range(8_000).select("id", (F.col("id") % 7).cast("double").alias("a"), (1.0 + F.col("id") % 2).alias("w"), (F.xxhash64("id") % 5 / 1.0).alias("noise"))
    df = df.withColumn("t", F.col("a") + F.col("noise")).withColumn("y", (F.col("t") > 4).cast("int"))
    x, _ = MD.prepare(df, ["a"], label, k=2)
    x = x.join(df.select("id", "w"), "id").checkpoint()
    rows = MD.cross_validate(x, label, task, "gbt", 2, weight=weight, early_stopping=True, maxIter=3)
    monkeypatch.setattr(MD, "CELL_ROWS", 0)
    cells = MD.cross_validate(x, label, task, "gbt", 2, weight=weight, early_stopping=True, maxIter=3)
    assert cells.best_iterations == rows.best_iterations and cells.fold_metrics == pytest.approx(rows.fold_metrics, abs=1e-9)
    assert all(m.isSet("weightCol") == (weight is not None) for m in cells.models)


def test_cells_leave_learners_of_single_rows_alone(spark, monkeypatch):
    monkeypatch.setattr(MD, "CELL_ROWS", 0)
    df = spark.range(4_000).select("id", (F.col("id") % 2).cast("double").alias("a"), (F.col("id") % 3 % 2).cast("double").alias("y"))
    x, _ = MD.prepare(df, ["a"], "y", k=2)
    assert MD.row_cells(x, MD.estimator("gbt", "binary", "y")).count() == 4
    wide, _ = MD.prepare(df.select("id", "y", *[F.rand(i).alias(f"r{i}") for i in range(4)]), [f"r{i}" for i in range(4)], "y", k=2)
    assert MD.row_cells(wide, MD.estimator("gbt", "binary", "y")) is None  # nearly every row is a cell of its own
    for est in (MD.estimator("gbt", "binary", "y", subsamplingRate=0.8), MD.estimator("gbt", "binary", "y", minInstancesPerNode=5),
                MD.estimator("rf", "binary", "y"), MD.estimator("lr", "binary", "y")):
        assert MD.row_cells(x, est) is None


def test_cell_bins_split_values_as_the_fitted_trees_do(spark, monkeypatch):
    """More values than bins: the row's cell and the scored row go the same way; NaN is refused as by the learner on rows."""
    monkeypatch.setattr(MD, "CELL_ROWS", 0)
    df = spark.range(20_000).select("id", (F.col("id") % 997).cast("double").alias("a"))
    df = df.withColumn("t", F.floor(F.col("a") / 250) * 100.0)
    x, _ = MD.prepare(df, ["a"], "t", k=2)
    est = MD.estimator("gbt", "regression", "t", maxIter=3)
    cells = MD.row_cells(x, est)
    model = MD.fit_cells(est, cells)
    inside = model.transform(cells).agg(F.sum(F.col("prediction") * F.col("_n"))).first()[0]
    assert cells.count() <= 32 and model.transform(x).agg(F.sum("prediction")).first()[0] == pytest.approx(inside, rel=1e-9)
    holes, _ = MD.prepare(df.withColumn("a", F.when(F.col("id") > 9, F.col("a")).otherwise(F.lit(float("nan")))), ["a"], "t", k=2)
    for fit in (est.fit, lambda rows: MD.fit_model(est, rows)):
        with pytest.raises(Exception, match="NaN"):
            fit(holes)


def _few_values(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") * 37 % 11).cast("double").alias("b"),
                                    (F.col("id") % 3).cast("string").alias("c"), (F.xxhash64("id") % 5 / 1.0).alias("noise"))
    df = df.withColumn("y", (F.col("a") * F.col("b") + F.col("noise") > 20).cast("int"))
    return MD.prepare(df, ["a", "b", "c"], "y", ["c"], k=3)[0]


def test_fits_that_draw_rows_learn_from_cells_with_every_round_s_counts(spark, monkeypatch):
    """Each row is drawn by itself in each round; with all rows drawn the trees are the learner's own, leaf sizes included."""
    monkeypatch.setattr(MD, "CELL_ROWS", 0)
    x = _few_values(spark)
    ests = [MD.estimator("gbt", "binary", "y", maxIter=3, minInstancesPerNode=700), MD.estimator("gbt", "binary", "y", maxIter=2, subsamplingRate=0.8)]
    cells = MD.drawn_cells(x, ests, ["fold"])
    n = cells.agg(*[F.sum(c).alias(c) for c in cells.columns if c.startswith("_n")]).first().asDict()
    assert cells.count() < 1_000 and n["_n"] == n["_n0_0"] == n["_n0_2"] == 20_000
    assert n["_n1_0"] != n["_n1_1"] and all(abs(n[c] - 16_000) < 400 for c in ("_n1_0", "_n1_1"))
    both = [MD.score_col(m.transform(x), "binary") for m in (ests[0].fit(x), MD.fit_drawn(ests[0], cells, 0))]
    pair = both[0].select("id", "score").join(both[1].select("id", F.col("score").alias("other")), "id")
    assert pair.where(F.abs(F.col("score") - F.col("other")) > 1e-9).count() == 0
    assert MD.drawn_cells(x.withColumn("y", F.col("y") * 2), ests) is None  # the learner itself refuses the label
    assert MD.drawn_cells(x.withColumn("w", F.lit(1.0)), [ests[0].copy().setWeightCol("w")]) is None


def test_drawn_folds_do_not_visit_rows_again(spark, monkeypatch):
    x = _few_values(spark)
    rows = MD.cross_validate(x, "y", "binary", "gbt", 3, maxIter=3, subsamplingRate=0.8, featureSubsetStrategy="all")
    monkeypatch.setattr(MD, "CELL_ROWS", 0)
    seen, fit = [], MD.fit_drawn
    monkeypatch.setattr(MD, "fit_drawn", lambda est, cells, i=0: seen.append(cells.count()) or fit(est, cells, i))
    drawn = MD.cross_validate(x, "y", "binary", "gbt", 3, maxIter=3, subsamplingRate=0.8, featureSubsetStrategy="all")
    assert len(seen) == 3 and max(seen) < 1_000 and drawn.oof.count() == 20_000
    assert drawn.mean_metric == pytest.approx(rows.mean_metric, abs=0.01) and drawn.models[0].getMaxBins() == 32
    path = MD.save_models({("gbt", 0): drawn.models[0]}, scratch_path(spark, "t-drawn"))["gbt", 0]
    again = MD.GBTClassificationModel.load(path)
    assert again.toDebugString.split("\n")[1:] == drawn.models[0].toDebugString.split("\n")[1:]


def test_search_on_cells_scores_points_as_on_rows(spark, monkeypatch):
    x = _few_values(spark).withColumn("fold", F.col("fold").cast("int"))
    space = {"stepSize": ("uniform", 0.1, 0.3), "growth": ("branch", {"deep": {"maxDepth": ("int", 2, 4)}, "wide": {"maxBins": ("int", 32, 40), "minInstancesPerNode": ("int", 5, 900)}})}
    rows = MD.parameter_search(x, "y", "binary", space, trials=3, seed=5, maxIter=2)
    monkeypatch.setattr(MD, "CELL_ROWS", 0)
    monkeypatch.setattr(MD.CrossValidator, "fit", None)  # no point goes through rows
    cells = MD.parameter_search(x, "y", "binary", space, trials=3, seed=5, maxIter=2)
    assert cells[:2] == rows[:2] and cells[2] == pytest.approx(rows[2], abs=1e-6) and cells[3].avgMetrics == cells[2]
    assert cells[3].bestModel.getNumTrees == 2 and cells[3].transform(x).count() == 20_000


def test_rounds_of_the_refit_follow_the_folds(spark, monkeypatch):
    """Folds may take more rounds than the final model's least number, and the final model takes the rounds they found."""
    from lathe.registry import modeling
    asked, validate = [], MD.cross_validate

    def folds(*args, **params):
        asked.append(params["maxIter"])
        cv = validate(*args, **(params | {"maxIter": 1}))
        cv.best_iterations = [asked[0] - i for i in range(5)]
        return cv

    class Fitted(Exception):
        pass

    def fit(est, x):
        raise Fitted(est.getMaxIter())
    monkeypatch.setattr(MD, "cross_validate", folds)
    monkeypatch.setattr(MD, "fit_model", fit)
    with pytest.raises(Fitted) as found:
        modeling.m10_refit(spark, SMALL)
    assert found.value.args[0] == asked[0] - 2 > 50

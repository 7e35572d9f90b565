"""Model work as Spark ML jobs.

Training data is featurized once, given a fold column, and cut from its
lineage with ``checkpoint()`` into the session's shared checkpoint folder, so
the k x m model fits that follow re-read it instead of re-running the
featurization, and a lost executor costs a re-read, not a recomputation.
Trees are MLlib's (histogram split finding, ``maxBins``); nothing is
collected to the driver except fitted models and per-fold metrics.
"""

from __future__ import annotations

import json
import math
import random
import statistics
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel,
                                       RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (GBTRegressionModel, GBTRegressor, LinearRegression, LinearRegressionModel,
                                   RandomForestRegressionModel, RandomForestRegressor)
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.functions.scalars import from_model_space, to_model_space
from lathe.operators.blend import apply_blend, load_blend_weights, save_blend_weights
from lathe.operators.metrics import rmse, roc_auc
from lathe.operators.ranks import hash_key, kfold, safe_stratify_bins, sample_n
from lathe.session import checkpoint_dir, written

FEATURES = "features"
#: Fits whose Spark jobs are submitted side by side.
PARALLEL_FITS = 4
#: Smaller tables are fitted row by row.
CELL_ROWS = 200_000
#: Cells of one task of a fit on them that visits them round by round, and such fits side by side: each round is many small jobs.
CELLS_A_TASK = 100_000
PARALLEL_DRAWN_FITS = 8


# ---------------------------------------------------------------- featurization

def featurizer(features: list[str], categorical: list[str] | None = None) -> Pipeline:
    """M5: categorical columns through ``StringIndexer(handleInvalid='keep')``, then one vector."""
    categorical = [c for c in (categorical or []) if c in features]
    stages = []
    if categorical:
        stages.append(StringIndexer(inputCols=categorical, outputCols=[f"{c}__idx" for c in categorical],
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
    inputs = [f"{c}__idx" if c in categorical else c for c in features]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES, handleInvalid="keep"))
    return Pipeline(stages=stages)


def prepare(df: DataFrame, features: list[str], label: str, categorical=None, id_col: str = "id",
            k: int = 5, seed=42, stratify: bool = False, checkpoint: bool = True, fit_rows: int | None = None):
    """Featurize once, add ``fold`` (exact, optionally stratified on the label), checkpoint.
    Returns ``(frame, featurizer_model)`` with columns ``id, label, fold, features``. ``fit_rows`` bounds the labelled rows
    that models learn from: a sample of that many rows by hash of the id."""
    if fit_rows is not None:
        df = sample_n(df, fit_rows, id_col, seed)
    fm = featurizer(features, categorical).fit(df)
    x = fm.transform(df).select(id_col, F.col(label).cast("double").alias(label), FEATURES)
    x = kfold(x, id_col, k, seed, strata=[label] if stratify else None)
    if checkpoint:
        x = x.checkpoint(eager=True)
    return x, fm


def class_weight_col(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """M4: weight ``neg/pos`` on positives, 1 on negatives (from one aggregate row)."""
    s = df.agg(F.try_divide(F.count_if(F.col(label) == 0).cast("double"), F.count_if(F.col(label) == 1)).alias("_w"))
    return df.crossJoin(F.broadcast(s)).withColumn(out, F.when(F.col(label) == 1, F.col("_w")).otherwise(F.lit(1.0))).drop("_w")


def estimator(family: str, task: str, label: str, seed=42, prediction: str = "prediction", **params):
    """M1-M3, M6: one model family. ``task`` is ``binary`` or ``regression``."""
    common = dict(featuresCol=FEATURES, labelCol=label, predictionCol=prediction)
    if task == "binary":
        cls = {"gbt": GBTClassifier, "rf": RandomForestClassifier, "lr": LogisticRegression}.get(family)
        if cls is not None:
            est = cls(**common, **params) if family == "lr" else cls(seed=seed, **common, **params)
            return est.setProbabilityCol(f"{prediction}__prob").setRawPredictionCol(f"{prediction}__raw")
    else:
        if family == "gbt":
            return GBTRegressor(seed=seed, **common, **params)
        if family == "rf":
            return RandomForestRegressor(seed=seed, **common, **params)
        if family == "lr":
            return LinearRegression(**common, **params)
    raise ValueError(f"unknown family/task {family}/{task}")


def score_col(model_out: DataFrame, task: str, prediction: str = "prediction", out: str = "score") -> DataFrame:
    """The positive-class probability (binary) or the prediction (regression) as ``out``."""
    if task == "binary":
        return model_out.withColumn(out, vector_to_array(F.col(f"{prediction}__prob"))[1])
    return model_out.withColumn(out, F.col(prediction))


# ---------------------------------------------------------------- boosted fits on cells of equal rows

def _bin_values(x: DataFrame, max_bins: int, rows: int, seed) -> dict[int, list[float]]:
    """One value per bin of every continuous feature, from as many rows as MLlib's learners take to choose their
    thresholds: all values of a feature with at most ``max_bins`` of them, else values at equal distances of rank."""
    attrs = (x.schema[FEATURES].metadata.get("ml_attr") or {}).get("attrs") or {}
    discrete = {a["idx"] for kind in ("nominal", "binary") for a in attrs.get(kind, [])}
    want = max(max_bins * max_bins, 10_000)
    some = x.select(FEATURES) if rows <= want else x.select(FEATURES).sample(min(1.0, 1.1 * want / rows), seed)
    seen = [r[0].toArray() for r in some.collect()]
    out = {}
    for j in range(len(seen[0]) if seen else 0):
        if j not in discrete:
            values = sorted(float(v[j]) for v in seen if math.isfinite(v[j]))
            distinct = sorted(set(values))
            if len(distinct) > max_bins:
                distinct = sorted({values[(2 * i + 1) * len(values) // (2 * max_bins)] for i in range(max_bins)})
            out[j] = distinct or [0.0]
    return out


def _nearest(value: F.Column, bins: list[float]) -> F.Column:
    """The entry of ascending ``bins`` on whose side of the midpoints ``value`` lies."""
    if len(bins) == 1:
        return F.lit(bins[0])
    half = len(bins) // 2
    return F.when(value <= (bins[half - 1] + bins[half]) / 2.0, _nearest(value, bins[:half])).otherwise(_nearest(value, bins[half:]))


def _binned(x: DataFrame, est, rows: int, keep: list) -> tuple[DataFrame, list[str]]:
    """The columns ``keep`` and one column a feature, its value that of its bin; and the names of the latter."""
    bins = _bin_values(x, est.getMaxBins(), rows, est.getSeed())
    a = F.col("_a")
    names = [f"_f{j}" for j in range(x.select(FEATURES).first()[0].size)]
    flat = x.select(*keep, vector_to_array(FEATURES).alias("_a"))
    kept = [c for c in flat.columns if c != "_a"]
    return flat.select(*kept, *[(F.when(F.abs(a[j]) < float("inf"), _nearest(a[j], bins[j])).otherwise(a[j]) if j in bins else a[j]).alias(n)
                                for j, n in enumerate(names)]), names


def row_cells(x: DataFrame, est, by: list[str] | None = None) -> DataFrame | None:
    """``(by..., label, features, _n)``: the rows that a boosted learner cannot tell apart as one row of their weight, written
    once; None where the learner needs single rows or cells would not be fewer than half of them.

    Boosted trees see a row through its bins, its label and its weight. Features take their bin's value, whose midpoints
    are the thresholds that MLlib tries on such a table; cells hold a class, or the mean label (the spread inside a cell is
    on both sides of every gain). Their number is bounded by the product of the bins, whatever the rows; features derived
    from others (squares, crossed labels) add few. It is estimated over all rows first."""
    if not isinstance(est, (GBTClassifier, GBTRegressor)) or est.getSubsamplingRate() < 1.0 or est.getMinInstancesPerNode() > 1 \
            or est.isSet("validationIndicatorCol"):
        return None
    rows = x.count()
    if rows < CELL_ROWS:
        return None
    by, label, binary = by or [], est.getLabelCol(), isinstance(est, GBTClassifier)
    weight = F.col(est.getWeightCol()).cast("double") if est.isSet("weightCol") else F.lit(1.0)
    flat, names = _binned(x, est, rows, [*by, F.col(label).cast("double").alias(label), weight.alias("_w")])
    if 2 * flat.agg(F.approx_count_distinct(F.xxhash64(*by, *names, *([label] if binary else [])))).first()[0] > rows:
        return None
    # A weight, a label or a feature (NaN) that the learner refuses stays one that it refuses.
    total = F.when((F.min("_w") >= 0) & (F.count("_w") == F.count(F.lit(1))), F.sum("_w"))
    if binary:
        cells = flat.groupBy(*by, label, *names).agg(total.alias("_n"))
    else:
        mean = F.when(F.count(label) == F.count(F.lit(1)), F.try_divide(F.sum(F.col("_w") * F.col(label)), F.sum("_w")))
        cells = flat.groupBy(*by, *names).agg(mean.alias(label), total.alias("_n"))
    features = array_to_vector(F.array(*names)).alias(FEATURES, metadata=x.schema[FEATURES].metadata)
    return cells.where("_n IS NULL OR _n > 0").select(*by, label, features, "_n").checkpoint(eager=True)


def _merged(cells: DataFrame, est) -> DataFrame:
    """Cells of several groups (folds) as cells of all of them together."""
    label, meta = est.getLabelCol(), cells.schema[FEATURES].metadata
    key = vector_to_array(FEATURES).alias("_a")
    total = F.when(F.count("_n") == F.count(F.lit(1)), F.sum("_n")).alias("_n")
    if isinstance(est, GBTClassifier):
        out = cells.groupBy(key, label).agg(total)
    else:
        mean = F.when(F.count(label) == F.count(F.lit(1)), F.sum(F.col("_n") * F.col(label)) / F.sum("_n"))
        out = cells.groupBy(key).agg(mean.alias(label), total)
    return out.select(label, array_to_vector("_a").alias(FEATURES, metadata=meta), "_n")


def fit_cells(est, cells: DataFrame):
    """``est`` fitted on the rows that ``cells`` stand for. MLlib chooses thresholds from the square of ``maxBins`` rows or
    more; here that is all cells, so that none of their values is left out."""
    wide = est.copy({est.maxBins: max(est.getMaxBins(), math.isqrt(cells.count()) + 1)}).setWeightCol("_n")
    model = wide.fit(cells)
    model.set(model.maxBins, est.getMaxBins())
    # The model goes on to score and judge rows, which have the weight of ``est`` or none.
    if est.isSet("weightCol"):
        model.set(model.weightCol, est.getWeightCol())
    else:
        model.clear(model.weightCol)
    model._transfer_params_to_java()
    return model


def fit_model(est, x: DataFrame):
    """``est.fit(x)``, on cells where the learner cannot tell rows apart."""
    cells = row_cells(x, est)
    return est.fit(x) if cells is None else fit_cells(est, cells)


# ---------------------------------------------------------------- boosted fits that draw rows, on cells

def drawn_cells(x: DataFrame, ests: list, by: list[str] | None = None) -> DataFrame | None:
    """``(by..., label, features, _n, _n<i>_<m>...)``: cells (``row_cells``) for boosted classifiers of equal ``maxBins`` that draw
    rows in every round; ``_n<i>_<m>`` is the number of the cell's rows that learner ``i`` draws in round ``m``. Each row is drawn by
    itself, for every round, in the one pass that counts the cells. None where a learner needs single rows, a label is not one that
    the learner takes, or the cells of all groups together would not be fewer than half of the rows."""
    first = ests[0]
    if any(not isinstance(e, GBTClassifier) or e.isSet("weightCol") or e.isSet("validationIndicatorCol") or e.getMinWeightFractionPerNode() > 0
           or e.getMaxBins() != first.getMaxBins() for e in ests):
        return None
    rows = x.count()
    if rows < CELL_ROWS:
        return None
    by, label = by or [], first.getLabelCol()
    flat, names = _binned(x, first, rows, [*by, F.col(label).cast("double").alias(label)])
    seen = flat.agg(F.approx_count_distinct(F.xxhash64(*names, label)), F.count_if(F.col(label).isin(0.0, 1.0))).first()
    if 2 * seen[0] > rows or seen[1] < rows:
        return None
    rounds = max(e.getMaxIter() for e in ests)
    draws = flat.select("*", *[F.rand(first.getSeed() + 1_000_003 * (m + 1)).alias(f"_u{m}") for m in range(rounds)])
    counts = [F.count_if(F.col(f"_u{m}") < e.getSubsamplingRate()).cast("double").alias(f"_n{i}_{m}") for i, e in enumerate(ests) for m in range(e.getMaxIter())]
    cells = draws.groupBy(*by, label, *names).agg(F.count(F.lit(1)).cast("double").alias("_n"), *counts)
    features = array_to_vector(F.array(*names)).alias(FEATURES, metadata=x.schema[FEATURES].metadata)
    return cells.select(*by, label, features, "_n", *[c for c in cells.columns if c.startswith("_n") and c != "_n"]).checkpoint(eager=True)


def _merged_draws(cells: DataFrame, label: str, counts: list[str]) -> DataFrame:
    """Drawn cells of several groups (folds) as cells of all of them together, with these counts."""
    out = cells.groupBy(label, vector_to_array(FEATURES).alias("_a")).agg(*[F.sum(c).alias(c) for c in counts])
    return out.select(label, array_to_vector("_a").alias(FEATURES, metadata=cells.schema[FEATURES].metadata), *counts)


def _boosted(kind, est, trees: list, weights: list[float], features: int):
    """A boosted model (``kind``: MLlib's classification or regression model) of single regression trees."""
    context = SparkContext._active_spark_context
    jvm, gateway = context._jvm, context._gateway
    jtrees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    jweights = gateway.new_array(gateway.jvm.double, len(trees))
    for i, (t, w) in enumerate(zip(trees, weights, strict=True)):
        jtrees[i], jweights[i] = t._java_obj, w
    if kind is GBTClassificationModel:
        return est._copyValues(kind(jvm.org.apache.spark.ml.classification.GBTClassificationModel(est.uid, jtrees, jweights, features, 2)))
    return kind(jvm.org.apache.spark.ml.regression.GBTRegressionModel(est.uid, jtrees, jweights, features)).setFeaturesCol(FEATURES)


def fit_drawn(est, cells: DataFrame, i: int = 0):
    """The boosted classifier ``est`` (learner ``i`` of ``drawn_cells``) fitted round by round: a tree on the labels -1 and 1, then trees
    on what the log loss leaves of them, each over the rows drawn for its round. The number of rows that a leaf needs is asked of
    their counts, as the share of the round's rows."""
    label, size = est.getLabelCol(), cells.select(FEATURES).first()[0].size
    drawn = [f"_n{i}_{m}" for m in range(est.getMaxIter())]
    # Every round visits the cells some eight times, so they lie in as few tasks as their number asks for.
    data = _merged_draws(cells, label, drawn).coalesce(cells.count() // CELLS_A_TASK + 1).persist()
    try:
        known = data.agg(F.count(F.lit(1)).alias("cells"), *[F.sum(c).alias(c) for c in drawn]).first()
        y = 2.0 * F.col(label) - 1.0
        trees, weights = [], []
        for m, n in enumerate(drawn):
            if m == 0:
                todo = data.withColumn("_t", y)
            else:
                so_far = _boosted(GBTRegressionModel, est, trees, weights, size).setPredictionCol("_p")
                todo = so_far.transform(data).withColumn("_t", 4.0 * y / (1.0 + F.exp(2.0 * y * F.col("_p"))))
            least = est.getMinInstancesPerNode()
            tree = RandomForestRegressor(featuresCol=FEATURES, labelCol="_t", weightCol=n, numTrees=1, bootstrap=False, subsamplingRate=1.0, seed=est.getSeed() + m,
                                         featureSubsetStrategy=est.getFeatureSubsetStrategy(), maxDepth=est.getMaxDepth() if known[n] >= 2 * least else 0,
                                         maxBins=max(est.getMaxBins(), math.isqrt(known["cells"]) + 1), minInfoGain=est.getMinInfoGain(),
                                         minWeightFractionPerNode=(least - 0.5) / known[n] if 1 < least <= known[n] / 2 else 0.0,
                                         maxMemoryInMB=est.getMaxMemoryInMB(), leafCol="")
            trees.append(tree.fit(todo.where(F.col(n) > 0).select(FEATURES, "_t", n)).trees[0])
            weights.append(1.0 if m == 0 else est.getStepSize())
    finally:
        data.unpersist()
    model = _boosted(GBTClassificationModel, est, trees, weights, size)
    model._transfer_params_to_java()
    return model


# ---------------------------------------------------------------- early stopping

def best_iteration(model, valid: DataFrame, task: str) -> int:
    """M7: 1-based round with the lowest validation loss (``evaluateEachIteration``)."""
    losses = model.evaluateEachIteration(valid) if task == "binary" else model.evaluateEachIteration(valid, "squared")
    return int(min(range(len(losses)), key=lambda i: (losses[i], i))) + 1


def first_rounds(model, rounds: int):
    """The boosted model as it stood after ``rounds`` rounds: its first trees and their weights, no second fit."""
    if rounds >= model.getNumTrees:
        return model
    context = SparkContext._active_spark_context
    jvm, gateway = context._jvm, context._gateway
    java = model._java_obj
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for i, (t, w) in enumerate(zip(java.trees()[:rounds], java.treeWeights()[:rounds], strict=True)):
        trees[i], weights[i] = t, w
    if isinstance(model, GBTClassificationModel):
        cut = jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, weights, java.numFeatures(), java.numClasses())
    else:
        cut = jvm.org.apache.spark.ml.regression.GBTRegressionModel(java.uid(), trees, weights, java.numFeatures())
    out = type(model)(cut)
    model._copyValues(out)
    out._transfer_params_to_java()
    return out


# ---------------------------------------------------------------- cross-validation

@dataclass
class CVResult:
    oof: DataFrame                 # id, fold, label, score
    fold_metrics: list[float]
    models: list = field(default_factory=list)
    best_iterations: list[int] = field(default_factory=list)

    @property
    def mean_metric(self) -> float:
        return sum(self.fold_metrics) / len(self.fold_metrics)


def cross_validate(x: DataFrame, label: str, task: str, family: str = "gbt", k: int | None = None, seed=42,
                   weight: str | None = None, early_stopping: bool = False, target_mode: str = "raw",
                   **params) -> CVResult:
    """M8 + M9: one model per fold, each scoring the fold it did not see; OOF scores are the
    union of the k held-out predictions. Metric: AUC (binary) or RMSE on the original scale.
    With ``early_stopping`` the kept model of a fold has its best number of rounds, and it is the one that scores.
    Boosted models of a large table learn from its cells (``row_cells``, ``drawn_cells``), made once for all folds.
    A fold's scores are written once; its metric and the union read them."""
    checkpoint_dir(x.sparkSession)
    folds = sorted(r[0] for r in x.select("fold").distinct().collect()) if k is None else list(range(k))
    lab, rows = label, x
    if task == "regression" and target_mode != "raw":
        lab, rows = "_t", x.withColumn("_t", to_model_space(label, target_mode))

    def learner():
        est = estimator(family, task, lab, seed, **params)
        return est.setWeightCol(weight) if weight else est

    cells = row_cells(rows, learner(), ["fold"])
    draws = drawn_cells(rows, [learner()], ["fold"]) if cells is None and family == "gbt" and learner().getSubsamplingRate() < 1.0 else None

    def one(f):
        va, best = x.where(F.col("fold") == f), None
        est, other = learner(), F.col("fold") != f
        if draws is not None:
            m = fit_drawn(est, draws.where(other))
        else:
            m = est.fit(rows.where(other)) if cells is None else fit_cells(est, _merged(cells.where(other), est))
        if early_stopping and family == "gbt":
            best = best_iteration(m, va.withColumn(lab, to_model_space(label, target_mode)) if lab != label else va, task)
            m = first_rounds(m, best)
        pred = score_col(m.transform(va), task)
        if task == "regression" and target_mode != "raw":
            pred = pred.withColumn("score", from_model_space("score", target_mode))
        pred = pred.select("id", "fold", label, "score").checkpoint(eager=True)
        metric = roc_auc(pred, "score", label).first()["auc"] if task == "binary" else rmse(pred, "score", label).first()["rmse"]
        return pred, metric, m, best

    parts, metrics, models, bests = zip(*side_by_side(one, folds, PARALLEL_FITS if draws is None else PARALLEL_DRAWN_FITS), strict=True)
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    return CVResult(oof, list(metrics), list(models), [b for b in bests if b is not None])


def side_by_side(run, items: list, most: int = PARALLEL_FITS) -> list:
    """``run`` of every item, ``most`` at a time on driver threads (small fits wait for jobs more than they compute)."""
    with ThreadPoolExecutor(most) as pool:
        return list(pool.map(inheritable_thread_target(run), items))


def refit_with_cv_rounds(x: DataFrame, label: str, task: str, cv: CVResult, min_rounds: int = 50, seed=42, **params):
    """Final model on all rows with the mean best iteration of the folds (at least ``min_rounds``)."""
    rounds = max(min_rounds, int(sum(cv.best_iterations) / len(cv.best_iterations))) if cv.best_iterations else min_rounds
    params = dict(params, maxIter=rounds)
    return fit_model(estimator("gbt", task, label, seed, **params), x), rounds


def fold_matrix(x: DataFrame, label: str, seeds, k: int = 5, id_col: str = "id", strata: str | None = None) -> DataFrame:
    """``x`` with ``folds``: one fold number per seed, in the order of ``seeds``. Folds are stratified on ``strata``, or on
    quantile bins of the label (W7), so in every seed the folds of a bin differ by at most one row."""
    binned = x.withColumn("_bin", F.col(strata)) if strata else safe_stratify_bins(x, label, out="_bin")
    for i, s in enumerate(seeds):
        binned = kfold(binned, id_col, k, s, strata="_bin", out=f"_fold{i}")
    return binned.select(*x.columns, F.array(*[F.col(f"_fold{i}") for i in range(len(seeds))]).alias("folds"))


def seed_fold_ensemble(df: DataFrame, features: list[str], label: str, test: DataFrame, seeds=(42, 43, 44, 45, 46),
                       k: int = 5, task: str = "regression", family: str = "gbt", id_col: str = "id", target_mode: str = "raw",
                       fit_rows: int | None = None, categorical=None, **params):
    """For each seed, folds by that seed (stratified on the class, or on quantile bins of a numeric label), k models;
    test predictions are the average over seeds of fold-averaged predictions; OOF predictions averaged over seeds. Scores
    of models fitted in ``target_mode`` return to the original scale before they are averaged. The table is featurized,
    given all its folds and written once."""
    checkpoint_dir(df.sparkSession)
    if fit_rows is not None:
        df = sample_n(df, fit_rows, id_col)
    fm = featurizer(features, categorical).fit(df)
    x = fm.transform(df).select(F.col(id_col).alias("id"), F.col(label).cast("double").alias(label), FEATURES)
    x = fold_matrix(x, label, seeds, k, strata=label if task == "binary" else None).checkpoint(eager=True)
    runs = [cross_validate(x.withColumn("fold", F.col("folds")[i]).drop("folds"), label, task, family, k, s, target_mode=target_mode, **params)
            for i, s in enumerate(seeds)]
    oof = None
    for cv in runs:
        oof = cv.oof.select("id", "score") if oof is None else oof.unionByName(cv.oof.select("id", "score"))
    oof = oof.groupBy("id").agg(F.avg("score").alias("oof"))
    scored = fm.transform(test).select(F.col(id_col).alias("id"), FEATURES)
    pred = predict_ensemble([m for cv in runs for m in cv.models], scored, task, "prediction", target_mode)
    return oof, pred.select("id", "prediction")


def _apply(model, df: DataFrame, task: str, out: str) -> DataFrame:
    """Score ``df`` with one fitted model into column ``out`` (keeps all other columns)."""
    m = model.copy()
    m.setPredictionCol(f"{out}__pred")
    if task == "binary":
        m.setProbabilityCol(f"{out}__prob").setRawPredictionCol(f"{out}__raw")
        r = m.transform(df).withColumn(out, vector_to_array(F.col(f"{out}__prob"))[1])
        return r.drop(f"{out}__pred", f"{out}__prob", f"{out}__raw")
    return m.transform(df).withColumnRenamed(f"{out}__pred", out)


def predict_ensemble(models: list, df: DataFrame, task: str, out: str = "prediction", target_mode: str = "raw") -> DataFrame:
    """Apply every model to the featurized table and average (on the original scale of the label)."""
    cols = []
    for i, m in enumerate(models):
        df = _apply(m, df, task, f"_m{i}")
        if task == "regression" and target_mode != "raw":
            df = df.withColumn(f"_m{i}", from_model_space(f"_m{i}", target_mode))
        cols.append(f"_m{i}")
    return df.withColumn(out, sum(F.col(c) for c in cols) / len(cols)).drop(*cols)


# ---------------------------------------------------------------- a saved ensemble of families

def save_blend_ensemble(models: dict, weights: dict[str, float], featurizer_model, contract: "ScoringContract", path: str) -> str:
    """Everything that scoring needs under one folder: the models per (family, fold), the weight per family, the fitted
    featurizer and the contract."""
    spark, path = SparkSession.getActiveSession(), path.rstrip("/")
    save_models(models, f"{path}/models")
    save_blend_weights(spark, weights, f"{path}/weights")
    featurizer_model.write().overwrite().save(f"{path}/featurizer")
    contract.save(spark, f"{path}/contract")
    return path


def score_saved_ensemble(spark: SparkSession, path: str, df: DataFrame, task: str, out: str = "prediction") -> DataFrame:
    """``(id, p_<family>..., out)`` of a table by an ensemble saved with ``save_blend_ensemble``: the contract is checked, each family's
    folds are averaged (M12), families are blended by the saved weights (M14)."""
    path = path.rstrip("/")
    x = PipelineModel.load(f"{path}/featurizer").transform(ScoringContract.load(spark, f"{path}/contract").check(df)).select("id", FEATURES)
    weights, models = load_blend_weights(spark, f"{path}/weights"), load_model_folder(spark, f"{path}/models")
    for family in sorted(weights):
        x = predict_ensemble([m for (f, _), m in sorted(models.items()) if f == family], x, task, f"p_{family}")
    return apply_blend(x, {f"p_{f}": w for f, w in weights.items()}, out).drop(FEATURES)


# ---------------------------------------------------------------- holdout with fitted state

def holdout_score(train: DataFrame, holdout: DataFrame, fit, label: str, task: str, categorical=None, id_col: str = "id", k: int = 5, seed=42,
                  fit_rows: int | None = None, family: str = "gbt", **params) -> tuple[DataFrame, DataFrame]:
    """``fit(train)`` gives a transform (a fitted X4, X6 or X7) that both tables go through; an ensemble of k fold
    models learns from the training table and scores the other; missing numbers become -1, which trees can split off.
    Returns ``(id, label, score)`` of the holdout and its metrics (``auc`` for a binary label, and ``rmse``, ``n``)."""
    fitted = fit(train)

    def transform(df):
        out = fitted(df)
        numbers = {c for c, t in out.dtypes if t in ("double", "float")}
        return out.select(*[F.nanvl(F.coalesce(F.col(f"`{c}`"), F.lit(-1)), F.lit(-1)).alias(c) if c in numbers
                            else F.coalesce(F.col(f"`{c}`"), F.lit(-1)).alias(c) if t in ("bigint", "int", "smallint", "tinyint") and c != id_col else F.col(f"`{c}`")
                            for c, t in out.dtypes])
    tr = transform(train)
    text = [c for c, t in tr.dtypes if t == "string" and c not in (id_col, label)]
    categorical = [c for c in (categorical or text) if c in tr.columns]
    features = [c for c, t in tr.dtypes if c not in (id_col, label) and (c in categorical or t in ("double", "float", "bigint", "int", "smallint", "tinyint"))]
    x, fm = prepare(tr, features, label, categorical, id_col, k, seed, stratify=task == "binary", fit_rows=fit_rows)
    if family != "lr":  # trees need a bin for every label of a category
        labels = max([len(v) for s in fm.stages if isinstance(s, StringIndexerModel) for v in s.labelsArray], default=0)
        params = {"maxBins": max(32, labels + 2)} | params
    cv = cross_validate(x.withColumnRenamed(id_col, "id"), label, task, family, k, seed, **params)
    ho = fm.transform(transform(holdout)).select(F.col(id_col).alias("id"), F.col(label).cast("double").alias(label), FEATURES)
    scored = predict_ensemble(cv.models, ho, task, "score").drop(FEATURES).checkpoint(eager=True)
    metrics = rmse(scored, "score", label)
    return scored, roc_auc(scored, "score", label).crossJoin(metrics) if task == "binary" else metrics


# ---------------------------------------------------------------- importance, search, contract

def feature_importances(model, features: list[str]) -> list[tuple[str, float]]:
    """``(feature, importance)`` sorted by importance, then name."""
    imp = model.featureImportances.toArray()
    return sorted(zip(features, [float(v) for v in imp]), key=lambda t: (-t[1], t[0]))


def _first_by_hash(df: DataFrame, n: int, seed) -> DataFrame:
    """``min(n, rows)`` rows, those whose row number has the smallest hash, written. One pass writes the rows below a bound
    of the hash that should hold some more than ``n``; if it holds fewer, a wider one does. The table itself is not copied."""
    rows = df.count()
    share = (n + 10 * math.sqrt(n) + 100) / max(rows, 1)
    while True:
        numbered = df.withColumn("_row", F.monotonically_increasing_id())
        if share < 1:
            numbered = numbered.where(hash_key("_row", seed) < F.lit(f"{int(share * 2 ** 32):08x}"))
        some = written(numbered, "importance-rows")
        if share >= 1 or some.count() >= n:
            return written(sample_n(some, n, "_row", seed).drop("_row"), "importance-sample")
        share *= 2


def top_features_by_importance(df: DataFrame, features: list[str], target: str, n: int = 6,
                               rounds: int = 100, depth: int = 5, seed=42, fit_rows: int | None = None) -> list[str]:
    """K3: the ``n`` most important features of a boosted-tree regressor; ``fit_rows`` bounds the rows it learns from."""
    if fit_rows is not None:
        df = _first_by_hash(df, fit_rows, seed)
    x = VectorAssembler(inputCols=features, outputCol=FEATURES, handleInvalid="keep").transform(df)
    m = GBTRegressor(featuresCol=FEATURES, labelCol=target, maxIter=rounds, maxDepth=depth, stepSize=0.1, seed=seed).fit(x)
    return [f for f, _ in feature_importances(m, features)[:n]]


def random_search_grid(space: dict, trials: int, seed=42, start: dict | None = None) -> list[dict]:
    """Seeded random points of a search space. Each entry of ``space`` is
    ``("loguniform", lo, hi)``, ``("uniform", lo, hi)``, ``("int", lo, hi)``, ``("choice", [..])`` or
    ``("branch", {name: space})``: one of the nested spaces is chosen, and only its parameters are drawn.
    ``start`` (clamped into the ranges, its branch being the first that holds all its nested names) is the first point."""
    rng = random.Random(seed)

    def draw(space):
        point = {}
        for name, spec in space.items():
            kind = spec[0]
            if kind == "branch":
                point |= draw(spec[1][rng.choice(sorted(spec[1]))])
            elif kind == "loguniform":
                point[name] = math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2])))
            elif kind == "uniform":
                point[name] = rng.uniform(spec[1], spec[2])
            elif kind == "int":
                point[name] = rng.randint(spec[1], spec[2])
            else:
                point[name] = rng.choice(spec[1])
        return point

    def clamped(space, values):
        point = {}
        for name, spec in space.items():
            if spec[0] == "branch":
                nested = {n for sub in spec[1].values() for n in sub} & set(values)
                for sub in sorted(spec[1]):
                    if nested <= set(spec[1][sub]):
                        point |= clamped(spec[1][sub], values)
                        break
            elif name in values:
                v = values[name]
                point[name] = v if spec[0] == "choice" else min(max(v, spec[1]), spec[2])
        return point

    pts = [clamped(space, start)] if start else []
    while len(pts) < trials:
        pts.append(draw(space))
    return pts


def parameter_search(x: DataFrame, label: str, task: str, space: dict, trials: int = 10, seed=42,
                     parallelism: int = PARALLEL_FITS, family: str = "gbt", start: dict | None = None, **fixed):
    """The start point and random points -> parameter maps -> ``CrossValidator(foldCol='fold')``; ``fixed`` parameters hold for
    all points. Points that can learn from cells of a large table (``drawn_cells``, made once per ``maxBins``) are fitted and evaluated
    on them, fold by fold: a row and its cell get the same score. Returns ``(best_params, points, metrics_per_point, cv_model)``."""
    est = estimator(family, task, label, seed, **fixed)
    points = random_search_grid(space, trials, seed, start)
    maps = [{est.getParam(k): v for k, v in p.items()} for p in points]
    ev = (BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="prediction__raw", metricName="areaUnderROC")
          if task == "binary" else RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse"))
    folds = int(x.agg(F.max("fold")).first()[0]) + 1
    learners = [est.copy(m) for m in maps]
    where = {}  # point: its cells and its number among the learners of these cells
    if family == "gbt":
        for bins in sorted({e.getMaxBins() for e in learners}):
            same = [i for i, e in enumerate(learners) if e.getMaxBins() == bins]
            cells = drawn_cells(x, [learners[i] for i in same], ["fold"])
            where |= {} if cells is None else {i: (cells, j) for j, i in enumerate(same)}
    rest = [i for i in range(len(points)) if i not in where]
    cv = CrossValidator(estimator=est, estimatorParamMaps=[maps[i] for i in rest] or maps, evaluator=ev, foldCol="fold", numFolds=folds,
                        parallelism=parallelism, seed=seed)
    if len(rest) == len(points):
        cvm = cv.fit(x)
        metrics, spread = list(cvm.avgMetrics), list(cvm.stdMetrics)
    else:
        weighted = ev.copy({ev.weightCol: "_n"})

        def one(task):
            i, f = task
            cells, j = where[i]
            held, other = F.col("fold") == f, F.col("fold") != f
            return weighted.evaluate(fit_drawn(learners[i], cells.where(other), j).transform(cells.where(held).select(label, FEATURES, "_n")))
        tasks = [(i, f) for i in sorted(where) for f in range(folds)]
        found = dict(zip(tasks, side_by_side(one, tasks, max(parallelism, PARALLEL_DRAWN_FITS)), strict=True))
        metrics, spread = [0.0] * len(points), [0.0] * len(points)
        for i in where:
            each = [found[i, f] for f in range(folds)]
            metrics[i] = statistics.fmean(each)
            spread[i] = statistics.pstdev(each)
        if rest:
            cvm = cv.fit(x)
            for i, m, d in zip(rest, cvm.avgMetrics, cvm.stdMetrics, strict=True):
                metrics[i], spread[i] = m, d
    pick = max if task == "binary" else min
    best = pick(range(len(metrics)), key=lambda i: metrics[i])
    if best in where:
        cvm = cv._copyValues(CrossValidatorModel(fit_drawn(learners[best], *where[best]), metrics, None, spread))
    elif len(rest) < len(points):
        cvm = cv._copyValues(CrossValidatorModel(cvm.bestModel, metrics, None, spread))
    return points[best], points, metrics, cvm


@dataclass
class ScoringContract:
    """What a saved model expects; checked before scoring."""
    features: list[str]
    categorical: list[str]
    target: str
    spark_version: str = ""

    def to_json(self) -> str:
        return json.dumps(self.__dict__, sort_keys=True)

    @classmethod
    def from_json(cls, s: str) -> "ScoringContract":
        return cls(**json.loads(s))

    def save(self, spark: SparkSession, path: str) -> str:
        spark.createDataFrame([(self.to_json(),)], "contract string").coalesce(1).write.mode("overwrite").parquet(path)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ScoringContract":
        return cls.from_json(spark.read.parquet(path).first()["contract"])

    def check(self, df: DataFrame) -> DataFrame:
        """Raise if a feature is missing; return the features in the stored order (plus ``id`` if present)."""
        missing = [c for c in self.features if c not in df.columns]
        if missing:
            raise ValueError(f"missing features for scoring: {missing}")
        keep = (["id"] if "id" in df.columns else []) + self.features
        return df.select(*keep)


def save_models(models: dict, path: str) -> dict:
    """One saved model per (family, fold) under ``<path>/<family>/fold=<k>``."""
    out = {}
    for (family, fold), m in models.items():
        p = f"{path.rstrip('/')}/{family}/fold={fold}"
        m.write().overwrite().save(p)
        out[(family, fold)] = p
    spark = SparkSession.getActiveSession()
    rows = [(family, fold, f"{type(m).__module__}.{type(m).__name__}") for (family, fold), m in models.items()]
    spark.createDataFrame(rows, "family string, fold int, kind string").coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/manifest")
    return out


def load_model_folder(spark: SparkSession, path: str) -> dict:
    """Every model saved under ``path``, by (family, fold), from the folder alone."""
    kinds = {f"{k.__module__}.{k.__name__}": k for k in (
        GBTClassificationModel, GBTRegressionModel, RandomForestClassificationModel, RandomForestRegressionModel,
        LogisticRegressionModel, LinearRegressionModel)}
    rows = spark.read.parquet(f"{path.rstrip('/')}/manifest").collect()  # one row per model
    return {(r.family, r.fold): kinds[r.kind].load(f"{path.rstrip('/')}/{r.family}/fold={r.fold}") for r in rows}


def load_models(paths: dict, kinds: dict) -> dict:
    """Reload with the model class given per family."""
    return {key: kinds[key[0]].load(p) for key, p in paths.items()}

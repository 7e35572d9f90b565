"""Model scores as aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lathe.operators.ranks import rank_distinct, range_cuts, qcut_edges, qcut_code


def rmse(df: DataFrame, pred: str, label: str, by=None) -> DataFrame:
    """``sqrt(mean((p - y)^2))`` overall or per group (e.g. per fold)."""
    by = [by] if isinstance(by, str) else list(by or [])
    e = F.pow(F.col(pred).cast("double") - F.col(label).cast("double"), 2)
    return df.groupBy(*by).agg(F.sqrt(F.avg(e)).alias("rmse"), F.count(e).alias("n"))


def roc_auc(df: DataFrame, score: str, label: str, by=None) -> DataFrame:
    """Rank AUC with ties counted half:
    ``(sum of positive ranks - n1 (n1 + 1) / 2) / (n1 n0)``; NULL with one class only.

    The rows collapse to one row per distinct score with positive/negative
    counts, the average rank per distinct score comes from the bucketed rank
    plan, and one aggregation finishes it; no row-level sort."""
    by = [by] if isinstance(by, str) else list(by or [])
    y = F.col(label).cast("double")
    base = df.where(F.col(score).isNotNull() & y.isNotNull()).select(*by, F.col(score).cast("double").alias("_s"),
                                                                     y.alias("_y"))
    hist = base.groupBy(*by, "_s").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("_y") == 1, 1).otherwise(0)).alias("_pos"))
    ranked = rank_distinct(hist, by, "_s", cuts=range_cuts(base, "_s"))
    agg = ranked.groupBy(*by).agg(F.sum(F.col("avg_rank") * F.col("_pos")).alias("_rs"),
                                  F.sum("_pos").alias("_n1"), F.sum(F.col("n") - F.col("_pos")).alias("_n0"))
    auc = F.try_divide(F.col("_rs") - F.col("_n1") * (F.col("_n1") + 1) / 2.0, F.col("_n1") * F.col("_n0"))
    return agg.select(*by, F.when((F.col("_n1") > 0) & (F.col("_n0") > 0), auc).alias("auc"))


def mean_predictions(df: DataFrame, cols: list[str], out: str = "prediction") -> DataFrame:
    """A34 (wide form): average of several prediction columns."""
    s = sum((F.col(c).cast("double") for c in cols), F.lit(0.0))
    return df.withColumn(out, s / len(cols))


def mean_predictions_long(df: DataFrame, key: str, pred: str = "prediction") -> DataFrame:
    """A34 (long form): ``(key, prediction)`` rows from many models averaged per key."""
    return df.groupBy(key).agg(F.avg(F.col(pred).cast("double")).alias(pred))


def threshold_table(df: DataFrame, score: str, label: str, bins: int = 1000) -> DataFrame:
    """T5: precision and recall at each score threshold ``t = k / bins`` (score >= t) for
    scores in [0, 1]; a histogram of at most ``bins + 1`` rows and running sums over it."""
    s = F.least(F.greatest(F.col(score).cast("double"), F.lit(0.0)), F.lit(1.0))
    b = F.floor(s * bins).cast("int")
    h = df.where(F.col(score).isNotNull()).groupBy(b.alias("bin")).agg(
        F.count_if(F.col(label) == 1).alias("_tp"), F.count_if(F.col(label) != 1).alias("_fp"))
    # the window sees at most bins + 1 rows
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    tot = h.agg(F.sum("_tp").alias("_P"))
    c = h.select("bin", F.sum("_tp").over(w).alias("tp"), F.sum("_fp").over(w).alias("fp")).crossJoin(F.broadcast(tot))
    return c.select((F.col("bin") / bins).alias("threshold"), "tp", "fp",
                    F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")).alias("precision"),
                    F.try_divide(F.col("tp").cast("double"), F.col("_P")).alias("recall"))


def residual_bins(df: DataFrame, pred: str, label: str, by_col: str | None = None, q: int = 10,
                  mode: str = "auto") -> DataFrame:
    """Quantile bins of the prediction (or of ``by_col``) with mean error and RMSE per bin."""
    x = by_col or pred
    edges = qcut_edges(df, x, q, mode=mode)
    j = df.crossJoin(F.broadcast(edges))
    err = F.col(pred).cast("double") - F.col(label).cast("double")
    return j.groupBy(qcut_code(F.col(x).cast("double"), F.col("edges")).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(err).alias("mean_error"), F.sqrt(F.avg(err * err)).alias("rmse"))

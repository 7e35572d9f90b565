"""Operators the reference's prose asks for (T7, T9); T1-T6 and T8 live with their kin."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.operators.ranks import quantiles, unpivot_values


def constant_and_extreme(df: DataFrame, cols: list[str], top_share: float = 0.95, mode: str = "auto") -> DataFrame:
    """Per numeric column: constant (<= 1 distinct value, or the top value's share above
    ``top_share``), the top share, and the count of values outside 1.5 IQR of the quartiles."""
    long_df = unpivot_values(df, cols)
    vc = long_df.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    s = vc.groupBy("column").agg(F.count(F.lit(1)).alias("nd"), (F.max("n") / F.sum("n")).alias("top_share"))
    q = quantiles(df, cols, [0.25, 0.75], mode=mode).groupBy("column").agg(
        F.max(F.when(F.col("q_index") == 0, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("q_index") == 1, F.col("value"))).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    out_of = (F.col("value") < F.col("q1") - 1.5 * iqr) | (F.col("value") > F.col("q3") + 1.5 * iqr)
    ext = vc.join(F.broadcast(q), "column").groupBy("column").agg(F.sum(F.when(out_of, F.col("n")).otherwise(0)).alias("extreme"))
    return s.join(ext, "column").select("column", ((F.col("nd") <= 1) | (F.col("top_share") > top_share)).alias("constant"),
                                        "top_share", F.col("extreme").cast("long"))


def drift_check(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Category shares in two tables side by side (full outer join on the value)."""
    def shares(df, name):
        g = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("_n"))
        tot = g.agg(F.sum("_n").alias("_t"))
        return g.crossJoin(F.broadcast(tot)).select("value", (F.col("_n") / F.col("_t")).alias(name))
    j = shares(a, "share_a").join(shares(b, "share_b"), "value", "full_outer")
    return j.select("value", F.coalesce("share_a", F.lit(0.0)).alias("share_a"), F.coalesce("share_b", F.lit(0.0)).alias("share_b"),
                    (F.coalesce("share_a", F.lit(0.0)) - F.coalesce("share_b", F.lit(0.0))).alias("diff"))

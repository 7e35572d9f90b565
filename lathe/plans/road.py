"""Road-segment features (X7): the table written once when its own bin edges are wanted, the edges, then one projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.functions import scalars as S
from lathe.operators.encode import LabelEncoderModel, cast_category, fit_label_encoder
from lathe.operators.ranks import quantile_map
from lathe.session import written

# fixed values: the curvature bin grid and labels, and the categorical outputs
CURVATURE_PROBS = [0.0, 0.25, 0.75, 1.0]
CURVATURE_LABELS = ["low", "medium", "high"]
CATEGORICAL = ["road_type", "lighting", "weather", "time_of_day", "holiday_x_lighting",
               "weather_lighting", "curvature_bin", "speed_x_curvature_bin"]


@dataclass
class QuantileBinner:
    """labelled quantile bins with the fallback of the reference: fewer than 2 distinct
    values, fewer than 6 rows, or edges lost to duplicates -> every row gets the middle label;
    a missing value gets the text ``nan``."""
    col: str
    edges: list[float] | None
    labels: list[str]

    def expr(self) -> F.Column:
        mid = self.labels[len(self.labels) // 2]
        x = F.col(self.col).cast("double")
        if self.edges is None:
            return F.lit(mid)
        e = self.edges
        out = F.when(x.isNull(), F.lit("nan"))
        for i, lab in enumerate(self.labels):
            lo, hi = e[i], e[i + 1]
            cond = (x >= lo) & (x <= hi) if i == 0 else (x > lo) & (x <= hi)
            out = out.when(cond, F.lit(lab))
        return out.otherwise(F.lit("nan"))


def fit_quantile_binner(df: DataFrame, col: str, probs=CURVATURE_PROBS, labels=CURVATURE_LABELS,
                        mode: str = "auto") -> QuantileBinner:
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(col).alias("nd")).first()
    if row["nd"] < 2 or row["n"] < 6:
        return QuantileBinner(col, None, labels)
    qm = quantile_map(df, [col], probs, mode)
    edges = sorted({qm[(col, round(p, 12))] for p in probs})
    if len(edges) != len(labels) + 1:
        return QuantileBinner(col, None, labels)
    return QuantileBinner(col, edges, labels)


def fit_road_categories(features: DataFrame) -> dict[str, LabelEncoderModel]:
    """P21 state of the road table: sorted categories of each categorical output, fitted on a transformed table;
    a label that the table did not hold gets no code."""
    return {c: fit_label_encoder(features, c, handle_invalid="null") for c in CATEGORICAL if c in features.columns}


@dataclass
class RoadFeaturesModel:
    binner: QuantileBinner | None = None   # fitted edges (Q6 fitted=True); None = per-table edges
    categories: dict[str, LabelEncoderModel] | None = None   # fitted codes; None = the labels themselves

    def transform(self, df: DataFrame, drop_duplicates: bool = False, mode: str = "auto") -> DataFrame:
        d = df.dropDuplicates() if drop_duplicates else df
        if self.binner is None:  # the edges take several scans: what the table is made of (joins, distinct rows) runs once
            d = written(d, "road")
        binner = self.binner or fit_quantile_binner(d, "curvature", mode=mode)
        cols = {c: F.col(c) for c in d.columns}
        cb = binner.expr()
        cols["speed_curvature_ratio"] = S.eps_ratio("speed_limit", "curvature", 1e-6)
        cols["weather_lighting"] = S.string_interaction("weather", "lighting")
        cols["curvature_bin"] = cb
        cols["curvature_sq"] = S.square("curvature")
        cols["speed_limit_sq"] = F.col("speed_limit") * F.col("speed_limit")
        cols["speed_x_curvature_bin"] = S.string_interaction("speed_limit", cb)
        cols["holiday_x_lighting"] = S.string_interaction("holiday", "lighting")
        types = dict(d.dtypes)
        for c, t in types.items():          # P16
            if t == "boolean":
                cols[c] = F.col(c).cast("int")
        out = d.select(*[e.alias(n) for n, e in cols.items()])
        return cast_category(out, self.categories) if self.categories else out


def road_like(li: DataFrame, orders: DataFrame) -> DataFrame:
    """A road-segment shaped table built from ``lineitem`` x ``orders`` (fixture mapping)."""
    j = li.join(orders, li.l_orderkey == orders.o_orderkey)
    tod = F.element_at(F.array(F.lit("morning"), F.lit("afternoon"), F.lit("evening")), (F.col("l_linenumber") % 3 + 1).cast("int"))
    return j.select(
        F.col("l_returnflag").alias("road_type"), F.col("l_linestatus").alias("lighting"),
        F.col("o_orderstatus").alias("weather"), tod.alias("time_of_day"),
        F.col("l_linenumber").alias("num_lanes"), (F.col("l_discount") * 10).alias("curvature"),
        F.col("l_quantity").cast("int").alias("speed_limit"), (F.col("l_tax") > 0.04).alias("road_signs_present"),
        (F.col("l_quantity") > 25).alias("public_road"), (F.col("o_orderpriority") == "1-URGENT").alias("holiday"),
        (F.col("l_discount") > 0.05).alias("school_season"), (F.col("l_linenumber") % 3).alias("num_reported_accidents"),
        (F.col("l_extendedprice") / 131072.0).alias("accident_risk"))

"""Fit/transform queries: fitted state, winsorizing, robust scaling."""

from pyspark.sql import functions as F

from lathe.operators.stats import Winsorizer
from lathe.registry.base import register, table, r6

_LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _sql_clip(cols, lo=0.002, hi=0.998, key="l_orderkey, l_linenumber, l_shipdate", tbl="lineitem"):
    b = ", ".join(f"quantile_cont({c}, {lo}) AS {c}_lo, quantile_cont({c}, {hi}) AS {c}_hi" for c in cols)
    sel = ", ".join(f"round(least(greatest({c}, {c}_lo), {c}_hi), 6) + 0.0 AS {c}" for c in cols)
    return f"WITH b AS (SELECT {b} FROM {tbl}) SELECT {key}, {sel} FROM {tbl}, b"


def winsorize_lineitem(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", *_LI_NUM)
    model = Winsorizer(_LI_NUM, 0.002, 0.998).fit(li)
    out = model.transform(li)
    return out.select("l_orderkey", "l_linenumber", "l_shipdate", *[r6(c).alias(c) for c in _LI_NUM])


register("x1_winsorize", _sql_clip(_LI_NUM))(winsorize_lineitem)

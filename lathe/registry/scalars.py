"""Row-level feature expressions (F1-F31, P12-P17) checked on the driver tables."""

from pyspark.sql import functions as F

from lathe.functions import scalars as S
from lathe.registry.base import register, table, r6

LI_KEY = "l_orderkey, l_linenumber"


def _li(spark, sf):
    return table(spark, sf, "lineitem")


def _sql_li(select: str, where: str = "") -> str:
    return f"SELECT {LI_KEY}, {select} FROM lineitem {where}"


def _ln1p(x: str) -> str:
    return f"(CASE WHEN {x} > -1 THEN ln(1 + ({x})) END)"


@register("f1_log1p", _sql_li(f"round({_ln1p('l_extendedprice')}, 6) + 0.0 AS v, "
                              f"round({_ln1p('l_discount * -20')}, 6) + 0.0 AS w"))
def f1_log1p(spark, sf):
    li = _li(spark, sf)
    return li.select("l_orderkey", "l_linenumber", r6(S.log1p("l_extendedprice")).alias("v"),
                     r6(S.log1p(F.col("l_discount") * -20)).alias("w"))


@register("f2_guarded_log1p", "SELECT c_custkey, CAST(c_acctbal > 0 AS TINYINT) AS any_pos, "
          f"round(CASE WHEN c_acctbal > 0 THEN {_ln1p('c_acctbal')} ELSE 0.0 END, 6) + 0.0 AS log_pos "
          "FROM customer")
def f2_guarded_log1p(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", S.any_flag("c_acctbal").alias("any_pos"),
                    r6(S.guarded_log1p("c_acctbal")).alias("log_pos"))


@register("f3_asinh", _sql_li("round(asinh(l_extendedprice - 50000), 6) + 0.0 AS v"))
def f3_asinh(spark, sf):
    return _li(spark, sf).select("l_orderkey", "l_linenumber",
                                 r6(S.asinh(F.col("l_extendedprice") - 50000)).alias("v"))


@register("f4_square", _sql_li("round(l_quantity * l_quantity, 6) + 0.0 AS v"))
def f4_square(spark, sf):
    return _li(spark, sf).select("l_orderkey", "l_linenumber", r6(S.square("l_quantity")).alias("v"))


@register("f5_sqrt_clipped", "SELECT o_orderkey, round(sqrt(greatest(o_totalprice - 100000, 0)), 6) + 0.0 AS s, "
          "round(pow(greatest(sqrt(greatest(o_totalprice - 100000, 0)), 0), 2), 4) + 0.0 AS back FROM orders")
def f5_sqrt_clipped(spark, sf):
    o = table(spark, sf, "orders")
    s = S.sqrt_clipped(F.col("o_totalprice") - 100000)
    return o.select("o_orderkey", r6(s).alias("s"), r6(S.square_clipped(s), 4).alias("back"))


@register("f6_expm1_clipped", "SELECT o_orderkey, round(greatest(exp(ln(1 + o_totalprice / 1e5) - 1.5) - 1, 0), 6) + 0.0 AS v "
          "FROM orders")
def f6_expm1_clipped(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", r6(S.expm1_clipped(F.log1p(F.col("o_totalprice") / 1e5) - 1.5)).alias("v"))


@register("f7_target_modes", "SELECT o_orderkey, round(o_totalprice, 6) + 0.0 AS raw, "
          "round(sqrt(greatest(o_totalprice, 0)), 6) + 0.0 AS sq, "
          f"round({_ln1p('greatest(o_totalprice, 0)')}, 6) + 0.0 AS lg, "
          "round(pow(sqrt(greatest(o_totalprice, 0)), 2), 4) + 0.0 AS sq_back, "
          f"round(greatest(exp({_ln1p('greatest(o_totalprice, 0)')}) - 1, 0), 4) + 0.0 AS lg_back FROM orders")
def f7_target_modes(spark, sf):
    o = table(spark, sf, "orders")
    y = F.col("o_totalprice")
    return o.select("o_orderkey", r6(S.to_model_space(y, "raw")).alias("raw"),
                    r6(S.to_model_space(y, "sqrt")).alias("sq"), r6(S.to_model_space(y, "log1p")).alias("lg"),
                    r6(S.from_model_space(S.to_model_space(y, "sqrt"), "sqrt"), 4).alias("sq_back"),
                    r6(S.from_model_space(S.to_model_space(y, "log1p"), "log1p"), 4).alias("lg_back"))


@register("f8_clip_two_sided", _sql_li("round(CASE WHEN l_discount = 0 THEN NULL ELSE least(greatest(l_extendedprice, 5000), 80000) END, 6) + 0.0 AS v"))
def f8_clip(spark, sf):
    x = F.when(F.col("l_discount") != 0, F.col("l_extendedprice"))
    return _li(spark, sf).select("l_orderkey", "l_linenumber", r6(S.clip(x, 5000.0, 80000.0)).alias("v"))


@register("f9_clip_upper", "WITH q AS (SELECT quantile_cont(l_extendedprice, 0.99) AS hi FROM lineitem) "
          + _sql_li("round(least(l_extendedprice, hi), 6) + 0.0 AS v", "").replace("FROM lineitem", "FROM lineitem, q"))
def f9_clip_upper(spark, sf):
    from lathe.operators.ranks import quantile_map
    li = _li(spark, sf)
    hi = quantile_map(li, ["l_extendedprice"], [0.99])[("l_extendedprice", 0.99)]
    return li.select("l_orderkey", "l_linenumber", r6(S.clip("l_extendedprice", None, hi)).alias("v"))


@register("f10_f11_products_differences",
          _sql_li("round(l_quantity * l_tax, 6) + 0.0 AS prod_qt, round(l_discount * 10 * l_tax, 6) + 0.0 AS prod_dt, "
                  "round(l_quantity - l_tax, 6) + 0.0 AS diff_qt"))
def f10_products(spark, sf):
    li = _li(spark, sf)
    return li.select("l_orderkey", "l_linenumber", r6(S.product("l_quantity", "l_tax")).alias("prod_qt"),
                     r6(S.product(F.col("l_discount") * 10, "l_tax")).alias("prod_dt"),
                     r6(S.difference("l_quantity", "l_tax")).alias("diff_qt"))


@register("f12_plain_ratio", "SELECT c_custkey, round(c_acctbal / nullif(c_nationkey, 0), 6) + 0.0 AS per_nation FROM customer")
def f12_ratio(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", r6(S.ratio("c_acctbal", "c_nationkey")).alias("per_nation"))


@register("f13_eps_ratio", _sql_li("round(l_quantity / (l_discount + 1e-6), 4) + 0.0 AS v"))
def f13_eps_ratio(spark, sf):
    return _li(spark, sf).select("l_orderkey", "l_linenumber", r6(S.eps_ratio("l_quantity", "l_discount"), 4).alias("v"))


@register("f15_f16_log_ratio_relative",
          _sql_li(f"round({_ln1p('l_quantity')} - {_ln1p('l_tax + 1e-9')}, 6) + 0.0 AS log_ratio, "
                  "round((l_quantity - l_tax) / (l_quantity + l_tax + 1e-9), 6) + 0.0 AS rel"))
def f15_log_ratio(spark, sf):
    li = _li(spark, sf)
    return li.select("l_orderkey", "l_linenumber", r6(S.log_ratio("l_quantity", "l_tax")).alias("log_ratio"),
                     r6(S.relative_difference("l_quantity", "l_tax")).alias("rel"))


@register("f17_hinges", _sql_li("round(greatest(l_discount * 10 - 0.7, 0), 6) + 0.0 AS high_e, "
                                "round(greatest(0.3 - l_discount * 10, 0), 6) + 0.0 AS low_e"))
def f17_hinges(spark, sf):
    e = F.col("l_discount") * 10
    return _li(spark, sf).select("l_orderkey", "l_linenumber", r6(S.hinge_above(e, 0.7)).alias("high_e"),
                                 r6(S.hinge_below(e, 0.3)).alias("low_e"))


@register("f18_threshold_flag", "WITH q AS (SELECT quantile_cont(ln(1 + l_extendedprice), 0.95) AS t FROM lineitem) "
          "SELECT l_orderkey, l_linenumber, CAST(CASE WHEN t > 0 THEN CAST(ln(1 + l_extendedprice) > t AS INT) END AS TINYINT) AS long_flag "
          "FROM lineitem, q")
def f18_threshold(spark, sf):
    from lathe.operators.ranks import quantile_map
    li = _li(spark, sf).withColumn("_lg", S.log1p("l_extendedprice"))
    t = quantile_map(li, ["_lg"], [0.95])[("_lg", 0.95)]
    flag = S.threshold_flag("_lg", t) if t and t > 0 else F.lit(None).cast("tinyint")
    return li.select("l_orderkey", "l_linenumber", flag.alias("long_flag"))


@register("f19_negate", "SELECT c_custkey, round(-c_acctbal, 6) + 0.0 AS mag FROM customer")
def f19_negate(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", r6(S.negate("c_acctbal")).alias("mag"))


_PD = ("CASE WHEN l_discount = 0 THEN -1 ELSE date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) END")


def _pdays(li):
    return li.withColumn("pdays", F.when(F.col("l_discount") == 0, F.lit(-1))
                         .otherwise(F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date"))))


@register("f21_fixed_bins", f"""SELECT l_orderkey, l_linenumber, CASE
  WHEN p > -2 AND p <= 0 THEN 'NotContacted' WHEN p > 0 AND p <= 90 THEN 'Recent'
  WHEN p > 90 AND p <= 180 THEN 'WithinHalfYear' WHEN p > 180 AND p <= 365 THEN 'WithinYear'
  WHEN p > 365 AND p <= 1000 THEN 'LongAgo' END AS pdays_binned
FROM (SELECT *, coalesce({_PD}, -1) AS p FROM lineitem)""")
def f21_fixed_bins(spark, sf):
    li = _pdays(_li(spark, sf))
    return li.select("l_orderkey", "l_linenumber",
                     S.fixed_bins(F.coalesce("pdays", F.lit(-1)), S.PDAYS_EDGES, S.PDAYS_LABELS).alias("pdays_binned"))


@register("p12_sentinel_to_null", f"""SELECT l_orderkey, l_linenumber, CAST(nullif({_PD}, -1) AS INT) AS pdays,
  CAST(nullif({_PD}, -1) IS NULL AS TINYINT) AS pdays_missing FROM lineitem""")
def p12_sentinel(spark, sf):
    li = _pdays(_li(spark, sf))
    p = S.sentinel_to_null("pdays", -1)
    return li.select("l_orderkey", "l_linenumber", p.alias("pdays"), S.missing_flag(p).alias("pdays_missing"))


@register("p13_coerce_numeric", """SELECT o_orderkey, round(try_cast(replace(
  CASE WHEN o_orderkey % 7 = 0 THEN 'abc' WHEN o_orderkey % 11 = 0 THEN '' ELSE format('{:,.2f}', o_totalprice) END,
  ',', '') AS DOUBLE), 6) + 0.0 AS v FROM orders""")
def p13_coerce(spark, sf):
    o = table(spark, sf, "orders")
    txt = (F.when(F.col("o_orderkey") % 7 == 0, F.lit("abc")).when(F.col("o_orderkey") % 11 == 0, F.lit(""))
           .otherwise(F.format_number("o_totalprice", 2)))
    return o.select("o_orderkey", r6(S.coerce_numeric(txt)).alias("v"))


_YN = "CASE WHEN o_orderstatus = 'F' THEN 'Yes' WHEN o_orderstatus = 'O' THEN 'no' ELSE 'maybe' END"


@register("p17_map_yes_no", f"""SELECT o_orderkey, CAST(CASE WHEN lower({_YN}) = 'yes' THEN 1 WHEN lower({_YN}) = 'no' THEN 0 END AS TINYINT) AS flag
FROM orders""")
def p17_yes_no(spark, sf):
    o = table(spark, sf, "orders")
    yn = (F.when(F.col("o_orderstatus") == "F", "Yes").when(F.col("o_orderstatus") == "O", "no").otherwise("maybe"))
    return o.select("o_orderkey", S.yes_no(yn).alias("flag"))


@register("f23_string_interaction", """SELECT o_orderkey, concat_ws('_', o_orderstatus, o_orderpriority) AS status_priority,
  concat_ws('_', CASE WHEN o_totalprice > 150000 THEN 'True' ELSE 'False' END, o_orderstatus) AS big_status FROM orders""")
def f23_interaction(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", S.string_interaction("o_orderstatus", "o_orderpriority").alias("status_priority"),
                    S.string_interaction(S.bool_text(F.col("o_totalprice") > 150000), "o_orderstatus").alias("big_status"))


@register("f24_f25_lower_unknown_flag", """SELECT c_custkey, lower(c_mktsegment) AS seg,
  CAST(c_mktsegment = 'MACHINERY' AS TINYINT) AS is_machinery FROM customer""")
def f24_lower(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", S.lower("c_mktsegment").alias("seg"),
                    S.equals_flag("c_mktsegment", "MACHINERY").alias("is_machinery"))


_MON = ("CASE WHEN o_orderkey % 97 = 0 THEN 'xyz' WHEN o_orderkey % 5 = 0 THEN upper(strftime(o_orderdate, '%b')) "
        "ELSE lower(strftime(o_orderdate, '%b')) END")
_DAY = "(dayofmonth(o_orderdate) + o_orderkey % 4)"


def dirty_calendar(o):
    """Month names (some upper case, some unknown) and days that may exceed the month."""
    mon = F.lower(F.date_format("o_orderdate", "MMM"))
    mon = (F.when(F.col("o_orderkey") % 97 == 0, F.lit("xyz")).when(F.col("o_orderkey") % 5 == 0, F.upper(mon))
           .otherwise(mon))
    return o.withColumn("month", mon).withColumn("day", (F.dayofmonth("o_orderdate") + F.col("o_orderkey") % 4).cast("int"))


_MONTH_CASE = ("CASE lower(month) WHEN 'jan' THEN 1 WHEN 'feb' THEN 2 WHEN 'mar' THEN 3 WHEN 'apr' THEN 4 "
               "WHEN 'may' THEN 5 WHEN 'jun' THEN 6 WHEN 'jul' THEN 7 WHEN 'aug' THEN 8 WHEN 'sep' THEN 9 "
               "WHEN 'oct' THEN 10 WHEN 'nov' THEN 11 WHEN 'dec' THEN 12 END")
CAL_SQL = f"""WITH d AS (SELECT o_orderkey, {_MON} AS month, CAST({_DAY} AS INT) AS day FROM orders),
m AS (SELECT *, {_MONTH_CASE} AS mnum FROM d),
e AS (SELECT *, CASE WHEN mnum IS NOT NULL THEN dayofmonth(last_day(make_date(2020, mnum, 1))) END AS mend FROM m),
s AS (SELECT *, CASE WHEN mnum IS NOT NULL THEN make_date(2020, mnum, least(greatest(day, 1), mend)) END AS dt FROM e)"""


@register("f26_f30_calendar", CAL_SQL + """
SELECT o_orderkey, mnum AS month_num, CAST(dayofyear(dt) AS INT) AS day_of_year,
  round(sin(2 * pi() * dayofyear(dt) / 366.0), 6) + 0.0 AS day_sin,
  round(cos(2 * pi() * dayofyear(dt) / 366.0), 6) + 0.0 AS day_cos,
  CASE WHEN mnum IS NOT NULL THEN CAST(day < 1 OR day > mend AS INT) END AS invalid_day FROM s""")
def f26_calendar(spark, sf):
    o = dirty_calendar(table(spark, sf, "orders"))
    m = S.month_number("month")
    dt = S.safe_date(m, "day")
    return o.select("o_orderkey", m.alias("month_num"), S.day_of_year(dt).alias("day_of_year"),
                    r6(S.cyclic_sin(S.day_of_year(dt))).alias("day_sin"),
                    r6(S.cyclic_cos(S.day_of_year(dt))).alias("day_cos"),
                    S.invalid_date(m, "day").cast("int").alias("invalid_day"))


@register("f30_invalid_date_filter", CAL_SQL + " SELECT o_orderkey, month, day FROM s WHERE day < 1 OR day > mend")
def f30_invalid_filter(spark, sf):
    o = dirty_calendar(table(spark, sf, "orders"))
    return o.where(S.invalid_date(S.month_number("month"), "day")).select("o_orderkey", "month", "day")


@register("f31_pair_products", _sql_li('round(l_quantity * l_discount, 6) + 0.0 AS "l_quantity l_discount", '
                                      'round(l_quantity * l_tax, 6) + 0.0 AS "l_quantity l_tax", '
                                      'round(l_discount * l_tax, 6) + 0.0 AS "l_discount l_tax"'))
def f31_pairs(spark, sf):
    li = _li(spark, sf)
    pp = S.pair_products(["l_quantity", "l_discount", "l_tax"], li.columns)
    return li.select("l_orderkey", "l_linenumber", *[r6(e).alias(n) for n, e in pp.items()])


@register("t4_equivalence_error", "SELECT o_orderkey, round(least(abs(o_totalprice * 0.9 - o_totalprice), "
          "abs(o_totalprice * 0.9 / 2 - o_totalprice), abs(o_totalprice * 0.9 * 2 - o_totalprice)), 4) + 0.0 AS err FROM orders")
def t4_equivalence(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", r6(S.equivalence_error(F.col("o_totalprice") * 0.9, "o_totalprice"), 4).alias("err"))


@register("f14_floored_clipped_ratio", """WITH f AS (SELECT quantile_cont(l_tax, 0.05) AS fl FROM lineitem),
r AS (SELECT l_orderkey, l_linenumber, l_quantity / greatest(l_tax, fl + 1e-9) AS ratio FROM lineitem, f),
b AS (SELECT quantile_cont(ratio, 0.01) AS lo, quantile_cont(ratio, 0.99) AS hi FROM r)
SELECT l_orderkey, l_linenumber, round(least(greatest(ratio, lo), hi), 4) + 0.0 AS v2i,
  round(ln(1 + least(greatest(ratio, lo), hi)), 6) + 0.0 AS v2i_log1p, round(asinh(least(greatest(ratio, lo), hi)), 6) + 0.0 AS v2i_asinh FROM r, b""")
def f14_floored_ratio(spark, sf):
    from lathe.operators.ranks import quantile_map
    li = _li(spark, sf)
    floor = quantile_map(li, ["l_tax"], [0.05])[("l_tax", 0.05)]
    raw = F.try_divide(F.col("l_quantity"), F.greatest(F.col("l_tax"), F.lit(floor + S.EPS)))
    b = quantile_map(li.select(raw.alias("r")), ["r"], [0.01, 0.99])
    v = S.floored_ratio("l_quantity", "l_tax", floor, b[("r", 0.01)], b[("r", 0.99)])
    return li.select("l_orderkey", "l_linenumber", r6(v, 4).alias("v2i"), r6(F.log1p(v)).alias("v2i_log1p"),
                     r6(S.asinh(v)).alias("v2i_asinh"))


@register("f20_robust_scale", """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.5) AS med, quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25) AS iqr,
  quantile_cont(l_tax, 0.5) AS tmed, quantile_cont(l_tax, 0.75) - quantile_cont(l_tax, 0.25) AS tiqr FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_extendedprice - med) / CASE WHEN iqr = 0 THEN 1.0 ELSE iqr END, 6) + 0.0 AS price_scaled,
  round((l_tax - tmed) / (tiqr + 1e-9), 6) + 0.0 AS tax_scaled_eps FROM lineitem, q""")
def f20_robust(spark, sf):
    from lathe.operators.stats import RobustScaler
    li = _li(spark, sf)
    m = RobustScaler(["l_extendedprice"]).fit(li)
    m2 = RobustScaler(["l_tax"], eps=1e-9).fit(li)
    return li.select("l_orderkey", "l_linenumber", r6(m.scaled("l_extendedprice")).alias("price_scaled"),
                     r6(m2.scaled("l_tax")).alias("tax_scaled_eps"))


@register("f22_quantile_bin_labels", """WITH q AS (SELECT list_sort(list_distinct(quantile_cont(o_totalprice, [0.0, 0.25, 0.75, 1.0]))) AS e FROM orders)
SELECT o_orderkey, CASE WHEN o_totalprice >= e[1] AND o_totalprice <= e[2] THEN 'low' WHEN o_totalprice > e[2] AND o_totalprice <= e[3] THEN 'medium'
  WHEN o_totalprice > e[3] AND o_totalprice <= e[4] THEN 'high' END AS price_band, 'medium' AS status_band FROM orders, q""")
def f22_bins(spark, sf):
    from lathe.plans.road import fit_quantile_binner
    o = table(spark, sf, "orders").withColumn("_const", F.lit(7.0))
    b = fit_quantile_binner(o, "o_totalprice")
    c = fit_quantile_binner(o, "_const")     # < 2 distinct values: every row gets the middle label
    return o.select("o_orderkey", b.expr().alias("price_band"), c.expr().alias("status_band"))


@register("f27_f28_f29_safe_date_cyclic", CAL_SQL + """
SELECT o_orderkey, CAST(dt AS VARCHAR) AS safe_date, CAST(dayofyear(dt) AS INT) AS day_of_year,
  round(sin(2 * pi() * dayofyear(dt) / 366.0), 6) + 0.0 AS day_sin, round(cos(2 * pi() * dayofyear(dt) / 366.0), 6) + 0.0 AS day_cos,
  CASE WHEN mnum IS NOT NULL THEN CAST(least(greatest(day, 1), mend) <> day AS INT) END AS adjusted FROM s""")
def f27_safe_date(spark, sf):
    """F27 safe date from (2020, month, clipped day), F28 day of year, F29 cyclic encoding."""
    o = dirty_calendar(table(spark, sf, "orders"))
    m = S.month_number("month")
    dt = S.safe_date(m, "day")
    return o.select("o_orderkey", F.date_format(dt, "yyyy-MM-dd").alias("safe_date"), S.day_of_year(dt).alias("day_of_year"),
                    r6(S.cyclic_sin(S.day_of_year(dt))).alias("day_sin"), r6(S.cyclic_cos(S.day_of_year(dt))).alias("day_cos"),
                    S.day_adjusted(m, "day").cast("int").alias("adjusted"))

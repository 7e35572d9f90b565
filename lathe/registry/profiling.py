"""Profiling queries (A1-A15, A28-A31, X9) and their DuckDB oracles."""

from pyspark.sql import functions as F

from lathe.operators import profile as P
from lathe.registry.base import register, table, r6

LI_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
          "l_discount", "l_tax"]
SPARK_TYPE_SQL = ("CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
                  "WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT' THEN 'float' "
                  "WHEN 'BOOLEAN' THEN 'boolean' WHEN 'DATE' THEN 'date' ELSE lower(data_type) END")


def union_cols(cols, template: str) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in cols)


CUST = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@register("a1_profile_shape", f"""WITH t AS (SELECT column_name AS "column", {SPARK_TYPE_SQL} AS dtype,
  CAST(ordinal_position - 1 AS INT) AS position FROM information_schema.columns WHERE table_name = 'customer'),
c AS ({union_cols(CUST, "SELECT '{c}' AS \"column\", count({c}) AS non_null, count(*) AS n_rows FROM customer")})
SELECT c."column", dtype, non_null, n_rows, position FROM c JOIN t USING ("column")""")
def a1_shape(spark, sf):
    return P.profile_shape(table(spark, sf, "customer")).select("column", "dtype", "non_null", "n_rows", "position")


def _describe_sql(tbl, cols):
    return union_cols(cols, f"""SELECT '{{c}}' AS "column", count({{c}}) AS count, round(avg({{c}}), 6) + 0.0 AS mean,
  round(stddev_samp({{c}}), 6) + 0.0 AS std, round(min({{c}}), 6) + 0.0 AS min,
  round(quantile_cont({{c}}, 0.25), 6) + 0.0 AS p25, round(quantile_cont({{c}}, 0.5), 6) + 0.0 AS p50,
  round(quantile_cont({{c}}, 0.75), 6) + 0.0 AS p75, round(max({{c}}), 6) + 0.0 AS max FROM {tbl}""")


def _round_all(df, keep):
    return df.select(*[F.col(c) if c in keep else r6(c).alias(c) for c in df.columns])


@register("a2_describe_numeric", _describe_sql("lineitem", LI_NUM))
def a2_describe(spark, sf):
    d = P.describe_numeric(table(spark, sf, "lineitem"), LI_NUM)
    return _round_all(d, {"column", "count"})


@register("a3_describe_categorical", union_cols(["c_name", "c_mktsegment"], """SELECT '{c}' AS "column",
  CAST(sum(n) AS BIGINT) AS count, count(*) AS unique, arg_min(v, (-n, v)) AS top, max(n) AS freq
  FROM (SELECT {c} AS v, count(*) AS n FROM customer WHERE {c} IS NOT NULL GROUP BY {c})"""))
def a3_describe_cat(spark, sf):
    d = P.describe_categorical(table(spark, sf, "customer"), ["c_name", "c_mktsegment"])
    return d.select("column", F.col("count").cast("long"), "unique", "top", "freq")


NULLY = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_shipdate"]
NULLY_SQL = """(SELECT l_orderkey, l_linenumber,
  CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
  CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS l_discount,
  l_tax,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag END AS l_returnflag,
  CASE WHEN l_orderkey % 5 = 0 AND l_linenumber = 1 THEN NULL ELSE l_shipdate END AS l_shipdate FROM lineitem)"""


def with_nulls(li):
    """``lineitem`` with missing values put in by fixed rules (driver tables have none)."""
    return li.select("l_orderkey", "l_linenumber",
                     F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity")).alias("l_quantity"),
                     F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("l_discount"),
                     "l_tax",
                     F.when(F.col("l_linenumber") != 3, F.col("l_returnflag")).alias("l_returnflag"),
                     F.when(~((F.col("l_orderkey") % 5 == 0) & (F.col("l_linenumber") == 1)),
                            F.col("l_shipdate")).alias("l_shipdate"))


_MISS_SQL = union_cols(NULLY, """SELECT '{c}' AS "column", count(*) - count({c}) AS missing,
  round((count(*) - count({c})) * 100.0 / count(*), 6) + 0.0 AS missing_pct FROM nl""")


@register("a4_missing_summary", f"WITH nl AS {NULLY_SQL} {_MISS_SQL}")
def a4_missing(spark, sf):
    m = P.missing_summary(with_nulls(table(spark, sf, "lineitem")), NULLY)
    return m.select("column", "missing", r6("missing_pct").alias("missing_pct"))


@register("a5_missing_ranked", f"WITH nl AS {NULLY_SQL}, m AS ({_MISS_SQL}) SELECT * FROM m WHERE missing > 0")
def a5_missing_ranked(spark, sf):
    m = P.missing_ranked(with_nulls(table(spark, sf, "lineitem")), NULLY)
    return m.select("column", "missing", r6("missing_pct").alias("missing_pct"))


@register("a6_duplicate_rows", """SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates FROM
  (SELECT count(*) AS n FROM events GROUP BY user_id, event_type, value, props)""")
def a6_duplicates(spark, sf):
    ev = table(spark, sf, "events").drop("event_id", "ts")
    return P.duplicate_row_count(ev)


@register("a7_dtype_counts", f"""SELECT {SPARK_TYPE_SQL} AS dtype, count(*) AS n_columns
  FROM information_schema.columns WHERE table_name = 'lineitem' GROUP BY 1""")
def a7_dtypes(spark, sf):
    return P.dtype_counts(table(spark, sf, "lineitem"))


def _pairs(cols):
    cols = sorted(cols)
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


PEARSON_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
_PEARSON_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(covar_samp({a}, {b}) / nullif(stddev_samp({a}) * stddev_samp({b}), 0), 6) + 0.0 AS r "
    "FROM lineitem" for a, b in _pairs(PEARSON_COLS))


@register("a8_pearson_matrix", _PEARSON_SQL)
def a8_pearson(spark, sf):
    m = P.pearson_matrix(table(spark, sf, "lineitem"), PEARSON_COLS)
    return m.select("a", "b", r6("r").alias("r"))


SPEAR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _spearman_sql(tbl, x, y, extra=""):
    return f"""(SELECT covar_samp(rx, ry) / nullif(stddev_samp(rx) * stddev_samp(ry), 0) AS rho FROM (
  SELECT rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2.0 AS rx,
         rank() OVER (ORDER BY {y}) + (count(*) OVER (PARTITION BY {y}) - 1) / 2.0 AS ry
  FROM {tbl} WHERE {x} IS NOT NULL AND {y} IS NOT NULL {extra}))"""


@register("a9_spearman_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round((SELECT rho FROM {_spearman_sql('lineitem', a, b)}), 6) + 0.0 AS rho"
    for a, b in _pairs(SPEAR_COLS)))
def a9_spearman(spark, sf):
    m = P.spearman_matrix(table(spark, sf, "lineitem"), SPEAR_COLS)
    return m.select("a", "b", r6("rho").alias("rho"))


@register("a10_top_pairs", f"SELECT * FROM ({_PEARSON_SQL}) ORDER BY abs(r) DESC, a, b LIMIT 4")
def a10_top_pairs(spark, sf):
    m = P.pearson_matrix(table(spark, sf, "lineitem"), PEARSON_COLS)
    return P.top_pairs(m, 4).select("a", "b", r6("r").alias("r"))


@register("a11_value_counts", """WITH vc AS (
  SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2
  UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2
  UNION ALL SELECT 'o_custkey', CAST(o_custkey AS VARCHAR), count(*) FROM orders GROUP BY 2)
SELECT * FROM vc WHERE "column" IN (SELECT "column" FROM vc GROUP BY 1 HAVING count(*) <= 20)""")
def a11_value_counts(spark, sf):
    o = table(spark, sf, "orders")
    return P.value_counts(o, ["o_orderstatus", "o_orderpriority", "o_custkey"], 20)


@register("a12_value_shares", """SELECT CAST(o_totalprice > 200000 OR o_orderstatus = 'P' AS BOOLEAN) AS value, count(*) AS n,
  round(count(*) / sum(count(*)) OVER (), 6) + 0.0 AS share FROM orders GROUP BY 1""")
def a12_value_shares(spark, sf):
    o = table(spark, sf, "orders")
    s = P.value_shares(o, (F.col("o_totalprice") > 200000) | (F.col("o_orderstatus") == "P"))
    return s.select("value", "n", r6("share").alias("share"))


def _hist_sql(x, tbl, k_expr):
    return f"""WITH b AS (SELECT {x} AS x FROM {tbl} WHERE {x} IS NOT NULL),
s AS (SELECT min(x) AS lo, max(x) AS hi, {k_expr} AS k FROM b),
w AS (SELECT lo, k, (hi - lo) / k AS w FROM s),
c AS (SELECT CAST(CASE WHEN w = 0 THEN 0 ELSE least(floor((x - lo) / w), k - 1) END AS INT) AS bin, lo, w FROM b, w)
SELECT bin, round(lo + bin * w, 4) + 0.0 AS lo, round(lo + (bin + 1) * w, 4) + 0.0 AS hi, count(*) AS n
FROM c GROUP BY bin, lo, w"""


def _hist_out(h):
    return h.select(F.col("bin").cast("int"), r6("lo", 4).alias("lo"), r6("hi", 4).alias("hi"), "n")


@register("a13_histogram_sqrt_rule", _hist_sql("o_totalprice", "orders", "greatest(20, CAST(floor(sqrt(count(*))) AS INT))"))
def a13_histogram(spark, sf):
    return _hist_out(P.histogram(table(spark, sf, "orders"), "o_totalprice"))


@register("a14_clipped_histogram", _hist_sql(
    "least(l_extendedprice, (SELECT quantile_cont(l_extendedprice, 0.99) FROM lineitem))", "lineitem", "50"))
def a14_clipped_histogram(spark, sf):
    return _hist_out(P.clipped_histogram(table(spark, sf, "lineitem"), "l_extendedprice", 0.99, 50))


@register("a15_priority_histograms", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", * FROM ({_hist_sql(c, 'lineitem', 'greatest(20, CAST(floor(sqrt(count(*))) AS INT))')})"
    for c in ["l_tax", "l_quantity"]))
def a15_priority(spark, sf):
    li = table(spark, sf, "lineitem")
    cols = P.priority_columns(li, ["L_TAX", "missing_col", "l_Quantity"])
    out = None
    for c in cols:
        h = _hist_out(P.histogram(li, c)).select(F.lit(c).alias("column"), "*")
        out = h if out is None else out.unionByName(h)
    return out


A28_COLUMNS = ["column", "dtype", "n", "missing", "distinct", "zeros", "mean", "std", "min", "p25", "p50", "p75", "max"]
A28_SQL = f"""SELECT o."column", o.dtype, o.n, o.missing, o.distinct, z.zeros, d.mean, d.std, d.min, d.p25, d.p50, d.p75, d.max FROM
  ({union_cols(CUST, "SELECT '{c}' AS \"column\", count({c}) AS n, count(*) - count({c}) AS missing, count(DISTINCT {c}) AS distinct FROM customer")}) o
  JOIN (SELECT column_name AS "column", {SPARK_TYPE_SQL} AS dtype FROM information_schema.columns WHERE table_name = 'customer') t USING ("column")
  LEFT JOIN ({union_cols(["c_custkey", "c_nationkey", "c_acctbal"], "SELECT '{c}' AS \"column\", CAST(count_if({c} = 0) AS BIGINT) AS zeros FROM customer")}) z USING ("column")
  LEFT JOIN ({_describe_sql("customer", ["c_custkey", "c_nationkey", "c_acctbal"])}) d USING ("column")""".replace(
    "o.dtype", "t.dtype")


@register("a28_profile_table", A28_SQL)
def a28_profile(spark, sf):
    rep = P.profile_table(table(spark, sf, "customer"))
    ov = rep["overview"]
    return _round_all(ov, {"column", "dtype", "n", "missing", "distinct", "zeros"}).select(*A28_COLUMNS)


@register("a28_profile_top_values", """SELECT * FROM (SELECT "column", value, n, CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS INT) AS rank
  FROM (SELECT 'c_mktsegment' AS "column", c_mktsegment AS value, count(*) AS n FROM customer GROUP BY 2
        UNION ALL SELECT 'c_name', c_name, count(*) FROM customer GROUP BY 2)) WHERE rank <= 5""")
def a28_top_values(spark, sf):
    return P.profile_table(table(spark, sf, "customer"))["top_values"].select(
        "column", "value", "n", F.col("rank").cast("int"))


CMP = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("a29_compare_tables", f"""WITH a AS ({union_cols(CMP, "SELECT '{c}' AS \"column\", stddev_samp({c}) AS std, max({c}) AS mx, avg({c}) AS mean FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-06-17'")}),
b AS ({union_cols(CMP, "SELECT '{c}' AS \"column\", stddev_samp({c}) AS std, max({c}) AS mx, avg({c}) AS mean FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-06-17'")}),
d AS (SELECT "column", a.std - b.std AS delta_std, a.mx - b.mx AS delta_max, a.mean - b.mean AS delta_mean FROM a JOIN b USING ("column"))
SELECT "column", round(delta_std, 6) + 0.0 AS delta_std, round(delta_max, 6) + 0.0 AS delta_max, round(delta_mean, 6) + 0.0 AS delta_mean,
  CAST(row_number() OVER (ORDER BY abs(delta_std) DESC NULLS LAST, "column") AS INT) AS rank_std,
  CAST(row_number() OVER (ORDER BY abs(delta_max) DESC NULLS LAST, "column") AS INT) AS rank_max,
  CAST(row_number() OVER (ORDER BY abs(delta_mean) DESC NULLS LAST, "column") AS INT) AS rank_mean FROM d""")
def a29_compare(spark, sf):
    li = table(spark, sf, "lineitem")
    cut = F.lit("1995-06-17").cast("timestamp")
    c = P.compare_tables(li.where(F.col("l_shipdate") < cut), li.where(F.col("l_shipdate") >= cut), CMP)
    return c.select("column", *[r6(f"delta_{s}").alias(f"delta_{s}") for s in ("std", "max", "mean")],
                    *[F.col(f"rank_{s}").cast("int") for s in ("std", "max", "mean")])


def _target_corr_sql(side, where):
    return " UNION ALL ".join(f"SELECT '{side}' AS side, '{c}' AS feature, covar_samp({c}, l_extendedprice) / nullif(stddev_samp({c}) * stddev_samp(l_extendedprice), 0) AS r "
                              f"FROM lineitem WHERE l_shipdate {where} TIMESTAMP '1995-06-17'" for c in CORR_COLS)


CORR_COLS = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_partkey", "l_suppkey"]


@register("a29_target_correlations", f"""SELECT side, CAST(rank AS INT) AS rank, feature, round(r, 6) + 0.0 AS r FROM (
  SELECT *, row_number() OVER (PARTITION BY side ORDER BY abs(r) DESC, feature) AS rank FROM (
  {_target_corr_sql('a', '<')} UNION ALL {_target_corr_sql('b', '>=')}) WHERE r IS NOT NULL AND NOT isnan(r)) WHERE rank <= 5""")
def a29_correlations(spark, sf):
    li, cut = table(spark, sf, "lineitem"), F.lit("1995-06-17").cast("timestamp")
    c = P.compare_target_correlations(li.where(F.col("l_shipdate") < cut), li.where(F.col("l_shipdate") >= cut), "l_extendedprice", CORR_COLS)
    return c.select("side", F.col("rank").cast("int"), "feature", r6("r").alias("r"))


LI_ALL = LI_NUM + ["l_returnflag", "l_linestatus", "l_shipdate"]


@register("a29_shape_summary", f"""WITH t AS (SELECT *, CASE WHEN l_shipdate < TIMESTAMP '1995-06-17' THEN 'early' ELSE 'late' END AS side FROM lineitem)
SELECT side, CAST(sum(n) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS missing_cells, CAST(sum(n - 1) AS BIGINT) AS duplicates, {len(LI_ALL)} AS columns
FROM (SELECT side, count(*) AS n FROM t GROUP BY side, {", ".join(LI_ALL)}) GROUP BY side""")
def a29_shape(spark, sf):
    li, cut = table(spark, sf, "lineitem"), F.lit("1995-06-17").cast("timestamp")

    def side(name, rows):
        return P.shape_summary(rows).select(F.lit(name).alias("side"), "rows", F.col("missing_cells").cast("long"), "duplicates",
                                            F.col("columns").cast("int"))
    return side("early", li.where(F.col("l_shipdate") < cut)).union(side("late", li.where(F.col("l_shipdate") >= cut)))


@register("a30_class_balance", """SELECT CAST(count_if(toxic = 1) AS BIGINT) AS positives, CAST(count_if(toxic = 0) AS BIGINT) AS negatives,
  round(count_if(toxic = 0) / nullif(count_if(toxic = 1), 0), 6) + 0.0 AS pos_weight FROM labels""")
def a30_class_balance(spark, sf):
    b = P.class_balance(table(spark, sf, "labels"), "toxic")
    return b.select("positives", "negatives", r6("pos_weight").alias("pos_weight"))


@register("a31_adjusted_count", """WITH d AS (SELECT o_orderkey, month(o_orderdate) AS m, dayofmonth(o_orderdate) + o_orderkey % 4 AS day FROM orders)
SELECT CAST(count_if(least(greatest(day, 1), dayofmonth(last_day(make_date(2020, m, 1)))) <> day) AS BIGINT) AS adjusted FROM d""")
def a31_adjusted(spark, sf):
    from lathe.functions.scalars import clipped_day
    o = table(spark, sf, "orders")
    day = (F.dayofmonth("o_orderdate") + F.col("o_orderkey") % 4).cast("int")
    return P.adjusted_count(o, clipped_day(F.month("o_orderdate"), day), day)


@register("x9_eda_summary", f"""SELECT 'missing' AS section, "column", 'missing' AS stat, CAST(missing AS DOUBLE) AS value FROM
  ({union_cols(CUST, "SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing FROM customer")})
UNION ALL SELECT 'numeric', "column", 'mean', round(avg_v, 6) + 0.0 FROM ({union_cols(["c_custkey", "c_nationkey", "c_acctbal"], "SELECT '{c}' AS \"column\", avg({c}) AS avg_v FROM customer")})
UNION ALL SELECT 'numeric', "column", 'p50', round(med, 6) + 0.0 FROM ({union_cols(["c_custkey", "c_nationkey", "c_acctbal"], "SELECT '{c}' AS \"column\", quantile_cont({c}, 0.5) AS med FROM customer")})
UNION ALL SELECT 'categorical', "column", 'unique', CAST(u AS DOUBLE) FROM ({union_cols(["c_name", "c_mktsegment"], "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS u FROM customer")})
UNION ALL SELECT 'duplicates', '*', 'rows', CAST((SELECT count(*) FROM customer) - (SELECT count(*) FROM (SELECT DISTINCT * FROM customer)) AS DOUBLE)
UNION ALL SELECT 'value_counts', 'c_mktsegment', c_mktsegment, CAST(count(*) AS DOUBLE) FROM customer GROUP BY c_mktsegment""")
def x9_eda(spark, sf):
    rep = P.eda_summary(table(spark, sf, "customer"))
    parts = [
        rep["missing"].select(F.lit("missing").alias("section"), "column", F.lit("missing").alias("stat"),
                              F.col("missing").cast("double").alias("value")),
        rep["numeric"].select(F.lit("numeric").alias("section"), "column", F.lit("mean").alias("stat"),
                              r6("mean").alias("value")),
        rep["numeric"].select(F.lit("numeric").alias("section"), "column", F.lit("p50").alias("stat"),
                              r6("p50").alias("value")),
        rep["categorical"].select(F.lit("categorical").alias("section"), "column", F.lit("unique").alias("stat"),
                                  F.col("unique").cast("double").alias("value")),
        rep["duplicates"].select(F.lit("duplicates").alias("section"), F.lit("*").alias("column"),
                                 F.lit("rows").alias("stat"), F.col("duplicates").cast("double").alias("value")),
        rep["value_counts"].where(F.col("column") == "c_mktsegment").select(
            F.lit("value_counts").alias("section"), "column", F.col("value").alias("stat"),
            F.col("n").cast("double").alias("value")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("a10_top_spearman_pairs", "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round((SELECT rho FROM {_spearman_sql('lineitem', a, b)}), 6) + 0.0 AS rho"
        for a, b in _pairs(SPEAR_COLS)) + ") ORDER BY abs(rho) DESC, a, b LIMIT 3")
def a10_top_spearman(spark, sf):
    m = P.spearman_matrix(table(spark, sf, "lineitem"), SPEAR_COLS).select("a", "b", r6("rho").alias("rho"))
    return P.top_pairs(m, 3, value="rho")

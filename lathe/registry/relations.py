"""Target-aware tables (A16-A27, X10) and their DuckDB oracles."""

import math

from pyspark.sql import functions as F

from lathe.operators import relate as R
from lathe.registry.base import register, table, r6


def hex_sql(tbl, x, y, gridsize, value=None):
    ny = int(gridsize / math.sqrt(3))
    z = f", CAST({value} AS DOUBLE) AS z" if value else ""
    znn = f" AND {value} IS NOT NULL" if value else ""
    agg = ", round(avg(z), 6) + 0.0 AS mean" if value else ""
    return f"""WITH b AS (SELECT CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y{z} FROM {tbl} WHERE {x} IS NOT NULL AND {y} IS NOT NULL{znn}),
s AS (SELECT min(x) AS x0, min(y) AS y0, (max(x) - min(x)) / {gridsize} AS sx, (max(y) - min(y)) / {ny} AS sy FROM b),
uv AS (SELECT b.*, x0, y0, sx, sy, CASE WHEN sx = 0 THEN 0.0 ELSE (x - x0) / sx END AS u,
              CASE WHEN sy = 0 THEN 0.0 ELSE (y - y0) / sy END AS v FROM b, s),
c AS (SELECT *, floor(u + 0.5) AS i1, floor(v + 0.5) AS j1, floor(u) AS i2, floor(v) AS j2 FROM uv),
d AS (SELECT *, (pow(u - i1, 2) + 3 * pow(v - j1, 2)) < (pow(u - i2 - 0.5, 2) + 3 * pow(v - j2 - 0.5, 2)) AS first FROM c),
g AS (SELECT CASE WHEN first THEN 1 ELSE 2 END AS grid, CAST(CASE WHEN first THEN i1 ELSE i2 END AS INT) AS i,
             CAST(CASE WHEN first THEN j1 ELSE j2 END AS INT) AS j, x0, y0, sx, sy{', z' if value else ''} FROM d)
SELECT grid, i, j, round(x0 + (i + CASE WHEN grid = 1 THEN 0.0 ELSE 0.5 END) * sx, 4) + 0.0 AS cx,
       round(y0 + (j + CASE WHEN grid = 1 THEN 0.0 ELSE 0.5 END) * sy, 4) + 0.0 AS cy, count(*) AS n{agg}
FROM g GROUP BY grid, i, j, x0, y0, sx, sy"""


def _hex_out(h, value=False):
    cols = [F.col("grid").cast("int"), "i", "j", r6("cx", 4).alias("cx"), r6("cy", 4).alias("cy"), "n"]
    if value:
        cols.append(r6("mean").alias("mean"))
    return h.select(*[c for c in ["x", "y"] if c in h.columns], *cols)


HEX_PAIRS = [("l_quantity", "l_extendedprice"), ("l_discount", "l_extendedprice")]


@register("a16_hexbin_count", " UNION ALL ".join(
    f"SELECT '{x}' AS x, '{y}' AS y, * FROM ({hex_sql('lineitem', x, y, 40)})" for x, y in HEX_PAIRS))
def a16_hexbin(spark, sf):
    li = table(spark, sf, "lineitem")
    return _hex_out(R.hexbin_count(li, HEX_PAIRS + [("absent_feature", "l_extendedprice")], 40))


@register("a17_hexbin_mean", hex_sql("lineitem", "l_quantity", "l_discount", 50, "l_extendedprice"))
def a17_hexbin_mean(spark, sf):
    return _hex_out(R.hexbin_mean(table(spark, sf, "lineitem"), "l_quantity", "l_discount", "l_extendedprice", 50), True)


@register("a18_collapse_rare", """SELECT p_partkey, CASE WHEN p_brand IN (SELECT p_brand FROM part GROUP BY p_brand HAVING count(*) >= 85)
  THEN p_brand ELSE '__OTHER__' END AS p_brand FROM part""")
def a18_collapse(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    return R.collapse_rare(p, "p_brand", 85)


@register("a19_target_rate_by_category", """WITH c AS (SELECT CASE WHEN p_brand IN (SELECT p_brand FROM part GROUP BY p_brand HAVING count(*) >= 85)
  THEN p_brand ELSE '__OTHER__' END AS p_brand, CAST(p_size > 25 AS INT) AS y FROM part)
SELECT p_brand, count(*) AS n, round(avg(y), 6) + 0.0 AS rate FROM c GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 20""")
def a19_rate(spark, sf):
    p = table(spark, sf, "part").withColumn("y", (F.col("p_size") > 25).cast("int"))
    r = R.target_rate_by_category(p, "p_brand", "y", 85, 20)
    return r.select("p_brand", "n", r6("rate").alias("rate"))


def trend_sql(x, cat, y, q, min_count, tbl="lineitem"):
    return f"""WITH d AS (SELECT {cat} AS cat, CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM {tbl}
  WHERE {cat} IN (SELECT {cat} FROM {tbl} GROUP BY {cat} HAVING count(*) >= {min_count}) AND {x} IS NOT NULL AND {y} IS NOT NULL),
nd AS (SELECT cat, least({q}, count(DISTINCT x)) AS q, count(*) AS n FROM d GROUP BY cat HAVING count(DISTINCT x) >= 2),
pts AS (SELECT cat, i, (n - 1) * (i / q) AS h FROM nd, range(0, {q} + 1) t(i) WHERE i <= q),
r AS (SELECT cat, x, row_number() OVER (PARTITION BY cat ORDER BY x) - 1 AS pos FROM d),
e AS (SELECT p.cat, lo.x + (p.h - floor(p.h)) * (hi.x - lo.x) AS edge FROM pts p
  JOIN r lo ON lo.cat = p.cat AND lo.pos = floor(p.h) JOIN r hi ON hi.cat = p.cat AND hi.pos = ceil(p.h)),
ed AS (SELECT cat, list_sort(list_distinct(list(edge))) AS edges FROM e GROUP BY cat),
b AS (SELECT d.cat, d.y, edges, len(list_filter(edges[2:len(edges) - 1], lambda v: v < d.x)) AS bin FROM d JOIN ed USING (cat))
SELECT cat AS {cat}, CAST(bin AS INT) AS bin, round((edges[bin + 1] + edges[bin + 2]) / 2, 6) + 0.0 AS center,
  round(avg(y), 6) + 0.0 AS mean_target, count(*) AS n FROM b GROUP BY cat, bin, edges"""


def _trend_out(t):
    return t.select(t.columns[0], F.col("bin").cast("int"), r6("center").alias("center"),
                    r6("mean_target").alias("mean_target"), "n")


@register("a20_numeric_by_category_trend", trend_sql("l_extendedprice", "l_returnflag", "l_discount", 15, 2000))
def a20_trend(spark, sf):
    li = table(spark, sf, "lineitem")
    return _trend_out(R.numeric_by_category_trend(li, "l_extendedprice", "l_returnflag", "l_discount", 15, 2000))


@register("a20_trend_few_distinct", trend_sql("l_tax", "l_returnflag", "l_extendedprice", 15, 2000))
def a20_trend_small(spark, sf):
    li = table(spark, sf, "lineitem")
    return _trend_out(R.numeric_by_category_trend(li, "l_tax", "l_returnflag", "l_extendedprice", 15, 2000))


@register("a21_cat_cat_table", """SELECT o_orderstatus, o_orderpriority, round(avg(o_totalprice), 6) + 0.0 AS mean, count(*) AS count
FROM orders GROUP BY 1, 2 HAVING count(*) >= 500""")
def a21_cat_cat(spark, sf):
    t = R.cat_cat_table(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", "o_totalprice", 500)
    return t.select("o_orderstatus", "o_orderpriority", r6("mean").alias("mean"), "count")


@register("k4_cat_cat_matrix", """SELECT o_orderstatus,
  round(avg(o_totalprice) FILTER (WHERE o_orderpriority = '1-URGENT'), 6) + 0.0 AS "1-URGENT",
  round(avg(o_totalprice) FILTER (WHERE o_orderpriority = '2-HIGH'), 6) + 0.0 AS "2-HIGH",
  round(avg(o_totalprice) FILTER (WHERE o_orderpriority = '3-MEDIUM'), 6) + 0.0 AS "3-MEDIUM",
  round(avg(o_totalprice) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED'), 6) + 0.0 AS "4-NOT SPECIFIED",
  round(avg(o_totalprice) FILTER (WHERE o_orderpriority = '5-LOW'), 6) + 0.0 AS "5-LOW" FROM orders GROUP BY 1""")
def k4_matrix(spark, sf):
    t = R.cat_cat_table(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", "o_totalprice", 1)
    m = R.cat_cat_matrix(t, "o_orderstatus", "o_orderpriority")
    return m.select("o_orderstatus", *[r6(F.col(f"`{c}`")).alias(c) for c in m.columns if c != "o_orderstatus"])


PRIORITY_ORDER = ["1-URGENT", "2-HIGH", "3-MEDIUM", "9-ABSENT", "5-LOW"]


@register("a22_ordered_category_mean", """SELECT position, o_orderpriority, round(mean, 6) + 0.0 AS mean FROM
  (VALUES (0, '1-URGENT'), (1, '2-HIGH'), (2, '3-MEDIUM'), (3, '9-ABSENT'), (4, '5-LOW')) AS l(position, o_orderpriority)
  LEFT JOIN (SELECT o_orderpriority, avg(o_totalprice) AS mean FROM orders GROUP BY 1) USING (o_orderpriority)""")
def a22_ordered(spark, sf):
    m = R.ordered_category_mean(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice", PRIORITY_ORDER)
    return m.select(F.col("position").cast("int"), "o_orderpriority", r6("mean").alias("mean"))


def orders_customer(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_totalprice", "o_custkey", "c_acctbal", "c_nationkey",
                                                       "o_orderstatus", "o_orderpriority", "c_mktsegment")


_OC = "(SELECT o_totalprice, o_custkey, c_acctbal, c_nationkey, o_orderstatus, o_orderpriority, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey)"


def _spear_target_sql(tbl, feats, target):
    parts = []
    for f in feats:
        parts.append(f"""SELECT '{f}' AS feature, (SELECT covar_samp(rx, ry) / nullif(stddev_samp(rx) * stddev_samp(ry), 0) FROM (
  SELECT rank() OVER (ORDER BY {f}) + (count(*) OVER (PARTITION BY {f}) - 1) / 2.0 AS rx,
         rank() OVER (ORDER BY {target}) + (count(*) OVER (PARTITION BY {target}) - 1) / 2.0 AS ry
  FROM {tbl} WHERE {f} IS NOT NULL AND {target} IS NOT NULL)) AS rho""")
    return " UNION ALL ".join(parts)


def _range_sql(tbl, cats, target, min_count):
    return " UNION ALL ".join(f"""SELECT '{c}' AS feature, max(m) FILTER (WHERE n >= {min_count}) - min(m) FILTER (WHERE n >= {min_count}) AS range,
  count_if(n >= {min_count}) AS groups FROM (SELECT CAST({c} AS VARCHAR) AS v, avg({target}) AS m, count(*) AS n FROM {tbl}
  WHERE {c} IS NOT NULL AND {target} IS NOT NULL GROUP BY 1)""" for c in cats)


@register("a23_feature_signal_ranking", f"""SELECT 'numeric' AS kind, feature, round(rho, 6) + 0.0 AS score FROM (
  SELECT * FROM ({_spear_target_sql(_OC, ["o_custkey", "c_acctbal", "c_nationkey"], "o_totalprice")})
  WHERE rho IS NOT NULL ORDER BY abs(rho) DESC, feature LIMIT 10)
UNION ALL SELECT 'categorical', feature, round(range, 6) + 0.0 FROM (
  SELECT * FROM ({_range_sql(_OC, ["o_orderstatus", "o_orderpriority", "c_mktsegment"], "o_totalprice", 1)})
  WHERE groups >= 2 ORDER BY range DESC, feature LIMIT 10)""")
def a23_signal(spark, sf):
    r = R.feature_signal_ranking(orders_customer(spark, sf), "o_totalprice")
    n = r["numeric"].select(F.lit("numeric").alias("kind"), "feature", r6("rho").alias("score"))
    c = r["categorical"].select(F.lit("categorical").alias("kind"), "feature", r6("range").alias("score"))
    return n.unionByName(c)


LI_FEATS = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_partkey"]


@register("a24_top_numeric_by_spearman", f"""SELECT feature, round(abs(rho), 6) + 0.0 AS abs_rho FROM ({_spear_target_sql('lineitem', LI_FEATS, 'l_extendedprice')})
  WHERE rho IS NOT NULL AND NOT isnan(rho) ORDER BY abs(rho) DESC, feature LIMIT 3""")
def a24_top_numeric(spark, sf):
    t = R.top_numeric_by_spearman(table(spark, sf, "lineitem"), LI_FEATS, "l_extendedprice", 3)
    return t.select("feature", r6("abs_rho").alias("abs_rho"))


@register("a25_top_categorical_by_range", f"""SELECT feature, round(range, 6) + 0.0 AS range FROM ({_range_sql('part', ['p_brand', 'p_type', 'p_size'], 'p_retailprice', 85)})
  WHERE groups >= 2 ORDER BY range DESC, feature LIMIT 6""")
def a25_top_cat(spark, sf):
    t = R.top_categorical_by_range(table(spark, sf, "part"), ["p_brand", "p_type", "p_size"], "p_retailprice", 85, 6)
    return t.select("feature", r6("range").alias("range"))


BOX_SQL = """WITH q AS (SELECT o_orderpriority, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median,
  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS hf FROM q)
SELECT o_orderpriority, round(q1, 6) + 0.0 AS q1, round(median, 6) + 0.0 AS median, round(q3, 6) + 0.0 AS q3,
  round(min(o_totalprice) FILTER (WHERE o_totalprice BETWEEN lf AND hf), 6) + 0.0 AS whisker_lo,
  round(max(o_totalprice) FILTER (WHERE o_totalprice BETWEEN lf AND hf), 6) + 0.0 AS whisker_hi,
  CAST(count_if(NOT (o_totalprice BETWEEN lf AND hf)) AS BIGINT) AS outliers, count(*) AS n
FROM orders JOIN f USING (o_orderpriority) GROUP BY o_orderpriority, q1, median, q3"""


def _box_out(b):
    return b.select(b.columns[0], *[r6(c).alias(c) for c in ["q1", "median", "q3", "whisker_lo", "whisker_hi"]],
                    "outliers", "n")


@register("a26_box_stats", BOX_SQL)
def a26_box(spark, sf):
    return _box_out(R.box_stats(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice"))


DENSITY_SQL = """WITH s AS (SELECT o_orderstatus, min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 20 AS w, count(*) AS nn FROM orders GROUP BY 1),
b AS (SELECT o.o_orderstatus, lo, w, nn, CAST(CASE WHEN w = 0 THEN 0 ELSE least(floor((o_totalprice - lo) / w), 19) END AS INT) AS bin FROM orders o JOIN s USING (o_orderstatus))
SELECT o_orderstatus, bin, round(lo + bin * w, 4) + 0.0 AS lo, round(lo + (bin + 1) * w, 4) + 0.0 AS hi, count(*) AS n,
  round(count(*) / (nn * w) * 1e6, 6) + 0.0 AS density_e6 FROM b GROUP BY o_orderstatus, bin, lo, w, nn"""


@register("a27_violin_density", DENSITY_SQL)
def a27_violin(spark, sf):
    v = R.violin_stats(table(spark, sf, "orders"), "o_orderstatus", "o_totalprice", 20)["density"]
    return v.select("o_orderstatus", F.col("bin").cast("int"), r6("lo", 4).alias("lo"), r6("hi", 4).alias("hi"), "n",
                    r6(F.col("density") * 1e6).alias("density_e6"))


@register("a27_violin_box", BOX_SQL.replace("o_orderpriority", "o_orderstatus"))
def a27_violin_box(spark, sf):
    return _box_out(R.violin_stats(table(spark, sf, "orders"), "o_orderstatus", "o_totalprice", 20)["box"])


EDA_NUM, EDA_CAT = ["o_custkey", "o_orderkey"], ["o_orderpriority", "o_orderstatus"]


def _long(section, table_sql, keys, stats):
    key = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return " UNION ALL ".join(f"SELECT '{section}' AS section, {key} AS key, '{c}' AS stat, CAST({c} AS DOUBLE) AS value FROM ({table_sql})" for c in stats)


def _eda_sql():
    """The sections of the runner over ``orders``. The strongest features are found in SQL too: each section is written for
    every choice and kept for the one that the ranking makes."""
    tn = f"SELECT feature, abs(rho) AS abs_rho, row_number() OVER (ORDER BY abs(rho) DESC, feature) AS r FROM ({_spear_target_sql('orders', EDA_NUM, 'o_totalprice')})"
    tc = f"SELECT feature, range, row_number() OVER (ORDER BY range DESC, feature) AS r FROM ({_range_sql('orders', EDA_CAT, 'o_totalprice', 200)}) WHERE groups >= 2"
    n, c = (lambda f, k: f"'{f}' = (SELECT feature FROM tn WHERE r = {k})"), (lambda f, k: f"'{f}' = (SELECT feature FROM tc WHERE r = {k})")
    parts = ["""SELECT 'roles' AS section, c || '|' || r AS key, '' AS stat, CAST(NULL AS DOUBLE) AS value FROM (VALUES ('o_orderkey', 'numeric'), ('o_custkey', 'numeric'),
  ('o_orderstatus', 'categorical'), ('o_orderpriority', 'categorical'), ('o_totalprice', 'regression')) t(c, r)""",
             _long("top_numeric", "SELECT * FROM tn", ["feature"], ["abs_rho"]), _long("top_categorical", "SELECT * FROM tc", ["feature"], ["range"])]
    hexes = " UNION ALL ".join(f"SELECT '{x}' AS x, 'o_totalprice' AS y, * FROM ({hex_sql('orders', x, 'o_totalprice', 40)})" for x in EDA_NUM)
    parts.append(_long("pairs", hexes, ["x", "y", "grid", "i", "j"], ["cx", "cy", "n"]))
    boxes = " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS category, q1, median, q3, whisker_lo, whisker_hi, outliers, n FROM ({BOX_SQL.replace('o_orderpriority', f)})"
                               for f in EDA_CAT)
    parts.append(_long("box", boxes, ["category", "feature"], ["q1", "median", "q3", "whisker_lo", "whisker_hi", "outliers", "n"]))
    dens = " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS category, bin, lo, hi, n, density_e6 AS density FROM ({DENSITY_SQL.replace('o_orderstatus', f)})" for f in EDA_CAT)
    parts.append(_long("density", dens, ["category", "bin", "feature"], ["lo", "hi", "n", "density"]))
    for x in EDA_NUM:
        y = next(f for f in EDA_NUM if f != x)
        parts.append(_long("hex_mean", f"SELECT '{x}' AS x, '{y}' AS y, * FROM ({hex_sql('orders', x, y, 50, 'o_totalprice')}) WHERE {n(x, 1)}",
                           ["x", "y", "grid", "i", "j"], ["cx", "cy", "n", "mean"]))
        for f in EDA_CAT:
            trend = trend_sql(x, f, "o_totalprice", 15, 3000, "orders")
            parts.append(_long("trend", f"SELECT '{x}' AS x, '{f}' AS feature, * FROM ({trend}) WHERE {n(x, 1)} AND {c(f, 1)}", ["x", "feature", f, "bin"],
                               ["center", "mean_target", "n"]))
    for f in EDA_CAT:
        g = next(k for k in EDA_CAT if k != f)
        cells = f"""SELECT {f} AS c1, {g} AS c2, avg(o_totalprice) AS mean, count(*) AS count FROM orders GROUP BY 1, 2 HAVING count(*) >= 500"""
        parts.append(_long("cells", f"SELECT '{f}' AS f1, '{g}' AS f2, * FROM ({cells}) WHERE {c(f, 1)}", ["f1", "f2", "c1", "c2"], ["mean", "count"]))
    parts.append("SELECT 'signal', 'numeric|' || feature, 'score', rho FROM (" + _spear_target_sql('orders', EDA_NUM, 'o_totalprice') + ")")
    parts.append("SELECT 'signal', 'categorical|' || feature, 'score', range FROM (" + _range_sql('orders', EDA_CAT, 'o_totalprice', 1) + ") WHERE groups >= 2")
    return f"WITH tn AS ({tn}), tc AS ({tc}) SELECT section, key, stat, round(value, 6) + 0.0 AS value FROM (" + " UNION ALL ".join(parts) + ")"


def _eda_rows(sections):
    """Long form, with the digits of the single queries (densities per million)."""
    v = F.col("value")
    value = F.when(F.col("stat").isin("cx", "cy", "lo", "hi"), r6(v, 4)).when(F.col("stat") == "density", r6(v * 1e6)).otherwise(r6(v))
    return R.long_form(sections).select("section", "key", "stat", value.alias("value"))


@register("x10_run_eda", _eda_sql())
def x10_run_eda(spark, sf):
    o = table(spark, sf, "orders").drop("o_orderdate")
    return _eda_rows(R.run_eda(o, "o_totalprice", 30, 10, 10, 200, cell_count=500))


X10_CLASS = """(SELECT o_custkey, o_totalprice, o_orderpriority, ['morning', 'afternoon', 'evening'][o_orderkey % 3 + 1] AS time_of_day,
  CAST(o_orderstatus = 'F' AS INT) AS y FROM orders)"""


@register("x10_run_eda_classification", f"""WITH d AS {X10_CLASS} SELECT section, key, stat, round(value, 6) + 0.0 AS value FROM (
SELECT 'roles' AS section, c || '|' || r AS key, '' AS stat, CAST(NULL AS DOUBLE) AS value FROM (VALUES ('o_custkey', 'numeric'), ('o_totalprice', 'numeric'),
  ('o_orderpriority', 'categorical'), ('time_of_day', 'categorical'), ('y', 'classification')) t(c, r)
UNION ALL {_long("category_rates", " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS category, count(*) AS n, avg(y) AS rate FROM d GROUP BY 1, 2 HAVING count(*) >= 100"
                                                     for f in ("o_orderpriority", "time_of_day")), ["feature", "category"], ["n", "rate"])}
UNION ALL {_long("trend", "SELECT 'o_custkey' AS x, 'o_orderpriority' AS feature, * FROM (" + trend_sql("o_custkey", "o_orderpriority", "y", 12, 1000, "d") + ")",
                 ["x", "feature", "o_orderpriority", "bin"], ["center", "mean_target", "n"])}
UNION ALL {_long("cells", "SELECT 'o_orderpriority' AS f1, 'time_of_day' AS f2, o_orderpriority AS c1, time_of_day AS c2, avg(y) AS mean, count(*) AS count FROM d GROUP BY 3, 4 HAVING count(*) >= 100",
                 ["f1", "f2", "c1", "c2"], ["mean", "count"])}
UNION ALL {_long("day_parts", "SELECT p, l.t, m AS mean FROM (VALUES (0, 'morning'), (1, 'afternoon'), (2, 'evening')) l(p, t) LEFT JOIN (SELECT time_of_day AS t, avg(y) AS m FROM d GROUP BY 1) USING (t)",
                 ["p", "t"], ["mean"])}
UNION ALL SELECT 'signal', 'numeric|' || feature, 'score', rho FROM ({_spear_target_sql('d', ['o_custkey', 'o_totalprice'], 'y')})
UNION ALL SELECT 'signal', 'categorical|' || feature, 'score', range FROM ({_range_sql('d', ['o_orderpriority', 'time_of_day'], 'y', 1)}) WHERE groups >= 2)""")
def x10_run_eda_classification(spark, sf):
    """The runner on a 0/1 target: rates, trend and cells of the first columns, the line by time of day."""
    o = table(spark, sf, "orders")
    part = F.element_at(F.array(*[F.lit(p) for p in R.DAY_PARTS]), (F.col("o_orderkey") % 3 + 1).cast("int"))
    d = o.select("o_custkey", "o_totalprice", "o_orderpriority", part.alias("time_of_day"), (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    return _eda_rows(R.run_eda(d, "y", trend_count=1000, cell_count=100))

"""Cleaning, joins, encoders, folds/samples, metrics and blending, with DuckDB oracles."""

from pyspark.sql import functions as F

from lathe.operators import clean as C, joins as J, encode as E, ranks as RK, metrics as M, blend as BL
from lathe.operators import columns as COL
from lathe.operators.stats import FittedState, apply_fitted_broadcast
from lathe.registry.base import register, table, r6

SEED = 42


# ---------------------------------------------------------------- schema steps

@register("p1_p2_drop_columns_carry_key", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def p1_drop(spark, sf):
    o = table(spark, sf, "orders")
    return COL.drop_columns(o, ["o_totalprice", "o_orderdate", "not_there"])


@register("p3_columns_by_kind", """SELECT column_name AS "column", CASE WHEN data_type IN ('BIGINT', 'INTEGER') THEN 'integer'
  WHEN data_type = 'DOUBLE' THEN 'float' WHEN data_type = 'VARCHAR' THEN 'categorical' END AS kind
  FROM information_schema.columns WHERE table_name = 'part'""")
def p3_kinds(spark, sf):
    p = table(spark, sf, "part")
    rows = [(c, k) for k in ("integer", "float", "categorical") for c in COL.columns_by_kind(p, k)]
    return spark.createDataFrame(rows, "column string, kind string")


@register("p4_p5_detect_target", """SELECT 'target' AS role, 'target' AS "column" UNION ALL
  SELECT 'feature', column_name FROM information_schema.columns WHERE table_name = 'labels' AND data_type IN ('BIGINT', 'INTEGER')
  AND column_name NOT IN ('quality')""")
def p4_target(spark, sf):
    lab = table(spark, sf, "labels").withColumnRenamed("quality", "target")
    t, feats = COL.describe_roles(lab)
    return spark.createDataFrame([("target", t)] + [("feature", f) for f in feats], "role string, column string")


@register("p6_split_columns", """WITH nd AS (SELECT count(DISTINCT p_partkey) AS pk, count(DISTINCT p_size) AS ps, count(DISTINCT p_brand) AS pb,
  count(DISTINCT p_type) AS pt, count(DISTINCT p_name) AS pn FROM part)
SELECT 'numeric' AS role, 'p_retailprice' AS "column" UNION ALL SELECT 'numeric', 'p_partkey' FROM nd WHERE pk > 30
UNION ALL SELECT 'numeric', 'p_size' FROM nd WHERE ps > 30 UNION ALL SELECT 'categorical', 'p_size' FROM nd WHERE ps <= 30
UNION ALL SELECT 'categorical', 'p_brand' FROM nd WHERE pb <= 30 UNION ALL SELECT 'categorical', 'p_type' FROM nd WHERE pt <= 30
UNION ALL SELECT 'categorical', 'p_name' FROM nd WHERE pn <= 30""")
def p6_split(spark, sf):
    num, cat = COL.split_columns(table(spark, sf, "part"), 30)
    return spark.createDataFrame([("numeric", c) for c in num] + [("categorical", c) for c in cat], "role string, column string")


@register("p7_p8_discrete_regression", """SELECT 'l_linenumber' AS "column", count(DISTINCT l_linenumber) <= 20 AS discrete, count(DISTINCT l_linenumber) > 20 AS regression FROM lineitem
UNION ALL SELECT 'l_extendedprice', count(DISTINCT l_extendedprice) <= 20, count(DISTINCT l_extendedprice) > 20 FROM lineitem
UNION ALL SELECT 'l_returnflag', false, false FROM lineitem LIMIT 3""")
def p7_discrete(spark, sf):
    li = table(spark, sf, "lineitem")
    rows = [(c, COL.is_discrete_numeric(li, c), COL.is_regression(li, c)) for c in ["l_linenumber", "l_extendedprice", "l_returnflag"]]
    return spark.createDataFrame(rows, "column string, discrete boolean, regression boolean")


@register("p14_narrow_types", """SELECT column_name AS "column", CASE column_name WHEN 'p_size' THEN 'tinyint' WHEN 'p_partkey' THEN
  (SELECT CASE WHEN min(p_partkey) > -128 AND max(p_partkey) < 127 THEN 'tinyint' WHEN min(p_partkey) > -32768 AND max(p_partkey) < 32767 THEN 'smallint' ELSE 'int' END FROM part)
  WHEN 'p_retailprice' THEN 'float' ELSE 'string' END AS dtype FROM information_schema.columns WHERE table_name = 'part'""")
def p14_narrow(spark, sf):
    n = COL.narrow_types(table(spark, sf, "part"))
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in n.schema.fields], "column string, dtype string")


@register("p14_narrow_rows", """SELECT * REPLACE (CAST(p_partkey AS SMALLINT) AS p_partkey, CAST(p_size AS TINYINT) AS p_size,
  CAST(p_retailprice AS FLOAT) AS p_retailprice) FROM part""")
def p14_narrow_rows(spark, sf):
    return COL.narrow_types(table(spark, sf, "part"))


@register("p15_p16_float32_bool_to_int", """SELECT l_orderkey, CAST(l_quantity AS FLOAT) AS l_quantity, CAST(l_tax AS FLOAT) AS l_tax,
  CAST(l_linestatus = 'F' AS INT) AS is_f FROM lineitem""")
def p15_float32(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_tax", (F.col("l_linestatus") == "F").alias("is_f"))
    out = COL.bool_to_int(COL.cast_numeric_float32(li, exclude=["l_orderkey"]))
    return out


@register("p20_append_new_columns", """SELECT l_orderkey, l_linenumber, l_quantity, round(l_quantity * l_tax, 6) + 0.0 AS qt FROM lineitem""")
def p20_append(spark, sf):
    # "l_quantity" exists already, so only "qt" is added
    tax = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    return COL.append_new_columns(tax, {"l_quantity": F.lit(-1.0), "qt": r6(F.col("l_quantity") * F.col("l_tax"))}).drop("l_tax")


# ---------------------------------------------------------------- cleaning

@register("p9_row_predicates", """SELECT o_orderkey FROM orders WHERE (month(o_orderdate) = 2 AND dayofmonth(o_orderdate) = 29)
  OR o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'P'""")
def p9_predicates(spark, sf):
    o = table(spark, sf, "orders").withColumn("_m", F.month("o_orderdate")).withColumn("_d", F.dayofmonth("o_orderdate"))
    a = C.where_all(o, _m=2, _d=29)
    b = C.where_all(C.where_in(o, "o_orderpriority", ["1-URGENT", "2-HIGH"]), o_orderstatus="P")
    return a.unionByName(b).select("o_orderkey").distinct()


@register("p10_drop_missing", """SELECT event_id FROM (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN NULL ELSE value END AS v,
  CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS et FROM events) WHERE v IS NOT NULL AND et IS NOT NULL""")
def p10_drop_missing(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.when(F.col("user_id") % 3 != 0, F.col("value")).alias("v"),
                                           F.when(F.col("event_type") != "error", F.col("event_type")).alias("et"))
    return C.drop_missing(ev, ["v", "et"]).select("event_id")


@register("p11_fill_missing", """SELECT event_id, coalesce(CASE WHEN user_id % 3 = 0 THEN NULL ELSE value END, -1.0) AS v,
  coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE event_type END, '<NA>') AS et FROM events""")
def p11_fill(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.when(F.col("user_id") % 3 != 0, F.col("value")).alias("v"),
                                           F.when(F.col("event_type") != "error", F.col("event_type")).alias("et"))
    return C.fill_missing(C.fill_missing(ev, -1.0, ["v"]), "<NA>", ["et"])


@register("p18_drop_duplicate_rows", "SELECT DISTINCT user_id, event_type, value, props FROM events")
def p18_dedup(spark, sf):
    ev = table(spark, sf, "events").drop("event_id", "ts")
    return C.drop_duplicate_rows(ev, True)


@register("p19_head_transposed", """WITH t AS (SELECT *, row_number() OVER (ORDER BY n_nationkey) - 1 AS row FROM nation ORDER BY n_nationkey LIMIT 5)
SELECT 'n_nationkey' AS "column", CAST(row AS INT) AS row, CAST(n_nationkey AS VARCHAR) AS value FROM t
UNION ALL SELECT 'n_name', CAST(row AS INT), n_name FROM t UNION ALL SELECT 'n_regionkey', CAST(row AS INT), CAST(n_regionkey AS VARCHAR) FROM t""")
def p19_head(spark, sf):
    h = C.head_transposed(table(spark, sf, "nation"), "n_nationkey", 5)
    return h.select("column", F.col("row").cast("int"), "value")


# ---------------------------------------------------------------- joins

@register("j1_attach_by_key", """SELECT o_orderkey, o_custkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def j1_attach(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return J.attach_by_key(o, c, "o_custkey")


@register("j2_apply_fitted", """WITH s AS (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS sd FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_extendedprice - m) / sd, 6) + 0.0 AS z FROM lineitem, s""")
def j2_apply(spark, sf):
    li = table(spark, sf, "lineitem")
    row = li.agg(F.avg("l_extendedprice").alias("m"), F.stddev_samp("l_extendedprice").alias("sd")).first()
    st = FittedState()
    st.put("l_extendedprice", "mean", row["m"])
    st.put("l_extendedprice", "std", row["sd"])
    j = apply_fitted_broadcast(li, st, spark)
    return j.select("l_orderkey", "l_linenumber",
                    r6((F.col("l_extendedprice") - F.col("l_extendedprice__mean")) / F.col("l_extendedprice__std")).alias("z"))


@register("j3_lookup_map", """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 END AS urgency,
  n_name FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def j3_lookup(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation")
    oc = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_orderpriority", F.col("c_nationkey").alias("n_nationkey"))
    oc = oc.select("*", J.lookup_map("o_orderpriority", {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}).alias("urgency"))
    return J.lookup_table(oc, n, "n_nationkey", "n_name").select("o_orderkey", "urgency", "n_name")


@register("j4_keep_frequent", "SELECT p_partkey FROM part WHERE p_brand IN (SELECT p_brand FROM part GROUP BY 1 HAVING count(*) >= 85)")
def j4_keep(spark, sf):
    return J.keep_frequent(table(spark, sf, "part"), "p_brand", 85).select("p_partkey")


# ---------------------------------------------------------------- encoders

@register("x2_one_hot", """SELECT c_custkey, """ + ", ".join(
    f"CAST(coalesce(c_mktsegment = '{s}', false) AS TINYINT) AS \"c_mktsegment_{s}\""
    for s in ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]) + " FROM customer")
def x2_one_hot(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    m = E.fit_one_hot(c, "c_mktsegment")
    out = m.transform(c)
    return m.transform(out)  # idempotent second call


@register("x2_one_hot_unseen", """SELECT c_custkey, """ + ", ".join(
    f"CAST(coalesce(c_mktsegment = '{s}', false) AS TINYINT) AS \"c_mktsegment_{s}\""
    for s in ["AUTOMOBILE", "BUILDING", "FURNITURE"]) + " FROM customer")
def x2_unseen(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    m = E.fit_one_hot(c.where(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING", "FURNITURE")), "c_mktsegment")
    return m.transform(c)


@register("x3_label_encode", """SELECT o_orderkey, o_orderpriority, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INT) AS o_orderpriority_code,
  CAST(o_orderpriority = '4-NOT SPECIFIED' AS TINYINT) AS unknown_flag FROM orders""")
def x3_label(spark, sf):
    from lathe.functions.scalars import equals_flag
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    m = E.fit_label_encoder(o, "o_orderpriority")
    return m.transform(o).withColumn("unknown_flag", equals_flag("o_orderpriority", "4-NOT SPECIFIED"))


@register("p21_cast_category", """SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INT) AS c_mktsegment,
  CAST(dense_rank() OVER (ORDER BY c_nationkey) - 1 AS INT) AS c_nationkey FROM customer""")
def p21_cast(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.col("c_nationkey").cast("string").alias("c_nationkey"))
    models = {"c_mktsegment": E.fit_label_encoder(c, "c_mktsegment"),
              "c_nationkey": E.LabelEncoderModel("c_nationkey", sorted([str(i) for i in range(25)], key=lambda s: int(s)))}
    out = E.cast_category(E.cast_category(c, models), models)
    return out


@register("t2_ordinal_map", """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 END AS ordinal FROM orders""")
def t2_ordinal(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", E.ordinal_map("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]).alias("ordinal"))


@register("t1_target_mean_encode_oof", """WITH d AS (SELECT o_orderkey, o_orderpriority AS c, CAST(o_orderkey % 5 AS INT) AS fold, o_totalprice AS y FROM orders),
cf AS (SELECT c, fold, sum(y) AS s, count(y) AS n FROM d GROUP BY 1, 2), ct AS (SELECT c, sum(y) AS tot_s, count(y) AS tot_n FROM d GROUP BY 1),
ft AS (SELECT fold, sum(y) AS fs, count(y) AS fn FROM d GROUP BY 1), gt AS (SELECT sum(y) AS gs, count(y) AS gn FROM d)
SELECT o_orderkey, round(CASE WHEN tot_n - n > 0 THEN (tot_s - s) / (tot_n - n) ELSE (gs - fs) / (gn - fn) END, 4) + 0.0 AS te
FROM d JOIN cf USING (c, fold) JOIN ct USING (c) JOIN ft USING (fold), gt""")
def t1_te(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", (F.col("o_orderkey") % 5).cast("int").alias("fold"), "o_totalprice")
    t = E.target_mean_encode(o, "o_orderpriority", "o_totalprice", "fold")
    return t.select("o_orderkey", r6("o_orderpriority_te", 4).alias("te"))


# ---------------------------------------------------------------- order-dependent

@register("w2_avg_rank", """SELECT l_orderkey, l_linenumber, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS q_rank,
  rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS p_rank FROM lineitem""")
def w2_rank(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    r = RK.avg_rank_column(RK.avg_rank_column(li, "l_quantity", "q_rank"), "l_extendedprice", "p_rank")
    return r.select("l_orderkey", "l_linenumber", "q_rank", "p_rank")


def _qcut_sql(x, tbl, key, q):
    probs = ", ".join(str(i / q) for i in range(q + 1))
    return f"""WITH e AS (SELECT list_sort(list_distinct(quantile_cont({x}, [{probs}]))) AS edges FROM {tbl})
SELECT {key}, CASE WHEN len(edges) >= 2 THEN CAST(len(list_filter(edges[2:len(edges) - 1], lambda v: v < {x})) AS INT) END AS bin FROM {tbl}, e"""


@register("w3_quantile_bins", _qcut_sql("o_totalprice", "orders", "o_orderkey", 12))
def w3_qcut(spark, sf):
    o = table(spark, sf, "orders")
    e = RK.qcut_edges(o, "o_totalprice", 12)
    return o.crossJoin(F.broadcast(e)).select("o_orderkey", RK.qcut_code(F.col("o_totalprice"), F.col("edges")).alias("bin"))


@register("w3_quantile_bins_ties", _qcut_sql("l_tax", "lineitem", "l_orderkey, l_linenumber", 12))
def w3_qcut_ties(spark, sf):
    li = table(spark, sf, "lineitem")
    e = RK.qcut_edges(li, "l_tax", 12)
    return li.crossJoin(F.broadcast(e)).select("l_orderkey", "l_linenumber", RK.qcut_code(F.col("l_tax"), F.col("edges")).alias("bin"))


def _md5_order(idc, seed=SEED):
    return f"md5(concat_ws('|', CAST({idc} AS VARCHAR), '{seed}')), {idc}"


@register("w4_stratified_kfold", f"""SELECT c_custkey, c_mktsegment, CAST((row_number() OVER (PARTITION BY c_mktsegment ORDER BY {_md5_order('c_custkey')}) - 1) % 5 AS INT) AS fold FROM customer""")
def w4_kfold(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return RK.kfold(c, "c_custkey", 5, SEED, strata="c_mktsegment")


@register("w4_kfold_plain", f"""SELECT o_orderkey, CAST((row_number() OVER (ORDER BY {_md5_order('o_orderkey')}) - 1) % 5 AS INT) AS fold FROM orders""")
def w4_kfold_plain(spark, sf):
    return RK.kfold(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 5, SEED)


@register("w4_kfold_hash", f"""SELECT event_id, CAST(CAST(('0x' || substr(md5(concat_ws('|', CAST(event_id AS VARCHAR), '{SEED}')), 1, 8)) AS BIGINT) % 5 AS INT) AS fold FROM events""")
def w4_kfold_hash(spark, sf):
    return RK.kfold(table(spark, sf, "events").select("event_id"), "event_id", 5, SEED, exact=False)


@register("w5_sample_n", f"""SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY {_md5_order('o_orderkey')}) AS r FROM orders) WHERE r <= 1000""")
def w5_sample(spark, sf):
    return RK.sample_n(table(spark, sf, "orders").select("o_orderkey"), 1000, "o_orderkey", SEED)


@register("w5_sample_n_all", "SELECT n_nationkey FROM nation")
def w5_sample_all(spark, sf):
    return RK.sample_n(table(spark, sf, "nation").select("n_nationkey"), 1000, "n_nationkey", SEED)


@register("w6_stratified_subsample", f"""WITH k AS (SELECT CAST(floor(100 * avg(toxic)) AS BIGINT) AS kp FROM labels),
r AS (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY {_md5_order('doc_id')}) AS rn FROM labels)
SELECT doc_id, toxic FROM r, k WHERE (toxic = 1 AND rn <= kp) OR (toxic = 0 AND rn <= 100 - kp)""")
def w6_strat(spark, sf):
    lab = table(spark, sf, "labels").select("doc_id", "toxic")
    return RK.stratified_subsample(lab, 100, "doc_id", "toxic", SEED)


def _stratify_sql(max_q=12, min_q=5, n_splits=5):
    parts = []
    for q in range(min_q, max_q + 1):
        probs = ", ".join(str(i / q) for i in range(q + 1))
        parts.append(f"SELECT {q} AS q, list_sort(list_distinct(quantile_cont(o_totalprice, [{probs}]))) AS edges FROM orders")
    return f"""WITH e AS ({' UNION ALL '.join(parts)}),
b AS (SELECT q, o_orderkey, len(list_filter(edges[2:len(edges) - 1], lambda v: v < o_totalprice)) AS bin FROM orders, e),
ok AS (SELECT q FROM (SELECT q, bin, count(*) AS n FROM b GROUP BY 1, 2) GROUP BY q HAVING min(n) >= {n_splits}),
pick AS (SELECT coalesce(max(q), {min_q}) AS q FROM ok)
SELECT o_orderkey, CAST(bin AS INT) AS bin FROM b JOIN pick USING (q)"""


@register("w7_safe_stratify_bins", _stratify_sql())
def w7_stratify(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return RK.safe_stratify_bins(o, "o_totalprice", 12, 5, 5).select("o_orderkey", "bin")


# ---------------------------------------------------------------- metrics and blending

def _u(idc, salt):
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.col(idc).cast("string"), F.lit(salt))), 1, 8), 16, 10).cast("double") / 4294967295.0


def _u_sql(idc, salt):
    return f"(CAST(('0x' || substr(md5(concat_ws('|', CAST({idc} AS VARCHAR), '{salt}')), 1, 8)) AS BIGINT) / 4294967295.0)"


PRED_SQL = f"""(SELECT o_orderkey AS id, CAST(o_orderkey % 5 AS INT) AS fold, CAST(o_orderstatus = 'F' AS INT) AS y,
  round(0.5 * CAST(o_orderstatus = 'F' AS INT) + 0.5 * {_u_sql('o_orderkey', 'a')}, 3) AS p_a,
  round(0.3 * CAST(o_orderstatus = 'F' AS INT) + 0.7 * {_u_sql('o_orderkey', 'b')}, 3) AS p_b,
  round({_u_sql('o_orderkey', 'c')}, 3) AS p_c FROM orders)"""


def predictions(spark, sf):
    """Out-of-fold prediction fixture: label, fold and three model scores per order."""
    o = table(spark, sf, "orders")
    y = (F.col("o_orderstatus") == "F").cast("int")
    return o.select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 5).cast("int").alias("fold"), y.alias("y"),
                    F.round(0.5 * y + 0.5 * _u("o_orderkey", "a"), 3).alias("p_a"),
                    F.round(0.3 * y + 0.7 * _u("o_orderkey", "b"), 3).alias("p_b"),
                    F.round(_u("o_orderkey", "c"), 3).alias("p_c"))


@register("a32_rmse_by_fold", f"""SELECT fold, round(sqrt(avg(pow(p_a - y, 2))), 6) + 0.0 AS rmse, count(*) AS n FROM {PRED_SQL} GROUP BY fold
UNION ALL SELECT -1, round(sqrt(avg(pow(p_a - y, 2))), 6) + 0.0, count(*) FROM {PRED_SQL}""")
def a32_rmse(spark, sf):
    p = predictions(spark, sf)
    a = M.rmse(p, "p_a", "y", "fold")
    b = M.rmse(p, "p_a", "y").select(F.lit(-1).alias("fold"), "rmse", "n")
    return a.unionByName(b).select("fold", r6("rmse").alias("rmse"), "n")


def _auc_sql(score, src, by=None):
    g = f"{by}, " if by else ""
    p1 = f"PARTITION BY {by} " if by else ""
    p2 = f"PARTITION BY {by}, {score}" if by else f"PARTITION BY {score}"
    grp = f"GROUP BY {by}" if by else ""
    return f"""SELECT {g}round(CASE WHEN sum(y) > 0 AND sum(1 - y) > 0 THEN (sum(r * y) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)) END, 6) + 0.0 AS auc
FROM (SELECT {g}y, rank() OVER ({p1}ORDER BY {score}) + (count(*) OVER ({p2}) - 1) / 2.0 AS r FROM {src}) {grp}"""


@register("a33_roc_auc", f"""SELECT 'p_a' AS model, * FROM ({_auc_sql('p_a', PRED_SQL)}) UNION ALL SELECT 'p_b', * FROM ({_auc_sql('p_b', PRED_SQL)})
UNION ALL SELECT 'p_c', * FROM ({_auc_sql('p_c', PRED_SQL)})""")
def a33_auc(spark, sf):
    p = predictions(spark, sf)
    out = None
    for m in ["p_a", "p_b", "p_c"]:
        a = M.roc_auc(p, m, "y").select(F.lit(m).alias("model"), r6("auc").alias("auc"))
        out = a if out is None else out.unionByName(a)
    return out


@register("a33_roc_auc_by_fold", _auc_sql("p_b", PRED_SQL, "fold"))
def a33_auc_fold(spark, sf):
    return M.roc_auc(predictions(spark, sf), "p_b", "y", "fold").select("fold", r6("auc").alias("auc"))


@register("a34_mean_predictions", f"SELECT id, round((p_a + p_b + p_c) / 3, 6) + 0.0 AS prediction FROM {PRED_SQL}")
def a34_mean(spark, sf):
    p = predictions(spark, sf)
    return M.mean_predictions(p, ["p_a", "p_b", "p_c"]).select("id", r6("prediction").alias("prediction"))


@register("a34_mean_predictions_long", f"""SELECT id, round(avg(p), 6) + 0.0 AS prediction FROM (SELECT id, p_a AS p FROM {PRED_SQL}
  UNION ALL SELECT id, p_b FROM {PRED_SQL} UNION ALL SELECT id, p_c FROM {PRED_SQL}) GROUP BY id""")
def a34_mean_long(spark, sf):
    p = predictions(spark, sf)
    long_df = p.select("id", F.explode(F.array("p_a", "p_b", "p_c")).alias("prediction"))
    return M.mean_predictions_long(long_df, "id").select("id", r6("prediction").alias("prediction"))


def _grid_sql(step=0.05):
    pts = BL.simplex_grid(3, step)
    vals = ", ".join(f"({i}, {a}, {b}, {c})" for i, (a, b, c) in enumerate(pts))
    return f"(SELECT weight_id, CAST(w_p_a AS DOUBLE) AS w_p_a, CAST(w_p_b AS DOUBLE) AS w_p_b, CAST(w_p_c AS DOUBLE) AS w_p_c FROM (VALUES {vals}) g(weight_id, w_p_a, w_p_b, w_p_c))"


@register("m13_blend_weights_auc", f"""WITH s AS (SELECT weight_id, w_p_a, w_p_b, w_p_c, y, w_p_a * p_a + w_p_b * p_b + w_p_c * p_c AS s FROM {PRED_SQL}, {_grid_sql()}),
r AS (SELECT weight_id, w_p_a, w_p_b, w_p_c, y, rank() OVER (PARTITION BY weight_id ORDER BY s) + (count(*) OVER (PARTITION BY weight_id, s) - 1) / 2.0 AS r FROM s),
a AS (SELECT weight_id, w_p_a, w_p_b, w_p_c, (sum(r * y) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)) AS auc FROM r GROUP BY 1, 2, 3, 4)
SELECT CAST(weight_id AS INT) AS weight_id, round(w_p_a, 6) + 0.0 AS w_p_a, round(w_p_b, 6) + 0.0 AS w_p_b, round(w_p_c, 6) + 0.0 AS w_p_c, round(auc, 6) + 0.0 AS auc
FROM a ORDER BY auc DESC, weight_id LIMIT 1""")
def m13_blend(spark, sf):
    b = BL.blend_weights(predictions(spark, sf), ["p_a", "p_b", "p_c"], "y", 0.05)
    return b.select(F.col("weight_id").cast("int"), *[r6(c).alias(c) for c in ["w_p_a", "w_p_b", "w_p_c", "auc"]])


@register("m14_apply_blend", f"SELECT id, round(0.6 * p_a + 0.3 * p_b + 0.1 * p_c, 6) + 0.0 AS blend FROM {PRED_SQL}")
def m14_apply(spark, sf):
    from lathe.session import scratch_path
    path = BL.save_blend_weights(spark, {"p_a": 0.6, "p_b": 0.3, "p_c": 0.1}, scratch_path(spark, "blend-weights"))
    w = BL.load_blend_weights(spark, path)
    return BL.apply_blend(predictions(spark, sf), w).select("id", r6("blend").alias("blend"))


@register("s6_blend_weights_roundtrip", f"""WITH a AS (SELECT 'p_a' AS model, * FROM ({_auc_sql('p_a', PRED_SQL)}) UNION ALL SELECT 'p_b', * FROM ({_auc_sql('p_b', PRED_SQL)})
  UNION ALL SELECT 'p_c', * FROM ({_auc_sql('p_c', PRED_SQL)}))
SELECT model, round(auc / sum(auc) OVER (), 6) + 0.0 AS weight FROM a""")
def s6_weights(spark, sf):
    """Weights proportional to each model's OOF AUC, saved as Parquet and read back."""
    from lathe.session import scratch_path
    p = predictions(spark, sf)
    aucs = {m: M.roc_auc(p, m, "y").first()["auc"] for m in ["p_a", "p_b", "p_c"]}
    # AUCs rounded to 6 digits, as the checked AUC query reports them
    tot = sum(round(a, 6) for a in aucs.values())
    weights = {m: round(a, 6) / tot for m, a in aucs.items()}
    path = BL.save_blend_weights(spark, weights, scratch_path(spark, "blend-weights"))
    back = BL.load_blend_weights(spark, path)
    return spark.createDataFrame(sorted(back.items()), "model string, weight double").select("model", r6("weight").alias("weight"))


@register("t5_threshold_table", f"""WITH h AS (SELECT CAST(floor(least(greatest(p_a, 0), 1) * 100) AS INT) AS bin, count_if(y = 1) AS tp0, count_if(y <> 1) AS fp0 FROM {PRED_SQL} GROUP BY 1),
c AS (SELECT bin, sum(tp0) OVER (ORDER BY bin DESC) AS tp, sum(fp0) OVER (ORDER BY bin DESC) AS fp FROM h), t AS (SELECT sum(tp0) AS P FROM h)
SELECT round(bin / 100.0, 6) + 0.0 AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(tp / (tp + fp), 6) + 0.0 AS precision, round(tp / P, 6) + 0.0 AS recall FROM c, t""")
def t5_thresholds(spark, sf):
    t = M.threshold_table(predictions(spark, sf), "p_a", "y", 100)
    return t.select(r6("threshold").alias("threshold"), F.col("tp").cast("long"), F.col("fp").cast("long"),
                    r6("precision").alias("precision"), r6("recall").alias("recall"))


@register("t6_residual_bins", f"""WITH p AS {PRED_SQL}, e AS (SELECT list_sort(list_distinct(quantile_cont(p_b, [{', '.join(str(i / 10) for i in range(11))}]))) AS edges FROM p)
SELECT CAST(len(list_filter(edges[2:len(edges) - 1], lambda v: v < p_b)) AS INT) AS bin, count(*) AS n, round(avg(p_b - y), 6) + 0.0 AS mean_error,
  round(sqrt(avg(pow(p_b - y, 2))), 6) + 0.0 AS rmse FROM p, e GROUP BY 1""")
def t6_residuals(spark, sf):
    r = M.residual_bins(predictions(spark, sf), "p_b", "y", q=10)
    return r.select(F.col("bin").cast("int"), "n", r6("mean_error").alias("mean_error"), r6("rmse").alias("rmse"))


@register("w3_w4_regression_stratified_folds", f"""WITH e AS (SELECT list_sort(list_distinct(quantile_cont(o_totalprice, [{', '.join(str(i / 12) for i in range(13))}]))) AS edges FROM orders),
b AS (SELECT o_orderkey, CAST(len(list_filter(edges[2:len(edges) - 1], lambda v: v < o_totalprice)) AS INT) AS bin FROM orders, e)
SELECT o_orderkey, bin, CAST((row_number() OVER (PARTITION BY bin ORDER BY {_md5_order('o_orderkey')}) - 1) % 5 AS INT) AS fold FROM b""")
def w3_w4_regression_folds(spark, sf):
    """Folds for a regression target: stratify on 12 quantile bins of the target."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    e = RK.qcut_edges(o, "o_totalprice", 12)
    b = o.crossJoin(F.broadcast(e)).select("o_orderkey", RK.qcut_code(F.col("o_totalprice"), F.col("edges")).alias("bin"))
    return RK.kfold(b, "o_orderkey", 5, SEED, strata="bin")

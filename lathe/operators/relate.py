"""Target-aware tables (A16-A27, X10): the numbers behind the reference's relationship plots.

Grouped statistics are grouped aggregations; statistics of a group's
distribution come from one histogram of its values (``GroupedValues``), never
from a window over the rows or a buffer per group.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.operators.columns import numeric_columns, split_columns, distinct_up_to, is_numeric_type
from lathe.operators.profile import spearman_with_target
from lathe.operators.ranks import GroupedValues, join_by_counts, qcut_code
from lathe.session import written

OTHER = "__OTHER__"
NA_LABEL = "<NA>"


# ---------------------------------------------------------------- hexagonal cells

def hex_cells(df: DataFrame, x: str, y: str, gridsize: int = 40, value: str | None = None,
              mincnt: int = 1) -> DataFrame:
    """Counts (and mean of ``value``) per hexagonal cell of two interleaved grids.

    ``nx = gridsize``, ``ny = int(nx / sqrt(3))``; a point goes to the nearer of the
    two candidate centres (``(round u, round v)`` or ``(floor u + .5, floor v + .5)``)
    under the metric ``du^2 + 3 dv^2``. Returns ``(grid, i, j, cx, cy, n[, mean])``.
    """
    cols = [F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")]
    if value:
        cols.append(F.col(value).cast("double").alias("_z"))
    base = df.select(*cols).where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    if value:
        base = base.where(F.col("_z").isNotNull())
    nx = gridsize
    ny = int(nx / math.sqrt(3))
    st = base.agg(F.min("_x").alias("_x0"), F.max("_x").alias("_x1"), F.min("_y").alias("_y0"), F.max("_y").alias("_y1"))
    st = st.select("_x0", "_y0", ((F.col("_x1") - F.col("_x0")) / nx).alias("_sx"),
                   ((F.col("_y1") - F.col("_y0")) / ny).alias("_sy"))
    j = base.crossJoin(F.broadcast(st))
    u = F.when(F.col("_sx") == 0, F.lit(0.0)).otherwise((F.col("_x") - F.col("_x0")) / F.col("_sx"))
    v = F.when(F.col("_sy") == 0, F.lit(0.0)).otherwise((F.col("_y") - F.col("_y0")) / F.col("_sy"))
    j = j.withColumn("_u", u).withColumn("_v", v)
    i1, j1 = F.floor(F.col("_u") + 0.5), F.floor(F.col("_v") + 0.5)
    i2, j2 = F.floor("_u"), F.floor("_v")
    d1 = F.pow(F.col("_u") - i1, 2) + 3 * F.pow(F.col("_v") - j1, 2)
    d2 = F.pow(F.col("_u") - i2 - 0.5, 2) + 3 * F.pow(F.col("_v") - j2 - 0.5, 2)
    first = d1 < d2
    j = j.select("*", F.when(first, 1).otherwise(2).alias("grid"),
                 F.when(first, i1).otherwise(i2).cast("int").alias("i"),
                 F.when(first, j1).otherwise(j2).cast("int").alias("j"))
    off = F.when(F.col("grid") == 1, F.lit(0.0)).otherwise(F.lit(0.5))
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.avg("_z").alias("mean"))
    g = j.groupBy("grid", "i", "j", "_x0", "_y0", "_sx", "_sy").agg(*aggs).where(F.col("n") >= mincnt)
    return g.select("grid", "i", "j",
                    (F.col("_x0") + (F.col("i") + off) * F.col("_sx")).alias("cx"),
                    (F.col("_y0") + (F.col("j") + off) * F.col("_sy")).alias("cy"),
                    *[a for a in ("n", "mean") if a == "n" or value])


def hexbin_count(df: DataFrame, pairs: list[tuple[str, str]], gridsize: int = 40, mincnt: int = 1) -> DataFrame:
    """Hex counts for several (feature, target) pairs; pairs with an absent column are skipped."""
    out = None
    for x, y in pairs:
        if x not in df.columns or y not in df.columns:
            continue
        h = hex_cells(df, x, y, gridsize, mincnt=mincnt).select(F.lit(x).alias("x"), F.lit(y).alias("y"), "*")
        out = h if out is None else out.unionByName(h)
    return out


def hexbin_mean(df: DataFrame, x: str, y: str, target: str, gridsize: int = 50) -> DataFrame:
    """Mean target per hex cell."""
    return hex_cells(df, x, y, gridsize, value=target)


# ---------------------------------------------------------------- categories vs target

def collapse_rare(df: DataFrame, col: str, min_count: int = 50, out: str | None = None) -> DataFrame:
    """Categories seen fewer than ``min_count`` times (and missing) become ``__OTHER__``.

    The frequent set is a count aggregate joined back by its counts: it holds at most ``rows / min_count`` values, and
    the rows of a common category are dealt over many tasks.
    """
    out = out or col
    freq = (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= min_count))
    j = join_by_counts(df, freq, [col], "__n", F.struct(*df.columns))
    val = F.when(F.col("__n").isNotNull(), F.col(col).cast("string")).otherwise(F.lit(OTHER))
    cols = [val.alias(out) if c == out else F.col(c) for c in df.columns]
    if out not in df.columns:
        cols.append(val.alias(out))
    return j.select(*cols)


def target_rate_by_category(df: DataFrame, feature: str, target: str, min_count: int = 50,
                            top_n: int = 20) -> DataFrame:
    """After collapsing rare categories: the ``top_n`` largest groups with their mean target. Rows are aggregated once,
    per category as it stands; rare categories are collapsed among those sums."""
    y = F.col(target).cast("double")
    g = df.groupBy(F.col(feature)).agg(F.count(F.lit(1)).alias("_all"), F.count(y).alias("_k"), F.sum(y).alias("_s"))
    cat = F.when(F.col(feature).isNotNull() & (F.col("_all") >= min_count), F.col(feature).cast("string")).otherwise(F.lit(OTHER))
    g = g.groupBy(cat.alias(feature)).agg(F.sum("_k").alias("n"), F.sum("_s").alias("_s")).where("n > 0")
    return g.select(feature, "n", (F.col("_s") / F.col("n")).alias("rate")).orderBy(F.desc("n"), feature).limit(top_n)


def numeric_by_category_trend(df: DataFrame, x: str, cat: str, target: str, q: int = 15, min_count: int = 2000) -> DataFrame:
    """Per frequent category: quantile bins of ``x`` (``q`` capped at its distinct count),
    mean target and bin centre per bin. Categories with < 2 distinct ``x`` are skipped."""
    rows = df.select(F.col(cat).alias("_cat"), F.col(x).cast("double").alias("_x"), F.col(target).cast("double").alias("_y"))
    often = rows.groupBy("_cat").agg(F.count(F.lit(1)).alias("_all")).where(F.col("_all") >= min_count).select("_cat")
    values = GroupedValues(rows.where(F.col("_y").isNotNull()), "_cat", "_x", {"y": "_y"})
    bins = F.least(F.lit(q), F.col("distinct"))
    edges = (values.quantiles(lambda: F.transform(F.sequence(F.lit(0), bins), lambda i: i / bins))
             .groupBy("_cat").agg(F.array_sort(F.collect_set("value")).alias("_edges")))  # at most q + 1 edges
    kept = values.groups().where("distinct >= 2").select("_cat").join(often, "_cat").join(edges, "_cat")
    code = qcut_code(F.col("value"), F.col("_edges"))
    g = values.values_with(kept).groupBy("_cat", code.alias("bin"), "_edges").agg(F.sum("y").alias("_s"), F.sum("n").alias("n"))
    lo, hi = F.element_at("_edges", F.col("bin") + 1), F.element_at("_edges", F.col("bin") + 2)
    return g.select(F.col("_cat").alias(cat), "bin", ((lo + hi) / 2).alias("center"), (F.col("_s") / F.col("n")).alias("mean_target"), "n")


def cat_cat_table(df: DataFrame, a: str, b: str, target: str, min_count: int = 500) -> DataFrame:
    """Mean and count of the target per (a, b) pair with at least ``min_count`` rows;
    labels as text with ``<NA>`` for missing, ordered by labels."""
    d = df.where(F.col(a).isNotNull() & F.col(b).isNotNull() & F.col(target).isNotNull())
    g = d.groupBy(F.coalesce(F.col(a).cast("string"), F.lit(NA_LABEL)).alias(a),
                  F.coalesce(F.col(b).cast("string"), F.lit(NA_LABEL)).alias(b)) \
         .agg(F.avg(F.col(target).cast("double")).alias("mean"), F.count(F.lit(1)).alias("count"))
    return g.where(F.col("count") >= min_count).orderBy(a, b)


def cat_cat_matrix(table: DataFrame, a: str, b: str, labels: list[str] | None = None) -> DataFrame:
    """The label-ordered matrix (rows = ``a`` labels, one column per ``b`` label in ``labels``; without it, per
    label in the table, read from its pairs first)."""
    if labels is None:
        labels = [r[0] for r in table.select(b).distinct().orderBy(b).collect()]
    return table.groupBy(a).pivot(b, labels).agg(F.first("mean")).orderBy(a)


def ordered_category_mean(df: DataFrame, cat: str, target: str, order: list[str]) -> DataFrame:
    """Mean target by category in a fixed order; labels without rows get NULL."""
    spark = df.sparkSession
    lab = spark.createDataFrame([(v, i) for i, v in enumerate(order)], f"{cat} string, position int")
    g = df.where(F.col(cat).isin(order) & F.col(target).isNotNull()) \
          .groupBy(cat).agg(F.avg(F.col(target).cast("double")).alias("mean"))
    return F.broadcast(lab).join(g, cat, "left").select("position", cat, "mean").orderBy("position")


def category_range(df: DataFrame, cols: list[str], target: str, min_count: int = 1) -> DataFrame:
    """Per categorical column: range (max - min) of group means over groups with at least
    ``min_count`` rows, number of such groups and the column's distinct count.
    One unpivot + groupBy for all columns."""
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols])
    long_df = df.where(F.col(target).isNotNull()).select(F.col(target).cast("double").alias("_y"),
                                                         F.explode(arr).alias("_kv")) \
                .select("_kv.feature", "_kv.value", "_y").where(F.col("value").isNotNull())
    g = long_df.groupBy("feature", "value").agg(F.avg("_y").alias("_m"), F.count(F.lit(1)).alias("_n"))
    return g.groupBy("feature").agg(
        (F.max(F.when(F.col("_n") >= min_count, F.col("_m"))) - F.min(F.when(F.col("_n") >= min_count, F.col("_m")))).alias("range"),
        F.count_if(F.col("_n") >= min_count).alias("groups"), F.count(F.lit(1)).alias("n_unique"))


def feature_signal_ranking(df: DataFrame, target: str, k: int = 10) -> dict[str, DataFrame]:
    """Numeric features by signed Spearman with the target (top ``k`` by ``|rho|``);
    other columns by range of group means (needs >= 2 groups, top ``k``)."""
    num = [c for c in numeric_columns(df) if c != target]
    cat = [c for c in df.columns if c not in num and c != target]
    out = {}
    if num:
        out["numeric"] = spearman_with_target(df, num, target).where(F.col("rho").isNotNull()) \
            .orderBy(F.abs("rho").desc(), "feature").limit(k)
    if cat:
        # group means include every row whose category is present, target missing rows excluded by avg
        out["categorical"] = category_range(df, cat, target).where(F.col("groups") >= 2) \
            .orderBy(F.desc("range"), "feature").limit(k)
    return out


def top_numeric_by_spearman(df: DataFrame, cols: list[str], target: str, k: int = 6) -> DataFrame:
    """``(feature, abs_rho)`` for the ``k`` features with the largest ``|rho|``;
    empty, constant and non-finite cases are skipped."""
    rho = spearman_with_target(df, cols, target)
    return rho.where(F.col("rho").isNotNull() & ~F.isnan("rho")) \
              .select("feature", F.abs("rho").alias("abs_rho")).orderBy(F.desc("abs_rho"), "feature").limit(k)


def top_categorical_by_range(df: DataFrame, cols: list[str], target: str, min_count: int = 200,
                             k: int = 6) -> DataFrame:
    """Range of group means among groups with at least ``min_count`` rows (>= 2 such groups)."""
    r = category_range(df, cols, target, min_count)
    return r.where(F.col("groups") >= 2).select("feature", "range").orderBy(F.desc("range"), "feature").limit(k)


def _box(values: GroupedValues) -> DataFrame:
    q = values.quantiles([0.25, 0.5, 0.75]).groupBy(*values.by).agg(
        *[F.max(F.when(F.col("q_index") == i, F.col("value"))).alias(n) for i, n in enumerate(["q1", "median", "q3"])])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return values.values_with(q).groupBy(*values.by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_lo"), F.max(F.when(inside, F.col("value"))).alias("whisker_hi"),
        F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"), F.sum("n").alias("n"))


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per group: quartiles, whiskers at the last point within 1.5 IQR of the box,
    and the outlier count."""
    return _box(GroupedValues(df, group, value))


def violin_stats(df: DataFrame, group: str, value: str, bins: int = 20) -> dict[str, DataFrame]:
    """Box statistics plus a per-group density histogram (``n / (N w)``) over the group's range, both from one
    histogram of the group's values."""
    values = GroupedValues(df, group, value)
    st = values.groups().select(group, F.col("min").alias("_lo"), F.col("n").alias("_N"), ((F.col("max") - F.col("min")) / bins).alias("_w"))
    b = F.when(F.col("_w") == 0, F.lit(0)).otherwise(F.least(F.floor((F.col("value") - F.col("_lo")) / F.col("_w")).cast("int"), F.lit(bins - 1)))
    h = values.values_with(st).groupBy(group, b.alias("bin"), "_lo", "_w", "_N").agg(F.sum("n").alias("n"))
    dens = h.select(group, "bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("hi"), "n",
                    F.when(F.col("_w") == 0, F.lit(None)).otherwise(F.col("n") / (F.col("_N") * F.col("_w"))).alias("density"))
    return {"box": _box(values), "density": dens}


#: Fixed order of the day parts in the line by time of day.
DAY_PARTS = ["morning", "afternoon", "evening"]


def run_eda(df: DataFrame, target: str, max_cat_card: int = 30, num_count: int = 10, cat_count: int = 10, min_count: int = 200,
            trend_count: int = 3000, cell_count: int | None = None) -> dict[str, DataFrame]:
    """Column split, regression test, and the relationship tables of the strongest features, by section:

    ``roles``, and for a numeric target with more than 20 values ``top_numeric`` (largest absolute rank correlation; the
    first ``num_count`` columns where none has one), ``top_categorical`` (largest range of means; the first columns
    likewise), ``pairs`` (hexagonal counts of each top number with the target), ``box`` and ``density`` (per top category),
    ``trend`` (strongest number by strongest category), ``cells`` (two strongest categories) and ``hex_mean`` (two
    strongest numbers). Any other target: ``category_rates`` of the first six categories, ``trend`` (12 bins) and ``cells``
    of the first columns. Both: ``day_parts`` where there is a column time_of_day, and ``signal``. A section without
    features is left out. Returns an empty dict when the target is absent."""
    if target not in df.columns:
        return {}
    num, cats = split_columns(df.drop(target), max_cat_card)
    regression = is_numeric_type(df.schema[target].dataType) and distinct_up_to(df, [target], 20)[target] is None
    spark = df.sparkSession
    out = {"roles": spark.createDataFrame(
        [(c, "numeric") for c in num] + [(c, "categorical") for c in cats] + [(target, "regression" if regression else "classification")],
        "column string, role string")}
    if regression:
        if num:
            out["top_numeric"] = written(top_numeric_by_spearman(df, num, target, num_count), "eda-numeric")
        if cats:
            out["top_categorical"] = written(top_categorical_by_range(df, cats, target, min_count, cat_count), "eda-categorical")
        # names of at most num_count + cat_count columns
        nums = [r["feature"] for r in out["top_numeric"].orderBy(F.desc("abs_rho"), "feature").collect()] if num else []
        best = [r["feature"] for r in out["top_categorical"].orderBy(F.desc("range"), "feature").collect()] if cats else []
        nums, best = nums or num[:num_count], best or cats[:cat_count]
        if nums:
            out["pairs"] = hexbin_count(df, [(c, target) for c in nums])
        violins = {c: violin_stats(df, c, target) for c in best}
        for section, part in (("box", "box"), ("density", "density")):
            if violins:
                out[section] = _stacked([v[part].withColumn("feature", F.lit(c)).withColumnRenamed(c, "category")
                                         .withColumn("category", F.col("category").cast("string")) for c, v in violins.items()])
        bins, cells = 15, 1000
        if len(nums) > 1:
            out["hex_mean"] = hexbin_mean(df, nums[0], nums[1], target).select(F.lit(nums[0]).alias("x"), F.lit(nums[1]).alias("y"), "*")
    else:
        nums, best, bins, cells = num[:6], cats[:6], 12, 1500
        rates = [target_rate_by_category(df, c, target, 100, 20).select(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category"), "n", "rate")
                 for c in best]
        if rates:
            out["category_rates"] = _stacked(rates)
    if nums and best:
        t = numeric_by_category_trend(df, nums[0], best[0], target, bins, trend_count)
        out["trend"] = t.select(F.lit(nums[0]).alias("x"), F.lit(best[0]).alias("feature"), F.col(best[0]).cast("string").alias("category"),
                                "bin", "center", "mean_target", "n")
    if len(best) > 1:
        t = cat_cat_table(df, best[0], best[1], target, cell_count or cells)
        out["cells"] = t.select(F.lit(best[0]).alias("feature"), F.lit(best[1]).alias("feature2"), F.col(best[0]).alias("category"),
                                F.col(best[1]).alias("category2"), "mean", "count")
    if "time_of_day" in df.columns:
        out["day_parts"] = ordered_category_mean(df, "time_of_day", target, DAY_PARTS)
    signal = [t.select(F.lit(kind).alias("kind"), "feature", F.col("rho" if kind == "numeric" else "range").alias("score"))
              for kind, t in feature_signal_ranking(df, target).items()]
    if signal:
        out["signal"] = _stacked(signal)
    return out


def _stacked(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def long_form(sections: dict[str, DataFrame]) -> DataFrame:
    """The tables of ``run_eda`` as one: ``(section, key, stat, value)``. ``key`` joins a row's names, labels and cell numbers
    by ``|``; every measure of the row is one row here."""
    out = []
    for name, t in sections.items():
        keys = [c for c, d in t.dtypes if d == "string" or c in ("grid", "i", "j", "bin", "position")]
        stats = [c for c in t.columns if c not in keys] or [None]
        key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit(NA_LABEL)) for c in keys])
        pairs = F.array(*[F.struct(F.lit(c or "").alias("stat"), (F.col(c) if c else F.lit(None)).cast("double").alias("value")) for c in stats])
        out.append(t.select(F.lit(name).alias("section"), key.alias("key"), F.explode(pairs).alias("p")).select("section", "key", "p.*"))
    return _stacked(out)

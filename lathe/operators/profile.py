"""Table profiling.

Per-column statistics are computed for all columns in one aggregation (or one
``unpivot`` + ``groupBy``), never one job per column, and returned as small
long tables with one row per column (or per column value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathe.operators.columns import columns_by_kind, distinct_counts, numeric_columns
from lathe.operators.ranks import dealt, quantiles, row_ranks
from lathe.session import written


def per_column_stats(df: DataFrame, cols: list[str], stats: dict, types: dict | None = None) -> DataFrame:
    """One aggregation computing ``stats[name](col)`` for every column; long result
    ``(column, <stat>...)``, one row per column."""
    types = types or {}
    aggs = [fn(F.col(c)).alias(f"{c}\u0001{s}") for c in cols for s, fn in stats.items()]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"),
                     *[F.col(f"`{c}\u0001{s}`").cast(types.get(s, "double")).alias(s) for s in stats])
            for c in cols]
    return wide.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def profile_shape(df: DataFrame) -> DataFrame:
    """A1: ``(column, dtype, non_null, n_rows, position)``; one ``count`` aggregation."""
    cols = df.columns
    base = per_column_stats(df, cols, {"non_null": F.count, "n_rows": lambda c: F.count(F.lit(1))},
                            {"non_null": "long", "n_rows": "long"})
    meta = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)],
        "column string, dtype string, position int")
    return base.join(F.broadcast(meta), "column")


def describe_numeric(df: DataFrame, cols: list[str] | None = None, mode: str = "auto") -> DataFrame:
    """A2: count, mean, sample std, min, 25/50/75 %, max per numeric column."""
    cols = cols or numeric_columns(df)
    mom = per_column_stats(df, cols, {
        "count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max},
        {"count": "long"})
    q = quantiles(df, cols, [0.25, 0.5, 0.75], mode=mode)
    qw = q.groupBy("column").agg(*[F.max(F.when(F.col("q_index") == i, F.col("value"))).alias(n)
                                   for i, n in enumerate(["p25", "p50", "p75"])])
    # both sides hold one row per column (a bound set by the schema, not the data)
    return mom.join(F.broadcast(qw), "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def _unpivot_strings(df: DataFrame, cols: list[str]) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    return df.select(F.explode(arr).alias("_kv")).select("_kv.column", "_kv.value")


def category_counts(df: DataFrame, cols: list[str], dropna: bool = True) -> DataFrame:
    """``(column, value, n)`` for many categorical columns in one unpivot + groupBy."""
    long_df = _unpivot_strings(df, cols)
    if dropna:
        long_df = long_df.where(F.col("value").isNotNull())
    return long_df.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def describe_categorical(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A3: count, unique, top, freq per categorical column; ties on freq go to the smallest value (Q21)."""
    cols = cols or columns_by_kind(df, "categorical")
    vc = category_counts(df, cols)
    return vc.groupBy("column").agg(
        F.sum("n").cast("long").alias("count"), F.count(F.lit(1)).cast("long").alias("unique"),
        F.min_by("value", F.struct((-F.col("n")).alias("k"), F.col("value").alias("v"))).alias("top"),
        F.max("n").cast("long").alias("freq"))


def missing_summary(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A4: missing count and percent per column."""
    cols = cols or df.columns
    return per_column_stats(df, cols, {
        "missing": lambda c: F.count_if(c.isNull()),
        "missing_pct": lambda c: F.try_divide(F.count_if(c.isNull()) * 100.0, F.count(F.lit(1)))},
        {"missing": "long"})


def missing_ranked(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A5: only columns with missing values, most missing first."""
    return missing_summary(df, cols).where(F.col("missing") > 0).orderBy(F.desc("missing"), "column")


def duplicate_row_count(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row (NULL equals NULL), as a one-row frame."""
    cols = cols or df.columns
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates"))


def dtype_counts(df: DataFrame) -> DataFrame:
    """Number of columns per type (schema only, no job over the data)."""
    counts: dict[str, int] = {}
    for f in df.schema.fields:
        counts[f.dataType.simpleString()] = counts.get(f.dataType.simpleString(), 0) + 1
    return df.sparkSession.createDataFrame(sorted(counts.items()), "dtype string, n_columns bigint")


def safe_corr(a: F.Column, b: F.Column) -> F.Column:
    """Pearson r that is NULL (not an error) for a constant column."""
    return F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b))


def pearson_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``(a, b, r)`` for every pair ``a < b`` in one aggregation; pairwise-complete rows."""
    cols = sorted(cols or numeric_columns(df))
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], "a string, b string, r double")
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    aggs = []
    for a, b in pairs:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        aggs.append(safe_corr(F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double")))
                    .alias(f"{a}\u0001{b}"))
    wide = df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}\u0001{b}`").alias("r"))
                    for a, b in pairs])
    return wide.select(F.explode(arr).alias("_p")).select("_p.*")


def _missing_patterns(df: DataFrame, cols: list[str]) -> dict[str, str]:
    """A representative column for every column with missing values: columns that miss the same rows share it."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    some = [c for c in cols if row[c]]
    like = [(a, b) for i, a in enumerate(some) for b in some[i + 1:] if row[a] == row[b]]
    out = {c: c for c in some}
    if like:
        apart = df.agg(*[F.count_if(F.col(a).isNull() != F.col(b).isNull()).alias(f"x{i}") for i, (a, b) in enumerate(like)]).first()
        for i, (a, b) in enumerate(like):
            if apart[f"x{i}"] == 0:
                out[b] = out[a] if out[b] == b else out[b]
    return out


def spearman_pairs(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """``(a, b, rho)`` per pair: Pearson on average ranks over the rows where both columns are present.

    A column is ranked once for each set of rows that a pair of it needs; columns that miss the same rows share their
    sets, so there are as many as combinations of missing-value patterns (one without missing values), not as pairs. All
    ranks come from one long table of (row, set, column, value): one shuffle ranks it, one brings each row's ranks
    together, and one aggregate makes all products."""
    spark = df.sparkSession
    if not pairs:
        return spark.createDataFrame([], "a string, b string, rho double")
    cols = sorted({c for p in pairs for c in p})
    pattern = _missing_patterns(df, cols)
    sets: dict[tuple[str, ...], int] = {}
    of = {}
    for a, b in pairs:
        of[a, b] = sets.setdefault(tuple(sorted({pattern[c] for c in (a, b) if c in pattern})), len(sets))
    ranked = sorted({(k, c) for (a, b), k in of.items() for c in (a, b)})
    name = {kc: f"r{i}" for i, kc in enumerate(ranked)}
    rows = written(df.select(F.monotonically_increasing_id().alias("_row"), *[F.col(c).cast("double").alias(c) for c in cols]), "rank-rows")
    masks = {k: [F.col(c).isNotNull() for c in need] for need, k in sets.items()}

    def held(k: int, c: str) -> F.Column:
        ok = F.col(c).isNotNull()
        for m in masks[k]:
            ok &= m
        return F.when(ok, F.struct(F.lit(name[k, c]).alias("_name"), F.col(c).alias("_v")))
    long_df = (rows.select("_row", F.explode(F.array(*[held(k, c) for k, c in ranked])).alias("_s")).where(F.col("_s").isNotNull())
               .select("_row", "_s.*"))
    ranks = row_ranks(long_df, "_v", "_name", "_rank", few_keys=True)
    wide = (dealt(ranks, rows.count() * len(ranked), "_row").groupBy("_row")
            .agg(*[F.max(F.when(F.col("_name") == n, F.col("_rank"))).alias(n) for n in name.values()]))

    def varies(c: str) -> F.Column:  # merging partial sums leaves a constant a variance near zero, not zero
        return F.min(c) < F.max(c)
    of_pair = [(name[of[p], p[0]], name[of[p], p[1]]) for p in pairs]
    one = wide.agg(*[F.when(varies(a) & varies(b), safe_corr(F.col(a), F.col(b))).alias(f"p{i}") for i, (a, b) in enumerate(of_pair)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"p{i}").alias("rho"))
                                          for i, (a, b) in enumerate(pairs)])).alias("_p")).select("_p.*")


def spearman_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Spearman rho for every pair ``a < b`` over the rows where both columns are present."""
    cols = sorted(cols or numeric_columns(df))
    return spearman_pairs(df, [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]])


def spearman_with_target(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """``(feature, rho)``: Spearman of each feature with the target over rows where both are present."""
    return spearman_pairs(df, [(c, target) for c in cols]).select(F.col("a").alias("feature"), "rho")


def top_pairs(corr: DataFrame, k: int = 10, value: str = "r") -> DataFrame:
    """A10: strongest ``|r|`` pairs; ties by names."""
    return corr.where(F.col(value).isNotNull()).orderBy(F.abs(value).desc(), "a", "b").limit(k)


def value_counts(df: DataFrame, cols: list[str] | None = None, max_unique: int = 20) -> DataFrame:
    """``(column, value, n)`` for categorical columns with at most ``max_unique`` values,
    most frequent first, ties by value."""
    cols = cols or columns_by_kind(df, "categorical")
    vc = category_counts(df, cols)
    small = vc.groupBy("column").agg(F.count(F.lit(1)).alias("_u")).where(F.col("_u") <= max_unique)
    return vc.join(small, "column", "left_semi").orderBy("column", F.desc("n"), "value")


def value_shares(df: DataFrame, expr: F.Column, name: str = "value") -> DataFrame:
    """``(value, n, share)`` of one expression; the share divides by the total of the small result."""
    g = df.groupBy(expr.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    tot = g.agg(F.sum("n").alias("_tot"))
    return g.crossJoin(F.broadcast(tot)).select(name, "n", (F.col("n") / F.col("_tot")).alias("share"))


def histogram(df: DataFrame, col: str, bins: int | None = None, upper: float | None = None) -> DataFrame:
    """Equal-width bins; ``bins`` defaults to ``max(20, floor(sqrt(n)))``; last bin closed.
    ``(bin, lo, hi, n)`` for non-empty bins. Range stats come from one aggregate row."""
    x = F.col(col).cast("double")
    if upper is not None:
        x = F.when(x.isNotNull(), F.least(x, F.lit(upper)))
    base = df.select(x.alias("_x")).where(F.col("_x").isNotNull())
    st = base.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    k = F.lit(bins) if bins else F.greatest(F.lit(20), F.floor(F.sqrt("_n")).cast("int"))
    st = st.withColumn("_k", k.cast("int")).withColumn("_w", (F.col("_hi") - F.col("_lo")) / F.col("_k"))
    j = base.crossJoin(F.broadcast(st))
    b = F.when(F.col("_w") == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_x") - F.col("_lo")) / F.col("_w")).cast("int"), F.col("_k") - 1))
    g = j.groupBy(b.alias("bin"), "_lo", "_w").agg(F.count(F.lit(1)).alias("n"))
    return g.select("bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("hi"), "n")


def clipped_histogram(df: DataFrame, col: str, q: float = 0.99, bins: int = 50, mode: str = "auto") -> DataFrame:
    """Clip the upper tail at quantile ``q`` then ``bins`` equal-width bins."""
    from lathe.operators.ranks import quantile_map
    hi = quantile_map(df, [col], [q], mode=mode).get((col, round(q, 12)))
    return histogram(df, col, bins=bins, upper=hi)


def priority_columns(df: DataFrame, priority: list[str], limit: int = 8, exclude=None) -> list[str]:
    """Numeric columns named in ``priority`` (case-insensitive), else the first ``limit``."""
    num = numeric_columns(df, exclude)
    low = {c.lower(): c for c in num}
    chosen = [low[p.lower()] for p in priority if p.lower() in low]
    return chosen if chosen else num[:limit]


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Positives, negatives and ``neg/pos`` (NULL when there is no positive)."""
    y = F.col(label)
    return df.agg(F.count_if(y == 1).alias("positives"), F.count_if(y == 0).alias("negatives")) \
             .withColumn("pos_weight", F.try_divide(F.col("negatives").cast("double"), F.col("positives")))


def adjusted_count(df: DataFrame, repaired: F.Column, original: F.Column) -> DataFrame:
    """Rows whose repaired value differs from the original."""
    return df.agg(F.count_if(repaired != original).cast("long").alias("adjusted"))


def top_k_per_group(df: DataFrame, group: list[str], order: list, k: int, spread_col: str,
                    spread: int = 256) -> DataFrame:
    """The first ``k`` rows of each group under ``order``, with a ``rank`` column.

    Two levels, so no group is sorted whole in one task: the top ``k`` within
    (group, hash(spread_col) mod ``spread``) first, then the top ``k`` of those
    at most ``k * spread`` survivors per group."""
    from pyspark.sql import Window
    sub = F.pmod(F.hash(F.col(spread_col)), F.lit(spread))
    w1 = Window.partitionBy(*group, sub).orderBy(*order)
    local = df.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k).drop("_r1")
    w2 = Window.partitionBy(*group).orderBy(*order)
    return local.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)


def profile_table(df: DataFrame, mode: str = "auto", max_top: int = 5) -> dict[str, DataFrame]:
    """The full report as tables: per-column overview (type, n, missing, distinct,
    zeros, numeric moments and quantiles), top values, duplicate rows, correlations."""
    num = numeric_columns(df)
    cats = columns_by_kind(df, "categorical") + columns_by_kind(df, "bool")
    overview = per_column_stats(df, df.columns, {"n": F.count, "missing": lambda c: F.count_if(c.isNull())}, {"n": "long", "missing": "long"})
    distinct = distinct_counts(df, df.columns)
    meta = df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString(), distinct[f.name]) for f in df.schema.fields],
                                           "column string, dtype string, distinct long")
    overview = overview.join(F.broadcast(meta), "column")
    if num:
        zeros = per_column_stats(df, num, {"zeros": lambda c: F.count_if(c == 0)}, {"zeros": "long"})
        # per-column tables: one row per column, broadcast
        overview = overview.join(F.broadcast(zeros), "column", "left").join(
            F.broadcast(describe_numeric(df, num, mode).drop("count")), "column", "left")
    out = {"overview": overview, "duplicates": duplicate_row_count(df)}
    if cats:
        vc = category_counts(df, cats)
        out["top_values"] = top_k_per_group(vc, ["column"], [F.desc("n"), F.asc("value")], max_top, "value")
    if len(num) > 1:
        out["correlations"] = pearson_matrix(df, num)
    return out


def eda_summary(df: DataFrame, max_unique: int = 20, mode: str = "auto") -> dict[str, DataFrame]:
    """Shape, numeric and categorical descriptions, missing values, duplicates,
    type counts, correlations (only with more than one numeric column) and value counts."""
    num = numeric_columns(df)
    cats = columns_by_kind(df, "categorical")
    out = {"shape": profile_shape(df), "missing": missing_summary(df), "duplicates": duplicate_row_count(df),
           "dtypes": dtype_counts(df)}
    if num:
        out["numeric"] = describe_numeric(df, num, mode)
    if cats:
        out["categorical"] = describe_categorical(df, cats)
        out["value_counts"] = value_counts(df, cats, max_unique)
    if len(num) > 1:
        out["correlations"] = pearson_matrix(df, num)
    return out


def compare_tables(a: DataFrame, b: DataFrame, cols: list[str] | None = None, mode: str = "auto") -> DataFrame:
    """Per shared numeric column, differences a-b of std, max and mean, with the rank
    of each absolute difference (1 = largest)."""
    from pyspark.sql import Window
    cols = cols or [c for c in numeric_columns(a) if c in set(numeric_columns(b))]
    st = {"std": F.stddev_samp, "max": F.max, "mean": F.avg}
    sa = per_column_stats(a, cols, st)
    sb = per_column_stats(b, cols, st)
    j = sa.alias("x").join(F.broadcast(sb.alias("y")), "column")
    out = j.select("column", *[(F.col(f"x.{s}") - F.col(f"y.{s}")).alias(f"delta_{s}") for s in st])
    for s in st:
        w = Window.orderBy(F.abs(F.col(f"delta_{s}")).desc_nulls_last(), "column")
        # one row per column: the window runs over a table of len(cols) rows
        out = out.withColumn(f"rank_{s}", F.row_number().over(w))
    return out


def pearson_with_target(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """``(feature, r)``: Pearson of each column with the target over rows where both are present, in one aggregation."""
    y = F.col(target).cast("double")
    aggs = []
    for i, c in enumerate(cols):
        both = F.col(c).isNotNull() & y.isNotNull()
        aggs.append(safe_corr(F.when(both, F.col(c).cast("double")), F.when(both, y)).alias(f"r{i}"))
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"r{i}").alias("r")) for i, c in enumerate(cols)])
    return df.agg(*aggs).select(F.explode(rows).alias("_r")).select("_r.*")


def compare_target_correlations(a: DataFrame, b: DataFrame, target: str, cols: list[str] | None = None, k: int = 5) -> DataFrame:
    """The ``k`` columns of each side with the largest absolute correlation with the target:
    ``(side, rank, feature, r)``; columns without a correlation are left out, ties go by name."""
    from pyspark.sql import Window
    cols = cols or [c for c in numeric_columns(a) if c in set(numeric_columns(b)) and c != target]
    both = None
    for side, df in (("a", a), ("b", b)):
        one = pearson_with_target(df, cols, target).where("r is not null and not isnan(r)").select(F.lit(side).alias("side"), "feature", "r")
        both = one if both is None else both.union(one)
    rank = F.row_number().over(Window.partitionBy("side").orderBy(F.abs("r").desc(), "feature"))  # one row per column and side
    return both.withColumn("rank", rank).where(F.col("rank") <= k).select("side", "rank", "feature", "r")


def shape_summary(df: DataFrame) -> DataFrame:
    """Rows, columns, missing cells and duplicate rows of one table as one row."""
    n_cols = len(df.columns)
    miss = sum((F.col(c).isNull().cast("long") for c in df.columns), F.lit(0))
    base = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(miss).alias("missing_cells"))
    return base.crossJoin(duplicate_row_count(df)).withColumn("columns", F.lit(n_cols))

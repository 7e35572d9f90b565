"""Global order without a single task: average ranks, exact quantiles, folds, samples.

Every operator here that needs "the rank of a value" is planned as:

1. collapse rows to distinct values with counts (``groupBy(key, value)``; map
   side partial aggregation makes a hot value one row, so skew does not reach
   the shuffle),
2. cut the values into balanced range buckets at the quantiles of one sketch
   over all rows, whatever their key (any cuts give the right answer, they only
   set the balance; equal values always share a bucket, and no key holds more
   of a bucket than the bucket has),
3. turn bucket sizes into running offsets (a table of at most
   ``keys x MAX_BUCKETS`` rows),
4. run the cumulative sum inside each bucket (a window partitioned by
   ``(key, bucket)``, never an unpartitioned ``Window.orderBy``).

Whole-table quantiles need only a few positions: they narrow a bracket around
each with sketches and count exactly inside it (``_quantiles_select``).

Hash-ordered ranks (folds and samples) use the first hex digits of an md5 as
the bucket, which is uniform by construction whatever the key distribution.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathe.session import written

# distinct values of one (key, bucket) window partition the planner aims for
TARGET_BUCKET_ROWS = 1_000_000
MAX_BUCKETS = 4096
# quantile sketches: size, and the rank error they keep with 99 % confidence (a wrong bracket is noticed and widened)
SKETCH_SIZE = 2000
SKETCH_ERROR = 2.3 / SKETCH_SIZE ** 0.9
# values between the ends of a bracket that one window partition may sort
FINISH_ROWS = 1_000_000
# brackets told apart by one generated expression
HIT_BRACKETS = 32
# quantiles asked of a sketch over the values inside a bracket
NARROW_GRID = 400
# rows of one key that a task may meet in a join back to the rows
HOT_ROWS = 1_000_000
# rows that a task of the row ranks sorts or groups
TASK_ROWS = 500_000
# hex digits of the md5 used as hash buckets for folds and samples (16^4 buckets)
HASH_PREFIX = 4


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def unpivot_values(df: DataFrame, cols: list[str], name_col: str = "column",
                   value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Long form ``(keep..., column, value)`` of numeric columns, as double, NULLs dropped."""
    keep = keep or []
    exprs = [F.struct(F.lit(c).alias(name_col), F.col(c).cast("double").alias(value_col)) for c in cols]
    return (df.select(*keep, F.explode(F.array(*exprs)).alias("_kv"))
              .select(*keep, F.col(f"_kv.{name_col}").alias(name_col),
                      F.col(f"_kv.{value_col}").alias(value_col))
              .where(F.col(value_col).isNotNull()))


def value_histogram(long_df: DataFrame, keys, value: str = "value",
                    extra_sums: dict[str, str] | None = None) -> DataFrame:
    """Distinct values per key with their row count ``n`` (and optional sums)."""
    keys = _keys(keys)
    aggs = [F.count(F.lit(1)).alias("n")]
    for out, c in (extra_sums or {}).items():
        aggs.append(F.sum(F.col(c)).alias(out))
    return long_df.groupBy(*keys, value).agg(*aggs)


def _number(c: F.Column, dtype: T.DataType) -> F.Column:
    """A double in the order of the column (ties may be added, never turned around)."""
    return F.unix_date(c).cast("double") if isinstance(dtype, T.DateType) else c.cast("double")


def _numbers(x: F.Column) -> F.Column:
    return F.count_if(x.isNotNull() & ~F.isnan(x))


def _sketch_quantiles(x: F.Column, probs: list[float]) -> F.Column:
    """Aggregate: values of ``x`` near the given probabilities (within ``SKETCH_ERROR`` of the rank), NaN left out; NULL
    without values."""
    sketch = F.kll_sketch_agg_double(x, F.lit(SKETCH_SIZE))
    return F.when(_numbers(x) > 0, F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(p)) for p in probs])))


def _counted_cuts(df: DataFrame, value: str, least: int = 2) -> tuple[int, list[float]]:
    """(rows of ``df``, cut points as in ``range_cuts``)."""
    x = _number(F.col(value), df.schema[value].dataType)
    parts = max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def cuts(b: int):
        return df.agg(F.count(F.lit(1)).alias("rows"), _numbers(x).alias("n"), _sketch_quantiles(x, [i / b for i in range(1, b)]).alias("g")).first()
    row = cuts(min(MAX_BUCKETS, parts))
    wanted = min(MAX_BUCKETS, math.ceil(int(row["n"]) / TARGET_BUCKET_ROWS))
    if wanted > parts:
        row = cuts(wanted)
    return int(row["rows"]), sorted(set(row["g"] or []))


def range_cuts(df: DataFrame, value: str = "value", least: int = 2) -> list[float]:
    """Cut points of ``value`` for the rank plan, from one sketch over the rows of ``df``: at least ``least`` buckets and one
    per shuffle partition, and about ``TARGET_BUCKET_ROWS`` rows in a bucket, up to ``MAX_BUCKETS``."""
    return _counted_cuts(df, value, least)[1]


def dealt(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """``df``, which has about ``rows`` rows, shuffled by the columns ``by`` into tasks of at most about ``TASK_ROWS`` rows each:
    what a task sorts or groups does not grow with the table."""
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / TASK_ROWS))
    return df.repartition(parts, *by)


def range_bucket(x: F.Column, cuts: list[float]) -> F.Column:
    """Number of cuts below ``x``, found by halving."""
    def halve(lo: int, hi: int) -> F.Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x > F.lit(float(cuts[mid])), halve(mid + 1, hi)).otherwise(halve(lo, mid))
    if len(cuts) < 64:  # compiled comparisons; more of them would not be compiled by the JVM
        return halve(0, len(cuts))
    table = F.array(*[F.lit(float(c)) for c in cuts])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(table, at + step - 1) < x, at + step).otherwise(at))


def bucketize(hist: DataFrame, keys, value: str = "value", n_col: str = "n",
              cuts: list[float] | None = None) -> tuple[DataFrame, DataFrame]:
    """Steps 2-3 of the rank plan: ``(hist + bucket, offsets)`` where ``offsets`` has one
    row per (key, bucket) with ``_off`` (rows before the bucket) and ``_bn`` (rows in it)."""
    keys = _keys(keys)
    cuts = range_cuts(hist, value) if cuts is None else cuts
    hb = hist.withColumn("bucket", range_bucket(_number(F.col(value), hist.schema[value].dataType), cuts))
    sizes = hb.groupBy(*keys, "bucket").agg(F.sum(n_col).alias("_bn"))
    w_off = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "bucket", "_bn", F.coalesce(F.sum("_bn").over(w_off), F.lit(0)).alias("_off"))
    return hb, offsets


def _rank_within(hb: DataFrame, offsets: DataFrame, keys: list[str], value: str, n_col: str) -> DataFrame:
    small = offsets.select(*keys, "bucket", "_off")
    # without keys the offsets are at most MAX_BUCKETS rows; with keys Spark's own size limit decides
    ranked = hb.join(small if keys else F.broadcast(small), keys + ["bucket"])
    # one window partition per (key, bucket): at most about TARGET_BUCKET_ROWS distinct values
    w_in = Window.partitionBy(*keys, "bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    cum = (F.col("_off") + F.coalesce(F.sum(n_col).over(w_in), F.lit(0))).cast("long")
    ranked = ranked.withColumn("cum_before", cum).drop("_off")
    return (ranked
            .withColumn("rank_lo", F.col("cum_before") + 1)
            .withColumn("rank_hi", F.col("cum_before") + F.col(n_col))
            .withColumn("avg_rank", F.col("cum_before") + (F.col(n_col) + 1) / 2.0))


def rank_distinct(hist: DataFrame, keys, value: str = "value", n_col: str = "n", cuts: list[float] | None = None) -> DataFrame:
    """Add ``cum_before``, ``rank_lo``, ``rank_hi``, ``avg_rank`` and ``bucket`` to a value histogram.

    ``avg_rank`` is the average 1-based rank of the tied rows holding ``value``
    (pandas ``rank(method='average')``), computed per key. ``cuts`` from ``range_cuts`` over the
    rows spare a pass over the histogram.
    """
    keys = _keys(keys)
    hb, offsets = bucketize(hist, keys, value, n_col, cuts)
    return _rank_within(hb, offsets, keys, value, n_col)


def join_by_counts(rows: DataFrame, table: DataFrame, on: list[str], n_col: str, spread: F.Column, how: str = "left",
                   hot_rows: int | None = None) -> DataFrame:
    """``rows`` joined with ``table``, which has one row per key and its number of rows ``n_col``. A key of more than
    ``hot_rows`` rows is dealt over as many tasks as it has that many rows; ``spread`` is a column of ``rows`` to deal
    by. The hot keys are at most ``rows / hot_rows``, so they are broadcast."""
    limit = HOT_ROWS if hot_rows is None else hot_rows
    deals = F.ceil(F.col(n_col) / limit).cast("int")
    hot = F.broadcast(table.where(F.col(n_col) > limit).select(*[F.col(c).alias(f"__hot_{c}") for c in on], deals.alias("__deals")))
    dealt = rows.join(hot, [rows[c] == hot[f"__hot_{c}"] for c in on], "left") \
                .withColumn("__deal", F.when(F.col("__deals").isNull(), 0).otherwise(F.pmod(F.xxhash64(spread), F.col("__deals"))).cast("int")) \
                .drop("__deals", *[f"__hot_{c}" for c in on])
    last = F.when(F.col(n_col) > limit, deals - 1).otherwise(0)
    copies = table.withColumn("__deal", F.explode(F.sequence(F.lit(0), last)))
    return dealt.join(copies, [*on, "__deal"], how).drop("__deal")


def row_ranks(df: DataFrame, value: str, keys, out: str, few_keys: bool = False) -> DataFrame:
    """``df`` with the average rank of ``value`` per key as column ``out``, without a join on the value.

    Rows carry their range bucket through one shuffle and are ranked by a window inside it. Every cut is a bucket of its
    own, so a value that many rows hold (the sketch puts a cut on it) needs no window: its rank follows from the bucket
    sizes, and its rows stay spread. ``few_keys`` says that the number of keys is set by the caller, not by the data;
    the bucket sizes are then broadcast. NULL values get a NULL rank; with NULL keys too."""
    keys = _keys(keys)
    dtype = df.schema[value].dataType
    n, cuts = _counted_cuts(df, value)
    x = _number(F.col(value), dtype)
    at = range_bucket(x, cuts)
    alone = F.lit(False)
    if cuts and isinstance(dtype, (T.FractionalType, T.IntegralType, T.DateType)) and not isinstance(dtype, T.DecimalType):
        on_cut = F.get(F.array(*[F.lit(float(c)) for c in cuts]), F.col("__at")) == x
        alone = F.coalesce(on_cut & (F.abs(x) < float(1 << 53)), F.lit(False))  # beyond it several whole numbers share a double
    rows = (df.withColumn("__at", at).withColumn("__alone", alone)
            .withColumn("__bucket", F.when(F.col(value).isNotNull(), 2 * F.col("__at") + F.col("__alone").cast("int"))).drop("__at"))
    sizes = rows.where("__bucket is not null").groupBy(*keys, "__bucket").agg(F.count(F.lit(1)).alias("__bn"))
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__off", F.coalesce(F.sum("__bn").over(before), F.lit(0)))
    if not keys or few_keys:  # at most keys x 2 x MAX_BUCKETS rows
        placed = rows.join(F.broadcast(sizes), [*keys, "__bucket"], "left")
    else:
        placed = join_by_counts(rows, sizes, [*keys, "__bucket"], "__bn", F.struct(*df.columns))
    placed = placed.withColumn("__deal", F.when(F.col("__alone") | F.col("__bucket").isNull(), F.spark_partition_id()).otherwise(-1))
    placed = dealt(placed, n, *keys, "__bucket", "__deal")
    inside = Window.partitionBy(*keys, "__bucket", "__deal")
    ties = Window.partitionBy(*keys, "__bucket", "__deal", value)
    rank = F.rank().over(inside.orderBy(value)) + (F.count(F.lit(1)).over(ties) - 1) / 2.0
    rank = F.when(F.col("__alone"), (F.col("__bn") + 1) / 2.0).otherwise(rank) + F.col("__off")
    return placed.select(*df.columns, F.when(F.col("__bucket").isNotNull(), rank).alias(out))


def avg_rank_column(df: DataFrame, col: str, out: str | None = None, by=None) -> DataFrame:
    """``df`` with the average rank of ``col`` (within ``by`` groups) as a new column.

    NULL values and values of a NULL group get a NULL rank; ranks count only non-null values."""
    return row_ranks(df, col, by, out or f"{col}_rank")


# ---------------------------------------------------------------- quantiles

def _quantiles_percentile(df: DataFrame, cols: list[str], probs: list[float], by: list[str]) -> DataFrame:
    aggs = [F.percentile(F.col(c).cast("double"), F.array(*[F.lit(float(p)) for p in probs])).alias(c)
            for c in cols]
    wide = df.groupBy(*by).agg(*aggs)
    stacked = wide.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("_qs")) for c in cols])).alias("_s"))
    return (stacked.select(*by, "_s.column", F.posexplode("_s._qs").alias("q_index", "value"))
            .withColumn("prob", F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("q_index") + 1))
            .select(*by, "column", "q_index", "prob", "value"))


def _quantiles_rank(df: DataFrame, cols: list[str], probs: list[float], by: list[str]) -> DataFrame:
    keys = by + ["column"]
    long_df = unpivot_values(df, cols, keep=by)
    hb, offsets = bucketize(value_histogram(long_df, keys), keys, cuts=range_cuts(long_df))
    return _positions(hb, offsets, _totals(offsets, keys, probs), keys).select(*by, "column", "q_index", "prob", "value")


def _totals(offsets: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    return offsets.groupBy(*keys).agg(F.sum("_bn").alias("_N")).withColumn("_probs", F.array(*[F.lit(float(p)) for p in probs]))


def _positions(hb: DataFrame, offsets: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """Linear quantiles per key from a bucketed histogram: ``(key..., q_index, prob, value)``; ``totals`` has the rows ``_N``
    and the wanted ``_probs`` of every key. Only buckets that hold a wanted position are ranked value by value."""
    # target positions (1-based) of the two neighbours of h = (N-1) q
    tg = totals.select(*keys, "_N", F.posexplode("_probs").alias("q_index", "prob"))
    tg = tg.withColumn("_h", (F.col("_N") - 1) * F.col("prob")) \
           .withColumn("_frac", F.col("_h") - F.floor("_h")) \
           .withColumn("_side", F.explode(F.array(F.lit(0), F.lit(1)))) \
           .withColumn("_pos", F.when(F.col("_side") == 0, F.floor("_h")).otherwise(F.ceil("_h")).cast("long") + 1)
    # the bucket holding each target position comes from the (small) offsets table
    tgb = tg.join(offsets, keys).where((F.col("_pos") > F.col("_off")) & (F.col("_pos") <= F.col("_off") + F.col("_bn"))) \
            .select(*keys, "bucket", "q_index", "prob", "_frac", "_side", "_pos")
    need = tgb.select(*keys, "bucket").distinct()
    ranked = _rank_within(hb.join(need, keys + ["bucket"], "left_semi"), offsets, keys, "value", "n")
    hit = ranked.select(*keys, "bucket", "value", "rank_lo", "rank_hi").join(tgb, keys + ["bucket"]) \
                .where((F.col("_pos") >= F.col("rank_lo")) & (F.col("_pos") <= F.col("rank_hi")))
    res = hit.groupBy(*keys, "q_index", "prob").agg(
        F.max(F.when(F.col("_side") == 0, F.col("value"))).alias("_lo"),
        F.max(F.when(F.col("_side") == 1, F.col("value"))).alias("_hi"),
        F.first("_frac").alias("_frac"))
    return res.select(*keys, "q_index", "prob", (F.col("_lo") + F.col("_frac") * (F.col("_hi") - F.col("_lo"))).alias("value"))


class GroupedValues:
    """The values of one column per group as one written histogram, from which all statistics of a group's distribution
    come: rows ``(group..., bucket, value, n, <sums>)``, one per distinct value, in range buckets that no group fills
    beyond its share of the bucket (64 or more: only those that hold a wanted position are sorted). Statistics of a group reach its values through ``(group, bucket)``, so the values of
    a group that holds much of the table stay spread. Rows with a NULL group or value do not count."""

    def __init__(self, df: DataFrame, by, value: str, sums: dict[str, str] | None = None):
        self.by = _keys(by)
        rows = df.select(*self.by, F.col(value).cast("double").alias("value"),
                         *[F.col(c).cast("double").alias(f"_in_{out}") for out, c in (sums or {}).items()]).dropna(subset=[*self.by, "value"])
        hist = value_histogram(rows, self.by, "value", {out: f"_in_{out}" for out in sums or {}})
        self.hist = written(hist.withColumn("bucket", range_bucket(F.col("value"), range_cuts(rows, least=64))), "grouped-values")
        sizes = self.hist.groupBy(*self.by, "bucket").agg(F.sum("n").alias("_bn"), F.count(F.lit(1)).alias("_distinct"),
                                                          F.min("value").alias("_lo"), F.max("value").alias("_hi"))
        before = Window.partitionBy(*self.by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        self.buckets = written(sizes.withColumn("_off", F.coalesce(F.sum("_bn").over(before), F.lit(0))), "grouped-buckets")

    def groups(self) -> DataFrame:
        """``(group..., n, distinct, min, max)``."""
        return self.buckets.groupBy(*self.by).agg(F.sum("_bn").alias("n"), F.sum("_distinct").alias("distinct"),
                                                  F.min("_lo").alias("min"), F.max("_hi").alias("max"))

    def quantiles(self, probs) -> DataFrame:
        """``(group..., q_index, prob, value)``: linear quantiles at ``probs``, or at the array that ``probs`` (a function of
        the columns of ``groups``) gives for a group."""
        wanted = probs if callable(probs) else lambda: F.array(*[F.lit(float(p)) for p in probs])
        totals = self.groups().select(*self.by, F.col("n").alias("_N"), wanted().alias("_probs"))
        return _positions(self.hist, self.buckets.select(*self.by, "bucket", "_bn", "_off"), totals, self.by)

    def values_with(self, stats: DataFrame) -> DataFrame:
        """The histogram with the columns of ``stats`` (one row per group; groups without one fall out)."""
        per_bucket = self.buckets.select(*self.by, "bucket").join(stats, self.by)
        return self.hist.join(per_bucket, [*self.by, "bucket"])


def quantiles(df: DataFrame, cols: list[str], probs: list[float], by=None, mode: str = "auto") -> DataFrame:
    """Exact linear-interpolated quantiles (pandas ``quantile``, DuckDB ``quantile_cont``).

    Returns the long table ``(by..., column, q_index, prob, value)``; NULLs are ignored,
    an all-NULL column (or group) gives no value.

    ``mode``: ``"auto"`` = whole-table quantiles by narrowing brackets, grouped quantiles by the bucketed rank plan;
    ``"rank"`` = the rank plan (same answer); ``"exact"`` = Spark ``percentile`` (same answer, one aggregation whose
    buffer holds every distinct value of a group); ``"approx"`` = ``percentile_approx`` (data values, not interpolated).
    """
    by = _keys(by)
    cols = list(cols)
    probs = [float(p) for p in probs]
    if mode == "exact":
        return _quantiles_percentile(df, cols, probs, by)
    if mode == "approx":
        aggs = [F.percentile_approx(F.col(c).cast("double"), probs, 100_000).alias(c) for c in cols]
        wide = df.groupBy(*by).agg(*aggs)
        st = wide.select(*by, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("_qs"))
                                                 for c in cols])).alias("_s"))
        return (st.select(*by, "_s.column", F.posexplode("_s._qs").alias("q_index", "value"))
                .withColumn("prob", F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("q_index") + 1))
                .select(*by, "column", "q_index", "prob", "value"))
    if mode not in ("auto", "rank"):
        raise ValueError(f"unknown quantile mode {mode!r}")
    if by or mode == "rank":
        return _quantiles_rank(df, cols, probs, by)
    return _quantiles_select(df, cols, probs)


class _Bracket:
    """Values from ``lo`` to ``hi`` of the ``at``-th column that should hold the 0-based ``positions``."""

    def __init__(self, at: int, lo: float, hi: float, positions: set[int]):
        self.at, self.lo, self.hi, self.positions = at, lo, hi, positions

    def value(self) -> F.Column:
        return F.col(f"x{self.at}")


def _merged(brackets: list[_Bracket]) -> list[_Bracket]:
    """Overlapping brackets of a column become one, so no value is counted twice."""
    out: list[_Bracket] = []
    for b in sorted(brackets, key=lambda b: (b.at, b.lo)):
        last = out[-1] if out else None
        if last is not None and last.at == b.at and b.lo <= last.hi:
            out[-1] = _Bracket(b.at, last.lo, max(last.hi, b.hi), last.positions | b.positions)
        else:
            out.append(b)
    return out


def _below(b: _Bracket) -> F.Column:
    return F.count_if(b.value() < F.lit(b.lo))


def _hits(xs: DataFrame, some: list[tuple[int, _Bracket]]) -> DataFrame:
    """``(t, v)``: values of ``xs`` inside the numbered brackets, one row each."""
    of: dict[int, F.Column] = {}
    for t, b in some:
        inside, number = b.value().between(F.lit(b.lo), F.lit(b.hi)), F.lit(t)
        of[b.at] = of[b.at].when(inside, number) if b.at in of else F.when(inside, number)
    cols = [f"x{at}" for at in of]
    marked = xs.select(*cols, *[e.alias(f"t{at}") for at, e in of.items()])
    return (marked.select(F.explode(F.array(*[F.struct(F.col(f"t{at}").alias("t"), F.col(f"x{at}").alias("v")) for at in of])).alias("s"))
            .select("s.*").where("t is not null"))


def _count_inside(xs: DataFrame, brackets: list[_Bracket]) -> dict[tuple[int, int], float]:
    """Value at every wanted position that its bracket holds. One scan groups the values inside the brackets, one counts
    those below; a window per bracket places them, and one row per position reaches the driver."""
    spark = xs.sparkSession
    numbered = list(enumerate(brackets))
    hits = None
    while numbered:  # a few columns at a time: the generated code stays small enough to be compiled
        last = numbered[min(len(numbered), HIT_BRACKETS) - 1][1].at
        some = [(t, b) for t, b in numbered if b.at <= last]
        numbered = numbered[len(some):]
        part = _hits(xs, some)
        hits = part if hits is None else hits.union(part)
    hist = hits.groupBy("t", "v").agg(F.count(F.lit(1)).alias("n"))
    inside = hist.withColumn("upto", F.sum("n").over(Window.partitionBy("t").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
    below = xs.agg(F.array(*[F.struct(F.lit(i).alias("t"), _below(b).alias("below")) for i, b in enumerate(brackets)]).alias("b")) \
              .select(F.explode("b").alias("b")).select("b.*")
    wanted = spark.createDataFrame([(i, p) for i, b in enumerate(brackets) for p in sorted(b.positions)], "t int, pos long")
    # both small sides hold one row per bracket or position, a number set by the call
    at = F.col("pos") - F.col("below")
    rows = (inside.join(F.broadcast(below), "t").join(F.broadcast(wanted), "t")
            .where((at < F.col("upto")) & (at >= F.col("upto") - F.col("n"))).select("t", "pos", "v").collect())
    return {(brackets[r["t"]].at, r["pos"]): r["v"] for r in rows}


def _narrowed(xs: DataFrame, brackets: list[_Bracket]) -> tuple[list[_Bracket], list[_Bracket]]:
    """(brackets of at most ``FINISH_ROWS`` values between their ends, narrower brackets for the others), from one
    aggregate: rows below each bracket, on its lower end and between its ends, and a sketch of the values between. A
    position on an end has that value; any other bracket shrinks to values between its ends, so each round gets nearer.
    A bracket that misses a position is replaced by what lies on that side of it."""
    grid = [j / NARROW_GRID for j in range(NARROW_GRID + 1)]
    aggs = []
    for i, b in enumerate(brackets):
        x, lo, hi = b.value(), F.lit(float(b.lo)), F.lit(float(b.hi))
        between = (x > lo) & (x < hi)
        aggs += [_below(b).alias(f"b{i}"), F.count_if(x == lo).alias(f"e{i}"), F.count_if(between).alias(f"o{i}"),
                 F.count_if(x.between(lo, hi)).alias(f"n{i}"), _sketch_quantiles(F.when(between, x), grid).alias(f"g{i}")]
    row = xs.agg(*aggs).first()
    ready, again = [], []
    margin = math.ceil(2 * SKETCH_ERROR * NARROW_GRID)
    for i, b in enumerate(brackets):
        below, on_lo, between, inside, g = (row[f"{k}{i}"] for k in "beong")
        for p in b.positions:
            if p < below:
                again.append(_Bracket(b.at, -math.inf, b.lo, {p}))
            elif p >= below + inside:
                again.append(_Bracket(b.at, b.hi, math.inf, {p}))
            elif p < below + on_lo:
                ready.append(_Bracket(b.at, b.lo, b.lo, {p}))
            elif p >= below + on_lo + between:
                ready.append(_Bracket(b.at, b.hi, b.hi, {p}))
            elif between <= FINISH_ROWS:
                ready.append(_Bracket(b.at, b.lo, b.hi, {p}))
            else:
                at = (p - below - on_lo) / between * NARROW_GRID
                again.append(_Bracket(b.at, g[max(0, math.floor(at) - margin)], g[min(NARROW_GRID, math.ceil(at) + margin)], {p}))
    return _merged(ready), again  # not merged: joined brackets would grow again


def _quantiles_select(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """Whole-table exact quantiles by selection.

    One sketch of every column brackets the wanted positions. Brackets that may hold more than ``FINISH_ROWS`` values are
    narrowed by sketches over the values inside them, each time to about one hundredth; then the values inside are
    counted exactly on the executors. The sketches only choose the brackets: counts below and inside say which position
    a value has, and a bracket that misses its position is widened, so the answer is exact. The driver sees bracket ends
    and one value per position."""
    # NaN is above every number: no bracket holds it, no sketch takes it, so only the row counts must leave it out
    xs = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    grid = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-2 * SKETCH_ERROR, 2 * SKETCH_ERROR)})
    row = xs.agg(*[a for c in xs.columns for a in (_numbers(F.col(c)).alias(f"n_{c}"), _sketch_quantiles(F.col(c), grid).alias(f"g_{c}"))]).first()
    sizes, ready, wide = {}, [], []
    for i, c in enumerate(xs.columns):
        n = int(row[f"n_{c}"])
        if n == 0:
            continue
        sizes[i] = n
        ends = dict(zip(grid, row[f"g_{c}"], strict=True))
        brackets = []
        for p in probs:
            h = (n - 1) * p
            lo, hi = p - 2 * SKETCH_ERROR, p + 2 * SKETCH_ERROR
            brackets.append(_Bracket(i, ends[lo] if lo > 0 else -math.inf, ends[hi] if hi < 1 else math.inf, {math.floor(h), math.ceil(h)}))
        small = 5 * SKETCH_ERROR * n * len(probs) <= FINISH_ROWS
        (ready if small else wide).extend(_merged(brackets))
    found: dict[tuple[int, int], float] = {}
    while ready or wide:
        if wide:
            more, wide = _narrowed(xs, wide)
            ready = _merged(ready + more)
        if ready and not wide:
            found |= _count_inside(xs, sorted(ready, key=lambda b: b.at))
            missed = [b for b in ready if any((b.at, p) not in found for p in b.positions)]
            ready, wide = [], [_Bracket(b.at, b.lo, b.hi, {p for p in b.positions if (b.at, p) not in found}) for b in missed]
    out = []
    for i, n in sizes.items():
        for qi, p in enumerate(probs):
            h = (n - 1) * p
            a, b = math.floor(h), math.ceil(h)
            va, vb = found[i, a], found[i, b]
            out.append((cols[i], qi, p, float(va if va == vb else (b - h) * va + (h - a) * vb)))
    return df.sparkSession.createDataFrame(out, "column string, q_index int, prob double, value double")


def quantile_map(df: DataFrame, cols: list[str], probs: list[float], mode: str = "auto") -> dict:
    """``{(column, prob): value}`` for whole-table quantiles; the result has ``len(cols) * len(probs)`` entries."""
    rows = quantiles(df, cols, probs, mode=mode).collect()
    return {(r["column"], round(r["prob"], 12)): r["value"] for r in rows}


# ---------------------------------------------------------------- hash-ordered ranks (folds, samples)

def hash_key(id_col: str, seed) -> F.Column:
    """md5 of ``'<id>|<seed>'`` as hex text: the deterministic shuffle key."""
    return F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(str(seed))))


def hash_rank(df: DataFrame, id_col: str, seed, strata=None, out: str = "hash_rank", at_most: int | None = None) -> DataFrame:
    """1-based rank of each row by ``(md5(id|seed), id)`` inside each stratum.

    Planned as (stratum, md5 prefix bucket) counts -> running offsets ->
    ``row_number`` inside each (stratum, bucket). A stratum holding a third of
    the table still spreads over 16^4 buckets. ``at_most`` says that only ranks up to it are wanted: buckets that
    start beyond it are dropped before any row is moved or sorted (ranks up to ``at_most`` are all there).
    """
    strata = _keys(strata)
    h = df.withColumn("_h", hash_key(id_col, seed)) \
          .withColumn("_hb", F.conv(F.substring("_h", 1, HASH_PREFIX), 16, 10).cast("int"))
    sizes = h.groupBy(*strata, "_hb").agg(F.count(F.lit(1)).alias("_bn"))
    w_off = Window.partitionBy(*strata).orderBy("_hb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*strata, "_hb", F.coalesce(F.sum("_bn").over(w_off), F.lit(0)).alias("_off"))
    if at_most is not None:
        offsets = offsets.where(F.col("_off") < at_most)
    if strata:
        joined = h.join(offsets, [*strata, "_hb"])
    else:
        joined = h.join(offsets, ["_hb"])
    w_in = Window.partitionBy(*strata, "_hb").orderBy("_h", id_col)
    return joined.withColumn(out, (F.col("_off") + F.row_number().over(w_in)).cast("long")) \
                 .drop("_h", "_hb", "_off")


def kfold(df: DataFrame, id_col: str, k: int = 5, seed=42, strata=None, exact: bool = True,
          out: str = "fold") -> DataFrame:
    """Assign a ``fold`` in ``0..k-1``.

    ``exact=True``: within each stratum fold sizes differ by at most one
    (rank by hash, modulo k). ``exact=False``: fold = hash mod k, a pure
    projection with no shuffle, sizes equal only in expectation.
    """
    if not exact:
        return df.withColumn(out, (F.conv(F.substring(hash_key(id_col, seed), 1, 8), 16, 10)
                                   .cast("long") % k).cast("int"))
    r = hash_rank(df, id_col, seed, strata, out="_r")
    return r.withColumn(out, ((F.col("_r") - 1) % k).cast("int")).drop("_r")


def sample_n(df: DataFrame, n: int, id_col: str, seed=42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, deterministic in ``seed``."""
    return hash_rank(df, id_col, seed, out="_r", at_most=n).where(F.col("_r") <= n).drop("_r")


def stratified_subsample(df: DataFrame, n: int, id_col: str, label: str, seed=42) -> DataFrame:
    """``n`` rows keeping the positive share: ``k_pos = int(n * mean(label))``, rest negatives.

    The two class limits come from one aggregate row; each class keeps its
    ``k`` smallest hash ranks.
    """
    stats = df.agg(F.avg(F.col(label).cast("double")).alias("_m"))
    k_pos = F.floor(F.lit(n) * F.col("_m")).cast("long")
    lim = stats.select(k_pos.alias("_kpos"), (F.lit(n) - k_pos).alias("_kneg"))
    r = hash_rank(df, id_col, seed, strata=[label], out="_r", at_most=n).crossJoin(F.broadcast(lim))
    keep = F.when(F.col(label) == 1, F.col("_r") <= F.col("_kpos")).otherwise(F.col("_r") <= F.col("_kneg"))
    return r.where(F.col(label).isin(0, 1) & keep).drop("_r", "_kpos", "_kneg")


# ---------------------------------------------------------------- quantile bins (qcut)

def qcut_edges(df: DataFrame, col: str, q: int, by=None, mode: str = "auto") -> DataFrame:
    """Distinct linear quantile edges at ``i/q`` as one sorted array per group:
    ``(by..., edges)``; size ``<= q+1`` per group."""
    by = _keys(by)
    qs = quantiles(df, [col], [i / q for i in range(q + 1)], by=by, mode=mode)
    return qs.groupBy(*by).agg(F.array_sort(F.array_distinct(F.collect_list("value"))).alias("edges"))


def qcut_code(x: F.Column, edges: F.Column) -> F.Column:
    """pandas ``qcut(..., labels=False, duplicates='drop')`` code from an edges array column:
    number of interior edges below ``x``; NULL for NULL ``x`` or fewer than two edges,
    NULL outside ``[first, last]`` edge."""
    n = F.size(edges)
    inner = F.slice(edges, 2, F.greatest(n - 2, F.lit(1)))
    code = F.when(n == 2, F.lit(0)).otherwise(F.size(F.filter(inner, lambda e: e < x)))
    ok = x.isNotNull() & (n >= 2) & (x >= F.element_at(edges, 1)) & (x <= F.element_at(edges, -1))
    return F.when(ok, code.cast("int"))


def safe_stratify_bins(df: DataFrame, col: str, max_q: int = 12, min_q: int = 5, n_splits: int = 5,
                       out: str = "bin", mode: str = "auto") -> DataFrame:
    """Quantile-bin codes with the largest ``q`` in ``[min_q, max_q]`` whose bins all hold at
    least ``n_splits`` rows, else ``min_q`` (missing codes -> 0 in the fallback).

    All candidate edges come from one quantile job (the union of the ``i/q``
    grids), all candidate bin sizes from one aggregation; the choice is made
    from ``max_q - min_q + 1`` small rows."""
    qs = list(range(min_q, max_q + 1))
    probs = sorted({round(i / q, 12) for q in qs for i in range(q + 1)})
    vals = {round(r["prob"], 12): r["value"] for r in quantiles(df, [col], probs, mode=mode).collect()}
    edges = {q: sorted({vals.get(round(i / q, 12)) for i in range(q + 1)} - {None}) for q in qs}
    x = F.col(col).cast("double")
    codes = F.array(*[F.struct(F.lit(q).alias("q"),
                               qcut_code(x, F.array(*[F.lit(float(e)) for e in edges[q]])).alias("b")) for q in qs
                      if len(edges[q]) >= 2])
    counts = (df.select(F.explode(codes).alias("_c")).groupBy("_c.q", "_c.b").agg(F.count(F.lit(1)).alias("n"))
              .groupBy("q").agg(F.min(F.when(F.col("b").isNotNull(), F.col("n"))).alias("mn"),
                                F.count_if(F.col("b").isNull()).alias("nulls")).collect())
    ok = [r["q"] for r in counts if r["nulls"] == 0 and r["mn"] is not None and r["mn"] >= n_splits]
    if ok:
        q = max(ok)
        return df.withColumn(out, qcut_code(x, F.array(*[F.lit(float(e)) for e in edges[q]])))
    e = edges[min_q]
    if len(e) < 2:
        return df.withColumn(out, F.lit(0))
    return df.withColumn(out, F.coalesce(qcut_code(x, F.array(*[F.lit(float(v)) for v in e])), F.lit(0)))

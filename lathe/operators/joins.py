"""Key joins the reference does by position or lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.operators.ranks import join_by_counts


def attach_by_key(left: DataFrame, right: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """Positional re-assembly becomes an equi-join on the carried key; the planner
    picks sort-merge or broadcast from measured sizes (AQE)."""
    return left.join(right, key, how)


def lookup_map(col: str, mapping: dict, default=None) -> F.Column:
    """J3 for small fixed dictionaries: a literal map lookup, unmatched -> ``default``."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    hit = F.try_element_at(m, F.col(col))
    return hit if default is None else F.coalesce(hit, F.lit(default))


def lookup_table(df: DataFrame, table: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """J3 for dictionaries held as a table: left join on the key (unmatched -> NULL)."""
    t = table.select(F.col(key).alias("_lk"), F.col(value).alias(out or value))
    return df.join(t, df[key] == t["_lk"], "left").drop("_lk")


def keep_frequent(df: DataFrame, col: str, min_count: int) -> DataFrame:
    """Rows whose category occurs at least ``min_count`` times. The frequent set is a count aggregate of at most
    ``rows / min_count`` keys, joined back by its counts, so a common category is dealt over many tasks."""
    freq = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= min_count)
    return join_by_counts(df, freq, [col], "__n", F.struct(*df.columns), "inner").select(*df.columns)

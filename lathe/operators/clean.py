"""Row filters and cleaning steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def where_all(df: DataFrame, **equals) -> DataFrame:
    """Rows where every named column equals its value (``month='feb', day=29``)."""
    cond = F.lit(True)
    for c, v in equals.items():
        cond = cond & (F.col(c) == F.lit(v))
    return df.where(cond)


def where_in(df: DataFrame, col: str, values) -> DataFrame:
    """``isin`` filter (pushed to the Parquet scan as an In predicate)."""
    return df.where(F.col(col).isin(list(values)))


def drop_missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """P10: keep rows where all listed columns are present."""
    return df.dropna(how="any", subset=cols)


def fill_missing(df: DataFrame, value, cols: list[str] | None = None) -> DataFrame:
    """Constant fill of the listed columns (all columns of a matching type by default)."""
    if cols is None:
        return df.fillna(value)
    return df.select(*[F.coalesce(F.col(c), F.lit(value)).alias(c) if c in cols else F.col(c) for c in df.columns])


def drop_duplicate_rows(df: DataFrame, enabled: bool = True, subset: list[str] | None = None) -> DataFrame:
    """Whole-row dedup (NULL equals NULL); a no-op when disabled."""
    return df.dropDuplicates(subset) if enabled else df


def head_transposed(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``key`` with columns as rows: ``(column, row, value)``.

    ``orderBy(key).limit(n)`` plans as a top-n per partition plus a merge of
    ``n x partitions`` rows; the row number runs over those ``n`` rows only."""
    top = df.orderBy(key).limit(n)
    cols = df.columns
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    w = Window.partitionBy(F.lit(0)).orderBy(key)
    return top.withColumn("row", F.row_number().over(w) - 1) \
              .select("row", F.explode(arr).alias("_kv")).select("_kv.column", "row", "_kv.value")

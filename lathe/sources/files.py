"""File sources and sinks (CSV, delimited text, Parquet tables, prediction files)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Turn NaN into NULL in every float/double column, so aggregates see one kind of missing."""
    want = set(cols) if cols is not None else None
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (want is None or f.name in want):
            out.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def read_parquet(spark: SparkSession, path: str, clean_nan: bool = True, where=None,
                 columns: list[str] | None = None) -> DataFrame:
    """Parquet with NaN turned into NULL.

    ``nan_to_null`` wraps float columns in ``nanvl``, which Catalyst cannot push
    into the scan, so a row filter on a float column belongs in ``where``: it
    is applied to the raw columns first and reaches the Parquet reader as a
    pushed filter (a NaN compares as the largest value there). Filters on
    other types push down either way; column pruning always does."""
    df = spark.read.parquet(path)
    if columns is not None:
        df = df.select(*columns)
    if where is not None:
        df = df.where(where)
    return nan_to_null(df) if clean_nan else df


def read_table(spark: SparkSession, sf_dir: str, name: str, clean_nan: bool = True, where=None,
               columns: list[str] | None = None) -> DataFrame:
    """One of the driver tables under ``sf_dir``."""
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", clean_nan, where, columns)


def read_table_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                   sep: str = ",", quote: str = '"', infer_schema: bool = False,
                   clean_nan: bool = True) -> DataFrame:
    """CSV with a header row (S1). An explicit schema is the default path;
    inference costs an extra pass and turns all-empty columns into strings."""
    r = spark.read.option("header", True).option("sep", sep).option("quote", quote)
    if schema is not None:
        r = r.schema(schema)
    elif infer_schema:
        r = r.option("inferSchema", True)
    df = r.csv(path)
    return nan_to_null(df) if clean_nan else df


def read_delimited(spark: SparkSession, path: str, schema=None, sep: str = ";", quote: str = '"',
                   infer_schema: bool = False) -> DataFrame:
    """Semicolon separated text with double quotes."""
    return read_table_csv(spark, path, schema=schema, sep=sep, quote=quote, infer_schema=infer_schema)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)
    return path


def write_predictions(df: DataFrame, path: str, id_col: str = "id",
                      pred_cols: list[str] | tuple[str, ...] = ("prediction",),
                      mode: str = "overwrite") -> str:
    """``(id, prediction...)`` CSV with a header and no index column (S3).

    Written by all tasks in parallel as part files; no coalesce to one file,
    which would funnel the whole table through one task.
    """
    df.select(id_col, *pred_cols).write.mode(mode).option("header", True).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path

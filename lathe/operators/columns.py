"""Column roles and schema-level steps.

Decisions that depend on data (distinct counts, ranges) are made from one
aggregate row computed for all columns at once, never one job per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)

# fixed values: target names tried in this order by detect_target
TARGET_CANDIDATES = ["BPM", "bpm", "tempo", "Tempo", "target", "BeatsPerMinute"]


def drop_columns(df: DataFrame, cols, missing_ok: bool = True) -> DataFrame:
    """Drop columns; absent names are ignored unless ``missing_ok=False``."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    if not missing_ok:
        absent = [c for c in cols if c not in df.columns]
        if absent:
            raise KeyError(f"columns not found: {absent}")
    return df.drop(*cols)


def feature_columns(df: DataFrame, key: str | None = "id", target: str | None = None) -> list[str]:
    """Every column except the carried key and the target."""
    return [c for c in df.columns if c not in {key, target}]


def is_numeric_type(dt: T.DataType) -> bool:
    return isinstance(dt, _INTEGRAL + _FRACTIONAL)


def columns_by_kind(df: DataFrame, kind: str = "numeric", exclude=None) -> list[str]:
    """Column names by type. ``numeric`` excludes booleans; ``categorical`` is strings."""
    exclude = set(exclude or [])
    test = {
        "numeric": lambda t: is_numeric_type(t),
        "integer": lambda t: isinstance(t, _INTEGRAL),
        "float": lambda t: isinstance(t, _FRACTIONAL),
        "categorical": lambda t: isinstance(t, T.StringType),
        "bool": lambda t: isinstance(t, T.BooleanType),
    }[kind]
    return [f.name for f in df.schema.fields if test(f.dataType) and f.name not in exclude]


def numeric_columns(df: DataFrame, exclude=None) -> list[str]:
    return columns_by_kind(df, "numeric", exclude)


def has_target(df: DataFrame, target: str) -> bool:
    return target in df.columns


def detect_target(df: DataFrame, candidates=None) -> str:
    """First candidate name present, else ``KeyError``."""
    for c in candidates or TARGET_CANDIDATES:
        if c in df.columns:
            return c
    raise KeyError("no target column among candidates")


def describe_roles(df: DataFrame, target: str | None = None, candidates=None) -> tuple[str, list[str]]:
    """P5: ``(target, numeric features)``."""
    t = target or detect_target(df, candidates)
    return t, numeric_columns(df, exclude=[t, "id"])


#: A distinct sketch of this many bits keeps up to 2^12 values as they are: below that its count is exact.
SKETCH_BITS = 12


def _sketch_value(df: DataFrame, col: str) -> F.Column:
    """A column as the distinct sketch takes it, one value per distinct value (the sketch skips empty text)."""
    dt = df.schema[col].dataType
    if isinstance(dt, _INTEGRAL):
        return F.col(col).cast("bigint")
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.col(col).cast("double")
    return F.concat(F.lit("="), F.col(col).cast("string"))


def distinct_up_to(df: DataFrame, cols: list[str], k: int) -> dict[str, int | None]:
    """Distinct non-null values per column where there are at most ``k``, else None: one scan whose state is one sketch a
    column, merged from task to task, of at least four times ``k`` hashes (4,096 or more; ``k`` up to 16 million). So
    many values a sketch holds as their 64-bit hashes, all of them, so its count is that of the values (among 4,096 two
    share a hash in one of 10^12 columns)."""
    if not cols:
        return {}
    row = _sketch_counts(df, cols, max(SKETCH_BITS, (4 * k).bit_length()))
    return {c: row[c] if row[c] <= k else None for c in cols}


def _sketch_counts(df: DataFrame, cols: list[str], bits: int = SKETCH_BITS) -> dict[str, int]:
    row = df.agg(*[F.theta_sketch_estimate(F.theta_sketch_agg(_sketch_value(df, c), bits)).alias(f"d{i}") for i, c in enumerate(cols)]).first()
    return {c: int(row[f"d{i}"] or 0) for i, c in enumerate(cols)}


def distinct_counts(df: DataFrame, cols: list[str]) -> dict[str, int]:
    """Exact distinct non-null counts of many columns: one scan of sketches settles the columns with few values; each
    other column is counted by an aggregate over that column alone, all of them in one job."""
    if not cols:
        return {}
    out = _sketch_counts(df, cols)
    wide = [c for c in cols if out[c] > 1 << SKETCH_BITS]
    counted = None
    for c in wide:
        one = df.agg(F.count_distinct(F.col(c)).alias("n")).select(F.lit(c).alias("c"), "n")
        counted = one if counted is None else counted.union(one)
    return out | ({r["c"]: int(r["n"]) for r in counted.collect()} if wide else {})


def split_columns(df: DataFrame, max_cardinality: int = 30, exclude=None) -> tuple[list[str], list[str]]:
    """``(numeric, categorical)``; integers with <= ``max_cardinality`` distinct
    values are categorical, string/bool columns above it are dropped, booleans join
    the categoricals and the categorical list is sorted."""
    exclude = set(exclude or [])
    ints = [c for c in columns_by_kind(df, "integer") if c not in exclude]
    flts = [c for c in columns_by_kind(df, "float") if c not in exclude]
    cats = [c for c in columns_by_kind(df, "categorical") if c not in exclude]
    bools = [c for c in columns_by_kind(df, "bool") if c not in exclude]
    few = distinct_up_to(df, ints + cats + bools, max_cardinality)
    numeric = flts + [c for c in ints if few[c] is None]
    numeric = [c for c in df.columns if c in set(numeric)]
    categorical = [c for c in ints + cats + bools if few[c] is not None]
    return numeric, sorted(set(categorical))


def is_discrete_numeric(df: DataFrame, col: str, max_unique: int = 20) -> bool:
    """Numeric with at most ``max_unique`` distinct values."""
    if not is_numeric_type(df.schema[col].dataType):
        return False
    return distinct_up_to(df, [col], max_unique)[col] is not None


def is_regression(df: DataFrame, target: str, max_unique: int = 20) -> bool:
    """Numeric target with more than ``max_unique`` distinct values."""
    if not is_numeric_type(df.schema[target].dataType):
        return False
    return distinct_up_to(df, [target], max_unique)[target] is None


def narrow_types(df: DataFrame, cols: list[str] | None = None, floats: bool = True) -> DataFrame:
    """Smallest integer type whose open range holds (min, max); doubles to float
    when the range fits float32. One min/max aggregation for all columns."""
    cols = cols or numeric_columns(df)
    if not cols:
        return df
    row = df.agg(*[F.min(c).alias(f"{c}__min") for c in cols],
                 *[F.max(c).alias(f"{c}__max") for c in cols]).first()
    f32 = 3.4028234663852886e38
    casts = {}
    for c in cols:
        lo, hi = row[f"{c}__min"], row[f"{c}__max"]
        dt = df.schema[c].dataType
        if lo is None:
            continue
        if isinstance(dt, _INTEGRAL):
            for name, (a, b) in (("tinyint", (-128, 127)), ("smallint", (-32768, 32767)),
                                 ("int", (-2 ** 31, 2 ** 31 - 1))):
                if a < lo and hi < b:
                    casts[c] = name
                    break
        elif floats and isinstance(dt, T.DoubleType) and -f32 < lo and hi < f32:
            casts[c] = "float"
    return df.select(*[F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns])


def cast_numeric_float32(df: DataFrame, exclude=None) -> DataFrame:
    """Every integer/float column to float32."""
    num = set(numeric_columns(df, exclude))
    return df.select(*[F.col(c).cast("float").alias(c) if c in num else F.col(c) for c in df.columns])


def bool_to_int(df: DataFrame) -> DataFrame:
    """Booleans to 0/1 ints."""
    b = set(columns_by_kind(df, "bool"))
    return df.select(*[F.col(c).cast("int").alias(c) if c in b else F.col(c) for c in df.columns])


def append_new_columns(df: DataFrame, new: dict[str, F.Column]) -> DataFrame:
    """P20: add only the columns whose names are not present yet, in one projection."""
    add = [e.alias(n) for n, e in new.items() if n not in df.columns]
    return df.select("*", *add) if add else df

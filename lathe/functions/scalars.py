"""Row-level feature expressions (F1-F31). All are built-in Column expressions (JVM side,
whole-stage codegen); divisions and casts use the ``try_`` forms so ANSI mode never raises."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-9


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _at_least(x: Column, low) -> Column:
    """``max(x, low)`` with a missing value left missing (``greatest`` alone skips NULL)."""
    low = low if isinstance(low, Column) else F.lit(float(low))
    return F.when(x.isNotNull(), F.greatest(x, low))


def log1p(x) -> Column:
    """``log1p``; argument <= -1 gives NULL."""
    return F.log1p(_c(x).cast("double"))


def guarded_log1p(x) -> Column:
    """``log1p(x)`` when ``x > 0`` else 0; a missing value compares false and gives 0."""
    x = _c(x).cast("double")
    return F.when(x > 0, F.log1p(x)).otherwise(F.lit(0.0))


def any_flag(x) -> Column:
    """``(x > 0)`` as tinyint (NULL compares false, as in pandas)."""
    return F.coalesce((_c(x) > 0), F.lit(False)).cast("tinyint")


def asinh(x) -> Column:
    """F3, in the sign-symmetric form: Spark's ``asinh`` loses digits for large negative inputs."""
    x = _c(x).cast("double")
    ax = F.abs(x)
    return F.signum(x) * F.log1p(ax + ax * ax / (F.sqrt(ax * ax + F.lit(1.0)) + F.lit(1.0)))


def square(x) -> Column:
    """F4."""
    x = _c(x).cast("double")
    return x * x


def sqrt_clipped(x) -> Column:
    """``sqrt(max(x, 0))``."""
    return F.sqrt(_at_least(_c(x).cast("double"), 0))


def square_clipped(x) -> Column:
    """F5 inverse: ``max(x, 0) ** 2``."""
    g = _at_least(_c(x).cast("double"), 0)
    return g * g


def expm1_clipped(x) -> Column:
    """``max(expm1(x), 0)``."""
    return _at_least(F.expm1(_c(x).cast("double")), 0)


def to_model_space(y, mode: str) -> Column:
    """target transform ``raw`` / ``sqrt`` / ``log1p``."""
    y = _c(y).cast("double")
    if mode == "raw":
        return y
    if mode == "sqrt":
        return sqrt_clipped(y)
    if mode == "log1p":
        return F.log1p(_at_least(y, 0))
    raise ValueError(f"unknown target mode {mode!r}")


def from_model_space(p, mode: str) -> Column:
    """F7 inverse, clipped at 0 for the non-raw modes."""
    p = _c(p).cast("double")
    if mode == "raw":
        return p
    if mode == "sqrt":
        return square_clipped(p)
    if mode == "log1p":
        return expm1_clipped(p)
    raise ValueError(f"unknown target mode {mode!r}")


def clip(x, lo=None, hi=None) -> Column:
    """Clip to bounds, NULL-safe (``least``/``greatest`` alone would turn NULL into a bound)."""
    x = _c(x).cast("double")
    out = x
    if lo is not None:
        out = F.greatest(out, F.lit(lo) if not isinstance(lo, Column) else lo)
    if hi is not None:
        out = F.least(out, F.lit(hi) if not isinstance(hi, Column) else hi)
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(out)


def product(a, b) -> Column:
    """F10."""
    return _c(a).cast("double") * _c(b).cast("double")


def difference(a, b) -> Column:
    """F11."""
    return _c(a).cast("double") - _c(b).cast("double")


def ratio(a, b) -> Column:
    """plain ratio; a zero divisor gives NULL instead of infinity (Q4)."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def eps_ratio(a, b, eps: float = 1e-6) -> Column:
    """``a / (b + eps)``."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double") + F.lit(eps))


def floored_ratio(v, i, floor, lo, hi, eps: float = EPS) -> Column:
    """``clip(v / max(i, floor + eps), lo, hi)`` with fitted floor and bounds."""
    fl = floor if isinstance(floor, Column) else F.lit(floor)
    den = _at_least(_c(i).cast("double"), fl + F.lit(eps))
    return clip(F.try_divide(_c(v).cast("double"), den), lo, hi)


def log_ratio(v, i, eps: float = EPS) -> Column:
    """``log1p(v) - log1p(i + eps)``."""
    return F.log1p(_c(v).cast("double")) - F.log1p(_c(i).cast("double") + F.lit(eps))


def relative_difference(v, i, eps: float = EPS) -> Column:
    """F16: ``(v - i) / (v + i + eps)``."""
    v, i = _c(v).cast("double"), _c(i).cast("double")
    return F.try_divide(v - i, v + i + F.lit(eps))


def hinge_above(x, t: float) -> Column:
    """``max(x - t, 0)``."""
    return _at_least(_c(x).cast("double") - F.lit(t), 0)


def hinge_below(x, t: float) -> Column:
    """``max(t - x, 0)``."""
    return _at_least(F.lit(t) - _c(x).cast("double"), 0)


def threshold_flag(x, thr) -> Column:
    """``(x > thr)`` as tinyint."""
    t = thr if isinstance(thr, Column) else F.lit(thr)
    return F.coalesce(_c(x).cast("double") > t, F.lit(False)).cast("tinyint")


def negate(x) -> Column:
    """F19."""
    return -_c(x).cast("double")


# fixed values: pdays bin edges and labels (right-closed bins)
PDAYS_EDGES = [-2, 0, 90, 180, 365, 1000]
PDAYS_LABELS = ["NotContacted", "Recent", "WithinHalfYear", "WithinYear", "LongAgo"]


def fixed_bins(x, edges, labels) -> Column:
    """right-closed bins ``(e_k, e_k+1]`` with labels; outside -> NULL."""
    x = _c(x).cast("double")
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(float(lo))) & (x <= F.lit(float(hi)))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


def string_interaction(*cols) -> Column:
    """``a_b``; booleans render as ``True``/``False`` and NULL as ``nan``."""
    def text(c: Column) -> Column:
        plain = c.cast("string")
        return F.coalesce(F.when(F.typeof(c) == "boolean", F.initcap(plain)).otherwise(plain), F.lit("nan"))
    return F.concat_ws("_", *[text(_c(c)) for c in cols])


def bool_text(c) -> Column:
    """Q8: booleans as ``True``/``False``."""
    return F.initcap(_c(c).cast("string"))


def lower(x) -> Column:
    """F24."""
    return F.lower(_c(x))


def equals_flag(x, value) -> Column:
    """``(x == value)`` as tinyint, NULL -> 0."""
    return F.coalesce(_c(x) == F.lit(value), F.lit(False)).cast("tinyint")


# fixed values: month names in calendar order
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def month_number(name) -> Column:
    """lower-cased month name -> 1..12, unknown -> NULL (a literal map lookup)."""
    m = F.create_map(*[x for i, n in enumerate(MONTHS, 1) for x in (F.lit(n), F.lit(i))])
    return F.try_element_at(m, F.lower(_c(name)))


def month_last_day(month, year: int = 2020) -> Column:
    m = _c(month).cast("int")
    ok = m.between(1, 12)
    return F.when(ok, F.dayofmonth(F.last_day(F.make_date(F.lit(year), F.when(ok, m), F.lit(1)))))


def clipped_day(month, day, year: int = 2020) -> Column:
    """Day clipped into ``[1, last day of month]``; NULL for an unknown month."""
    last = month_last_day(month, year)
    return F.when(last.isNotNull(), F.least(F.greatest(_c(day).cast("int"), F.lit(1)), last))


def safe_date(month, day, year: int = 2020) -> Column:
    """``make_date(year, month, clipped day)``; NULL for an unknown month."""
    m = _c(month).cast("int")
    ok = m.between(1, 12) & _c(day).isNotNull()
    return F.when(ok, F.make_date(F.lit(year), F.when(ok, m), clipped_day(month, day, year)))


def day_of_year(date) -> Column:
    """F28."""
    return F.dayofyear(_c(date))


def cyclic_sin(d, period: float = 366.0) -> Column:
    """F29."""
    return F.sin(F.lit(2 * math.pi) * _c(d).cast("double") / F.lit(period))


def cyclic_cos(d, period: float = 366.0) -> Column:
    """F29."""
    return F.cos(F.lit(2 * math.pi) * _c(d).cast("double") / F.lit(period))


def invalid_date(month, day, year: int = 2020) -> Column:
    """the raw (year, month, day) is not a calendar date."""
    d = _c(day).cast("int")
    return (d < 1) | (d > month_last_day(month, year))


def day_adjusted(month, day, year: int = 2020) -> Column:
    """A31 helper: the clipped day differs from the raw day."""
    return clipped_day(month, day, year) != _c(day).cast("int")


def pair_products(cols: list[str], existing: list[str] | None = None) -> dict[str, Column]:
    """interaction-only degree-2 terms ``'a b'`` of distinct pairs, new names only."""
    existing = set(existing or [])
    out = {}
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            name = f"{a} {b}"
            if name not in existing:
                out[name] = product(a, b)
    return out


def yes_no(x, lowercase: bool = True) -> Column:
    """``yes`` -> 1, ``no`` -> 0, anything else -> NULL, as tinyint."""
    v = F.lower(_c(x)) if lowercase else _c(x)
    return F.when(v == "yes", F.lit(1)).when(v == "no", F.lit(0)).cast("tinyint")


def coerce_numeric(x) -> Column:
    """Strip thousands commas and parse; anything unparsable -> NULL (``try_cast``).
    NaN text parses to NaN and is turned into NULL as all missing values are."""
    v = F.expr(f"try_cast(replace(`{x}`, ',', '') AS double)") if isinstance(x, str) else \
        F.regexp_replace(x, ",", "").try_cast("double")
    return F.nanvl(v, F.lit(None).cast("double"))


def sentinel_to_null(x, sentinel=-1) -> Column:
    """The sentinel becomes NULL."""
    return F.nullif(_c(x), F.lit(sentinel))


def missing_flag(x) -> Column:
    """Missing as tinyint flag."""
    return _c(x).isNull().cast("tinyint")


def equivalence_error(p, y) -> Column:
    """T4: smallest absolute error of the prediction, its half and its double."""
    p, y = _c(p).cast("double"), _c(y).cast("double")
    return F.least(F.abs(p - y), F.abs(p / 2 - y), F.abs(p * 2 - y))

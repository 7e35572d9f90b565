"""Fit/transform composites (X4-X8), sources and sinks (S1-S4, S8), prose-only operators
(T3, T7-T9) and sort/top-k forms (K1, K2), with DuckDB oracles."""

import re

from pyspark.sql import functions as F

from lathe.functions import scalars as S
from lathe.operators import profile as P
from lathe.operators.stats import Winsorizer, WinsorizerModel
from lathe.plans import audio as AU, bank as BK, road as RD
from lathe.registry.base import register, table, r6
from lathe.registry.profiling import A28_COLUMNS, A28_SQL
from lathe.session import scratch_path, written
from lathe.sources import files as IO


def _round_doubles(df, digits=6):
    """Every number of a wide row as ``r6`` rounds it. ``round`` goes through a decimal's text, about a microsecond each, so
    only values near a tie (or too large) take it; else the nearest whole number over the scale is that very double. The
    rare path is a function of an array: this projection is then compiled in methods small enough to be optimised."""
    def rounded(x):
        scaled = x * 10.0 ** digits
        whole = F.rint(scaled)
        exact = F.get(F.transform(F.array(x), lambda v: F.round(v, digits)), F.lit(0))
        return F.when((F.abs(scaled) < 1e11) & (F.abs(scaled - whole) < 0.4999), whole / 10.0 ** digits).otherwise(exact) + F.lit(0.0)
    return df.select(*[rounded(F.col(c).cast("double")).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


# ---------------------------------------------------------------- X4 bank features

BANK_SQL = """(SELECT o_orderkey AS id, c_nationkey + 18 AS age, c_mktsegment AS job, o_orderstatus AS marital,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'unknown' ELSE o_orderpriority END AS education,
  CASE WHEN o_totalprice > 300000 THEN 'yes' ELSE 'no' END AS dflt,
  CASE WHEN o_orderstatus = 'F' THEN 'Yes' WHEN o_orderstatus = 'O' THEN 'no' ELSE 'maybe' END AS housing,
  CASE WHEN o_orderkey % 3 = 0 THEN 'YES' ELSE 'no' END AS loan, c_acctbal AS balance,
  ['cellular', 'telephone', 'unknown'][o_custkey % 3 + 1] AS contact,
  CAST(dayofmonth(o_orderdate) + o_orderkey % 4 AS INT) AS day,
  CASE WHEN o_orderkey % 5 = 0 THEN upper(strftime(o_orderdate, '%b')) ELSE lower(strftime(o_orderdate, '%b')) END AS month,
  CAST(round(o_totalprice / 1000) AS INT) AS duration, CAST(o_orderkey % 7 AS INT) AS campaign,
  CAST(CASE WHEN o_orderkey % 5 = 0 THEN -1 ELSE date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) % 1100 END AS INT) AS pdays,
  CAST(o_orderkey % 4 AS INT) AS previous, ['failure', 'other', 'success', 'unknown'][o_custkey % 4 + 1] AS poutcome,
  CAST(o_orderstatus = 'F' AS INT) AS y FROM orders JOIN customer ON o_custkey = c_custkey)"""

_MONTH = ("CASE lower(month) WHEN 'jan' THEN 1 WHEN 'feb' THEN 2 WHEN 'mar' THEN 3 WHEN 'apr' THEN 4 WHEN 'may' THEN 5 "
          "WHEN 'jun' THEN 6 WHEN 'jul' THEN 7 WHEN 'aug' THEN 8 WHEN 'sep' THEN 9 WHEN 'oct' THEN 10 WHEN 'nov' THEN 11 WHEN 'dec' THEN 12 END")


def _ln1p(x):
    return f"(CASE WHEN {x} > -1 THEN ln(1 + ({x})) END)"


X4_SQL = f"""WITH b AS {BANK_SQL}, c AS (SELECT *, {_MONTH} AS mnum FROM b),
d AS (SELECT *, make_date(2020, mnum, least(greatest(day, 1), dayofmonth(last_day(make_date(2020, mnum, 1))))) AS dt FROM c)
SELECT id, age, CAST(dense_rank() OVER (ORDER BY job) - 1 AS INT) AS job,
  CAST(marital = 'F' AS TINYINT) AS marital_F, CAST(marital = 'O' AS TINYINT) AS marital_O, CAST(marital = 'P' AS TINYINT) AS marital_P,
  CAST(dense_rank() OVER (ORDER BY education) - 1 AS INT) AS encoded_education, CAST(education = 'unknown' AS TINYINT) AS education_unknown,
  CAST(CASE WHEN lower(dflt) = 'yes' THEN 1 WHEN lower(dflt) = 'no' THEN 0 END AS TINYINT) AS default_bool,
  CAST(CASE WHEN lower(housing) = 'yes' THEN 1 WHEN lower(housing) = 'no' THEN 0 END AS TINYINT) AS housing_bool,
  CAST(CASE WHEN lower(loan) = 'yes' THEN 1 WHEN lower(loan) = 'no' THEN 0 END AS TINYINT) AS loan_bool,
  round(balance, 6) + 0.0 AS balance, round(balance / nullif(age, 0), 6) + 0.0 AS balance_per_age,
  round(balance / nullif(campaign, 0), 6) + 0.0 AS balance_per_campaign,
  CAST(dense_rank() OVER (ORDER BY contact) - 1 AS INT) AS contact,
  CAST(dayofyear(dt) AS INT) AS day_of_year, round(sin(2 * pi() * dayofyear(dt) / 366.0), 6) + 0.0 AS day_sin,
  round(cos(2 * pi() * dayofyear(dt) / 366.0), 6) + 0.0 AS day_cos,
  duration, round({_ln1p('duration')}, 6) + 0.0 AS log_duration, campaign,
  CASE WHEN coalesce(pdays, -1) > -2 AND coalesce(pdays, -1) <= 0 THEN 'NotContacted' WHEN pdays > 0 AND pdays <= 90 THEN 'Recent'
    WHEN pdays > 90 AND pdays <= 180 THEN 'WithinHalfYear' WHEN pdays > 180 AND pdays <= 365 THEN 'WithinYear'
    WHEN pdays > 365 AND pdays <= 1000 THEN 'LongAgo' END AS pdays_binned,
  nullif(pdays, -1) AS pdays, CAST(nullif(pdays, -1) IS NULL AS TINYINT) AS pdays_missing,
  CAST(previous > 0 AS TINYINT) AS prev_any, round(CASE WHEN previous > 0 THEN {_ln1p('previous')} ELSE 0.0 END, 6) + 0.0 AS prev_log,
  CAST(dense_rank() OVER (ORDER BY poutcome) - 1 AS INT) AS poutcome, y FROM d"""


@register("x4_bank_features", X4_SQL)
def x4_bank(spark, sf):
    b = BK.bank_like(table(spark, sf, "orders"), table(spark, sf, "customer"))
    model = BK.fit_bank_features(b)
    # The fitted encoders survive a save and reload
    model = BK.BankFeaturesModel.load(spark, model.save(spark, scratch_path(spark, "bank-features")))
    out = model.transform(model.transform(b))       # second call is a no-op
    return _round_doubles(out.withColumnRenamed("default_bool", "default_bool"))


# ---------------------------------------------------------------- audio pipelines

AUDIO_COLS = ["RhythmScore", "VocalContent", "AcousticQuality", "InstrumentalScore", "LivePerformanceLikelihood",
              "MoodScore", "TrackDurationMs", "AudioLoudness", "Energy"]
AUDIO_SQL = """(SELECT CAST(l_linenumber AS DOUBLE) / 7.0 AS RhythmScore, l_quantity / 50.0 AS VocalContent,
  CAST(l_suppkey % 50 AS DOUBLE) / 50.0 AS AcousticQuality, l_tax * 10 AS InstrumentalScore,
  CAST(l_orderkey % 37 AS DOUBLE) / 37.0 AS LivePerformanceLikelihood, CAST(l_partkey % 100 AS DOUBLE) / 100.0 AS MoodScore,
  l_extendedprice * 10 AS TrackDurationMs, -(l_tax * 100) - l_discount * 50 AS AudioLoudness, l_discount * 10 AS Energy,
  60.0 + l_quantity * 2 + l_discount * 100 AS BeatsPerMinute FROM lineitem)"""


def _bounds_sql(cols, lo=0.002, hi=0.998, src="a"):
    return ", ".join(f"quantile_cont({c}, {lo}) AS {c}_lo, quantile_cont({c}, {hi}) AS {c}_hi" for c in cols) + f" FROM {src}"


def _clip(c):
    return f"least(greatest({c}, {c}_lo), {c}_hi)"


X5_SQL = f"""WITH a AS {AUDIO_SQL}, b AS (SELECT {_bounds_sql(AUDIO_COLS)}),
s AS (SELECT quantile_cont(ln(1 + TrackDurationMs), 0.5) AS dm, quantile_cont(ln(1 + TrackDurationMs), 0.75) - quantile_cont(ln(1 + TrackDurationMs), 0.25) AS di,
             quantile_cont(-AudioLoudness, 0.5) AS lm, quantile_cont(-AudioLoudness, 0.75) - quantile_cont(-AudioLoudness, 0.25) AS li FROM a)
SELECT {', '.join(f'round({_clip(c)}, 6) + 0.0 AS {c}' for c in AUDIO_COLS)},
  round((ln(1 + TrackDurationMs) - dm) / CASE WHEN di = 0 THEN 1.0 ELSE di END, 6) + 0.0 AS TrackDurationMs__scaled,
  round((-AudioLoudness - lm) / CASE WHEN li = 0 THEN 1.0 ELSE li END, 6) + 0.0 AS AudioLoudness__scaled,
  {', '.join(f'round({c}, 6) + 0.0 AS {c}__raw' for c in AUDIO_COLS if c not in ('TrackDurationMs', 'AudioLoudness'))}
FROM a, b, s"""


@register("x5_audio_pipeline_v1", X5_SQL)
def x5_audio_v1(spark, sf):
    a = AU.audio_like(table(spark, sf, "lineitem"))
    m = AU.fit_audio_v1(a)
    return _round_doubles(m.transform(a))


TOPS = ["Energy", "MoodScore", "VocalContent"]
X6_COLUMNS = [c for c in AUDIO_COLS if c not in ("TrackDurationMs", "AudioLoudness")] + [
    "TrackDurationMs", "log_duration", "AudioLoudness", "loud_mag", "Energy_sq", "drive", "stage", "bright", "mood_energy", "acoustic_energy", "rhythm_mood",
    "vocal_to_instr", "vocal_log_ratio", "vocal_rel", "vocal_minus_instr", "vocal_to_instr_log1p", "vocal_to_instr_asinh", "energy_minus_acoustic", "high_energy",
    "low_energy", "long_track", "Energy MoodScore", "Energy VocalContent", "MoodScore VocalContent"]


def _x6_sql():
    cl = {c: _clip(c) for c in AUDIO_COLS}
    eps = "1e-9"
    return f"""WITH a AS {AUDIO_SQL}, b AS (SELECT {_bounds_sql(AUDIO_COLS)}),
c AS (SELECT a.BeatsPerMinute, {', '.join(f'{cl[x]} AS {x}' for x in AUDIO_COLS)} FROM a, b),
s AS (SELECT quantile_cont(InstrumentalScore, 0.05) AS fl,
  quantile_cont(ln(1 + TrackDurationMs), 0.5) AS dm, quantile_cont(ln(1 + TrackDurationMs), 0.75) - quantile_cont(ln(1 + TrackDurationMs), 0.25) AS di0,
  quantile_cont(ln(1 + TrackDurationMs), 0.95) AS dlong,
  quantile_cont(-AudioLoudness, 0.5) AS lm, quantile_cont(-AudioLoudness, 0.75) - quantile_cont(-AudioLoudness, 0.25) AS li0 FROM c),
s2 AS (SELECT *, CASE WHEN di0 = 0 THEN 1.0 ELSE di0 END AS di, CASE WHEN li0 = 0 THEN 1.0 ELSE li0 END AS li FROM s),
r AS (SELECT quantile_cont(VocalContent / greatest(InstrumentalScore, fl + {eps}), 0.01) AS rlo,
             quantile_cont(VocalContent / greatest(InstrumentalScore, fl + {eps}), 0.99) AS rhi FROM c, s2),
f AS (SELECT c.*, ln(1 + TrackDurationMs) AS log_duration, -AudioLoudness AS loud_mag,
  least(greatest(VocalContent / greatest(InstrumentalScore, fl + {eps}), rlo), rhi) AS v2i, dm, di, dlong, lm, li FROM c, s2, r)
SELECT {', '.join(f'round({x}, 6) + 0.0 AS {x}' for x in AUDIO_COLS if x not in ('TrackDurationMs', 'AudioLoudness'))},
  round((log_duration - dm) / (di + {eps}), 6) + 0.0 AS TrackDurationMs, round(log_duration, 6) + 0.0 AS log_duration,
  round((loud_mag - lm) / (li + {eps}), 6) + 0.0 AS AudioLoudness, round(loud_mag, 6) + 0.0 AS loud_mag,
  round(Energy * Energy, 6) + 0.0 AS Energy_sq, round(Energy * RhythmScore, 6) + 0.0 AS drive,
  round(Energy * LivePerformanceLikelihood, 6) + 0.0 AS stage, round(Energy * loud_mag, 6) + 0.0 AS bright,
  round(Energy * MoodScore, 6) + 0.0 AS mood_energy, round(AcousticQuality * Energy, 6) + 0.0 AS acoustic_energy,
  round(RhythmScore * MoodScore, 6) + 0.0 AS rhythm_mood, round(v2i, 6) + 0.0 AS vocal_to_instr,
  round(ln(1 + VocalContent) - ln(1 + InstrumentalScore + {eps}), 6) + 0.0 AS vocal_log_ratio,
  round((VocalContent - InstrumentalScore) / (VocalContent + InstrumentalScore + {eps}), 6) + 0.0 AS vocal_rel,
  round(VocalContent - InstrumentalScore, 6) + 0.0 AS vocal_minus_instr, round(ln(1 + v2i), 6) + 0.0 AS vocal_to_instr_log1p,
  round(asinh(v2i), 6) + 0.0 AS vocal_to_instr_asinh, round(Energy - AcousticQuality, 6) + 0.0 AS energy_minus_acoustic,
  round(greatest(Energy - 0.7, 0), 6) + 0.0 AS high_energy, round(greatest(0.3 - Energy, 0), 6) + 0.0 AS low_energy,
  CAST(log_duration > dlong AS TINYINT) AS long_track,
  round(Energy * MoodScore, 6) + 0.0 AS "Energy MoodScore", round(Energy * VocalContent, 6) + 0.0 AS "Energy VocalContent",
  round(MoodScore * VocalContent, 6) + 0.0 AS "MoodScore VocalContent" FROM f"""


@register("x6_audio_preprocessor_v2", _x6_sql())
def x6_audio_v2(spark, sf):
    a = AU.audio_like(table(spark, sf, "lineitem"))
    m = AU.fit_audio_v2(a, "BeatsPerMinute", top_features=TOPS)
    m.float32 = False
    return _round_doubles(m.transform(a, drop_target=True))


@register("x6_audio_v2_float32_types", f"""SELECT c AS "column", 'float' AS dtype, n FROM
  (SELECT unnest([{', '.join(f"'{c}'" for c in X6_COLUMNS)}]) AS c), (SELECT count(*) AS n FROM lineitem)""")
def x6_float32(spark, sf):
    """Type of every output column, with its number of values."""
    a = AU.audio_like(table(spark, sf, "lineitem"))
    out = AU.fit_audio_v2(a, "BeatsPerMinute", top_features=TOPS).transform(a, drop_target=True)
    return P.profile_shape(out).select("column", "dtype", F.col("non_null").alias("n"))


@register("x6_audio_v2_float32_rows", re.sub(r"round\(([^,]*(?:\([^)]*\)[^,]*)*), 6\) \+ 0\.0 AS", r"CAST((\1) + 0.0 AS FLOAT) AS", _x6_sql())
          .replace("CAST(log_duration > dlong AS TINYINT)", "CAST(log_duration > dlong AS FLOAT)"))
def x6_float32_rows(spark, sf):
    """Every row of the float32 form (X6 narrows its numbers to four bytes)."""
    a = AU.audio_like(table(spark, sf, "lineitem"))
    out = AU.fit_audio_v2(a, "BeatsPerMinute", top_features=TOPS).transform(a, drop_target=True)
    return out.select(*[(F.col(f"`{c}`").cast("double") + 0.0).cast("float").alias(c) for c in out.columns])


@register("x6_audio_v2_learned_features")
def x6_learned(spark, sf):
    """X6 with its own six strongest features, learned by boosted trees from 10,000 tracks, and all their products."""
    a = AU.audio_like(table(spark, sf, "lineitem"))
    m = AU.fit_audio_v2(a, "BeatsPerMinute", learn_rows=10_000)
    m.float32 = False
    return _round_doubles(m.transform(a, drop_target=True))


@register("x3_category_table", """SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS BIGINT) AS c_name_code
  FROM orders JOIN customer ON o_custkey = c_custkey""")
def x3_category_table(spark, sf):
    """Codes of a column with a category per customer, fitted, saved, reloaded and applied to the orders."""
    from lathe.operators.encode import CategoryTable, fit_category_table
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    named = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name")
    path = fit_category_table(named, "c_name").save(scratch_path(spark, "category-table"))
    return CategoryTable.load(spark, path).transform(named, drop_original=True)


@register("x8_target_winsorizer", """WITH b AS (SELECT quantile_cont(o_totalprice, 0.0005) AS lo, quantile_cont(o_totalprice, 0.9995) AS hi FROM orders)
SELECT o_orderkey, round(least(greatest(o_totalprice, lo), hi), 6) + 0.0 AS o_totalprice FROM orders, b""")
def x8_target(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    m = AU.target_winsorizer(o, "o_totalprice")
    return _round_doubles(m.transform(o))


# ---------------------------------------------------------------- X7 road features

ROAD_SQL = """(SELECT l_returnflag AS road_type, l_linestatus AS lighting, o_orderstatus AS weather,
  ['morning', 'afternoon', 'evening'][l_linenumber % 3 + 1] AS time_of_day, l_linenumber AS num_lanes, l_discount * 10 AS curvature,
  CAST(l_quantity AS INT) AS speed_limit, l_tax > 0.04 AS road_signs_present, l_quantity > 25 AS public_road,
  o_orderpriority = '1-URGENT' AS holiday, l_discount > 0.05 AS school_season, l_linenumber % 3 AS num_reported_accidents,
  l_extendedprice / 131072.0 AS accident_risk FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

X7_SQL = f"""WITH r AS {ROAD_SQL}, q AS (SELECT list_sort(list_distinct(quantile_cont(curvature, [0.0, 0.25, 0.75, 1.0]))) AS e,
  count(*) AS n, count(DISTINCT curvature) AS nd FROM r),
b AS (SELECT r.*, CASE WHEN nd < 2 OR n < 6 OR len(e) <> 4 THEN 'medium' WHEN curvature IS NULL THEN 'nan'
  WHEN curvature >= e[1] AND curvature <= e[2] THEN 'low' WHEN curvature > e[2] AND curvature <= e[3] THEN 'medium'
  WHEN curvature > e[3] AND curvature <= e[4] THEN 'high' ELSE 'nan' END AS curvature_bin FROM r, q)
SELECT road_type, lighting, weather, time_of_day, num_lanes, round(curvature, 6) + 0.0 AS curvature, speed_limit,
  CAST(road_signs_present AS INT) AS road_signs_present, CAST(public_road AS INT) AS public_road, CAST(holiday AS INT) AS holiday,
  CAST(school_season AS INT) AS school_season, num_reported_accidents, round(accident_risk, 6) + 0.0 AS accident_risk,
  round(speed_limit / (curvature + 1e-6), 4) + 0.0 AS speed_curvature_ratio, weather || '_' || lighting AS weather_lighting,
  curvature_bin, round(curvature * curvature, 6) + 0.0 AS curvature_sq, speed_limit * speed_limit AS speed_limit_sq,
  CAST(speed_limit AS VARCHAR) || '_' || curvature_bin AS speed_x_curvature_bin,
  CASE WHEN holiday THEN 'True' ELSE 'False' END || '_' || lighting AS holiday_x_lighting FROM b"""


@register("x7_road_features", X7_SQL)
def x7_road(spark, sf):
    r = RD.road_like(table(spark, sf, "lineitem"), table(spark, sf, "orders"))
    out = RD.RoadFeaturesModel().transform(r)
    out = out.withColumn("speed_curvature_ratio", r6("speed_curvature_ratio", 4))
    return _round_doubles(out)


ROAD_MISSING = {"lighting": "num_lanes = 2", "holiday": "num_reported_accidents = 1", "weather": "num_lanes = 4", "speed_limit": "num_lanes = 5", "curvature": "num_lanes = 6"}
X7_MISSING_SQL = X7_SQL.replace(ROAD_SQL, f"(SELECT * REPLACE ({', '.join(f'CASE WHEN {w} THEN NULL ELSE {c} END AS {c}' for c, w in ROAD_MISSING.items())}) FROM {ROAD_SQL})") \
    .replace("count(DISTINCT curvature) AS nd", "count(DISTINCT curvature) AS nd") \
    .replace("weather || '_' || lighting", "coalesce(weather, 'nan') || '_' || coalesce(lighting, 'nan')") \
    .replace("CAST(speed_limit AS VARCHAR) || '_'", "coalesce(CAST(speed_limit AS VARCHAR), 'nan') || '_'") \
    .replace("CASE WHEN holiday THEN 'True' ELSE 'False' END || '_' || lighting", "CASE WHEN holiday IS NULL THEN 'nan' WHEN holiday THEN 'True' ELSE 'False' END || '_' || coalesce(lighting, 'nan')")


@register("x7_road_features_missing", X7_MISSING_SQL)
def x7_road_missing(spark, sf):
    """Missing lighting, holiday, weather, speed and curvature, put in by fixed rules: text features spell them ``nan``."""
    r = RD.road_like(table(spark, sf, "lineitem"), table(spark, sf, "orders"))
    r = r.select(*[F.when(~F.expr(ROAD_MISSING[c]), F.col(c)).alias(c) if c in ROAD_MISSING else F.col(c) for c in r.columns])
    out = RD.RoadFeaturesModel().transform(r)
    return _round_doubles(out.withColumn("speed_curvature_ratio", r6("speed_curvature_ratio", 4)))


@register("x7_road_features_dedup", X7_SQL.replace(ROAD_SQL, f"(SELECT DISTINCT * FROM {ROAD_SQL})"))
def x7_road_dedup(spark, sf):
    r = RD.road_like(table(spark, sf, "lineitem"), table(spark, sf, "orders"))
    out = RD.RoadFeaturesModel().transform(r, drop_duplicates=True)
    return _round_doubles(out.withColumn("speed_curvature_ratio", r6("speed_curvature_ratio", 4)))


@register("x7_road_features_categories", f"WITH x AS ({X7_SQL}) SELECT * REPLACE ("
          + ", ".join(f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INT) AS {c}" for c in RD.CATEGORICAL) + ") FROM x")
def x7_road_categories(spark, sf):
    # written: the edges and the labels of eight columns scan it, the join runs once
    r = written(RD.road_like(table(spark, sf, "lineitem"), table(spark, sf, "orders")), "road")
    binner = RD.fit_quantile_binner(r, "curvature")
    codes = RD.fit_road_categories(RD.RoadFeaturesModel(binner).transform(r))
    out = RD.RoadFeaturesModel(binner, codes).transform(r)
    return _round_doubles(out.withColumn("speed_curvature_ratio", r6("speed_curvature_ratio", 4)))


# ---------------------------------------------------------------- sources and sinks

CUST_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@register("s1_read_table_csv", "SELECT * FROM customer")
def s1_csv(spark, sf):
    path = IO.write_csv(table(spark, sf, "customer"), scratch_path(spark, "customer-csv"))
    return IO.read_table_csv(spark, path, schema=CUST_SCHEMA)


@register("s1_read_csv_inferred", "SELECT * FROM customer")
def s1_csv_infer(spark, sf):
    c = table(spark, sf, "customer")
    df = IO.read_table_csv(spark, IO.write_csv(c, scratch_path(spark, "customer-csv")), infer_schema=True)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in c.schema.fields])


@register("s2_read_delimited", "SELECT * FROM customer")
def s2_delimited(spark, sf):
    c = table(spark, sf, "customer").withColumn("c_name", F.concat(F.col("c_name"), F.lit(";x")))
    path = IO.write_csv(c, scratch_path(spark, "customer-semicolon"), sep=";")
    df = IO.read_delimited(spark, path, schema=CUST_SCHEMA)
    return df.withColumn("c_name", F.regexp_replace("c_name", ";x$", ""))


@register("s3_write_predictions", "SELECT o_orderkey AS id, round(o_totalprice / 1000, 6) + 0.0 AS prediction FROM orders")
def s3_predictions(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), r6(F.col("o_totalprice") / 1000).alias("prediction"))
    path = IO.write_predictions(o, scratch_path(spark, "predictions"))
    return IO.read_table_csv(spark, path, schema="id bigint, prediction double")


@register("s4_save_load_fitted", """WITH b AS (SELECT quantile_cont(l_extendedprice, 0.002) AS lo, quantile_cont(l_extendedprice, 0.998) AS hi FROM lineitem)
SELECT o_orderkey, round(least(greatest(o_totalprice / 4, lo), hi), 6) + 0.0 AS v FROM orders, b""")
def s4_fitted(spark, sf):
    li = table(spark, sf, "lineitem")
    m = Winsorizer(["l_extendedprice"]).fit(li)
    m2 = WinsorizerModel.load(spark, m.save(spark, scratch_path(spark, "winsor-state")))
    o = table(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") / 4).alias("l_extendedprice"))
    return m2.transform(o).select("o_orderkey", r6("l_extendedprice").alias("v"))


@register("s8_write_profile", A28_SQL)
def s8_profile(spark, sf):
    rep = P.profile_table(table(spark, sf, "customer"))
    path = scratch_path(spark, "profile")
    rep["overview"].write.mode("overwrite").parquet(path)
    return _round_doubles(spark.read.parquet(path)).select(*A28_COLUMNS)


# ---------------------------------------------------------------- prose-only operators (T3, T7-T9) and K1, K2

@register("t3_numeric_bands", """WITH q AS (SELECT list_sort(list_distinct(quantile_cont(l_extendedprice, [0.0, 0.25, 0.75, 1.0]))) AS e FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN l_extendedprice >= e[1] AND l_extendedprice <= e[2] THEN 'low'
  WHEN l_extendedprice > e[2] AND l_extendedprice <= e[3] THEN 'medium' WHEN l_extendedprice > e[3] AND l_extendedprice <= e[4] THEN 'high' END AS band FROM lineitem, q""")
def t3_bands(spark, sf):
    li = table(spark, sf, "lineitem")
    b = RD.fit_quantile_binner(li, "l_extendedprice")
    return li.select("l_orderkey", "l_linenumber", b.expr().alias("band"))


@register("t7_constant_extreme_columns", """WITH t AS (SELECT c_custkey, c_nationkey, c_acctbal, 1.0 AS k FROM customer),
q AS (SELECT 'c_custkey' AS "column", quantile_cont(c_custkey, 0.25) AS q1, quantile_cont(c_custkey, 0.75) AS q3 FROM t
  UNION ALL SELECT 'c_nationkey', quantile_cont(c_nationkey, 0.25), quantile_cont(c_nationkey, 0.75) FROM t
  UNION ALL SELECT 'c_acctbal', quantile_cont(c_acctbal, 0.25), quantile_cont(c_acctbal, 0.75) FROM t
  UNION ALL SELECT 'k', quantile_cont(k, 0.25), quantile_cont(k, 0.75) FROM t),
l AS (SELECT 'c_custkey' AS "column", CAST(c_custkey AS DOUBLE) AS v FROM t UNION ALL SELECT 'c_nationkey', c_nationkey FROM t
  UNION ALL SELECT 'c_acctbal', c_acctbal FROM t UNION ALL SELECT 'k', k FROM t),
s AS (SELECT "column", count(DISTINCT v) AS nd, max(n) / sum(n) AS top_share FROM (SELECT "column", v, count(*) AS n FROM l GROUP BY 1, 2) GROUP BY 1)
SELECT "column", nd <= 1 OR top_share > 0.95 AS constant, round(top_share, 6) + 0.0 AS top_share,
  (SELECT count(*) FROM l WHERE l."column" = q."column" AND (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1))) AS extreme
FROM s JOIN q USING ("column")""")
def t7_constant(spark, sf):
    from lathe.plans.extras import constant_and_extreme
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", F.lit(1.0).alias("k"))
    t = constant_and_extreme(c, ["c_custkey", "c_nationkey", "c_acctbal", "k"], 0.95)
    return t.select("column", "constant", r6("top_share").alias("top_share"), "extreme")


@register("t8_category_pair_feature", """SELECT c_custkey, c_mktsegment || '_' || CAST(c_nationkey AS VARCHAR) AS seg_x_nation,
  round(c_acctbal * CAST(c_mktsegment = 'BUILDING' AS INT), 6) + 0.0 AS acctbal_x_building FROM customer""")
def t8_pairs(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", S.string_interaction("c_mktsegment", F.col("c_nationkey").cast("string")).alias("seg_x_nation"),
                    r6(S.product("c_acctbal", S.equals_flag("c_mktsegment", "BUILDING"))).alias("acctbal_x_building"))


@register("t9_drift_check", """WITH a AS (SELECT o_orderpriority AS value, count(*) / sum(count(*)) OVER () AS sa FROM orders WHERE o_orderdate < TIMESTAMP '1995-06-17' GROUP BY 1),
b AS (SELECT o_orderpriority AS value, count(*) / sum(count(*)) OVER () AS sb FROM orders WHERE o_orderdate >= TIMESTAMP '1995-06-17' GROUP BY 1)
SELECT coalesce(a.value, b.value) AS value, round(coalesce(sa, 0), 6) + 0.0 AS share_a, round(coalesce(sb, 0), 6) + 0.0 AS share_b,
  round(coalesce(sa, 0) - coalesce(sb, 0), 6) + 0.0 AS diff FROM a FULL OUTER JOIN b ON a.value = b.value""")
def t9_drift(spark, sf):
    from lathe.plans.extras import drift_check
    o = table(spark, sf, "orders")
    cut = F.lit("1995-06-17").cast("timestamp")
    d = drift_check(o.where(F.col("o_orderdate") < cut), o.where(F.col("o_orderdate") >= cut), "o_orderpriority")
    return d.select("value", *[r6(c).alias(c) for c in ["share_a", "share_b", "diff"]])


@register("k1_top_categories", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 5")
def k1_top(spark, sf):
    p = table(spark, sf, "part")
    return p.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "p_brand").limit(5)


@register("k2_sort_by_abs_value", """SELECT feature, round(rho, 6) + 0.0 AS rho FROM (
  SELECT 'l_quantity' AS feature, (SELECT covar_samp(rx, ry) / (stddev_samp(rx) * stddev_samp(ry)) FROM (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS rx,
     rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS ry FROM lineitem)) AS rho
  UNION ALL SELECT 'l_tax', (SELECT covar_samp(rx, ry) / (stddev_samp(rx) * stddev_samp(ry)) FROM (SELECT rank() OVER (ORDER BY l_tax) + (count(*) OVER (PARTITION BY l_tax) - 1) / 2.0 AS rx,
     rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS ry FROM lineitem))
  UNION ALL SELECT 'l_discount', (SELECT covar_samp(rx, ry) / (stddev_samp(rx) * stddev_samp(ry)) FROM (SELECT rank() OVER (ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_discount) - 1) / 2.0 AS rx,
     rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS ry FROM lineitem)))
ORDER BY abs(rho) DESC, feature LIMIT 2""")
def k2_abs(spark, sf):
    r = P.spearman_with_target(table(spark, sf, "lineitem"), ["l_quantity", "l_tax", "l_discount"], "l_extendedprice")
    return r.orderBy(F.abs("rho").desc(), "feature").limit(2).select("feature", r6("rho").alias("rho"))

"""Fitted state applied to a stream of ``events``: stream output equals batch output."""

from pyspark.sql import functions as F

from lathe.functions.geo import whole_route_curviness
from lathe.operators.stats import Winsorizer, RobustScaler, FittedState, apply_fitted_broadcast
from lathe.registry.base import register, table, r6
from lathe.registry.routes import X11_SQL, routes_geojson
from lathe.session import scratch_path
from lathe.streaming.scoring import score_stream, stream_table

STREAM_SQL = """WITH b AS (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM events),
c AS (SELECT event_id, event_type, least(greatest(value, lo), hi) AS v FROM events, b),
s AS (SELECT quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr FROM c)
SELECT event_id, event_type, round(v, 6) + 0.0 AS value, round((v - med) / CASE WHEN iqr = 0 THEN 1.0 ELSE iqr END, 6) + 0.0 AS value_scaled,
  CAST(event_type = 'purchase' AS TINYINT) AS is_purchase FROM c, s"""


def _fit(spark, sf):
    ev = table(spark, sf, "events")
    w = Winsorizer(["value"], 0.01, 0.99).fit(ev)
    sc = RobustScaler(["value"]).fit(w.transform(ev.select("value")))
    return w, sc


def _score(w, sc):
    def run(df):
        c = w.transform(df.select("event_id", "event_type", "value"))
        return c.select("event_id", "event_type", r6("value").alias("value"), r6(sc.scaled("value")).alias("value_scaled"),
                        (F.col("event_type") == "purchase").cast("tinyint").alias("is_purchase"))
    return run


@register("st1_stream_scoring_events", STREAM_SQL)
def st1_stream(spark, sf):
    w, sc = _fit(spark, sf)
    return score_stream(spark, stream_table(spark, sf, "events"), _score(w, sc), "events-scored")


@register("st1_batch_scoring_events", STREAM_SQL)
def st1_batch(spark, sf):
    w, sc = _fit(spark, sf)
    return _score(w, sc)(table(spark, sf, "events"))


@register("st2_stream_broadcast_state", """WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS sd FROM events)
SELECT event_id, round((value - m) / sd, 6) + 0.0 AS z FROM events, s""")
def st2_broadcast(spark, sf):
    ev = table(spark, sf, "events")
    row = ev.agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("sd")).first()
    st = FittedState()
    st.put("value", "mean", row["m"])
    st.put("value", "std", row["sd"])

    def run(df):
        j = apply_fitted_broadcast(df, st, spark)
        return j.select("event_id", r6((F.col("value") - F.col("value__mean")) / F.col("value__std")).alias("z"))
    return score_stream(spark, stream_table(spark, sf, "events"), run, "events-z")


@register("st3_stream_route_curviness", X11_SQL)
def st3_routes(spark, sf):
    """A stream of whole routes scored without a window: the batch result (X11)."""
    path = scratch_path(spark, "routes")
    routes_geojson(spark, sf).select("route_id", "geojson").write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    c = score_stream(spark, stream, whole_route_curviness, "routes-scored")
    return c.select("route_id", "n_vertices", r6("mean_angle").alias("mean_angle"), r6("curviness").alias("curviness"))

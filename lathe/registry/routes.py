"""Route queries (S7, W1, F32-F36, X11) on polylines built from ``embeddings``."""

import math

from pyspark.sql import functions as F

from lathe.functions import geo as G
from lathe.registry.base import register, table, r6

ROUTE_LEN = 64  # a route = one label's vertices within a block of 64 vec_ids


def routes_geojson(spark, sf):
    """One GeoJSON LineString per route: vertices (lng, lat) from the first two embedding
    entries, in vec_id order; each route has at most ``ROUTE_LEN`` vertices."""
    e = table(spark, sf, "embeddings")
    v = e.select((F.col("label").cast("long") * 1000000 + F.floor(F.col("vec_id") / ROUTE_LEN)).alias("route_id"),
                 "vec_id", (F.lit(40.0) + F.col("embedding")[0].cast("double") * 0.5).alias("lat"),
                 (F.lit(-99.0) + F.col("embedding")[1].cast("double") * 0.5).alias("lng"))
    pts = F.array_sort(F.collect_list(F.struct("vec_id", "lng", "lat")))
    g = v.groupBy("route_id").agg(pts.alias("_pts"))
    coords = F.transform("_pts", lambda s: F.array(s["lng"], s["lat"]))
    return g.select("route_id", F.to_json(F.struct(F.lit("LineString").alias("type"), coords.alias("coordinates"))).alias("geojson"))


V_SQL = f"""(SELECT label * 1000000 + vec_id // {ROUTE_LEN} AS route_id, vec_id,
  40 + CAST(embedding[1] AS DOUBLE) * 0.5 AS lat, -99 + CAST(embedding[2] AS DOUBLE) * 0.5 AS lng FROM embeddings)"""
S_SQL = f"(SELECT route_id, CAST(row_number() OVER (PARTITION BY route_id ORDER BY vec_id) - 1 AS INT) AS seq, lat, lng FROM {V_SQL})"


@register("s7_read_routes_geojson", f"SELECT route_id, seq, round(lng, 9) + 0.0 AS lng, round(lat, 9) + 0.0 AS lat FROM {S_SQL}")
def s7_routes(spark, sf):
    v = G.parse_routes(routes_geojson(spark, sf))
    return v.select("route_id", F.col("seq").cast("int"), r6("lng", 9).alias("lng"), r6("lat", 9).alias("lat"))


def _angle_sql(px, py, cx, cy, nx, ny):
    v1x, v1y, v2x, v2y = f"({px} - {cx})", f"({py} - {cy})", f"({nx} - {cx})", f"({ny} - {cy})"
    return (f"CASE WHEN {px} IS NULL OR {nx} IS NULL THEN 180.0 "
            f"WHEN ({v1x} = 0 AND {v1y} = 0) OR ({v2x} = 0 AND {v2y} = 0) THEN 0.0 "
            f"ELSE degrees(atan2(abs({v1x} * {v2y} - {v1y} * {v2x}), {v1x} * {v2x} + {v1y} * {v2y})) END")


@register("w1_f32_f33_vertex_angles", f"""SELECT label, vec_id, round({_angle_sql('px', 'py', 'x', 'y', 'nx', 'ny')}, 6) + 0.0 AS angle_deg FROM (
  SELECT label, vec_id, x, y, lag(x) OVER w AS px, lag(y) OVER w AS py, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM
  (SELECT label, vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)
  WINDOW w AS (PARTITION BY label ORDER BY vec_id))""")
def w1_angles(spark, sf):
    e = table(spark, sf, "embeddings").select("label", "vec_id", F.col("embedding")[0].cast("double").alias("x"),
                                               F.col("embedding")[1].cast("double").alias("y"))
    # each label is one long polyline; blocks of 16 sequence numbers split it over tasks
    a = G.vertex_angles(e, "label", "vec_id", "x", "y", block_size=16)
    return a.select("label", "vec_id", r6("angle_deg").alias("angle_deg"))


@register("w1_vertex_angles_unblocked", f"""SELECT label, vec_id, round({_angle_sql('px', 'py', 'x', 'y', 'nx', 'ny')}, 6) + 0.0 AS angle_deg FROM (
  SELECT label, vec_id, x, y, lag(x) OVER w AS px, lag(y) OVER w AS py, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM
  (SELECT label, vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)
  WINDOW w AS (PARTITION BY label ORDER BY vec_id))""")
def w1_angles_plain(spark, sf):
    e = table(spark, sf, "embeddings").select("label", "vec_id", F.col("embedding")[0].cast("double").alias("x"),
                                               F.col("embedding")[1].cast("double").alias("y"))
    a = G.vertex_angles(e, "label", "vec_id", "x", "y", block_size=None)
    return a.select("label", "vec_id", r6("angle_deg").alias("angle_deg"))


_LATLNG = "(SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 250 AS lat, CAST(embedding[2] AS DOUBLE) * 480 AS lng FROM embeddings)"


@register("f34_utm_zone_crs", f"""SELECT vec_id, CASE WHEN abs(lat) <= 90 AND abs(lng) <= 180 THEN CAST(greatest(ceil((lng + 180) / 6), 1) AS INT) END AS zone,
  CASE WHEN abs(lat) <= 90 AND abs(lng) <= 180 THEN '+proj=utm +zone=' || CAST(CAST(greatest(ceil((lng + 180) / 6), 1) AS INT) AS VARCHAR)
    || CASE WHEN lat < 0 THEN ' +south' ELSE '' END || ' +datum=WGS84 +units=m +no_defs' END AS crs FROM {_LATLNG}""")
def f34_zone(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", (F.col("embedding")[0].cast("double") * 250).alias("lat"),
                                               (F.col("embedding")[1].cast("double") * 480).alias("lng"))
    return e.select("vec_id", G.utm_zone("lat", "lng").alias("zone"), G.utm_crs("lat", "lng").alias("crs"))


def _utm_sql(lat, lng, zone, south):
    n = G.WGS84_F / (2 - G.WGS84_F)
    big_a = G.WGS84_A / (1 + n) * (1 + n * n / 4 + n ** 4 / 64)
    a = [n / 2 - 2 * n * n / 3 + 5 * n ** 3 / 16, 13 * n * n / 48 - 3 * n ** 3 / 5, 61 * n ** 3 / 240]
    c = 2 * math.sqrt(n) / (1 + n)
    sp = f"sin(radians({lat}))"
    t = f"sinh(atanh({sp}) - {c!r} * atanh({c!r} * {sp}))"
    lam = f"radians({lng} - ({zone} * 6.0 - 183.0))"
    xi = f"atan2({t}, cos({lam}))"
    eta = f"atanh(sin({lam}) / sqrt(1 + {t} * {t}))"
    e_sum = eta + "".join(f" + {aj!r} * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})" for j, aj in enumerate(a, 1))
    n_sum = xi + "".join(f" + {aj!r} * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})" for j, aj in enumerate(a, 1))
    k = G.UTM_K0 * big_a
    return (f"({G.UTM_FALSE_EASTING!r} + {k!r} * ({e_sum}))",
            f"(CASE WHEN {south} THEN {G.UTM_FALSE_NORTHING_SOUTH!r} ELSE 0.0 END + {k!r} * ({n_sum}))")


_E, _N = _utm_sql("lat", "lng", "zone", "olat < 0")
PROJ_SQL = f"""(SELECT route_id, seq, {_E} AS x, {_N} AS y FROM (
  SELECT s.*, o.olat, greatest(ceil((o.olng + 180) / 6), 1) AS zone FROM {S_SQL} s
  JOIN (SELECT route_id, lat AS olat, lng AS olng FROM {S_SQL} WHERE seq = 0) o USING (route_id)))"""


@register("f35_utm_project", f"SELECT route_id, seq, round(x, 3) + 0.0 AS x, round(y, 3) + 0.0 AS y FROM {PROJ_SQL}")
def f35_project(spark, sf):
    r = routes_geojson(spark, sf)
    g = F.from_json(F.col("geojson"), G.GEOJSON_LINESTRING)["coordinates"]
    v = r.select("route_id", g[0][1].alias("olat"), g[0][0].alias("olng"), F.posexplode(g).alias("seq", "_pt")) \
         .select("route_id", "seq", "olat", F.col("_pt")[0].alias("lng"), F.col("_pt")[1].alias("lat"),
                 G.utm_zone(F.col("olat"), F.col("olng")).alias("zone"))
    e, n = G.utm_project(F.col("lat"), F.col("lng"), F.col("zone"), F.col("olat") < 0)
    return v.select("route_id", F.col("seq").cast("int"), r6(e, 3).alias("x"), r6(n, 3).alias("y"))


X11_SQL = f"""WITH a AS (SELECT route_id, {_angle_sql('px', 'py', 'x', 'y', 'nx', 'ny')} AS angle FROM (
  SELECT route_id, x, y, lag(x) OVER w AS px, lag(y) OVER w AS py, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM {PROJ_SQL}
  WINDOW w AS (PARTITION BY route_id ORDER BY seq)))
SELECT route_id, count(*) AS n_vertices, round(avg(angle), 6) + 0.0 AS mean_angle,
  round((180.0 - greatest(avg(angle), 160.0)) / 20.0, 6) + 0.0 AS curviness FROM a GROUP BY route_id"""


@register("x11_route_curviness", X11_SQL)
def x11_curviness(spark, sf):
    c = G.route_curviness(routes_geojson(spark, sf))
    return c.select("route_id", "n_vertices", r6("mean_angle").alias("mean_angle"), r6("curviness").alias("curviness"))


@register("f36_curviness_by_label", f"""WITH a AS (SELECT label, {_angle_sql('px', 'py', 'x', 'y', 'nx', 'ny')} AS angle FROM (
  SELECT label, x, y, lag(x) OVER w AS px, lag(y) OVER w AS py, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM
  (SELECT label, vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)
  WINDOW w AS (PARTITION BY label ORDER BY vec_id)))
SELECT label, round(avg(angle), 6) + 0.0 AS mean_angle, round((180.0 - greatest(avg(angle), 160.0)) / 20.0, 6) + 0.0 AS curviness FROM a GROUP BY label""")
def f36_curviness(spark, sf):
    e = table(spark, sf, "embeddings").select("label", "vec_id", F.col("embedding")[0].cast("double").alias("x"),
                                               F.col("embedding")[1].cast("double").alias("y"))
    a = G.vertex_angles(e, "label", "vec_id", "x", "y", block_size=16)
    g = a.groupBy("label").agg(F.avg("angle_deg").alias("mean_angle"))
    return g.select("label", r6("mean_angle").alias("mean_angle"), r6(G.curviness_score(F.col("mean_angle"))).alias("curviness"))

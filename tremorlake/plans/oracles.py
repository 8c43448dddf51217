"""The same answers as plain DuckDB SQL over the given tables."""

from __future__ import annotations

QUAKE = """quake AS (
  SELECT event_id AS id,
    concat('ev', CAST(CASE WHEN event_id % 50 = 1 THEN event_id - 1 ELSE event_id END AS VARCHAR)) AS usgs_id,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(floor(least(value, 240.0) * 4) AS DOUBLE) / 100 END AS mag,
    CASE WHEN event_id % 53 = 0 THEN NULL
         ELSE concat(json_extract_string(props, '$.k'), ' km NE of NATION_', CAST(user_id % 25 AS VARCHAR)) END AS place,
    ts AS time_utc,
    concat('https://example.org/ev', CAST(event_id AS VARCHAR)) AS url,
    CAST(CASE WHEN event_id % 61 = 0 THEN NULL WHEN user_id % 10 = 0 THEN 1 ELSE 0 END AS INT) AS tsunami,
    concat(event_type, ' quake, NATION_', CAST(user_id % 25 AS VARCHAR)) AS title,
    CASE event_type WHEN 'click' THEN 'us' WHEN 'view' THEN 'AK' WHEN 'error' THEN 'pr'
                    WHEN 'signup' THEN 'ci' ELSE 'nn' END AS net,
    CASE WHEN event_id % 89 = 0 THEN NULL
         ELSE CAST(CAST(json_extract_string(props, '$.k') AS INT) * 7 - 5 AS DOUBLE) END AS depth_km,
    CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST((event_id * 7919) % 3601 AS DOUBLE) / 10 - 180 END AS lon,
    CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST((event_id * 104729) % 1701 AS DOUBLE) / 10 - 85 END AS lat
  FROM events)"""

_ARROW = "(0,0,-34,-12),(0,1,40,-12),(0,2,10,0),(0,3,40,12),(0,4,-34,12)"
_STRIP = "(0,0,0,-80),(0,1,72,-80),(0,2,72,80),(0,3,0,80),(1,0,26,-10),(1,1,46,-10),(1,2,46,10),(1,3,26,10)"
_SMALL_ARROW = "(0,0,-4,-2),(0,1,5,-2),(0,2,1,0),(0,3,5,2),(0,4,-4,2)"
_SQUARE = "(0,0,-2,-2),(0,1,2,-2),(0,2,2,2),(0,3,-2,2),(1,0,-1,-1),(1,1,1,-1),(1,2,1,1),(1,3,-1,1)"


def _layer(name: str, table: str, key: str, x: str, y: str, corners: str) -> str:
    return f"""{name}_poly AS (
  SELECT CAST({key} AS BIGINT) AS poly, v.ring AS ring, v.i AS i,
    CAST({x} + v.dx AS DOUBLE) AS x, CAST({y} + v.dy AS DOUBLE) AS y
  FROM {table} CROSS JOIN (VALUES {corners}) AS v(ring, i, dx, dy))"""


LAYERS = {
    "country": _layer("country", "nation", "n_nationkey", "-144 + 72 * (n_nationkey % 5)",
                      "-60 + 30 * ((n_nationkey - n_nationkey % 5) // 5)", _ARROW),
    "sea": _layer("sea", "region", "r_regionkey", "-180 + 72 * r_regionkey", "0", _STRIP),
    "zone": _layer("zone", "supplier", "s_suppkey", "-170 + (s_suppkey * 37) % 340", "-80 + (s_suppkey * 53) % 160",
                   _SMALL_ARROW),
    "basin": _layer("basin", "customer", "c_custkey", "-170 + (c_custkey * 41) % 340", "-80 + (c_custkey * 59) % 160",
                    _SQUARE),
}

COUNTRY = "country AS (SELECT concat('N', lpad(CAST(n_nationkey AS VARCHAR), 2, '0')) AS iso, n_name AS name FROM nation)"
SEA = "sea AS (SELECT CAST(r_regionkey AS INT) AS id, r_name AS name FROM region)"
ZONE_RAW = """zone_raw AS (
  SELECT s_suppkey AS row_id,
    CASE WHEN s_suppkey % 11 = 0 THEN ' na ' WHEN s_suppkey % 13 = 0 THEN ''
         ELSE concat(' n', lpad(CAST(s_suppkey % 40 AS VARCHAR), 2, '0')) END AS iso_raw,
    CASE WHEN s_suppkey % 17 = 0 THEN 'NONE' ELSE concat(' ', s_name) END AS name_raw
  FROM supplier)"""
ZONE_CLEAN = """zone_clean AS (
  SELECT row_id, CASE WHEN upper(trim(iso_raw)) IN ('', 'NONE', 'NA', 'N/A') THEN NULL ELSE upper(trim(iso_raw)) END AS iso,
    CASE WHEN trim(name_raw) IN ('', 'NONE', 'NA', 'N/A') THEN NULL ELSE trim(name_raw) END AS name
  FROM zone_raw)"""
ZONE_LOOKUP = """zone_lookup AS (
  SELECT iso, name FROM (
    SELECT iso, name, row_number() OVER (PARTITION BY iso ORDER BY row_id) AS rn
    FROM zone_clean WHERE iso IS NOT NULL AND name IS NOT NULL) WHERE rn = 1)"""
BASIN_LOOKUP = """basin_names AS (
  SELECT concat(c_mktsegment, ' ', CAST((c_custkey * 7) % 90 AS VARCHAR)) AS name, min(c_custkey) AS first_row
  FROM customer GROUP BY 1),
basin_lookup AS (SELECT CAST(row_number() OVER (ORDER BY first_row) - 1 AS INT) AS id, name FROM basin_names)"""
PLACES = """places AS (
  SELECT s_suppkey AS place, CAST(-170 + (s_suppkey * 37) % 340 AS DOUBLE) AS plon,
    CAST(-80 + (s_suppkey * 53) % 160 AS DOUBLE) AS plat FROM supplier)"""


def _edges(layer: str) -> str:
    """Edges of a layer as the CTE ``<layer>_edge``."""
    return f"""{layer}_edge AS (
  SELECT poly, ring, x AS x1, y AS y1,
    COALESCE(LEAD(x) OVER w, FIRST_VALUE(x) OVER w) AS x2, COALESCE(LEAD(y) OVER w, FIRST_VALUE(y) OVER w) AS y2
  FROM {layer}_poly WINDOW w AS (PARTITION BY poly, ring ORDER BY i))"""


def _covering(layer: str) -> str:
    """Plain point-in-polygon: bounding boxes, then all edges. CTEs ``<layer>_cand``, ``<layer>_pair``, ``<layer>_hit``."""
    return f"""{LAYERS[layer]}, {_edges(layer)},
{layer}_cand AS (
  SELECT q.id, q.lon, q.lat, b.poly FROM quake q JOIN (
    SELECT poly, MIN(x) AS xmin, MAX(x) AS xmax, MIN(y) AS ymin, MAX(y) AS ymax FROM {layer}_poly GROUP BY poly) b
  ON q.lon BETWEEN b.xmin AND b.xmax AND q.lat BETWEEN b.ymin AND b.ymax),
{layer}_pair AS (
  SELECT c.id, c.poly FROM {layer}_cand c JOIN {layer}_edge e ON c.poly = e.poly GROUP BY c.id, c.poly
  HAVING SUM(CASE WHEN (e.y1 > c.lat) <> (e.y2 > c.lat)
                   AND c.lon < (e.x2 - e.x1) * (c.lat - e.y1) / (e.y2 - e.y1) + e.x1 THEN 1 ELSE 0 END) % 2 = 1
      OR MAX(CASE WHEN (e.x2 - e.x1) * (c.lat - e.y1) = (e.y2 - e.y1) * (c.lon - e.x1)
                   AND c.lon BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
                   AND c.lat BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2) THEN 1 ELSE 0 END) = 1),
{layer}_hit AS (SELECT id, MIN(poly) AS poly FROM {layer}_pair GROUP BY id)"""


POINTS = "points AS (SELECT * FROM quake WHERE lon IS NOT NULL AND lat IS NOT NULL)"
ISO_OF = "concat('N', lpad(CAST(c.poly AS VARCHAR), 2, '0'))"
LOCATION = f"""location AS (
  SELECT p.id AS quake_id, CASE WHEN c.poly IS NOT NULL THEN {ISO_OF} END AS country_iso, CAST(s.poly AS INT) AS sea_id
  FROM points p LEFT JOIN country_hit c ON p.id = c.id LEFT JOIN sea_hit s ON p.id = s.id)"""
LOCATED = ", ".join([QUAKE, POINTS, _covering("country"), _covering("sea"), LOCATION])
ZONE_LOCATION = """zone_location AS (
  SELECT p.id AS quake_id, z.iso AS country_iso, CAST(NULL AS INT) AS sea_id, p.time_utc
  FROM points p LEFT JOIN zone_hit h ON p.id = h.id LEFT JOIN zone_clean z ON h.poly = z.row_id)"""
ZONED = ", ".join([_covering("zone"), ZONE_RAW, ZONE_CLEAN, ZONE_LOCATION])

HAVERSINE = """2 * 6371.0088 * asin(sqrt(least(1.0,
  pow(sin(radians(q.lat - {lat}) / 2), 2) + cos(radians({lat})) * cos(radians(q.lat)) * pow(sin(radians(q.lon - {lon}) / 2), 2))))"""
KM = HAVERSINE.format(lon="p.plon", lat="p.plat")

FEED_COLUMNS = """usgs_id, mag, place, date_trunc('milliseconds', time_utc) AS time_utc, url, tsunami, title, net,
  CASE WHEN lon IS NOT NULL THEN depth_km END AS depth_km, lon, lat"""
FEED = f"SELECT {FEED_COLUMNS} FROM quake"


def _q(sql: str, *ctes: str) -> str:
    return f"WITH {', '.join([QUAKE, *ctes])} {sql}"


def _interpolated(x: str, stops: list[tuple[float, float]]) -> str:
    parts = [f"WHEN {x} <= {stops[0][0]} THEN {stops[0][1]}"]
    for (x0, y0), (x1, y1) in zip(stops, stops[1:]):
        parts.append(f"WHEN {x} <= {x1} THEN CAST({y0} AS DOUBLE) + ({x} - {x0}) / {x1 - x0} * (CAST({y1} AS DOUBLE) - CAST({y0} AS DOUBLE))")
    return f"CAST(CASE {' '.join(parts)} WHEN {x} > {stops[-1][0]} THEN {stops[-1][1]} END AS DOUBLE)"


MAG0 = "coalesce(mag, 0.0)"
WEIGHT = _interpolated(MAG0, [(0, 0.1), (2, 0.3), (4, 0.7), (6, 1)])
AGE = "(((epoch_us(TIMESTAMP '2024-01-31 00:00:00') // 1000) - (epoch_us(time_utc) // 1000)) / 3600000.0)"
FADE_STOPS = [(0, 1), (6, 0.4), (24, 0.1), (72, 0)]


def _channel(*levels: int) -> str:
    stops = list(zip((0, 3, 5, 7), levels))
    return f"lpad(lower(to_hex(CAST(floor({_interpolated(MAG0, stops)} + 0.5) AS BIGINT))), 2, '0')"


def _fixed(col: str, decimals: int) -> str:
    scale = 2 ** (decimals + 1)
    half = f"({col} * {scale} = floor({col} * {scale}) AND abs({col} * {scale}) % 2 = 1)"
    return f"coalesce(printf('%.{decimals}f', CASE WHEN {half} THEN {col} + sign({col}) * CAST(1e-6 AS DOUBLE) ELSE {col} END), '—')"


def _histogram(col: str, where: str, maxbins: int, extra: str = "") -> str:
    edge = lambda k: f"CASE WHEN step >= 1e-4 THEN round({k} * step, 6) ELSE {k} * step END"
    return _q(f"""SELECT bin, {edge('bin')} AS bin_start, {edge('(bin + 1)')} AS bin_end, count{extra} FROM (
    SELECT CAST(floor(x / step) AS BIGINT) AS bin, step, count(*) AS count FROM known CROSS JOIN step GROUP BY 1, 2)""",
              f"known AS (SELECT {col} AS x FROM quake WHERE {where})",
              "width AS (SELECT CAST(max(x) - min(x) AS DOUBLE) AS width FROM known)",
              f"""step AS (SELECT coalesce(min(step), CAST(0.001 AS DOUBLE)) AS step FROM (
    SELECT width, CASE WHEN k < 0 THEN CAST(m AS DOUBLE) / pow(10.0, -k) ELSE CAST(m AS DOUBLE) * pow(10.0, k) END AS step
    FROM width, (VALUES (1), (2), (5)) AS ms(m), (VALUES (-1), (0), (1)) AS ks(d),
      LATERAL (SELECT CAST(floor(log10(nullif(width, 0) / {float(maxbins)})) AS INT) + d AS k) WHERE width > 0)
  WHERE width / step <= {maxbins})""")


def _describe(col: str, where: str) -> str:
    return _q(f"""SELECT count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, min(x) AS min,
  round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.75), 6) AS p75,
  max(x) AS max FROM (SELECT {col} AS x FROM quake WHERE {where})""")


def _cell(col: str, size: float) -> str:
    return f"CAST(floor({col} / {float(size)}) AS INT)"


HELD_MS = "(CASE WHEN depth_km < 0 THEN 0 WHEN depth_km IS NOT NULL THEN (epoch_us(time_utc) // 1000) END)"
MID = "TIMESTAMP '2024-01-15 00:00:00'"
FIRSTS = "firsts AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY usgs_id ORDER BY id) AS rn FROM quake) WHERE rn = 1)"

ORACLES: dict[str, str] = {
    "scan_quake": _q("SELECT * FROM quake"),
    "scan_points": _q("SELECT id, lat, lon FROM quake WHERE lat IS NOT NULL AND lon IS NOT NULL"),
    "read_geojson": _q(FEED),
    "fetch_windows": """WITH RECURSIVE sec AS (SELECT CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events),
w(a, b, n) AS (
  SELECT CAST(1704067200 AS BIGINT), CAST(1706659200 AS BIGINT), (SELECT count(*) FROM sec WHERE s >= 1704067200 AND s < 1706659200)
  UNION ALL
  SELECT h.a, h.b, (SELECT count(*) FROM sec WHERE s >= h.a AND s < h.b) FROM (
    SELECT CASE WHEN side = 0 THEN a ELSE a + (b - a) // 2 END AS a, CASE WHEN side = 0 THEN a + (b - a) // 2 ELSE b END AS b
    FROM w CROSS JOIN (VALUES (0), (1)) AS t(side) WHERE n > 500 AND b - a > 1) h)
SELECT a AS start_s, b AS end_s, CAST(n AS BIGINT) AS n_events, n > 500 AS over_cap FROM w WHERE n <= 500 OR b - a <= 1""",
    "fetch_source": _q(FEED),
    "month_windows": _q("""SELECT window_start, window_end, count(q.id) AS n_events FROM (
    SELECT greatest(m, stop - INTERVAL 365 DAY) AS window_start, m + INTERVAL 1 MONTH AS window_end
    FROM (SELECT stop, unnest(generate_series(date_trunc('month', stop - INTERVAL 365 DAY)::TIMESTAMP,
                              stop - INTERVAL 1 SECOND, INTERVAL 1 MONTH)) AS m
          FROM (SELECT date_trunc('month', max(time_utc) + INTERVAL 31 DAY)::TIMESTAMP AS stop FROM quake))) w
  LEFT JOIN quake q ON q.time_utc >= w.window_start AND q.time_utc < w.window_end GROUP BY 1, 2"""),
    "recent_window": _q("""SELECT date_trunc('second', max(time_utc)) - INTERVAL 30 DAY AS window_start,
  date_trunc('second', max(time_utc)) AS window_end FROM quake"""),
    "country_edges": f"""WITH {LAYERS['country']}, {_edges('country')}, {LAYERS['zone']}, {_edges('zone')}
SELECT poly, ring, x1, y1, x2, y2 FROM country_edge UNION ALL SELECT poly + 100, ring, x1, y1, x2, y2 FROM zone_edge""",
    "sea_edges": f"""WITH {LAYERS['sea']}, {_edges('sea')}, {LAYERS['basin']}, {_edges('basin')}
SELECT poly, ring, x1, y1, x2, y2 FROM sea_edge UNION ALL SELECT poly + 100, ring, x1, y1, x2, y2 FROM basin_edge""",
    "flatten_feature": _q(FEED),
    "epoch_ms_to_ts": _q(f"SELECT id, make_timestamp(nullif({HELD_MS}, 0) * 1000) AS ts FROM quake"),
    "to_feature": _q("""SELECT id, 'Feature' AS feature_type, CASE WHEN lon IS NOT NULL AND lat IS NOT NULL THEN 2 END AS n_coordinates,
  (epoch_us(time_utc) // 1000) AS time, mag, place, depth_km, lon, lat, coalesce(tsunami, 0) AS tsunami, net, url, title FROM quake"""),
    "ts_to_epoch_ms": _q("SELECT id, (epoch_us(time_utc) // 1000) AS ms FROM quake"),
    "event_rows": _q("""SELECT id, date_trunc('milliseconds', time_utc) AS time, CAST((epoch_us(time_utc) // 1000) AS DOUBLE) AS time_ms, mag,
  depth_km, lon, lat, coalesce(nullif(place, ''), title) AS place, net, coalesce(tsunami, 0) AS tsunami, url
  FROM quake WHERE lon IS NOT NULL AND lat IS NOT NULL"""),
    "numeric_coerce": _q("""SELECT id, TRY_CAST(CASE WHEN tsunami = 1 THEN title ELSE split_part(place, ' ', 1) END AS DOUBLE) AS number
  FROM quake"""),
    "to_iso": _q(f"""SELECT id, coalesce(strftime(make_timestamp(nullif({HELD_MS}, 0) * 1000), '%Y-%m-%d %H:%M:%S'), '—') AS iso
  FROM quake"""),
    "display_place": _q("SELECT id, coalesce(nullif(place, ''), nullif(title, ''), '—') AS place_text FROM quake"),
    "normalize_time": _q("""SELECT id, CASE WHEN tsunami = 1 OR net = 'us' THEN (epoch_us(time_utc) // 1000)
  WHEN net = 'AK' THEN (epoch_us(date_trunc('second', time_utc)) // 1000) ELSE 0 END AS time_ms FROM quake"""),
    "format_event_row": _q(f"""SELECT id, concat(strftime(date_trunc('milliseconds', time_utc), '%Y-%m-%d %H:%M:%S.%g'), ' Z') AS time_text,
  coalesce(nullif(place, ''), nullif(title, ''), '—') AS place_text, {_fixed('mag', 1)} AS mag_text,
  {_fixed('depth_km', 1)} AS depth_text, coalesce(nullif(net, ''), '—') AS net_text, coalesce(tsunami, 0) AS tsunami,
  {_fixed('lon', 3)} AS lon_text, {_fixed('lat', 3)} AS lat_text, coalesce(nullif(url, ''), '#') AS url FROM quake"""),
    "clean_lookup_key": f"WITH {ZONE_RAW}, {ZONE_CLEAN} SELECT row_id, iso, name FROM zone_clean WHERE iso IS NOT NULL AND name IS NOT NULL",
    "mag_radius": _q(f"SELECT id, round({_interpolated(MAG0, [(0, 3), (2, 5), (4, 8), (6, 14), (7, 20)])}, 6) AS radius FROM quake"),
    "mag_weight": _q(f"SELECT id, round({WEIGHT}, 6) AS weight FROM quake"),
    "mag_color": _q(f"""SELECT id, concat('#', {_channel(79, 255, 239, 217)}, {_channel(224, 209, 71, 4)}, {_channel(138, 102, 111, 41)}) AS color
  FROM quake"""),
    "age_fade": _q(f"""SELECT id, round({_interpolated(AGE, FADE_STOPS)}, 6) AS fade,
  round({_interpolated(AGE, [(0, 0.9), (6, 0.4), (24, 0.1), (72, 0)])}, 6) AS opacity FROM quake"""),
    "snap_to_hour": _q("""SELECT id, least(greatest(CAST(floor((epoch_us(time_utc) // 1000) / 3600000.0 + 0.5) AS BIGINT) * 3600000,
  (epoch_us(TIMESTAMP '2024-01-02') // 1000)), (epoch_us(TIMESTAMP '2024-01-29') // 1000)) AS snapped_ms FROM quake"""),
    "filter_time": _q("SELECT * FROM quake WHERE time_utc BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-20 18:00:00'"),
    "filter_mag": _q("SELECT * FROM quake WHERE mag BETWEEN 2.5 AND 6.0"),
    "filter_depth": _q("SELECT * FROM quake WHERE depth_km BETWEEN 0 AND 300"),
    "filter_tsunami": _q("SELECT * FROM quake WHERE tsunami = 1"),
    "filter_text": _q("SELECT * FROM quake WHERE contains(lower(place), 'click quake') OR contains(lower(title), 'click quake')"),
    "filter_network": _q("SELECT * FROM quake WHERE lower(net) IN ('us', 'ak')"),
    "filter_bbox": _q("SELECT * FROM quake WHERE lon BETWEEN -60 AND 60 AND lat BETWEEN -30 AND 45"),
    "search_text": _q("""SELECT s.query, id, place, title FROM quake JOIN (VALUES ('us'), ('click quake'), ('km ne of nation_1'), ('ew quake, nation_24')) s(query)
  ON contains(lower(place), s.query) OR contains(lower(title), s.query)"""),
    "visible_at": _q("""SELECT id, time_utc FROM quake WHERE (epoch_us(time_utc) // 1000) BETWEEN (epoch_us(TIMESTAMP '2024-01-03') // 1000)
  AND (epoch_us(TIMESTAMP '2024-01-10 12:00:00') // 1000)"""),
    "query_events": _q("""SELECT * FROM quake
  WHERE time_utc BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-28 12:00:00' AND mag BETWEEN 0.5 AND 9.0
    AND depth_km BETWEEN 0 AND 600 AND (contains(lower(place), 'nation_1') OR contains(lower(title), 'nation_1'))
    AND lower(net) IN ('us', 'ak', 'pr') AND lon BETWEEN -170 AND 170 AND lat BETWEEN -80 AND 80
  ORDER BY time_utc DESC, id LIMIT 5000"""),
    "resolve_country": f"WITH {LOCATED} SELECT quake_id AS id, country_iso FROM location",
    "resolve_sea": f"WITH {LOCATED} SELECT quake_id AS id, sea_id FROM location",
    "resolve_zone": _q("SELECT p.id, h.poly FROM points p LEFT JOIN zone_hit h ON p.id = h.id", POINTS, _covering("zone")),
    "resolve_basin": _q("SELECT p.id, h.poly FROM points p LEFT JOIN basin_hit h ON p.id = h.id", POINTS, _covering("basin")),
    "resolve_location": f"WITH {LOCATED} SELECT * FROM location",
    "pip_candidates": _q("SELECT id, lon, lat, poly FROM country_cand", _covering("country")),
    "covering_pairs": _q("SELECT id, poly FROM zone_pair", _covering("zone")),
    "count_quakes": _q("SELECT count(*) AS n FROM quake"),
    "histogram_mag": _histogram("mag", "mag IS NOT NULL", 30),
    "histogram_depth": _histogram("depth_km", "depth_km >= 0", 40),
    "histogram_log": _histogram("mag", "mag IS NOT NULL", 30, ", round(log10(count), 6) AS log_count"),
    "describe_mag": _describe("mag", "mag IS NOT NULL"),
    "describe_depth": _describe("depth_km", "depth_km >= 0"),
    "describe_depth_ranked": _describe("depth_km", "depth_km >= 0"),
    "describe_sketched": _q("""SELECT count(*) AS count, round(avg(depth_km), 6) AS mean, round(stddev_samp(depth_km), 6) AS std, min(depth_km) AS min,
  max(depth_km) AS max, true AS p25_close, true AS p50_close, true AS p75_close FROM quake
  WHERE depth_km >= 0 AND time_utc >= TIMESTAMP '2024-01-03 06:00:00' AND time_utc < TIMESTAMP '2024-01-24 18:30:00'"""),
    "country_lookup": f"WITH {ZONE_RAW}, {ZONE_CLEAN}, {ZONE_LOOKUP} SELECT iso, name FROM zone_lookup",
    "sea_lookup": f"WITH {BASIN_LOOKUP} SELECT id, name FROM basin_lookup",
    "heat_density": _q(f"""SELECT {_cell('lat', 10)} AS cell_r, {_cell('lon', 10)} AS cell_c,
  round(sum({WEIGHT} * {_interpolated(AGE, FADE_STOPS)}), 6) AS heat, count(*) AS n_events
  FROM quake WHERE lon IS NOT NULL AND lat IS NOT NULL AND time_utc <= TIMESTAMP '2024-01-31'
    AND time_utc > TIMESTAMP '2024-01-31' - INTERVAL 72 HOUR GROUP BY 1, 2"""),
    "dense_id": _q("SELECT time_utc, usgs_id, id, 1000 + row_number() OVER (ORDER BY time_utc, usgs_id, id) AS dense_id FROM quake"),
    "dedup_first": _q("SELECT * FROM firsts", FIRSTS),
    "newest_k": _q("SELECT * FROM quake ORDER BY time_utc DESC, id LIMIT 5000"),
    "table_sorted": "",
    "map_table": _q("SELECT id, time_utc, coalesce(nullif(place, ''), nullif(title, ''), '—') AS place_text, mag FROM quake"),
    "union_windows": _q("SELECT * FROM quake"),
    "insert_new": _q("SELECT * FROM firsts", FIRSTS),
    "insert_filtered": _q("SELECT usgs_id, mag, time_utc, title, net, depth_km, lon, lat FROM firsts", FIRSTS),
    "upsert_country": f"""WITH {COUNTRY}, {ZONE_RAW}, {ZONE_CLEAN}, {ZONE_LOOKUP}
SELECT coalesce(z.iso, c.iso) AS iso, coalesce(z.name, c.name) AS name FROM country c FULL JOIN zone_lookup z ON c.iso = z.iso""",
    "upsert_sea": f"""WITH {SEA}, {BASIN_LOOKUP}
SELECT coalesce(b.id, s.id) AS id, coalesce(b.name, s.name) AS name
FROM (SELECT id, name FROM sea UNION ALL SELECT 100000, 'Old Sea') s FULL JOIN basin_lookup b ON s.id = b.id""",
    "upsert_location": f"""WITH {LOCATED}, {ZONED}
SELECT l.quake_id, CASE WHEN z.time_utc >= {MID} THEN z.country_iso ELSE l.country_iso END AS country_iso,
  CASE WHEN z.time_utc >= {MID} THEN z.sea_id ELSE l.sea_id END AS sea_id
FROM location l JOIN zone_location z ON l.quake_id = z.quake_id""",
    "relocate_changed": f"""WITH {LOCATED}, fewer AS (SELECT id, MIN(poly) AS poly FROM country_pair WHERE poly % 7 <> 3 GROUP BY id)
SELECT p.id AS quake_id, CASE WHEN c.poly IS NOT NULL THEN {ISO_OF} END AS country_iso, CAST(s.poly AS INT) AS sea_id
FROM points p LEFT JOIN fewer c ON p.id = c.id LEFT JOIN sea_hit s ON p.id = s.id""",
    "resolve_incremental": f"""WITH {LOCATED}
SELECT l.* FROM location l JOIN quake q ON l.quake_id = q.id WHERE q.time_utc >= {MID}""",
    "load_log": _q("""SELECT net AS source, day AS start_time_utc, day + INTERVAL 1 DAY AS end_time_utc, count(*) AS rows_submitted,
  count(CASE WHEN rn = 1 THEN 1 END) AS rows_inserted, 'success' AS status FROM (
    SELECT net, date_trunc('day', time_utc)::TIMESTAMP AS day, row_number() OVER (PARTITION BY usgs_id ORDER BY id) AS rn FROM quake)
  GROUP BY 1, 2"""),
    "feature_collection": _q("""SELECT 'FeatureCollection' AS document_type, CAST(row_number() OVER (ORDER BY time_utc DESC, id) - 1 AS INT) AS position,
  (epoch_us(time_utc) // 1000) AS time, mag, place, depth_km, lon, lat, coalesce(tsunami, 0) AS tsunami, net, url, title
  FROM quake ORDER BY time_utc DESC, id LIMIT 5000"""),
    "check_unique": _q("SELECT usgs_id, count(*) AS n FROM quake GROUP BY usgs_id HAVING count(*) > 1 OR usgs_id IS NULL"),
    "check_not_null": _q("""SELECT count(*) FILTER (id IS NULL) AS id, count(*) FILTER (usgs_id IS NULL) AS usgs_id,
  count(*) FILTER (mag IS NULL) AS mag, count(*) FILTER (lon IS NULL) AS lon FROM quake"""),
    "check_references": _q("""SELECT country_iso AS missing, count(*) AS n FROM zone_location
  WHERE country_iso IS NOT NULL AND country_iso NOT IN (SELECT iso FROM country) GROUP BY 1""", POINTS, ZONED, COUNTRY),
    "delete_cascade": f"WITH {LOCATED} SELECT * FROM location WHERE quake_id NOT IN (SELECT id FROM quake WHERE tsunami = 1)",
    "delete_set_null": f"""WITH {LOCATED}
SELECT quake_id, CASE WHEN country_iso < 'N10' THEN NULL ELSE country_iso END AS country_iso, sea_id FROM location""",
    "playback_counts": _q("""SELECT frame, frame_time, (SELECT count(*) FROM quake
    WHERE (epoch_us(time_utc) // 1000) BETWEEN (epoch_us(TIMESTAMP '2024-01-02') // 1000) AND (epoch_us(frame_time) // 1000)) AS visible
  FROM (SELECT f AS frame, TIMESTAMP '2024-01-02' + f * INTERVAL 1 HOUR AS frame_time FROM range(0, 679) AS r(f))"""),
    "playback_heat": _q(f"""SELECT frame, {_cell('lat', 20)} AS cell_r, {_cell('lon', 20)} AS cell_c,
  round(sum({WEIGHT} * {_interpolated('age', FADE_STOPS)}), 6) AS heat, CAST(count(*) AS BIGINT) AS n_events
  FROM (SELECT q.*, f.frame, ((epoch_us(f.at) // 1000) - (epoch_us(q.time_utc) // 1000)) / 3600000.0 AS age FROM quake q JOIN (
      SELECT r.f AS frame, TIMESTAMP '2024-01-02' + r.f * INTERVAL 4 HOUR AS at FROM range(0, 170) AS r(f)) f
    ON (epoch_us(q.time_utc) // 1000) <= (epoch_us(f.at) // 1000) AND (epoch_us(q.time_utc) // 1000) >= (epoch_us(TIMESTAMP '2024-01-02') // 1000))
  WHERE age < 72 AND lon IS NOT NULL AND lat IS NOT NULL GROUP BY 1, 2, 3"""),
    "last_within_km": _q(f"""SELECT place, id, time_utc, mag, km FROM (
    SELECT *, row_number() OVER (PARTITION BY place ORDER BY time_utc DESC, id DESC) AS rn FROM (
      SELECT p.place, q.id, q.time_utc, q.mag, round({KM}, 3) AS km FROM quake q CROSS JOIN places p WHERE q.lon IS NOT NULL)
    WHERE km <= 500) WHERE rn = 1""", PLACES),
    "frequency_grid": _q(f"""SELECT {_cell('lat', 10)} AS cell_r, {_cell('lon', 10)} AS cell_c, count(*) AS n_events FROM quake
  WHERE time_utc <= TIMESTAMP '2024-01-31' AND time_utc > TIMESTAMP '2024-01-30' AND lon IS NOT NULL AND lat IS NOT NULL GROUP BY 1, 2"""),
    "frequency_grid_year": _q(f"""SELECT {_cell('lat', 5)} AS cell_r, {_cell('lon', 5)} AS cell_c, count(*) AS n_events FROM quake
  WHERE time_utc <= TIMESTAMP '2024-01-31' AND time_utc > TIMESTAMP '2023-01-31' AND lon IS NOT NULL AND lat IS NOT NULL GROUP BY 1, 2"""),
    "tsunami_near": _q(f"""SELECT place, id, time_utc, mag, km FROM (
    SELECT p.place, q.id, q.time_utc, q.mag, round({KM}, 3) AS km FROM quake q CROSS JOIN places p
    WHERE q.lon IS NOT NULL AND q.tsunami = 1 AND q.time_utc >= {MID}) WHERE km <= 500""", PLACES),
    "quakes_by_country": f"""WITH {LOCATED}, {COUNTRY}
SELECT q.id, q.time_utc, q.mag, l.country_iso, c.name AS country FROM quake q JOIN location l ON q.id = l.quake_id
JOIN country c ON l.country_iso = c.iso
WHERE l.country_iso = 'N07' AND q.mag > 2.0 AND q.time_utc >= TIMESTAMP '2024-01-31' - INTERVAL 20 DAY""",
    "strongest_k": _q("SELECT * FROM quake ORDER BY mag DESC NULLS LAST, id LIMIT 100"),
    "nearest_k": _q(f"""SELECT q.*, round({HAVERSINE.format(lon='16.37', lat='48.21')}, 3) AS km FROM quake q
  WHERE q.lon IS NOT NULL AND q.lat IS NOT NULL ORDER BY km, q.id LIMIT 100"""),
    "nearest_k_per_place": _q(f"""SELECT place, id, km, rank FROM (
    SELECT place, id, km, CAST(row_number() OVER (PARTITION BY place ORDER BY km, id) AS INT) AS rank FROM (
      SELECT p.place, q.id, round({KM}, 3) AS km FROM quake q CROSS JOIN places p WHERE q.lon IS NOT NULL AND q.lat IS NOT NULL)) WHERE rank <= 5""", PLACES),
    "hourly_counts": _q("""SELECT h.hour, count(q.id) AS n_events FROM (
    SELECT unnest(generate_series(date_trunc('hour', min(time_utc))::TIMESTAMP, max(time_utc)::TIMESTAMP, INTERVAL 1 HOUR)) AS hour FROM quake) h
  LEFT JOIN quake q ON date_trunc('hour', q.time_utc) = h.hour GROUP BY 1"""),
    "coverage_gaps": """WITH done AS (
  SELECT event_type AS source, date_trunc('second', ts) AS a,
    date_trunc('second', ts) + CAST(json_extract_string(props, '$.k') AS INT) * INTERVAL 1 MINUTE AS b FROM events WHERE NOT value > 100),
loads AS (SELECT source, a, max(b) AS b FROM done GROUP BY 1, 2)
SELECT source, upto AS gap_start, a AS gap_end FROM (
  SELECT source, a, max(b) OVER (PARTITION BY source ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto FROM loads)
WHERE a > upto""",
    "backfill_windows": """WITH done AS (
  SELECT event_type AS source, date_trunc('second', ts) AS a,
    date_trunc('second', ts) + CAST(json_extract_string(props, '$.k') AS INT) * INTERVAL 1 MINUTE AS b FROM events WHERE NOT value > 100),
wanted AS (SELECT DISTINCT event_type AS source, TIMESTAMP '2024-01-01' AS w0, TIMESTAMP '2024-01-31' AS w1 FROM events),
loads AS (SELECT source, greatest(a, w0) AS a, least(b, w1) AS b FROM done JOIN wanted USING (source) WHERE b > w0 AND a < w1
  UNION ALL SELECT source, w0, w0 FROM wanted UNION ALL SELECT source, w1, w1 FROM wanted),
gap AS (SELECT source, upto AS g0, a AS g1 FROM (
  SELECT source, a, max(b) OVER (PARTITION BY source ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto FROM loads) WHERE a > upto)
SELECT source, g0 + k * INTERVAL 6 HOUR AS window_start, least(g0 + (k + 1) * INTERVAL 6 HOUR, g1) AS window_end
FROM gap, range(0, 200) AS r(k) WHERE g0 + k * INTERVAL 6 HOUR < g1""",
    "latest_coverage": """SELECT event_type AS source,
  max(date_trunc('second', ts) + CAST(json_extract_string(props, '$.k') AS INT) * INTERVAL 1 MINUTE) AS covered_to
FROM events WHERE NOT value > 100 GROUP BY 1""",
    "country_stats": f"""WITH {LOCATED}
SELECT l.country_iso, l.sea_id, count(*) AS n_events, max(q.mag) AS max_mag, round(avg(q.depth_km), 6) AS mean_depth_km
FROM quake q JOIN location l ON q.id = l.quake_id GROUP BY 1, 2""",
    "stream_features": _q(FEED),
    "stream_dedup": _q("SELECT DISTINCT usgs_id FROM quake"),
    "stream_tumbling": _q("""SELECT date_trunc('hour', time_utc)::TIMESTAMP AS window_start,
  date_trunc('hour', time_utc)::TIMESTAMP + INTERVAL 1 HOUR AS window_end, count(*) AS n_events FROM quake GROUP BY 1, 2"""),
    "stream_sliding": _q("""SELECT window_start, window_start + INTERVAL 24 HOUR AS window_end, count(*) AS n_events FROM (
    SELECT date_trunc('hour', time_utc)::TIMESTAMP - k * INTERVAL 1 HOUR AS window_start FROM quake CROSS JOIN range(0, 24) AS r(k))
  GROUP BY 1"""),
    "stream_insert_new": _q("""SELECT usgs_id, date_trunc('milliseconds', time_utc) AS time_utc, mag, lon, lat FROM (
    SELECT *, row_number() OVER (PARTITION BY usgs_id ORDER BY time_utc) AS rn FROM quake) WHERE rn = 1"""),
    "tsunami_alerts": _q(f"""SELECT DISTINCT usgs_id, place FROM (
    SELECT p.place, q.usgs_id, round({KM}, 3) AS km FROM quake q CROSS JOIN places p
    WHERE q.lon IS NOT NULL AND q.tsunami = 1) WHERE km <= 500""", PLACES),
    "stream_last_quake": _q(f"""SELECT place, usgs_id, time_utc, mag, km FROM (
    SELECT *, row_number() OVER (PARTITION BY place ORDER BY time_utc DESC, usgs_id DESC) AS rn FROM (
      SELECT p.place, q.usgs_id, date_trunc('milliseconds', q.time_utc) AS time_utc, q.mag, round({KM}, 3) AS km
      FROM quake q CROSS JOIN places p WHERE q.lon IS NOT NULL)
    WHERE km <= 500) WHERE rn = 1""", PLACES),
}
ORACLES["table_sorted"] = ORACLES["event_rows"]

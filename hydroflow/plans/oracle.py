"""SQL twins of the registered queries, for an independent engine over the same tables."""

from __future__ import annotations

_DAY = "strftime({0}, '%Y-%m-%d')"
_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"


def _day(c: str) -> str:
    return _DAY.format(c)


def _time(c: str) -> str:
    return _TIME.format(c)


_ID = """CAST(user_id * 10 + CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2
         WHEN 'signup' THEN 3 WHEN 'error' THEN 4 END AS BIGINT)"""

THINGS = """things AS (
  SELECT s_suppkey AS iot_id, s_name AS name, 'nation ' || s_nationkey AS description,
         CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE CAST(s_suppkey AS VARCHAR) END AS station_id
  FROM supplier)"""

LOCATIONS = """locations AS (
  SELECT s_suppkey AS thing_id, s_name AS name,
         CASE WHEN s_suppkey % 11 <> 0 THEN CAST(9.8 AS DOUBLE) + (s_suppkey % 30) * CAST(0.1 AS DOUBLE) END AS lon,
         CASE WHEN s_suppkey % 11 <> 0 THEN CAST(50.2 AS DOUBLE) + (s_suppkey % 16) * CAST(0.1 AS DOUBLE) END AS lat
  FROM supplier)"""

DATASTREAMS = f"""ds AS (
  SELECT DISTINCT {_ID} AS datastream_id, user_id AS thing_id, event_type || '@' || user_id AS datastream,
         CASE event_type WHEN 'view' THEN 'm³/s' WHEN 'click' THEN 'cm' ELSE '' END AS unit,
         CASE user_id % 3 WHEN 0 THEN 'TH_PEGELDATEN_1D' WHEN 1 THEN 'TH_PEGELDATEN_15MIN' END AS type,
         event_type AS parameter
  FROM events)"""

OBS = f"""obs AS (
  SELECT {_ID} AS datastream_id, ts, value AS result, event_id AS obs_id FROM events)"""

PLANTS = "plants AS (SELECT user_id % 2 AS plant, ts, event_id, round(value * 100) AS power FROM events)"

WIDE = """wide AS (
  SELECT user_id % 2 AS plant, date_trunc('hour', ts) AS ts,
         avg(CASE WHEN event_type = 'view' THEN round(value * 100) END) AS discharge_view,
         avg(CASE WHEN event_type = 'click' THEN round(value * 100) END) AS discharge_click,
         avg(CASE WHEN event_type = 'purchase' THEN round(value * 100) END) AS power
  FROM events GROUP BY 1, 2)"""

COMPLETE = """complete AS (
  SELECT *, row_number() OVER (PARTITION BY plant ORDER BY ts) AS rn FROM wide
  WHERE discharge_view IS NOT NULL AND discharge_click IS NOT NULL AND power IS NOT NULL)"""

LAUNCHES = """launches AS (
  SELECT DISTINCT plant, date_trunc('day', ts) + INTERVAL 10 HOUR AS cutoff FROM wide)"""

WINDOW = """obs_window AS (
  SELECT * FROM obs WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-12 00:00:00')"""


POWER_DAILY = """power_daily AS (
  SELECT s.day, m.el, m.el1
  FROM (SELECT CAST(unnest(generate_series(min(o_orderdate::DATE)::TIMESTAMP, max(o_orderdate::DATE)::TIMESTAMP,
                                           INTERVAL 1 DAY)) AS DATE) AS day FROM orders) s
  LEFT JOIN (SELECT o_orderdate::DATE AS day, avg(round(o_totalprice * 100)) AS el,
                    avg(CASE WHEN o_orderstatus = 'F' THEN round(o_totalprice * 100) END) AS el1
             FROM orders GROUP BY 1) m ON s.day = m.day)"""

FLOW_DAILY = """flow_daily AS (
  SELECT s.day, m.q
  FROM (SELECT CAST(unnest(generate_series(min(l_shipdate::DATE)::TIMESTAMP, max(l_shipdate::DATE)::TIMESTAMP,
                                           INTERVAL 1 DAY)) AS DATE) AS day FROM lineitem) s
  LEFT JOIN (SELECT l_shipdate::DATE AS day, avg(l_quantity) AS q FROM lineitem GROUP BY 1) m ON s.day = m.day)"""

RELATION = f"""WITH {POWER_DAILY}, {FLOW_DAILY},
relation AS (SELECT p.day, p.el, p.el1, f.q FROM power_daily p JOIN flow_daily f ON p.day = f.day)"""

_FEATURES = """features AS (
  SELECT plant, ts, rn, power,
         avg(power) OVER (PARTITION BY plant ORDER BY ts ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS power_ma_4h
  FROM complete)"""

RESOLVE = """SELECT r.text, COALESCE(m.thing_id, -1) AS thing_id, m.station FROM requested r
LEFT JOIN (
  SELECT t.text, min(iot_id) AS thing_id, arg_min(name, iot_id) AS station
  FROM (SELECT DISTINCT text FROM requested) t JOIN things ON contains(lower(name), lower(t.text))
  GROUP BY t.text) m ON r.text = m.text"""

LOAD = f"""WITH {THINGS}, {DATASTREAMS}, {OBS}, {WINDOW},
requested AS (SELECT upper(substr(c_name, 7)) AS text FROM customer),
resolved AS ({RESOLVE}),
matched AS (SELECT thing_id, min(datastream_id) AS datastream_id FROM ds
            WHERE starts_with(datastream, 'view@') AND type = 'TH_PEGELDATEN_15MIN' GROUP BY 1),
counted AS (SELECT datastream_id, count(*) AS n_obs FROM obs_window GROUP BY 1),
status AS (
  SELECT r.text, r.thing_id, m.datastream_id,
         CASE WHEN r.thing_id = -1 THEN 'no_station' WHEN m.datastream_id IS NULL THEN 'no_datastream'
              WHEN c.n_obs IS NULL THEN 'no_data' ELSE 'loaded' END AS status
  FROM resolved r LEFT JOIN matched m ON r.thing_id = m.thing_id LEFT JOIN counted c ON m.datastream_id = c.datastream_id),
store AS (
  SELECT 'view' AS param, s.station_id, s.station, '15min' AS freq, d.unit, w.ts, w.result
  FROM obs_window w
  JOIN (SELECT DISTINCT m.datastream_id, r.thing_id AS station_id, r.station FROM resolved r JOIN matched m ON r.thing_id = m.thing_id) s
    ON w.datastream_id = s.datastream_id
  JOIN ds d ON d.datastream_id = w.datastream_id)"""


REQUESTS = f"""WITH {THINGS}, {DATASTREAMS}, {OBS},
asked AS (
  SELECT c_custkey AS request_id, c_custkey AS k,
    CASE WHEN c_custkey % 29 = 0 THEN '' WHEN c_custkey % 31 = 0 THEN 'no such place'
      ELSE 'SUPPLIER#' || lpad(((c_custkey * 7) % 97)::VARCHAR, 9, '0') END AS text,
    ['view', 'click', 'purchase', 'signup', 'error', 'flow'][c_custkey % 6 + 1] AS param,
    ['15min', '1D', '15min', '1D', '15min', '1H'][(c_custkey // 6) % 6 + 1] AS freq,
    (DATE '2024-01-01' + (c_custkey % 25)::INTEGER)::TIMESTAMP AS starts,
    CASE WHEN c_custkey % 37 <> 0 THEN (DATE '2024-01-01' + (c_custkey % 25 + c_custkey % 41 - 1)::INTEGER)::TIMESTAMP END AS ends
  FROM customer),
named AS (
  SELECT a.*, CASE WHEN text <> '' THEN (SELECT min(iot_id) FROM things t WHERE contains(lower(t.name), lower(a.text))) END AS thing_id
  FROM asked a),
matched AS (
  SELECT n.*, t.name AS station, (SELECT min(datastream_id) FROM ds d WHERE d.thing_id = n.thing_id AND split_part(d.datastream, '@', 1) = n.param
    AND d.type = CASE n.freq WHEN '1D' THEN 'TH_PEGELDATEN_1D' WHEN '15min' THEN 'TH_PEGELDATEN_15MIN' END) AS datastream_id
  FROM named n LEFT JOIN things t ON t.iot_id = n.thing_id),
held AS (
  SELECT m.*, d.unit, o.ts, o.result FROM matched m JOIN ds d ON d.datastream_id = m.datastream_id
  JOIN obs o ON o.datastream_id = m.datastream_id AND o.ts >= m.starts AND o.ts <= m.ends),
outcome AS (
  SELECT m.request_id, coalesce(n, 0)::BIGINT AS n_obs, CASE WHEN text = '' OR ends IS NULL THEN 'incomplete'
    WHEN freq NOT IN ('1D', '15min') THEN 'bad_frequency'
    WHEN param NOT IN (SELECT split_part(datastream, '@', 1) FROM ds) THEN 'bad_parameter'
    WHEN thing_id IS NULL THEN 'no_station' WHEN datastream_id IS NULL THEN 'no_datastream'
    WHEN n IS NULL THEN 'no_data' ELSE 'loaded' END AS status
  FROM matched m LEFT JOIN (SELECT request_id, count(*) AS n FROM held GROUP BY 1) h ON h.request_id = m.request_id)"""


def _exceed(condition: str) -> str:
    return f"""WITH {DATASTREAMS}, {OBS},
hits AS (SELECT *, row_number() OVER (PARTITION BY datastream_id ORDER BY ts, obs_id) AS rank,
                count(*) OVER (PARTITION BY datastream_id) AS total FROM obs WHERE result {condition})
SELECT h.datastream_id, h.rank, h.total, {_time('h.ts')} AS ts, h.result, ds.unit
FROM hits h JOIN ds ON h.datastream_id = ds.datastream_id WHERE h.rank <= 20"""


_CUT = """days AS (SELECT DISTINCT plant, ts::DATE AS day FROM complete),
cut AS (SELECT plant, day FROM days QUALIFY row_number() OVER (PARTITION BY plant ORDER BY day DESC) = 2)"""

# The cut-off day, its trend, and the day after it; needs complete (plant, ts, power) and cut (plant, day).
_ACTUALS = """of_day AS (SELECT c.* FROM complete c JOIN cut ON c.plant = cut.plant AND c.ts::DATE = cut.day),
frame AS (
  SELECT plant, ts, 'actual' AS series, power AS value FROM of_day
  UNION ALL
  SELECT plant, ts, 'trend', avg(power) OVER (PARTITION BY plant ORDER BY ts ROWS BETWEEN 15 PRECEDING AND CURRENT ROW) FROM of_day
  UNION ALL
  SELECT c.plant, c.ts, 'next_day_actual', c.power FROM complete c JOIN cut ON c.plant = cut.plant AND c.ts::DATE = cut.day + 1)"""

_HOUR_MEANS = """hours AS (SELECT plant, hour(ts) AS hour, avg(power) AS mean FROM plants WHERE ts::DATE <= DATE '2024-01-15' GROUP BY 1, 2)"""


_LINE = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || ',' || CAST(result AS VARCHAR)"

ORACLE: dict[str, str] = {
    # Time series
    "daily_resample": f"""WITH {POWER_DAILY}
SELECT {_day('day')} AS day, el, el1 FROM power_daily""",
    "daily_resample_keyed": f"""WITH m AS (
  SELECT o_orderpriority, o_orderdate::DATE AS day, avg(round(o_totalprice * 100)) AS el FROM orders GROUP BY 1, 2),
s AS (SELECT o_orderpriority, CAST(unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day
      FROM m GROUP BY 1)
SELECT s.o_orderpriority, {_day('s.day')} AS day, m.el
FROM s LEFT JOIN m ON s.o_orderpriority = m.o_orderpriority AND s.day = m.day""",
    "daily_join": f"""{RELATION}
SELECT {_day('day')} AS day, el, el1, q FROM relation""",
    "daily_head": f"""{RELATION}
SELECT row_number() OVER (ORDER BY day) - 1 AS place, {_day('day')} AS day, el, el1, q FROM relation ORDER BY day LIMIT 10""",
    "daily_join_zoned": f"""WITH power AS (
  SELECT CAST(timezone('Europe/Berlin', timezone('UTC', ts)) AS DATE) AS day, avg(round(value * 100)) AS power
  FROM events WHERE event_type = 'purchase' GROUP BY 1),
days AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM power),
flow AS (SELECT CAST(ts AS DATE) AS day, avg(round(value * 100)) AS q FROM events WHERE event_type = 'view' GROUP BY 1),
flow_days AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM flow)
SELECT {_day('d.day')} AS day, p.power, f.q FROM days d LEFT JOIN power p ON p.day = d.day
JOIN flow_days e ON e.day = d.day LEFT JOIN flow f ON f.day = d.day""",
    "daily_power_discharge_corr": f"""{RELATION}
SELECT round(corr(el, q), 6) AS corr_el, round(corr(el1, q), 6) AS corr_el1 FROM relation""",
    "trailing_mean": f"""WITH {PLANTS}
SELECT plant, event_id, {_time('ts')} AS ts,
       avg(power) OVER (PARTITION BY plant ORDER BY ts, event_id ROWS BETWEEN 15 PRECEDING AND CURRENT ROW) AS power_ma_4h
FROM plants""",
    "trailing_mean_chunked": f"""WITH {PLANTS}
SELECT event_id, {_time('ts')} AS ts,
       avg(power) OVER (ORDER BY ts, event_id ROWS BETWEEN 95 PRECEDING AND CURRENT ROW) AS power_ma_24h
FROM plants""",
    "day_trailing_mean": f"""WITH {PLANTS}
SELECT plant, event_id, {_day('ts')} AS day,
       avg(power) OVER (PARTITION BY plant, ts::DATE ORDER BY ts, event_id
                        ROWS BETWEEN 15 PRECEDING AND CURRENT ROW) AS trend
FROM plants""",
    "trailing_mean_null_keys": f"""WITH {PLANTS}, rows_ AS (
  SELECT CASE WHEN event_id % 5 <> 0 THEN plant END AS plant, ts, event_id, power FROM plants)
SELECT plant, event_id,
       avg(power) OVER (PARTITION BY plant ORDER BY ts, event_id ROWS BETWEEN 15 PRECEDING AND CURRENT ROW) AS power_ma_4h
FROM rows_""",
    "row_positions_null_keys": f"""WITH {PLANTS}, rows_ AS (
  SELECT CASE WHEN event_id % 5 <> 0 THEN plant END AS plant, ts, event_id FROM plants)
SELECT plant, event_id, row_number() OVER (PARTITION BY plant ORDER BY ts, event_id) - 1 AS row_index FROM rows_""",
    "row_positions": f"""WITH {PLANTS}
SELECT plant, event_id, row_number() OVER (PARTITION BY plant ORDER BY ts, event_id) - 1 AS row_index FROM plants""",
    # Features and cut-offs
    "wide_features_dropna": f"""WITH {WIDE}, {COMPLETE}
SELECT plant, {_time('ts')} AS ts, round(power, 6) AS power, round(discharge_view, 6) AS discharge_view,
       round(discharge_click, 6) AS discharge_click FROM complete""",
    "build_features": f"""WITH {WIDE}
SELECT plant, {_time('ts')} AS ts, round(discharge_view, 6) AS discharge_view,
       round(discharge_click, 6) AS discharge_click,
       round(avg(power) OVER (PARTITION BY plant ORDER BY ts ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 6) AS power_ma_4h
FROM wide""",
    "lookback_flatten": f"""WITH {WIDE}, {COMPLETE}, {LAUNCHES},
hit AS (SELECT c.plant, c.ts AS cutoff, c.rn FROM complete c JOIN launches l ON c.plant = l.plant AND c.ts = l.cutoff
       WHERE c.rn >= 24),
win AS (SELECT a.plant, a.cutoff, c.rn - a.rn + 23 AS i, c.discharge_view, c.discharge_click
        FROM hit a JOIN complete c ON a.plant = c.plant AND c.rn BETWEEN a.rn - 23 AND a.rn)
SELECT plant, {_time('cutoff')} AS cutoff, i * 2 AS slot, round(discharge_view, 6) AS value FROM win
UNION ALL
SELECT plant, {_time('cutoff')} AS cutoff, i * 2 + 1 AS slot, round(discharge_click, 6) AS value FROM win""",
    "lookback_status": f"""WITH {WIDE}, {LAUNCHES},
placed AS (SELECT *, row_number() OVER (PARTITION BY plant ORDER BY ts) AS rn FROM wide),
win AS (SELECT l.plant, l.cutoff, count(p.rn) AS n_rows,
               count(CASE WHEN p.rn IS NOT NULL AND (p.discharge_view IS NULL OR p.discharge_click IS NULL) THEN 1 END) AS gaps
        FROM launches l LEFT JOIN placed c ON c.plant = l.plant AND c.ts = l.cutoff
        LEFT JOIN placed p ON p.plant = l.plant AND p.rn BETWEEN c.rn - 23 AND c.rn GROUP BY 1, 2)
SELECT plant, {_time('cutoff')} AS cutoff, n_rows,
       CASE WHEN n_rows = 0 THEN 'no_cutoff' WHEN n_rows < 24 THEN 'short_history'
            WHEN gaps > 0 THEN 'missing_values' ELSE 'ok' END AS status
FROM win""",
    "asof_history": f"""WITH {PLANTS}
SELECT plant, event_id, {_time('ts')} AS ts, power FROM plants WHERE ts::DATE <= DATE '2024-01-15'""",
    "next_day_rows": f"""WITH {PLANTS}
SELECT plant, event_id, {_time('ts')} AS ts, power FROM plants WHERE ts::DATE = DATE '2024-01-16'""",
    "valid_cutoffs": f"""WITH {PLANTS}, days AS (SELECT DISTINCT plant, ts::DATE AS day FROM plants)
SELECT plant, {_day('day')} AS day FROM days d
WHERE day < (SELECT max(day) FROM days x WHERE x.plant = d.plant)""",
    "default_cutoff": f"""WITH {PLANTS}, days AS (SELECT DISTINCT plant, ts::DATE AS day FROM plants),
ranked AS (SELECT *, row_number() OVER (PARTITION BY plant ORDER BY day DESC) AS r FROM days)
SELECT plant, {_day('day')} AS day FROM ranked WHERE r = 2""",
    "cutoff_lookup": f"""WITH {WIDE}, {COMPLETE}, {LAUNCHES}
SELECT l.plant, {_time('l.cutoff')} AS cutoff, CASE WHEN c.ts IS NULL THEN 'false' ELSE 'true' END AS found,
       round(c.power, 6) AS power
FROM launches l LEFT JOIN complete c ON c.plant = l.plant AND c.ts = l.cutoff""",
    "cutoff_lookup_null_keys": f"""WITH {WIDE}, {COMPLETE}, {LAUNCHES}
SELECT nullif(l.plant, 1) AS plant, {_time('l.cutoff')} AS cutoff, CASE WHEN c.ts IS NULL THEN 'false' ELSE 'true' END AS found,
       round(c.power, 6) AS power
FROM launches l LEFT JOIN complete c ON c.plant = l.plant AND c.ts = l.cutoff""",
    "forecast_training_rows_null_keys": f"""WITH {WIDE}, {COMPLETE}, {LAUNCHES}, {_FEATURES}
SELECT nullif(f.plant, 1) AS plant, {_time('f.ts')} AS cutoff, i AS step, round(t.power, 6) AS label
FROM features f JOIN launches l ON f.plant = l.plant AND f.ts = l.cutoff
CROSS JOIN generate_series(1, 24) g(i)
JOIN complete t ON t.plant = f.plant AND t.ts = f.ts + i * INTERVAL 1 HOUR
WHERE f.rn >= 24""",
    "forecast_index": f"""WITH {WIDE}, {LAUNCHES}
SELECT plant, {_time('cutoff')} AS cutoff, i AS step, {_time('cutoff + i * INTERVAL 15 MINUTE')} AS ts
FROM launches, generate_series(1, 96) g(i)""",
    "forecast_training_rows": f"""WITH {WIDE}, {COMPLETE}, {LAUNCHES}, {_FEATURES}
SELECT f.plant, {_time('f.ts')} AS cutoff, i AS step, CAST(72 AS BIGINT) AS n_values, round(t.power, 6) AS label
FROM features f JOIN launches l ON f.plant = l.plant AND f.ts = l.cutoff
CROSS JOIN generate_series(1, 24) g(i)
JOIN complete t ON t.plant = f.plant AND t.ts = f.ts + i * INTERVAL 1 HOUR
WHERE f.rn >= 24""",
    # Catalogue
    "station_list": f"""WITH {THINGS} SELECT iot_id, name, description, station_id,
       row_number() OVER (ORDER BY name, iot_id) - 1 AS place FROM things""",
    "station_caps": f"""WITH {THINGS}, {LOCATIONS}, calls AS (
  SELECT 'list' AS call, 50 AS most, row_number() OVER (ORDER BY name, iot_id) - 1 AS place, iot_id, name FROM things
  UNION ALL
  SELECT 'search', 20, row_number() OVER (ORDER BY iot_id) - 1, iot_id, name FROM things WHERE contains(name, 'Supplier#0000000')
  UNION ALL
  SELECT 'box', 10, row_number() OVER (ORDER BY name, iot_id) - 1, iot_id, name FROM things
  WHERE iot_id IN (SELECT thing_id FROM locations WHERE lon > 10.0 AND lon < 12.0 AND lat > 50.5 AND lat < 51.5))
SELECT call, place, iot_id, name FROM calls WHERE place < most""",
    "station_search_ci": f"""WITH {THINGS} SELECT iot_id, name, description, station_id FROM things
WHERE contains(lower(name), 'supplier#00000001') ORDER BY iot_id LIMIT 1""",
    "station_search_cs": f"""WITH {THINGS} SELECT iot_id, name, description, station_id FROM things
WHERE contains(name, 'Supplier#00000001')""",
    "resolve_stations": f"""WITH {THINGS}, requested AS (SELECT upper(substr(c_name, 7)) AS text FROM customer)
{RESOLVE}""",
    "resolve_partial_names": f"""WITH {THINGS}, requested AS (SELECT DISTINCT substr(c_name, 10, 8) AS text FROM customer)
{RESOLVE}""",
    "station_datastreams": f"""WITH {THINGS}, {DATASTREAMS}
SELECT thing_id, name AS station, datastream_id, datastream, unit, COALESCE(type, '') AS type,
       'no data' AS phenomenon_time FROM ds JOIN things ON ds.thing_id = things.iot_id""",
    "datastream_match": f"""WITH {DATASTREAMS}
SELECT thing_id, min(datastream_id) AS datastream_id, arg_min(datastream, datastream_id) AS datastream,
       arg_min(unit, datastream_id) AS unit
FROM ds WHERE starts_with(datastream, 'view@') AND type = 'TH_PEGELDATEN_15MIN' GROUP BY 1""",
    "datastreams_by_type": f"""WITH {DATASTREAMS}
SELECT *, row_number() OVER (ORDER BY n DESC, type) - 1 AS place
FROM (SELECT COALESCE(type, 'unknown') AS type, count(*) AS n FROM ds GROUP BY 1)""",
    "datastreams_by_parameter": f"""WITH {DATASTREAMS}
SELECT *, row_number() OVER (ORDER BY n DESC, parameter) - 1 AS place
FROM (SELECT parameter, count(*) AS n FROM ds GROUP BY 1)""",
    "station_frequencies": f"""WITH {DATASTREAMS}
SELECT thing_id, COALESCE(type, 'unknown') AS freq_type, datastream_id, datastream, unit,
       'no data' AS phenomenon_time,
       row_number() OVER (ORDER BY thing_id, COALESCE(type, 'unknown'), datastream_id) - 1 AS place FROM ds""",
    "station_location": f"""WITH {LOCATIONS}
SELECT thing_id, name, round(lon, 6) AS lon, round(lat, 6) AS lat, 'true' AS is_point FROM locations""",
    "stations_in_bbox": f"""WITH {THINGS}, {LOCATIONS}
SELECT iot_id, name, description, station_id, row_number() OVER (ORDER BY name, iot_id) - 1 AS place
FROM things WHERE iot_id IN (
  SELECT thing_id FROM locations WHERE lon > 10.25 AND lon < 11.95 AND lat > 50.45 AND lat < 51.35)""",
    "stations_in_regions": f"""WITH {THINGS}, {LOCATIONS}, nations AS (
  SELECT DISTINCT s_nationkey AS k, 9.87::DOUBLE + (s_nationkey % 10) * 0.21::DOUBLE AS x, 50.27::DOUBLE + (s_nationkey % 5) * 0.23::DOUBLE AS y FROM supplier)
SELECT DISTINCT region_id, iot_id, things.name FROM (
  SELECT 'box ' || k AS region_id, thing_id FROM nations, locations WHERE lon > x AND lon < x + 0.55 AND lat > y AND lat < y + 0.41
  UNION ALL
  SELECT 'diamond ' || k, thing_id FROM nations, locations WHERE abs(lon - x) / 0.37 + abs(lat - y) / 0.29 < 1) r
JOIN things ON iot_id = thing_id""",
    "correlation_matrix": f"""WITH {WIDE}, long AS (
  SELECT plant, ts, unnest(['discharge_view', 'discharge_click', 'power', 'constant']) AS name, unnest([1, 2, 3, 4]) AS i,
    unnest([discharge_view, discharge_click, power, 7.0]) AS v FROM wide),
pairs AS (SELECT a.plant, a.name AS a, b.name AS b, a.v AS x, b.v AS y FROM long a JOIN long b ON a.plant = b.plant AND a.ts = b.ts AND a.i < b.i)
SELECT plant, a, b, count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) AS n,
  CASE WHEN b <> 'constant' THEN round(corr(x, y) FILTER (x IS NOT NULL AND y IS NOT NULL), 6) END AS corr FROM pairs GROUP BY 1, 2, 3""",
    "trailing_mean_year": f"""WITH {PLANTS}
SELECT nullif(p, 9) AS plant, event_id, round(avg(power) OVER (PARTITION BY p ORDER BY ts, event_id ROWS 35039 PRECEDING), 6) AS year_mean
FROM (SELECT *, CASE WHEN event_id % 5 <> 0 THEN plant ELSE 9 END AS p FROM plants)""",
    "trailing_mean_long": f"""WITH {PLANTS}
SELECT plant, event_id, round(avg(power) OVER (PARTITION BY plant ORDER BY ts, event_id ROWS 95 PRECEDING), 6) AS day_mean FROM plants""",
    "dedupe_last_by_name": """SELECT p_name AS name, p_brand AS description,
       CASE WHEN p_size > 25 THEN p_type END AS station_id, CAST(p_size AS VARCHAR) AS size
FROM part QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey DESC) = 1""",
    # Observations
    "observation_window": f"""WITH {OBS}, {WINDOW}
SELECT datastream_id, obs_id, {_time('ts')} AS ts, result FROM obs_window""",
    "observations_with_unit": f"""WITH {OBS}, {DATASTREAMS}
SELECT obs.datastream_id, obs_id, datastream, unit, result FROM obs JOIN ds ON obs.datastream_id = ds.datastream_id""",
    "series_inspect": f"""WITH {OBS}, {DATASTREAMS}
SELECT ds.datastream_id, ds.datastream, ds.unit, COALESCE(ds.type, '') AS type, ds.parameter,
       'unknown' AS phenomenon_time, count(*) AS n_obs, {_time('min(ts)')} AS first_ts, {_time('max(ts)')} AS last_ts
FROM ds JOIN obs ON obs.datastream_id = ds.datastream_id GROUP BY ALL""",
    "series_samples": f"""WITH {OBS}, {DATASTREAMS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY datastream_id ORDER BY ts, obs_id) AS f,
                  row_number() OVER (PARTITION BY datastream_id ORDER BY ts DESC, obs_id DESC) AS l FROM obs),
edges AS (SELECT datastream_id, 'first' AS edge, f AS rank, ts, result FROM ranked WHERE f <= 5
          UNION ALL SELECT datastream_id, 'last', l, ts, result FROM ranked WHERE l <= 5)
SELECT e.datastream_id, edge, rank, {_time('ts')} AS ts, result, unit
FROM edges e JOIN ds ON e.datastream_id = ds.datastream_id""",
    "latest_observation": f"""WITH {OBS}, {DATASTREAMS},
newest AS (SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY datastream_id ORDER BY ts DESC, obs_id DESC) = 1)
SELECT n.datastream_id, datastream, unit, {_time('ts')} AS ts, result
FROM newest n JOIN ds ON n.datastream_id = ds.datastream_id""",
    "threshold_above": _exceed("> 20"),
    "threshold_below": _exceed("< 5"),
    "load_status": f"{LOAD} SELECT status, count(*) AS n FROM status GROUP BY 1",
    "missing_stations": f"{LOAD} SELECT text, status FROM status WHERE status <> 'loaded'",
    # Files
    "series_store": f"{LOAD} SELECT param, station_id, station, freq, unit, {_time('ts')} AS ts, result FROM store",
    "series_store_counts": f"{LOAD} SELECT count(DISTINCT station) AS n_series, count(*) AS n_rows, 'true' AS few_files FROM store",
    "store_ranges": f"""{LOAD} SELECT param, station_id, freq, count(*) AS n_rows, {_time('min(ts)')} AS first_ts, {_time('max(ts)')} AS last_ts
FROM store GROUP BY 1, 2, 3""",
    "store_versions": f"""{LOAD} SELECT param, station_id, freq, {_time('ts')} AS ts, round(result, 6) AS result FROM (
  SELECT *, 0.0::DOUBLE AS r FROM store WHERE station_id % 7 = 0 UNION ALL
  SELECT *, -result FROM store WHERE station_id % 7 <> 0 AND station_id % 5 = 0 AND result > 10 UNION ALL
  SELECT *, result + 100 FROM store WHERE station_id % 7 <> 0 AND station_id % 3 = 0
    AND NOT (station_id % 5 = 0 AND station_id IN (SELECT station_id FROM store WHERE result > 10)) UNION ALL
  SELECT *, result FROM store WHERE station_id % 7 <> 0 AND station_id % 3 <> 0
    AND NOT (station_id % 5 = 0 AND station_id IN (SELECT station_id FROM store WHERE result > 10))) x(
    param, station_id, station, freq, unit, ts, old, result)""",
    "bulk_requests": f"""{REQUESTS}
SELECT request_id, param, thing_id AS station_id, station, freq, unit, {_time('ts')} AS ts, result FROM held""",
    "request_status": f"""{REQUESTS}
SELECT request_id, status, n_obs FROM outcome""",
    "page_roundtrip": f"WITH {OBS} SELECT datastream_id, {_time('ts')} AS ts, result FROM obs",
    "page_completeness": f"""WITH {OBS} SELECT datastream_id, count(*) AS fetched, count(*) AS announced,
       CAST(ceil(count(*) / 5.0) AS BIGINT) AS n_pages FROM obs GROUP BY 1""",
    "page_chain": f"""WITH {OBS}, n AS (SELECT datastream_id, count(*) AS rows, ceil(count(*) / 5.0)::BIGINT AS pages FROM obs GROUP BY 1),
kept AS (SELECT *, pages - (CASE WHEN datastream_id % 3 = 0 AND pages > 1 THEN 1 ELSE 0 END) - (CASE WHEN datastream_id % 7 = 0 THEN 1 ELSE 0 END) AS landed,
  datastream_id % 7 = 0 AS headless, datastream_id % 3 = 0 AND pages > 1 AS cut FROM n)
SELECT datastream_id, CASE WHEN headless THEN 'no_first' WHEN cut THEN 'broken' ELSE 'complete' END AS status,
  CASE WHEN headless THEN 0 WHEN cut THEN 1 ELSE pages END AS n_pages,
  (CASE WHEN headless THEN 0 WHEN cut THEN 5 ELSE rows END)::BIGINT AS n_rows,
  CASE WHEN cut AND NOT headless THEN 'page=1' END AS missing,
  landed - CASE WHEN headless THEN 0 WHEN cut THEN 1 ELSE pages END AS n_orphans
FROM kept WHERE landed > 0""",
    "thing_pages": f"""WITH {THINGS} SELECT iot_id, name, description, NULLIF(station_id, '') AS station_id FROM things""",
    "datastream_pages": f"""WITH {DATASTREAMS}
SELECT datastream_id AS iot_id, thing_id, datastream AS name, NULLIF(unit, '') AS unit, type, parameter,
       CAST(thing_id AS VARCHAR) AS station_id, CAST(NULL AS VARCHAR) AS phenomenon_time FROM ds""",
    "location_pages": f"""WITH {LOCATIONS}
SELECT thing_id, name, round(lon, 6) AS lon, round(lat, 6) AS lat FROM locations""",
    "page_stream": f"WITH {OBS} SELECT datastream_id, {_time('ts')} AS ts, result FROM obs",
    "plant_table_csv": f"""WITH {WIDE}, {COMPLETE}
SELECT plant, {_time('ts')} AS "time", round(power, 6) AS power, round(discharge_view, 6) AS discharge_view,
       round(discharge_click, 6) AS discharge_click FROM complete""",
    "observation_csv": f"""SELECT {_time('ts')} AS "phenomenonTime", value AS q FROM events""",
    "plant_export_clean": f"""SELECT {_time('o_orderdate')} AS "Datum_von", {_time('o_orderdate')} AS "Datum_bis",
       round(o_totalprice * 100) AS el, CASE WHEN o_orderstatus = 'F' THEN round(o_totalprice * 100) END AS el1 FROM orders""",
    "export_names": f"""WITH {THINGS}, {DATASTREAMS}
SELECT datastream_id, 'Q_' || replace(replace(name || ' / ' || datastream, '/', '-'), ' ', '_') || '_1D' AS file_name,
       'Q_' || unit AS value_name, '2024-01-05T00:00:00Z' AS starts
FROM ds JOIN things ON ds.thing_id = things.iot_id""",
    "export_summary": f"""WITH {OBS}, {WINDOW}
SELECT datastream_id, count(*) AS n_rows, 'phenomenonTime,result' AS header,
       arg_min({_LINE}, ts) AS first_line, CASE WHEN count(*) > 1 THEN arg_max({_LINE}, ts) END AS last_line
FROM obs_window GROUP BY 1""",
    "window_files": f"""WITH {OBS}, {WINDOW}
SELECT datastream_id, row_number() OVER (PARTITION BY datastream_id ORDER BY ts, result) - 1 AS place, {_LINE} AS line
FROM obs_window""",
    "date_labels": """SELECT event_id, strftime(ts, '%A, %d %b %Y') AS day_label,
       strftime(ts, '%Y-%m-%d %H:%M') AS minute_label FROM events""",
    "clip_nonnegative": """SELECT event_id, round(greatest(value - 20, 0), 6) AS clipped FROM events""",
    # Models: what does not depend on the trees, and runs that are determined
    "run_actuals": f"""WITH {WIDE}, {COMPLETE}, cut AS (SELECT DISTINCT plant, DATE '2024-01-15' AS day FROM complete),
{_ACTUALS}
SELECT plant, {_time('ts')} AS ts, series, round(value, 6) AS value FROM frame""",
    "run_frame": f"""WITH {WIDE}, {COMPLETE}, {_CUT}, {_ACTUALS}
SELECT plant, {_time('ts')} AS ts, series, round(value, 6) AS value, CAST(NULL AS VARCHAR) AS learned FROM frame
UNION ALL
SELECT plant, {_time('ts')}, 'prediction', NULL, 'true' FROM frame WHERE series = 'next_day_actual'""",
    "run_peak": f"""WITH {WIDE}, {COMPLETE}, {_CUT}, {_ACTUALS}
SELECT c.plant, {_time('min(f.ts)')} AS starts_at, round(max(f.value), 6) AS actual,
       CASE WHEN count(f.ts) > 0 THEN 'true' END AS bounded
FROM cut c LEFT JOIN frame f ON f.plant = c.plant AND series = 'next_day_actual' GROUP BY 1""",
    "feature_importance_top10": f"""WITH {WIDE}, {COMPLETE}
SELECT DISTINCT plant, feature, CAST(1 AS DOUBLE) AS total, 'true' AS share
FROM complete, (VALUES ('discharge_view'), ('discharge_click')) f(feature)""",
    "backtest": f"""WITH {WIDE}, {COMPLETE}, days AS (SELECT DISTINCT plant, ts::DATE AS day FROM complete),
valid AS (SELECT * FROM days d WHERE day < (SELECT max(day) FROM days x WHERE x.plant = d.plant))
SELECT v.plant, {_day('v.day')} AS cutoff, {_time('c.ts')} AS ts, round(c.power, 6) AS actual, 'true' AS learned
FROM valid v JOIN complete c ON c.plant = v.plant AND c.ts::DATE = v.day + 1""",
    "run_frame_exact": f"""WITH {PLANTS}, complete AS (SELECT * FROM plants),
cut AS (SELECT DISTINCT plant, DATE '2024-01-15' AS day FROM complete), {_ACTUALS}, {_HOUR_MEANS}
SELECT plant, {_time('ts')} AS ts, series, round(value, 6) AS value FROM frame
UNION ALL
SELECT f.plant, {_time('f.ts')}, 'prediction', round(h.mean, 6)
FROM frame f JOIN hours h ON h.plant = f.plant AND h.hour = hour(f.ts) WHERE series = 'next_day_actual'""",
    "run_peak_exact": f"""WITH {PLANTS}, complete AS (SELECT * FROM plants),
cut AS (SELECT DISTINCT plant, DATE '2024-01-15' AS day FROM complete), {_ACTUALS}, {_HOUR_MEANS}
SELECT f.plant, {_time('min(f.ts)')} AS starts_at, round(greatest(max(f.value), max(h.mean)), 6) AS peak
FROM frame f JOIN hours h ON h.plant = f.plant AND h.hour = hour(f.ts) WHERE series = 'next_day_actual' GROUP BY 1""",
    "importance_exact": f"""WITH {PLANTS}
SELECT DISTINCT plant, feature, importance
FROM plants, (VALUES ('hour', CAST(1 AS DOUBLE)), ('constant', CAST(0 AS DOUBLE))) f(feature, importance)""",
    "importance_order": f"""WITH {PLANTS}, ranked AS (
  SELECT 'constant_' || lpad(CAST(i AS VARCHAR), 2, '0') AS feature, CAST(0 AS DOUBLE) AS importance FROM range(11) t(i)
  UNION ALL SELECT 'hour', CAST(1 AS DOUBLE)),
strongest AS (SELECT * FROM ranked ORDER BY importance DESC, feature LIMIT 10),
shown AS (SELECT *, row_number() OVER (ORDER BY importance, feature DESC) - 1 AS place FROM strongest)
SELECT DISTINCT plant, place, feature, importance FROM plants, shown""",
    "multistep_forecast": f"""WITH {WIDE}, {COMPLETE}, starts AS (
  SELECT DISTINCT plant, date_trunc('day', ts) + INTERVAL 10 HOUR AS cutoff FROM complete)
SELECT c.plant, {_time('c.ts')} AS cutoff, i AS step, {_time('c.ts + i * INTERVAL 1 HOUR')} AS ts, 'true' AS learned, 'true' AS shown
FROM complete c JOIN starts s ON s.plant = c.plant AND s.cutoff = c.ts CROSS JOIN generate_series(1, 24) g(i)
WHERE c.rn >= 24 AND c.ts >= TIMESTAMP '2024-01-15 00:00:00'""",
    "keyed_runs": f"""WITH {PLANTS}, rows AS (SELECT *, CAST(ts AS DATE) AS day, hour(ts) AS hour FROM plants),
days AS (SELECT DISTINCT plant, day FROM rows), runs AS (
  SELECT plant, day AS cutoff FROM (SELECT *, max(day) OVER (PARTITION BY plant) AS last FROM days) WHERE day < last),
hours AS (
  SELECT u.plant, u.cutoff, r.hour, avg(r.power) AS mean FROM runs u JOIN rows r ON r.plant = u.plant AND r.day <= u.cutoff GROUP BY ALL),
least AS (SELECT plant, cutoff, min(hour) AS first, max(hour) AS last FROM hours GROUP BY ALL),
following AS (SELECT u.cutoff, r.* FROM runs u JOIN rows r ON r.plant = u.plant AND r.day = u.cutoff + 1),
today AS (SELECT *, avg(power) OVER (PARTITION BY plant, day ORDER BY ts, event_id ROWS 15 PRECEDING) AS trend FROM rows)
SELECT nullif(plant, 1) AS plant, {_day('cutoff')} AS cutoff, {_time('ts')} AS ts, series, round(value, 6) AS value FROM (
  SELECT u.plant, u.cutoff, t.ts, 'actual' AS series, t.power AS value FROM runs u JOIN today t ON t.plant = u.plant AND t.day = u.cutoff
  UNION ALL SELECT u.plant, u.cutoff, t.ts, 'trend', t.trend FROM runs u JOIN today t ON t.plant = u.plant AND t.day = u.cutoff
  UNION ALL SELECT plant, cutoff, ts, 'next_day_actual', power FROM following
  UNION ALL SELECT f.plant, f.cutoff, f.ts, 'prediction', h.mean FROM following f JOIN hours h
    ON h.plant = f.plant AND h.cutoff = f.cutoff AND h.hour = f.hour)""",
    "vector_forecast": f"""WITH {WIDE}, {COMPLETE}, starts AS (
  SELECT c.plant, c.ts AS cutoff FROM complete c WHERE hour(c.ts) = 10 AND c.rn >= 3),
means AS (
  SELECT s.plant, i AS step, avg(t.power) AS mean FROM starts s CROSS JOIN generate_series(1, 24) g(i)
  JOIN complete t ON t.plant = s.plant AND t.ts = s.cutoff + i * INTERVAL 1 HOUR
  WHERE t.ts <= TIMESTAMP '2024-01-15 00:00:00' GROUP BY ALL)
SELECT s.plant, {_time('s.cutoff')} AS cutoff, i AS step, {_time('s.cutoff + i * INTERVAL 1 HOUR')} AS ts, round(m.mean, 6) AS power_pred
FROM starts s CROSS JOIN generate_series(1, 24) g(i) LEFT JOIN means m ON m.plant = s.plant AND m.step = i
WHERE s.cutoff >= TIMESTAMP '2024-01-15 00:00:00'""",
    "multistep_training_rows": f"""WITH {WIDE}, {COMPLETE}, starts AS (
  SELECT DISTINCT plant, date_trunc('day', ts) + INTERVAL 10 HOUR AS cutoff FROM complete)
SELECT c.plant, {_time('c.ts')} AS cutoff, i AS step, {_time('t.ts')} AS ts, round(t.power, 6) AS label
FROM complete c JOIN starts s ON s.plant = c.plant AND s.cutoff = c.ts CROSS JOIN generate_series(1, 24) g(i)
JOIN complete t ON t.plant = c.plant AND t.ts = c.ts + i * INTERVAL 1 HOUR
WHERE c.rn >= 24 AND t.ts <= TIMESTAMP '2024-01-15 00:00:00'""",
    "predict_for_date": f"""WITH {WIDE}, {COMPLETE}, launch AS (
  SELECT min(ts) AS launched FROM complete WHERE plant = 0 AND rn >= 24 AND hour(ts) = 10 AND ts > TIMESTAMP '2024-01-15 00:00:00')
SELECT {_time('launched + i * INTERVAL 1 HOUR')} AS ts, 'true' AS learned FROM launch, generate_series(1, 24) g(i)""",
    "plant_targets": f"""WITH {PLANTS}
SELECT event_id, CASE plant WHEN 0 THEN 'power_burgau' ELSE 'power_rudolstadt' END AS target, round(power, 6) AS power FROM plants""",
}

"""DuckDB SQL for every registered query, over the driver's views ``lineitem`` and ``events``."""

from __future__ import annotations

# Driver tables to typed observations of each feed (FIXTURES.md).
_READINGS = """
       CASE WHEN k % 97 <> 0 THEN (k * 7 % 121) / 10e0 END AS uvi,
       CASE WHEN k % 89 <> 0 THEN (k * 13 % 500) / 10e0 - 10e0 END AS temp,
       CAST(CASE WHEN k % 83 <> 0 THEN 980 + k * 17 % 60 END AS INTEGER) AS pressure,
       CAST(k % 101 AS INTEGER) AS humidity,
       (k * 11 % 250) / 10e0 AS wind_speed"""

_FEEDS = f"""
history_keys AS (
  SELECT CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS k,
         CAST(floor(epoch(l_shipdate)) AS BIGINT) AS ep
  FROM lineitem),
feed_keys AS (
  SELECT event_id AS k, CAST(floor(epoch(ts)) AS BIGINT) AS ep FROM events),
history AS (
  SELECT ep + (k % 24) * 3600 AS dt,
         round(CASE k % 3 WHEN 0 THEN -41.810145e0 WHEN 1 THEN 11.538415e0 ELSE 0e0 END, 4) AS lat,
         round(CASE k % 3 WHEN 0 THEN -68.9063e0 WHEN 1 THEN -72.91679e0 ELSE 0e0 END, 4) AS lon,
         {_READINGS}
  FROM history_keys),
feed AS (
  SELECT CASE WHEN k % 211 <> 0 THEN ep END AS dt,
         CASE WHEN k % 101 = 0 THEN NULL WHEN k % 17 = 0 THEN -41.81012e0
              WHEN k % 3 = 0 THEN -41.8101e0 WHEN k % 3 = 1 THEN 11.5384e0 ELSE 0e0 END AS lat,
         CASE k % 3 WHEN 0 THEN -68.9063e0 WHEN 1 THEN -72.9168e0 ELSE 0e0 END AS lon,
         {_READINGS}
  FROM feed_keys)"""


def _region(rows: str) -> str:
    return f"""
  SELECT *,
         CASE WHEN lat = -41.8101e0 AND lon = -68.9063e0 THEN 'Patagonia'
              WHEN lat = 11.5384e0 AND lon = -72.9168e0 THEN 'Riohacha'
              ELSE 'No Region' END AS region,
         strftime(make_timestamp(dt * 1000000), '%Y-%m-%d %H:%M:%S') AS "timestamp",
         CAST(year(make_timestamp(dt * 1000000)) AS INTEGER) AS year,
         CAST(month(make_timestamp(dt * 1000000)) AS INTEGER) AS month,
         CAST(day(make_timestamp(dt * 1000000)) AS INTEGER) AS day
  FROM ({rows})"""


_SILVER = f"""{_FEEDS},
both_feeds AS (SELECT * FROM history UNION ALL BY NAME SELECT * FROM feed),
silver AS ({_region("SELECT * FROM both_feeds")})"""

_LOSS = "CASE WHEN temp > 25e0 THEN (temp - 25e0) * 0.004e0 ELSE 0e0 END"
_DENSITY = "(pressure * 100e0) / (287.05e0 * (temp + 273.15e0))"


def _power(rows: str) -> str:
    return f"""
  SELECT *, potencia_solar_w + potencial_eolico_w AS potencial_renovable_total_w
  FROM (SELECT *,
               uvi * 100e0 * 0.18e0 * (1e0 - {_LOSS}) * 0.75e0 AS potencia_solar_w,
               {_DENSITY} * 0.5e0 * (wind_speed * wind_speed * wind_speed) * 0.4e0
                 AS potencial_eolico_w
        FROM ({rows}))"""


_GOLD = f"""{_SILVER},
gold AS ({_power("SELECT * FROM silver")})"""

_DAILY = f"""{_GOLD},
daily AS (
  SELECT region, year, month, day, count(*) AS observations,
         avg(potencia_solar_w) AS solar, avg(potencial_eolico_w) AS wind,
         avg(potencial_renovable_total_w) AS total,
         max(potencia_solar_w) AS solar_max,
         min(potencial_eolico_w) AS wind_min, max(potencial_eolico_w) AS wind_max,
         avg(temp) AS temp, avg(pressure) AS pressure, avg(humidity) AS humidity,
         avg(wind_speed) AS speed, avg(uvi) AS uvi,
         sum(potencia_solar_w) AS solar_sum, count(potencia_solar_w) AS solar_n,
         sum(potencial_eolico_w) AS wind_sum, count(potencial_eolico_w) AS wind_n
  FROM gold GROUP BY ALL)"""


def _settle(value: str, digits: int, guard: int) -> str:
    """Round away summation noise in decimal arithmetic, then round half up."""
    decimal = f"CAST({value} AS DECIMAL(24, {digits + guard}))"
    return f"CAST(round({decimal}, {digits}) AS DOUBLE)"


def _cents(value: str) -> str:
    return _settle(value, 2, 6)


def _micros(value: str) -> str:
    return _settle(value, 6, 3)


def _mean8(value: str) -> str:
    return f"CAST(CAST({value} AS DECIMAL(24, 8)) AS DOUBLE)"


def _of(region: str, aggregate: str) -> str:
    return f"{aggregate} FILTER (WHERE region = '{region}')"


def _spread(highest: str, lowest: str) -> str:
    return _cents(f"({_cents(highest)} - {_cents(lowest)})")


_OBSERVATION = "dt, lat, lon, uvi, temp, pressure, humidity, wind_speed"
_SILVER_COLUMNS = f'{_OBSERVATION}, "timestamp", day, region, year, month'
_POWERS = ", ".join(
    f"{_micros(c)} AS {c}"
    for c in ("potencia_solar_w", "potencial_eolico_w", "potencial_renovable_total_w")
)
_TABLE_COLUMNS = f"{_OBSERVATION}, day, region, year, month, {_POWERS}"
_GOLD_COLUMNS = f"{_SILVER_COLUMNS}, {_POWERS}"


def _extreme(region: str, direction: str) -> str:
    return f"""WITH {_DAILY}
SELECT region, year, month, day, {_cents("total")} AS avg_pot_energy_daily
FROM daily WHERE region = '{region}'
ORDER BY avg_pot_energy_daily {direction} NULLS LAST,
         year NULLS LAST, month NULLS LAST, day NULLS LAST
LIMIT 10"""


def _monthly(measure: str, suffix: str) -> str:
    columns = ", ".join(
        _spread(_of(region, f"max({measure})"), _of(region, f"min({measure})"))
        + f" AS {short}_{suffix}"
        for region, short in (("Patagonia", "pat"), ("Riohacha", "rio"))
    )
    return f"""WITH {_DAILY}
SELECT year, month, {columns} FROM daily GROUP BY year, month
ORDER BY year DESC NULLS LAST, month DESC NULLS LAST"""


def _partition_counts(rows: str) -> str:
    return f"""WITH {_SILVER}
SELECT region, year, month, count(*) AS observations
FROM ({rows}) GROUP BY region, year, month"""


_RANK_ORDER = "NULLS LAST, year, month, day"

_DATED = f"""{_DAILY},
dated AS (
  SELECT region, make_date(year, month, day) AS d, {_mean8("total")} AS total
  FROM daily WHERE region <> 'No Region' AND year IS NOT NULL),
pairs AS (
  SELECT a.region, a.total, b.total AS prior
  FROM dated a JOIN dated b ON a.region = b.region AND a.d = b.d + 1)"""

_WEATHER = ("temp", "pressure", "humidity", "speed", "uvi")

_LOW_POWER = f"""WITH {_DAILY},
means AS (
  SELECT region, {_mean8("total")} AS total, {", ".join(f"{_mean8(w)} AS {w}" for w in _WEATHER)}
  FROM daily WHERE region <> 'No Region' AND total IS NOT NULL),
per_region AS (
  SELECT region, quantile_cont(total, 0.1) AS threshold,
         {", ".join(f"corr({w}, total) AS corr_{w}" for w in _WEATHER)}
  FROM means GROUP BY region)
SELECT region, total < threshold AS low_power, count(*) AS days,
       {", ".join(f"{_micros(f'avg({c})')} AS mean_{c}" for c in ("total", *_WEATHER))},
       {", ".join(f"{_micros(f'max(corr_{w})')} AS corr_{w}" for w in _WEATHER)}
FROM means JOIN per_region USING (region)
GROUP BY region, total < threshold"""


def _rejects(table: str, feed: str, malformed: dict[str, str] | None = None, corrupt: str = "false") -> str:
    """Counts per field; ``malformed`` and ``corrupt`` are conditions on the rows, none by default."""
    bad = malformed or {}
    lines = [f"SELECT '{feed}' AS feed, 'record' AS field, 'corrupt' AS reason, count(*) FILTER (WHERE {corrupt}) AS rows FROM {table}"]
    for f in _OBSERVATION.split(", "):
        wrong = f"NOT ({corrupt}) AND ({bad.get(f, 'false')})"
        lines.append(
            f"SELECT '{feed}', '{f}', 'missing', count(*) FILTER (WHERE NOT ({corrupt}) AND {f} IS NULL "
            f"AND NOT ({wrong})) FROM {table}"
        )
        lines.append(f"SELECT '{feed}', '{f}', 'malformed', count(*) FILTER (WHERE {wrong}) FROM {table}")
    lines.append(
        f"SELECT '{feed}', 'region', 'unknown', count(*) FILTER (WHERE NOT ({corrupt}) AND region = 'No Region') "
        f"FROM ({_region(f'SELECT * FROM {table}')})"
    )
    return "\nUNION ALL ".join(lines)


# What ``fixtures.dirty_history_lines`` does to the historical feed.
_DIRTY = f"""{_FEEDS},
dirty AS (
  SELECT k,
         CASE WHEN k % 29 <> 0 AND k % 19 <> 0 THEN ep + (k % 24) * 3600 END AS dt,
         CASE WHEN k % 29 <> 0 THEN
           round(CASE k % 3 WHEN 0 THEN -41.810145e0 WHEN 1 THEN 11.538415e0 ELSE 0e0 END, 4) END AS lat,
         CASE WHEN k % 29 <> 0 THEN
           round(CASE k % 3 WHEN 0 THEN -68.9063e0 WHEN 1 THEN -72.91679e0 ELSE 0e0 END, 4) END AS lon,
         CASE WHEN k % 29 <> 0 THEN uvi END AS uvi,
         CASE WHEN k % 29 <> 0 AND k % 11 <> 0 THEN temp END AS temp,
         CASE WHEN k % 29 = 0 THEN NULL WHEN k % 13 = 0 THEN 1010 WHEN k % 17 <> 0 THEN pressure END AS pressure,
         CASE WHEN k % 29 <> 0 THEN humidity END AS humidity,
         CASE WHEN k % 29 <> 0 THEN wind_speed END AS wind_speed
  FROM (SELECT k, ep, {_READINGS} FROM history_keys))"""

_DIRTY_FIELDS = {"dt": "k % 19 = 0", "temp": "k % 11 = 0", "pressure": "k % 17 = 0 AND k % 13 <> 0"}

# The feed of ``fixtures.unsteady_feed`` without its repeats, which are equal rows.
_UNSTEADY = f"""{_FEEDS},
unsteady AS (
  SELECT CASE WHEN k % 211 = 0 THEN NULL WHEN k % 37 = 0 THEN ep * 1000 ELSE ep END AS dt,
         CASE WHEN k % 101 = 0 THEN NULL WHEN k % 17 = 0 THEN -41.81012e0
              WHEN k % 3 = 0 THEN -41.8101e0 WHEN k % 3 = 1 THEN 11.5384e0 ELSE 0e0 END AS lat,
         CASE k % 3 WHEN 0 THEN -68.9063e0 WHEN 1 THEN -72.9168e0 ELSE 0e0 END AS lon, {_READINGS}
  FROM (SELECT * FROM feed_keys UNION ALL SELECT * FROM feed_keys WHERE k % 5 = 0)),
ranked AS (
  SELECT *, row_number() OVER (
           PARTITION BY dt, lat, lon
           ORDER BY uvi NULLS LAST, temp NULLS LAST, pressure NULLS LAST,
                    humidity NULLS LAST, wind_speed NULLS LAST) AS copy
  FROM unsteady)"""

# The feed in four deliveries of eight days each, some readings one delivery late, some times in milliseconds.
_DELIVERED = f"""{_FEEDS},
deliveries AS (
  SELECT k, ep, least(CAST(floor((ep - 1704067200) / 86400e0 / 8e0) AS INTEGER) + CASE WHEN k % 11 = 0 THEN 1 ELSE 0 END, 3) AS delivery
  FROM feed_keys),
delivered AS (
  SELECT k, delivery, CASE WHEN k % 211 = 0 THEN NULL WHEN k % 37 = 0 THEN ep * 1000 ELSE ep END AS dt,
         CASE WHEN k % 101 = 0 THEN NULL WHEN k % 17 = 0 THEN -41.81012e0
              WHEN k % 3 = 0 THEN -41.8101e0 WHEN k % 3 = 1 THEN 11.5384e0 ELSE 0e0 END AS lat,
         CASE k % 3 WHEN 0 THEN -68.9063e0 WHEN 1 THEN -72.9168e0 ELSE 0e0 END AS lon, {_READINGS}
  FROM deliveries)"""


def _days_of(mode: str, reason: str, last_day: str) -> str:
    """Averages of the readings without a reason against them, and counts of the others."""
    means = ", ".join(
        f"{_micros(f'avg({column})')} AS {name}_mean"
        for name, column in (
            ("solar", "potencia_solar_w"), ("wind", "potencial_eolico_w"), ("total", "potencial_renovable_total_w"))
    )
    return f"""
SELECT '{mode}' AS mode, NULL AS reason, region, year, month, day, count(*) AS observations, {means}
FROM judged WHERE {reason} IS NULL AND {last_day} GROUP BY region, year, month, day
UNION ALL BY NAME
SELECT '{mode}' AS mode, {reason} AS reason, region, count(*) AS observations
FROM judged WHERE {reason} IS NOT NULL GROUP BY region, {reason}"""


_ORACLES = {
    # Sources, sinks, jobs
    "bronze_hist_scan": f"WITH {_FEEDS} SELECT {_OBSERVATION} FROM history",
    "bronze_hist_split_scan": f"WITH {_FEEDS} SELECT {_OBSERVATION} FROM history",
    "bronze_hist_lines_scan": f"WITH {_FEEDS} SELECT {_OBSERVATION} FROM history",
    "bronze_hist_mixed_sizes": f"WITH {_FEEDS} SELECT {_OBSERVATION} FROM history",
    "bronze_hist_styles": f"WITH {_FEEDS} SELECT {_OBSERVATION} FROM history",
    "bronze_stream_scan": f"WITH {_FEEDS} SELECT {_OBSERVATION} FROM feed",
    "silver_roundtrip": f"WITH {_SILVER} SELECT {_SILVER_COLUMNS} FROM silver",
    "silver_incremental": f"""WITH {_FEEDS}
SELECT {_SILVER_COLUMNS} FROM ({_region("SELECT * FROM history")})""",
    "gold_roundtrip": f"WITH {_GOLD} SELECT {_GOLD_COLUMNS} FROM gold",
    "gold_by_month": f"WITH {_GOLD} SELECT {_GOLD_COLUMNS} FROM gold",
    "gold_table": f"WITH {_GOLD} SELECT {_TABLE_COLUMNS} FROM gold",
    "gold_table_by_month": f"WITH {_GOLD} SELECT {_TABLE_COLUMNS} FROM gold",
    "gold_view_by_month": f"WITH {_GOLD} SELECT {_TABLE_COLUMNS} FROM gold",
    "gold_table_sql": f"""WITH {_DAILY},
both_regions AS (
  SELECT year, month, day, {_of("Patagonia", "max(total)")} AS patagonia,
         {_of("Riohacha", "max(total)")} AS riohacha
  FROM daily GROUP BY year, month, day)
SELECT year, month, count(*) FILTER (WHERE patagonia > riohacha) AS patagonia_leads,
       count(*) FILTER (WHERE riohacha > patagonia) AS riohacha_leads
FROM both_regions GROUP BY year, month""",
    "overwrite_static": _partition_counts(_region("SELECT * FROM feed")),
    "overwrite_dynamic": _partition_counts("SELECT * FROM silver"),
    "row_counts": f"""WITH {_GOLD}
SELECT 'historical' AS stage, count(*) AS rows FROM history
UNION ALL SELECT 'hourly', count(*) FROM feed
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'gold', count(*) FROM gold""",
    "bronze_to_gold_end_to_end": f"""WITH {_DAILY}
SELECT year, month, day,
       {_cents(_of("Patagonia", "max(solar_max)"))} AS var_pot_solar_patagonia,
       {_cents(_of("Riohacha", "max(solar_max)"))} AS var_pot_solar_riohacha
FROM daily GROUP BY year, month, day""",
    # Projections
    "norm_hist": f"WITH {_FEEDS} SELECT {_OBSERVATION} FROM history",
    "norm_stream": f"WITH {_FEEDS} SELECT {_OBSERVATION} FROM feed",
    "norm_dirty": f"WITH {_DIRTY} SELECT {_OBSERVATION} FROM dirty",
    "silver_union": f"WITH {_SILVER} SELECT {_OBSERVATION} FROM both_feeds",
    "calendar_fields": f'WITH {_SILVER} SELECT dt, "timestamp", year, month, day FROM silver',
    "region_classify": f"WITH {_SILVER} SELECT dt, lat, lon, region FROM silver",
    "solar_power": f"""WITH {_GOLD}
SELECT dt, region, uvi, temp, {_micros(_LOSS)} AS heat_loss,
       {_micros("potencia_solar_w")} AS potencia_solar_w FROM gold""",
    "air_density": f"""WITH {_GOLD}
SELECT dt, region, pressure, temp, {_micros(_DENSITY)} AS air_density FROM gold""",
    "wind_power": f"""WITH {_GOLD}
SELECT dt, region, pressure, temp, wind_speed,
       {_micros("potencial_eolico_w")} AS potencial_eolico_w FROM gold""",
    "total_power": f"WITH {_GOLD} SELECT dt, region, {_POWERS} FROM gold",
    # Aggregates
    "daily_avg_by_region": f"""WITH {_DAILY}
SELECT region, year, month, day, observations, {_micros("solar")} AS avg_solar,
       {_micros("wind")} AS avg_wind, {_micros("total")} AS avg_total FROM daily""",
    "merged_daily": f"""WITH {_DAILY}
SELECT region, year, month, day, observations, {_micros("solar")} AS avg_solar,
       {_micros("wind")} AS avg_wind, {_micros("total")} AS avg_total FROM daily""",
    "region_pivot": f"""WITH {_GOLD}
SELECT year, month, day,
       {_cents(_of("Patagonia", "max(potencial_renovable_total_w)"))} AS patagonia,
       {_cents(_of("Riohacha", "max(potencial_renovable_total_w)"))} AS riohacha
FROM gold GROUP BY year, month, day""",
    # Reports
    "q1_solar_daily": f"""WITH {_GOLD}
SELECT year, month, day,
       {_cents(_of("Patagonia", "max(potencia_solar_w)"))} AS var_pot_solar_patagonia,
       {_cents(_of("Riohacha", "max(potencia_solar_w)"))} AS var_pot_solar_riohacha
FROM gold GROUP BY year, month, day
ORDER BY year DESC NULLS LAST, month DESC NULLS LAST, day DESC NULLS LAST""",
    "q1_solar_monthly": _monthly("solar", "var_pot_sol_monthly"),
    "q2_wind_daily": f"""WITH {_GOLD}
SELECT year, month, day,
       {", ".join(
           _spread(_of(r, "max(potencial_eolico_w)"), _of(r, "min(potencial_eolico_w)"))
           + f" AS daily_var_pot_eolico_{r.lower()}" for r in ("Patagonia", "Riohacha"))}
FROM gold GROUP BY year, month, day
ORDER BY year DESC NULLS LAST, month DESC NULLS LAST, day DESC NULLS LAST""",
    "q2_wind_monthly": _monthly("wind", "var_pot_eolico_monthly"),
    "q4_max_patagonia": _extreme("Patagonia", "DESC"),
    "q4_max_riohacha": _extreme("Riohacha", "DESC"),
    "q4_min_patagonia": _extreme("Patagonia", "ASC"),
    "q4_min_riohacha": _extreme("Riohacha", "ASC"),
    "q4_extremes_all": f"""WITH {_DAILY},
energy AS (
  SELECT region, year, month, day, {_cents("total")} AS avg_pot_energy_daily
  FROM daily WHERE region <> 'No Region'),
ranked AS (
  SELECT *, 'max' AS extreme, row_number() OVER (
           PARTITION BY region ORDER BY avg_pot_energy_daily DESC {_RANK_ORDER}) AS position
  FROM energy
  UNION ALL
  SELECT *, 'min', row_number() OVER (
           PARTITION BY region ORDER BY avg_pot_energy_daily ASC {_RANK_ORDER})
  FROM energy)
SELECT region, year, month, day, avg_pot_energy_daily, extreme,
       CAST(position AS INTEGER) AS position
FROM ranked WHERE position <= 10""",
    # Questions asked without SQL of their own
    "q3_low_power_conditions": _LOW_POWER,
    "forecast_vs_observed": f"""WITH {_DATED}
SELECT region, count(*) AS forecast_days,
       {_micros("avg(abs(prior - total))")} AS mean_absolute_error,
       {_micros("avg(prior - total)")} AS bias
FROM pairs WHERE prior - total IS NOT NULL GROUP BY region""",
    "forecast_feed_errors": f"""WITH {_GOLD},
observed AS (
  SELECT region, dt, avg(potencial_renovable_total_w) AS total
  FROM gold WHERE dt IS NOT NULL GROUP BY region, dt),
errors AS (
  SELECT o.region, f.total - o.total AS error
  FROM observed f JOIN observed o ON f.region = o.region AND f.dt + 86400 = o.dt
  WHERE f.region <> 'No Region' AND f.total - o.total IS NOT NULL)
SELECT region, count(*) AS forecasts, {_micros("avg(abs(error))")} AS mean_absolute_error,
       {_micros("avg(error)")} AS bias
FROM errors GROUP BY region""",
    "intermittency": f"""WITH {_DATED}
SELECT region, count(*) AS day_pairs,
       {_micros("avg(abs(total - prior))")} AS mean_day_to_day_change,
       {_micros("max(abs(total - prior))")} AS max_day_to_day_change
FROM pairs WHERE prior - total IS NOT NULL GROUP BY region""",
    "hot_day_derating": f"""WITH {_GOLD}
SELECT region, count(*) AS hot_readings, {_micros(f"avg({_LOSS})")} AS mean_loss,
       {_micros(f"max({_LOSS})")} AS max_loss
FROM gold WHERE region <> 'No Region' AND temp > 32e0 GROUP BY region""",
    "seasonality": f"""WITH {_DAILY},
monthly AS (
  SELECT region, year, month,
         CASE WHEN sum(solar_n) > 0 THEN sum(solar_sum) / sum(solar_n) END AS solar,
         CASE WHEN sum(wind_n) > 0 THEN sum(wind_sum) / sum(wind_n) END AS wind
  FROM daily WHERE region <> 'No Region' AND year IS NOT NULL GROUP BY region, year, month)
SELECT region, count(*) AS months,
       {_micros("stddev_samp(solar)")} AS solar_monthly_stddev,
       {_micros("stddev_samp(wind)")} AS wind_monthly_stddev
FROM monthly GROUP BY region""",
    # Data quality
    "dedup_silver": f"""WITH {_FEEDS},
labelled AS (
  SELECT *, 1 AS source_rank FROM history UNION ALL BY NAME SELECT *, 0 AS source_rank FROM feed),
placed AS ({_region("SELECT * FROM labelled")}),
ranked AS (
  SELECT *, row_number() OVER (
           PARTITION BY dt, lat, lon
           ORDER BY source_rank, uvi NULLS LAST, temp NULLS LAST, pressure NULLS LAST,
                    humidity NULLS LAST, wind_speed NULLS LAST) AS copy
  FROM placed)
SELECT {_OBSERVATION}, region FROM ranked
WHERE copy = 1 OR dt IS NULL OR lat IS NULL OR lon IS NULL""",
    "reject_report": f"""WITH {_FEEDS}
{_rejects("history", "historical")}
UNION ALL {_rejects("feed", "hourly")}""",
    "reject_report_dirty": f"""WITH {_DIRTY}
{_rejects("dirty", "historical", _DIRTY_FIELDS, "k % 29 = 0")}
UNION ALL {_rejects("feed", "hourly")}""",
    # Streams
    "stream_late_and_bad_time": f"""WITH {_UNSTEADY}
SELECT {_OBSERVATION},
       CASE WHEN lat = -41.8101e0 AND lon = -68.9063e0 THEN 'Patagonia'
            WHEN lat = 11.5384e0 AND lon = -72.9168e0 THEN 'Riohacha'
            ELSE 'No Region' END AS region
FROM ranked WHERE copy = 1 OR dt IS NULL OR lat IS NULL OR lon IS NULL""",
    "stream_silver": f"""WITH {_FEEDS},
placed AS ({_region("SELECT * FROM feed")})
SELECT region, year, month, day, count(*) AS observations
FROM (SELECT DISTINCT region, lat, lon, dt, year, month, day FROM placed
      WHERE dt IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL
      UNION ALL
      SELECT region, lat, lon, dt, year, month, day FROM placed
      WHERE dt IS NULL OR lat IS NULL OR lon IS NULL)
GROUP BY region, year, month, day""",
    "stream_append": f"""WITH {_FEEDS}
SELECT {_SILVER_COLUMNS} FROM ({_region("SELECT * FROM feed")})""",
    "stream_daily": f"""WITH {_FEEDS},
gold AS ({_power(_region("SELECT * FROM feed"))})
SELECT region, year, month, day, count(*) AS observations,
       {_micros("avg(potencia_solar_w)")} AS solar_mean,
       {_micros("avg(potencial_eolico_w)")} AS wind_mean,
       {_micros("avg(potencial_renovable_total_w)")} AS total_mean
FROM gold WHERE region <> 'No Region' AND dt IS NOT NULL
GROUP BY region, year, month, day""",
    "stream_daily_bad_time": f"""WITH {_DELIVERED},
gold AS ({_power(_region("SELECT * FROM delivered"))}),
timed AS (
  SELECT *, CASE WHEN dt IS NULL THEN 'no time' WHEN dt > 100000000000 THEN 'ahead of its delivery' END AS bad
  FROM gold WHERE region <> 'No Region'),
latest AS (SELECT delivery, max(dt) FILTER (WHERE bad IS NULL) AS dt FROM timed GROUP BY delivery),
seen AS (SELECT delivery, max(dt) OVER (ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM latest),
judged AS (
  SELECT t.*, (dt // 86400 + 1) * 86400 + 7200 AS closing,
         CASE WHEN bad IS NOT NULL THEN bad
              WHEN (dt // 86400 + 1) * 86400 + 7200 <= before THEN 'after its day was closed' END AS late
  FROM timed t JOIN seen USING (delivery))
{_days_of("running", "bad", "true")}
UNION ALL BY NAME {_days_of("finished", "late", "closing <= (SELECT max(dt) FROM latest)")}""",
    "stream_dedup": f"""WITH {_DELIVERED},
placed AS ({_region("SELECT * FROM delivered UNION ALL SELECT * FROM delivered WHERE k % 5 = 0")})
SELECT DISTINCT {_OBSERVATION}, region FROM placed WHERE dt IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL
UNION ALL
SELECT {_OBSERVATION}, region FROM placed WHERE dt IS NULL OR lat IS NULL OR lon IS NULL""",
}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)

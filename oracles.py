"""SQL of the same meaning as each registered query, for DuckDB."""

from __future__ import annotations

VISITS = """
visits AS (
  SELECT e.event_id, e.event_type, day(e.ts) AS day,
    CASE WHEN e.event_type <> 'error' THEN p_brand END AS artist,
    CASE WHEN e.event_type <> 'error' THEN p_name END AS song,
    e.value + (e.event_id % 100) / 100000.0e0 AS duration,
    epoch_us(e.ts) // 1000 AS ts,
    CAST(e.user_id * 100 + day(e.ts) AS INTEGER) AS sessionId,
    'Logged In' AS auth,
    CASE WHEN e.value >= 20 THEN 'paid' ELSE 'free' END AS level,
    n_name AS city, CAST(e.user_id AS VARCHAR) AS zip, r_name AS state,
    CASE e.event_id % 6
      WHEN 0 THEN 'Mozilla/5.0 (Windows NT 6.1) Chrome/36.0 Safari/537.36'
      WHEN 1 THEN 'Mozilla/5.0 (iPhone; CPU iPhone OS 7_1 like Mac OS X) Mobile Safari/9537'
      WHEN 2 THEN 'Mozilla/5.0 (X11; Linux x86_64) Firefox/31.0'
      WHEN 3 THEN 'Mozilla/5.0 (Macintosh; Intel Mac OS X 10_9) Safari/537'
      WHEN 4 THEN 'curl/7.1' END AS userAgent,
    100.0e0 - c_nationkey * 2.0e0 AS lon, c_nationkey * 1.5e0 AS lat,
    e.user_id AS userId, 'L' || CAST(e.user_id % 7 AS VARCHAR) AS lastName, c_name AS firstName,
    CASE WHEN e.user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    1609459200000 + e.user_id * 86400000 AS registration,
    e.event_type AS page,
    CASE WHEN e.event_type = 'view' THEN 'GET' ELSE 'PUT' END AS method,
    CAST(CASE WHEN e.event_type <> 'error' THEN 200 ELSE 404 END AS INTEGER) AS status,
    e.event_type <> 'error' AS success,
    CAST(e.ts AS DATE) AS event_date,
    date '2021-01-01' + CAST(('0x' || substr(md5('listenlake:' || e.user_id), 1, 8))::BIGINT % 365 AS INTEGER)
      AS registration_date,
    CAST(datediff('day', date '1970-01-01', registration_date) AS BIGINT) * 86400000 AS masked_registration
  FROM events e
  LEFT JOIN part p ON p_partkey = CAST(e.props->>'k' AS INTEGER)
  LEFT JOIN customer c ON c_custkey = e.user_id
  LEFT JOIN nation n ON n_nationkey = c_nationkey
  LEFT JOIN region r ON r_regionkey = n_regionkey
),
listen AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY userId, day ORDER BY ts, event_id) - 1 AS INTEGER) AS itemInSession,
    make_timestamp((ts // 1000) * 1000000) AS second
  FROM visits
)"""

SONG = """
song AS (
  SELECT *, row_number() OVER (ORDER BY song_name, song_duration) AS song_id
  FROM (SELECT DISTINCT song AS song_name, duration AS song_duration FROM listen
        WHERE song IS NOT NULL AND duration IS NOT NULL)
)"""

ARTIST = """
artist AS (
  SELECT artist_name, latitude, longitude, date '2024-01-16' AS start_date, CAST(NULL AS DATE) AS end_date,
    true AS is_active, row_number() OVER (ORDER BY artist_name, latitude, longitude) AS artist_id
  FROM (SELECT DISTINCT artist AS artist_name, lat AS latitude, lon AS longitude FROM listen
        WHERE artist IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL)
)"""

CITY = """
city AS (
  SELECT *, row_number() OVER (ORDER BY city_name NULLS FIRST, state NULLS FIRST, zip_code NULLS FIRST,
    latitude NULLS FIRST, longitude NULLS FIRST) AS city_id
  FROM (SELECT DISTINCT city AS city_name, state, zip AS zip_code, lat AS latitude, lon AS longitude FROM listen)
)"""

DEVICE = """
device AS (
  SELECT row_number() OVER (ORDER BY userAgent NULLS FIRST) AS device_id, userAgent,
    coalesce(nullif(regexp_extract(userAgent, '(Mobile|Tablet|iPad|iPhone|Desktop|Bot)', 1), ''), 'Unknown')
      AS device_type,
    coalesce(nullif(regexp_extract(userAgent, '(Windows|Mac OS X|Linux|Android|iOS|iPad|iPhone)', 1), ''), 'Unknown')
      AS operating_system,
    coalesce(nullif(regexp_extract(userAgent,
      '(Chrome|Firefox|Safari|Edge|Opera|IE|Trident|SamsungBrowser)', 1), ''), 'Unknown') AS browser
  FROM (SELECT DISTINCT userAgent FROM listen)
)"""

SESSION = """
session AS (
  SELECT *, row_number() OVER (ORDER BY StartTime, sessionId) AS session_id
  FROM (SELECT sessionId, min(second) AS StartTime, max(second) AS EndTime,
          date '2024-01-16' AS start_date, CAST(NULL AS DATE) AS end_date, true AS is_active
        FROM listen GROUP BY sessionId)
)"""

USER_HISTORY = """
instants AS (
  SELECT * FROM listen WHERE userId IS NOT NULL AND level IS NOT NULL AND ts IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY userId, ts, level ORDER BY sessionId NULLS FIRST,
    itemInSession NULLS FIRST, firstName NULLS FIRST, lastName NULLS FIRST, gender NULLS FIRST,
    registration_date NULLS FIRST) = 1
),
marked AS (
  SELECT *, CASE WHEN level <> lag(level) OVER person THEN 1 ELSE 0 END AS changed
  FROM instants
  WINDOW person AS (PARTITION BY userId, firstName, lastName, gender
    ORDER BY ts, sessionId NULLS FIRST, itemInSession NULLS FIRST, level)
),
numbered AS (
  SELECT *, sum(changed) OVER (PARTITION BY userId, firstName, lastName, gender
    ORDER BY ts, sessionId NULLS FIRST, itemInSession NULLS FIRST, level
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM marked
),
runs AS (
  SELECT userId, firstName, lastName, gender, level, run,
    min(registration_date) AS registration_date, min(second) AS rowActivationDate
  FROM numbered GROUP BY ALL
),
user_history AS (
  SELECT userId, firstName, lastName, gender, level, registration_date, rowActivationDate,
    strftime(lead(rowActivationDate, 1, timestamp '9999-12-31 00:00:00') OVER person, '%Y-%m-%d %H:%M:%S')
      AS rowExpirationDate,
    CAST(CASE WHEN lead(run) OVER person IS NULL THEN 1 ELSE 0 END AS INTEGER) AS currentRow
  FROM runs
  WINDOW person AS (PARTITION BY userId, firstName, lastName, gender ORDER BY run)
)"""

USER = """
user_dim AS (
  SELECT row_number() OVER (ORDER BY userId) AS userKey, *
  FROM (SELECT * FROM user_history WHERE currentRow = 1
        QUALIFY row_number() OVER (PARTITION BY userId
          ORDER BY rowActivationDate DESC, firstName DESC NULLS LAST, lastName DESC NULLS LAST,
            gender DESC NULLS LAST) = 1)
)"""


def _calendar(name: str, moments: str, column: str, key: str, hour: str) -> str:
    d = column
    return f"""
{name} AS (
  SELECT {d}, {key} AS DateSK,
    CAST(year({d}) AS INTEGER) AS Year, CAST(quarter({d}) AS INTEGER) AS Quarter,
    CAST(month({d}) AS INTEGER) AS Month, CAST(day({d}) AS INTEGER) AS Day, {hour}
    CAST(weekofyear({d}) AS INTEGER) AS Week,
    CASE quarter({d}) WHEN 1 THEN '1st' WHEN 2 THEN '2nd' WHEN 3 THEN '3rd' ELSE '4th' END || ' quarter'
      AS QuarterNameLong,
    'Q' || quarter({d}) AS QuarterNameShort, '0' || quarter({d}) AS QuarterNumberString,
    strftime({d}, '%B') AS MonthNameLong, strftime({d}, '%b') AS MonthNameShort,
    strftime({d}, '%m') AS MonthNumberString, strftime({d}, '%d') AS DayNumberString,
    'week' || lpad(CAST(weekofyear({d}) AS VARCHAR), 2, '0') AS WeekNameLong,
    'w' || lpad(CAST(weekofyear({d}) AS VARCHAR), 2, '0') AS WeekNameShort,
    lpad(CAST(weekofyear({d}) AS VARCHAR), 2, '0') AS WeekNumberString,
    CAST(dayofweek({d}) + 1 AS INTEGER) AS DayOfWeek, strftime({d}, '%Y/%m') AS YearMonthString,
    strftime({d}, '%A') AS DayOfWeekNameLong, strftime({d}, '%a') AS DayOfWeekNameShort,
    CAST(day({d}) AS INTEGER) AS DayOfMonth, CAST(dayofyear({d}) AS INTEGER) AS DayOfYear
  FROM ({moments})
)"""


DAYS = _calendar(
    "days",
    """SELECT CAST(unnest(generate_series(CAST(min(event_date) AS TIMESTAMP), CAST(max(event_date) AS TIMESTAMP),
         INTERVAL 1 DAY)) AS DATE) AS "Date" FROM listen""",
    '"Date"',
    """CAST(strftime("Date", '%Y%m%d') AS INTEGER)""",
    "",
)

HOURS = _calendar(
    "hours",
    """SELECT unnest(generate_series(CAST(min(event_date) AS TIMESTAMP),
         CAST(max(event_date) AS TIMESTAMP) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS "date" FROM listen""",
    '"date"',
    """CAST(strftime("date", '%Y%m%d%H') AS BIGINT)""",
    """CAST(hour("date") AS INTEGER) AS Hour,""",
)


def _fact(name: str, calendar: str, calendar_on: str, columns: str) -> str:
    return f"""
{name} AS (
  SELECT {columns}, l.level, l.ts, CAST(1 AS INTEGER) AS plays_count
  FROM listen l
  LEFT JOIN song s ON l.song = s.song_name AND l.duration = s.song_duration
  LEFT JOIN artist a ON l.artist = a.artist_name AND l.lat = a.latitude AND l.lon = a.longitude
  LEFT JOIN city c ON l.city = c.city_name AND l.state = c.state AND l.zip = c.zip_code
    AND l.lat = c.latitude AND l.lon = c.longitude
  LEFT JOIN {calendar} d ON {calendar_on}
  LEFT JOIN user_dim u ON l.userId = u.userId
  LEFT JOIN session x ON l.sessionId = x.sessionId
  LEFT JOIN device v ON l.userAgent IS NOT DISTINCT FROM v.userAgent
)"""


_IDS = "s.song_id, a.artist_id, c.city_id, d.DateSK AS datetime_id, x.session_id AS session_id_fk"
FACT_DAY = _fact("fact_day", "days", 'l.event_date = d."Date"', f"u.userKey, {_IDS}")
FACT_HOUR = _fact(
    "fact_hour",
    "hours",
    'l.event_date = CAST(d."date" AS DATE) AND hour(l.second) = d.Hour',
    f"u.userId AS user_id_fk, {_IDS}, l.duration, v.device_id",
)

_DIMENSIONS = [SONG, ARTIST, CITY, DEVICE, SESSION, USER_HISTORY, USER]

_EXACT = "CAST(sum(CAST(duration AS DECIMAL(38,9))) AS DOUBLE)"


def _over(parts: list[str], select: str) -> str:
    return "WITH " + ",".join([VISITS, *parts]) + "\n" + select


def _topic(columns: str) -> str:
    return _over([], f"SELECT {columns} FROM listen")


_LISTENER = "city, zip, state, userAgent, lon, lat, userId, lastName, firstName, gender, registration"
_LISTEN_COLUMNS = f"artist, song, duration, ts, sessionId, auth, level, itemInSession, {_LISTENER}"
_PAGE_COLUMNS = (
    "ts, sessionId, page, auth, method, status, level, CAST(itemInSession AS BIGINT) AS itemInSession, "
    f"{_LISTENER}, artist, song, duration"
)

_PROFILE = {
    "users": "userId",
    "cities": "city, state, zip, lat, lon",
    "artist_places": "artist, lat, lon",
    "artists": "artist",
    "songs": "song, duration",
    "sessions": "sessionId",
    "timestamps": "second",
    "devices": "userAgent",
}

_UNIQUE = {
    "dim_song": ("song", "song_name, song_duration"),
    "dim_artist": ("artist", "artist_name, latitude, longitude"),
    "dim_city": ("city", "city_name, state, zip_code, latitude, longitude"),
    "dim_device": ("device", "userAgent"),
    "dim_date": ("days", "DateSK"),
    "dim_date_hour": ("hours", "DateSK"),
    "dim_user": ("user_dim", "userId"),
    "dim_session": ("session", "sessionId"),
}


def _unique(name: str, table: str, key: str) -> str:
    missing = " OR ".join(f"{c.strip()} IS NULL" for c in key.split(","))
    return f"""SELECT '{name}' AS table_name, count(*) AS row_count,
      (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {table})) AS distinct_keys,
      count(*) FILTER (WHERE {missing}) AS null_keys,
      count(*) = (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {table})) AS is_unique FROM {table}"""


SCD2_MERGE = (
    """
existing AS (
  SELECT *, row_number() OVER (ORDER BY StartTime, sessionId) AS session_id
  FROM (SELECT sessionId, min(second) AS StartTime, max(second) AS EndTime
        FROM (SELECT *, max(ts) OVER (PARTITION BY sessionId) AS last_ts FROM listen
              WHERE event_date < date '2024-01-16')
        WHERE userId % 2 = 1 OR ts < last_ts
        GROUP BY sessionId)
),
incoming AS (
  SELECT sessionId, min(second) AS StartTime, max(second) AS EndTime FROM listen WHERE userId <> 7 GROUP BY sessionId
),
fates AS (
  SELECT e.sessionId AS old_id, e.StartTime AS old_start, e.EndTime AS old_end, e.session_id,
    i.sessionId AS new_id, i.StartTime AS new_start, i.EndTime AS new_end,
    e.sessionId IS NOT NULL AND (i.sessionId IS NULL
      OR (e.StartTime = i.StartTime AND e.EndTime = i.EndTime)) AS keep
  FROM existing e FULL JOIN incoming i ON e.sessionId = i.sessionId
)""",
    """
SELECT old_id AS sessionId, old_start AS StartTime, old_end AS EndTime, date '2024-01-16' AS start_date,
  CASE WHEN keep THEN CAST(NULL AS DATE) ELSE date '2024-02-01' END AS end_date, keep AS is_active, session_id
FROM fates WHERE old_id IS NOT NULL
UNION ALL
SELECT new_id, new_start, new_end, date '2024-02-01', CAST(NULL AS DATE), true,
  (SELECT max(session_id) FROM existing) + row_number() OVER (ORDER BY new_start, new_id)
FROM fates WHERE NOT keep AND new_id IS NOT NULL""",
)

ARTIST_INCREMENT = (
    """
places AS (
  SELECT artist AS artist_name, lat AS latitude, lon AS longitude, min(event_date) < date '2024-01-16' AS known
  FROM listen WHERE artist IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL GROUP BY ALL
)""",
    """
SELECT artist_name, latitude, longitude,
  CASE WHEN known THEN date '2024-01-16' ELSE date '2024-02-01' END AS start_date,
  CAST(NULL AS DATE) AS end_date, true AS is_active,
  row_number() OVER (ORDER BY CASE WHEN known THEN 0 ELSE 1 END, artist_name, latitude, longitude) AS artist_id
FROM places""",
)

STAR_LINEITEM = """
WITH kinds AS (
  SELECT *, row_number() OVER (ORDER BY p_brand, p_type, p_size) AS part_kind_id
  FROM (SELECT DISTINCT p_brand, p_type, p_size FROM part)
),
places AS (
  SELECT *, row_number() OVER (ORDER BY n_name) AS place_id
  FROM (SELECT DISTINCT n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)
)
SELECT l_orderkey, l_linenumber, part_kind_id, place_id,
  CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS DateSK, l_quantity, l_extendedprice
FROM lineitem
LEFT JOIN part p ON l_partkey = p_partkey
LEFT JOIN kinds k ON p.p_brand = k.p_brand AND p.p_type = k.p_type AND p.p_size = k.p_size
LEFT JOIN (supplier s JOIN nation n ON s_nationkey = n_nationkey) ON l_suppkey = s_suppkey
LEFT JOIN places x ON n.n_name = x.n_name
"""

RUNS_ORDERS = """
WITH marked AS (
  SELECT *, CASE WHEN o_orderstatus IS DISTINCT FROM lag(o_orderstatus) OVER w THEN 1 ELSE 0 END AS changed
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
),
numbered AS (
  SELECT *, sum(changed) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM marked
),
runs AS (
  SELECT o_custkey, o_orderstatus, run, min(o_orderdate) AS run_start, count(*) AS orders,
    max(o_totalprice) AS largest
  FROM numbered GROUP BY ALL
)
SELECT o_custkey, o_orderstatus, run_start,
  lead(run_start) OVER (PARTITION BY o_custkey ORDER BY run) AS next_start, orders, largest
FROM runs
"""

RUNS_HOT_KEY = """
WITH marked AS (
  SELECT *, CASE WHEN user_id IS DISTINCT FROM lag(user_id) OVER w THEN 1 ELSE 0 END AS changed
  FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)
),
numbered AS (
  SELECT *, sum(changed) OVER (PARTITION BY event_type ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM marked
),
runs AS (
  SELECT event_type, user_id, run, min(ts) AS run_start, count(*) AS events, max(value) AS largest
  FROM numbered GROUP BY ALL
)
SELECT event_type, user_id, run_start,
  lead(run_start) OVER (PARTITION BY event_type ORDER BY run) AS next_start, events, largest
FROM runs
"""


def oracle_sql() -> dict[str, str]:
    arrived = " UNION ALL ".join(
        f"""SELECT '{topic}' AS topic, event_date, count(*) AS event_rows, CAST(sum(ts) AS BIGINT) AS sum_ts,
          CAST(sum(userId) AS BIGINT) AS sum_user_id FROM listen GROUP BY event_date"""
        for topic in ("auth_events", "listen_events", "page_view_events", "status_change_events")
    )
    profile = " UNION ALL ".join(
        f"SELECT '{measure}' AS measure, count(*) AS distinct_rows FROM (SELECT DISTINCT {columns} FROM listen)"
        for measure, columns in _PROFILE.items()
    )
    lacking = " UNION ALL ".join(
        f"SELECT '{topic}' AS topic, '{column}' AS column_name, count(*) FILTER ({column} IS NULL) AS null_rows FROM listen"
        for topic in ("auth_events", "listen_events", "page_view_events", "status_change_events")
        for column in ("ts", "sessionId", "userId", "level")
    )
    unique_keys = " UNION ALL ".join(_unique(name, *table) for name, table in _UNIQUE.items())
    day_star = [*_DIMENSIONS, DAYS, FACT_DAY]
    hour_star = [*_DIMENSIONS, HOURS, FACT_HOUR]
    return {
        "ingest_parse_listen": _topic(_LISTEN_COLUMNS),
        "ingest_parse_auth": _topic(f"ts, sessionId, level, itemInSession, {_LISTENER}, success"),
        "ingest_parse_page_view": _topic(_PAGE_COLUMNS),
        "ingest_parse_status_change": _topic(f"ts, sessionId, auth, level, itemInSession, {_LISTENER}"),
        "ingest_quarantine": _over(
            [],
            """SELECT CASE WHEN event_id % 10 <= 1 THEN 'bad' ELSE 'good' END AS quality,
                 CASE event_id % 10 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'null_value' ELSE 'none' END AS reason,
                 count(*) AS message_rows,
                 CAST(sum(CASE WHEN event_id % 10 > 1 THEN ts END) AS BIGINT) AS sum_ts
               FROM listen GROUP BY 1, 2""",
        ),
        "ingest_bad_times": _over(
            [],
            """SELECT CASE WHEN event_id % 10 <= 3 THEN 'bad' ELSE 'good' END AS quality,
                 CASE WHEN event_id % 10 <= 3 THEN 'bad_time' WHEN event_id % 10 = 4 THEN 'wrong_type' ELSE 'none' END
                   AS reason,
                 count(*) AS message_rows, count(CASE WHEN event_id % 10 <= 4 THEN 1 END) AS kept_texts,
                 CAST(sum(CASE WHEN event_id % 10 > 3 THEN ts END) AS BIGINT) AS sum_ts
               FROM listen GROUP BY 1, 2""",
        ),
        "fact_undated_plays": _over(
            [],
            f"""SELECT event_id % 50 = 0 AS undated, count(*) AS fact_rows, {_EXACT} AS total_duration
                FROM listen GROUP BY 1""",
        ),
        "ingest_stream_append": _topic(
            f"{_LISTEN_COLUMNS}, registration_date, event_date".replace("registration,", "masked_registration AS registration,")
        ),
        "ingest_stream_topics": _over([], arrived),
        "archive_csv": _topic(_PAGE_COLUMNS),
        "ingest_event_date": "SELECT event_id, CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS INTEGER) AS event_hour FROM events",
        "ingest_masked_registration": _topic("event_id, userId, masked_registration AS registration, registration_date"),
        "dim_song": _over([SONG], "SELECT * FROM song"),
        "dim_artist": _over([ARTIST], "SELECT * FROM artist"),
        "dim_city": _over([CITY], "SELECT * FROM city"),
        "dim_device": _over([DEVICE], "SELECT * FROM device"),
        "dim_date": _over([DAYS], "SELECT * FROM days"),
        "dim_date_hour": _over([HOURS], "SELECT * FROM hours"),
        "dim_user_history": _over([USER_HISTORY], "SELECT * FROM user_history"),
        "warehouse_late_history": _over([USER_HISTORY], "SELECT * FROM user_history"),
        "warehouse_late_sessions": _over(
            [],
            """SELECT CAST(userId AS INTEGER) AS sessionId, min(second) AS StartTime, max(second) AS EndTime
               FROM listen GROUP BY userId""",
        ),
        "dim_user": _over([USER_HISTORY, USER], "SELECT * FROM user_dim"),
        "dim_session": _over(
            [SESSION],
            """SELECT *, CAST(year(StartTime) AS INTEGER) AS year, CAST(month(StartTime) AS INTEGER) AS month
               FROM session""",
        ),
        "scd2_session_merge": _over([SCD2_MERGE[0]], SCD2_MERGE[1]),
        "dim_artist_increment": _over([ARTIST_INCREMENT[0]], ARTIST_INCREMENT[1]),
        "fact_plays_day": _over(day_star, "SELECT * FROM fact_day"),
        "fact_plays_hour": _over(hour_star, "SELECT * EXCLUDE (device_id) FROM fact_hour"),
        "fact_plays_device": _over(hour_star, "SELECT * FROM fact_hour"),
        "check_fact_sums": _over(
            hour_star,
            f"""SELECT (SELECT count(*) FROM listen) AS play_rows, count(*) AS fact_rows,
                  (SELECT {_EXACT} FROM listen) AS play_duration, {_EXACT} AS fact_duration,
                  count(*) = (SELECT count(*) FROM listen)
                    AND sum(CAST(duration AS DECIMAL(38,9)))
                      = (SELECT sum(CAST(duration AS DECIMAL(38,9))) FROM listen) AS preserved
                FROM fact_hour""",
        ),
        "check_profile": _over([], profile),
        "check_hours_per_date": _over(
            [DAYS, HOURS],
            """SELECT d."Date", count(h.Hour) AS hour_count FROM days d
               LEFT JOIN hours h ON CAST(h."date" AS DATE) = d."Date" AND h.DateSK % 7 <> 0 AND h.Day % 10 <> 0
               GROUP BY d."Date" HAVING count(h.Hour) < 24""",
        ),
        "check_date_range": _over([], "SELECT min(event_date) AS first_date, max(event_date) AS last_date FROM listen"),
        "check_unique_keys": _over(
            [*_DIMENSIONS, DAYS, HOURS],
            unique_keys,
        ),
        "stream_refresh_keys": _over([*_DIMENSIONS, DAYS, HOURS], unique_keys),
        "stream_refresh_history": _over([USER_HISTORY], "SELECT * FROM user_history"),
        "stream_refresh_facts": _over(
            [],
            """SELECT ts, CAST(strftime(second, '%Y%m%d%H') AS BIGINT) AS datetime_id, userId AS user_id_fk, level, duration,
                 song AS song_name, CASE WHEN song IS NOT NULL THEN duration END AS song_duration, artist AS artist_name,
                 city AS city_name, zip AS zip_code, sessionId FROM listen""",
        ),
        "fact_plays_of_a_day": _over(
            hour_star, "SELECT * EXCLUDE (device_id) FROM fact_hour WHERE datetime_id // 100 = 20240116"
        ),
        "dim_song_from_none": _over([SONG], "SELECT * FROM song"),
        "check_required_columns": _over([], lacking),
        "ingest_deduplicated": _over(
            [],
            """SELECT event_date, count(*) AS event_rows, CAST(sum(ts) AS BIGINT) AS sum_ts,
                 CAST(sum(userId) AS BIGINT) AS sum_user_id FROM listen GROUP BY event_date""",
        ),
        "lake_compacted": _over(
            [],
            """SELECT event_date, event_date < (SELECT max(event_date) FROM listen) AS compacted, count(*) AS event_rows,
                 CAST(sum(ts) AS BIGINT) AS sum_ts FROM listen GROUP BY event_date""",
        ),
        "mart_active_over_days": _over(
            [],
            """SELECT last_date, count(*) AS plays, count(DISTINCT userId) AS users, count(DISTINCT (song, duration)) AS songs,
                 true AS users_near, true AS songs_near
               FROM (SELECT *, event_date + CAST(unnest(range(7)) AS INTEGER) AS last_date FROM listen)
               WHERE last_date <= (SELECT max(event_date) FROM listen) GROUP BY last_date""",
        ),
        "duration_by_user": _over([], f"SELECT userId, {_EXACT} AS total_duration FROM listen GROUP BY userId"),
        "duration_by_city": _over(
            [],
            f"""SELECT city AS city_name, state, zip AS zip_code, lat AS latitude, lon AS longitude,
                  {_EXACT} AS total_duration FROM listen GROUP BY ALL""",
        ),
        "mart_top_songs": _over(
            hour_star,
            """SELECT CAST(row_number() OVER (ORDER BY sum(plays_count) DESC, f.song_id) AS INTEGER) AS rank,
                 f.song_id, song_name, song_duration, CAST(sum(plays_count) AS BIGINT) AS plays
               FROM fact_hour f JOIN song s ON f.song_id = s.song_id
               GROUP BY f.song_id, song_name, song_duration ORDER BY plays DESC, f.song_id LIMIT 20""",
        ),
        "mart_active_users_hour": _over(
            hour_star,
            """SELECT datetime_id, count(DISTINCT user_id_fk) AS active_users,
                 CAST(sum(plays_count) AS BIGINT) AS plays FROM fact_hour GROUP BY datetime_id""",
        ),
        "mart_active_users_day": _over(
            day_star,
            """SELECT datetime_id, count(DISTINCT userKey) AS active_users,
                 CAST(sum(plays_count) AS BIGINT) AS plays FROM fact_day GROUP BY datetime_id""",
        ),
        "mart_demographics": _over(
            [USER_HISTORY, USER], "SELECT gender, level, count(*) AS users FROM user_dim GROUP BY gender, level"
        ),
        "star_lineitem": STAR_LINEITEM,
        "runs_orders": RUNS_ORDERS,
        "runs_hot_key": RUNS_HOT_KEY,
    }

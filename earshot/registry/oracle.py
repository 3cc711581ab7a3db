"""DuckDB SQL for every registered query, written from the definitions of the reports
rather than from the Spark plans.  Common table expressions stand for the canonical tables."""

from __future__ import annotations

import re

from earshot.sources.canonical import (
    COUNTRIES,
    ERROR_TYPES,
    PLATFORMS,
    PLAYLIST_ACTIONS,
)

AS_OF = "DATE '2024-01-29'"
RUN_TS = "TIMESTAMP '2024-01-29 06:00:00'"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _pick(values: list[str], index: str) -> str:
    return f"({_list(values)})[CAST(({index}) % {len(values)} AS INTEGER) + 1]"


def _daypart(hour: str) -> str:
    return (
        f"CASE WHEN {hour} BETWEEN 5 AND 11 THEN 'morning' WHEN {hour} BETWEEN 12 AND 16 "
        f"THEN 'afternoon' WHEN {hour} BETWEEN 17 AND 21 THEN 'evening' ELSE 'night' END"
    )


# Canonical tables and shared steps; a query gets those it mentions, in this order.
_TABLES: dict[str, str] = {
    "plays": f"""
        SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS track_id,
               ts AS played_at, CAST(floor(value * 3000) AS BIGINT) AS ms_played,
               CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
               event_type AS device, 'playbtn' AS reason_start,
               CASE WHEN value < 10 THEN 'forwarded' ELSE 'trackdone' END AS reason_end,
               event_id % 3 = 0 AS shuffle, value < 10 AS skipped,
               {_pick(PLATFORMS, 'event_id')} AS platform,
               CASE WHEN event_id % 50 <> 0 THEN {_pick(COUNTRIES, 'user_id')} END AS country
        FROM events""",
    "tracks": """
        SELECT p_partkey AS track_id, p_name AS name, p_type AS album_id, p_brand AS artist_id,
               CAST(floor(p_retailprice * 200) AS BIGINT) AS duration_ms, p_size % 5 = 0 AS explicit,
               p_size AS track_number, 1 AS disc_number,
               CAST(p_partkey % 101 AS INTEGER) AS popularity,
               DATE '2020-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS release_date
        FROM part""",
    "artists": """
        SELECT b.artist_id, b.artist_id AS name, b.popularity, g.genres, b.followers
        FROM (SELECT p_brand AS artist_id, CAST(count(*) % 101 AS INTEGER) AS popularity,
                     CAST(sum(p_size) AS BIGINT) AS followers FROM part GROUP BY 1) b
        JOIN (SELECT p_brand AS artist_id, list(DISTINCT word ORDER BY word) AS genres
              FROM (SELECT p_brand, unnest(string_split(p_name, ' ')) AS word FROM part)
              GROUP BY 1) g USING (artist_id)""",
    "albums": """
        SELECT p_type AS album_id, p_type AS name, min(p_brand) AS artist_id,
               DATE '2020-01-01' AS release_date, count(*) AS total_tracks,
               CASE WHEN count(*) > 300 THEN 'compilation' ELSE 'album' END AS album_type
        FROM part GROUP BY 1""",
    "users": f"""
        SELECT c_custkey AS user_id, c_name AS username, lower(c_name) || '@example.com' AS email,
               lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS country,
               DATE '1970-01-01' + CAST(c_custkey % 10000 AS INTEGER) AS birthdate,
               {_pick(['female', 'male', 'other'], 'c_custkey')} AS gender,
               c_mktsegment AS subscription_type,
               DATE '2024-01-01' + CAST(c_custkey % 30 AS INTEGER) AS registered_on,
               c_acctbal > 0 AS is_active,
               DATE '2024-01-01' + CAST(c_custkey % 30 AS INTEGER) + 7 AS last_active
        FROM customer""",
    "playlists": "SELECT o_orderkey AS playlist_id, o_custkey AS user_id FROM orders",
    "playlist_tracks": """
        SELECT l_orderkey AS playlist_id, l_partkey AS track_id FROM lineitem""",
    "enriched": f"""
        SELECT event_id, user_id, track_id, played_at AS "timestamp", CAST(played_at AS DATE) AS date,
               CAST(year(played_at) AS INTEGER) AS year, CAST(month(played_at) AS INTEGER) AS month,
               CAST(day(played_at) AS INTEGER) AS day, CAST(hour(played_at) AS INTEGER) AS hour,
               ms_played, reason_start, reason_end, shuffle, skipped, platform, country,
               {_daypart('hour(played_at)')} AS time_of_day,
               isodow(played_at) IN (6, 7) AS is_weekend,
               least(1.0::DOUBLE, ms_played / 180000.0::DOUBLE) AS completion_ratio
        FROM plays""",
    "history": """
        SELECT p.event_id AS id, p.user_id, p.track_id, t.artist_id, t.album_id, p.played_at,
               p.ms_played,
               CASE WHEN t.duration_ms > 0 THEN least(1.0::DOUBLE, p.ms_played::DOUBLE / t.duration_ms)
                    ELSE 0.0 END AS completion_rate,
               CAST(dayofweek(p.played_at) AS INTEGER) AS day_of_week,
               CAST(hour(p.played_at) AS INTEGER) AS hour_of_day,
               p.skipped, p.session_id, u.country, u.subscription_type
        FROM plays p JOIN tracks t USING (track_id) JOIN users u USING (user_id)""",
    "user_artist_day": """
        SELECT CAST(p.played_at AS DATE) AS date, p.user_id, t.artist_id, count(*) AS n
        FROM plays p JOIN tracks t USING (track_id) GROUP BY ALL""",
    "user_genre_day": """
        SELECT date, user_id, genre, count(*) AS n FROM (
          SELECT CAST(p.played_at AS DATE) AS date, p.user_id, unnest(a.genres) AS genre
          FROM plays p JOIN tracks t USING (track_id) JOIN artists a USING (artist_id))
        GROUP BY ALL""",
    "fav_artist_day": """
        SELECT date, user_id, artist_id FROM user_artist_day
        QUALIFY row_number() OVER (PARTITION BY date, user_id ORDER BY n DESC, artist_id) = 1""",
    "fav_genre_day": """
        SELECT date, user_id, genre FROM user_genre_day
        QUALIFY row_number() OVER (PARTITION BY date, user_id ORDER BY n DESC, genre) = 1""",
    "timed": """
        SELECT p.*, CAST(p.played_at AS DATE) AS date, t.name AS song_name, t.artist_id,
               a.name AS artist_name, al.name AS album_name, t.explicit,
               CASE WHEN t.duration_ms > 0 THEN least(1.0::DOUBLE, p.ms_played::DOUBLE / t.duration_ms)
                    ELSE 0.0 END AS completion
        FROM plays p JOIN tracks t USING (track_id) JOIN artists a USING (artist_id)
             JOIN albums al USING (album_id)""",
    "ranged": """
        SELECT * REPLACE (coalesce(country, 'unknown') AS country) FROM timed
        WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'""",
    "song_platforms": """
        SELECT track_id, date, string_agg(platform || ':' || n, ',' ORDER BY platform) AS platforms
        FROM (SELECT track_id, date, platform, count(*) AS n FROM ranged GROUP BY ALL) GROUP BY ALL""",
    "song_countries": """
        SELECT track_id, date, string_agg(country || ':' || n, ',' ORDER BY country) AS countries
        FROM (SELECT track_id, date, country, count(*) AS n FROM ranged GROUP BY ALL) GROUP BY ALL""",
    "song_daily": """
        SELECT track_id AS song_id, date, any_value(song_name) AS song_name,
               any_value(artist_name) AS artist_name, any_value(album_name) AS album_name,
               count(*) AS play_count, count(DISTINCT user_id) AS unique_listeners,
               CAST(sum(ms_played) AS BIGINT) AS total_ms_played, avg(ms_played) AS avg_ms_played,
               count(*) FILTER (completion < 0.3) / count(*) AS skip_rate,
               avg(completion) AS avg_completion_rate
        FROM ranged GROUP BY track_id, date""",
    "habits_base": """
        SELECT user_id, date, count(*) AS song_count, count(DISTINCT track_id) AS unique_songs,
               count(DISTINCT artist_id) AS unique_artists,
               CAST(sum(ms_played) AS BIGINT) AS total_listening_time
        FROM timed GROUP BY user_id, date""",
    "habits_artist": """
        SELECT user_id, date, artist_name AS top_artist
        FROM (SELECT user_id, date, artist_name, count(*) AS n FROM timed GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY user_id, date ORDER BY n DESC, artist_name) = 1""",
    "habits_platforms": """
        SELECT user_id, date, platform, count(*) AS n FROM timed GROUP BY ALL""",
    "habits_platform": """
        SELECT user_id, date, platform FROM habits_platforms
        QUALIFY row_number() OVER (PARTITION BY user_id, date ORDER BY n DESC, platform) = 1""",
    "habits": """
        SELECT b.user_id, b.date, b.total_listening_time, b.song_count, 'unknown' AS top_genre,
               a.top_artist,
               CAST(b.total_listening_time // b.song_count AS BIGINT) AS avg_session_duration,
               p.platform
        FROM habits_base b JOIN habits_artist a USING (user_id, date)
             JOIN habits_platform p USING (user_id, date)""",
    "feed": f"""
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, ts,
               CASE event_type WHEN 'view' THEN 'song_play' WHEN 'signup' THEN 'auth'
                    WHEN 'click' THEN 'search' WHEN 'purchase' THEN 'playlist'
                    ELSE 'error' END AS event_type,
               CASE WHEN event_type <> 'signup' AND event_id % 40 <> 0
                    THEN {_pick(PLATFORMS, 'event_id')} ELSE 'unknown' END AS platform,
               CAST(json_extract(props, '$.k') AS VARCHAR) AS k,
               {_pick(PLAYLIST_ACTIONS, 'event_id')} AS action_type,
               {_pick(ERROR_TYPES, 'event_id')} AS error_type,
               {_pick(COUNTRIES, 'user_id')} AS country,
               event_id % 20 <> 0 AS success,
               CAST(event_id % 200 AS INTEGER) AS result_count,
               CAST(event_id % 500 AS VARCHAR) AS playlist_id,
               CAST(floor(value * 3000) AS BIGINT) AS ms_played,
               'best songs ' || (CAST(json_extract(props, '$.k') AS BIGINT) % 20) AS search_query
        FROM events""",
    "dated": """
        SELECT event_id, user_id, ms_played, played_at, played_at::DATE AS date FROM plays""",
    "counter_events": """
        SELECT event_type AS metric_type, ts,
               CASE event_type WHEN 'song_play' THEN k WHEN 'search' THEN search_query
                    WHEN 'error' THEN error_type END AS entity_id
        FROM feed WHERE event_type IN ('song_play', 'search', 'error')""",
    "user_genres": f"""
        SELECT user_id, genre, count(*) AS genre_plays FROM (
          SELECT h.user_id, unnest(a.genres) AS genre
          FROM history h JOIN artists a USING (artist_id)
          WHERE h.played_at >= {AS_OF} - 30)
        GROUP BY ALL""",
    "listening_days": f"""
        SELECT user_id, CAST(played_at AS DATE) AS activity_date,
               sum(ms_played::DOUBLE / 60000.0) AS daily_minutes
        FROM plays WHERE played_at >= {AS_OF} - 30 GROUP BY ALL""",
    "islands": """
        SELECT user_id, activity_date, daily_minutes,
               activity_date - CAST(row_number() OVER (PARTITION BY user_id ORDER BY activity_date)
                                    AS INTEGER) AS island
        FROM listening_days""",
    "runs": f"""
        SELECT user_id, count(*) AS streak_length, min(activity_date) AS streak_start,
               max(activity_date) AS streak_end, max(activity_date) = {AS_OF} - 1 AS is_current
        FROM islands GROUP BY user_id, island""",
    "pauses": """
        SELECT *, coalesce(played_at - lag(played_at) OVER w > INTERVAL 30 MINUTE, TRUE) AS starts
        FROM plays WINDOW w AS (PARTITION BY user_id ORDER BY played_at)""",
    "numbered": """
        SELECT event_id, user_id, played_at, ms_played,
               CAST(sum(CASE WHEN starts THEN 1 ELSE 0 END)
                    OVER (PARTITION BY user_id ORDER BY played_at) AS BIGINT) AS session_no
        FROM pauses""",
    "all_sessions": """
        SELECT user_id, min(played_at) AS session_start,
               max(played_at) + INTERVAL 30 MINUTE AS session_end,
               count(*) AS tracks_in_session, CAST(sum(ms_played) AS BIGINT) AS ms_in_session
        FROM numbered GROUP BY user_id, session_no""",
}

_DAYPART_COUNTS = {
    suffix: ", ".join(
        f"count(*) FILTER (time_of_day = '{p}') AS {p}_{suffix}"
        for p in ("morning", "afternoon", "evening", "night")
    )
    for suffix in ("tracks", "streams")
}

_FEATURE_TIMES = ", ".join(
    f"round(coalesce(sum(ms_played) FILTER (is_weekend = {flag} AND time_of_day = '{part}'), 0)"
    f" / 60000.0::DOUBLE, 6) AS listening_time_{label}_{part}"
    for label, flag in (("weekday", "FALSE"), ("weekend", "TRUE"))
    for part in ("morning", "afternoon", "evening", "night")
)


def _window_counts(days: int) -> str:
    return (
        "count(*) AS total_plays, count(DISTINCT p.user_id) AS unique_listeners, "
        f"count(*) FILTER (p.played_at >= {AS_OF} - {days}) AS recent, "
        f"count(*) FILTER (p.played_at BETWEEN {AS_OF} - {2 * days} AND {AS_OF} - {days}) AS prev"
    )


_GROWTH = "CASE WHEN prev = 0 THEN 0.0 ELSE (recent - prev)::DOUBLE / prev * 100 END"


def _top_named(names: str, measure: str) -> str:
    keys = names.replace("t.name AS ", "").replace("a.name AS ", "")
    return f"""
        SELECT {names}, {measure} AS metric
        FROM plays p JOIN tracks t USING (track_id) JOIN artists a USING (artist_id)
        GROUP BY ALL ORDER BY metric DESC, {keys} LIMIT 10"""


def _check(name: str, violations: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, v AS violations, "
        f"CASE WHEN v = 0 THEN 'success' ELSE 'failure' END AS status FROM ({violations}) AS q(v)"
    )


def _unique(table: str, *columns: str) -> str:
    keys = ", ".join(columns)
    source = "plays" if table == "streaming_history" else table
    return _check(
        f"unique:{table}.{'+'.join(columns)}",
        f"SELECT count(*) FROM (SELECT {keys} FROM {source} GROUP BY {keys} HAVING count(*) > 1)",
    )


def _not_null(table: str, *columns: str) -> list[str]:
    source = "plays" if table == "streaming_history" else table
    return [
        _check(f"not_null:{table}.{c}", f"SELECT count(*) FROM {source} WHERE {c} IS NULL")
        for c in columns
    ]


def _fk(table: str, column: str, parent: str, condition: str = "TRUE") -> str:
    source = "plays" if table == "streaming_history" else table
    return _check(
        f"fk:{table}.{column}",
        f"SELECT count(*) FROM {source} x WHERE x.{column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parent} y WHERE y.{column} = x.{column} AND {condition})",
    )


def _range(table: str, source: str, column: str, condition: str) -> str:
    return _check(
        f"range:{table}.{column}", f"SELECT count(*) FROM {source} WHERE NOT ({condition})"
    )


_DQ_UNIQUE = [
    _unique("users", "user_id"),
    _unique("artists", "artist_id"),
    _unique("albums", "album_id"),
    _unique("tracks", "track_id"),
    _unique("tracks", "name"),
    _unique("streaming_history", "event_id"),
    _unique("playlist_tracks", "playlist_id", "track_id"),
]
_DQ_NOT_NULL = [
    *_not_null("users", "user_id", "username", "country"),
    *_not_null("tracks", "track_id", "name", "album_id", "artist_id"),
    *_not_null("streaming_history", "event_id", "user_id", "track_id", "played_at", "country"),
]
_DQ_FK = [
    _fk("albums", "artist_id", "artists"),
    _fk("tracks", "album_id", "albums"),
    _fk("tracks", "artist_id", "artists"),
    _fk("streaming_history", "user_id", "users"),
    _fk("streaming_history", "track_id", "tracks"),
    _fk("playlists", "user_id", "users"),
    _fk("playlist_tracks", "playlist_id", "playlists"),
    _fk("playlist_tracks", "track_id", "tracks"),
]
_DQ_OTHER = [
    _check(
        "rows_for_date:2024-01-29",
        f"SELECT CAST(count(*) = 0 AS BIGINT) FROM plays WHERE CAST(played_at AS DATE) = {AS_OF}",
    ),
    _check(
        "rows_for_date:2024-03-01",
        "SELECT CAST(count(*) = 0 AS BIGINT) FROM plays "
        "WHERE CAST(played_at AS DATE) = DATE '2024-03-01'",
    ),
    _check("min_rows:plays", "SELECT greatest(20 - count(*), 0) FROM plays"),
    _check("min_rows:tracks", "SELECT greatest(20 - count(*), 0) FROM tracks"),
]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _counts(tables: dict[str, str]) -> str:
    return _union(
        [
            f"SELECT '{name}' AS table_name, count(*) AS record_count FROM {source}"
            for name, source in tables.items()
        ]
    )


_TOTALS = """
    SELECT 'song_plays_count' AS metric, count(*) AS value FROM feed WHERE event_type = 'song_play'
    UNION ALL
    SELECT 'unique_users', count(DISTINCT user_id) FROM feed WHERE event_type <> 'error'
    UNION ALL
    SELECT 'unique_songs', count(DISTINCT k) FROM feed WHERE event_type = 'song_play'"""

_BY_PLATFORM = "SELECT platform, count(*) AS events FROM feed GROUP BY 1"

_USER_DAILY_FULL = f"""
    SELECT x.date, x.user_id, x.total_tracks, x.total_time_ms,
           round(x.total_time_ms / x.total_tracks, 6) AS avg_track_duration,
           x.morning_tracks, x.afternoon_tracks, x.evening_tracks, x.night_tracks,
           x.weekday_tracks, x.weekend_tracks, x.distinct_artists, fa.artist_id AS top_artist_id,
           fg.genre AS top_genre, x.explicit_tracks, round(x.completion_rate, 6) AS completion_rate,
           x.date AS process_date
    FROM (SELECT date, user_id, count(*) AS total_tracks,
                 CAST(sum(ms_played) AS BIGINT) AS total_time_ms, {_DAYPART_COUNTS['tracks']},
                 count(*) FILTER (NOT is_weekend) AS weekday_tracks,
                 count(*) FILTER (is_weekend) AS weekend_tracks,
                 count(DISTINCT artist_id) AS distinct_artists,
                 count(*) FILTER (explicit) AS explicit_tracks, avg(completion) AS completion_rate
          FROM (SELECT *, {_daypart('hour(played_at)')} AS time_of_day,
                       isodow(played_at) >= 6 AS is_weekend FROM timed)
          GROUP BY date, user_id) x
    LEFT JOIN fav_artist_day fa USING (date, user_id)
    LEFT JOIN fav_genre_day fg USING (date, user_id)"""

_TRACK_DAILY_FULL = f"""
    SELECT date, track_id, any_value(song_name) AS track_name, any_value(artist_id) AS artist_id,
           any_value(artist_name) AS artist_name, count(*) AS total_streams,
           count(DISTINCT user_id) AS unique_listeners,
           CAST(sum(ms_played) AS BIGINT) AS total_time_ms,
           round(avg(completion), 6) AS avg_completion_rate,
           round(avg(CASE WHEN skipped THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS skip_rate,
           {_DAYPART_COUNTS['streams']},
           count(*) FILTER (NOT is_weekend) AS weekday_streams,
           count(*) FILTER (is_weekend) AS weekend_streams, date AS process_date
    FROM (SELECT *, {_daypart('hour(played_at)')} AS time_of_day,
                 isodow(played_at) >= 6 AS is_weekend FROM timed)
    GROUP BY date, track_id"""


def _invariants() -> str:
    user = f"({_USER_DAILY_FULL})"
    track = f"({_TRACK_DAILY_FULL})"
    checks = {
        "user_daily:dayparts_sum": (
            user,
            "morning_tracks + afternoon_tracks + evening_tracks + night_tracks <> total_tracks",
        ),
        "user_daily:weekdays_sum": (user, "weekday_tracks + weekend_tracks <> total_tracks"),
        "user_daily:completion_rate_bounds": (user, "completion_rate NOT BETWEEN 0 AND 1"),
        "user_daily:date_present": (user, "date IS NULL"),
        "track_daily:listeners_le_streams": (track, "unique_listeners > total_streams"),
        "track_daily:completion_bounds": (track, "avg_completion_rate NOT BETWEEN 0 AND 1"),
        "track_daily:skip_bounds": (track, "skip_rate NOT BETWEEN 0 AND 1"),
        "track_daily:dayparts_sum": (
            track,
            "morning_streams + afternoon_streams + evening_streams + night_streams"
            " <> total_streams",
        ),
        "track_daily:weekdays_sum": (track, "weekday_streams + weekend_streams <> total_streams"),
    }
    return _union(
        [
            _check(name, f"SELECT count(*) FROM {source} WHERE {condition}")
            for name, (source, condition) in checks.items()
        ]
    )


def _active(day: str) -> str:
    """The six columns of one day, as scalar subqueries over ``day``."""
    active = "SELECT count(DISTINCT user_id) FROM plays WHERE CAST(played_at AS DATE) BETWEEN"
    return f"""
        {day} AS date,
        ({active} {day} AND {day}) AS count,
        ({active} CAST(date_trunc('week', {day}) AS DATE) AND {day}) AS weekly_active_count,
        ({active} CAST(date_trunc('month', {day}) AS DATE) AND {day}) AS monthly_active_count,
        (SELECT count(*) FROM users WHERE registered_on = {day}) AS new_users_count"""


_ACTIVE_RANGE = """
    WITH days AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-05', TIMESTAMP '2024-02-03',
                                                     INTERVAL 1 DAY)) AS DATE) AS d),
         seen AS (SELECT DISTINCT user_id, CAST(played_at AS DATE) AS a FROM plays)
    SELECT d AS date,
           count(DISTINCT user_id) FILTER (a = d) AS count,
           count(DISTINCT user_id) FILTER (a BETWEEN date_trunc('week', d) AND d)
             AS weekly_active_count,
           count(DISTINCT user_id) FILTER (a BETWEEN date_trunc('month', d) AND d)
             AS monthly_active_count,
           (SELECT count(*) FROM users WHERE registered_on = d) AS new_users_count,
           count(DISTINCT user_id) FILTER (a BETWEEN d - 30 AND d - 1)
             - count(DISTINCT user_id) FILTER (a BETWEEN d - 30 AND d - 1 AND back) AS churn_count
    FROM (SELECT days.d, s.user_id, s.a, EXISTS (SELECT 1 FROM seen t WHERE t.user_id = s.user_id
                                                 AND t.a = days.d) AS back
          FROM days LEFT JOIN seen s ON s.a BETWEEN days.d - 62 AND days.d)
    GROUP BY d"""

# The dayparts of the listening patterns by first hour, in order of precedence on
# ties (the last one first), and the labels of the reports.
_DAYPART_LABELS = {
    "1": "Morning (5AM-11AM)",
    "2": "Afternoon (12PM-5PM)",
    "3": "Evening (6PM-11PM)",
    "4": "Night (12AM-4AM)",
}
_WEEK_LABELS = ("Weekday Listener", "Weekend Listener")
_LISTENER_LABELS = ("Heavy Listener", "Regular Listener", "Casual Listener", "Mixed Pattern")
_TREND_LABELS = ("New", "Trending Up", "Falling", "Stable")

_PATTERNS = f"""
    WITH grain AS MATERIALIZED (
      SELECT user_id, session_id, track_id, played_at::DATE AS at_day, hour_of_day AS at_hour,
             day_of_week IN (0, 6) AS off, count(*) AS n, sum(ms_played) AS ms,
             sum(completion_rate) AS done, count(completion_rate) AS n_done
      FROM history WHERE played_at >= {AS_OF} - 30 GROUP BY ALL),
    best_part AS (
      SELECT user_id, part FROM (
        SELECT user_id, at_hour, sum(n) AS n,
               CASE WHEN at_hour < 5 THEN 4 WHEN at_hour < 12 THEN 1
                    WHEN at_hour < 18 THEN 2 ELSE 3 END AS part
        FROM grain GROUP BY user_id, at_hour)
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, part DESC) = 1),
    liked AS (
      SELECT user_id, array_to_string(list_transform(
               list(struct_pack(n := -genre_plays, g := genre) ORDER BY genre_plays DESC, genre)[1:3],
               lambda x: x.g || ' (' || -x.n || ')'), ', ') AS top_genres
      FROM user_genres GROUP BY user_id),
    sat AS (
      SELECT user_id, count(*) AS total_sessions, sum(n * minutes) / sum(n) AS minutes,
             sum(n * n) / sum(n) AS songs
      FROM (SELECT user_id, session_id, sum(n) AS n, sum(ms) / 60000.0::DOUBLE AS minutes
            FROM grain WHERE session_id IS NOT NULL GROUP BY ALL)
      GROUP BY user_id),
    days AS (
      SELECT user_id, count(DISTINCT at_day) AS active_days,
             count(DISTINCT track_id) AS unique_tracks, sum(done) / sum(n_done) AS done,
             sum(CASE WHEN off THEN -n ELSE n END) > 0 AS works
      FROM grain GROUP BY user_id)
    SELECT user_id, username, country, subscription_type, active_days, unique_tracks,
           round(done * 100, 2) AS avg_completion_percentage,
           round(minutes, 2) AS avg_session_minutes, round(songs, 2) AS avg_tracks_per_session,
           coalesce(total_sessions, 0) AS total_sessions, top_genres,
           map({_list(list(_DAYPART_LABELS))}, {_list(list(_DAYPART_LABELS.values()))})[part::VARCHAR]
             AS preferred_time_of_day,
           {_list(list(_WEEK_LABELS))}[if(works, 1, 2)] AS weekday_weekend_preference,
           {_list(list(_LISTENER_LABELS))}[coalesce(list_position([
             minutes > 60 AND active_days > 20,
             minutes >= 30 AND minutes <= 60 AND active_days >= 10 AND active_days <= 20,
             minutes < 30 AND active_days < 10], TRUE), 4)] AS listener_type
    FROM days JOIN users USING (user_id) LEFT JOIN sat USING (user_id)
         LEFT JOIN best_part USING (user_id) LEFT JOIN liked USING (user_id)"""

_WEEKLY = f"""
    SELECT track_id, t.name AS track_name, a.name AS artist_name, al.name AS album_name,
           n AS play_count, listeners AS unique_listeners,
           round(ms / 60000.0::DOUBLE, 6) AS total_minutes_played,
           round(ms::DOUBLE / n / duration_ms * 100, 2) AS completion_percentage,
           round(skips / n * 100, 2) AS skip_percentage, round(score, 2) AS trending_score,
           n - n_before AS weekly_change,
           {_list(list(_TREND_LABELS))}[CASE WHEN n_before = 0 THEN 1 WHEN 2 * n >= 3 * n_before
             THEN 2 WHEN 10 * n <= 7 * n_before THEN 3 ELSE 4 END] AS trend_status
    FROM (SELECT track_id, count_if(fresh) AS n, count_if(NOT fresh) AS n_before,
                 count(DISTINCT if(fresh, user_id, NULL)) AS listeners,
                 sum(if(fresh, ms_played, 0)) AS ms, count_if(fresh AND skipped) AS skips
          FROM (SELECT *, played_at >= {AS_OF} - 7 AS fresh FROM plays
                WHERE played_at >= {AS_OF} - 14 AND played_at < {AS_OF})
          GROUP BY track_id) counted
    JOIN tracks t USING (track_id) JOIN artists a USING (artist_id) JOIN albums al USING (album_id),
    LATERAL (SELECT n * 0.4::DOUBLE + listeners * 0.3::DOUBLE
                    + ms::DOUBLE / n / duration_ms * 100 * 0.3::DOUBLE AS score)
    WHERE n > 0
    ORDER BY score DESC, track_id LIMIT 100"""

_STATS = """
    SELECT c.user_id, c.unique_tracks_played,
           round(c.total_minutes_played, 6) AS total_minutes_played, c.total_plays,
           fa.artist_id AS favorite_artist_id, fg.genre AS favorite_genre,
           d.active_days_last_month, round(d.avg_daily_minutes, 6) AS avg_daily_minutes,
           coalesce(s.streak, 0) AS listening_streak
    FROM (SELECT user_id, count(*) AS total_plays, count(DISTINCT track_id) AS unique_tracks_played,
                 sum(ms_played::DOUBLE / 60000.0) AS total_minutes_played
          FROM {plays} GROUP BY 1) c
    LEFT JOIN (SELECT user_id, artist_id FROM {plays} JOIN tracks USING (track_id)
               GROUP BY user_id, artist_id
               QUALIFY row_number() OVER (PARTITION BY user_id
                                          ORDER BY count(*) DESC, artist_id) = 1) fa
      USING (user_id)
    LEFT JOIN (SELECT user_id, genre FROM (
                 SELECT user_id, unnest(a.genres) AS genre FROM {plays} JOIN tracks USING (track_id)
                 JOIN artists a USING (artist_id))
               GROUP BY user_id, genre
               QUALIFY row_number() OVER (PARTITION BY user_id
                                          ORDER BY count(*) DESC, genre) = 1) fg
      USING (user_id)
    LEFT JOIN (SELECT user_id, count(DISTINCT activity_date) AS active_days_last_month,
                      avg(daily_minutes) AS avg_daily_minutes FROM {days} GROUP BY 1) d
      USING (user_id)
    LEFT JOIN (SELECT user_id, max(CASE WHEN is_current THEN streak_length ELSE 0 END) AS streak
               FROM {runs} GROUP BY 1) s USING (user_id)"""

_EARLY_DAYS = """(SELECT user_id, CAST(played_at AS DATE) AS activity_date,
      sum(ms_played::DOUBLE / 60000.0) AS daily_minutes
    FROM plays WHERE played_at >= DATE '2024-01-25' - 30 AND played_at < DATE '2024-01-25'
    GROUP BY ALL)"""
_EARLY_RUNS = f"""(SELECT user_id, count(*) AS streak_length,
      max(activity_date) = DATE '2024-01-24' AS is_current
    FROM (SELECT user_id, activity_date, activity_date - CAST(row_number() OVER (
            PARTITION BY user_id ORDER BY activity_date) AS INTEGER) AS island
          FROM {_EARLY_DAYS}) GROUP BY user_id, island)"""

_GENERATE = f"""
    WITH stored AS ({_STATS.format(
        plays="(SELECT * FROM plays WHERE played_at < DATE '2024-01-25')",
        days=_EARLY_DAYS,
        runs=_EARLY_RUNS,
    )}),
    fresh AS (
      SELECT user_id, count(DISTINCT track_id) AS unique_tracks_played,
             round(sum(ms_played) / 60000.0::DOUBLE, 6) AS total_minutes_played,
             count(*) AS total_plays
      FROM plays WHERE played_at >= {AS_OF} - 1 GROUP BY 1)
    SELECT user_id, coalesce(f.unique_tracks_played, s.unique_tracks_played) AS unique_tracks_played,
           coalesce(f.total_minutes_played, s.total_minutes_played) AS total_minutes_played,
           coalesce(f.total_plays, s.total_plays) AS total_plays, s.favorite_artist_id,
           s.favorite_genre, s.active_days_last_month, s.avg_daily_minutes, s.listening_streak
    FROM stored s FULL OUTER JOIN fresh f USING (user_id)"""

_FEATURES = f"""
    WITH flagged AS (
      SELECT *, {_daypart('hour(played_at)')} AS time_of_day, isodow(played_at) >= 6 AS is_weekend
      FROM plays),
    totals AS (
      SELECT user_id, {_FEATURE_TIMES}, count(*) AS n,
             count(DISTINCT track_id) AS tracks, count(*) FILTER (skipped) AS skips
      FROM flagged GROUP BY 1),
    genre AS (
      SELECT user_id, count(DISTINCT genre) AS genres, count(*) AS genre_plays FROM (
        SELECT user_id, unnest(a.genres) AS genre FROM plays JOIN tracks USING (track_id)
        JOIN artists a USING (artist_id)) GROUP BY 1),
    loyal AS (
      SELECT user_id, max(n) AS top_plays FROM (
        SELECT user_id, artist_id, count(*) AS n FROM plays JOIN tracks USING (track_id)
        GROUP BY ALL) GROUP BY 1)
    SELECT t.* EXCLUDE (n, tracks, skips),
           round(genres::DOUBLE / genre_plays, 6) AS genre_diversity,
           round(top_plays::DOUBLE / n, 6) AS artist_loyalty,
           round(tracks::DOUBLE / n, 6) AS track_discovery_rate,
           round(skips::DOUBLE / n, 6) AS skip_rate
    FROM totals t LEFT JOIN genre USING (user_id) LEFT JOIN loyal USING (user_id)"""


def _upsert_part(first: str, last: str) -> str:
    return f"SELECT * FROM habits WHERE date BETWEEN DATE '{first}' AND DATE '{last}'"


def _activity_by(source: str, dimension: str, grain: str) -> str:
    return f"""
        SELECT CAST(date_trunc('{grain}', played_at) AS DATE) AS period, {dimension},
               count(*) AS plays, count(DISTINCT user_id) AS active_users,
               round(sum(ms_played) / 60000.0::DOUBLE, 6) AS minutes
        FROM {source} GROUP BY ALL"""


_SQL: dict[str, str] = {
    "enrich_history": f"""
        SELECT * REPLACE (round(completion_ratio, 6) AS completion_ratio), {RUN_TS} AS processed_at
        FROM enriched""",
    "user_daily_stats": f"""
        SELECT e.*, fa.artist_id AS favorite_artist_id, fg.genre AS favorite_genre
        FROM (SELECT date, user_id, count(*) AS total_tracks,
                     CAST(coalesce(sum(ms_played), 0) AS BIGINT) AS total_time_ms,
                     round(coalesce(avg(ms_played), 0), 6) AS avg_track_duration_ms,
                     {_DAYPART_COUNTS['tracks']}
              FROM enriched GROUP BY date, user_id) e
        LEFT JOIN fav_artist_day fa USING (date, user_id)
        LEFT JOIN fav_genre_day fg USING (date, user_id)""",
    "user_daily_stats_ext": f"""
        SELECT e.*, f.country
        FROM (SELECT date, user_id, count(*) AS total_tracks,
                     CAST(sum(ms_played) AS BIGINT) AS total_time_ms,
                     round(sum(ms_played) / count(*), 6) AS avg_track_duration_ms,
                     count(DISTINCT track_id) AS unique_tracks, {_DAYPART_COUNTS['tracks']},
                     count(*) FILTER (skipped) AS skipped_tracks,
                     count(*) FILTER (NOT skipped) AS completed_tracks,
                     round(coalesce(avg(completion_ratio), 0), 6) AS avg_completion_rate
              FROM enriched GROUP BY date, user_id) e
        JOIN (SELECT date, user_id, country FROM enriched
              QUALIFY row_number() OVER (PARTITION BY date, user_id
                                         ORDER BY "timestamp", event_id) = 1) f
          USING (date, user_id)""",
    "track_daily_stats": """
        SELECT date, track_id, count(*) AS total_streams, count(DISTINCT user_id) AS unique_listeners,
               round(coalesce(avg(completion_ratio), 0), 6) AS avg_completion_rate,
               round(count(*) FILTER (skipped) / count(*), 6) AS skip_rate
        FROM enriched GROUP BY date, track_id""",
    "track_daily_stats_ext": """
        WITH by_country AS (
          SELECT date, track_id, country, count(*) AS n,
                 row_number() OVER (PARTITION BY date, track_id
                                    ORDER BY count(*) DESC, country) AS rk
          FROM enriched WHERE country IS NOT NULL GROUP BY date, track_id, country),
        top3 AS (
          SELECT date, track_id, string_agg(country || ':' || n, ',' ORDER BY rk) AS top_countries
          FROM by_country WHERE rk <= 3 GROUP BY date, track_id),
        peak AS (
          SELECT date, track_id, hour AS peak_hour FROM enriched GROUP BY date, track_id, hour
          QUALIFY row_number() OVER (PARTITION BY date, track_id ORDER BY count(*) DESC, hour) = 1)
        SELECT e.*, coalesce(top_countries, '') AS top_countries, peak_hour
        FROM (SELECT date, track_id, count(*) AS total_streams,
                     count(DISTINCT user_id) AS unique_listeners,
                     CAST(sum(ms_played) AS BIGINT) AS total_listening_time_ms,
                     round(coalesce(avg(completion_ratio), 0), 6) AS avg_completion_rate,
                     round(count(*) FILTER (skipped) / count(*), 6) AS skip_rate
              FROM enriched GROUP BY date, track_id) e
        LEFT JOIN top3 USING (date, track_id) LEFT JOIN peak USING (date, track_id)""",
    "song_daily_metrics": """
        SELECT s.* REPLACE (round(avg_ms_played, 6) AS avg_ms_played, round(skip_rate, 6) AS skip_rate,
                            round(avg_completion_rate, 6) AS avg_completion_rate),
               p.platforms, c.countries
        FROM song_daily s JOIN song_platforms p ON s.song_id = p.track_id AND s.date = p.date
             JOIN song_countries c ON s.song_id = c.track_id AND s.date = c.date""",
    "user_daily_metrics": """
        SELECT b.user_id, b.date, b.song_count, b.unique_songs, b.unique_artists,
               b.total_listening_time, a.top_artist, p.platforms
        FROM habits_base b JOIN habits_artist a USING (user_id, date)
        JOIN (SELECT user_id, date, string_agg(platform || ':' || n, ',' ORDER BY platform)
                AS platforms FROM habits_platforms GROUP BY ALL) p USING (user_id, date)
        WHERE b.date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'""",
    "allocate_song_metrics": f"""
        SELECT song_id, date, play_count, unique_listeners,
               round(avg_ms_played, 6) AS average_play_duration, round(skip_rate, 6) AS skip_rate,
               country, platform, {RUN_TS} AS created_at, {RUN_TS} AS updated_at
        FROM (
          SELECT s.song_id, s.date, s.avg_ms_played, s.skip_rate, c.country, p.platform,
                 CAST(c.n * p.n // s.play_count AS BIGINT) AS play_count,
                 CAST(s.unique_listeners * (c.n * p.n // s.play_count) // s.play_count AS BIGINT)
                   AS unique_listeners
          FROM song_daily s
          JOIN (SELECT track_id, date, country, count(*) AS n FROM ranged GROUP BY ALL) c
            ON c.track_id = s.song_id AND c.date = s.date
          JOIN (SELECT track_id, date, platform, count(*) AS n FROM ranged GROUP BY ALL) p
            ON p.track_id = s.song_id AND p.date = s.date)
        WHERE play_count > 0""",
    "user_listening_habits": f"""
        SELECT *, {RUN_TS} AS created_at, {RUN_TS} AS updated_at FROM habits
        WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'""",
    "user_daily_full": _USER_DAILY_FULL,
    "track_daily_full": _TRACK_DAILY_FULL,
    "active_users": f"""
        SELECT {_active(AS_OF)},
          (SELECT count(DISTINCT user_id) FROM plays
           WHERE CAST(played_at AS DATE) BETWEEN {AS_OF} - 30 AND {AS_OF} - 1
             AND user_id NOT IN (SELECT user_id FROM plays
                                 WHERE CAST(played_at AS DATE) = {AS_OF})) AS churn_count""",
    "active_users_range": _ACTIVE_RANGE,
    "new_users": f"SELECT user_id FROM users WHERE registered_on = {AS_OF}",
    "churned_users": f"""
        SELECT DISTINCT user_id FROM plays
        WHERE CAST(played_at AS DATE) BETWEEN {AS_OF} - 30 AND {AS_OF} - 1
          AND user_id NOT IN (SELECT user_id FROM plays WHERE CAST(played_at AS DATE) = {AS_OF})""",
    "user_activity_summary": """
        SELECT u.user_id, u.username, u.country, count(p.event_id) AS total_streams,
               count(DISTINCT p.track_id) AS unique_tracks,
               count(DISTINCT CAST(p.played_at AS DATE)) AS active_days,
               max(p.played_at) AS last_active
        FROM users u LEFT JOIN plays p USING (user_id)
        GROUP BY u.user_id, u.username, u.country""",
    "artist_popularity": f"""
        WITH counted AS (
          SELECT a.artist_id, a.name AS artist_name, {_window_counts(10)}
          FROM plays p JOIN tracks t USING (track_id) JOIN artists a USING (artist_id)
          GROUP BY ALL),
        best AS (
          SELECT t.artist_id, t.track_id, t.name AS track_name
          FROM plays p JOIN tracks t USING (track_id) GROUP BY t.artist_id, t.track_id, t.name
          QUALIFY row_number() OVER (PARTITION BY t.artist_id
                                     ORDER BY count(*) DESC, t.track_id) = 1)
        SELECT c.artist_id, artist_name, total_plays, unique_listeners,
               b.track_id AS most_popular_track, b.track_name AS most_popular_track_name,
               recent AS plays_last_30_days, prev AS plays_previous_30_days,
               round({_GROWTH}, 6) AS growth_percent,
               round(recent * 0.7::DOUBLE + ({_GROWTH}) * 0.3::DOUBLE, 6) AS trending_score,
               {RUN_TS} AS last_updated
        FROM counted c LEFT JOIN best b USING (artist_id)""",
    "track_popularity": f"""
        WITH counted AS (
          SELECT t.track_id, t.name AS track_name, a.artist_id, a.name AS artist_name,
                 {_window_counts(10)},
                 count(*) FILTER (p.skipped)::DOUBLE / count(*) AS skip_rate,
                 avg(p.ms_played::DOUBLE / t.duration_ms) AS completion
          FROM plays p JOIN tracks t USING (track_id) JOIN artists a USING (artist_id)
          GROUP BY ALL)
        SELECT track_id, track_name, artist_id, artist_name, total_plays, unique_listeners,
               round(skip_rate, 6) AS skip_rate, round(completion, 6) AS avg_completion_rate,
               recent AS plays_last_30_days, prev AS plays_previous_30_days,
               round({_GROWTH}, 6) AS growth_percent,
               round(recent * 0.6::DOUBLE + (1 - skip_rate) * 100 * 0.2::DOUBLE
                     + completion * 100 * 0.2::DOUBLE, 6) AS trending_score,
               {RUN_TS} AS last_updated
        FROM counted""",
    "user_listening_stats": f"""
        SELECT *, {RUN_TS} AS last_updated
        FROM ({_STATS.format(plays='plays', days='listening_days', runs='runs')})""",
    "listening_streaks": "SELECT * FROM runs",
    "upkeep_streaks": "SELECT * FROM runs",
    "upkeep_active_users": _ACTIVE_RANGE,
    "upkeep_user_stats": f"""
        SELECT *, {RUN_TS} AS last_updated
        FROM ({_STATS.format(plays='plays', days='listening_days', runs='runs')})""",
    "top_tracks_weekly": _WEEKLY,
    "user_listening_patterns": _PATTERNS,
    "genre_preferences": "SELECT * FROM user_genres",
    "hour_share": f"""
        SELECT user_id, hour_of_day, count(*) AS hour_plays,
               round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY user_id), 6)
                 AS hour_percentage
        FROM history WHERE played_at >= {AS_OF} - 30 GROUP BY user_id, hour_of_day""",
    "day_share": f"""
        SELECT user_id, day_of_week, count(*) AS day_plays,
               round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY user_id), 6)
                 AS day_percentage
        FROM history WHERE played_at >= {AS_OF} - 30 GROUP BY user_id, day_of_week""",
    "session_stats": """
        SELECT user_id, session_id, min(played_at) AS session_start, max(played_at) AS session_end,
               count(*) AS tracks_in_session,
               round(sum(ms_played) / 60000.0::DOUBLE, 6) AS session_minutes,
               round(avg(completion_rate), 6) AS avg_completion_rate
        FROM history GROUP BY user_id, session_id""",
    "sessionize_gap": """
        SELECT user_id, session_no, min(played_at) AS session_start, max(played_at) AS session_end,
               count(*) AS tracks_in_session,
               round(sum(ms_played) / 60000.0::DOUBLE, 6) AS session_minutes
        FROM numbered GROUP BY user_id, session_no""",
    "sessionize_plays": "SELECT * FROM numbered",
    "top_artists_plays": _top_named("a.name AS artist_name", "count(*)"),
    "top_artists_listeners": _top_named("a.name AS artist_name", "count(DISTINCT user_id)"),
    "top_tracks_plays": _top_named("t.name AS track_name, a.name AS artist_name", "count(*)"),
    "top_tracks_listeners": _top_named(
        "t.name AS track_name, a.name AS artist_name", "count(DISTINCT user_id)"
    ),
    "daily_activity": """
        SELECT CAST(played_at AS DATE) AS date, count(*) AS play_count FROM plays GROUP BY 1""",
    "daily_activity_range": """
        SELECT CAST(played_at AS DATE) AS date, count(*) AS play_count FROM plays
        WHERE CAST(played_at AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-16' GROUP BY 1""",
    "hourly_distribution": """
        WITH spine AS (SELECT CAST(h AS INTEGER) AS hour FROM range(24) AS r(h)),
        counted AS (SELECT hour(played_at) AS hour, count(*) AS n FROM plays GROUP BY 1),
        filled AS (SELECT s.hour, coalesce(c.n, 0) AS play_count
                   FROM spine s LEFT JOIN counted c ON c.hour = s.hour)
        SELECT hour, play_count,
               CASE WHEN hour BETWEEN 1 AND 22 THEN
                 round(avg(play_count) OVER (ORDER BY hour ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING),
                       6) END AS trend
        FROM filled""",
    "top_tracks_daily": """
        SELECT date, track_id, count(*) AS total_streams, count(DISTINCT user_id) AS unique_listeners,
               row_number() OVER (PARTITION BY date ORDER BY count(*) DESC, track_id) AS rank
        FROM enriched GROUP BY date, track_id""",
    "top_artists_daily": """
        SELECT date, artist_id, count(*) AS total_streams,
               count(DISTINCT user_id) AS unique_listeners,
               row_number() OVER (PARTITION BY date ORDER BY count(*) DESC, artist_id) AS rank
        FROM enriched JOIN tracks USING (track_id) GROUP BY date, artist_id""",
    "hourly_trends": """
        WITH genre AS (
          SELECT h, genre, count(*) AS n FROM (
            SELECT hour(played_at) AS h, unnest(a.genres) AS genre
            FROM plays JOIN tracks USING (track_id) JOIN artists a USING (artist_id))
          GROUP BY h, genre
          QUALIFY row_number() OVER (PARTITION BY h ORDER BY count(*) DESC, genre) = 1)
        SELECT CAST(hour(played_at) AS INTEGER) AS hour_of_day, count(*) AS total_plays,
               count(DISTINCT user_id) AS unique_listeners,
               any_value(genre) AS most_played_genre
        FROM plays LEFT JOIN genre ON h = hour(played_at) GROUP BY 1""",
    "user_features": _FEATURES,
    "activity_by_subscription": _activity_by("history", "subscription_type", "week"),
    "activity_by_country": _activity_by("history", "country", "month"),
    "activity_by_device": _activity_by("plays", "device", "day"),
    "monthly_active_users": """
        SELECT CAST(date_trunc('month', played_at) AS DATE) AS month,
               count(DISTINCT user_id) AS active_users
        FROM plays GROUP BY 1""",
    "extract_history": f"""
        SELECT p.event_id, p.user_id, p.track_id, t.artist_id, p.played_at, p.ms_played,
               t.name AS track_name, a.name AS artist_name,
               p.ms_played >= t.duration_ms * 0.9::DOUBLE AS completed, t.duration_ms, t.explicit,
               t.popularity AS track_popularity, array_to_string(a.genres, ',') AS genres,
               a.popularity AS artist_popularity
        FROM plays p JOIN tracks t USING (track_id) JOIN artists a USING (artist_id)
        WHERE CAST(p.played_at AS DATE) = {AS_OF}""",
    "extract_tracks": """
        SELECT t.track_id, t.name AS track_name, t.artist_id, a.name AS artist_name, t.album_id,
               al.name AS album_name, t.duration_ms, t.explicit, t.track_number, t.disc_number,
               t.popularity, t.release_date, array_to_string(a.genres, ',') AS genres,
               a.popularity AS artist_popularity, al.total_tracks, al.album_type
        FROM tracks t JOIN artists a USING (artist_id) JOIN albums al USING (album_id)""",
    "extract_active_users": """
        SELECT user_id, username, email, country, birthdate, gender, subscription_type,
               registered_on AS registration_date, is_active AS active, last_active AS last_login
        FROM users WHERE is_active""",
    "incremental_extract": f"""
        SELECT event_id, user_id, track_id, played_at, ms_played, reason_start, reason_end, shuffle,
               skipped, platform, country, {AS_OF} AS processed_date
        FROM plays WHERE CAST(played_at AS DATE) = {AS_OF} - 1
          AND played_at >= TIMESTAMP '2024-01-28 12:00:00'""",
    "processed_history": f"""
        SELECT * REPLACE (round(completion_rate, 6) AS completion_rate), {RUN_TS} AS processed_at
        FROM history""",
    "lookup_with_default": """
        SELECT p.event_id, p.track_id, p.ms_played, coalesce(t.name, 'Unknown') AS track_name,
               coalesce(a.name, 'Unknown') AS artist_name, coalesce(al.name, 'Unknown') AS album_name,
               coalesce(t.duration_ms, 0) AS duration_ms,
               coalesce(t.popularity, 0) AS track_popularity,
               round(CASE WHEN t.duration_ms > 0
                     THEN least(1.0::DOUBLE, p.ms_played::DOUBLE / t.duration_ms) ELSE 0.0 END, 6)
                 AS completion_rate
        FROM plays p
        LEFT JOIN tracks t ON t.track_id = p.track_id
        LEFT JOIN artists a ON a.artist_id = t.artist_id
        LEFT JOIN albums al ON al.album_id = t.album_id""",
    "upsert_result": f"""
        SELECT h.*,
               CASE WHEN date <= DATE '2024-01-14' THEN TIMESTAMP '2024-01-15'
                    ELSE TIMESTAMP '2024-01-17' END AS created_at,
               CASE WHEN date < DATE '2024-01-13' THEN TIMESTAMP '2024-01-15'
                    ELSE TIMESTAMP '2024-01-17' END AS updated_at
        FROM ({_upsert_part('2024-01-10', '2024-01-16')}) h""",
    "insert_new_result": """
        SELECT event_id, user_id, track_id, played_at FROM plays
        WHERE played_at >= DATE '2024-01-15'""",
    "upsert_counters": f"""
        SELECT metric_type, entity_id, count(*) AS count,
               CASE WHEN max(ts) >= DATE '2024-01-16' THEN {RUN_TS}
                    ELSE TIMESTAMP '2024-01-16' END AS last_updated
        FROM counter_events GROUP BY metric_type, entity_id""",
    "generate_analytics": _GENERATE,
    "snapshot_scd2": f"""
        SELECT user_id, username, country, subscription_type, TIMESTAMP '2024-01-01' AS valid_from,
               CASE WHEN user_id % 7 = 0 THEN {RUN_TS} END AS valid_to
        FROM users
        UNION ALL
        SELECT user_id, username, country, 'PREMIUM', {RUN_TS}, NULL FROM users
        WHERE user_id % 7 = 0""",
    "events_by_platform": _BY_PLATFORM,
    "search_counts": """
        SELECT search_query, count(*) AS searches FROM feed WHERE event_type = 'search' GROUP BY 1""",
    "search_terms_top": """
        SELECT search_query, count(*) AS searches FROM feed WHERE event_type = 'search' GROUP BY 1
        ORDER BY searches DESC, search_query LIMIT 5""",
    "errors_by_type": """
        SELECT error_type, count(*) AS errors FROM feed WHERE event_type = 'error' GROUP BY 1""",
    "running_totals": _TOTALS,
    "auth_failure_rate": """
        SELECT 'password' AS auth_type, count(*) AS attempts,
               count(*) FILTER (NOT success) AS failures,
               round(count(*) FILTER (NOT success) / count(*), 6) AS failure_rate
        FROM feed WHERE event_type = 'auth'""",
    "playlist_action_counts": """
        SELECT action_type, count(*) AS actions FROM feed WHERE event_type = 'playlist' GROUP BY 1""",
    "project_song_play": """
        SELECT event_id, user_id, k AS song_id, ts AS "timestamp", NULL::VARCHAR AS session_id,
               platform, ms_played, '' AS user_agent, '' AS device_type,
               '{"country":"' || country || '"}' AS location, '' AS network_type, '' AS ip_address
        FROM feed WHERE event_type = 'song_play'""",
    "project_auth": """
        SELECT event_id, user_id, ts AS "timestamp", 'password' AS auth_type, success,
               '' AS ip_address, '' AS user_agent, country
        FROM feed WHERE event_type = 'auth'""",
    "project_search": """
        SELECT event_id, user_id, ts AS "timestamp", search_query, result_count, platform,
               '' AS user_agent
        FROM feed WHERE event_type = 'search'""",
    "project_playlist": """
        SELECT event_id, user_id, playlist_id, ts AS "timestamp", action_type,
               CASE WHEN action_type IN ('add_song', 'remove_song') THEN k END AS song_id, platform
        FROM feed WHERE event_type = 'playlist'""",
    "project_error": """
        SELECT event_id AS error_id, platform AS service, error_type AS error_code,
               'request failed' AS error_message, ts AS "timestamp"
        FROM feed WHERE event_type = 'error'""",
    "stream_running_totals": _TOTALS,
    "stream_events_by_platform": _BY_PLATFORM,
    "stream_route_counts": """
        SELECT CASE event_type WHEN 'song_play' THEN 'song_plays' WHEN 'auth' THEN 'auth_events'
                 WHEN 'search' THEN 'search_events' WHEN 'playlist' THEN 'playlist_events'
                 ELSE 'system_errors' END AS table_name, count(*) AS rows
        FROM feed GROUP BY 1""",
    "stream_sessions": """
        SELECT * FROM all_sessions""",
    "stream_sessions_late": """
        SELECT * FROM all_sessions""",
    "stream_late_plays": """
        SELECT user_id, count(*) FILTER (NOT is_late) AS in_sessions,
               count(*) FILTER (is_late) AS late
        FROM (SELECT user_id, event_id % 3 = 0 AND played_at <
                     (SELECT max(played_at) FROM plays WHERE event_id % 3 <> 0)
                     - INTERVAL 10 MINUTE AS is_late
              FROM plays)
        GROUP BY user_id""",
    "stream_dedupe": """
        SELECT CASE event_type WHEN 'song_play' THEN 'song_plays' WHEN 'auth' THEN 'auth_events'
                 WHEN 'search' THEN 'search_events' WHEN 'playlist' THEN 'playlist_events'
                 ELSE 'system_errors' END AS table_name, count(*) AS record_count
        FROM feed GROUP BY 1""",
    "stream_ingest_accounting": """
        SELECT CASE event_type WHEN 'song_play' THEN 'song_plays' WHEN 'auth' THEN 'auth_events'
                 WHEN 'search' THEN 'search_events' WHEN 'playlist' THEN 'playlist_events'
                 ELSE 'system_errors' END AS table_name, count(*) AS record_count
        FROM feed GROUP BY 1
        UNION ALL SELECT 'quarantine', count(*) FROM feed""",
    "stream_counters": """
        SELECT metric_type, entity_id, count(*) AS count FROM counter_events
        WHERE entity_id IS NOT NULL GROUP BY ALL""",
    "stream_report": """
        SELECT 'totals' AS section, 'song_plays_count' AS key, count(*) AS value
        FROM feed WHERE event_type = 'song_play'
        UNION ALL SELECT 'totals', 'unique_users', count(DISTINCT user_id)
        FROM feed WHERE event_type <> 'error'
        UNION ALL SELECT 'totals', 'unique_songs', count(DISTINCT k)
        FROM feed WHERE event_type = 'song_play'
        UNION ALL SELECT * FROM (SELECT 'platforms', platform, count(*) FROM feed
                                 GROUP BY platform ORDER BY 3 DESC, 2 LIMIT 5)
        UNION ALL SELECT * FROM (SELECT 'searches', search_query, count(*) FROM feed
                                 WHERE event_type = 'search'
                                 GROUP BY search_query ORDER BY 3 DESC, 2 LIMIT 5)
        UNION ALL SELECT 'errors', error_type, count(*) FROM feed
        WHERE event_type = 'error' GROUP BY error_type""",
    "play_locations": """
        SELECT event_id, country, 'unknown' AS city FROM feed WHERE event_type = 'song_play'""",
    "sink_partitioned": "SELECT event_id, user_id, ms_played, played_at, date FROM dated",
    "sink_upsert_partitions": """
        SELECT event_id, user_id, played_at, date, ms_played
               + CASE WHEN date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' THEN 1 ELSE 0 END
                 AS ms_played
        FROM dated""",
    "sink_append_new": "SELECT event_id, user_id, ms_played, played_at, date FROM dated",
    "sink_staging": """
        SELECT event_id, user_id, ms_played, played_at, date, date AS process_date FROM dated""",
    "sink_versions": "SELECT user_id, username, country || '!' AS country FROM users",
    "sink_insert_new": """
        SELECT event_id, user_id, played_at,
               CASE WHEN ms_played >= 30000 THEN ms_played ELSE -ms_played END AS ms_played
        FROM dated""",
    "split_scan": """
        SELECT count(*) AS n_rows, 0::BIGINT AS not_in_one_range, TRUE AS balanced FROM lineitem""",
    "sink_keyed": """
        SELECT event_id, user_id, played_at, ms_played
               + CASE WHEN date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' THEN 1 ELSE 0 END
                 AS ms_played
        FROM dated
        UNION ALL SELECT -event_id - 1, user_id, played_at, ms_played FROM dated""",
    "files_json": """
        SELECT user_id, username, country, NULL::VARCHAR AS _corrupt_record FROM users""",
    "table_counts": _counts(
        {
            "raw.users": "users",
            "raw.artists": "artists",
            "raw.albums": "albums",
            "raw.tracks": "tracks",
            "raw.playlists": "playlists",
            "raw.playlist_tracks": "playlist_tracks",
            "raw.streaming_history": "plays",
        }
    ),
    "dq_unique": _union(_DQ_UNIQUE),
    "dq_not_null": _union(_DQ_NOT_NULL),
    "dq_fk": _union(_DQ_FK),
    "dq_range": _union(
        [
            _range("tracks", "tracks", "duration_ms", "duration_ms >= 1"),
            _range("tracks", "tracks", "popularity", "popularity BETWEEN 0 AND 100"),
            _range("tracks", "tracks", "track_number", "track_number BETWEEN 1 AND 40"),
            _range("processed", "history", "ms_played", "ms_played >= 0"),
            _range("processed", "history", "completion_rate", "completion_rate BETWEEN 0 AND 1"),
            _range("processed", "history", "day_of_week", "day_of_week BETWEEN 0 AND 6"),
            _range("processed", "history", "hour_of_day", "hour_of_day BETWEEN 0 AND 23"),
            _check(
                "in:streaming_history.platform",
                "SELECT count(*) FROM plays WHERE platform NOT IN ('android', 'ios', 'web')",
            ),
        ]
    ),
    "dq_invariants": _invariants(),
    "dq_checks": _union([*_DQ_UNIQUE, *_DQ_NOT_NULL, *_DQ_FK, *_DQ_OTHER]),
    "dq_observed": _union(
        [
            *_DQ_NOT_NULL,
            *_DQ_OTHER,
            _check(
                "in:streaming_history.platform",
                "SELECT count(*) FROM plays WHERE platform NOT IN ('android', 'ios', 'web')",
            ),
            _range("streaming_history", "plays", "ms_played", "ms_played >= 0"),
            _range("tracks", "tracks", "popularity", "popularity BETWEEN 0 AND 100"),
        ]
    ),
    "dq_report": f"""
        SELECT count(*) AS total_checks, count(*) FILTER (status = 'success') AS passed_checks,
               round(count(*) FILTER (status = 'success') * 100.0::DOUBLE / count(*), 6)
                 AS success_rate
        FROM ({_union([*_DQ_UNIQUE, *_DQ_NOT_NULL, *_DQ_FK, *_DQ_OTHER])})""",
    "gap_days": """
        SELECT d AS date FROM (
          SELECT CAST(unnest(generate_series(TIMESTAMP '2023-12-25', TIMESTAMP '2024-02-05',
                                             INTERVAL 1 DAY)) AS DATE) AS d)
        WHERE d NOT IN (SELECT CAST(played_at AS DATE) FROM plays)""",
    "duplicates": """
        SELECT playlist_id, track_id, count(*) AS rows FROM playlist_tracks
        GROUP BY playlist_id, track_id HAVING count(*) > 1""",
}


def _decimal_rounding(sql: str) -> str:
    """Round through DECIMAL, so that ties such as 4.225 go up as they do in Spark."""
    out, rest = "", sql
    while (found := re.search(r"\bround\(", rest)) is not None:
        depth, end = 1, found.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(rest[end], 0)
            end += 1
        value, digits = rest[found.end() : end - 1].rsplit(",", 1)
        rounded = f"CAST(ROUND(CAST({_decimal_rounding(value)} AS DECIMAL(28, 9)),{digits}) AS DOUBLE)"
        out, rest = out + rest[: found.start()] + rounded, rest[end:]
    return out + rest


def _with_tables(sql: str) -> str:
    """Prefix the common table expressions that ``sql`` needs, directly or through others."""
    needed: set[str] = set()
    pending = [sql]
    while pending:
        text = pending.pop()
        for name, body in _TABLES.items():
            if name not in needed and re.search(rf"(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                pending.append(body)
    parts = [f"{name} AS ({body})" for name, body in _TABLES.items() if name in needed]
    prefix = f"WITH {', '.join(parts)}\n" if parts else ""
    return f"{prefix}SELECT * FROM ({sql}) AS result"


def oracle_sql() -> dict[str, str]:
    return {name: _decimal_rounding(_with_tables(sql)) for name, sql in _SQL.items()}

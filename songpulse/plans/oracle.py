"""DuckDB SQL for every registered query, over the driver's tables as views.

The fixtures and operators are restated in plain SQL (RE2 regular expressions, window
functions for the arg-max steps) so that the two engines are independent implementations.
"""

from __future__ import annotations

import re

from songpulse.functions.text import NON_BLANK_RUN, PY2_WHITESPACE
from songpulse.sources.fixtures import PROCESSED_BEFORE

WS = "(" + " || ".join(f"chr({ord(c)})" for c in PY2_WHITESPACE) + ")"
# RE2 has no UNIX_LINES flag; its "." already excludes only "\n".
# The extraction cascade, as the original program has it.
RE2_PATTERNS = [
    r"(?i)#nowplaying(.*.)by(.*?)from",
    r"(?i)#nowplaying(.*.)-(.*.)",
    r"(?i)#nowplaying(.*.)by(.*.)",
    r"(?i)(.*.)-(.*.)#nowplaying",
]


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def tokens(x: str) -> str:
    y = f"regexp_replace({x}, '#{NON_BLANK_RUN}', '', 'g')"
    y = f"replace({y}, chr(0), '000')"
    y = f"translate({y}, '\\''\"$?-', '')"
    y = strip(y)
    y = f"regexp_replace({y}, 'http{NON_BLANK_RUN}', '', 'g')"
    y = f"regexp_replace({y}, '@{NON_BLANK_RUN}', '', 'g')"
    return strip(y)


def lookup_key(a: str, s: str) -> str:
    joined = f"coalesce({strip(a)}, '') || ' ' || coalesce({strip(s)}, '')"
    return f"lower({strip(joined)})"


def hour_label(t: str) -> str:
    return f"strftime(make_timestamp(CAST({t} AS BIGINT) * 1000000), '%d %b %Y-%H')"


def hour_start(t: str) -> str:
    return f"CAST(CAST({t} AS BIGINT) - (CAST({t} AS BIGINT) % 3600 + 3600) % 3600 AS INTEGER)"


def _cascade(group: int) -> str:
    whens = " ".join(
        f"WHEN regexp_matches(raw_tweet, '{p}') THEN regexp_extract(raw_tweet, '{p}', {group})"
        for p in RE2_PATTERNS
    )
    return f"CASE {whens} ELSE '' END"


CATALOG = """catalog AS (
  SELECT p_partkey AS track_id, p_name AS song, replace(p_brand, '#', ' ') AS artist,
         p_type AS genre, p_retailprice AS popularity
  FROM part)"""

TWEETS = """tweets AS (
  SELECT e.event_id, e.user_id, e.ts,
    CASE (e.event_id + e.event_id // (SELECT count(*) FROM part)) % 8
      WHEN 0 THEN '#nowplaying ' || p.p_name || ' by ' || replace(p.p_brand, '#', ' ')
                  || ' from Radio http://t.co/x' || CAST(e.event_id AS VARCHAR)
      WHEN 1 THEN '#NowPlaying ' || p.p_name || ' - ' || replace(p.p_brand, '#', ' ') || ' #music'
      WHEN 2 THEN '#nowplaying ' || p.p_name || ' by ' || replace(p.p_brand, '#', ' ')
      WHEN 3 THEN p.p_name || ' - ' || replace(p.p_brand, '#', ' ') || ' #NOWPLAYING'
      WHEN 4 THEN 'I love ' || p.p_name || ' @dj' || CASE WHEN e.event_id % 3 = 0 THEN '' ELSE ' #nowplaying' END
      WHEN 5 THEN '#nowplaying ' || p.p_name || ' by from x'
      WHEN 6 THEN '#nowplaying ' || p.p_name || ' by Unknown Artist'
      ELSE '#nowplaying Wrong Title by ' || replace(p.p_brand, '#', ' ')
    END AS raw_tweet,
    CAST(floor(epoch(e.ts)) AS INTEGER) AS tweet_time
  FROM events e JOIN part p ON p.p_partkey = e.event_id % (SELECT count(*) FROM part))"""

EXTRACTED = f"""extracted AS (
  SELECT *, {_cascade(1)} AS song_raw, {_cascade(2)} AS artist_raw FROM tweets)"""

CLEANED = f"""cleaned_ids AS (
  SELECT event_id, user_id, raw_tweet, {tokens('raw_tweet')} AS processed_tweet,
         {tokens('song_raw')} AS song, {tokens('artist_raw')} AS artist, tweet_time
  FROM extracted),
cleaned AS (SELECT raw_tweet, processed_tweet, song, artist, tweet_time FROM cleaned_ids)"""

HITS = f"""hits AS (
  SELECT key, artist, song, genre, track_id, popularity FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY popularity DESC, track_id) AS rn
    FROM (SELECT *, {lookup_key('artist', 'song')} AS key FROM catalog))
  WHERE rn = 1),
song_hits AS (
  SELECT song_key, artist, song, genre, track_id FROM (
    SELECT *, row_number() OVER (PARTITION BY song_key ORDER BY popularity DESC, track_id) AS rn
    FROM (SELECT *, lower({strip('song')}) AS song_key FROM catalog))
  WHERE rn = 1),
artist_tracks AS (
  SELECT artist_key, artist, song, track_id, genre AS own_genre FROM (
    SELECT *, row_number() OVER (PARTITION BY artist_key ORDER BY popularity DESC, track_id) AS rn
    FROM (SELECT *, lower({strip('artist')}) AS artist_key FROM catalog))
  WHERE rn = 1),
artist_genres AS (
  SELECT artist_key, genre FROM (
    SELECT artist_key, genre, row_number() OVER (PARTITION BY artist_key ORDER BY n DESC, genre) AS rn
    FROM (SELECT lower({strip('artist')}) AS artist_key, genre, count(*) AS n
          FROM catalog GROUP BY 1, 2))
  WHERE rn = 1),
tops AS (
  SELECT t.artist_key, t.artist, t.song, g.genre, t.own_genre, t.track_id
  FROM artist_tracks t JOIN artist_genres g USING (artist_key))"""


def resolve(src: str, a: str, s: str, with_song_only: bool) -> str:
    """SQL resolving requests from ``src`` with artist/song expressions ``a``, ``s``; adds
    res_artist, res_song, res_genre, res_track_id (NULL when unresolved)."""
    sa, ss = f"coalesce({strip(a)}, '')", f"coalesce({strip(s)}, '')"
    song_join = (
        f"LEFT JOIN song_hits sh ON sh.song_key = CASE WHEN r._a = '' AND r._s <> '' THEN lower(r._s) END"
        if with_song_only
        else "LEFT JOIN (SELECT NULL::VARCHAR AS song_key, NULL::VARCHAR AS artist, NULL::VARCHAR AS song, "
        "NULL::VARCHAR AS genre, NULL::BIGINT AS track_id) sh ON false"
    )

    def pick(c: str) -> str:
        # Artist only: the hit's own genre; the artist's main genre belongs to the fallback.
        top = "CASE WHEN r._s = '' THEN tp.own_genre ELSE tp.genre END" if c == "genre" else f"tp.{c}"
        return (
            f"CASE WHEN h.key IS NOT NULL THEN h.{c} WHEN sh.song_key IS NOT NULL THEN sh.{c} "
            f"WHEN tp.artist_key IS NOT NULL THEN {top} END"
        )

    return f"""(SELECT r.* EXCLUDE (_a, _s), {pick('artist')} AS res_artist, {pick('song')} AS res_song,
        {pick('genre')} AS res_genre, {pick('track_id')} AS res_track_id
  FROM (SELECT *, {sa} AS _a, {ss} AS _s FROM {src}) r
  LEFT JOIN hits h ON h.key = CASE WHEN r._a <> '' AND r._s <> '' THEN lower(r._a || ' ' || r._s) END
  {song_join}
  LEFT JOIN tops tp ON tp.artist_key = CASE WHEN r._a <> '' THEN lower(r._a) END)"""


ENRICHED = f"""complete_ids AS (SELECT * FROM cleaned_ids WHERE song <> '' AND artist <> ''),
resolved AS {resolve('complete_ids', 'artist', 'song', False)},
enriched_users AS (
  SELECT raw_tweet, processed_tweet, res_artist AS artist, res_song AS song, res_genre AS genre,
         tweet_time, user_id, event_id
  FROM resolved WHERE res_genre IS NOT NULL),
enriched AS (
  SELECT raw_tweet, processed_tweet, artist, song, genre, tweet_time FROM enriched_users)"""

GENRE_DIM = """genre_dim_raw AS (
  SELECT track_id AS ordinal, lower(genre) AS name, CAST(track_id + 1000 AS BIGINT) AS genre_id
  FROM catalog),
genre_dim AS (SELECT name, arg_max(genre_id, ordinal) AS genre_id FROM genre_dim_raw GROUP BY name)"""

GENRE_REQUESTS = f"""genre_requests AS (
  SELECT track_id AS request_id,
    CASE track_id % 6
      WHEN 0 THEN genre
      WHEN 1 THEN '  ' || lower(genre) || '  '
      WHEN 2 THEN chr(12288) || lower(genre) || chr(9)
      WHEN 3 THEN genre || ' music'
      WHEN 4 THEN ''
      ELSE NULL
    END AS request
  FROM catalog),
genre_norm AS (
  SELECT request_id, request, lower({strip('request')}) AS name FROM genre_requests
  WHERE lower({strip('request')}) <> '')"""

LOOKUP_REQUESTS = """lookup_requests AS (
  SELECT track_id AS request_id, CAST(track_id % 7 AS INTEGER) AS case_id,
    CASE WHEN track_id % 7 IN (0, 1, 2) THEN artist
         WHEN track_id % 7 = 3 THEN 'Nobody Of That Name' ELSE '' END AS artist_in,
    CASE WHEN track_id % 7 IN (0, 6) THEN song
         WHEN track_id % 7 = 1 THEN 'A Title Of Someone Else'
         WHEN track_id % 7 = 4 THEN 'No Title At All' ELSE '' END AS song_in
  FROM catalog)"""

HOURLY = f"""hourly AS (
  SELECT genre, {hour_start('tweet_time')} AS hour_start, count(*) AS count
  FROM enriched GROUP BY 1, 2)"""

BASE = [CATALOG, TWEETS, EXTRACTED, CLEANED, HITS, ENRICHED]


def _of_half_catalogue(sql: str) -> str:
    """The catalogue's and the enrichment's tables under other names, for every second track."""
    names = ["catalog", "hits", "song_hits", "artist_tracks", "artist_genres", "tops", "complete_ids", "resolved", "enriched_users", "enriched"]
    return re.sub(rf"\b({'|'.join(names)})\b", r"half_\1", sql)


HALF = [_of_half_catalogue(CATALOG).replace("FROM part)", "FROM part WHERE p_partkey % 2 = 0)"), _of_half_catalogue(HITS), _of_half_catalogue(ENRICHED)]


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _base(*more: str) -> str:
    return with_(*BASE, *more)


_CAT = with_(CATALOG)
_ENRICHED_COLS = "raw_tweet, processed_tweet, artist, song, genre, tweet_time"
_LINES_OK = "NOT (event_id % 50 = 0 OR event_id % 77 = 0 OR event_id % 91 = 0 OR event_id % 83 = 0)"
_TOPK_SONGS = """song_counts AS (SELECT genre, song, artist, count(*) AS count FROM enriched GROUP BY 1, 2, 3),
top_songs AS (
  SELECT genre, CAST(rank AS INTEGER) AS rank, song, artist, count FROM (
    SELECT *, row_number() OVER (PARTITION BY genre ORDER BY count DESC, song, artist) AS rank
    FROM song_counts) WHERE rank <= 10)"""
_CHART = """chart AS (
  SELECT genre, song, artist, CAST(chart_rank AS INTEGER) AS chart_rank FROM (
    SELECT *, row_number() OVER (PARTITION BY genre ORDER BY popularity DESC, song, artist) AS chart_rank
    FROM (SELECT genre, song, artist, max(popularity) AS popularity FROM catalog GROUP BY 1, 2, 3))
  WHERE chart_rank <= 10)"""
_REGION = """user_region AS (
  SELECT c.c_custkey AS user_id, r.r_name AS region
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
region_counts AS (
  SELECT u.region, e.genre, CAST(sum(e.n) AS BIGINT) AS count
  FROM (SELECT user_id, genre, count(*) AS n FROM enriched_users GROUP BY 1, 2) e
  JOIN user_region u USING (user_id)
  GROUP BY 1, 2)"""
_FEED = """top_tracks AS (
  SELECT genre, song, artist, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY genre ORDER BY popularity DESC, track_id) AS rank
    FROM catalog) WHERE rank <= 10),
feed_labels AS (
  SELECT genre, CAST(rank - 1 AS INTEGER) AS pos, song || ' - ' || artist AS label FROM top_tracks
  UNION ALL SELECT genre, 10, song FROM top_tracks WHERE rank = 1
  UNION ALL SELECT genre, 11, song || ' - ' || artist || ' - live' FROM top_tracks WHERE rank = 1),
feed_rows AS (
  SELECT d.genre_id, f.pos, f.label, CAST(len(string_split(f.label, ' - ')) AS INTEGER) AS n_parts,
         string_split(f.label, ' - ')[1] AS song, string_split(f.label, ' - ')[2] AS artist
  FROM feed_labels f JOIN genre_dim d ON lower(f.genre) = d.name)"""

ORACLE: dict[str, str] = {
    # scalar functions
    "clean_text": f"SELECT doc_id, {tokens('text')} AS processed_text FROM documents",
    "strip_text": f"SELECT doc_id, {strip('text')} AS stripped_text FROM documents",
    "extract_song_artist": with_(CATALOG, TWEETS, EXTRACTED)
    + f"SELECT event_id, {tokens('song_raw')} AS song, {tokens('artist_raw')} AS artist FROM extracted",
    "lookup_key": _base() + f"SELECT event_id, {lookup_key('artist', 'song')} AS lookup_key FROM cleaned_ids",
    "hour_label": "SELECT event_id, CAST(floor(epoch(ts)) AS INTEGER) AS tweet_time, "
    + hour_label("floor(epoch(ts))")
    + " AS hour_label FROM events",
    "epoch_seconds": "SELECT event_id, CAST(CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS VARCHAR) AS timestamp_ms, "
    "CAST(floor(epoch_us(ts) / 1000000) AS INTEGER) AS tweet_time FROM events",
    # sources, projections, filters
    "parse_tweets_json": with_(CATALOG, TWEETS)
    + f"SELECT raw_tweet, tweet_time FROM tweets WHERE {_LINES_OK}",
    "clean_tweets": _base() + "SELECT * FROM cleaned",
    "complete_tweets": _base() + "SELECT * FROM cleaned WHERE song <> '' AND artist <> ''",
    "hashtag_filter": with_(CATALOG, TWEETS)
    + "SELECT 'tweets' AS source, event_id AS post_id FROM tweets WHERE contains(lower(raw_tweet), '#nowplaying') "
    "UNION ALL SELECT 'documents', doc_id FROM documents "
    "WHERE contains(lower(text || CASE WHEN doc_id % 10 = 0 THEN ' #NowPlaying' ELSE '' END), '#nowplaying')",
    "lang_filter": "SELECT doc_id, text FROM documents WHERE lang = 'en'",
    "scan_cleaned": _base() + "SELECT * FROM cleaned",
    "sink_roundtrip": _base() + "SELECT * FROM cleaned",
    "preview_10": _base()
    + f"SELECT {_ENRICHED_COLS} FROM enriched ORDER BY tweet_time, raw_tweet, processed_tweet, artist, song, genre LIMIT 10",
    "hour_projection": _base() + f"SELECT artist, song, genre, {hour_label('tweet_time')} AS tweet_time FROM enriched",
    # catalogue lookups and joins
    "enrich_tweets": _base() + "SELECT * FROM enriched",
    "catalog_best_hit": with_(CATALOG, HITS) + "SELECT key, artist, song, genre, track_id, popularity FROM hits",
    "catalog_artist_top": with_(CATALOG, HITS) + "SELECT artist_key, artist, song, genre, own_genre, track_id FROM tops",
    "lookup_modes": with_(CATALOG, HITS, LOOKUP_REQUESTS)
    + "SELECT * FROM " + resolve("lookup_requests", "artist_in", "song_in", True),
    "lookup_artist_only": with_(CATALOG, HITS, LOOKUP_REQUESTS)
    + "SELECT * FROM "
    + resolve(f"(SELECT * FROM lookup_requests WHERE {strip('song_in')} = '' AND {strip('artist_in')} <> '')",
              "artist_in", "song_in", True)
    + " WHERE res_artist IS NOT NULL",
    "lookup_song_only": with_(CATALOG, HITS, LOOKUP_REQUESTS)
    + "SELECT * FROM "
    + resolve(f"(SELECT * FROM lookup_requests WHERE {strip('artist_in')} = '' AND {strip('song_in')} <> '')",
              "artist_in", "song_in", True)
    + " WHERE res_artist IS NOT NULL",
    "genre_dim_dedupe": with_(CATALOG, GENRE_DIM) + "SELECT name, genre_id FROM genre_dim",
    "genre_lookup": with_(CATALOG, GENRE_DIM, GENRE_REQUESTS)
    + "SELECT g.request_id, g.request, g.name, d.genre_id FROM genre_norm g JOIN genre_dim d USING (name)",
    "genre_unknown": with_(CATALOG, GENRE_DIM, GENRE_REQUESTS)
    + "SELECT g.request_id, g.request, g.name FROM genre_norm g ANTI JOIN genre_dim d USING (name)",
    "feed_top_songs": with_(CATALOG, GENRE_DIM, GENRE_REQUESTS, _FEED)
    + "SELECT n.name, n.genre_id, f.pos, f.label, f.n_parts, f.song, f.artist "
    "FROM (SELECT DISTINCT g.name, d.genre_id FROM genre_norm g JOIN genre_dim d USING (name)) n "
    "JOIN feed_rows f USING (genre_id)",
    "chart_compare": _base(_TOPK_SONGS, _CHART)
    + "SELECT genre, song, artist, t.rank AS tweet_rank, c.chart_rank, "
    "CAST(c.chart_rank - t.rank AS INTEGER) AS rank_delta "
    "FROM top_songs t FULL OUTER JOIN chart c USING (genre, song, artist)",
    # aggregations and rankings
    "genre_hour_count": _base(HOURLY)
    + f"SELECT genre, {hour_label('hour_start')} AS tweet_time, count FROM hourly",
    "kpi_counts": _base()
    + "SELECT (SELECT count(*) FROM cleaned) AS raw_tweet, count(*) AS processed_tweet, count(song) AS song, "
    "count(DISTINCT artist) AS artist, count(DISTINCT genre) AS genre, count(DISTINCT song) AS song_distinct "
    "FROM enriched",
    "kpi_long": _base(
        """k AS (SELECT (SELECT count(*) FROM cleaned) AS raw_tweet, count(*) AS processed_tweet,
               count(song) AS song, count(DISTINCT artist) AS artist, count(DISTINCT genre) AS genre,
               count(DISTINCT song) AS song_distinct FROM enriched)"""
    )
    + "SELECT metric, CAST(value AS BIGINT) AS value FROM (UNPIVOT k ON raw_tweet, processed_tweet, song, "
    "artist, genre, song_distinct INTO NAME metric VALUE value)",
    "summary_lines": _base(HOURLY)
    + f"SELECT {hour_label('hour_start')} || ',' || genre || ',' || CAST(count AS VARCHAR) AS line FROM hourly",
    "distinct_artists": _base() + "SELECT DISTINCT artist FROM enriched",
    "distinct_genres": _base() + "SELECT DISTINCT genre FROM enriched",
    # The genres of the driver's catalogue (a view cannot take columns from data).
    "genre_timeseries": _base(HOURLY)
    + "SELECT * FROM (PIVOT (SELECT hour_start, "
    + hour_label("hour_start")
    + " AS tweet_time, genre, count FROM hourly) "
    "ON genre IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD') USING CAST(coalesce(sum(count), 0) AS BIGINT) GROUP BY hour_start, tweet_time)",
    "top_genre_per_hour": _base(HOURLY)
    + f"SELECT hour_start, {hour_label('hour_start')} AS tweet_time, genre, count FROM ("
    "SELECT *, rank() OVER (PARTITION BY hour_start ORDER BY count DESC) AS rk FROM hourly) WHERE rk = 1",
    "top10_songs_per_genre": _base(_TOPK_SONGS) + "SELECT * FROM top_songs",
    "top10_artists_per_genre": _base()
    + "SELECT genre, CAST(rank AS INTEGER) AS rank, artist, count FROM ("
    "SELECT *, row_number() OVER (PARTITION BY genre ORDER BY count DESC, artist) AS rank FROM ("
    "SELECT genre, artist, count(*) AS count FROM enriched GROUP BY 1, 2)) WHERE rank <= 10",
    "top10_songs_catalog": _CAT
    + "SELECT genre, CAST(rank AS INTEGER) AS rank, track_id, song, artist, popularity FROM ("
    "SELECT *, row_number() OVER (PARTITION BY genre ORDER BY popularity DESC, track_id) AS rank FROM catalog) "
    "WHERE rank <= 10",
    "genre_region_count": _base(_REGION) + "SELECT region, genre, count FROM region_counts",
    "top_genre_per_region": _base(_REGION)
    + "SELECT region, genre, count FROM (SELECT *, rank() OVER (PARTITION BY region ORDER BY count DESC) AS rk "
    "FROM region_counts) WHERE rk = 1",
    # incremental
    "incremental_after_hwm": _base()
    + f"SELECT {_ENRICHED_COLS} FROM enriched WHERE tweet_time > "
    f"(SELECT max(tweet_time) FROM enriched WHERE tweet_time < {PROCESSED_BEFORE})",
    "incremental_first_run": _base() + f"SELECT {_ENRICHED_COLS} FROM enriched",
    "enrich_incremental": _base() + f"SELECT {_ENRICHED_COLS} FROM enriched",
    "genre_hour_incremental": _base(HOURLY)
    + f"SELECT genre, {hour_label('hour_start')} AS tweet_time, count FROM hourly",
    "genre_counts_per_hour": _base(HOURLY)
    + f"SELECT hour_start, {hour_label('hour_start')} AS tweet_time, CAST(count(*) AS INTEGER) AS n_genres, "
    "'{' || string_agg('\"' || genre || '\":' || CAST(count AS VARCHAR), ',' ORDER BY genre) || '}' AS genre_counts "
    "FROM hourly GROUP BY hour_start",
    # streaming (compared through the sink)
    "stream_line_status": "WITH l AS (SELECT CASE WHEN event_id % 50 = 0 THEN 'no_text' WHEN event_id % 77 = 0 THEN 'blank' "
    "WHEN event_id % 91 = 0 THEN 'not_json' WHEN event_id % 83 = 0 THEN 'bad_time' ELSE 'ok' END AS status FROM events) "
    "SELECT s.status, count(l.status) AS count FROM (SELECT unnest(['ok', 'blank', 'not_json', 'no_text', 'bad_time']) AS status) s "
    "LEFT JOIN l ON l.status = s.status GROUP BY 1",
    "stream_enrich_refresh": _base(*HALF)
    + f"SELECT {_ENRICHED_COLS} FROM half_enriched_users WHERE {_LINES_OK} AND tweet_time < {PROCESSED_BEFORE} "
    f"UNION ALL SELECT {_ENRICHED_COLS} FROM enriched_users WHERE {_LINES_OK} AND tweet_time >= {PROCESSED_BEFORE}",
    "stream_genre_hour_closed": _base()
    + f"SELECT genre, {hour_label('h')} AS tweet_time, count FROM (SELECT genre, {hour_start('tweet_time')} AS h, count(*) AS count "
    f"FROM enriched_users WHERE {_LINES_OK} GROUP BY 1, 2) "
    f"WHERE h + 3600 <= (SELECT max(tweet_time) FROM enriched_users WHERE {_LINES_OK}) - 10 * 86400",
    "stream_ingest": with_(CATALOG, TWEETS) + f"SELECT raw_tweet, tweet_time FROM tweets WHERE {_LINES_OK}",
    "stream_ingest_records": with_(CATALOG, TWEETS) + f"SELECT raw_tweet, tweet_time FROM tweets WHERE {_LINES_OK}",
    "stream_clean": _base()
    + f"SELECT raw_tweet, processed_tweet, song, artist, tweet_time FROM cleaned_ids WHERE {_LINES_OK}",
    "stream_enrich": _base()
    + f"SELECT {_ENRICHED_COLS} FROM enriched_users WHERE {_LINES_OK}",
    "stream_genre_hour": _base()
    + f"SELECT genre, {hour_label(hour_start('tweet_time'))} AS tweet_time, count(*) AS count "
    f"FROM enriched_users WHERE {_LINES_OK} GROUP BY 1, 2",
}

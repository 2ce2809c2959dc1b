"""Independent SQL for the registered queries, run by DuckDB over the same tables."""

from __future__ import annotations

CONCERTS = """
concerts AS (
  SELECT o_orderkey AS concert_id, c_name AS artist, CAST(o_orderdate AS DATE) AS event_date,
         n_name AS event_city
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

ARRIVALS = """
arrivals AS (
  SELECT n_name AS end_city, CAST(l_shipdate AS DATE) AS flight_date,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
)"""

FLIGHTS = """
flights AS (
  SELECT cn.n_name AS start_city, sn.n_name AS end_city, CAST(l_shipdate AS DATE) AS flight_date,
         l_extendedprice AS price, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
         l_orderkey, l_linenumber, l_returnflag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
)"""

AMOUNTS = """
amounts AS (
  SELECT event_id, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents FROM events
)"""

MATCHES = """
matches AS (
  SELECT event_city, event_date, cents
  FROM concerts JOIN arrivals ON event_city = end_city
   AND flight_date > event_date - INTERVAL 5 DAY AND flight_date < event_date
)"""

# Matches of feeds that arrive on their own dates, in 30-day intervals counted from 1970-01-01.
MONTHLY_MATCHES = """
matches AS (
  SELECT event_city, event_date, cents
  FROM concerts JOIN arrivals ON event_city = end_city
   AND flight_date > event_date - INTERVAL 5 DAY AND flight_date < event_date
   AND date_diff('day', DATE '1970-01-01', event_date) // 30
     = date_diff('day', DATE '1970-01-01', flight_date) // 30
)"""

RANGES = """
ranges AS (
  SELECT start_city, end_city, min(cents) FILTER (WHERE cents > 0) AS low, max(cents) AS high
  FROM flights GROUP BY ALL
)"""

BASES = """
bases AS (SELECT * FROM ranges WHERE start_city <> 'NATION_3')"""

SNAPSHOTS = """
old AS (
  SELECT start_city, end_city, flight_date, max(cents) AS cents
  FROM flights WHERE l_returnflag <> 'R' GROUP BY ALL
),
new AS (
  SELECT start_city, end_city, flight_date, max(cents) AS cents
  FROM flights WHERE l_returnflag <> 'A' GROUP BY ALL
),
changed AS (
  SELECT start_city, end_city, flight_date, old.cents AS old_price, new.cents AS new_price
  FROM old FULL JOIN new USING (start_city, end_city, flight_date)
  WHERE old.cents IS DISTINCT FROM new.cents
)"""

# The fare feed: an expired snapshot, a full one, and the changes to it.
FEED = """
feed AS (
  SELECT start_city, end_city, flight_date, round_even(CAST(cents AS DOUBLE) / 100, 0) AS price, 0 AS arrival
  FROM new WHERE cents > 0
  UNION ALL SELECT start_city, end_city, flight_date, round_even(CAST(cents AS DOUBLE) / 100, 0), 1
  FROM old WHERE cents > 0
  UNION ALL SELECT start_city, end_city, flight_date, round_even(CAST(new_price AS DOUBLE) / 100, 0), 2
  FROM changed WHERE new_price IS NOT NULL
)"""

# The events that the pages are built from, as rows.
PAGE_EVENTS = """
page_events AS (
  SELECT o_orderkey AS id, o_orderstatus, o_orderpriority, o_totalprice,
         CAST(o_orderdate AS DATE) AS start_date, c_custkey, c_name, c_mktsegment,
         n_nationkey, n_name, r_name, c_name || ' at ' || n_name AS display_name
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

MEAN = "CAST(sum(cents) AS DOUBLE) / count(*) / 100.0"
FOUR_FIELDS = r"'^[+-]?[0-9]+,[^,]*,[0-9]{4}-[0-9]{2}-[0-9]{2},[^,]+,*$'"
FOUR_FIELDS_FARE = r"'^[^,]*,[^,]*,[0-9]{4}-[0-9]{2}-[0-9]{2},[0-9.]+,*$'"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


ORACLE: dict[str, str] = {
    "event_fare_avg": _with(CONCERTS, ARRIVALS, MATCHES)
    + f"""SELECT event_city, CAST(event_date AS VARCHAR) AS event_date, {MEAN} AS avg_price,
       count(*) AS n
FROM matches GROUP BY event_city, matches.event_date""",
    "city_totals": _with(CONCERTS, ARRIVALS)
    + """SELECT event_city, n_concerts, n_flights,
       CAST(n_concerts AS DOUBLE) * n_flights AS pairs,
       CAST(total AS DOUBLE) / n_flights AS avg_price
FROM (SELECT event_city, count(*) AS n_concerts FROM concerts GROUP BY 1)
JOIN (SELECT end_city AS event_city, count(*) AS n_flights, sum(cents) AS total
      FROM arrivals GROUP BY 1) USING (event_city)""",
    "event_flights_window": _with(CONCERTS, FLIGHTS)
    + """SELECT CAST(event_date AS VARCHAR) AS event_date, event_city, n_concerts,
       CAST(flight_date AS VARCHAR) AS flight_date, start_city, cents, l_orderkey, l_linenumber
FROM (SELECT event_city, event_date, count(*) AS n_concerts FROM concerts GROUP BY ALL) c
JOIN flights ON event_city = end_city
 AND flight_date > event_date - INTERVAL 5 DAY AND flight_date < event_date""",
    "concert_flights": _with(CONCERTS, FLIGHTS)
    + """SELECT concert_id, artist, CAST(event_date AS VARCHAR) AS event_date, event_city,
       CAST(flight_date AS VARCHAR) AS flight_date, start_city, cents, l_orderkey, l_linenumber
FROM concerts JOIN flights ON event_city = end_city
 AND flight_date > event_date - INTERVAL 5 DAY AND flight_date < event_date
WHERE artist = (SELECT c_name FROM customer WHERE c_custkey = 1)""",
    "to_documents": _with(CONCERTS, ARRIVALS, MATCHES)
    + f"""SELECT event_city, strftime(event_date, '%Y-%m-%dT00:00:00.000Z') AS event_date,
       {MEAN} AS avg_price
FROM matches GROUP BY event_city, matches.event_date""",
    "running_avg": _with(AMOUNTS)
    + """SELECT event_id, user_id, event_type, cents, count(*) OVER w AS n,
       CAST(sum(cents) OVER w AS DOUBLE) / count(*) OVER w / 100.0 AS avg_price
FROM amounts
WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)""",
    "number_rows": _with(CONCERTS)
    + """SELECT concert_id AS order_id, artist, CAST(event_date AS VARCHAR) AS event_date, event_city,
       row_number() OVER (ORDER BY artist, concert_id) - 1 AS concert_id
FROM concerts""",
    "positive_fares": """SELECT event_id, value / 100 AS presence FROM events
WHERE value / 100 >= 0.1::DOUBLE AND value / 100 > 0""",
    "routes": _with(FLIGHTS)
    + "SELECT DISTINCT start_city, end_city FROM flights WHERE start_city <> end_city",
    "served_routes": _with(FLIGHTS)
    + """SELECT start_city, end_city, CAST(flight_date AS VARCHAR) AS flight_date, cents, l_orderkey,
       l_linenumber
FROM flights f
WHERE start_city <> end_city AND EXISTS (
  SELECT 1 FROM flights r WHERE r.l_returnflag = 'R' AND r.cents > 9500000
   AND r.start_city = f.start_city AND r.end_city = f.end_city)""",
    "date_spine": _with(CONCERTS)
    + """SELECT event_city, CAST(first_date AS VARCHAR) AS first_date, CAST(i AS INTEGER) AS day_index,
       CAST(CAST(first_date + to_days(CAST(i AS INTEGER)) AS DATE) AS VARCHAR) AS spine_date
FROM (SELECT event_city, min(event_date) AS first_date FROM concerts GROUP BY 1),
     generate_series(0, 359) AS s(i)""",
    "unpivot_fares": _with(ARRIVALS)
    + """SELECT end_city, CAST(sum(cents) AS BIGINT) AS cents, CAST(flight_date AS VARCHAR) AS flight_date
FROM arrivals GROUP BY end_city, arrivals.flight_date""",
    "decode_ids": """SELECT count(*) AS n, CASE WHEN n_nationkey < 20 THEN n_name END AS city, r_name AS region
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY n_nationkey, n_name, r_name""",
    "route_range": _with(FLIGHTS, RANGES)
    + "SELECT start_city, end_city, low AS min_price, high AS max_price FROM ranges",
    "rescale_fares": _with(FLIGHTS, RANGES, BASES)
    + """SELECT start_city, end_city, CAST(flight_date AS VARCHAR) AS flight_date, cents, l_orderkey,
       l_linenumber,
       CAST(2 * low - low AS DOUBLE) * CAST(cents - low AS DOUBLE)
         / nullif(CAST(high - low AS DOUBLE), 0) + low AS scaled_price
FROM flights LEFT JOIN bases USING (start_city, end_city)""",
    "over_cap": _with(FLIGHTS, RANGES, BASES)
    + """SELECT start_city, end_city, CAST(flight_date AS VARCHAR) AS flight_date, cents, l_orderkey,
       l_linenumber, low AS base
FROM flights JOIN bases USING (start_city, end_city) WHERE cents > 2 * low""",
    "cap_fares": _with(FLIGHTS, RANGES, BASES)
    + """SELECT start_city, end_city, CAST(flight_date AS VARCHAR) AS flight_date, cents, l_orderkey,
       l_linenumber, low AS base, least(cents, 2 * low) AS capped_price
FROM flights LEFT JOIN bases USING (start_city, end_city)""",
    "fare_diff": _with(FLIGHTS, SNAPSHOTS)
    + """SELECT start_city, end_city, CAST(flight_date AS VARCHAR) AS flight_date, old_price, new_price
FROM changed""",
    "fare_changes": _with(FLIGHTS, SNAPSHOTS)
    + """SELECT start_city, end_city, CAST(flight_date AS VARCHAR) AS flight_date,
       round_even(CAST(new_price AS DOUBLE) / 100, 0) AS price
FROM changed WHERE new_price IS NOT NULL""",
    "latest_fare": _with(AMOUNTS)
    + """SELECT user_id, event_type, arg_max(cents, event_id) AS cents, max(event_id) AS event_id
FROM amounts GROUP BY 1, 2""",
    "city_list": _with(CONCERTS)
    + """SELECT concert_id, artist, CAST(event_date AS VARCHAR) AS event_date, event_city
FROM concerts WHERE event_city IN (
  SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE')""",
    "city_in": _with(CONCERTS)
    + """SELECT concert_id, artist, CAST(event_date AS VARCHAR) AS event_date, event_city
FROM concerts WHERE event_city IN ('NATION_2', 'NATION_3', 'NATION_5', 'NATION_7')""",
    "concert_csv": _with(CONCERTS)
    + """SELECT CAST(concert_id AS BIGINT) * 10000000000 AS concert_id, artist,
       CAST(event_date AS VARCHAR) AS event_date, event_city
FROM concerts""",
    "parse_quarantine": _with(CONCERTS)
    + f"""SELECT 'accepted' AS kind, event_city, count(*) AS n, CAST(sum(concert_id) AS BIGINT) AS id_sum,
       CAST(min(event_date) AS VARCHAR) AS first_date
FROM concerts GROUP BY event_city
UNION ALL
SELECT 'rejected', NULL, count(*), NULL, NULL
FROM documents WHERE NOT regexp_matches(text, {FOUR_FIELDS})""",
    "fare_feed": _with(FLIGHTS)
    + """SELECT start_city, end_city, count(*) AS n,
       CAST(sum(CAST(round_even(price, 0) AS BIGINT)) AS BIGINT) AS total
FROM flights WHERE price > 0 GROUP BY ALL""",
    "snapshot_and_changes": _with(FLIGHTS, SNAPSHOTS, FEED)
    + """SELECT start_city, end_city, count(*) AS n, CAST(sum(CAST(price AS BIGINT)) AS BIGINT) AS total
FROM feed WHERE arrival > 0 GROUP BY ALL""",
    "average_fares": _with(CONCERTS, FLIGHTS, SNAPSHOTS, FEED)
    + """SELECT event_city, CAST(event_date AS VARCHAR) AS event_date, sum(price) / count(*) AS avg_price,
       2 * count(*) AS n
FROM concerts JOIN feed ON event_city = end_city
 AND flight_date > event_date - INTERVAL 5 DAY AND flight_date < event_date
GROUP BY event_city, concerts.event_date""",
    "average_fares_latest": _with(CONCERTS, FLIGHTS, SNAPSHOTS, FEED)
    + """SELECT event_city, CAST(event_date AS VARCHAR) AS event_date, sum(price) / count(*) AS avg_price,
       count(*) AS n
FROM (SELECT DISTINCT artist, event_date, event_city FROM concerts) c
JOIN (SELECT start_city, end_city, flight_date, arg_max(price, arrival) AS price FROM feed GROUP BY ALL) f
  ON event_city = end_city AND flight_date > event_date - INTERVAL 5 DAY AND flight_date < event_date
GROUP BY event_city, c.event_date""",
    "stream_feeds": _with(CONCERTS, FLIGHTS)
    + f"""SELECT 'concerts' AS feed, 'accepted' AS kind, event_city AS city, count(*) AS n
FROM concerts GROUP BY ALL
UNION ALL
SELECT 'fares', 'accepted', end_city, count(*) FROM flights WHERE price > 0 GROUP BY ALL
UNION ALL
SELECT 'concerts', 'rejected', NULL, count(*) FROM documents
WHERE NOT regexp_matches(text, {FOUR_FIELDS})
UNION ALL
SELECT 'fares', 'rejected', NULL, count(*) FROM documents
WHERE NOT regexp_matches(text, {FOUR_FIELDS_FARE})""",
    "event_pages": _with(PAGE_EVENTS)
    + """SELECT id, CASE WHEN o_orderstatus = 'P' THEN 'cancelled' ELSE 'ok' END AS status,
       'concert' AS event_type, display_name,
       CAST(round(o_totalprice * 100) AS BIGINT) AS popularity, o_orderpriority AS series,
       n_name || ' Hall' AS venue, r_name AS country, n_name || ', ' || r_name AS location,
       CAST(start_date AS VARCHAR) AS start_date,
       CASE WHEN o_orderstatus <> 'O' THEN '20:00:00' END AS start_time,
       CASE WHEN o_orderstatus <> 'O' THEN strftime(start_date, '%Y-%m-%d 19:00:00') END AS start_utc,
       CAST(2 AS BIGINT) AS n_artists, 'Band of ' || n_name AS second_artist,
       md5(c_mktsegment) AS second_mbid, true AS one_day
FROM page_events""",
    "page_rejects": _with(PAGE_EVENTS)
    + """SELECT 'none' AS reason, count(*) AS n FROM page_events
UNION ALL SELECT 'malformed', count(*) FROM documents
UNION ALL SELECT 'no event list', count(*) FROM documents""",
    "unconverted": _with(PAGE_EVENTS)
    + """SELECT CASE WHEN o_orderstatus <> 'O' THEN 'event_start.time' ELSE '' END AS failed, count(*) AS n
FROM page_events GROUP BY ALL""",
    "page_items": _with(PAGE_EVENTS)
    + """SELECT 'event' AS kind, CASE WHEN n_nationkey % 10 IN (3, 6, 9) THEN 'bad event' ELSE 'none' END AS reason,
       count(*) AS n, CAST(sum(id) AS BIGINT) AS ids
FROM page_events GROUP BY ALL
UNION ALL SELECT 'setlist', CASE WHEN conv_id % 3 = 0 THEN 'bad setlist' ELSE 'none' END, count(*), CAST(sum(turn) AS BIGINT)
FROM conversations GROUP BY ALL""",
    "event_search": _with(PAGE_EVENTS)
    + """SELECT id, c_custkey AS list_position, CAST(start_date AS VARCHAR) AS start_date
FROM page_events
WHERE c_mktsegment = 'BUILDING' AND start_date BETWEEN DATE '1997-03-01' AND DATE '1999-02-28'""",
    "concert_feed": _with(PAGE_EVENTS)
    + """SELECT row_number() OVER (ORDER BY c_custkey, start_date, id) - 1 AS concert_id,
       c_name AS artist, CAST(start_date AS VARCHAR) AS event_date, n_name AS event_city
FROM page_events
WHERE c_mktsegment = 'BUILDING' AND r_name = 'EUROPE'
  AND start_date BETWEEN DATE '1997-03-01' AND DATE '1999-02-28'""",
    "active_events": _with(PAGE_EVENTS)
    + """SELECT id, display_name AS "displayName" FROM page_events WHERE o_orderstatus <> 'P'""",
    "by_mbid": _with(PAGE_EVENTS)
    + """SELECT id, display_name AS "displayName" FROM page_events WHERE c_mktsegment = 'BUILDING'""",
    "gigography": _with(PAGE_EVENTS)
    + """SELECT id, CAST(start_date AS VARCHAR) AS start_date FROM page_events
WHERE n_nationkey = 3 AND start_date < DATE '1999-01-01'""",
    "gigography_by_mbid": _with(PAGE_EVENTS)
    + """SELECT id, CAST(start_date AS VARCHAR) AS start_date FROM page_events
WHERE n_name = 'NATION_3' AND start_date < DATE '1999-01-01'""",
    "setlists_for": """SELECT conv_id AS event_id, turn AS id, role AS artist
FROM conversations WHERE conv_id = 3""",
    "first_setlist": """SELECT conv_id AS event_id, turn AS id, role AS artist
FROM conversations WHERE conv_id = 3 ORDER BY turn LIMIT 1""",
    "first_setlists": """SELECT conv_id AS event_id, turn AS id, 'Set ' || turn AS display_name, role AS artist,
       CAST(0 AS BIGINT) AS n_identifiers,
       CAST(len(string_split(text, '. ')) AS BIGINT) AS n_songs, string_split(text, '. ')[1] AS opener
FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1""",
    "setlist_songs": """SELECT event_id, id, CAST(i - 1 AS BIGINT) AS position, songs[i] AS title,
       i = len(songs) AS encore
FROM (SELECT conv_id AS event_id, turn AS id, string_split(text, '. ') AS songs,
             unnest(generate_series(1, len(string_split(text, '. ')))) AS i
      FROM conversations)""",
    "stream_event_fare_avg": _with(CONCERTS, ARRIVALS, MONTHLY_MATCHES)
    + f"""SELECT event_city, strftime(event_date, '%Y-%m-%dT00:00:00.000Z') AS event_date,
       {MEAN} AS avg_price
FROM matches GROUP BY event_city, matches.event_date""",
    "stream_running_avg_per_record": _with(CONCERTS, ARRIVALS, MONTHLY_MATCHES)
    + f"""SELECT event_city, CAST(event_date AS VARCHAR) AS event_date, {MEAN} AS avg_price,
       count(*) AS n
FROM matches GROUP BY event_city, matches.event_date""",
}
ORACLE["documents_current"] = (
    _with(CONCERTS, ARRIVALS, MONTHLY_MATCHES)
    + f"""SELECT event_city, strftime(event_date, '%Y-%m-%dT00:00:00.000Z') AS event_date,
       {MEAN} AS avg_price
FROM matches GROUP BY event_city, matches.event_date"""
)
# Arrivals count from the start of their 30 days; a share meets the watermark of those before it.
ORACLE["late_rows"] = (
    _with(CONCERTS)
    + """, rows AS (
  SELECT 'concerts' AS feed, concert_id AS id, CAST(0 AS BIGINT) AS line, event_date AS day, concert_id % 3 AS share FROM concerts
  UNION ALL
  SELECT 'fares', l_orderkey, CAST(l_linenumber AS BIGINT), CAST(l_shipdate AS DATE), (l_linenumber - 1) % 3
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
), placed AS (
  SELECT *, date_diff('day', DATE '1970-01-01', day) // 30 * 30 AS start FROM rows
), tops AS (
  SELECT now.share, feed, max(start) AS top
  FROM placed JOIN (SELECT unnest([1, 2]) AS share) now ON placed.share < now.share GROUP BY ALL
), marks AS (
  SELECT share, min(top) - 400 AS mark FROM tops GROUP BY share
)
SELECT feed, id, line, CAST(day AS VARCHAR) AS arrival FROM placed JOIN marks USING (share) WHERE start + 30 <= mark"""
)
ORACLE["stream_clock"] = (
    _with(ARRIVALS) + "SELECT end_city, count(*) AS n, CAST(sum(cents) AS BIGINT) AS total FROM arrivals GROUP BY end_city"
)
ORACLE["feed_stamps"] = "SELECT strftime(ts, '%Y%m%d%H%M%S') AS stamp, count(*) AS n FROM events GROUP BY ALL"
ORACLE["fare_validity"] = (
    _with(FLIGHTS, SNAPSHOTS)
    + """, history AS (
  SELECT *, 1 AS number FROM old UNION ALL SELECT *, 2 FROM new UNION ALL SELECT *, 3 FROM new UNION ALL SELECT *, 4 FROM old
), runs AS (
  SELECT *, number - row_number() OVER (PARTITION BY start_city, end_city, flight_date, cents ORDER BY number) AS run FROM history
)
SELECT start_city, end_city, CAST(flight_date AS VARCHAR) AS flight_date, cents,
       CAST(min(number) * 10 AS INTEGER) AS first_seen, CAST(max(number) * 10 AS INTEGER) AS last_seen, count(*) AS n_snapshots
FROM runs GROUP BY start_city, end_city, runs.flight_date, cents, run"""
)
ORACLE["page_gaps"] = (
    _with(CONCERTS)
    + """, sizes AS (
  SELECT event_city AS city, count(*) AS total, CAST(ceil(count(*) / 50) AS BIGINT) AS n_pages FROM concerts GROUP BY ALL
), pages AS (
  SELECT city, total, unnest(range(1, n_pages + 1)) AS page FROM sizes
), lost AS (
  SELECT *, page - row_number() OVER (PARTITION BY city ORDER BY page) AS run FROM pages
  WHERE NOT (page % 7 <> 3 AND page % 11 NOT IN (5, 6))
)
SELECT city, min(page) AS first_page, max(page) AS last_page, least(max(page) * 50, max(total)) - (min(page) - 1) * 50 AS n_entries
FROM lost GROUP BY city, run"""
)
ORACLE["stream_average_fares_latest"] = ORACLE["average_fares_latest"]
ORACLE["running_avg_split"] = ORACLE["running_avg"]

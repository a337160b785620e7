"""The same queries as ANSI SQL over the Parquet tables, to check the results against another engine."""

from __future__ import annotations

_SPACE = r"\x09-\x0d\x1c-\x20\x{85}\p{Z}"

_SUPPLIER_STOPS = """
    SELECT s_suppkey AS stop_id,
           CASE WHEN s_acctbal < 0 THEN '' WHEN s_nationkey = 7 THEN NULL ELSE s_name END AS stop_name
    FROM supplier"""

_EVENT_VISITS = """
    SELECT user_id AS stop_id, count(*) AS total_visits, count(*) / 30.0::DOUBLE AS avg_visits_per_day
    FROM events
    WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31'
    GROUP BY user_id"""

_EVENT_VISITS_WITH_GAPS = """
    SELECT CASE WHEN event_type <> 'error' THEN user_id END AS stop_id,
           count(*) AS total_visits, count(*) / 30.0::DOUBLE AS avg_visits_per_day
    FROM events
    WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31'
    GROUP BY 1"""

_LINEITEM_VISITS = """
    SELECT l_partkey AS stop_id, count(*) AS total_visits, count(*) / 2557.0::DOUBLE AS avg_visits_per_day
    FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '2002-01-01'
    GROUP BY l_partkey"""

_TRIPS = "SELECT l_orderkey AS route_id, count(*) AS trip_count FROM lineitem GROUP BY l_orderkey"

_ROUTE_STATS = """
    SELECT count(*) AS total_routes, avg(trip_count) AS avg_trips_per_route,
           count(*) FILTER (WHERE trip_count = 1) AS single_trip_routes
    FROM trips"""


def _named(visits: str, stops: str) -> str:
    return f"""
    SELECT v.stop_id, coalesce(nullif(s.stop_name, ''), 'Unknown') AS stop_name, total_visits, avg_visits_per_day
    FROM ({visits}) v LEFT JOIN ({stops}) s ON v.stop_id = s.stop_id"""


def _list(visits: str, stops: str, direction: str) -> str:
    return f"{_named(visits, stops)} ORDER BY total_visits {direction}, v.stop_id ASC NULLS LAST LIMIT 30"


_PART_STOPS = "SELECT p_partkey AS stop_id, p_name AS stop_name FROM part"

# Both lists with ranks, from a table of visits.
_RANKED = """
    SELECT 'top_stops' AS list_name, rank, stop_id, stop_name, total_visits, avg_visits_per_day
    FROM (SELECT *, row_number() OVER (ORDER BY total_visits DESC, stop_id ASC NULLS LAST) AS rank FROM named)
    WHERE rank <= 30
    UNION ALL
    SELECT 'least_stops', rank, stop_id, stop_name, total_visits, avg_visits_per_day
    FROM (SELECT *, row_number() OVER (ORDER BY total_visits ASC, stop_id ASC NULLS LAST) AS rank FROM named)
    WHERE rank <= 30"""

_ORDER_DAYS = """
    days AS (SELECT CAST(d AS DATE) AS feed_date
             FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) g(d)),
    manifest(table_name, required) AS (
        VALUES ('1-URGENT', true), ('2-HIGH', true), ('3-MEDIUM', true),
               ('4-NOT SPECIFIED', false), ('5-LOW', false), ('6-UNUSED', false)),
    observed AS (SELECT CAST(o_orderdate AS DATE) AS feed_date, o_orderpriority AS table_name, count(*) AS n_records
                 FROM orders GROUP BY ALL),
    complete AS (
        SELECT d.feed_date, m.table_name, CASE WHEN required THEN '[R]' ELSE '[O]' END AS marker, required,
               o.n_records IS NOT NULL AS found, coalesce(o.n_records, 0) AS n_records
        FROM days d CROSS JOIN manifest m
        LEFT JOIN observed o ON o.feed_date = d.feed_date AND o.table_name = m.table_name)"""


def _size_label(size: str) -> str:
    return f"""CASE WHEN {size} < 1024 THEN {size} || ' B'
                    WHEN {size} < 1048576 THEN printf('%.1f', {size} / 1024.0::DOUBLE) || ' KB'
                    ELSE printf('%.1f', {size} / 1048576.0::DOUBLE) || ' MB' END"""


def _lines(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


_STOP_LINE = "printf('%2d', rank) || '. ' || substr(stop_name, 1, 50) || ' (' || printf('%.1f', avg_visits_per_day) || ' avg visits/day)'"

ORACLE: dict[str, str] = {
    "csv_feed_scan": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
               CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment, DATE '2024-01-01' AS feed_date
        FROM customer""",
    "csv_feed_period": """
        SELECT CAST(ts AS DATE) AS feed_date, CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
               event_type, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN CAST(value AS VARCHAR) END AS value
        FROM events""",
    "archive_expand": """
        SELECT 'sweden-' || year(o_orderdate) || '0101.zip' AS archive_name, 'trips.txt' AS member, o_orderkey, o_custkey,
               o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
        FROM orders""",
    "archive_table_scan": """
        SELECT make_date(year(o_orderdate), 1, 1) AS feed_date, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
               CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
               o_orderpriority, o_totalprice, CAST(NULL AS VARCHAR) AS trip_headsign
        FROM orders""",
    "file_inventory": """
        SELECT '2024-01' AS dataset, CAST(ts AS DATE) AS feed_date, CAST(count(*) AS BIGINT) AS n_records,
               true AS all_have_bytes, true AS all_named, true AS all_labelled
        FROM events GROUP BY CAST(ts AS DATE)""",
    "dataset_totals": """
        SELECT '2024-01' AS dataset, CAST(count(*) AS BIGINT) AS n_records, true AS files_for_all_days, true AS labelled
        FROM events""",
    "period_days": """
        WITH spans AS (
            SELECT event_type, CAST(min(ts) AS DATE) AS first_day, CAST(max(ts) AS DATE) AS last_day
            FROM events GROUP BY event_type)
        SELECT event_type, datediff('day', first_day, last_day) + 1 AS num_days,
               datediff('day', first_day, CAST(d AS DATE)) + 1 AS day_no, CAST(d AS DATE) AS feed_date,
               strftime(d, '%Y%m%d') AS feed_key, strftime(d, '%Y-%m') AS month_key, CAST(d + INTERVAL 1 DAY AS DATE) AS next_day
        FROM spans, unnest(generate_series(CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP), INTERVAL 1 DAY)) u(d)""",
    "period_paths": """
        WITH per_day AS (SELECT CAST(ts AS DATE) AS feed_date, count(*) AS n_records FROM events GROUP BY 1)
        SELECT feed_date, 'https://feeds.example.org/gtfs/sweden-' || strftime(feed_date, '%Y%m%d') || '.zip' AS archive_url,
               '/feeds/sweden-' || strftime(feed_date, '%Y%m%d') || '/stops.txt' AS table_path,
               '/data/' || strftime(feed_date, '%Y-%m') || '/gtfs' AS dataset_path, n_records
        FROM per_day""",
    "daily_union": "SELECT CAST(ts AS DATE) AS feed_date, count(*) AS n_records FROM events GROUP BY 1",
    "union_evolving": """
        SELECT event_id, user_id FROM events WHERE ts < TIMESTAMP '2024-01-15'
        UNION ALL BY NAME
        SELECT value, user_id, event_id FROM events WHERE ts >= TIMESTAMP '2024-01-15'""",
    "land_and_prune": """
        SELECT event_id, user_id, CAST(ts AS DATE) AS feed_date FROM events
        WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-14'""",
    "table_counts": """
        SELECT 'region' AS table_name, count(*) AS n_records FROM region
        UNION ALL SELECT 'nation', count(*) FROM nation
        UNION ALL SELECT 'customer', count(*) FROM customer
        UNION ALL SELECT 'orders', count(*) FROM orders
        UNION ALL SELECT 'lineitem', count(*) FROM lineitem""",
    "stop_visit_counts": _EVENT_VISITS,
    "route_trip_counts": _TRIPS,
    "single_trip_routes": f"{_TRIPS} HAVING count(*) = 1",
    "route_stats": f"WITH trips AS ({_TRIPS}) {_ROUTE_STATS}",
    "route_stats_null_key": f"""
        WITH trips AS (SELECT stop_id AS route_id, total_visits AS trip_count FROM ({_EVENT_VISITS_WITH_GAPS}))
        {_ROUTE_STATS}""",
    "rolling_stop_visits": """
        SELECT CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS stop_id, count(*) AS total_visits,
               count(*) / 14.0::DOUBLE AS avg_visits_per_day
        FROM events WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-16' GROUP BY 1""",
    "lake_summary": f"""
        WITH feed AS (SELECT *, CAST(ts AS DATE) AS day FROM events
                      WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31'),
        trips AS (SELECT user_id AS route_id, count(*) AS trip_count FROM feed GROUP BY user_id), stats AS ({_ROUTE_STATS})
        SELECT '2024-01-01' AS start_date, '2024-01-30' AS end_date, CAST(30 AS INTEGER) AS num_days,
               count(*) FILTER (event_type = 'signup') AS agency, count(*) FILTER (event_type = 'click') AS routes,
               count(*) FILTER (event_type = 'purchase') AS stops, count(*) AS trips, count(*) AS stop_times,
               count(DISTINCT day) FILTER (event_type = 'signup') AS agency_days,
               count(DISTINCT day) FILTER (event_type = 'click') AS routes_days,
               count(DISTINCT day) FILTER (event_type = 'purchase') AS stops_days,
               count(DISTINCT day) AS trips_days, count(DISTINCT day) AS stop_times_days,
               any_value(total_routes) AS total_routes, any_value(avg_trips_per_route) AS avg_trips_per_route,
               any_value(single_trip_routes) AS single_trip_routes
        FROM feed, stats""",
    "feed_day_totals": "SELECT CAST(ts AS DATE) AS feed_date, count(*) AS n_records FROM events GROUP BY 1",
    "days_loaded": "SELECT count(DISTINCT CAST(l_shipdate AS DATE)) AS n_days, count(*) AS n_records FROM lineitem",
    "latest_dimension": """
        SELECT o_custkey, feed_date, o_orderkey, o_orderpriority
        FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS feed_date, o_orderkey, o_orderpriority,
                     row_number() OVER (PARTITION BY o_custkey
                                        ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS place
              FROM orders)
        WHERE place = 1""",
    "stop_visits_named": _named(_EVENT_VISITS_WITH_GAPS, _SUPPLIER_STOPS),
    "top_stops": _list(_EVENT_VISITS, _SUPPLIER_STOPS, "DESC"),
    "least_stops": _list(_EVENT_VISITS, _SUPPLIER_STOPS, "ASC"),
    "top_stops_lineitem": _list(_LINEITEM_VISITS, _PART_STOPS, "DESC"),
    "least_stops_lineitem": _list(_LINEITEM_VISITS, _PART_STOPS, "ASC"),
    "ranked_stops": f"WITH named AS ({_named(_EVENT_VISITS_WITH_GAPS, _SUPPLIER_STOPS)}) {_RANKED}",
    "all_stops_ranked": f"""
        SELECT *, row_number() OVER (ORDER BY total_visits DESC, stop_id ASC NULLS LAST) AS rank FROM ({_LINEITEM_VISITS})""",
    "long_list": _list(_LINEITEM_VISITS, _PART_STOPS, "ASC").replace("LIMIT 30", "LIMIT 50000"),
    "feed_completeness": f"WITH {_ORDER_DAYS} SELECT * FROM complete",
    "feed_verdicts": f"""
        WITH {_ORDER_DAYS}
        SELECT feed_date, count(*) FILTER (WHERE required) AS required_tables,
               count(*) FILTER (WHERE required AND found) AS required_found,
               count(*) FILTER (WHERE NOT required AND found) AS optional_found,
               bool_and(found OR NOT required) AS complete
        FROM complete GROUP BY feed_date""",
    "found_tables": f"WITH {_ORDER_DAYS} SELECT feed_date, table_name, required FROM complete WHERE found",
    "missing_tables": f"WITH {_ORDER_DAYS} SELECT feed_date, table_name FROM complete WHERE required AND NOT found",
    "lake_tables": """
        WITH days AS (SELECT CAST(d AS DATE) AS feed_date
                      FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY) g(d)),
        manifest(table_name, required) AS (
            VALUES ('view', true), ('click', true), ('purchase', true), ('signup', false), ('refund', false)),
        observed AS (SELECT CAST(ts AS DATE) AS feed_date, event_type AS table_name, count(*) AS n_records FROM events GROUP BY ALL)
        SELECT feed_date, table_name, CASE WHEN required THEN '[R]' ELSE '[O]' END AS marker, required,
               n_records IS NOT NULL AS found, coalesce(n_records, 0) AS n_records
        FROM days CROSS JOIN manifest LEFT JOIN observed USING (feed_date, table_name)""",
    "size_labels": f"SELECT doc_id, n_chars AS n_bytes, {_size_label('n_chars')} AS size_label FROM documents",
    "source_sizes": f"""
        WITH totals AS (SELECT lang, count(*) AS n_files, CAST(sum(n_chars) AS BIGINT) AS n_bytes
                        FROM documents GROUP BY lang)
        SELECT *, {_size_label("n_bytes")} AS size_label FROM totals""",
    "path_parts": """
        SELECT page_id, split_part(url, '/', -1) AS base_name,
               array_to_string(list_slice(string_split(url, '/'), 1, len(string_split(url, '/')) - 1), '/') AS parent_path,
               replace(url, 'https://', '') AS without_prefix
        FROM pages""",
    "table_labels": """
        WITH tables AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1),
        runs AS (SELECT o_orderpriority, n, unnest(regexp_extract_all(o_orderpriority, '[A-Za-z]+|[^A-Za-z]+')) AS run,
                        generate_subscripts(regexp_extract_all(o_orderpriority, '[A-Za-z]+|[^A-Za-z]+'), 1) AS pos
                 FROM tables)
        SELECT string_agg(upper(substr(run, 1, 1)) || lower(substr(run, 2)), '' ORDER BY pos) AS label,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN '[R]' ELSE '[O]' END AS marker,
               format('{:,}', n) AS n_records_text
        FROM runs GROUP BY o_orderpriority, n""",
    "line_counts": f"""
        WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
        SELECT doc_id, count(*) AS n_lines,
               {_lines(f"regexp_matches(line, '[^{_SPACE}]')")} AS n_with_content,
               {_lines(f"regexp_matches(line, '[^{_SPACE}]') AND NOT starts_with(line, 'The')")} AS n_without_prefix,
               {_lines(f"len(regexp_extract_all(line, '[^{_SPACE}]+')) >= 8")} AS n_with_fields
        FROM lines GROUP BY doc_id""",
    "summary": f"""
        WITH trips AS ({_TRIPS}), stats AS ({_ROUTE_STATS})
        SELECT '2024-01-01' AS start_date, '2024-01-30' AS end_date, CAST(30 AS INTEGER) AS num_days,
               (SELECT count(*) FROM nation) AS agency, (SELECT count(*) FROM orders) AS routes,
               (SELECT count(*) FROM supplier) AS stops, (SELECT count(*) FROM lineitem) AS trips,
               (SELECT count(*) FROM events) AS stop_times, stats.*
        FROM stats""",
    "report_lines": f"""
        WITH named AS ({_named(_EVENT_VISITS, _SUPPLIER_STOPS)}), ranked AS ({_RANKED}),
        trips AS ({_TRIPS}), stats AS ({_ROUTE_STATS}),
        parts(part, pos, section, line) AS (
            VALUES (0, 1, 'title', 'GTFS Analytics Summary - 2024-02-01 08:30:00'), (0, 2, 'title', repeat('=', 50)),
                   (0, 3, 'title', ''), (1, 1, 'period', 'Analysis Period: 2024-01-01 to 2024-01-30'),
                   (1, 2, 'period', 'Number of days: 30'), (1, 3, 'period', ''),
                   (2, 1, 'counts', 'Dataset Summary:'), (2, 7, 'counts', ''),
                   (3, -1, 'top_stops', 'Top 30 Most Visited Stops (Average per Day):'),
                   (3, 0, 'top_stops', repeat('-', 50)), (3, 31, 'top_stops', ''),
                   (4, -1, 'least_stops', 'Top 30 Least Visited Stops (Average per Day):'),
                   (4, 0, 'least_stops', repeat('-', 50)), (4, 31, 'least_stops', ''),
                   (5, 1, 'routes', 'Route Statistics:'), (5, 2, 'routes', repeat('-', 30))
            UNION ALL SELECT 2, 2, 'counts', '- Agency records: ' || format('{{:,}}', count(*)) FROM nation
            UNION ALL SELECT 2, 3, 'counts', '- Routes records: ' || format('{{:,}}', count(*)) FROM orders
            UNION ALL SELECT 2, 4, 'counts', '- Stops records: ' || format('{{:,}}', count(*)) FROM supplier
            UNION ALL SELECT 2, 5, 'counts', '- Trips records: ' || format('{{:,}}', count(*)) FROM lineitem
            UNION ALL SELECT 2, 6, 'counts', '- Stop times records: ' || format('{{:,}}', count(*)) FROM events
            UNION ALL SELECT 3, rank, list_name, {_STOP_LINE} FROM ranked WHERE list_name = 'top_stops'
            UNION ALL SELECT 4, rank, list_name, {_STOP_LINE} FROM ranked WHERE list_name = 'least_stops'
            UNION ALL SELECT 5, 3, 'routes', '- Total unique routes: ' || format('{{:,}}', total_routes) FROM stats
            UNION ALL SELECT 5, 4, 'routes', '- Average trips per route: ' || printf('%.1f', avg_trips_per_route) FROM stats)
        SELECT row_number() OVER (ORDER BY part, pos) AS line_no, section, line FROM parts""",
    "summary_round_trip": f"""
        WITH named AS ({_named(_EVENT_VISITS, _SUPPLIER_STOPS)}), ranked AS ({_RANKED})
        SELECT list_name, rank AS position, CAST(stop_id AS VARCHAR) AS stop_id, stop_name, total_visits,
               avg_visits_per_day
        FROM ranked""",
    "result_slice": f"""
        WITH named AS ({_named(_EVENT_VISITS, _SUPPLIER_STOPS)}), ranked AS ({_RANKED})
        SELECT list_name, rank AS position, stop_name, avg_visits_per_day FROM ranked""",
}

ORACLE["report_file"] = f"SELECT line, count(*) AS n_lines FROM ({ORACLE['report_lines']}) GROUP BY line"
ORACLE["csv_feed_history"] = ORACLE["csv_feed_period"]

"""The DuckDB statement for each query of ``checks.queries``."""

from __future__ import annotations

# Fixed value: the types the test types stand for in event JSON.
JSON_TYPE = """CASE event_type WHEN 'view' THEN 'WatchEvent' WHEN 'click' THEN 'PushEvent'
    WHEN 'purchase' THEN 'PullRequestEvent' ELSE event_type END"""

BASE = f"""
base AS (
    SELECT CAST(event_id AS VARCHAR) AS event_id,
           event_type,
           user_id AS actor_id,
           'user_' || user_id AS actor_login,
           CAST(props::JSON ->> 'k' AS BIGINT) AS repo_id,
           'repo_' || (props::JSON ->> 'k') AS repo_name,
           CASE WHEN event_type IN ('click', 'purchase') THEN 'org_' || user_id END AS org_login,
           true AS is_public,
           date_trunc('second', ts) AS event_timestamp,
           date_trunc('second', ts) + INTERVAL 1 HOUR AS ingested_at,
           CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date,
           CAST(extract(hour FROM ts) AS INTEGER) AS event_hour,
           value,
           {JSON_TYPE} AS json_type
    FROM events
)"""

# The clean table.
SILVER = f"""{BASE},
silver AS (SELECT * EXCLUDE (value, json_type) FROM base)"""

# The clean table as it comes out of the event JSON, with the value of the event.
PARSED = f"""{BASE},
parsed AS (SELECT * EXCLUDE (json_type) REPLACE (json_type AS event_type) FROM base)"""


def _messages(dirty: bool) -> str:
    """CTE ``msg``: id, type and text of each event's JSON."""
    has_id = "value >= 10" if dirty else "true"
    has_type = "(value < 10 OR value >= 20)" if dirty else "true"
    return f"""{PARSED},
msg AS (
    SELECT event_id, actor_id, repo_id, org_login, value, event_timestamp,
           CASE WHEN {has_id} THEN event_id END AS id,
           CASE WHEN {has_type} THEN event_type END AS type,
           '{{'
           || CASE WHEN {has_id} THEN '"id":"' || event_id || '",' ELSE '' END
           || CASE WHEN {has_type} THEN '"type":"' || event_type || '",' ELSE '' END
           || '"actor":{{"id":' || actor_id || ',"login":"' || actor_login || '"}}'
           || ',"repo":{{"id":' || repo_id || ',"name":"' || repo_name || '"}}'
           || CASE WHEN org_login IS NOT NULL
                   THEN ',"org":{{"login":"' || org_login || '"}}' ELSE '' END
           || ',"public":true,"created_at":"'
           || strftime(event_timestamp, '%Y-%m-%dT%H:%M:%SZ')
           || '","payload":{{"k":' || repo_id || '}}}}' AS raw_json
    FROM parsed
)"""


CUT = "TIMESTAMP '2024-01-15 00:00:00'"

SILVER_LIST = """event_id, event_type, actor_id, actor_login, repo_id, repo_name, org_login,
    is_public, event_timestamp, ingested_at, event_date, event_hour"""

FACT_LIST = """event_id, event_type, actor_id, repo_id, is_public, event_timestamp, event_date,
    event_hour, ingested_at"""

BRONZE_LIST = """event_id, raw_json, 'events.raw' AS kafka_topic,
    CAST(CAST(event_id AS BIGINT) % 2 AS INTEGER) AS kafka_partition,
    CAST(event_id AS BIGINT) // 2 AS kafka_offset,
    event_timestamp + INTERVAL 1 HOUR AS kafka_timestamp"""

AGG_DAILY = f"""WITH {SILVER}
SELECT event_date, repo_id, repo_name, event_type,
       count(event_id) AS event_count,
       count(DISTINCT actor_id) AS unique_actors,
       max(ingested_at) AS ingested_at
FROM silver GROUP BY ALL"""

FACT = f"WITH {SILVER} SELECT {FACT_LIST} FROM silver"

DIM_REPOS = f"""WITH {SILVER}
SELECT repo_id, repo_name, min(event_timestamp) AS first_seen,
       max(event_timestamp) AS last_seen, count(DISTINCT actor_id) AS contributors
FROM silver WHERE repo_id IS NOT NULL GROUP BY repo_id, repo_name"""

LOADS = f"""{SILVER},
facts AS (
    SELECT event_id, event_type, actor_id, repo_id, event_timestamp, event_date, event_hour,
           ingested_at
    FROM silver
),
target AS (SELECT * FROM facts WHERE event_timestamp < TIMESTAMP '2024-01-20 00:00:00'),
source AS (
    SELECT * REPLACE (
        'new_' || event_type AS event_type,
        CASE WHEN event_type = 'purchase'
             THEN CAST(CAST(event_date AS DATE) + 1 AS VARCHAR) ELSE event_date END AS event_date
    )
    FROM facts WHERE event_timestamp >= TIMESTAMP '2024-01-10 00:00:00'
)"""

INSERT_ONLY = f"""WITH {LOADS}
SELECT * FROM target
UNION ALL
SELECT * FROM source AS s
WHERE NOT EXISTS (SELECT 1 FROM target AS t WHERE t.event_id = s.event_id)"""

UPSERT = f"""WITH {LOADS}
SELECT * FROM source
UNION ALL
SELECT * FROM target AS t
WHERE NOT EXISTS (SELECT 1 FROM source AS s WHERE s.event_id = t.event_id)"""

CORRECTED = f"""WITH {SILVER}
SELECT event_date, event_type,
       CASE WHEN event_date BETWEEN '2024-01-10' AND '2024-01-12'
            THEN count(event_id) * 10 ELSE count(event_id) END AS n
FROM silver GROUP BY event_date, event_type"""

STARS = f"""WITH {SILVER}
SELECT repo_id, repo_name, count(event_id) AS total_stars
FROM silver WHERE event_type = 'view' GROUP BY repo_id, repo_name"""

LINE_ITEM_ORDER = """l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
    l_returnflag, l_linestatus, l_shipdate"""

ORACLES: dict[str, str] = {
    "archive_read": f"WITH {_messages(False)} SELECT id AS key, type, raw_json AS value FROM msg",
    "archive_hour_filter": f"""WITH {SILVER}
        SELECT event_id, event_type, event_timestamp FROM silver
        WHERE event_date = '2024-01-15' AND event_hour = 12""",
    "archive_hour_files": f"""WITH {PARSED}
        SELECT event_id, event_type AS type, strftime(event_timestamp, '%Y-%m-%dT%H:%M:%SZ') AS created_at
        FROM parsed
        WHERE event_timestamp >= TIMESTAMP '2024-01-14 12:00:00'
          AND event_timestamp < TIMESTAMP '2024-01-16 00:00:00'""",
    "limit_n": f"""WITH {SILVER}
        SELECT event_id, event_type, event_timestamp FROM silver
        ORDER BY event_timestamp, event_id LIMIT 500""",
    "keyed_messages": f"""WITH {_messages(True)}
        SELECT coalesce(id, 'unknown') AS key, raw_json AS value, type FROM msg""",
    "route_topics": f"""WITH {_messages(True)}
        SELECT 'events.raw' AS topic, count(*) AS messages FROM msg
        UNION ALL SELECT 'events.push', count(*) FROM msg WHERE type = 'PushEvent'
        UNION ALL SELECT 'events.pr', count(*) FROM msg WHERE type = 'PullRequestEvent'
        UNION ALL SELECT 'events.stars', count(*) FROM msg WHERE type = 'WatchEvent'""",
    "delivery_reconcile": f"""WITH {_messages(True)},
        counts AS (
            SELECT count(*) AS events,
                   count(*) FILTER (value < 5) AS cut_off,
                   count(*) FILTER (
                       type IN ('PushEvent', 'PullRequestEvent', 'WatchEvent')
                   ) AS routed
            FROM msg
        )
        SELECT events + cut_off AS source_lines, cut_off AS malformed_lines,
               events + routed AS expected_messages, events AS raw_messages,
               routed AS routed_messages, CAST(0 AS BIGINT) AS missing
        FROM counts""",
    "bronze_project": f"""WITH {_messages(False)}
        SELECT {BRONZE_LIST},
               event_timestamp + INTERVAL 1 HOUR AS ingested_at,
               CAST(CAST(event_timestamp + INTERVAL 1 HOUR AS DATE) AS VARCHAR) AS ingestion_date
        FROM msg""",
    "bronze_summary": f"""WITH {SILVER}
        SELECT count(*) AS rows, max(ingested_at) AS latest FROM silver""",
    "bronze_stream": f"WITH {_messages(False)} SELECT {BRONZE_LIST} FROM msg",
    "bronze_stream_batches": "SELECT true AS limit_held, count(*) AS n_rows FROM events",
    "bronze_rerun_idempotent": """SELECT count(*) AS first_run, count(*) AS second_run
        FROM events""",
    "bronze_schema_evolution": f"""WITH {SILVER}
        SELECT CASE WHEN ingested_at > {CUT} THEN 'second load' END AS origin, count(*) AS n
        FROM silver GROUP BY 1""",
    "lookback_filter": f"""WITH {SILVER}
        SELECT event_id, ingested_at, CAST(CAST(ingested_at AS DATE) AS VARCHAR) AS ingestion_date
        FROM silver WHERE CAST(ingested_at AS DATE) >= DATE '2024-01-20' - 1""",
    "silver_parse": f"WITH {PARSED} SELECT {SILVER_LIST} FROM parsed",
    "silver_clean": f"WITH {PARSED} SELECT {SILVER_LIST} FROM parsed WHERE value >= 20",
    "silver_dedupe": f"WITH {PARSED} SELECT {SILVER_LIST} FROM parsed",
    "dedupe_by_key": f"""SELECT * EXCLUDE (n) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ITEM_ORDER}
            ) AS n
            FROM lineitem
        ) WHERE n = 1""",
    "silver_view": f"WITH {SILVER} SELECT {SILVER_LIST} FROM silver",
    "silver_run_date": f"""WITH {PARSED}
        SELECT {SILVER_LIST} FROM parsed WHERE CAST(ingested_at AS DATE) >= DATE '2024-01-17'""",
    "silver_today": f"""WITH {PARSED}
        SELECT * EXCLUDE (ingested_at) FROM (SELECT {SILVER_LIST} FROM parsed)
        WHERE CAST(event_id AS BIGINT) % 4 <= 1""",
    "silver_create": f"WITH {PARSED} SELECT {SILVER_LIST} FROM parsed",
    "silver_rejects_kept": f"""WITH {_messages(False)}, placed AS (
            SELECT *, CAST(event_id AS BIGINT) // 2 AS kafka_offset FROM msg
        )
        SELECT event_id, 'stored' AS place, NULL AS raw_json FROM placed WHERE kafka_offset % 6 != 0
        UNION ALL SELECT event_id, 'rejected',
               regexp_replace(raw_json, '"created_at":"[^"]*"', '"created_at":"unknown"')
        FROM placed WHERE kafka_offset % 6 = 0""",
    "silver_foreach_batch": f"""WITH {PARSED}
        SELECT * EXCLUDE (ingested_at) FROM (SELECT {SILVER_LIST} FROM parsed)""",
    "compact_partitions": f"""WITH {SILVER}
        SELECT event_date, count(*) AS n_rows, true AS fewer_files
        FROM silver GROUP BY event_date""",
    "events_by_type": f"""WITH {SILVER}
        SELECT event_type, count(*) AS n FROM silver GROUP BY event_type
        ORDER BY n DESC, event_type""",
    "dim_repos": DIM_REPOS,
    "dim_users": f"""WITH {SILVER}
        SELECT actor_id, actor_login, min(event_timestamp) AS first_seen,
               max(event_timestamp) AS last_seen, count(DISTINCT repo_id) AS repos_touched
        FROM silver WHERE actor_id IS NOT NULL GROUP BY actor_id, actor_login""",
    "dim_repos_latest_name": f"""WITH {SILVER},
        named AS (SELECT * REPLACE (repo_name || '_' || event_date AS repo_name) FROM silver),
        latest AS (
            SELECT repo_id, repo_name, row_number() OVER (
                PARTITION BY repo_id ORDER BY event_timestamp DESC, repo_name DESC
            ) AS n
            FROM named
        )
        SELECT d.repo_id, l.repo_name, min(d.event_timestamp) AS first_seen,
               max(d.event_timestamp) AS last_seen, count(DISTINCT d.actor_id) AS contributors
        FROM named AS d JOIN latest AS l ON d.repo_id = l.repo_id AND l.n = 1
        GROUP BY d.repo_id, l.repo_name""",
    "fact_events": FACT,
    "agg_daily_activity": AGG_DAILY,
    "top_repos_topk": f"{STARS} ORDER BY total_stars DESC, repo_id, repo_name LIMIT 20",
    "stars_from_daily": STARS,
    "star_join": f"""WITH {SILVER},
        users AS (SELECT DISTINCT actor_id, actor_login FROM silver)
        SELECT u.actor_login, count(*) AS event_count
        FROM silver AS f JOIN users AS u ON f.actor_id = u.actor_id GROUP BY u.actor_login""",
    "gold_overwrite": DIM_REPOS,
    "affected_dates": f"""WITH {SILVER}
        SELECT DISTINCT event_date FROM silver WHERE ingested_at > {CUT}""",
    "incremental_highwater": f"""WITH {SILVER}
        SELECT {FACT_LIST} FROM silver WHERE ingested_at > (
            SELECT coalesce(max(ingested_at), TIMESTAMP '1970-01-01 00:00:00')
            FROM silver WHERE ingested_at <= {CUT}
        )""",
    "incremental_affected_dates": f"""WITH {SILVER}
        SELECT {FACT_LIST} FROM silver WHERE event_date IN (
            SELECT event_date FROM silver WHERE ingested_at > (
                SELECT coalesce(max(ingested_at), TIMESTAMP '1970-01-01 00:00:00')
                FROM silver WHERE ingested_at <= {CUT}
            )
        )""",
    "dims_incremental": DIM_REPOS,
    "users_incremental": f"""WITH {SILVER}
        SELECT actor_id, actor_login, min(event_timestamp) AS first_seen,
               max(event_timestamp) AS last_seen, count(DISTINCT repo_id) AS repos_touched
        FROM silver WHERE actor_id IS NOT NULL GROUP BY actor_id, actor_login""",
    "gold_changed_dates": AGG_DAILY,
    "agg_daily_incremental": AGG_DAILY,
    "late_event_recompute": AGG_DAILY,
    "fact_incremental_strict": FACT,
    "fact_incremental_safe": FACT,
    "merge_insert_only": INSERT_ONLY,
    "merge_upsert": UPSERT,
    "merge_insert_only_table": INSERT_ONLY,
    "merge_upsert_table": UPSERT,
    "insert_overwrite_partitions": CORRECTED,
    "insert_overwrite_table": CORRECTED,
    "dq_not_null": f"""WITH {_messages(True)}
        SELECT count(*) FILTER (id IS NULL) AS event_id,
               count(*) FILTER (type IS NULL) AS event_type,
               count(*) FILTER (actor_id IS NULL) AS actor_id,
               count(*) FILTER (repo_id IS NULL) AS repo_id,
               count(*) FILTER (org_login IS NULL) AS org_login,
               count(*) FILTER (event_timestamp IS NULL) AS event_timestamp
        FROM msg""",
    "dq_unique": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_check_constraint": """SELECT count(*) AS violations FROM orders
        WHERE NOT coalesce(o_orderdate > TIMESTAMP '2000-01-01 00:00:00', false)""",
    "dq_schema": """
        SELECT 'kafka_partition' AS "column", 'type' AS problem, 'int' AS expected, 'bigint' AS found,
               count(*) AS "rows" FROM events
        UNION ALL SELECT 'kafka_timestamp', 'missing', 'timestamp', NULL, count(*) FROM events
        UNION ALL SELECT 'origin', 'extra', NULL, 'string', count(*) FILTER (event_id // 2 < 100)
        FROM events""",
    "dq_audit": """
        SELECT 'not_null(l_orderkey)' AS rule, count(*) FILTER (l_orderkey IS NULL) AS violations
        FROM lineitem
        UNION ALL SELECT 'not_null(l_shipdate)', count(*) FILTER (l_shipdate IS NULL) FROM lineitem
        UNION ALL SELECT 'check(small)', count(*) FILTER (NOT coalesce(l_quantity < 40, false))
        FROM lineitem
        UNION ALL SELECT 'unique(l_orderkey)', count(*) FROM (
            SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL
            GROUP BY l_orderkey HAVING count(*) > 1)
        UNION ALL SELECT 'unique(l_partkey)', count(*) FROM (
            SELECT l_partkey FROM lineitem WHERE l_partkey IS NOT NULL
            GROUP BY l_partkey HAVING count(*) > 1)""",
    "archive_to_gold": f"""WITH {PARSED}
        SELECT event_date, repo_id, repo_name, event_type, count(event_id) AS event_count,
               count(DISTINCT actor_id) AS unique_actors
        FROM parsed GROUP BY ALL""",
    "hourly_run": f"""{STARS.replace("WHERE", "WHERE event_date = '2024-01-15' AND event_hour = 12 AND")}
        ORDER BY total_stars DESC, repo_id, repo_name LIMIT 20""",
    "hourly_run_limited": f"""WITH {PARSED},
        hour AS (
            SELECT event_id, event_type, actor_id, repo_id, is_public, event_timestamp, event_date, event_hour,
                   row_number() OVER (ORDER BY event_timestamp, event_id) AS n
            FROM parsed WHERE event_date = '2024-01-15' AND event_hour = 12
        )
        SELECT * EXCLUDE (n), 50 AS row_limit FROM hour WHERE n <= 50
        UNION ALL SELECT * EXCLUDE (n), NULL FROM hour""",
    "hours_to_gold": f"""WITH {PARSED}
        SELECT event_date, repo_id, repo_name, event_type, count(event_id) AS event_count,
               count(DISTINCT actor_id) AS unique_actors
        FROM parsed WHERE event_date BETWEEN '2024-01-10' AND '2024-01-19' GROUP BY ALL""",
}

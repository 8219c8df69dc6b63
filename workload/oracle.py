"""The same results in SQL for DuckDB, one statement per query."""

from __future__ import annotations

LOW = "nullif(o_orderpriority, '5-LOW')"
LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
RANKED = f"""
    SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY {LINE_ORDER}) AS INT) AS rank
    FROM lineitem
"""
PLACES = """
    SELECT c_custkey, c_acctbal, c_nationkey, c_mktsegment AS city, n_name AS state, nullif(r_name, 'AFRICA') AS country
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


def numbered(key: str, columns: list[str], order: list[str], source: str) -> str:
    ordered = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    names = ", ".join(columns)
    return f"""
        SELECT CAST(row_number() OVER (ORDER BY {ordered}) AS INT) AS {key}, {names}
        FROM (SELECT DISTINCT {names} FROM ({source}) s) d
    """


SPORT_TYPE = numbered(
    "sk_sport_type", ["type", "sport_type"], ["type", "sport_type"],
    f"SELECT {LOW} AS type, o_orderstatus AS sport_type FROM orders",
)
GEOGRAPHY = numbered("sk_geography", ["city", "state", "country"], ["country", "state", "city"], PLACES)
CALENDAR = """
    SELECT CAST(d AS DATE) AS date, strftime(d, '%Y%m%d') AS sk_time,
           CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day
    FROM (SELECT unnest(generate_series(
        (SELECT make_date(CAST(min(year(o_orderdate)) AS INT), 1, 1) FROM orders),
        (SELECT make_date(CAST(max(year(o_orderdate)) AS INT), 12, 31) FROM orders),
        INTERVAL 1 DAY)) AS d) days
"""

# Orders as activities with their labelled keys.
ACTIVITY = f"""
    SELECT o_orderkey AS id, CAST(o_totalprice AS FLOAT) AS distance, CAST(o_custkey AS INT) AS moving_time,
           c_nationkey AS elapsed_time, CAST(c_acctbal AS FLOAT) AS average_speed,
           coalesce({LOW}, 'N/A') AS type, o_orderstatus AS sport_type, city, state, country, o_orderdate
    FROM orders JOIN ({PLACES}) p ON o_custkey = c_custkey
"""
FACT_SPORT_TYPE = numbered("sk_sport_type", ["type", "sport_type"], ["type", "sport_type"], ACTIVITY)
FACT_GEOGRAPHY = numbered("sk_geography", ["city", "state", "country"], ["country", "state", "city"], ACTIVITY)
ZONES = """
    SELECT l_orderkey AS activity_id, CASE WHEN l_linestatus = 'O' THEN 0 ELSE 1 END AS zone_seq_no,
           CASE WHEN l_linestatus = 'O' THEN 'power' ELSE 'heartrate' END AS type,
           CAST(count(*) AS INT) AS score, max(l_linenumber) AS resource_state,
           bool_or(l_returnflag = 'R') AS sensor_based, CAST(sum(CAST(l_quantity AS INT)) AS INT) AS points,
           bool_and(l_returnflag = 'N') AS custom_zones
    FROM lineitem GROUP BY 1, 2, 3
"""
BUCKETS = """
    SELECT *, row_number() OVER (PARTITION BY activity_id, zone_seq_no ORDER BY min, max, time) AS rank
    FROM (SELECT l_orderkey AS activity_id, CASE WHEN l_linestatus = 'O' THEN 0 ELSE 1 END AS zone_seq_no,
                 l_linenumber AS min, CAST(l_partkey AS INT) AS max, CAST(l_quantity AS INT) AS time
          FROM lineitem) b
"""
# Every line in one of 11 or 5 ranges of its zone, empty ranges included.
RANGED_BUCKETS = """
    SELECT activity_id, zone_seq_no, slot * 100 AS min, slot * 100 + 100 AS max, coalesce(time, 0) AS time, slot + 1 AS rank
    FROM (SELECT activity_id, zone_seq_no,
                 unnest(generate_series(0, CASE zone_seq_no WHEN 0 THEN 10 ELSE 4 END)) AS slot
          FROM (SELECT DISTINCT l_orderkey AS activity_id, CASE WHEN l_linestatus = 'O' THEN 0 ELSE 1 END AS zone_seq_no
                FROM lineitem) k) z
    LEFT JOIN (SELECT l_orderkey AS activity_id, CASE WHEN l_linestatus = 'O' THEN 0 ELSE 1 END AS zone_seq_no,
                      CAST(l_partkey AS BIGINT) % (CASE WHEN l_linestatus = 'O' THEN 11 ELSE 5 END) AS slot,
                      sum(CAST(l_quantity AS INT)) AS time
               FROM lineitem GROUP BY 1, 2, 3) s USING (activity_id, zone_seq_no, slot)
"""
ZONE_TYPES = {"power": 11, "heartrate": 5}
FACT_MEASURES = {
    "distance": "FLOAT", "moving_time": "INT", "elapsed_time": "INT", "total_elevation_gain": "FLOAT",
    "comment_count": "INT", "athlete_count": "INT", "photo_count": "INT", "average_speed": "FLOAT",
    "max_speed": "FLOAT", "average_cadence": "FLOAT", "average_temp": "FLOAT", "average_heartrate": "FLOAT",
    "max_heartrate": "FLOAT", "total_photo_count": "INT", "suffer_score": "FLOAT", "average_watts": "FLOAT",
    "max_watts": "FLOAT", "weighted_average_watts": "FLOAT", "kilojoules": "FLOAT",
}
GIVEN = {"distance", "moving_time", "elapsed_time", "average_speed"}


def pivot(types: dict[str, int], type_column: str, attributes: dict[str, str], measures: dict[str, str]) -> str:
    cells = []
    for t in types:
        cells += [f"max(CASE WHEN {type_column} = '{t}' THEN {c} END) AS {stem}_{t}" for stem, c in attributes.items()]
    for t, n in types.items():
        for i in range(1, n + 1):
            cells += [
                f"CAST(sum(CASE WHEN {type_column} = '{t}' AND rank = {i} THEN {m} END) AS {kind}) AS {m}_{t}{i}"
                for m, kind in measures.items()
            ]
    return ", ".join(cells)


def fact() -> str:
    measures = ", ".join(c if c in GIVEN else f"CAST(NULL AS {kind}) AS {c}" for c, kind in FACT_MEASURES.items())
    attributes = {
        "score": "score", "zone_type": "type", "resource_state": "resource_state",
        "sensor_based": "sensor_based", "points": "points", "custom_zones": "custom_zones",
    }
    cells = pivot(ZONE_TYPES, "type", attributes, {"min": "BIGINT", "max": "BIGINT", "time": "BIGINT"})
    return f"""
        WITH a AS ({ACTIVITY}), st AS ({FACT_SPORT_TYPE}), g AS ({FACT_GEOGRAPHY}), t AS ({CALENDAR}),
             c AS (SELECT activity_id, {cells}
                   FROM ({ZONES}) z JOIN ({RANGED_BUCKETS}) b USING (activity_id, zone_seq_no) GROUP BY activity_id)
        SELECT id, {measures}, 0 AS start_hour, 0 AS start_minute, 0 AS start_second,
               sk_sport_type, sk_geography, sk_time, c.* EXCLUDE (activity_id)
        FROM a JOIN st USING (type, sport_type) JOIN g USING (city, state, country)
             JOIN t ON CAST(o_orderdate AS DATE) = t.date LEFT JOIN c ON id = activity_id
    """


# Stored responses: refused for one priority, empty for orders in progress, else two zones.
ANSWERED = "(SELECT * FROM orders WHERE o_orderpriority <> '5-LOW') o"
INTS = "CAST(trunc(o_totalprice) AS INT) AS price, CAST(o_custkey AS INT) AS customer"


def response_zones(source: str) -> str:
    return f"""
        SELECT o_orderkey AS activity_id, seq AS zone_seq_no, CASE seq WHEN 0 THEN price ELSE customer END AS score,
               CASE seq WHEN 0 THEN 'heartrate' ELSE 'power' END AS type, 3 AS resource_state,
               o_orderstatus = 'F' AS sensor_based, CAST(NULL AS INT) AS points, CAST(NULL AS BOOLEAN) AS custom_zones
        FROM (SELECT *, {INTS} FROM {source} WHERE o_orderstatus <> 'P') r, (VALUES (0), (1)) s(seq)
    """


def response_buckets(source: str) -> str:
    return f"""
        SELECT o_orderkey AS activity_id, seq AS zone_seq_no, low AS min, high AS max,
               CASE WHEN seq = 0 AND low = 0 THEN customer ELSE price END AS time
        FROM (SELECT *, {INTS} FROM {source} WHERE o_orderstatus <> 'P') r,
             (VALUES (0, 0, 100), (0, 100, 200), (1, 0, 50)) s(seq, low, high)
    """


STORED = "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus <> 'P'"
DELIVERED = f"""
    SELECT o_orderkey, o_orderstatus, o_totalprice * 2 AS o_totalprice, {LOW} AS o_orderpriority
    FROM orders WHERE o_orderstatus <> 'F'
"""
UPSERTED = f"""
    WITH t AS ({STORED}), s AS ({DELIVERED})
    SELECT * FROM s UNION ALL SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
"""
FLAG_COUNTS = """
    SELECT l_returnflag, l_linestatus, n, count(*) AS groups
    FROM (SELECT l_orderkey, l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL) c GROUP BY ALL
"""

ORACLE = {
    "q_dim_sport_type": SPORT_TYPE,
    "q_dim_geography": GEOGRAPHY,
    "q_surrogate_scaled": numbered(
        "sk", ["priority", "o_custkey"], ["priority", "o_custkey"], f"SELECT {LOW} AS priority, o_custkey FROM orders"
    ),
    "q_dim_time": CALENDAR,
    "q_distinct_dim": "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
    "q_null_label": f"SELECT o_orderkey, coalesce({LOW}, 'N/A') AS priority, o_orderstatus FROM orders",
    "q_date_parts": """
        SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS start_date_local,
               CAST(year(ts) AS INT) AS start_year, CAST(month(ts) AS INT) AS start_month,
               CAST(day(ts) AS INT) AS start_day, CAST(hour(ts) AS INT) AS start_hour,
               CAST(minute(ts) AS INT) AS start_minute, CAST(second(ts) AS INT) AS start_second
        FROM events
    """,
    "q_json_fields": """SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS "props.k" FROM events""",
    "q_json_scan": """
        SELECT c_custkey AS id, c_name AS "account.name", CAST(c_acctbal AS FLOAT) AS "account.balance",
               nullif(c_mktsegment, 'BUILDING') AS "map.segment"
        FROM customer
    """,
    "q_flatten_struct": """
        SELECT c_custkey AS id, c_name AS "athlete.name", c_nationkey AS "athlete.home.nation",
               c_mktsegment AS "athlete.home.segment"
        FROM customer
    """,
    "q_conform_schema": """
        SELECT CAST(o_orderkey AS INT) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
               CAST(o_totalprice AS FLOAT) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderstatus
        FROM orders
    """,
    "q_cast_failures": """
        SELECT CAST(0 AS BIGINT) AS o_orderkey, count(*) FILTER (o_orderstatus <> 'F') AS o_orderstatus,
               count(*) AS o_orderpriority
        FROM orders
    """,
    "q_page_union": """
        SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL BY NAME
        SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'
    """,
    "q_posexplode": """
        SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS seq_no, unnest(embedding) AS value
        FROM embeddings
    """,
    "q_inline_nested": """
        WITH l AS (SELECT doc_id, CAST(generate_subscripts(lines, 1) - 1 AS INT) AS line_no, unnest(lines) AS line
                   FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents) d)
        SELECT doc_id, line_no, CAST(generate_subscripts(words, 1) - 1 AS INT) AS word_no, unnest(words) AS word
        FROM (SELECT doc_id, line_no, string_split(line, ' ') AS words FROM l) w
    """,
    "q_response_parse": response_zones(ANSWERED),
    "q_response_buckets": response_buckets(ANSWERED),
    "q_empty_keys": f"SELECT o_orderkey AS activity_id FROM {ANSWERED} WHERE o_orderstatus = 'P'",
    "q_pending_keys": """
        SELECT DISTINCT o_orderkey FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
          AND NOT EXISTS (SELECT 1 FROM orders e WHERE e.o_orderstatus = 'P' AND e.o_orderkey = orders.o_orderkey)
    """,
    "q_zone_bucket_join": f"""
        SELECT l_orderkey, l_returnflag, line_count, status, rank, l_linenumber, l_quantity
        FROM ({RANKED}) r JOIN (SELECT l_orderkey, l_returnflag, count(*) AS line_count, max(l_linestatus) AS status
                                FROM lineitem GROUP BY 1, 2) g USING (l_orderkey, l_returnflag)
    """,
    "q_left_enrich": """
        SELECT o_orderkey, o_orderstatus, line_count, quantity
        FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS line_count, sum(l_quantity) AS quantity
                               FROM lineitem GROUP BY 1) l ON o_orderkey = l_orderkey
    """,
    "q_null_key_lookup": f"""
        WITH o AS (SELECT o_orderstatus, {LOW} AS priority FROM orders), d AS (SELECT DISTINCT priority AS p FROM o),
             e AS (SELECT o_orderstatus, count(*) AS equal_rows FROM o JOIN d ON priority = p GROUP BY 1),
             s AS (SELECT o_orderstatus, count(*) AS null_safe_rows
                   FROM o JOIN d ON priority IS NOT DISTINCT FROM p GROUP BY 1)
        SELECT o_orderstatus, CAST(equal_rows AS BIGINT) AS equal_rows, CAST(null_safe_rows AS BIGINT) AS null_safe_rows
        FROM e JOIN s USING (o_orderstatus)
    """,
    "q_fact": fact(),
    "q_lookup_loss": f"""
        SELECT 'sport_type' AS lookup, CAST(0 AS BIGINT) AS dropped_rows
        UNION ALL SELECT 'geography', count(*) FILTER (country IS NULL) FROM ({ACTIVITY}) a
        UNION ALL SELECT 'time', CAST(0 AS BIGINT)
    """,
    "q_rank_in_group": f"""
        SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, rank
        FROM ({RANKED}) r
    """,
    "q_pivot_zone": f"""
        SELECT l_orderkey, {pivot({f: 7 for f in "ANR"}, "l_returnflag", {"status": "l_linestatus", "flag": "l_returnflag"},
                                  {"l_suppkey": "BIGINT", "l_partkey": "BIGINT"})}
        FROM (SELECT *, l_linenumber AS rank FROM lineitem) r GROUP BY l_orderkey
    """,
    "q_pivot_builtin": "SELECT l_orderkey, "
    + ", ".join(
        f"CAST(sum(l_suppkey) FILTER (l_returnflag = '{f}' AND l_linenumber = {i}) AS BIGINT) AS {f}{i}"
        for f in "ANR"
        for i in range(1, 8)
    )
    + " FROM lineitem GROUP BY l_orderkey",
    "q_pivot_discovered": " UNION ALL ".join(
        f"SELECT l_orderkey, concat('{m}_', l_returnflag, rank) AS cell, CAST({m} AS BIGINT) AS value FROM ({RANKED}) r"
        for m in ("l_linenumber", "l_partkey")
    ),
    "q_uniform_groups": """
        SELECT l_returnflag AS zone_type, count(DISTINCT n) AS sizes
        FROM (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2) g
        GROUP BY 1 HAVING count(DISTINCT n) > 1
    """,
    "q_spec_check": f"""
        SELECT type, count(DISTINCT n) AS sizes, max(n) AS largest,
               CASE WHEN count(DISTINCT n) > 1 THEN 'groups of different size' ELSE 'more rows than declared' END AS reason
        FROM (SELECT type, count(*) AS n FROM ({ZONES}) z JOIN ({BUCKETS}) b USING (activity_id, zone_seq_no)
              GROUP BY activity_id, zone_seq_no, type) g
        GROUP BY type
        HAVING count(DISTINCT n) > 1 OR max(n) > CASE type WHEN 'power' THEN 11 ELSE 5 END
    """,
    "q_duplicate_types": """
        SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    """,
    "q_group_count": "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1",
    "q_group_size_hist": """
        SELECT n, count(*) AS groups FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey) g GROUP BY 1
    """,
    "q_group_size_by_type": """
        SELECT l_returnflag, n, count(*) AS groups
        FROM (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_returnflag) g GROUP BY 1, 2
    """,
    "q_count_of_counts": FLAG_COUNTS,
    "q_top20_profile": FLAG_COUNTS + " ORDER BY ALL LIMIT 20",
    "q_row_counts": """
        SELECT 'orders' AS table_name, count(*) AS row_count FROM orders
        UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'customer', count(*) FROM customer
    """,
    "q_merge_upsert": UPSERTED,
    "q_merge_partial_update": """
        WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
                   FROM lineitem WHERE l_returnflag <> 'R'),
             s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, sum(l_quantity) + 100 AS l_quantity,
                          max(l_extendedprice) AS l_extendedprice
                   FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, 2, 3, 4)
        SELECT t.* EXCLUDE (l_quantity), coalesce(s.l_quantity, t.l_quantity) AS l_quantity
        FROM t LEFT JOIN s USING (l_orderkey, l_linenumber, l_partkey, l_suppkey)
        UNION ALL BY NAME
        SELECT * FROM s WHERE NOT EXISTS (
            SELECT 1 FROM t WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber
                              AND t.l_partkey = s.l_partkey AND t.l_suppkey = s.l_suppkey)
    """,
    "q_merge_insert_only": f"""
        WITH t AS ({STORED}), s AS ({DELIVERED})
        SELECT * FROM t UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE s.o_orderkey = t.o_orderkey)
    """,
    "q_merge_table": UPSERTED,
    "q_merge_partitions": """
        SELECT o_orderkey, o_orderpriority,
               CASE o_orderpriority WHEN '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice
        FROM orders
    """,
    "q_overwrite_roundtrip": DELIVERED,
    "q_overwrite_schema": "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer FROM orders",
    "q_ensure_empty": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "q_two_loads": f"""
        SELECT z.*, buckets, CAST(time AS BIGINT) AS time
        FROM ({response_zones("orders")}) z
        LEFT JOIN (SELECT activity_id, zone_seq_no, count(*) AS buckets, sum(time) AS time
                   FROM ({response_buckets("orders")}) b GROUP BY 1, 2) c USING (activity_id, zone_seq_no)
    """,
}

"""Loads that meet real answers: text without a schema, pages and records that do not fit, refusals, repeats, second loads.

One query each on the TPC-H-like test tables, and beside it the same result in SQL for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbuild.functions import zone_time
from starbuild.operators.conform import cast_failures, conform
from starbuild.operators.dims import date_dim, dimension, grown_dimension
from starbuild.operators.pivot import pivot_sparse
from starbuild.operators.skew import skew_join
from starbuild.plans.mart import fact_rejects, labelled
from starbuild.plans.profile import profile_sets
from starbuild.plans.schemas import GEOGRAPHY, GEOGRAPHY_ORDER, SPORT_TYPE, SPORT_TYPE_ORDER
from starbuild.session import Counted, scratch_path
from starbuild.sinks import merge_into, overwrite, with_part
from starbuild.sources import (
    check_pages,
    fitting,
    flatten_json,
    json_paths,
    last_answers,
    page_files,
    rejects,
    until_empty,
    until_first_refusal,
)
from workload.oracle import ACTIVITY, BUCKETS, FACT_GEOGRAPHY, FACT_SPORT_TYPE, LOW, PLACES, ZONES, numbered
from workload.queries import activity, bucket, fresh_table, iso, null_low, places, query, table, zone

ORACLE: dict[str, str] = {}

# --- text without a schema ----------------------------------------------------------------------


@query("q_variant_schema")
def variant_schema(spark, sf_dir):
    """The paths of the events' properties, as found in the data."""
    return json_paths(table(spark, sf_dir, "events"), "props")


ORACLE["q_variant_schema"] = """
    SELECT path, CASE WHEN bool_and(kind IN ('BIGINT', 'UBIGINT')) THEN 'bigint' ELSE 'string' END AS type,
           NOT bool_and(kind IN ('BIGINT', 'UBIGINT')) AS mixed, count(*) AS filled
    FROM (SELECT path, json_type(props, '$.' || path) AS kind
          FROM (SELECT props, unnest(json_keys(props)) AS path FROM events) p) k
    GROUP BY path
"""


@query("q_variant_flatten")
def variant_flatten(spark, sf_dir):
    return flatten_json(table(spark, sf_dir, "events"), "props", ["event_id"])


ORACLE["q_variant_flatten"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as JSON text: nested, with an object that some lack, an array, and a path of numbers and text."""
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")

    def record(tag: Column) -> Column:
        return F.to_json(
            F.struct(
                F.col("c_custkey").alias("id"),
                F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")).alias("account"),
                F.when(segment != "BUILDING", F.struct(segment.alias("segment"), (nation > 9).alias("far"))).alias("map"),
                F.array(nation, nation + 1).alias("spots"),
                tag.alias("tag"),
            )
        )

    body = F.when(segment == "AUTOMOBILE", record(F.col("c_custkey"))).otherwise(record(F.col("c_name")))
    return table(spark, sf_dir, "customer").select(body.alias("body"))


@query("q_variant_records")
def variant_records(spark, sf_dir):
    """Nested records without a declared schema, as flat typed columns."""
    found = flatten_json(customer_records(spark, sf_dir), "body")
    return found.withColumn("spots", F.array_join("spots", ","))


ORACLE["q_variant_records"] = """
    SELECT c_custkey AS id, c_name AS "account.name", c_acctbal AS "account.balance",
           nullif(c_mktsegment, 'BUILDING') AS "map.segment",
           CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey > 9 END AS "map.far",
           concat(c_nationkey, ',', c_nationkey + 1) AS spots,
           CASE c_mktsegment WHEN 'AUTOMOBILE' THEN CAST(c_custkey AS VARCHAR) ELSE c_name END AS tag
    FROM customer
"""


@query("q_conform_text")
def conform_text(spark, sf_dir):
    """Whole numbers as text in several spellings; those with a fraction are no integers, however small it is."""
    return conform(spelled_keys(spark, sf_dir), "o_orderkey bigint, text string, number bigint", "null")


@query("q_conform_text_failures")
def conform_text_failures(spark, sf_dir):
    return cast_failures(spelled_keys(spark, sf_dir), "o_orderkey bigint, text string, number int")


#: How the text of a key ends, by priority; the fraction has eleven digits.
ENDINGS = {"1-URGENT": "", "2-HIGH": ".000", "3-MEDIUM": ".00000000001", "4-NOT SPECIFIED": "00e-2", "5-LOW": ".5"}
FRACTIONS = "('3-MEDIUM', '5-LOW')"


def spelled_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ending = F.create_map(*[F.lit(x) for pair in ENDINGS.items() for x in pair])[F.col("o_orderpriority")]
    text = F.concat(F.col("o_orderkey").cast("string"), ending)
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"), text.alias("number"))


_ENDING = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ENDINGS.items()) + " END"
ORACLE["q_conform_text"] = f"""
    SELECT o_orderkey, concat(o_orderkey, {_ENDING}) AS text,
           CASE WHEN o_orderpriority NOT IN {FRACTIONS} THEN o_orderkey END AS number
    FROM orders
"""
ORACLE["q_conform_text_failures"] = f"""
    SELECT CAST(0 AS BIGINT) AS o_orderkey, CAST(0 AS BIGINT) AS text, count(*) FILTER (o_orderpriority IN {FRACTIONS}) AS number
    FROM orders
"""

# --- pages --------------------------------------------------------------------------------------

#: Orders of a page.
PAGE = 250
RECORD = "id bigint NOT NULL, status string, total int"


def page_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pages of JSON records. Some have no id, some a total that is no integer."""
    record = F.to_json(
        F.struct(
            F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderkey")).alias("id"),
            F.col("o_orderstatus").alias("status"),
            F.when(F.col("o_orderstatus") == "P", F.concat(F.col("o_custkey").cast("string"), F.lit(".25")))
            .otherwise(F.col("o_custkey").cast("string"))
            .alias("total"),
        )
    )
    page = F.expr(f"cast(o_orderkey div {PAGE} + 1 as int)")
    rows = table(spark, sf_dir, "orders").select(page.alias("page"), "o_orderkey", record.alias("record"))
    # a page holds at most PAGE orders
    listed = rows.groupBy("page").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "record"))).alias("records"))
    return listed.select("page", F.concat(F.lit("["), F.array_join("records.record", ","), F.lit("]")).alias("body"))


def landed(spark: SparkSession, bodies: DataFrame) -> DataFrame:
    """Pages written as one file each and read again."""
    path = scratch_path(spark, "pages")
    bodies.select("page", "body").write.partitionBy("page").text(path)
    return page_files(spark, path, r"/page=(\d+)/[^/]*$")


def is_cut(page: str) -> str:
    return f"{page} % 7 = 3"


def is_refusal(page: str) -> str:
    return f"{page} % 7 = 5"


def damaged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some pages are cut off, some hold an error message instead of records."""
    body = (
        F.when(F.expr(is_cut("page")), F.expr("substring(body, 1, length(body) - 10)"))
        .when(F.expr(is_refusal("page")), F.lit('{"message":"Rate Limit Exceeded"}'))
        .otherwise(F.col("body"))
    )
    return landed(spark, page_bodies(spark, sf_dir).withColumn("body", body))


@query("q_page_rejects")
def page_rejects(spark, sf_dir):
    """What does not fit, by page and place, with its reason."""
    found = check_pages(damaged_pages(spark, sf_dir), RECORD, key="id")
    return rejects(found).select("page", "place", "key", "reason")


@query("q_page_records")
def page_records(spark, sf_dir):
    """All other records of the same pages."""
    found = check_pages(damaged_pages(spark, sf_dir), RECORD, key="id")
    return fitting(found, ["page", "place"])


_PAGED = f"""
    SELECT *, CAST(o_orderkey // {PAGE} + 1 AS INT) AS page,
           CAST(row_number() OVER (PARTITION BY o_orderkey // {PAGE} ORDER BY o_orderkey) - 1 AS INT) AS place
    FROM orders
"""
ORACLE["q_page_rejects"] = f"""
    WITH p AS ({_PAGED})
    SELECT DISTINCT page, CAST(NULL AS INT) AS place, CAST(NULL AS VARCHAR) AS key,
           CASE WHEN {is_cut("page")} THEN 'the page is no JSON' ELSE 'the page is no array' END AS reason
    FROM p WHERE {is_cut("page")} OR {is_refusal("page")}
    UNION ALL
    SELECT page, place, CAST(NULL AS VARCHAR), 'column id: null in a NOT NULL column'
    FROM p WHERE NOT ({is_cut("page")} OR {is_refusal("page")}) AND o_orderpriority = '1-URGENT'
    UNION ALL
    SELECT page, place, CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_orderkey AS VARCHAR) END,
           'column total: value cannot be cast to int'
    FROM p WHERE NOT ({is_cut("page")} OR {is_refusal("page")}) AND o_orderstatus = 'P'
"""
ORACLE["q_page_records"] = f"""
    SELECT page, place, o_orderkey AS id, o_orderstatus AS status, CAST(o_custkey AS INT) AS total
    FROM ({_PAGED}) p
    WHERE NOT ({is_cut("page")} OR {is_refusal("page")}) AND o_orderpriority <> '1-URGENT' AND o_orderstatus <> 'P'
"""


@query("q_page_stop")
def page_stop(spark, sf_dir):
    """The records before the first empty page, two thirds in; a second empty page and others come after it."""
    bodies = page_bodies(spark, sf_dir)
    last = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0] // PAGE + 1
    empty = (F.col("page") == last * 2 // 3 + 1) | (F.col("page") == last)
    pages = landed(spark, bodies.withColumn("body", F.when(empty, "[ ]").otherwise(F.col("body"))))
    found = check_pages(until_empty(pages, require_end=True), "id bigint, status string, total string")
    return fitting(found, ["page", "place"])


ORACLE["q_page_stop"] = f"""
    SELECT page, place, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderkey END AS id, o_orderstatus AS status,
           concat(o_custkey, CASE o_orderstatus WHEN 'P' THEN '.25' ELSE '' END) AS total
    FROM ({_PAGED}) p WHERE page < (SELECT (max(o_orderkey) // {PAGE} + 1) * 2 // 3 + 1 FROM orders)
"""

# --- answers ------------------------------------------------------------------------------------


@query("q_first_refusal")
def first_refusal(spark, sf_dir):
    """Orders asked for by date, until the first refusal; refusals begin in the middle of 1997."""
    refused = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderdate") >= F.lit("1997-06-01").cast("timestamp"))
    asked = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("activity_id"), "o_orderdate", F.when(refused, 429).otherwise(200).alias("status")
    )
    return until_first_refusal(asked, ["o_orderdate", "activity_id"]).select("activity_id", "status")


ORACLE["q_first_refusal"] = """
    WITH f AS (SELECT o_orderdate AS d, o_orderkey AS k FROM orders
               WHERE o_orderpriority = '5-LOW' AND o_orderdate >= '1997-06-01' ORDER BY d, k LIMIT 1)
    SELECT o_orderkey AS activity_id, 200 AS status FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM f WHERE o_orderdate > d OR (o_orderdate = d AND o_orderkey >= k))
"""


@query("q_last_answer")
def last_answer(spark, sf_dir):
    """Lines as answers for their orders, numbered and partly refused: the last good one of each order."""
    body = F.to_json(F.struct(F.col("l_partkey").alias("part"), F.col("l_quantity").cast("int").alias("quantity")))
    answers = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("activity_id"),
        F.col("l_linenumber").alias("attempt"),
        F.when(F.col("l_returnflag") == "R", 429).otherwise(200).alias("status"),
        body.alias("body"),
    )
    return last_answers(answers, "activity_id", "attempt")


ORACLE["q_last_answer"] = """
    SELECT l_orderkey AS activity_id, l_linenumber AS attempt, CASE l_returnflag WHEN 'R' THEN 429 ELSE 200 END AS status,
           concat('{"part":', l_partkey, ',"quantity":', CAST(l_quantity AS INT), '}') AS body
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY activity_id ORDER BY status, attempt DESC, body DESC) = 1
"""

# --- stored tables ------------------------------------------------------------------------------


@query("q_merge_zones")
def merge_zones(spark, sf_dir):
    """Zones of a stored table updated and inserted by activity and zone number."""
    name, root = fresh_table(spark)
    zones = zone(spark, sf_dir)
    overwrite(zones.filter("not custom_zones"), name, root=root)
    later = zones.filter("custom_zones or sensor_based")
    later = later.withColumn("points", (F.col("points") * 2).cast("int")).withColumn("type", F.lit("revised"))
    return merge_into(name, later, ["activity_id", "zone_seq_no"], root=root)


ORACLE["q_merge_zones"] = f"""
    SELECT activity_id, zone_seq_no, score, resource_state, sensor_based, custom_zones,
           CAST(CASE WHEN custom_zones OR sensor_based THEN points * 2 ELSE points END AS INT) AS points,
           CASE WHEN custom_zones OR sensor_based THEN 'revised' ELSE type END AS type
    FROM ({ZONES}) z
"""


@query("q_merge_buckets")
def merge_buckets(spark, sf_dir):
    """Buckets of a stored table by their four-column key; a later load sets their time and leaves other columns."""
    name, root = fresh_table(spark)
    key = ["activity_id", "zone_seq_no", "min", "max"]
    first = bucket(spark, sf_dir).groupBy(*key).agg(F.sum("time").cast("int").alias("time")).withColumn("load", F.lit(1))
    overwrite(first.filter("zone_seq_no = 0 or min < 4"), name, root=root)
    later = first.filter("min > 2").select(*key, (F.col("time") + 100).cast("int").alias("time"), F.lit(2).alias("load"))
    return merge_into(name, later, key, update=["time"], root=root)


ORACLE["q_merge_buckets"] = f"""
    SELECT activity_id, zone_seq_no, min, max, CAST(sum(time) + CASE WHEN min > 2 THEN 100 ELSE 0 END AS INT) AS time,
           CASE WHEN zone_seq_no = 0 OR min < 4 THEN 1 ELSE 2 END AS load
    FROM ({BUCKETS}) b GROUP BY activity_id, zone_seq_no, min, max
"""


@query("q_merge_files")
def merge_files(spark, sf_dir):
    """Buckets stored by parts of their key; a later load of few orders rewrites only the parts that hold them."""
    name, root = fresh_table(spark)
    key = ["activity_id", "zone_seq_no", "min", "max"]
    first = bucket(spark, sf_dir).groupBy(*key).agg(F.sum("time").cast("int").alias("time"))
    overwrite(with_part(first, ["activity_id"], 32), name, partition_by=["part"], root=root)
    largest = table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(3).select(F.col("o_orderkey").alias("activity_id"))
    later = first.join(F.broadcast(largest), "activity_id", "left_semi").withColumn("time", (F.col("time") + 1000).cast("int"))
    return merge_into(name, with_part(later, ["activity_id"], 32), ["part", *key], root=root).drop("part")


ORACLE["q_merge_files"] = f"""
    SELECT activity_id, zone_seq_no, min, max,
           CAST(sum(time) + CASE WHEN activity_id IN (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3) THEN 1000 ELSE 0 END AS INT) AS time
    FROM ({BUCKETS}) b GROUP BY activity_id, zone_seq_no, min, max
"""


@query("q_dim_two_loads")
def dim_two_loads(spark, sf_dir):
    """Places numbered in two loads; the second brings a region that sorts before all others, and old keys stay."""
    name, root = fresh_table(spark)
    columns = {"c_mktsegment": "city", "n_name": "state", "r_name": "country"}
    found = places(spark, sf_dir)
    first = found.filter("r_name is not null and r_name <> 'AMERICA'")
    known = overwrite(dimension(first, "sk_geography", columns, GEOGRAPHY_ORDER), name, root=root)
    return grown_dimension(found, known, "sk_geography", columns, GEOGRAPHY_ORDER)


_OLD = "country IS NOT NULL AND country <> 'AMERICA'"
_PLACE = ["city", "state", "country"]
_ORDER = ["country", "state", "city"]
ORACLE["q_dim_two_loads"] = f"""
    WITH old AS ({numbered("sk_geography", _PLACE, _ORDER, f"SELECT * FROM ({PLACES}) p WHERE {_OLD}")}),
         new AS ({numbered("sk_geography", _PLACE, _ORDER, f"SELECT * FROM ({PLACES}) p WHERE NOT coalesce({_OLD}, false)")})
    SELECT * FROM old UNION ALL
    SELECT CAST(sk_geography + (SELECT max(sk_geography) FROM old) AS INT), city, state, country FROM new
"""


@query("q_observed_counts")
def observed_counts(spark, sf_dir):
    """Rows, nulls and the range of keys of a table, counted by the job that writes it."""
    name, root = fresh_table(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", null_low().alias("priority"), "o_orderdate")
    counted = Counted(
        null_priorities=F.count_if(F.col("priority").isNull()), first_key=F.min("o_orderkey"), last_key=F.max("o_orderkey")
    )
    overwrite(counted.watch(orders), name, root=root)
    return spark.createDataFrame([tuple(counted.values.values())], "rows long, null_priorities long, first_key long, last_key long")


ORACLE["q_observed_counts"] = f"""
    SELECT count(*) AS rows, count(*) FILTER ({LOW} IS NULL) AS null_priorities, min(o_orderkey) AS first_key,
           max(o_orderkey) AS last_key
    FROM orders
"""

# --- profiles, pivots, rejects, clocks ----------------------------------------------------------


@query("q_profile_sets")
def profile_of_zones(spark, sf_dir):
    """All counts of counts of zones and buckets, each table read once."""
    return profile_sets(zone(spark, sf_dir), bucket(spark, sf_dir))


def _report(name: str, count: str, told: str, sizes: str) -> str:
    columns = ", ".join(
        f"{c if c in told.split() else f'CAST(NULL AS {kind})'} AS {c}" for c, kind in (("type", "VARCHAR"), ("min", "INT"), ("max", "INT"))
    )
    return f"SELECT '{name}' AS report, {columns}, CAST({count} AS BIGINT) AS count, count(*) AS groups FROM ({sizes}) s GROUP BY ALL"


_JOINED = f"(SELECT b.*, type FROM ({BUCKETS}) b JOIN ({ZONES}) z USING (activity_id, zone_seq_no)) j"
ORACLE["q_profile_sets"] = " UNION ALL ".join(
    [
        _report("zones_per_activity", "n", "", f"SELECT count(*) AS n FROM ({ZONES}) z GROUP BY activity_id"),
        _report("buckets_per_zone", "n", "", f"SELECT count(*) AS n FROM ({BUCKETS}) b GROUP BY activity_id, zone_seq_no"),
        _report("buckets_per_zone_by_type", "n", "type", f"SELECT type, count(*) AS n FROM {_JOINED} GROUP BY activity_id, zone_seq_no, type"),
        _report("range_counts", "n", "type min max", f"SELECT type, min, max, count(*) AS n FROM {_JOINED} GROUP BY activity_id, zone_seq_no, type, min, max"),
    ]
)


@query("q_pivot_sparse")
def sparse_pivot(spark, sf_dir):
    """Lines by the brand of their part and line number, one array of cells for each order, written as text."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", F.col("l_quantity").cast("int").alias("quantity"), "l_suppkey")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"))
    found = pivot_sparse(skew_join(lines, parts, ["l_partkey"]), "l_orderkey", "brand", "l_linenumber", ["quantity", "l_suppkey"])
    return found.withColumn("cells", F.expr("array_join(transform(cells, c -> concat_ws(':', c.type, c.rank, c.quantity, c.l_suppkey)), ' ')"))


ORACLE["q_pivot_sparse"] = """
    SELECT l_orderkey, string_agg(concat_ws(':', p_brand, l_linenumber, quantity, suppkey), ' ' ORDER BY p_brand, l_linenumber) AS cells
    FROM (SELECT l_orderkey, p_brand, l_linenumber, sum(CAST(l_quantity AS INT)) AS quantity, sum(l_suppkey) AS suppkey
          FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL) c
    GROUP BY l_orderkey
"""

#: A fixed calendar that ends before the orders do.
FIXED_CALENDAR = ("1995-01-01", "2000-12-31")


@query("q_fact_rejects")
def rejected_activities(spark, sf_dir):
    """Activities that the fact loses to their country or to a fixed calendar, each with all that it missed."""
    named = labelled(activity(spark, sf_dir))
    return fact_rejects(
        named,
        dimension(named, "sk_sport_type", SPORT_TYPE, SPORT_TYPE_ORDER),
        dimension(named, "sk_geography", GEOGRAPHY, GEOGRAPHY_ORDER),
        date_dim(spark, *FIXED_CALENDAR),
    )


_LATE = f"o_orderdate >= DATE '{FIXED_CALENDAR[1]}' + 1"
ORACLE["q_fact_rejects"] = f"""
    WITH a AS ({ACTIVITY}), st AS ({FACT_SPORT_TYPE}), g AS ({FACT_GEOGRAPHY})
    SELECT id, a.type, a.sport_type, a.city AS location_city, a.state AS location_state, a.country AS location_country,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS start_date_local,
           CAST((CASE WHEN sk_sport_type IS NULL THEN 1 ELSE 0 END) + (CASE WHEN sk_geography IS NULL THEN 2 ELSE 0 END)
                + (CASE WHEN {_LATE} THEN 4 ELSE 0 END) AS INT) AS missed,
           concat_ws(',', CASE WHEN sk_sport_type IS NULL THEN 'sport_type' END,
                     CASE WHEN sk_geography IS NULL THEN 'geography' END, CASE WHEN {_LATE} THEN 'time' END) AS dimensions
    FROM a LEFT JOIN st USING (type, sport_type)
         LEFT JOIN g ON a.city = g.city AND a.state = g.state AND a.country = g.country
    WHERE sk_sport_type IS NULL OR sk_geography IS NULL OR {_LATE}
"""

#: Zones in the way that activities name them, with the offset of winter; one has half hours, one no summer time.
ZONE_TEXTS = [
    "(GMT+01:00) Europe/Oslo", "(GMT-05:00) America/New_York", "(GMT+05:30) Asia/Kolkata", "(GMT+10:00) Australia/Sydney",
    "(GMT-03:30) America/St_Johns", "(GMT+00:00) Europe/London",
]


@query("q_zone_time")
def time_of_zones(spark, sf_dir):
    """Events in the local times of several zones, spread over the year: their instants, offsets, and hours skipped or shown twice."""
    names = F.array(*[F.lit(z) for z in ZONE_TEXTS])
    at = F.timestamp_add("MONTH", F.col("event_id").cast("int") % 12, F.col("ts").cast("timestamp_ntz"))
    events = table(spark, sf_dir, "events").select(
        "event_id",
        names[(F.col("user_id") % len(ZONE_TEXTS)).cast("int")].alias("timezone"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("start_date_local"),
    )
    return zone_time(events, "start_date_local", "timezone")


def _shifted(at: str) -> str:
    """Seconds that clocks are ahead at a time of UTC."""
    return f"CAST(epoch(timezone(zone, timezone('UTC', {at}))) - epoch({at}) AS BIGINT)"


ORACLE["q_zone_time"] = f"""
    WITH e AS (SELECT event_id, [{", ".join(f"'{z}'" for z in ZONE_TEXTS)}][user_id % {len(ZONE_TEXTS)} + 1] AS timezone,
                      date_trunc('second', ts + to_months(CAST(event_id % 12 AS INT))) AS local FROM events),
         z AS (SELECT *, regexp_replace(timezone, '^[^)]*[)] ', '') AS zone FROM e),
         o AS (SELECT *, {_shifted("local - INTERVAL 1 DAY")} AS b, {_shifted("local + INTERVAL 1 DAY")} AS a FROM z),
         c AS (SELECT *, local - to_seconds(b) AS ub, local - to_seconds(a) AS ua FROM o),
         v AS (SELECT *, {_shifted("ub")} = b AS bs, {_shifted("ua")} = a AS as_ FROM c)
    SELECT event_id, timezone, strftime(local, '%Y-%m-%dT%H:%M:%SZ') AS start_date_local,
           CASE WHEN bs OR NOT as_ THEN ub ELSE ua END AS utc,
           CASE WHEN bs THEN b ELSE a END AS offset_seconds,
           CASE WHEN NOT bs AND NOT as_ THEN 'gap' WHEN bs AND as_ AND a <> b THEN 'overlap' ELSE 'once' END AS clock
    FROM v
"""

"""The library's operators on the TPC-H-like test tables, one query each.

Orders stand in for activities, the lines of an order for its buckets, and the lines of one
status or return flag for a zone. Every query reads its tables whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbuild.functions import date_parts, label_nulls
from starbuild.operators.conform import cast_failures, conform
from starbuild.operators.dims import date_dim_over, dimension
from starbuild.operators.incremental import pending_keys, upsert
from starbuild.operators.lookup import left_enrich
from starbuild.operators.nested import empty_keys, explode_indexed, explode_inner, flatten_structs
from starbuild.operators.numbering import rank_in_group, surrogate_key
from starbuild.operators.pivot import PivotSpec, discover_types, pivot_children, pivot_values
from starbuild.operators.quality import (
    count_of_counts,
    duplicate_types,
    group_size_hist,
    group_sizes,
    require_empty,
    row_counts,
    spec_violations,
    top_rows,
    type_sizes,
    uniform_group_violations,
)
from starbuild.operators.skew import skew_join
from starbuild.plans.mart import bucket_counts, build_fact, labelled, lookup_losses
from starbuild.plans.schemas import (
    ACTIVITY,
    GEOGRAPHY,
    GEOGRAPHY_ORDER,
    SPORT_TYPE,
    SPORT_TYPE_ORDER,
    ZONE_SPEC,
    ZONES_BODY,
)
from starbuild.plans.staging import StagingTables, buckets_of, stage_children, zones_of
from starbuild.session import materialize, materialize_counted, scratch_path
from starbuild.sinks import ensure_table, merge_into, overwrite
from starbuild.sources import parse_json, parse_responses, union_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
#: An order has at most so many line numbers.
LINE_NUMBERS = 7


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def null_low(priority: str = "o_orderpriority") -> Column:
    """The test tables hold no nulls; this priority stands for one."""
    return F.nullif(F.col(priority), F.lit("5-LOW"))


def iso(at: str) -> Column:
    return F.date_format(F.col(at), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "customer")
        .join(nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment", "n_name", F.nullif("r_name", F.lit("AFRICA")).alias("r_name"))
    )


# --- dimensions ---------------------------------------------------------------------------------


@query("q_dim_sport_type")
def dim_sport_type(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(null_low().alias("type"), F.col("o_orderstatus").alias("sport_type"))
    return dimension(orders, "sk_sport_type", SPORT_TYPE, SPORT_TYPE_ORDER)


@query("q_dim_geography")
def dim_geography(spark, sf_dir):
    columns = {"c_mktsegment": "city", "n_name": "state", "r_name": "country"}
    return dimension(places(spark, sf_dir), "sk_geography", columns, GEOGRAPHY_ORDER)


@query("q_surrogate_scaled")
def surrogate_scaled(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select(null_low().alias("priority"), "o_custkey").distinct()
    return surrogate_key(keys, "sk", ["priority", "o_custkey"])


@query("q_dim_time")
def dim_time(spark, sf_dir):
    return date_dim_over(table(spark, sf_dir, "orders"), F.col("o_orderdate"))


@query("q_distinct_dim")
def distinct_dim(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus").distinct()


# --- projections and scalar functions -----------------------------------------------------------


@query("q_null_label")
def null_label(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", null_low().alias("priority"), "o_orderstatus")
    return label_nulls(orders, ["priority", "o_orderstatus"])


@query("q_date_parts")
def date_parts_of(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", iso("ts").alias("start_date_local"))
    return date_parts(events, "start_date_local")


# --- nested data and sources --------------------------------------------------------------------


@query("q_json_fields")
def json_fields(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", parse_json("props", "k int").alias("props"))
    return flatten_structs(events)


@query("q_json_scan")
def json_scan(spark, sf_dir):
    """Customers stored as nested JSON records, then scanned, flattened and typed."""
    path = scratch_path(spark, "records")
    records = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")).alias("account"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.struct(F.col("c_mktsegment").alias("segment"))).alias("map"),
    )
    records.write.json(path)
    schema = "id bigint NOT NULL, `account.name` string, `account.balance` float, `map.segment` string"
    return conform(flatten_structs(spark.read.json(path)), schema)


@query("q_flatten_struct")
def flatten_struct(spark, sf_dir):
    nested = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.struct(
            F.col("c_name").alias("name"),
            F.struct(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")).alias("home"),
        ).alias("athlete"),
    )
    return flatten_structs(nested)


@query("q_conform_schema")
def conform_schema(spark, sf_dir):
    schema = "o_orderkey int NOT NULL, o_custkey string, o_totalprice float, o_orderdate date, o_orderstatus string"
    return conform(table(spark, sf_dir, "orders"), schema)


@query("q_cast_failures")
def cast_failure_count(spark, sf_dir):
    return cast_failures(table(spark, sf_dir, "orders"), "o_orderkey int, o_orderstatus boolean, o_orderpriority int")


@query("q_page_union")
def page_union(spark, sf_dir):
    """Two overlapping deliveries of orders; the first lacks a column."""
    orders = table(spark, sf_dir, "orders")
    first = orders.filter("o_orderstatus <> 'P'").select("o_orderkey", "o_totalprice")
    second = orders.filter("o_orderstatus <> 'F'").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return union_pages([first, second])


@query("q_posexplode")
def posexplode(spark, sf_dir):
    return explode_indexed(table(spark, sf_dir, "embeddings"), ["vec_id"], "embedding", "seq_no", "value")


@query("q_inline_nested")
def inline_nested(spark, sf_dir):
    """Documents as arrays of lines, each an array of words: one row per word with both parent keys."""
    words = lambda line: F.transform(
        F.split(line, " ", -1), lambda word, i: F.struct(i.alias("word_no"), word.alias("word"))
    )
    lines = F.transform(F.split("text", "\n", -1), lambda line: F.struct(words(line).alias("words")))
    nested = table(spark, sf_dir, "documents").select("doc_id", lines.alias("lines"))
    indexed = explode_indexed(nested, ["doc_id"], "lines", "line_no", "line")
    return explode_inner(indexed, ["doc_id", "line_no"], "line.words")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored response per order: refused ones, empty ones, and ones with two zones."""

    def bucket(low: int, high: int, time: Column) -> Column:
        return F.struct(F.lit(low).alias("min"), F.lit(high).alias("max"), time.alias("time"))

    def zone(kind: str, score: Column, buckets: Column) -> Column:
        return F.struct(
            score.alias("score"),
            F.lit(kind).alias("type"),
            F.lit(3).alias("resource_state"),
            (F.col("o_orderstatus") == "F").alias("sensor_based"),
            F.lit("ignored").alias("unknown_field"),
            buckets.alias("distribution_buckets"),
        )

    price, customer = F.col("o_totalprice").cast("int"), F.col("o_custkey").cast("int")
    zones = F.array(
        zone("heartrate", price, F.array(bucket(0, 100, customer), bucket(100, 200, price))),
        zone("power", customer, F.array(bucket(0, 50, price))),
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("activity_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", 429).otherwise(200).alias("status"),
        F.when(F.col("o_orderstatus") == "P", "[]").otherwise(F.to_json(zones)).alias("body"),
    )


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_responses(responses(spark, sf_dir), "activity_id", ZONES_BODY, "zones")


@query("q_response_parse")
def response_parse(spark, sf_dir):
    return zones_of(parsed(spark, sf_dir))


@query("q_response_buckets")
def response_buckets(spark, sf_dir):
    return buckets_of(parsed(spark, sf_dir))


@query("q_empty_keys")
def empty_key_list(spark, sf_dir):
    return empty_keys(parsed(spark, sf_dir), "activity_id", "zones")


# --- joins --------------------------------------------------------------------------------------


@query("q_pending_keys")
def pending(spark, sf_dir):
    """Orders without lines, less those known to stay without (the ones in progress)."""
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    return pending_keys(
        orders, "o_orderkey", (lines, "l_orderkey"), (orders.filter("o_orderstatus = 'P'"), "o_orderkey")
    )


def line_groups(lines: DataFrame) -> DataFrame:
    return lines.groupBy("l_orderkey", "l_returnflag").agg(
        F.count("*").alias("line_count"), F.max("l_linestatus").alias("status")
    )


@query("q_zone_bucket_join")
def zone_bucket_join(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    ranked = rank_in_group(lines.select("l_returnflag", *LINE_KEY, "l_quantity", "l_extendedprice"), ["l_orderkey", "l_returnflag"], LINE_ORDER)
    return skew_join(ranked, line_groups(lines), ["l_orderkey", "l_returnflag"]).select(
        "l_orderkey", "l_returnflag", "line_count", "status", "rank", "l_linenumber", "l_quantity"
    )


@query("q_left_enrich")
def left_enriched(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("line_count"), F.sum("l_quantity").alias("quantity")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return left_enrich(orders, lines, "o_orderkey", "l_orderkey")


@query("q_null_key_lookup")
def null_key_lookup(spark, sf_dir):
    """Rows per status that a lookup by a partly null key finds: by equality, and null-safe."""
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", null_low().alias("priority"))
    counts = orders.groupBy("o_orderstatus", "priority").agg(F.count("*").alias("n"))
    dim = orders.select(F.col("priority").alias("d_priority")).distinct()
    found = lambda name, on: counts.join(dim, on).groupBy("o_orderstatus").agg(F.sum("n").alias(name))
    equal = found("equal_rows", F.col("priority") == F.col("d_priority"))
    safe = found("null_safe_rows", F.col("priority").eqNullSafe(F.col("d_priority")))
    return equal.join(safe, "o_orderstatus")


# --- the fact -----------------------------------------------------------------------------------


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the shape of activities, stored like a staging table; columns without a counterpart are null."""
    orders = skew_join(table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey"), places(spark, sf_dir), ["c_custkey"])
    given = {
        "id": F.col("o_orderkey"),
        "distance": F.col("o_totalprice"),
        "moving_time": F.col("c_custkey"),
        "elapsed_time": F.col("c_nationkey"),
        "average_speed": F.col("c_acctbal"),
        "type": null_low(),
        "sport_type": F.col("o_orderstatus"),
        "location_city": F.col("c_mktsegment"),
        "location_state": F.col("n_name"),
        "location_country": F.col("r_name"),
        "start_date_local": iso("o_orderdate"),
    }
    names = [f.name for f in spark.createDataFrame([], ACTIVITY).schema.fields]
    return materialize(conform(orders.select(*[given.get(c, F.lit(None)).alias(c) for c in names]), ACTIVITY))


def zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open lines of an order as its power zone, finished ones as its heartrate zone."""
    is_open = F.col("l_linestatus") == "O"
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("activity_id"), F.when(is_open, 0).otherwise(1).alias("zone_seq_no"))
        .agg(
            F.count("*").cast("int").alias("score"),
            F.max("l_linenumber").alias("resource_state"),
            F.bool_or(F.col("l_returnflag") == "R").alias("sensor_based"),
            F.sum(F.col("l_quantity").cast("int")).cast("int").alias("points"),
            F.bool_and(F.col("l_returnflag") == "N").alias("custom_zones"),
        )
        .withColumn("type", F.when(F.col("zone_seq_no") == 0, "power").otherwise("heartrate"))
    )


def bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_open = F.col("l_linestatus") == "O"
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("activity_id"),
        F.when(is_open, 0).otherwise(1).alias("zone_seq_no"),
        F.col("l_linenumber").alias("min"),
        F.col("l_partkey").cast("int").alias("max"),
        F.col("l_quantity").cast("int").alias("time"),
    )


def ranged_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line in one of the ranges of its zone: 11 for open lines, 5 for finished ones, empty ranges included."""
    ranges = F.when(F.col("l_linestatus") == "O", ZONE_SPEC.types["power"]).otherwise(ZONE_SPEC.types["heartrate"])
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("activity_id"),
        F.when(F.col("l_linestatus") == "O", 0).otherwise(1).alias("zone_seq_no"),
        ranges.alias("ranges"),
        F.pmod("l_partkey", ranges).alias("slot"),
        F.col("l_quantity").cast("int").alias("time"),
    )
    times = [F.coalesce(F.sum(F.when(F.col("slot") == i, F.col("time"))), F.lit(0)) for i in range(ZONE_SPEC.max_rank)]
    zones = lines.groupBy("activity_id", "zone_seq_no", "ranges").agg(F.array(*times).alias("times"))
    zones = zones.withColumn("times", F.slice("times", F.lit(1), F.col("ranges")))
    return explode_indexed(zones, ["activity_id", "zone_seq_no"], "times", "slot", "time").select(
        "activity_id",
        "zone_seq_no",
        (F.col("slot") * 100).alias("min"),
        (F.col("slot") * 100 + 100).alias("max"),
        F.col("time").cast("int").alias("time"),
    )


@query("q_fact")
def fact(spark, sf_dir):
    """The whole mart: three lookups and the pivoted zones, 86 columns. Stops if a zone does not fit its columns."""
    source = activity(spark, sf_dir)
    named = labelled(source)
    # Like the activities, both are stored as a load would leave them.
    zones, buckets = materialize(zone(spark, sf_dir)), materialize(ranged_bucket(spark, sf_dir))
    sizes = bucket_counts(zones, buckets)
    require_empty(spec_violations(sizes, "type", "bucket_count", ZONE_SPEC.types), "zone types do not fit the fact")
    sport_type, sport_counts = materialize_counted(dimension(named, "sk_sport_type", SPORT_TYPE, SPORT_TYPE_ORDER))
    geography, geography_counts = materialize_counted(dimension(named, "sk_geography", GEOGRAPHY, GEOGRAPHY_ORDER))
    time, time_counts = materialize_counted(date_dim_over(source, F.col("start_date_local")))
    rows = {"sport_type": sport_counts["rows"], "geography": geography_counts["rows"], "time": time_counts["rows"]}
    return build_fact(named, zones, buckets, sport_type, geography, time, rows=rows)


@query("q_lookup_loss")
def lookup_loss(spark, sf_dir):
    """Rows each lookup of the fact would drop, against a calendar of the order dates."""
    named = labelled(activity(spark, sf_dir))
    return lookup_losses(
        named,
        dimension(named, "sk_sport_type", SPORT_TYPE, SPORT_TYPE_ORDER),
        dimension(named, "sk_geography", GEOGRAPHY, GEOGRAPHY_ORDER),
        date_dim_over(named, F.col("start_date_local")),
    )


# --- ranks and pivots ---------------------------------------------------------------------------


@query("q_rank_in_group")
def rank_in_zone(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", *LINE_KEY, "l_quantity", "l_extendedprice")
    return rank_in_group(lines, ["l_orderkey", "l_returnflag"], LINE_ORDER)


@query("q_pivot_zone")
def pivot_zone(spark, sf_dir):
    """Lines by flag and line number, which runs from 1 to 7: every line has its cell."""
    spec = PivotSpec(
        types={flag: LINE_NUMBERS for flag in "ANR"},
        attributes={"status": "l_linestatus", "flag": "l_returnflag"},
        measures=("l_suppkey", "l_partkey"),
        type_column="l_returnflag",
        rank_column="l_linenumber",
    )
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", *LINE_KEY)
    return pivot_children(lines, "l_orderkey", spec)


@query("q_pivot_builtin")
def pivot_builtin(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", *LINE_KEY)
    lines = lines.withColumn("cell", F.concat("l_returnflag", F.col("l_linenumber").cast("string")))
    cells = [f"{flag}{number}" for flag in "ANR" for number in range(1, LINE_NUMBERS + 1)]
    return pivot_values(lines, "l_orderkey", "cell", cells, [F.sum("l_suppkey").alias("suppliers")])


@query("q_pivot_discovered")
def pivot_discovered(spark, sf_dir):
    """A pivot whose columns come from the data, unfolded again, as its columns differ from table to table."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", *LINE_KEY, "l_quantity", "l_extendedprice")
    sizes = type_sizes(lines, ["l_orderkey"], "l_returnflag")
    spec = PivotSpec(
        types=discover_types(sizes, *sizes.columns),
        attributes={"flag": "l_returnflag"},
        measures=("l_linenumber", "l_partkey"),
        type_column="l_returnflag",
    )
    ranked = rank_in_group(lines, ["l_orderkey", "l_returnflag"], LINE_ORDER)
    wide = pivot_children(ranked, "l_orderkey", spec)
    return wide.unpivot("l_orderkey", spec.measure_columns, "cell", "value").where("value is not null")


# --- rules and profiles -------------------------------------------------------------------------


@query("q_uniform_groups")
def uniform_groups(spark, sf_dir):
    sizes = type_sizes(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_returnflag")
    return uniform_group_violations(sizes, "l_returnflag")


@query("q_spec_check")
def spec_check(spark, sf_dir):
    """Types of the zones that a pivot over 11 and 5 buckets could not take."""
    sizes = bucket_counts(zone(spark, sf_dir), bucket(spark, sf_dir))
    return spec_violations(sizes, "type", "bucket_count", {"power": 11, "heartrate": 5})


@query("q_duplicate_types")
def doubled_types(spark, sf_dir):
    return duplicate_types(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_returnflag")


@query("q_group_count")
def group_count(spark, sf_dir):
    return group_sizes(table(spark, sf_dir, "lineitem"), ["l_orderkey"])


@query("q_group_size_hist")
def group_size_histogram(spark, sf_dir):
    return group_size_hist(table(spark, sf_dir, "lineitem"), ["l_orderkey"])


@query("q_group_size_by_type")
def group_size_by_type(spark, sf_dir):
    return group_size_hist(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_returnflag"], ["l_returnflag"])


def flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_returnflag", "l_linestatus"]
    return count_of_counts(table(spark, sf_dir, "lineitem"), ["l_orderkey", *keys], keys)


@query("q_count_of_counts")
def count_of_count(spark, sf_dir):
    return flag_counts(spark, sf_dir)


@query("q_top20_profile")
def top20_profile(spark, sf_dir):
    return top_rows(flag_counts(spark, sf_dir), 20)


@query("q_row_counts")
def row_count_profile(spark, sf_dir):
    return row_counts({name: table(spark, sf_dir, name) for name in ("orders", "lineitem", "customer")})


# --- merges and sinks ---------------------------------------------------------------------------


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as an earlier load left them: those in progress are not there yet."""
    return table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later delivery of the orders not yet finished, with a new price and some priorities now null."""
    return table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'").select(
        "o_orderkey", "o_orderstatus", (F.col("o_totalprice") * 2).alias("o_totalprice"), null_low().alias("o_orderpriority")
    )


@query("q_merge_upsert")
def merge_upsert(spark, sf_dir):
    return upsert(stored(spark, sf_dir), delivered(spark, sf_dir), ["o_orderkey"])


@query("q_merge_partial_update")
def merge_partial_update(spark, sf_dir):
    """Four-column key, only the quantity is updated."""
    columns = [*LINE_KEY, "l_quantity", "l_extendedprice"]
    lines = table(spark, sf_dir, "lineitem")
    source = lines.filter("l_returnflag <> 'N'").groupBy(*LINE_KEY).agg(
        F.sum("l_quantity").alias("l_quantity"), F.max("l_extendedprice").alias("l_extendedprice")
    )
    source = source.withColumn("l_quantity", F.col("l_quantity") + 100)
    return upsert(lines.filter("l_returnflag <> 'R'").select(*columns), source, LINE_KEY, ["l_quantity"])


@query("q_merge_insert_only")
def merge_insert_only(spark, sf_dir):
    return upsert(stored(spark, sf_dir), delivered(spark, sf_dir), ["o_orderkey"], update=[])


def fresh_table(spark: SparkSession) -> tuple[str, str]:
    """A table name of its own and a folder for it in the shared folder."""
    return f"starbuild_{uuid.uuid4().hex}", scratch_path(spark, "tables")


@query("q_merge_table")
def merge_table(spark, sf_dir):
    """The same merge into a stored table, in two loads."""
    name, root = fresh_table(spark)
    overwrite(stored(spark, sf_dir), name, root=root)
    return merge_into(name, delivered(spark, sf_dir), ["o_orderkey"], root=root)


@query("q_merge_partitions")
def merge_partitions(spark, sf_dir):
    """A merge into a partitioned table, which rewrites one of its five partitions."""
    name, root = fresh_table(spark)
    columns = ["o_orderkey", "o_totalprice", "o_orderpriority"]
    overwrite(table(spark, sf_dir, "orders").select(*columns), name, partition_by=["o_orderpriority"], root=root)
    urgent = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    source = urgent.select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), "o_orderpriority")
    return merge_into(name, source, ["o_orderpriority", "o_orderkey"], root=root)


@query("q_overwrite_roundtrip")
def overwrite_roundtrip(spark, sf_dir):
    name, root = fresh_table(spark)
    overwrite(stored(spark, sf_dir), name, root=root)
    return overwrite(delivered(spark, sf_dir), name, root=root)


@query("q_overwrite_schema")
def overwrite_schema(spark, sf_dir):
    name, root = fresh_table(spark)
    overwrite(stored(spark, sf_dir), name, root=root)
    changed = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"))
    return overwrite(changed, name, allow_schema_change=True, root=root)


@query("q_ensure_empty")
def ensure_empty(spark, sf_dir):
    """A table created empty, then filled by its first merge."""
    name, root = fresh_table(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    ensure_table(spark, name, orders.schema, root=root)
    return merge_into(name, orders, ["o_orderkey"], root=root)


@query("q_two_loads")
def two_loads(spark, sf_dir):
    """Zones after two increments: the second answers the keys the first was refused."""
    name, root = fresh_table(spark)
    tables = StagingTables(**{t: f"{name}_{t}" for t in ("athlete", "activity", "zone", "bucket", "no_zone")})
    overwrite(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")), tables.activity, root=root)
    first = responses(spark, sf_dir)
    stage_children(spark, first, tables, root=root)
    stage_children(spark, first.withColumn("status", F.lit(200)), tables, root=root)
    zones, buckets = spark.table(tables.zone), spark.table(tables.bucket)
    per_zone = buckets.groupBy("activity_id", "zone_seq_no").agg(
        F.count("*").alias("buckets"), F.sum("time").alias("time")
    )
    return zones.join(per_zone, ["activity_id", "zone_seq_no"], "left")

"""Text without a schema, pages, answers, second loads: the cases that the test tables do not have."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starbuild.functions import zone_of, zone_time
from starbuild.operators.conform import cast_failures, checked, conform
from starbuild.operators.dims import dimension, grown_dimension
from starbuild.operators.lookup import Lookup, lookup, marked_lookups, missed_names
from starbuild.operators.pivot import pivot_sparse, sparse_cell
from starbuild.operators.quality import QualityError
from starbuild.plans.mart import MartTables, build_mart
from starbuild.plans.profile import profile, profile_sets
from starbuild.plans.staging import StagingTables, stage_activity_pages, stage_athlete_text, stage_children
from starbuild.session import Counted, materialize_counted
from starbuild.sinks import merge_into, overwrite, with_part
from starbuild.sources import (
    check_pages,
    fitting,
    flatten_json,
    infer_schema,
    json_paths,
    last_answers,
    load_pages,
    page_files,
    rejects,
    typed_json,
    until_empty,
    until_first_refusal,
)
from starbuild.sources.inferred import TooManyPaths

RECORDS = [
    '{"a":1,"b":{"c":"x","d e":2.5},"l":[1,2.5]}',
    '{"a":"t","b":null,"z":{}}',
    '{"a":null,"q`r":true,"l":[],"m.n":1e300}',
    "null",
    None,
    '{"ts":"2020-01-01","big":123456789012345678901234567890,"a":{"k":1},"n":null}',
]


@pytest.fixture
def records(spark):
    return spark.createDataFrame(list(enumerate(RECORDS)), "id int, body string").repartition(3)


# --- inferred schemas ---


def test_schema_over_all_rows(records):
    assert {f.name: f.dataType.simpleString() for f in infer_schema(records, "body").fields} == {
        "a": "string", "b": "struct<c:string,d e:double>", "big": "decimal(30,0)", "l": "array<double>",
        "m.n": "double", "n": "string", "q`r": "boolean", "ts": "string", "z": "struct<>",
    }
    exact = infer_schema(records, "body", exact_decimals=True)
    assert exact["b"].dataType["d e"].dataType.simpleString() == "decimal(2,1)"


def test_flat_records(records):
    flat = flatten_json(records, "body", ["id"])
    assert flat.columns == ["id", "a", "b.c", "b.d e", "big", "l", "m.n", "n", "q`r", "ts"]
    rows = {r[0]: r for r in flat.collect()}
    assert rows[0][1:4] == ("1", "x", 2.5) and rows[0][5] == [1.0, 2.5]
    assert rows[1][1] == "t" and rows[2][5] == [] and rows[2][8] is True
    assert rows[5][1] == '{"k":1}' and str(rows[5][4]) == "123456789012345678901234567890"
    assert set(rows[3][1:]) == set(rows[4][1:]) == {None}


def test_paths(records):
    found = {r.path: (r.type, r.mixed, r.filled) for r in json_paths(records, "body").collect()}
    assert found["a"] == ("string", True, 3) and found["n"] == ("string", False, 0)
    assert found["b.d e"] == ("double", False, 1) and found["l"] == ("array<double>", False, 2)


def test_paths_of_nothing(records):
    none = records.limit(0)
    assert flatten_json(none, "body", ["id"]).columns == ["id", "body"]
    assert [(r.path, r.filled) for r in json_paths(none, "body").collect()] == [("", 0)]


def test_a_declared_schema_refuses_other_kinds(records):
    only = records.filter("id < 2")
    with pytest.raises(Exception, match="cannot be cast into"):
        flatten_json(only, "body", ["id"], infer_schema(only.filter("id = 0"), "body")).collect()
    loose = typed_json(only, "body", infer_schema(only.filter("id = 0"), "body"), malformed="null")
    assert sorted((r.id, r.body.a) for r in loose.collect()) == [(0, 1), (1, None)]


def test_malformed_text(spark):
    bad = spark.createDataFrame([("{",), ('{"a":1}',)], "body string")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        infer_schema(bad, "body")
    assert sorted(r.a or 0 for r in flatten_json(bad, "body", malformed="null").collect()) == [0, 1]
    with pytest.raises(ValueError, match="unknown mode"):
        infer_schema(bad, "body", malformed="skip")


def test_keys_that_are_data(spark):
    many = spark.range(50).select(F.concat(F.lit('{"k'), F.col("id").cast("string"), F.lit('":1}')).alias("body"))
    assert len(infer_schema(many, "body").fields) == 50
    with pytest.raises(TooManyPaths, match="50 paths"):
        infer_schema(many, "body", max_paths=49)


def test_athlete_as_text(spark, tables, tmp_path):
    athlete = spark.createDataFrame([('{"id":7,"bike":{"km":1.5},"clubs":[]}',)], "body string")
    found = stage_athlete_text(spark, athlete, tables=tables, root=str(tmp_path))
    assert [(r[0], r[1], r[2]) for r in found.collect()] == [(1.5, [], 7)]
    assert found.columns == ["bike.km", "clubs", "id"]


# --- integers as text ---


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("3.0", 3), (" 7 ", 7), ("-4.", -4), ("+3", 3), ("1e3", 1000), ("1.25e2", 125), ("-100e-2", -1), ("0e999", 0), ("-0.0", 0),
        ("9223372036854775807.000", 2**63 - 1), ("1.99999999999", None), ("1.00000000001", None), ("1.25e1", None), ("1e-2", None),
        ("9223372036854775808", None), ("1e40", None), ("abc", None), ("", None), (".5", None), (".", None), ("1e", None),
    ],
)
def test_whole_numbers_in_text(spark, text, value):
    df = spark.createDataFrame([(text,)], "v string")
    assert conform(df, "v bigint", "null").first().v == value
    assert cast_failures(df, "v bigint").first().v == (value is None)
    assert (checked(df, "v bigint").first().reasons == []) == (value is not None)


# --- pages ---

SCHEMA = "id int NOT NULL, n string, `sub.x` int"


@pytest.fixture
def pages(tmp_path):
    def write(**files):
        for name, text in files.items():
            (tmp_path / f"{name}.json").write_text(text)
        return str(tmp_path)

    return write


def test_good_records_and_rejects(spark, pages):
    path = pages(
        page_1='[{"id":1,"n":"a","sub":{"x":1.0}},{"id":"zz","n":null},{"id":2,"sub":{"x":"1.5"}},5,{"n":"no id","sub":3}]',
        page_2='[{"id":3,"n":"c"},{"id":4,"n"', page_3='{"message":"no"}', page_4=" [ ] ", page_5='[{"id":9}]',
    )
    good, bad = load_pages(spark, path, SCHEMA, key="id")
    assert [tuple(r) for r in good.collect()] == [(1, "a", 1)]
    found = sorted(((r.file.rsplit("/", 1)[1], r.place if r.place is not None else -1, r.key, r.reason) for r in bad.collect()))
    assert found == [
        ("page_1.json", 1, "zz", "column id: value cannot be cast to int"),
        ("page_1.json", 2, "2", "column sub.x: value cannot be cast to int"),
        ("page_1.json", 3, None, "the record is no object"),
        ("page_1.json", 4, None, "column id: null in a NOT NULL column"),
        ("page_1.json", 4, None, "column sub: no object"),
        ("page_2.json", -1, None, "the page is no JSON"),
        ("page_3.json", -1, None, "the page is no array"),
    ]
    assert {json.loads(r.record)["sub"]["x"] for r in bad.filter("place = 2").collect()} == {"1.5"}


def test_several_faults_of_one_record(spark, pages):
    found = check_pages(page_files(spark, pages(p1='[{"n":"x","sub":{"x":"y"}}]')), SCHEMA)
    assert sorted(r.reason for r in rejects(found).collect()) == [
        "column id: null in a NOT NULL column", "column sub.x: value cannot be cast to int",
    ]
    assert fitting(found).count() == 0 and rejects(found).first().key is None


def test_arrays_of_other_values(spark, pages):
    path = pages(p1='[{"a":[1,"x"]},{"a":[1,null,"2.5"]},{"a":"q"},{"a":null},{},{"a":[]}]')
    found = check_pages(page_files(spark, path), "a array<double>")
    assert [(r.place, r.reason) for r in rejects(found).orderBy("place").collect()] == [
        (0, "column a: value cannot be cast to array<double>"), (2, "column a: value cannot be cast to array<double>"),
    ]
    assert [(r.place, r.a) for r in fitting(found, ["place"]).orderBy("place").collect()] == [(1, [1.0, None, 2.5]), (3, None), (4, None), (5, [])]


def test_pages_in_order_of_their_numbers(spark, pages):
    path = pages(p10='[{"id":10}]', p9='[{"id":9}]', p11="[]", p12='[{"id":12}]')
    found = fitting(check_pages(until_empty(page_files(spark, path), first=9), SCHEMA), ["page", "place"])
    assert sorted((r.page, r.place, r.id) for r in found.collect()) == [(9, 0, 9), (10, 0, 10)]


def test_empty_first_page_and_no_pages(spark, pages):
    path = pages(p1="[]", p2='[{"id":2}]')
    assert until_empty(page_files(spark, path)).count() == 0
    none = page_files(spark, path).limit(0)
    assert until_empty(none).count() == 0
    with pytest.raises(QualityError, match="no end"):
        until_empty(none, require_end=True)


def test_missing_doubled_and_unnumbered_pages(spark, pages, tmp_path):
    path = pages(p1='[{"id":1}]', p3='[{"id":3}]', p4="[]")
    with pytest.raises(QualityError, match="1 pages are missing before page 4: {'page': 2}"):
        until_empty(page_files(spark, path))
    pages(p2='[{"id":2}]', again_p2='[{"id":2}]')
    with pytest.raises(QualityError, match="several files"):
        until_empty(page_files(spark, path))
    (tmp_path / "x.json").write_text("[]")
    with pytest.raises(QualityError, match="without a number"):
        until_empty(page_files(spark, path))


def test_activity_pages_staged_beside_their_rejects(spark, tables, pages, tmp_path):
    path = pages(p1='[{"id":1,"name":"Ride","athlete":{"id":5}},{"id":"x"}]', p2="[", p3="[]")
    staged = stage_activity_pages(spark, path, tables, root=str(tmp_path / "tables"))
    assert [(r["id"], r["name"], r["athlete.id"]) for r in staged.collect()] == [(1, "Ride", 5)]
    assert sorted(r.reason for r in spark.table(tables.rejects).collect()) == [
        "column id: value cannot be cast to bigint", "the page is no JSON",
    ]


# --- answers ---


def answers(spark, rows):
    return spark.createDataFrame(rows, "at int, activity_id long, attempt int, status int, body string").repartition(3)


def test_first_refusal(spark):
    rows = [(1, 10, 1, 200, "[]"), (2, 5, 1, 200, "[]"), (2, 6, 1, 429, None), (2, 7, 1, 200, "[]"), (3, 1, 1, None, None), (None, 2, 1, 200, "[]")]
    kept = until_first_refusal(answers(spark, rows), ["at", "activity_id"])
    assert sorted(r.activity_id for r in kept.collect()) == [2, 5, 10]
    fine = answers(spark, rows[:2])
    assert until_first_refusal(fine, ["at", "activity_id"]).count() == 2
    assert until_first_refusal(fine.limit(0), ["at"]).count() == 0
    assert until_first_refusal(answers(spark, [*rows, (None, 1, 1, 500, "x")]), ["at", "activity_id"]).count() == 0


def test_last_answer_of_a_key(spark):
    rows = [(1, 1, 1, 200, "old"), (1, 1, 2, 200, "new"), (1, 1, 3, 429, None), (1, 2, 1, 429, "a"), (1, 2, 2, 500, "b"), (1, 3, 1, 200, "x"), (1, 3, 1, 200, "y")]
    got = {r.activity_id: (r.attempt, r.status, r.body) for r in last_answers(answers(spark, rows), "activity_id", "attempt").collect()}
    assert got == {1: (2, 200, "new"), 2: (2, 500, "b"), 3: (1, 200, "y")}


@pytest.fixture
def tables(spark):
    import uuid

    name = f"loads_{uuid.uuid4().hex}"
    return StagingTables(**{t: f"{name}_{t}" for t in ("athlete", "activity", "zone", "bucket", "no_zone", "rejects")})


def test_children_from_repeated_and_refused_answers(spark, tables, tmp_path):
    def body(score):
        return json.dumps([{"type": "power", "score": score, "distribution_buckets": [{"min": 0, "max": 9, "time": score}]}])

    overwrite(spark.range(1, 6).select("id"), tables.activity, root=str(tmp_path))
    got = answers(spark, [(1, 1, 1, 200, body(1)), (2, 1, 2, 200, body(2)), (3, 2, 1, 200, "[]"), (4, 3, 1, 429, None), (5, 4, 1, 200, body(4))])
    with pytest.raises(QualityError, match="share a key"):
        stage_children(spark, got, tables, root=str(tmp_path))
    stage_children(spark, got, tables, root=str(tmp_path), order=["at"], attempt="attempt")
    assert [(r.activity_id, r.score) for r in spark.table(tables.zone).collect()] == [(1, 2)]
    assert [r.activity_id for r in spark.table(tables.no_zone).collect()] == [2]
    later = answers(spark, [(1, 3, 1, 200, body(3)), (2, 4, 1, 200, body(4)), (3, 1, 9, 200, body(9))])
    stage_children(spark, later, tables, root=str(tmp_path), order=["at"], attempt="attempt")
    assert sorted((r.activity_id, r.score) for r in spark.table(tables.zone).collect()) == [(1, 2), (3, 3), (4, 4)]


# --- second loads ---


def test_old_keys_stay(spark, tmp_path):
    def load(rows):
        return spark.createDataFrame(rows, "c string, s string")

    columns, order = {"c": "country", "s": "state"}, ["country", "state"]
    first = load([("NO", "a"), ("SE", None), ("NO", "a")])
    known = overwrite(dimension(first, "sk", columns, order), f"dim_{tmp_path.name}".replace("-", "_"), root=str(tmp_path))
    second = load([("AT", "z"), ("NO", "a"), (None, None), ("SE", None), ("SE", "b")])
    grown = grown_dimension(second, known, "sk", columns, order)
    assert sorted((r.sk, r.country, r.state) for r in grown.collect()) == [
        (1, "NO", "a"), (2, "SE", None), (3, None, None), (4, "AT", "z"), (5, "SE", "b"),
    ]
    assert grown.schema["sk"].dataType.simpleString() == "int"
    again = grown_dimension(second.limit(0), known, "sk", columns, order)
    assert sorted(r.sk for r in again.collect()) == [1, 2]
    assert sorted(r.sk for r in grown_dimension(first, known.limit(0), "sk", columns, order).collect()) == [1, 2]
    with pytest.raises(ValueError, match="every column"):
        grown_dimension(first, known, "sk", columns, ["country"])


def test_partitions_that_an_increment_touches(spark, tmp_path):
    table = f"parts_{tmp_path.name}".replace("-", "_")
    rows = [(i, f"p{i % 4}", float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, p string, v double")
    overwrite(df, table, partition_by=["p"], root=str(tmp_path))

    def files():
        return {r.f for r in spark.table(table).select(F.col("_metadata.file_path").alias("f"), "p").filter("p <> 'p1'").distinct().collect()}

    before = files()
    source = spark.createDataFrame([(1, "p1", -1.0), (41, "p1", -41.0)], "k long, p string, v double")
    found = merge_into(table, source, ["p", "k"], root=str(tmp_path))
    assert found.count() == 41 and {r.v for r in found.filter("k in (1, 41)").collect()} == {-1.0, -41.0}
    assert files() == before and len(before) == 3  # one file for each partition
    overwrite(df.select("p", "k"), table, allow_schema_change=True, root=str(tmp_path))
    assert spark.table(table).count() == 40 and set(spark.table(table).columns) == {"k", "p"}


def test_files_that_an_increment_leaves(spark, tmp_path):
    table = f"by_part_{tmp_path.name}".replace("-", "_")
    df = spark.range(1000).selectExpr("id as k", "cast(id as string) as v")
    overwrite(with_part(df, ["k"], 16), table, partition_by=["part"], root=str(tmp_path))

    def files():
        return {(r.part, r.f) for r in spark.table(table).select("part", F.col("_metadata.file_path").alias("f")).distinct().collect()}

    before = files()
    source = with_part(spark.createDataFrame([(7, "new"), (5000, "more")], "k long, v string"), ["k"], 16)
    touched = {r.part for r in source.collect()}
    found = merge_into(table, source, ["part", "k"], root=str(tmp_path))
    assert found.count() == 1001 and {r.v for r in found.filter("k in (7, 5000)").collect()} == {"new", "more"}
    assert {p for p, _ in before} == set(range(16))
    assert {x for x in files() if x[0] not in touched} == {x for x in before if x[0] not in touched}
    assert before - files() == {x for x in before if x[0] in touched}


# --- counts on the way ---


def test_counts_of_a_write(spark, tmp_path):
    df = spark.range(100).withColumn("t", F.when(F.col("id") % 10 > 0, "x"))
    counted = Counted(nulls=F.count_if(F.col("t").isNull()), most=F.max("id"))
    overwrite(counted.watch(df), f"counted_{tmp_path.name}".replace("-", "_"), root=str(tmp_path))
    assert counted.values == {"rows": 100, "nulls": 10, "most": 99} and counted.rows == 100
    stored, values = materialize_counted(df.filter("id < 0"), most=F.max("id"))
    assert stored.count() == 0 and values == {"rows": 0, "most": None}


# --- marks of lookups ---


def test_marked_lookups(spark):
    facts = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "a", None), (4, "c", 9), (5, None, 2)], "id int, t string, d int")
    types = spark.createDataFrame([("a", 10), ("b", 20)], "type string, sk_type int")
    days = spark.createDataFrame([(1, 100), (2, 200)], "day int, sk_day int")
    lookups = [Lookup("type", types, {"t": "type"}, ["sk_type"]), Lookup("day", days, {"d": "day"}, ["sk_day"], rows=2)]
    for bound in (500_000, 0):  # broadcast, and joined by key
        marked = marked_lookups(facts, lookups, broadcast_rows=bound)
        got = {r.id: (r.sk_type, r.sk_day, r.missed) for r in marked.collect()}
        assert got == {1: (10, 100, 0), 2: (20, 100, 0), 3: (10, None, 2), 4: (None, None, 3), 5: (None, 200, 1)}
    names = marked.select("id", missed_names(lookups).alias("names")).collect()
    assert {r.id: r.names for r in names} == {1: [], 2: [], 3: ["day"], 4: ["type", "day"], 5: ["type"]}
    assert lookup(facts, types, {"t": "type"}, ["sk_type"], dim_rows=2).count() == 3
    with pytest.raises(ValueError, match="31 lookups"):
        marked_lookups(facts, lookups * 16)


# --- sparse pivot ---


def test_sparse_pivot(spark):
    rows = [(1, "x", 1, 5), (1, "x", 1, 6), (1, "y", 2, 7), (2, None, None, 8), (2, "x", 1, None)]
    wide = pivot_sparse(spark.createDataFrame(rows, "k int, t string, r int, m int"), "k", "t", "r", ["m"])
    got = {r.k: [tuple(c) for c in r.cells] for r in wide.collect()}
    assert got == {1: [("x", 1, 11), ("y", 2, 7)], 2: [(None, None, 8), ("x", 1, None)]}
    one = wide.select("k", sparse_cell("cells", "x", 1, "m").alias("x1"), sparse_cell("cells", "z", 1, "m").alias("z1"))
    assert {r.k: (r.x1, r.z1) for r in one.collect()} == {1: (11, None), 2: (None, None)}


# --- profile ---


def test_profile_in_one_pass(spark):
    zones = spark.createDataFrame([(1, 0, "power"), (1, 1, "heartrate"), (2, 0, "power"), (3, 0, None)], "activity_id long, zone_seq_no int, type string")
    buckets = spark.createDataFrame(
        [(1, 0, 0, 9), (1, 0, 9, 20), (1, 0, 9, 20), (1, 1, 0, 9), (3, 0, None, None), (7, 7, 0, 9)], "activity_id long, zone_seq_no int, min int, max int"
    ).withColumn("time", F.lit(1))
    found = profile_sets(zones, buckets).collect()
    plain = profile(zones, buckets)
    for name in ("zones_per_activity", "buckets_per_zone", "buckets_per_zone_by_type", "range_counts"):
        want = plain[name]
        told = [c for c in ("type", "min", "max") if c in want.columns]
        assert sorted(map(repr, ((*[r[c] for c in told], r["count"], r.groups) for r in found if r.report == name))) == sorted(
            map(repr, ((*[r[c] for c in told], r["count"], r.groups) for r in want.collect()))
        )


def test_profile_sets_holds_no_key_per_range(spark):
    """Reports come from one window pass: no grouping sets that keep a key for every range in one task; null and repeated keys too."""
    zones = spark.createDataFrame([(1, 0, "power"), (1, 0, "power"), (None, 0, "power"), (None, None, None)], "activity_id long, zone_seq_no int, type string")
    buckets = spark.createDataFrame(
        [(1, 0, 0, 9), (1, 0, 0, 9), (None, 0, 1, 2), (None, None, None, None), (1, 1, 3, 4)], "activity_id long, zone_seq_no int, min int, max int"
    ).withColumn("time", F.lit(1))
    found = profile_sets(zones, buckets)
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect()), key=repr) == [
        ("buckets_per_zone", None, None, None, 1, 3), ("buckets_per_zone", None, None, None, 2, 1),
        ("buckets_per_zone_by_type", "power", None, None, 1, 1), ("buckets_per_zone_by_type", "power", None, None, 2, 1),
        ("buckets_per_zone_by_type", None, None, None, 1, 1), ("range_counts", "power", 0, 9, 2, 1),
        ("range_counts", "power", 1, 2, 1, 1), ("range_counts", None, None, None, 1, 1), ("zones_per_activity", None, None, None, 2, 2),
    ]


# --- clocks ---


def test_hours_skipped_and_shown_twice(spark):
    rows = [
        ("2024-03-31T01:59:59Z", "(GMT+01:00) Europe/Oslo", "2024-03-31 00:59:59", 3600, "once"),
        ("2024-03-31T02:30:00Z", "(GMT+01:00) Europe/Oslo", "2024-03-31 01:30:00", 7200, "gap"),
        ("2024-03-31T03:00:00Z", "(GMT+01:00) Europe/Oslo", "2024-03-31 01:00:00", 7200, "once"),
        ("2024-10-27T02:30:00Z", "(GMT+01:00) Europe/Oslo", "2024-10-27 00:30:00", 7200, "overlap"),
        ("2024-10-27T03:00:00Z", "(GMT+01:00) Europe/Oslo", "2024-10-27 02:00:00", 3600, "once"),
        ("2024-04-07T01:45:00Z", "(GMT+10:30) Australia/Lord_Howe", "2024-04-06 14:45:00", 39600, "overlap"),
        ("2024-07-01T12:00:00Z", "Asia/Kolkata", "2024-07-01 06:30:00", 19800, "once"),
        ("2011-12-30T12:00:00Z", "(GMT+13:00) Pacific/Apia", "2011-12-30 22:00:00", 50400, "gap"),
        (None, "Europe/Oslo", None, None, None),
        ("2024-01-01T00:00:00Z", None, None, None, None),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "at string, timezone string")
    got = [(r.at, r.timezone, str(r.utc) if r.utc else None, r.offset_seconds, r.clock) for r in zone_time(df, "at", "timezone").collect()]
    assert got == rows


def test_zone_time_in_any_session_zone(spark):
    df = spark.createDataFrame([("2024-03-31T02:30:00Z", "Europe/Oslo")], "at string, timezone string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert zone_time(df, "at", "timezone").first().utc == datetime(2024, 3, 31, 1, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    with pytest.raises(Exception, match="(?i)zone|atlantis"):
        zone_time(df.withColumn("timezone", F.lit("(GMT) Atlantis")), "at", "timezone").collect()


def test_zone_names(spark):
    texts = ["(GMT+01:00) Europe/Oslo", "Europe/Oslo", " (GMT-03:30)  America/St_Johns "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(zone_of(F.col("t"))).collect()] == ["Europe/Oslo", "Europe/Oslo", "America/St_Johns"]


# --- the mart with kept keys and rejects ---


def test_mart_keeps_its_keys_and_lists_rejects(spark, tables, tmp_path):
    from starbuild.plans.schemas import ACTIVITY, BUCKET, ZONE

    root = str(tmp_path)
    mart = MartTables(*[f"{tables.activity}_{t}" for t in ("sport", "geo", "time", "fact")])

    def load(rows):
        names = [f.name for f in spark.createDataFrame([], ACTIVITY).schema.fields]
        df = spark.createDataFrame(rows, "id long, location_country string, start_date_local string")
        df = df.withColumns({"type": F.lit("Ride"), "sport_type": F.lit("Ride"), "location_city": F.lit("c"), "location_state": F.lit("s")})
        overwrite(conform(df.select(*[F.col(n) if n in df.columns else F.lit(None).alias(n) for n in names]), ACTIVITY), tables.activity, root=root)
        return build_mart(spark, tables, mart, root=root, keep_keys=True, rejects=tables.rejects)

    overwrite(spark.createDataFrame([], ZONE), tables.zone, root=root)
    overwrite(spark.createDataFrame([], BUCKET), tables.bucket, root=root)
    rows = [(1, "Norway", "2020-01-01T10:00:00Z"), (2, None, "2020-01-01T10:00:00Z"), (3, None, "1999-01-01T10:00:00Z")]
    fact = load(rows)
    first = {r.id: r.sk_geography for r in fact.collect()}
    assert set(first) == {1}
    assert sorted((r.id, r.missed, r.dimensions) for r in spark.table(tables.rejects).collect()) == [(2, 2, "geography"), (3, 6, "geography,time")]
    second = {r.id: r.sk_geography for r in load([*rows, (4, "Austria", "2020-01-02T10:00:00Z")]).collect()}
    assert second[1] == first[1] and second[4] > max(first.values())

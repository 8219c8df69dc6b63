"""Transforms on small made-up frames: the cases SQL on the test tables does not reach."""

import pytest
from pyspark.sql import functions as F

from starbuild.functions import date_parts, label_nulls
from starbuild.operators.conform import cast_failures, conform
from starbuild.operators.dims import date_dim, date_dim_over, dimension
from starbuild.operators.incremental import merged_rows, new_rows, pending_keys, updated_rows, upsert
from starbuild.operators.lookup import dropped_by_lookup, lookup
from starbuild.operators.nested import empty_keys, explode_indexed, explode_inner, flatten_structs
from starbuild.operators.pivot import PivotSpec, discover_types, pivot_children, pivot_values
from starbuild.operators.quality import (
    QualityError,
    require_empty,
    spec_violations,
    type_sizes,
    uniform_group_violations,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# conform


def test_conform_selects_casts_and_orders(spark):
    df = spark.createDataFrame([(1, "2", 3.5)], "extra int, b string, a double")
    found = conform(df, "a float, b int")
    assert found.dtypes == [("a", "float"), ("b", "int")]
    assert rows(found) == [(3.5, 2)]


def test_conform_missing_column(spark):
    with pytest.raises(ValueError, match="missing from the source: b, c"):
        conform(spark.createDataFrame([(1,)], "a int"), "a int, b int, c int")


def test_conform_names_the_column_of_a_bad_value(spark):
    df = spark.createDataFrame([("g12",), (None,)], "gear_id string")
    with pytest.raises(Exception, match="column gear_id: value cannot be cast to int"):
        conform(df, "gear_id int").collect()
    assert rows(conform(df, "gear_id int", mode="null")) == [(None,), (None,)]
    assert rows(cast_failures(df, "gear_id int")) == [(1,)]


def test_conform_refuses_overflow(spark):
    with pytest.raises(Exception, match="column a: value cannot be cast"):
        conform(spark.createDataFrame([(2**40,)], "a bigint"), "a int").collect()


def test_conform_not_null(spark):
    df = spark.createDataFrame([(1,), (None,)], "a bigint")
    with pytest.raises(Exception, match="column a: null in a NOT NULL column"):
        conform(df, "a bigint NOT NULL").collect()


def test_conform_dotted_names_and_arrays(spark):
    df = spark.createDataFrame([([1.5, 2.5], ("x",))], "p array<double>, map struct<id: string>")
    found = conform(flatten_structs(df), "`map.id` string, p array<float>")
    assert found.dtypes == [("map.id", "string"), ("p", "array<float>")]
    assert rows(found) == [("x", [1.5, 2.5])]


# nested


def test_flatten_null_struct_and_depth(spark):
    df = spark.createDataFrame([(1, (2, (3,))), (4, None)], "a int, s struct<b: int, t: struct<c: int>>")
    found = flatten_structs(df)
    assert found.columns == ["a", "s.b", "s.t.c"]
    assert rows(found) == [(1, 2, 3), (4, None, None)]


def test_explode_with_positions(spark):
    df = spark.createDataFrame(
        [(1, [([(10, 20), (20, 30)],), ([],)]), (2, []), (3, None)],
        "id int, z array<struct<b: array<struct<lo: int, hi: int>>>>",
    )
    outer = explode_indexed(df, ["id"], "z", "seq", "e")
    assert rows(outer.select("id", "seq")) == [(1, 0), (1, 1)]
    assert rows(explode_inner(outer, ["id", "seq"], "e.b")) == [(1, 0, 10, 20), (1, 0, 20, 30)]
    assert rows(empty_keys(df, "id", "z")) == [(2,)]


# dimensions and lookups


def test_calendar_parity(spark):
    cal = date_dim(spark)
    assert cal.count() == 8035
    assert cal.dtypes == [("date", "date"), ("sk_time", "string"), ("year", "int"), ("month", "int"), ("day", "int")]
    ends = cal.agg(F.min("sk_time"), F.max("sk_time"), F.countDistinct("sk_time")).first()
    assert tuple(ends) == ("20090101", "20301231", 8035)


def test_calendar_over_data(spark):
    df = spark.createDataFrame([("2020-02-29T01:02:03Z",), ("2021-01-01T00:00:00Z",), (None,)], "at string")
    found = date_dim_over(df, F.col("at")).agg(F.count("*"), F.min("sk_time"), F.max("sk_time")).first()
    assert tuple(found) == (731, "20200101", "20211231")
    assert date_dim_over(df.filter("at is null"), F.col("at")).count() == 0


def test_dimension_numbers_nulls_first(spark):
    df = spark.createDataFrame([("b", "x"), (None, "y"), ("a", "y"), ("a", "y"), (None, None)], "p string, q string")
    found = dimension(df, "sk", {"p": "first", "q": "second"}, ["second", "first"])
    assert found.columns == ["sk", "first", "second"]
    assert rows(found) == [(1, None, None), (2, "b", "x"), (3, None, "y"), (4, "a", "y")]
    with pytest.raises(ValueError):
        dimension(df, "sk", {"p": "first", "q": "second"}, ["first"])


def test_lookup_drops_null_and_unknown_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    dim = spark.createDataFrame([(10, "a"), (11, None)], "sk int, natural string")
    assert rows(lookup(df, dim, {"k": "natural"}, ["sk"])) == [(1, "a", 10)]
    assert rows(dropped_by_lookup(df, dim, {"k": "natural"}, "d")) == [("d", 2)]


def test_date_parts_ignore_zone_and_session(spark):
    df = spark.createDataFrame([("2023-06-30T23:30:05Z",), (None,), ("2024-02-29 01:02:03",)], "at string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        found = rows(date_parts(df, "at").drop("at"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == [(2023, 6, 30, 23, 30, 5), (2024, 2, 29, 1, 2, 3), (None,) * 6]


def test_label_nulls(spark):
    df = spark.createDataFrame([(None, None), ("a", "b")], "x string, y string")
    assert rows(label_nulls(df, ["x"])) == [("N/A", None), ("a", "b")]


# pivot and its rules

SPEC = PivotSpec({"p": 2, "h": 1}, {"score": "score", "zone_type": "type"}, ("lo", "time"))


def child(spark, data):
    return spark.createDataFrame(data, "id int, type string, score int, rank int, lo int, time int")


def test_pivot_columns_values_and_types(spark):
    df = child(spark, [(1, "p", 7, 1, 0, 5), (1, "p", 7, 2, 10, 6), (1, "h", 3, 1, 1, 2), (2, "h", 4, 1, 0, None), (3, "x", 1, 1, 9, 9)])
    found = pivot_children(df, "id", SPEC)
    assert found.columns == ["id", *SPEC.columns]
    assert SPEC.columns == ["score_p", "zone_type_p", "score_h", "zone_type_h", "lo_p1", "time_p1", "lo_p2", "time_p2", "lo_h1", "time_h1"]
    assert dict(found.dtypes)["lo_p1"] == "bigint" and dict(found.dtypes)["score_p"] == "int"
    assert rows(found) == [
        (1, 7, "p", 3, "h", 0, 5, 10, 6, 1, 2),
        (2, None, None, 4, "h", None, None, None, None, 0, None),
        (3, *[None] * 10),
    ]


def test_pivot_adds_up_two_groups_of_one_type(spark):
    df = child(spark, [(1, "p", 7, 1, 1, 5), (1, "p", 9, 1, 2, 6)])
    assert rows(pivot_children(df, "id", SPEC).select("score_p", "lo_p1", "time_p1")) == [(9, 3, 11)]


def test_pivot_values(spark):
    df = child(spark, [(1, "p", 7, 1, 1, 5), (1, "h", 9, 1, 2, 6)])
    found = pivot_values(df, "id", "type", ["p", "h", "q"], [F.sum("time").alias("t")])
    assert found.columns == ["id", "p", "h", "q"] and rows(found) == [(1, 5, 6, None)]



def test_pivot_values_adds_up_only_after_the_shuffle(spark):
    df = child(spark, [(1, "p", 7, 1, 1, 5), (1, "h", 9, 1, 2, 6)])
    found = pivot_values(df, "id", "type", ["p", "h", "q"], [F.sum("time").alias("t")])
    plan = found._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning(id"):]
    assert "HashAggregate" not in below and rows(found) == [(1, 5, 6, None)]

def test_type_rules(spark):
    sizes = spark.createDataFrame([("p", 2), ("h", 1), ("h", 2), (None, 1), ("x", 1), ("q", 3)], "type string, n int")
    assert rows(uniform_group_violations(sizes, "type")) == [("h", 2)]
    types = {"p": 2, "h": 2, "q": 2}
    found = {r["type"]: r["reason"] for r in spec_violations(sizes, "type", "n", types).collect()}
    assert found == {"h": "groups of different size", None: "null type", "x": "type not declared", "q": "more rows than declared"}
    assert spec_violations(sizes.filter("type = 'p'"), "type", "n", types).isEmpty()
    assert spec_violations(sizes, "type", "n", {}).count() == 5


def test_require_empty(spark):
    require_empty(spark.range(0), "fine")
    with pytest.raises(QualityError, match="broken: {'id': 0}"):
        require_empty(spark.range(3), "broken")


def test_discover_types(spark):
    df = spark.createDataFrame([(1, "p"), (1, "p"), (2, "h")], "g int, type string")
    sizes = type_sizes(df, ["g"], "type")
    assert discover_types(sizes, "type", "bucket_count") == {"h": 1, "p": 2}
    with pytest.raises(ValueError, match="more than 1 types"):
        discover_types(sizes, "type", "bucket_count", max_types=1)
    with pytest.raises(ValueError, match="null type"):
        discover_types(spark.createDataFrame([(None, 1)], "type string, n int"), "type", "n")


# incremental


def test_pending_keys(spark):
    parent = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "id bigint")
    loaded = spark.createDataFrame([(2,), (2,), (None,)], "activity_id bigint")
    empty = spark.createDataFrame([(3,)], "activity_id bigint")
    assert rows(pending_keys(parent, "id", (loaded, "activity_id"), (empty, "activity_id"))) == [(1,), (None,)]


def target(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 0)], "k int, v string, n int")


@pytest.mark.parametrize("small", [False, True])
def test_upsert_updates_inserts_and_keeps(spark, small):
    source = spark.createDataFrame([(2, None, 21), (3, "c", 30)], "k int, v string, n int")
    found = upsert(target(spark), source, ["k"], small=small)
    assert rows(found) == [(1, "a", 10), (2, None, 21), (3, "c", 30), (None, "n", 0)]


@pytest.mark.parametrize("small", [False, True])
def test_upsert_of_some_columns(spark, small):
    source = spark.createDataFrame([("z", 2, 21), ("c", 3, 30)], "v string, k int, n int")
    found = upsert(target(spark), source, ["k"], ["n"], small=small)
    assert rows(found) == [(1, "a", 10), (2, "b", 21), (3, "c", 30), (None, "n", 0)]


@pytest.mark.parametrize("small", [False, True])
def test_upsert_null_keys(spark, small):
    source = spark.createDataFrame([(None, "m", 1)], "k int, v string, n int")
    plain = upsert(target(spark), source, ["k"], small=small)
    assert rows(plain.filter("k is null")) == [(None, "m", 1), (None, "n", 0)]
    safe = upsert(target(spark), source, ["k"], null_safe=True, small=small)
    assert rows(safe.filter("k is null")) == [(None, "m", 1)]


def test_upsert_insert_only(spark):
    source = spark.createDataFrame([(2, "z", 0), (4, "d", 40)], "k int, v string, n int")
    found = upsert(target(spark), source, ["k"], update=[])
    assert rows(found) == [(1, "a", 10), (2, "b", 20), (4, "d", 40), (None, "n", 0)]


def test_upsert_refuses_duplicate_keys(spark):
    source = spark.createDataFrame([(5, "a", 1), (5, "b", 2)], "k int, v string, n int")
    with pytest.raises(QualityError, match="several source rows share a key"):
        upsert(target(spark), source, ["k"])
    nulls = spark.createDataFrame([(None, "a", 1), (None, "b", 2)], "k int, v string, n int")
    assert upsert(target(spark), nulls, ["k"]).count() == 5
    with pytest.raises(QualityError):
        upsert(target(spark), nulls, ["k"], null_safe=True)


def test_upsert_of_a_frame_derived_from_the_target(spark):
    t = target(spark).dropna()
    source = t.filter("k = 2").withColumn("n", F.col("n") + 1)
    once = upsert(t, source, ["k"])
    assert rows(once) == [(1, "a", 10), (2, "b", 21)]
    assert rows(upsert(once, source, ["k"])) == rows(once)


@pytest.mark.parametrize("null_safe", [False, True])
def test_the_two_ways_to_merge_agree(spark, null_safe):
    t = spark.range(0, 60).select(
        F.when(F.col("id") % 7 != 0, F.col("id")).alias("k"), (F.col("id") % 5).alias("g"), F.lit("old").alias("v"), F.col("id").alias("n")
    )
    source = spark.range(40, 90).select(
        F.when(F.col("id") != 50, F.col("id")).alias("k"), (F.col("id") % 5).alias("g"),
        F.when(F.col("id") % 3 != 0, "new").alias("v"), (F.col("id") * 2).alias("n"),
    )
    for update in (["v", "n"], ["v"]):
        one = merged_rows(t, source, ["k", "g"], update, null_safe)
        two = updated_rows(t, source, ["k", "g"], update, null_safe).unionByName(new_rows(t, source, ["k", "g"], null_safe))
        assert one.columns == t.columns and rows(one) == rows(two)


def test_upsert_with_a_hot_target_key(spark, monkeypatch):
    monkeypatch.setattr("starbuild.operators.incremental.hot_keys", lambda df, keys: {1: 4})
    source = spark.createDataFrame([(2, None, 21), (3, "c", 30)], "k int, v string, n int")
    assert rows(upsert(target(spark), source, ["k"])) == [(1, "a", 10), (2, None, 21), (3, "c", 30), (None, "n", 0)]


def test_conform_keeps_fractions_out_of_integers(spark):
    whole = spark.createDataFrame([(3.0, "3.0"), (None, " 4 ")], "a double, b string")
    assert rows(conform(whole, "a int, b bigint")) == rows(spark.createDataFrame([(3, 3), (None, 4)], "a int, b bigint"))
    odd = spark.createDataFrame([(1.7, "1.7"), (float("nan"), "x"), (1e30, "")], "a double, b string")
    assert [tuple(r) for r in cast_failures(odd, "a int, b int").collect()] == [(3, 3)]
    with pytest.raises(Exception, match="column a: value cannot be cast"):
        conform(odd, "a int").collect()

"""Hot keys: rows and numbers must be those of the plain join and the plain window."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starbuild.operators.lookup import left_enrich, lookup
from starbuild.operators.numbering import rank_in_group, surrogate_key
from starbuild.operators.skew import hot_keys, key_hash, skew_join


def bag(df):
    columns = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(columns).collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, a third under null, and copies of one row."""
    rows = spark.range(0, 3000, 1, 6)
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 50)
    return rows.select(key.cast("bigint").alias("k"), (F.col("id") % 40).alias("v"), F.lit("x").alias("w"))


def test_hot_keys_lists_only_large_shares(spark, skewed):
    hot = hot_keys(skewed, ["k"], min_rows=100)
    expected = spark.createDataFrame([(7,), (None,)], "k bigint").select(key_hash(["k"])).collect()
    assert set(hot) == {r[0] for r in expected}
    assert all(4 < ways <= 16 for ways in hot.values())
    assert hot_keys(skewed, ["k"]) == {}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(spark, skewed, how):
    right = spark.range(0, 30).select(F.col("id").alias("k"), (F.col("id") * 10).alias("r"))
    right = right.unionByName(spark.createDataFrame([(None, -1)], "k bigint, r bigint"))
    found = skew_join(skewed, right, ["k"], how, min_rows=100)
    assert bag(found) == bag(skewed.join(right, ["k"], how))


def test_skew_join_spreads_the_hot_key(spark, skewed):
    right = spark.range(0, 30).select(F.col("id").alias("k"), F.lit(1).alias("r"))
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set(setting, "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        where = skew_join(skewed, right, ["k"], "left", min_rows=100).filter("k = 7")
        assert where.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.set(setting, before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_skew_join_refuses_mixed_types(spark):
    left = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError, match="same types"):
        skew_join(left, spark.range(3).toDF("k"), ["k"])
    with pytest.raises(ValueError, match="join type"):
        skew_join(left, left, ["k"], "full")


def test_two_column_keys(spark, skewed):
    right = skewed.dropna().select("k", "v").distinct().withColumn("r", F.col("k") + F.col("v"))
    found = skew_join(skewed, right, ["k", "v"], "left", min_rows=1)
    assert bag(found) == bag(skewed.join(right, ["k", "v"], "left"))


def test_lookup_beyond_the_broadcast_bound(spark, skewed):
    dim = spark.range(0, 30).select(F.col("id").alias("natural"), (F.col("id") + 100).alias("sk"))
    small = lookup(skewed, dim, {"k": "natural"}, ["sk"])
    large = lookup(skewed, dim, {"k": "natural"}, ["sk"], broadcast_rows=5, min_rows=100)
    assert small.columns == large.columns == ["k", "v", "w", "sk"]
    assert bag(small) == bag(large)


def test_left_enrich_keeps_every_row(spark, skewed):
    agg = spark.range(0, 10).select(F.col("id").alias("c"), F.lit(1).alias("n"))
    found = left_enrich(skewed, agg, "k", "c", min_rows=100)
    assert found.count() == skewed.count()
    assert bag(found) == bag(skewed.join(agg.withColumnRenamed("c", "k"), "k", "left"))


def plain_rank(df, group, order):
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def test_rank_of_large_groups_and_copies(skewed):
    found = rank_in_group(skewed, ["k"], ["v", "w"], min_rows=100)
    assert bag(found) == bag(plain_rank(skewed, ["k"], ["v", "w"]))
    assert dict(found.dtypes)["rank"] == "int"


def test_rank_of_one_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr("starbuild.operators.numbering.RUN", 100)
    copies = spark.range(0, 1000, 1, 4).select(F.lit(1).alias("k"), F.lit(2).alias("v"))
    found = rank_in_group(copies, ["k"], ["v"], min_rows=10)
    assert bag(found) == [(1, i, 2) for i in sorted(range(1, 1001), key=lambda i: repr((1, i, 2)))]


def test_rank_spreads_a_large_group(spark):
    rows = spark.range(0, 4000, 1, 4).select(F.lit(1).alias("k"), (F.col("id") * 7 % 4001).alias("v"))
    found = rank_in_group(rows, ["k"], ["v"], min_rows=10)
    assert bag(found) == bag(plain_rank(rows, ["k"], ["v"]))


def test_rank_keep(skewed):
    found = rank_in_group(skewed, ["k"], ["v", "w"], keep=3)
    assert bag(found) == bag(plain_rank(skewed, ["k"], ["v", "w"]).filter("rank <= 3"))


def test_rank_keep_beyond_what_spark_cuts(skewed):
    found = rank_in_group(skewed, ["k"], ["v", "w"], keep=1005, min_rows=100)
    assert bag(found) == bag(plain_rank(skewed, ["k"], ["v", "w"]).filter("rank <= 1005"))


def test_surrogate_key_equals_global_row_number(spark):
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 3 != 0, F.concat(F.lit("p"), F.col("id") % 11)).alias("a"), F.col("id").alias("b")
    )
    found = surrogate_key(df, "sk", ["a", "b"])
    plain = df.select(F.row_number().over(Window.orderBy("a", "b")).alias("sk"), "a", "b")
    assert bag(found) == bag(plain)
    assert found.columns == ["sk", "a", "b"]
    assert dict(surrogate_key(df, "sk", ["a", "b"], "bigint").dtypes)["sk"] == "bigint"


def test_surrogate_key_of_nothing(spark):
    assert surrogate_key(spark.createDataFrame([], "a string"), "sk", ["a"]).count() == 0


def test_hot_keys_are_found_bucket_by_bucket(spark):
    """No task merges the sketches of all input tasks: the exchange is by bucket."""
    df = spark.range(0, 400_000, 1, 16).withColumn("k", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")))
    found = hot_keys(df, ["k"], 1000)
    assert list(found) == [spark.range(1).select(F.xxhash64(F.lit(7).cast("long"))).first()[0]]


def test_a_hot_key_is_dealt_out_after_a_shuffle_by_it(spark):
    left = spark.range(0, 60_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    right = spark.range(0, 60_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before, adaptive = spark.conf.get(setting), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set(setting, "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew_join(left.repartition(8, "k"), right, ["k"], min_rows=1000)
        assert joined.count() == 60_000
        assert joined.where("k = 7").groupBy(F.spark_partition_id()).count().count() > 1
    finally:
        spark.conf.set(setting, before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_hot_group_with_map_columns(spark):
    """Rows whose maps cannot be grouped or sorted are ranked over several tasks, too; copies stay."""
    rows = [(i % 2, i // 4, {"a": i % 3, "b": 1}, [{"x": i}]) for i in range(200)] + [(0, 7, None, None)] * 3
    df = spark.createDataFrame(rows, "g int, o int, m map<string,int>, l array<map<string,int>>")
    ranked = rank_in_group(df, ["g"], ["o"], min_rows=10, hot={h: 8 for (h,) in df.select(key_hash(["g"])).distinct().collect()})
    found = ranked.collect()
    assert sorted((r.g, r.rank) for r in found) == [(g, i) for g, n in ((0, 103), (1, 100)) for i in range(1, n + 1)]
    for g in (0, 1):
        orders = [r.o for r in sorted((r for r in found if r.g == g), key=lambda r: r.rank)]
        assert orders == sorted(orders)
    assert sorted(repr((r.g, r.o, r.m, r.l)) for r in found) == sorted(repr(tuple(r)) for r in df.collect())

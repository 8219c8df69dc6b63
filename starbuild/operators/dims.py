"""Dimensions: distinct natural keys with a dense surrogate key, and the calendar."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import date_key, to_local_time
from .numbering import surrogate_key

# The calendar's first and last day.
CALENDAR = ("2009-01-01", "2030-12-31")


def dimension(df: DataFrame, key: str, columns: Mapping[str, str], order: Sequence[str]) -> DataFrame:
    """Distinct rows of `columns` (source name to dimension name), numbered by `order`.

    `order` names dimension columns and must include all of them. Null counts as a value and
    sorts first. Adding a natural key renumbers those after it, so facts that store
    the surrogate key are rebuilt together with the dimension.
    """
    if set(order) != set(columns.values()):
        raise ValueError("order must name every column of the dimension")
    natural = df.select(*[F.col(source).alias(name) for source, name in columns.items()]).distinct()
    return surrogate_key(natural, key, order).select(key, *columns.values())


def grown_dimension(
    df: DataFrame, known: DataFrame, key: str, columns: Mapping[str, str], order: Sequence[str], dtype: str = "int"
) -> DataFrame:
    """`known`, a stored dimension, with the natural keys of `df` that it lacks numbered behind its largest key.

    Old keys stay, so facts stored with them stay right. New ones are numbered by `order` among themselves, over range partitions. Null
    counts as a value and is known once. Both sides hold a natural key once, so the join has no hot keys.
    """
    if set(order) != set(columns.values()):
        raise ValueError("order must name every column of the dimension")
    names = list(columns.values())
    natural = df.select(*[F.col(source).alias(name) for source, name in columns.items()]).distinct()
    old = known.select(*[F.col(c).alias(f"_{c}") for c in names])
    same = reduce(lambda a, b: a & b, [natural[c].eqNullSafe(old[f"_{c}"]) for c in names])
    new = surrogate_key(natural.join(old, same, "left_anti"), "_n", order, "bigint")
    last = known.agg(F.max(key)).first()[0] or 0
    numbered = new.select((F.col("_n") + F.lit(last).cast("bigint")).cast(dtype).alias(key), *names)
    return known.select(F.col(key).cast(dtype).alias(key), *names).unionByName(numbered)


def _calendar_columns(days: DataFrame) -> DataFrame:
    day = F.col("date")
    return days.select(
        "date",
        date_key(day).alias("sk_time"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
    )


def date_dim(spark: SparkSession, start: str = CALENDAR[0], end: str = CALENDAR[1]) -> DataFrame:
    """One row per day from `start` to `end`, both included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return _calendar_columns(spark.range(1).select(F.explode(days).alias("date")))


def date_dim_over(df: DataFrame, at: Column) -> DataFrame:
    """The calendar of all years that `at` touches in `df`; no rows if it is always null."""
    day = to_local_time(at).cast("date")
    span = df.agg(F.year(F.min(day)).alias("first"), F.year(F.max(day)).alias("last"))
    days = F.sequence(F.make_date("first", F.lit(1), F.lit(1)), F.make_date("last", F.lit(12), F.lit(31)))
    return _calendar_columns(span.select(F.explode(days).alias("date")))

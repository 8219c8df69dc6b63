"""Rules that stop a load, and counts that describe a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityError(Exception):
    """A rule found rows that break it."""


def require_empty(violations: DataFrame, message: str) -> None:
    """Raise if `violations` has a row, showing one of them."""
    found = violations.take(1)
    if found:
        raise QualityError(f"{message}: {found[0].asDict()}")


def group_sizes(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per group."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def group_size_hist(df: DataFrame, keys: Sequence[str], by: Sequence[str] = (), name: str = "n") -> DataFrame:
    """How many groups have each size; with `by` (some of `keys`), separately for each value of those."""
    sizes = group_sizes(df, keys, name)
    return sizes.groupBy(*by, name).agg(F.count("*").alias("groups"))


def count_of_counts(df: DataFrame, keys: Sequence[str], by: Sequence[str], name: str = "n") -> DataFrame:
    """`group_size_hist` in the order of `by` and size."""
    return group_size_hist(df, keys, by, name).orderBy(*by, name)


def top_rows(df: DataFrame, n: int = 20) -> DataFrame:
    """First `n` rows in the order of all columns."""
    return df.orderBy(*df.columns).limit(n)


def type_sizes(df: DataFrame, group: Sequence[str], type_column: str, name: str = "bucket_count") -> DataFrame:
    """The distinct group sizes that occur for each type."""
    return group_sizes(df, [*group, type_column], name).select(type_column, name).distinct()


def uniform_group_violations(sizes: DataFrame, type_column: str) -> DataFrame:
    """Types with more than one group size, given `type_sizes`."""
    return (
        sizes.groupBy(type_column)
        .agg(F.count("*").alias("sizes"))
        .filter(F.col("sizes") > 1)
        .withColumnRenamed(type_column, "zone_type")
    )


def spec_violations(
    sizes: DataFrame, type_column: str, size_column: str, types: Mapping[str, int]
) -> DataFrame:
    """Types that a pivot over `types` cannot take, each with the reason.

    A type is refused when it is null, has groups of different size, is not declared or has more
    rows than declared.
    """
    declared = F.create_map(*[F.lit(v) for pair in types.items() for v in pair]) if types else None
    limit = F.try_element_at(declared, F.col(type_column)) if types else F.lit(None).cast("int")
    reason = F.when(F.col(type_column).isNull(), "null type").when(F.col("sizes") > 1, "groups of different size")
    reason = reason.when(limit.isNull(), "type not declared").when(F.col("largest") > limit, "more rows than declared")
    return (
        sizes.groupBy(type_column)
        .agg(F.count("*").alias("sizes"), F.max(size_column).alias("largest"))
        .withColumn("reason", reason)
        .filter(F.col("reason").isNotNull())
    )


def duplicate_types(df: DataFrame, key: str, type_column: str) -> DataFrame:
    """Keys with several child groups of one type, whose measures a pivot adds up."""
    return group_sizes(df, [key, type_column]).filter(F.col("n") > 1)


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per frame: its name and number of rows."""
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, counts)

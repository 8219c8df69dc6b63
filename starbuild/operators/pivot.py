"""Child rows to columns, by type and rank."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PivotSpec:
    """Which columns a pivot makes.

    types:       type value -> number of ranks
    attributes:  column-name stem -> source column, one column per type, by `max`
    measures:    columns with one column per type and rank, by `sum`
    """

    types: Mapping[str, int]
    attributes: Mapping[str, str]
    measures: Sequence[str]
    type_column: str = "type"
    rank_column: str = "rank"

    @property
    def max_rank(self) -> int:
        return max(self.types.values(), default=0)

    @property
    def attribute_columns(self) -> list[str]:
        return [f"{stem}_{t}" for t in self.types for stem in self.attributes]

    @property
    def measure_columns(self) -> list[str]:
        return [f"{m}_{t}{i}" for t, n in self.types.items() for i in range(1, n + 1) for m in self.measures]

    @property
    def columns(self) -> list[str]:
        return [*self.attribute_columns, *self.measure_columns]

    def aggregates(self) -> list[Column]:
        of_type = {t: F.col(self.type_column) == t for t in self.types}

        def attribute(stem: str, source: str, t: str) -> Column:
            if source == self.type_column:
                # The type is known: a flag is enough, and unlike a string it fits a hash aggregate.
                return F.when(F.bool_or(of_type[t]), F.lit(t)).alias(f"{stem}_{t}")
            return F.max(F.when(of_type[t], F.col(source))).alias(f"{stem}_{t}")

        def measure(m: str, t: str, i: int) -> Column:
            at_rank = of_type[t] & (F.col(self.rank_column) == i)
            return F.sum(F.when(at_rank, F.col(m))).alias(f"{m}_{t}{i}")

        return [attribute(stem, source, t) for t in self.types for stem, source in self.attributes.items()] + [
            measure(m, t, i) for t, n in self.types.items() for i in range(1, n + 1) for m in self.measures
        ]


def pivot_children(df: DataFrame, key: str, spec: PivotSpec) -> DataFrame:
    """One row per `key` with the columns of `spec`; a type or rank that is absent gives nulls.

    Two groups of one type under one key are added up in the measures, and their attributes
    show the larger value. Aggregation starts before the shuffle, so a hot key travels as few rows.
    """
    return df.groupBy(key).agg(*spec.aggregates())


def discover_types(
    sizes: DataFrame, type_column: str, size_column: str, max_types: int | None = None
) -> dict[str, int]:
    """Read `PivotSpec.types` from a frame of (type, group size): the largest size per type.

    Only the distinct types come to the driver, as many as the pivot has groups of columns. With `max_types`, more
    of them than that is an error.
    """
    largest = sizes.groupBy(type_column).agg(F.max(size_column).alias("_size"))
    rows = (largest if max_types is None else largest.limit(max_types + 1)).collect()
    if max_types is not None and len(rows) > max_types:
        raise ValueError(f"more than {max_types} types, too many to make columns of")
    if any(row[0] is None for row in rows):
        raise ValueError("a null type cannot name columns")
    return {row[0]: row[1] for row in sorted(rows)}


def pivot_values(
    df: DataFrame, key: str, column: str, values: Sequence[str], aggregates: Sequence[Column]
) -> DataFrame:
    """Spark's own pivot with declared values, which needs no pass over the data to find them.

    Rows move by `key` first. Spark's pivot adds up by key and value before it pivots; before the shuffle that key is
    nearly as many as the rows, and a task would hold all of its input in one hash table. After it, both steps work on
    partitions of the shuffle, whose size does not grow with the table.
    """
    return df.repartition(key).groupBy(key).pivot(column, list(values)).agg(*aggregates)


def pivot_sparse(
    df: DataFrame, key: str, type_column: str, rank_column: str, measures: Sequence[str], cells: str = "cells"
) -> DataFrame:
    """One row per `key` with its cells in one array, for pivots with more types than a table can have columns.

    A cell is a struct of type, rank and the sum of each measure; cells stand in the order of type and rank, nulls first. Types stay in the
    data: none is declared, and none comes to the driver. Rows are added up to cells before and after the first shuffle, so a
    key's array has one element for each of its (type, rank), however many rows it had.
    """
    filled = df.groupBy(key, type_column, rank_column).agg(*[F.sum(m).alias(m) for m in measures])
    cell = F.struct(F.col(type_column).alias("type"), F.col(rank_column).alias("rank"), *measures)
    return filled.groupBy(key).agg(F.sort_array(F.collect_list(cell)).alias(cells))


def sparse_cell(cells: str, kind: Column | str, rank: Column | int, measure: str) -> Column:
    """The measure of one cell of `pivot_sparse`; null if there is none."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    rank = F.lit(rank) if isinstance(rank, int) else rank
    here = F.filter(cells, lambda c: c["type"].eqNullSafe(kind) & c["rank"].eqNullSafe(rank))
    return F.get(here, F.lit(0))[measure]

"""Nested records to flat rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(path: Sequence[str]) -> str:
    """A path of field names as text that names the column, whatever characters they have."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in path)


def flatten_structs(df: DataFrame, sep: str = ".") -> DataFrame:
    """Turn struct fields into columns named by their path; arrays stay as they are.

    Only the schema is walked; a null struct gives null columns.
    """

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                yield F.col(quoted(here)).alias(sep.join(here))

    return df.select(*leaves(df.schema, ()))


def explode_indexed(df: DataFrame, keys: Sequence[str], array: str, index: str, element: str) -> DataFrame:
    """One row per array element with its 0-based position; empty and null arrays give none."""
    return df.select(*keys, F.posexplode(array).alias(index, element))


def explode_inner(df: DataFrame, keys: Sequence[str | Column], array: str) -> DataFrame:
    """One row per struct of an inner array: the parent keys, then the struct's fields."""
    return df.select(*keys, F.inline(F.col(array)))


def empty_keys(df: DataFrame, key: str, array: str) -> DataFrame:
    """Keys whose array is empty; a null array is not an empty one."""
    return df.filter(F.size(array) == 0).select(key)

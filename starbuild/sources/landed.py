"""Landed JSON: single records, pages of records, and stored responses."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.conform import as_struct

# Fixed value: the response status that counts as success.
SUCCESS = 200


def read_record(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object, its schema inferred."""
    return spark.read.option("multiLine", True).json(path)


def read_schema(schema: T.StructType | str, sep: str = ".") -> T.StructType:
    """Schema to read records with that are later conformed to the flat `schema`.

    Dotted names become structs. Atomic values are read as text, so that conforming sees what
    the record holds: a reader told to expect an int would turn any other text into null.
    """
    fields: dict[str, T.DataType | dict] = {}
    for field in as_struct(schema).fields:
        *path, leaf = field.name.split(sep)
        level = fields
        for step in path:
            level = level.setdefault(step, {})
        atomic = not isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType))
        level[leaf] = T.StringType() if atomic else field.dataType

    def struct(level: dict) -> T.StructType:
        return T.StructType(
            [T.StructField(name, struct(kind) if isinstance(kind, dict) else kind) for name, kind in level.items()]
        )

    return struct(fields)


def read_pages(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All records of a folder of page files, each a JSON array; an empty array gives no rows.

    Duplicates between pages are kept. A page that is cut off or no JSON stops the load. With `schema` the files are
    read once; without it, Spark reads them a first time to infer one.
    """
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    return (reader.schema(schema) if schema is not None else reader).json(path)


def union_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames by column name; duplicates stay, a column one lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def parse_json(column: str, schema: T.DataType | str) -> Column:
    """Value of a JSON text column; malformed text is an error."""
    return F.from_json(F.col(column), schema, {"mode": "FAILFAST"})


def until_first_refusal(responses: DataFrame, order: Sequence[str], status: str = "status") -> DataFrame:
    """The responses before the first one that was refused, in the order in which they were asked for.

    A fetch that stops at a refusal has no answers beyond it; those that are stored nevertheless wait for the next load. `order`
    should name every response once; a null sorts first. The first refusal is the least of each task's least: one row, which
    then is a constant filter on the scan, so nothing is sorted.
    """
    asked = F.struct(*order)
    refused = responses.filter(~F.coalesce(F.col(status) == SUCCESS, F.lit(False)))
    first = refused.agg(F.min(asked).alias("first")).first()["first"]
    if first is None:
        return responses
    kinds = [responses.schema[c].dataType for c in order]
    bound = F.struct(*[F.lit(v).cast(k).alias(c) for c, v, k in zip(order, first, kinds)])
    lead = F.col(order[0])
    near = lead.isNull() if first[0] is None else lead.isNull() | (lead <= F.lit(first[0]).cast(kinds[0]))
    return responses.filter(near & (asked < bound))


def last_answers(responses: DataFrame, key: str, attempt: str, status: str = "status", body: str = "body") -> DataFrame:
    """One response for each key: the successful one with the largest attempt number, else the last refusal.

    A key answered again by a later load or a retry thus counts once. Of equal attempts the larger body counts. Answers of one
    key are combined before the shuffle, so a key asked very often is no hot key.
    """
    good = F.coalesce(F.col(status) == SUCCESS, F.lit(False))
    rank = F.struct(good.alias("good"), F.col(attempt).alias("attempt"), F.col(body).alias("body"), F.col(status).alias("status"))
    return responses.groupBy(key).agg(F.max(rank).alias("_last")).select(
        key, F.col("_last.attempt").alias(attempt), F.col("_last.status").alias(status), F.col("_last.body").alias(body)
    )


def parse_responses(
    responses: DataFrame, key: str, schema: T.DataType | str, value: str, status: str = "status", body: str = "body"
) -> DataFrame:
    """Key and parsed body of the successful responses.

    Other responses leave no trace, so their keys are still pending in the next load. Where `schema` is an array, a
    body that is none stops the load, naming its key: Spark would make one element of it.
    """
    found = responses.filter(F.col(status) == SUCCESS)
    kind = schema if isinstance(schema, str) else schema.simpleString()
    if kind.strip().lower().startswith("array"):
        text = F.col(body)
        stop = F.raise_error(F.concat(F.lit(f"{key} "), F.col(key).cast("string"), F.lit(": the body is not an array")))
        found = found.withColumn(body, F.when(text.isNull() | F.ltrim(text).startswith("["), text).otherwise(stop))
    return found.select(key, parse_json(body, schema).alias(value))

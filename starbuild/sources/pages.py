"""Pages of records: which file each record comes from, where the pages end, and which records do not fit.

A page is a file that holds one JSON array. Pages are read as whole texts with the name of their file, so that a page that is cut off
or no array, and an empty page, which has no records to tell of it, are rows that Spark can count. A page is a task's
unit of work, as with any reader of JSON arrays; one page may hold up to 16 MiB (128 MiB as text), the bound of a VARIANT.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.conform import as_struct, checked
from ..operators.quality import QualityError, require_empty
from ..session import materialize
from .inferred import _ddl
from .landed import read_schema

# The last number of a file's name.
NUMBER = r"(\d+)[^\d/]*$"


def page_files(spark: SparkSession, path: str, number: str = NUMBER) -> DataFrame:
    """file, page (its number, from the file's path by the pattern `number`) and body of each page file under `path`."""
    name = F.col("_metadata.file_path")
    return spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path).select(
        name.alias("file"), F.regexp_extract(name, number, 1).try_cast("int").alias("page"), F.col("value").alias("body")
    )


def first_empty(pages: DataFrame) -> int | None:
    """The number of the first page with an empty array, by one aggregate over all pages; None if there is none."""
    return pages.agg(F.min(F.when(F.json_array_length("body") == 0, F.col("page")))).first()[0]


def until_empty(pages: DataFrame, first: int = 1, require_end: bool = False) -> DataFrame:
    """The pages from `first` up to the first empty one, which ends a delivery; later pages are left out.

    Pages may come in any order and from any file. Up to the end each number must be there once: a page that is missing or there twice
    stops the load and is named, and so does a file without a number. Without an empty page all pages count,
    unless `require_end`.
    """
    require_empty(pages.filter(F.col("page").isNull()).select("file"), "page files without a number")
    numbers = pages.select("file", "page")
    bounds = numbers.agg(F.max("page").alias("last")).first()
    end = first_empty(pages.filter(F.col("page") >= first))
    if end is None and require_end:
        raise QualityError("no empty page: the delivery has no end")
    if end is None:
        end = first if bounds.last is None else bounds.last + 1
    within = (F.col("page") >= first) & (F.col("page") < end)
    counted = numbers.filter(within).groupBy("page").agg(F.count("*").alias("files"), F.min("file").alias("file"))
    require_empty(counted.filter("files > 1"), "pages that several files hold")
    if (have := counted.count()) < end - first:
        wanted = numbers.sparkSession.range(first, end).select(F.col("id").cast("int").alias("page"))
        require_empty(wanted.join(counted, "page", "left_anti"), f"{end - first - have} pages are missing before page {end}")
    return pages.filter(within)


def check_pages(pages: DataFrame, schema: T.StructType | str, key: str | None = None) -> DataFrame:
    """Every record of `pages` (file, page, body) with what is wrong with it, and every page that has no records to show.

    Returns the columns of the flat `schema`, null where refused, and `_at`: file, page, place (in its page, from 0; null for a
    whole page), key (text of the column `key`), record (JSON text) and reasons (empty for a record that fits). Nothing stops the load.
    """
    schema = as_struct(schema)
    kind = F.expr("schema_of_variant(_page)")
    fault = F.when(F.col("_page").isNull(), "the page is no JSON").when(~kind.startswith("ARRAY"), "the page is no array")
    elements = F.when(kind.startswith("ARRAY"), F.expr("try_variant_get(_page, '$', 'array<variant>')"))
    opened = (
        pages.withColumn("_page", F.try_parse_json("body"))
        .select("file", "page", fault.alias("fault"), F.when(fault.isNotNull(), F.col("body")).alias("body"), elements.alias("elements"))
        # an empty page has no records, any other one has a row at least
        .filter(F.col("fault").isNotNull() | (F.size("elements") > 0))
        .select("file", "page", "fault", "body", F.posexplode_outer("elements").alias("place", "element"))
    )
    is_object = F.coalesce(F.expr("schema_of_variant(element)").startswith("OBJECT"), F.lit(False))
    values, shape_faults = _read(F.col("element"), read_schema(schema))
    faults = (
        F.when(F.col("fault").isNotNull(), F.array("fault"))
        .when(~is_object, F.array(F.lit("the record is no object")))
        .otherwise(F.array_compact(F.array(*shape_faults)) if shape_faults else F.array().cast("array<string>"))
    )
    at = F.struct(
        "file", "page", "place", (F.lit(None).cast("string") if key is None else values[key].cast("string")).alias("key"),
        F.coalesce("body", F.expr("cast(element as string)")).alias("record"), faults.alias("faults"),
        (F.col("fault").isNotNull() | ~is_object).alias("whole"),
    )
    leaves = opened.select(at.alias("_at"), *[values[name].alias(name) for name in schema.names])
    found = checked(leaves, schema, "_reasons", keep=["_at"])
    # of what is no record, nothing more is to be said
    reasons = F.when(F.col("_at.whole"), F.col("_at.faults")).otherwise(F.concat("_at.faults", "_reasons"))
    return found.withColumn("_at", F.col("_at").dropFields("faults", "whole").withField("reasons", reasons)).drop("_reasons")


def _read(record: Column, schema: T.StructType, path: tuple[str, ...] = (), sep: str = ".") -> tuple[dict[str, Column], list[Column]]:
    """The leaves of a VARIANT object by their flat names, and what does not fit among them.

    Spark reads a field of another shape as null without a word: a value where an object should be, an array with an
    element of another type. So each level is read as variants first, and their kinds are looked at.
    """
    level = _ddl(T.StructType([T.StructField(f.name, T.VariantType()) for f in schema.fields]))
    fields = F.try_variant_get(record, "$", level)
    values, faults = {}, []
    for field in schema.fields:
        here = (*path, field.name)
        name, raw = sep.join(here), fields.getField(field.name)
        is_null = raw.isNull() | F.is_variant_null(raw)
        if isinstance(field.dataType, T.StructType):
            faults.append(F.when(~is_null & ~F.schema_of_variant(raw).startswith("OBJECT"), f"column {name}: no object"))
            inner, more = _read(raw, field.dataType, here, sep)
            values |= inner
            faults += more
        elif isinstance(field.dataType, T.StringType):
            values[name] = raw.cast("string")
        else:
            typed = raw.try_cast(field.dataType)
            lost = typed.isNull()
            if isinstance(field.dataType, T.ArrayType):
                empty = F.size(F.filter(raw.try_cast("array<variant>"), lambda v: v.isNull() | F.is_variant_null(v)))
                lost = lost | (F.size(F.filter(typed, lambda v: v.isNull())) > empty)
            faults.append(F.when(~is_null & lost, f"column {name}: value cannot be cast to {field.dataType.simpleString()}"))
            values[name] = typed
    return values, faults


def fitting(found: DataFrame, where: Sequence[str] = ()) -> DataFrame:
    """The records of `check_pages` that fit, in the columns of their schema, after the columns `where` (of file, page, place)."""
    names = [f"`{c}`" for c in found.columns if c != "_at"]
    return found.filter(F.size("_at.reasons") == 0).select(*[F.col(f"_at.{c}") for c in where], *names)


def rejects(found: DataFrame) -> DataFrame:
    """file, page, place, key, reason and record of what `check_pages` refused, a row for each reason."""
    refused = found.filter(F.size("_at.reasons") > 0)
    return refused.select("_at.file", "_at.page", "_at.place", "_at.key", F.explode("_at.reasons").alias("reason"), "_at.record")


def load_pages(
    spark: SparkSession, path: str, schema: T.StructType | str, key: str | None = None, number: str = NUMBER, first: int = 1,
    require_end: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(records that fit, rejects) of the pages under `path` up to the first empty one; the checked records are stored once."""
    found = materialize(check_pages(until_empty(page_files(spark, path, number), first, require_end), schema, key))
    return fitting(found), rejects(found)

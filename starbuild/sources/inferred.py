"""JSON text columns without a declared schema.

The text is parsed into Spark's VARIANT, and the schema of all rows is folded on the executors, combined before the
shuffle: only its text reaches the driver. Rows are then cast to it at once, so that a record is parsed one more time, however
many columns it gives. A path that holds several kinds of value is text, objects and arrays there as JSON.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.nested import flatten_structs, quoted

# An object with more paths than this has keys that are data; it is no record.
MAX_PATHS = 2_000


class TooManyPaths(Exception):
    """The inferred schema has more paths than a table should have columns."""


def _parsed(column: str, malformed: str) -> Column:
    if malformed not in ("error", "null"):
        raise ValueError(f"unknown mode {malformed!r}")
    return (F.parse_json if malformed == "error" else F.try_parse_json)(F.col(column))


def _from_variant_ddl(text: str) -> T.DataType:
    # an OBJECT is a struct; a field name that says so stands in backticks
    ddl = re.sub(r"`(?:[^`]|``)*`|\bOBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], text)
    return T.DataType.fromDDL(ddl)


def _as_stored(kind: T.DataType, exact_decimals: bool) -> T.DataType:
    """The type a table keeps: text for mixed or unknown kinds, doubles for fractions unless they are to stay exact."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_stored(f.dataType, exact_decimals)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_stored(kind.elementType, exact_decimals))
    if isinstance(kind, (T.VariantType, T.NullType)):
        return T.StringType()
    if isinstance(kind, T.DecimalType) and kind.scale > 0 and not exact_decimals:
        return T.DoubleType()
    return kind


def _leaves(kind: T.DataType, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], T.DataType]]:
    if isinstance(kind, T.StructType):
        for field in kind.fields:
            yield from _leaves(field.dataType, (*path, field.name))
    else:
        yield path, kind


def variant_schema(df: DataFrame, column: str, malformed: str = "error", max_paths: int = MAX_PATHS) -> T.DataType:
    """The schema of a JSON text column over all its rows, VARIANT where rows differ in kind and VOID where all are null."""
    folded = df.agg(F.schema_of_variant_agg(_parsed(column, malformed))).first()[0]
    schema = _from_variant_ddl(folded or "VOID")
    paths = sum(1 for _ in _leaves(schema))
    if paths > max_paths:
        raise TooManyPaths(f"{column}: {paths} paths, more than {max_paths}; are keys of an object data?")
    return schema


def infer_schema(
    df: DataFrame, column: str, exact_decimals: bool = False, malformed: str = "error", max_paths: int = MAX_PATHS
) -> T.DataType:
    """The schema that `column` is stored with: `variant_schema`, its mixed and its empty paths as text."""
    return _as_stored(variant_schema(df, column, malformed, max_paths), exact_decimals)


def typed_json(df: DataFrame, column: str, schema: T.DataType | None = None, malformed: str = "error") -> DataFrame:
    """`df` with its JSON text column as a value of `schema`, which is inferred if none is given.

    Text that is no JSON, or a value that its schema refuses, is an error; with malformed ``"null"`` it becomes null, a value
    in its place in the record.
    """
    schema = infer_schema(df, column, malformed=malformed) if schema is None else schema
    get = "variant_get" if malformed == "error" else "try_variant_get"
    held = f"_variant_{column}"
    kind = schema.simpleString() if not isinstance(schema, T.StructType) else _ddl(schema)
    return (
        df.withColumn(held, _parsed(column, malformed))
        .withColumn(column, F.expr(f"{get}(`{held}`, '$', '{_escaped(kind)}')"))
        .drop(held)
    )


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _ddl(kind: T.DataType) -> str:
    """`simpleString` with quoted field names."""
    if isinstance(kind, T.StructType):
        fields = ",".join(f"{quoted([f.name])}:{_ddl(f.dataType)}" for f in kind.fields)
        return f"struct<{fields}>"
    if isinstance(kind, T.ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    return kind.simpleString()


def flatten_json(
    df: DataFrame,
    column: str,
    keys: Sequence[str] = (),
    schema: T.DataType | None = None,
    malformed: str = "error",
) -> DataFrame:
    """`keys` and one column for each path of the records in `column`, named by the path; arrays stay arrays.

    Without `schema` it is inferred. Records that are no objects give one column, `column` itself.
    """
    typed = typed_json(df, column, schema, malformed).select(*keys, F.col(column).alias("_record"))
    if not isinstance(typed.schema["_record"].dataType, T.StructType):
        return typed.withColumnRenamed("_record", column)
    flat = flatten_structs(typed.select(*keys, "_record"))
    return flat.withColumnsRenamed({c: c.removeprefix("_record.") for c in flat.columns if c.startswith("_record.")})


def json_paths(df: DataFrame, column: str, malformed: str = "error") -> DataFrame:
    """path, type, mixed (several kinds of value met there) and filled (rows with a value) of the records in `column`.

    An empty object has no path of its own. Two passes: one folds the schema, one counts all paths.
    """
    found = variant_schema(df, column, malformed)
    mixed = {path: isinstance(kind, T.VariantType) for path, kind in _leaves(found)}
    schema = _as_stored(found, exact_decimals=False)
    typed = typed_json(df.select(column), column, schema, malformed)
    leaves = [
        (".".join(path), kind.simpleString(), mixed[path], F.count(F.col(quoted((column, *path)))))
        for path, kind in _leaves(schema)
    ]
    if not leaves:
        return df.sparkSession.createDataFrame([], "path string, type string, mixed boolean, filled bigint")
    rows = [
        F.struct(F.lit(path).alias("path"), F.lit(kind).alias("type"), F.lit(several).alias("mixed"), count.alias("filled"))
        for path, kind, several, count in leaves
    ]
    return typed.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))

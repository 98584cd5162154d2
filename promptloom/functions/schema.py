"""Response schemas: a ``{field: type name}`` mapping becomes a Spark struct type."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The accepted type names of a response field.
TYPE_NAMES = {
    "str": T.StringType(),
    "string": T.StringType(),
    "int": T.LongType(),
    "float": T.DoubleType(),
    "number": T.DoubleType(),
    "bool": T.BooleanType(),
    "boolean": T.BooleanType(),
    "array": T.ArrayType(T.StringType()),
}


def field_type(spec) -> T.DataType:
    """A type name, a nested mapping or a ready Spark type."""
    if isinstance(spec, T.DataType):
        return spec
    if isinstance(spec, Mapping):
        return response_schema(spec)
    if isinstance(spec, str) and spec in TYPE_NAMES:
        return TYPE_NAMES[spec]
    raise ValueError(f"unknown response type {spec!r}; use one of {sorted(TYPE_NAMES)}")


def response_schema(output_type: Mapping) -> T.StructType:
    """Struct type of a structured response."""
    if not output_type:
        raise ValueError("output_type needs at least one field")
    return T.StructType([T.StructField(name, field_type(spec)) for name, spec in output_type.items()])


def missing_fields(response: Column, output_type: Mapping) -> Column:
    """Names of the fields a parsed response lacks; every field is required, so a complete one has none."""
    named = F.array(*[F.when(response.getField(name).isNull(), F.lit(name)) for name in output_type])
    return F.array_compact(named)

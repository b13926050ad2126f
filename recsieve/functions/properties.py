"""Raw properties as VARIANT: a JSON text is parsed once, and a property read with its type told apart from what isn't there."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Spark calls the types of values in a variant, by the type that is asked for.
TYPES = {"bigint": ["BIGINT"], "double": ["BIGINT", "DOUBLE", "DECIMAL"], "string": ["STRING"], "boolean": ["BOOLEAN"]}


def parsed(json: Column) -> Column:
    """The text as a VARIANT; null where it is null or no JSON. What follows a whole JSON value in a text isn't looked at."""
    return F.try_parse_json(json)


def typed(json: Column, variant: Column, path: str, kind: str) -> Column:
    """struct(state, value) of the property at a path of parsed(json), as bigint, double, string or boolean.

    state: `none` (no text), `malformed` (no JSON), `missing` (no such property), `null`, `type` (a value of another type, which isn't
    cast), `ok`. value is null but for `ok`.
    """
    found = F.try_variant_get(variant, path, "variant")
    name = F.regexp_extract(F.schema_of_variant(found), r"^[A-Z]+", 0)
    state = F.when(json.isNull(), "none").when(variant.isNull(), "malformed").when(found.isNull(), "missing").when(F.is_variant_null(found), "null").when(name.isin(TYPES[kind]), "ok").otherwise("type")
    return F.struct(state.alias("state"), F.when(state == "ok", F.try_variant_get(variant, path, kind)).alias("value"))

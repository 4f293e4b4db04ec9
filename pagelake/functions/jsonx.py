"""JSON helpers (native JSON / VARIANT functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_or_self_keys(x: Column, member: str) -> list[Column]:
    """parse a JSON string when valid (else keep the text); returns
    ``is_json`` and the named member as BIGINT."""
    v = F.try_parse_json(x)
    return [v.isNotNull().alias("is_json"), F.try_variant_get(v, f"$.{member}", "bigint").alias(member)]


def json_or_self(x: Column) -> Column:
    """F24 as one VARIANT column: the parsed value, or the original string as a VARIANT string."""
    as_string = F.try_variant_get(F.try_parse_json(F.to_json(F.struct(x.alias("v")))), "$.v", "variant")
    return F.coalesce(F.try_parse_json(x), as_string)


def json_shape(df: DataFrame, x: Column) -> DataFrame:
    """Q6: top-level type and sorted keys of each JSON text ('invalid_json' if unparsable)."""
    v = F.try_parse_json(x)
    keys = F.json_object_keys(x)
    kind = (
        F.when(v.isNull(), F.lit("invalid_json"))
        .when(x.rlike(r"^\s*\{"), F.lit("object"))
        .when(x.rlike(r"^\s*\["), F.lit("array"))
        .otherwise(F.lower(F.schema_of_variant(v)))
    )
    return df.select(
        kind.alias("parsed_type"),
        F.when(kind == "object", F.to_json(F.array_sort(keys))).otherwise(F.lit("[]")).alias("first_keys"),
        F.when(kind == "array", F.json_array_length(x)).alias("top_level_length"),
    )

"""Typed statement parameters named ``cypher.param.<type>.<name>``."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: pattern of a parameter property name.
PARAM_PATTERN = r"cypher\.param\.(boolean|string|integer|float)\.(.*)"

_PYTHON = {
    "boolean": lambda v: v is not None and v.lower() == "true",
    "string": lambda v: v,
    "integer": int,
    "float": float,
}


def typed_params(properties: dict[str, str]) -> dict[str, object]:
    """Parameters of one configuration; other properties are ignored."""
    found = {}
    for key, value in properties.items():
        match = re.fullmatch(PARAM_PATTERN, key)
        if match:
            found[match.group(2)] = _PYTHON[match.group(1)](value)
    return found


def typed_param_rows(df: DataFrame, key: str, value: str) -> DataFrame:
    """Typed parameters of a table of properties, one column per type.

    A number that cannot be read leaves its column NULL and sets ``invalid``.
    """
    kind = F.regexp_extract(key, f"^{PARAM_PATTERN}$", 1)
    text = F.col(value)
    out = df.filter(F.col(key).rlike(f"^{PARAM_PATTERN}$")).withColumns({
        "param_type": kind,
        "param_name": F.regexp_extract(key, f"^{PARAM_PATTERN}$", 2),
        "boolean_value": F.when(kind == "boolean", F.lower(text) == "true"),
        "integer_value": F.when((kind == "integer") & text.rlike(r"^[+-]?\d+$"), text.try_cast("int")),
        "float_value": F.when(kind == "float", text.try_cast("double")),
        "string_value": F.when(kind == "string", text),
    })
    return out.withColumn(
        "invalid",
        ((F.col("param_type") == "integer") & F.col("integer_value").isNull())
        | ((F.col("param_type") == "float") & F.col("float_value").isNull()),
    )


def run_statement(spark: SparkSession, statement: str, properties: dict[str, str] | None = None) -> DataFrame:
    """A stored statement with ``:name`` markers bound to typed parameters."""
    return spark.sql(statement, args=typed_params(properties or {}))

"""Strict JSON as VARIANT: complete values only, types told apart."""

from __future__ import annotations

from pyspark.sql import SparkSession


def allow_duplicate_keys(spark: SparkSession) -> None:
    """A key written twice in an object keeps its last value, as JSON readers commonly do.

    Sessions of this package start with the option; another session gets it here, for the queries are evaluated later.
    """
    if spark.conf.get("spark.sql.variant.allowDuplicateKeys", "false") != "true":
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def kind_of_schema(s: str) -> str:
    """SQL: object, array, string, number, boolean or null (JSON null) of a variant's schema text."""
    return (
        f"CASE WHEN {s} IS NULL THEN NULL WHEN {s} LIKE 'OBJECT%' THEN 'object' WHEN {s} LIKE 'ARRAY%' THEN 'array' "
        f"WHEN {s} = 'STRING' THEN 'string' WHEN {s} = 'BOOLEAN' THEN 'boolean' WHEN {s} = 'VOID' THEN 'null' "
        f"WHEN {s} IN ('BIGINT','DOUBLE','FLOAT') OR {s} LIKE 'DECIMAL%' THEN 'number' ELSE lower({s}) END"
    )


def elements(v: str) -> str:
    """SQL: array<variant> of an array; null for anything else."""
    return f"CASE WHEN schema_of_variant({v}) LIKE 'ARRAY%' THEN variant_get({v}, '$', 'array<variant>') END"

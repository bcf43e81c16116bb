"""Aligning one table's rows to another schema, and comparing schemas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagetally.functions import text
from stagetally.schemas import LOWERCASE_FIELDS, REFERENCE_FIELDS, URL_FIELDS
from stagetally.session import literal_table

_LOWERED = {f for fields in (*LOWERCASE_FIELDS.values(), *URL_FIELDS.values()) for f in fields}

# --- fixed values: accepted alternative names -----------------------------------------------
ALTERNATIVE_NAMES = {"closedate": "close_date", "createdate": "create_date"}


def migration_rule(field: str, c: Column) -> Column:
    """Clean-up a migrated field gets: references, enums, e-mails and URLs."""
    if field in REFERENCE_FIELDS:
        return text.null_if_empty(c)
    if field in _LOWERED:
        return F.lower(text.strip(c))
    return c


def align_to_schema(
    df: DataFrame,
    target: T.StructType,
    constants: Mapping[str, Column] | None = None,
    normalize: bool = True,
    alternatives: Mapping[str, str] | None = None,
) -> DataFrame:
    """Exactly the target's columns: constants, cleaned source values, or NULL.

    A value that does not fit the target type becomes NULL.
    """
    constants = constants or {}
    alternatives = alternatives or {}
    out = []
    for f in target:
        source = f.name if f.name in df.columns else alternatives.get(f.name)
        if f.name in constants:
            c = constants[f.name].cast(f.dataType)
        elif source in df.columns:
            c = F.col(source)
            if normalize and isinstance(df.schema[source].dataType, T.StringType):
                c = migration_rule(f.name, c)
            c = c.try_cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        out.append(c.alias(f.name))
    return df.select(*out)


def align_with_alternatives(df: DataFrame, target: T.StructType, constants: Mapping[str, Column]) -> DataFrame:
    """Alignment without clean-up, accepting alternative names for date fields."""
    return align_to_schema(df, target, constants, normalize=False, alternatives=ALTERNATIVE_NAMES)


def schema_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return literal_table(
        spark,
        [(f.name, f.dataType.simpleString()) for f in schema],
        "field string, type string",
    )


def schema_diff(spark: SparkSession, source: T.StructType, target: T.StructType) -> DataFrame:
    """Fields of both sides with their difference and whether migration can go on.

    A field missing in the target or of another type is incompatible; one that
    only the target has is fine.
    """
    a = schema_rows(spark, source).withColumnRenamed("type", "source_type")
    b = schema_rows(spark, target).withColumnRenamed("type", "target_type")
    status = (
        F.when(F.col("target_type").isNull(), "missing")
        .when(F.col("source_type").isNull(), "extra")
        .when(F.col("source_type") != F.col("target_type"), "type mismatch")
        .otherwise("same")
    )
    return (
        a.join(b, "field", "full_outer")
        .withColumn("difference", status)
        .withColumn("compatible", F.col("difference").isin("same", "extra"))
    )


def required_tables_present(spark: SparkSession, present: list[str], required: list[str]) -> DataFrame:
    return literal_table(
        spark,
        [(t, t in present) for t in required],
        "table string, present boolean",
    )

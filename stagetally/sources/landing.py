"""Landed CRM JSON: object pages, owner lists and deal-stage lists.

One page per line by default; set ``multi_line`` for files that hold one
pretty-printed page each (such files are not splittable).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagetally.functions import text
from stagetally.schemas import TABLES

_S = T.StringType()
_LINKS = T.StructType(
    [T.StructField("results", T.ArrayType(T.StructType([T.StructField("id", _S)])))]
)
OBJECT_PAGE = T.StructType(
    [
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", _S),
                        T.StructField("properties", T.MapType(_S, _S)),
                        T.StructField("associations", T.MapType(_S, _LINKS)),
                    ]
                )
            ),
        )
    ]
)
OWNER_PAGE = T.StructType(
    [
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(n, _S)
                        for n in (
                            "id",
                            "email",
                            "firstName",
                            "lastName",
                            "userId",
                            "active",
                            "createdAt",
                            "updatedAt",
                        )
                    ]
                )
            ),
        )
    ]
)
DEAL_STAGE_PAGE = T.StructType(
    [
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", _S),
                        T.StructField("label", _S),
                        T.StructField(
                            "stages",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("id", _S),
                                        T.StructField("label", _S),
                                        T.StructField("displayOrder", _S),
                                        T.StructField(
                                            "metadata",
                                            T.StructType(
                                                [
                                                    T.StructField("isClosed", _S),
                                                    T.StructField("probability", _S),
                                                ]
                                            ),
                                        ),
                                    ]
                                )
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)


def _pages(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_object_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Rows of landed object pages, with the page file and position in the page."""
    pages = _pages(spark, path, OBJECT_PAGE, multi_line)
    return pages.select(
        F.col("_metadata.file_path").alias("page_file"),
        F.posexplode("results").alias("position", "record"),
    ).select("page_file", "position", "record.*")


def project_properties(
    df: DataFrame,
    table: str,
    id_field: str,
    properties: Mapping[str, str],
    snapshot_id: Column,
    as_of: Column,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Identifier, mapped properties and the two system columns.

    Values are cast to the declared type of the target table; text that does
    not fit becomes NULL instead of failing the load.
    """
    types = {f.name: f.dataType for f in TABLES[table]}
    return df.select(
        F.col("id").alias(id_field),
        *[
            F.try_element_at("properties", F.lit(source)).try_cast(types.get(target, _S)).alias(target)
            for source, target in properties.items()
        ],
        *keep,
        snapshot_id.alias("snapshot_id"),
        as_of.alias("record_timestamp"),
    )


def resolve_associations(df: DataFrame, associations: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add one column per association: the first id, or all ids as an array."""
    added = {}
    for kind, (target, arity) in associations.items():
        links = F.try_element_at("associations", F.lit(kind)).getField("results")
        ids = F.transform(links, lambda r: r.getField("id"))
        ids = F.when(F.size(ids) > 0, ids)
        added[target] = F.get(ids, F.lit(0)) if arity == "single" else ids
    return df.withColumns(added)


def read_owners(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    owner = _pages(spark, path, OWNER_PAGE, multi_line).select(F.inline("results"))
    stamp = F.coalesce(text.null_if_empty(F.col("updatedAt")), text.null_if_empty(F.col("createdAt")))
    return owner.select(
        F.col("id").alias("owner_id"),
        text.normalize_email(F.col("email")).alias("email"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        F.nullif(text.null_if_empty(F.col("userId")), F.lit("0")).alias("user_id"),
        text.bool_from_text(F.col("active")).alias("active"),
        F.try_to_timestamp(stamp).alias("record_timestamp"),
    )


def flatten_deal_stages(
    spark: SparkSession, path: str, as_of: Column, multi_line: bool = False
) -> DataFrame:
    """One row per stage of every landed stage list."""
    groups = _pages(spark, path, DEAL_STAGE_PAGE, multi_line).select(F.inline("results"))
    stages = groups.select(
        F.col("id").alias("pipeline_id"),
        F.col("label").alias("pipeline_label"),
        F.explode("stages").alias("stage"),
    )
    meta = F.col("stage.metadata")
    return stages.select(
        "pipeline_id",
        "pipeline_label",
        F.col("stage.id").alias("stage_id"),
        F.col("stage.label").alias("stage_label"),
        text.bool_from_text(meta.getField("isClosed")).alias("is_closed"),
        F.coalesce(meta.getField("probability").try_cast("double"), F.lit(0.0)).alias("probability"),
        F.coalesce(F.col("stage.displayOrder").try_cast("bigint"), F.lit(0).cast("bigint")).alias(
            "display_order"
        ),
        as_of.alias("record_timestamp"),
    )

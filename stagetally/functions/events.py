"""Event envelopes: decoding queue messages and building new ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COUNTS = T.MapType(T.StringType(), T.LongType())

ENVELOPE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("environment", T.StringType()),
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField("snapshot_id", T.StringType()),
                    T.StructField("timestamp", T.StringType()),
                    T.StructField("data_tables", _COUNTS),
                    T.StructField("reference_tables", _COUNTS),
                    T.StructField("error_message", T.StringType()),
                    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
                ]
            ),
        ),
    ]
)

# --- fixed values: event kinds, appended to a namespace ------------------------------
SNAPSHOT_COMPLETED = "snapshot.completed"
SNAPSHOT_FAILED = "snapshot.failed"
RESCORE_ALL = "rescore.all"
DEFAULT_NAMESPACE = "crm"
ENVELOPE_VERSION = "1.0"


def event_type(kind: str, namespace: str = DEFAULT_NAMESPACE) -> str:
    return f"{namespace}.{kind}"


def parse_event(payload: Column) -> Column:
    """Envelope struct of a base64 or plain JSON message; NULL when it is neither."""
    # The first character decides, so plain JSON is never sent through a decoder that fails on it.
    decoded = F.try_to_binary(payload, F.lit("base64")).try_cast("string")
    text = F.when(_is_object(payload), payload).otherwise(decoded)
    return F.when(_is_object(text) & F.try_parse_json(text).isNotNull(), F.from_json(text, ENVELOPE))


def _is_object(text: Column) -> Column:
    return F.ltrim(text).startswith("{")


def count_total(counts: Column) -> Column:
    """Sum of the values of a table -> rows map."""
    return F.aggregate(F.map_values(counts), F.lit(0).cast("bigint"), lambda a, b: a + b)


def _stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def build_event(
    kind: Column | str,
    data: Column,
    as_of: Column,
    environment: str,
    source: str = "ingest",
    namespace: str = DEFAULT_NAMESPACE,
) -> Column:
    """JSON text of any event around the given data struct."""
    name = F.lit(event_type(kind, namespace)) if isinstance(kind, str) else kind
    return F.to_json(
        F.struct(
            name.alias("type"),
            F.lit(ENVELOPE_VERSION).alias("version"),
            _stamp(as_of).alias("timestamp"),
            F.lit(f"{namespace}-{source}-{environment}").alias("source"),
            F.lit(environment).alias("environment"),
            data.alias("data"),
        )
    )


def build_completed_event(
    snapshot_id: Column,
    data_counts: Column,
    reference_counts: Column,
    as_of: Column,
    environment: str,
    function_name: str = "unknown",
    namespace: str = DEFAULT_NAMESPACE,
) -> Column:
    data = F.struct(
        snapshot_id.alias("snapshot_id"),
        _stamp(as_of).alias("timestamp"),
        data_counts.alias("data_tables"),
        reference_counts.alias("reference_tables"),
        F.struct(
            F.lit("ingest_function").alias("triggered_by"),
            F.lit(environment).alias("environment"),
            F.lit(environment).alias("target_environment"),
            count_total(data_counts).alias("total_data_records"),
            count_total(reference_counts).alias("total_reference_records"),
            F.lit(function_name).alias("function_name"),
        ).alias("metadata"),
    )
    return build_event(SNAPSHOT_COMPLETED, data, as_of, environment, namespace=namespace)


def build_failed_event(
    snapshot_id: Column,
    error_message: Column,
    as_of: Column,
    environment: str,
    function_name: str = "unknown",
    namespace: str = DEFAULT_NAMESPACE,
) -> Column:
    data = F.struct(
        snapshot_id.alias("snapshot_id"),
        _stamp(as_of).alias("timestamp"),
        error_message.alias("error_message"),
        F.struct(
            F.lit("ingest_function").alias("triggered_by"),
            F.lit(environment).alias("environment"),
            F.lit(function_name).alias("function_name"),
        ).alias("metadata"),
    )
    return build_event(SNAPSHOT_FAILED, data, as_of, environment, namespace=namespace)

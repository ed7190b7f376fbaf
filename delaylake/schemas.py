"""Table contracts and document shapes, fixed; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_S, _L, _I, _D = StringType(), LongType(), IntegerType(), DoubleType()
_TS, _DT, _B = TimestampType(), DateType(), BooleanType()


def _struct(*fields: tuple) -> StructType:
    """Fields as (name, type) or (name, type, nullable)."""
    return StructType([StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


BRONZE_EVENTS = _struct(
    ("id", _S), ("route_id", _S), ("source", _S), ("feed_entity_id", _S), ("trip_id", _S),
    ("trip_update_timestamp", _L), ("first_stop_delay_sec", _I), ("ingest_batch_id", _S),
    ("ingested_at", _TS), ("lake_ingest_ts", _TS),
)
BRONZE_HUB = _struct(
    ("sequence_number", _L), ("offset", _S), ("enqueued_time", _TS), ("payload", _S),
    ("bronze_ingest_ts", _TS),
)
BRONZE_ROUTE_REF = _struct(
    ("route_id", _S), ("snapshot_date", _DT), ("payload", _S), ("ingest_batch_id", _S),
    ("ingested_at", _TS),
)
WATERMARKS = _struct(("source_key", _S), ("last_ts", _L), ("updated_at", _TS))
SILVER_FACT = _struct(
    ("event_sk", _S), ("route_id", _S, False), ("trip_id", _S), ("event_ts", _TS),
    ("delay_sec", _I), ("ingest_batch_id", _S), ("is_valid", _B),
)
# Stored next to the silver contract so that a later load can be ranked against it.
SILVER_FACT_ORDER = _struct(("_ingested_at", _TS), ("_source", _S))
SILVER_DIM_ROUTE = _struct(
    ("route_id", _S, False), ("route_short_name", _S), ("route_long_name", _S),
    ("route_type", _S), ("effective_from", _DT), ("effective_to", _DT),
)
GOLD_KPI = _struct(
    ("kpi_date", _DT, False), ("route_id", _S, False), ("trip_update_cnt", _L),
    ("avg_delay_sec", _D), ("p95_delay_sec", _D),
)

# The declarative variant: bronze carries a processing time, silver its source,
# and the percentile keeps the integer type of the delay.
FLOW_BRONZE_EVENTS = StructType(BRONZE_EVENTS.fields + [StructField("processing_ts", _TS)])
FLOW_BRONZE_HUB = StructType(BRONZE_HUB.fields + [StructField("processing_ts", _TS)])
FLOW_SILVER_FACT = StructType(
    [StructField(f.name, f.dataType) for f in SILVER_FACT.fields]
    + [StructField("source_system", _S)]
)
FLOW_GOLD_KPI = _struct(
    ("route_id", _S), ("kpi_date", _DT), ("trip_update_cnt", _L), ("avg_delay_sec", _D),
    ("p95_delay_sec", _I),
)
FLOW_GOLD_ENRICHED = _struct(
    ("kpi_date", _DT), ("route_id", _S), ("route_short_name", _S), ("route_long_name", _S),
    ("route_type", _S), ("trip_update_cnt", _L), ("avg_delay_sec", _D), ("p95_delay_sec", _I),
)

RUN_LOG = _struct(
    ("job", _S), ("run_id", _S), ("started_at", _TS), ("life_cycle", _S), ("result", _S),
    ("rows", _L), ("latency_ms", _D), ("detail", _S),
)
COMMIT_LOG = _struct(
    ("table_name", _S), ("version", _L), ("ts", _TS), ("operation", _S), ("rows_written", _L),
)

# Days of silver that gold has yet to take up.
CHANGED_DAYS = _struct(("event_date", _DT))

# Decoded feed entity.
STOP_UPDATE = _struct(
    ("delay", _I), ("arrival", _struct(("delay", _I))), ("departure", _struct(("delay", _I))),
)
FEED_ENTITY = _struct(
    ("id", _S),
    ("trip_update", _struct(
        ("trip", _struct(("route_id", _S), ("trip_id", _S))),
        ("timestamp", _L),
        ("stop_time_update", ArrayType(STOP_UPDATE)),
    )),
)

# Document envelope.
METADATA = _struct(
    ("schema_version", _S), ("source_system", _S), ("event_type", _S), ("ingest_batch_id", _S),
    ("ingested_at", _S), ("segment", _S), ("segment_mode", _S), ("cosmos_container", _S),
    ("emit_to_event_hub", _B),
)
PAYLOAD = _struct(
    ("feed_entity_id", _S), ("trip_id", _S), ("trip_update_timestamp", _L),
    ("first_stop_delay_sec", _I),
)
ENVELOPE = _struct(("id", _S), ("route_id", _S), ("metadata", METADATA), ("payload", PAYLOAD))
# Stored documents: the envelope or the older flat shape, plus modification time.
STORED_DOC = StructType(ENVELOPE.fields + [
    StructField(n, t) for n, t in (
        ("source", _S), ("feed_entity_id", _S), ("trip_id", _S), ("trip_update_timestamp", _L),
        ("first_stop_delay_sec", _I), ("ingest_batch_id", _S), ("ingested_at", _S), ("_ts", _L),
    )
])
# A document store: the document as text, its key and its modification second.
DOC_STORE = _struct(("id", _S), ("route_id", _S), ("value", _S), ("_ts", _L))
# What silver needs from a message, all as text so that one malformed field
# becomes NULL without losing the others.
MESSAGE_TEXT = _struct(
    ("id", _S), ("route_id", _S),
    ("metadata", _struct(("ingest_batch_id", _S), ("ingested_at", _S))),
    ("payload", _struct(("trip_id", _S), ("trip_update_timestamp", _S),
                        ("first_stop_delay_sec", _S))),
)
REFERENCE_TEXT = _struct(("route_short_name", _S), ("route_long_name", _S), ("route_type", _S))
# Batches whose messages were handed over.
SENT_BATCHES = _struct(("batch_id", _S), ("sent_at", _TS))
# Partial results of daily KPIs, any number of rows for a day and route.
KPI_PARTIALS = _struct(
    ("kpi_date", _DT), ("route_id", _S), ("events", _L), ("delays", _L), ("delay_sum", _L), ("sketch", BinaryType()),
)

"""Scalar expressions of the delay model, all built-in functions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delaylake import fixed_values as fv

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def event_time(epoch: ColumnOrName, fallback: ColumnOrName) -> Column:
    """Feed time in epoch seconds, else the fallback timestamp; always a timestamp."""
    return F.coalesce(F.timestamp_seconds(_c(epoch)), _c(fallback))


def parse_json(text: ColumnOrName, schema: StructType) -> Column:
    """JSON text to a struct, parsed once per row; unreadable text gives NULL.

    The one-element explode is a barrier: a later filter on a parsed field would
    otherwise be pushed below the parse and parse the text again for every field
    it uses, since Catalyst copies the expression into the predicate.
    """
    return F.explode(F.array(F.from_json(_c(text), schema, {"mode": "PERMISSIVE"})))


def parse_ts(text: ColumnOrName) -> Column:
    """ISO-8601 text to timestamp; unreadable text gives NULL."""
    return F.try_to_timestamp(_c(text))


def to_iso(ts: ColumnOrName) -> Column:
    """Timestamp to ISO-8601 text with offset and microseconds."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def path_key(doc: ColumnOrName, tag: str, epoch: ColumnOrName) -> Column:
    """Key of one event on one path: SHA-256 over id, path tag and feed time text.

    A NULL id gives a NULL key; a NULL feed time counts as empty text.
    """
    return F.sha2(F.concat(_c(doc), F.lit(tag), F.coalesce(_c(epoch).cast("string"), F.lit(""))), 256)


def validity(rule: str = "strict") -> Column:
    """Validity flag over route_id, trip_id, ingested_at (and trip_update_timestamp).

    ``strict`` needs the ingestion time; ``either`` accepts the feed time instead.
    """
    times = {
        "strict": F.col("ingested_at").isNotNull(),
        "either": F.col("ingested_at").isNotNull() | F.col("trip_update_timestamp").isNotNull(),
    }
    return F.col("route_id").isNotNull() & F.col("trip_id").isNotNull() & times[rule]


def first_stop_delay(stops: ColumnOrName) -> Column:
    """Delay of the first stop: its own, else on arrival, else on departure."""
    first = F.get(_c(stops), 0)
    return F.coalesce(
        first.getField("delay"),
        first.getField("arrival").getField("delay"),
        first.getField("departure").getField("delay"),
    ).cast("int")


def is_stream_route(
    route: ColumnOrName, mode: str = "letter_to_stream", ids: Iterable[str] = ()
) -> Column:
    """Whether a route belongs to the streaming segment under one of four modes.

    A missing or empty route counts as "UNKNOWN", one of blanks stays empty; an
    unknown mode sends everything to batch.
    """
    known = F.coalesce(F.nullif(_c(route), F.lit("")), F.lit(fv.UNKNOWN_ROUTE))
    rid = F.upper(F.regexp_replace(known, r"(?U)^\s+|\s+$", ""))
    starts_with_digit = rid.rlike(r"^\p{Nd}")
    if mode == "explicit":
        wanted = list(ids)
        return rid.isin(wanted) if wanted else F.lit(False)
    if mode == "letter_to_stream":
        return rid.rlike(r"^\p{L}")
    if mode == "numeric_to_batch":
        return ~starts_with_digit
    if mode == "numeric_to_stream":
        return starts_with_digit
    return F.lit(False)


def doc_id(trip: ColumnOrName, epoch: ColumnOrName, entity: ColumnOrName) -> Column:
    """Document id: the first 32 hex digits of SHA-256 over trip, raw feed time, entity."""
    parts = (
        F.coalesce(_c(trip), F.lit("")),
        F.coalesce(_c(epoch), F.lit(0)).cast("string"),
        F.coalesce(_c(entity), F.lit("")),
    )
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 32)


def route_type_label(code: ColumnOrName) -> Column:
    """Reference route code to its label."""
    label = F.lit(fv.ROUTE_TYPE_OTHER)
    for key, name in reversed(fv.ROUTE_TYPES.items()):
        label = F.when(_c(code) == key, name).otherwise(label)
    return label


def kpi_date(ts: ColumnOrName = "event_ts") -> Column:
    """Day of an event by cast."""
    return _c(ts).cast("date")


def kpi_date_by_text(ts: ColumnOrName = "event_ts") -> Column:
    """Day of an event in the declarative variant; its date text names the same day as the cast."""
    return kpi_date(ts)


def hour_utc(ts: ColumnOrName = "event_ts") -> Column:
    """Hour of day; the session zone is UTC."""
    return F.hour(_c(ts))


def delay_label(col: ColumnOrName) -> Column:
    """One-decimal text of a delay, or N/A."""
    return F.coalesce(F.round(_c(col), 1).cast("string"), F.lit("N/A"))


def stamp(df: DataFrame, name: str) -> DataFrame:
    """Add the processing time under ``name``."""
    return df.withColumn(name, F.current_timestamp())

"""Column expressions."""

from delaylake.functions.columns import (
    delay_label,
    doc_id,
    event_time,
    first_stop_delay,
    hour_utc,
    is_stream_route,
    kpi_date,
    kpi_date_by_text,
    parse_json,
    parse_ts,
    path_key,
    route_type_label,
    stamp,
    to_iso,
    validity,
)

__all__ = [
    "delay_label", "doc_id", "event_time", "first_stop_delay", "hour_utc", "is_stream_route",
    "kpi_date", "kpi_date_by_text", "parse_json", "parse_ts", "path_key", "route_type_label", "stamp", "to_iso",
    "validity",
]

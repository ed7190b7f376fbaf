"""Values that stored results depend on; they must not be changed."""

# Source tags and key tags of the two ingestion paths.
DEFAULT_SOURCE = "mta_gtfs_rt"
TAG_BATCH = "batch"
TAG_HUB = "event_hub"
FLOW_TAG_BATCH = "cosmos_batch"
FLOW_TAG_HUB = "event_hub"
KEY_TAG_BATCH = "_cosmos_"
KEY_TAG_HUB = "_eh_"

# Document envelope.
SCHEMA_VERSION = "1.0"
EVENT_TYPE = "TripUpdate"
CONTAINER_BATCH = "gtfs_rt_batch"
CONTAINER_STREAM = "gtfs_rt_stream"
UNKNOWN_ROUTE = "UNKNOWN"

# Segment modes.
SEGMENT_MODES = ("explicit", "letter_to_stream", "numeric_to_batch", "numeric_to_stream")

# Quality limits.
MIN_VALID_PCT = 95.0
DELAY_MIN_SEC = -3600
DELAY_MAX_SEC = 7200
EMPTY_AGE_HOURS = 999.0

# Route code in the reference file to type label.
ROUTE_TYPES = {"1": "SUBWAY", "2": "RAILWAY", "3": "BUS"}
ROUTE_TYPE_OTHER = "OTHER"
ROUTE_TYPE_UNKNOWN = "UNKNOWN"

# Routes used when the reference file does not list them
# (route id, short name, long name, type).
FALLBACK_ROUTES = [
    ("1", "1", "Broadway – 7th Ave Local", "SUBWAY"),
    ("2", "2", "7th Ave Express", "SUBWAY"),
    ("3", "3", "7th Ave Express", "SUBWAY"),
    ("4", "4", "Lexington Ave Express", "SUBWAY"),
    ("5", "5", "Lexington Ave Express", "SUBWAY"),
    ("6", "6", "Lexington Ave Local", "SUBWAY"),
    ("7", "7", "Flushing Local", "SUBWAY"),
    ("7X", "7X", "Flushing Express", "SUBWAY"),
    ("A", "A", "8th Ave Express", "SUBWAY"),
    ("B", "B", "6th Ave Express", "SUBWAY"),
    ("C", "C", "8th Ave Local", "SUBWAY"),
    ("D", "D", "6th Ave Express", "SUBWAY"),
    ("E", "E", "8th Ave Local", "SUBWAY"),
    ("F", "F", "6th Ave Local", "SUBWAY"),
    ("G", "G", "Brooklyn–Queens Crosstown", "SUBWAY"),
    ("J", "J", "Nassau St Local", "SUBWAY"),
    ("L", "L", "14th St–Canarsie", "SUBWAY"),
    ("M", "M", "6th Ave Local", "SUBWAY"),
    ("N", "N", "Broadway Express", "SUBWAY"),
    ("Q", "Q", "Broadway Express", "SUBWAY"),
    ("R", "R", "Broadway Local", "SUBWAY"),
    ("W", "W", "Broadway Local", "SUBWAY"),
    ("Z", "Z", "Nassau St Express", "SUBWAY"),
    ("GS", "S", "42nd St Shuttle", "SUBWAY"),
    ("FS", "S", "Franklin Ave Shuttle", "SUBWAY"),
    ("H", "S", "Rockaway Park Shuttle", "SUBWAY"),
    ("SI", "SIR", "Staten Island Railway", "RAILWAY"),
]

# Accepted feed times: 2000-01-01 to before 2100-01-01, in epoch seconds.
FEED_TIME_RANGE = (946_684_800, 4_102_444_800)

# Longest expected run of a job, in milliseconds.
RUN_LIMIT_MS = 1_800_000.0

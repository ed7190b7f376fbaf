"""Stored tables as Parquet directories on any Hadoop file system.

``loads`` tables hold one directory per load; it is written out of sight and
renamed into place, so a load is there completely or not at all, and a repeated
load id adds nothing.  ``versions`` tables are written as ``v=<n>`` and become
current when a small version file names their directories; readers never see a
half-written state and a replaced partition does not touch the others.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from delaylake.config import LakeConfig, TableSpec
from delaylake.operators.combine import union_all
from delaylake.operators.upsert import merge_sql, upsert

_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class _Dir:
    """The few file operations needed, through Hadoop so that any store works."""

    def __init__(self, spark: SparkSession, path: str):
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._root = self._hadoop.Path(path)
        self._fs = self._root.getFileSystem(spark._jsc.hadoopConfiguration())
        self._io = spark._jvm.org.apache.commons.io.IOUtils

    def _at(self, name: str):
        return self._hadoop.Path(self._root, name) if name else self._root

    def names(self, name: str = "") -> list[str]:
        where = self._at(name)
        if not self._fs.exists(where):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(where))

    def create(self) -> None:
        self._fs.mkdirs(self._root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def rename(self, old: str, new: str) -> bool:
        self._fs.mkdirs(self._at(new).getParent())
        return self._fs.rename(self._at(old), self._at(new))

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> None:
        """Create a file at once; fails when it exists, which is how races end."""
        hidden = f"_tmp-{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(hidden), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.exists(name) or not self.rename(hidden, name):
            self.delete(hidden)
            raise RuntimeError(f"{name} was committed by another writer")


@dataclass
class State:
    """Current directories of a table, and the loads already folded into them."""

    version: int = 0
    dirs: list[str] = field(default_factory=list)
    covers: list[str] = field(default_factory=list)


def state(spark: SparkSession, cfg: LakeConfig, name: str) -> State:
    d = _Dir(spark, cfg.path(name))
    known = d.names("_versions")
    if not known:
        return State()
    return State(int(known[-1]), **json.loads(d.read(f"_versions/{known[-1]}")))


def _commit(spark: SparkSession, cfg: LakeConfig, name: str, new: State) -> None:
    text = json.dumps({"dirs": new.dirs, "covers": new.covers})
    _Dir(spark, cfg.path(name)).write_new(f"_versions/{new.version:012d}", text)


# --- contracts ------------------------------------------------------------------


def conform(df: DataFrame, schema: StructType, on_null: str = "fail") -> DataFrame:
    """Columns of a contract by name and type; NOT NULL columns are enforced.

    ``on_null`` is ``fail`` (abort on a NULL), ``drop`` (leave the row out) or ``keep``.
    """
    required = [f.name for f in schema.fields if not f.nullable]
    for c in required:
        present = F.col(c).isNotNull()
        if on_null == "fail":
            failure = F.raise_error(F.lit(f"NULL in column {c}")).cast("boolean")
            df = df.filter(F.when(present, F.lit(True)).otherwise(failure))
        elif on_null == "drop":
            df = df.filter(present)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def stored_contract(spec: TableSpec) -> StructType:
    """The contract with the hidden and partition columns, NOT NULL columns marked."""
    extra = [StructField(spec.partition_by, DateType())] if spec.partition_by else []
    return StructType(spec.schema.fields + spec.hidden.fields + extra)


def _stored_schema(spec: TableSpec) -> StructType:
    return StructType([StructField(f.name, f.dataType) for f in stored_contract(spec).fields])


# --- reading ----------------------------------------------------------------------


def load_ids(spark: SparkSession, cfg: LakeConfig, name: str) -> list[str]:
    """Ids of the loads in place."""
    prefix = "load_id="
    return [n[len(prefix):] for n in _Dir(spark, cfg.path(name)).names() if n.startswith(prefix)]


def _read_dirs(spark: SparkSession, root: str, dirs: Sequence[str], schema: StructType) -> DataFrame:
    paths = [f"{root}/{d}" for d in dirs]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths).select(*schema.names)


@dataclass(frozen=True)
class Snapshot:
    """What a table consisted of when it was looked at: its state and the loads in place."""

    state: State
    loads: tuple[str, ...] = ()


def snapshot(spark: SparkSession, cfg: LakeConfig, name: str) -> Snapshot:
    loads = tuple(load_ids(spark, cfg, name)) if cfg.spec(name).kind == "loads" else ()
    return Snapshot(state(spark, cfg, name), loads)


def read_stored(spark: SparkSession, cfg: LakeConfig, name: str, at: Snapshot | None = None) -> DataFrame:
    """A table with its hidden and partition columns, now or as a snapshot has it."""
    spec, root = cfg.spec(name), cfg.path(name)
    schema = _stored_schema(spec)
    if spec.kind == "stream":
        # A file sink's own log says which files are committed.
        started = _Dir(spark, root).exists("_spark_metadata")
        return spark.read.schema(schema).parquet(root) if started else spark.createDataFrame([], schema)
    at = at or snapshot(spark, cfg, name)
    now = at.state
    if spec.kind == "versions":
        return _read_dirs(spark, root, now.dirs, schema)
    covered = set(now.covers)
    loads = [f"load_id={i}" for i in at.loads if i not in covered]
    parts = [_read_dirs(spark, root, dirs, schema) for dirs in (now.dirs, loads) if dirs]
    return union_all(parts) if parts else _read_dirs(spark, root, [], schema)


def read_load(spark: SparkSession, cfg: LakeConfig, name: str, load_id: str) -> DataFrame:
    """One load of a table."""
    return _read_dirs(spark, cfg.path(name), [f"load_id={load_id}"], _stored_schema(cfg.spec(name)))


def read_table(spark: SparkSession, cfg: LakeConfig, name: str) -> DataFrame:
    """A table in its contract."""
    if cfg.sql_catalog:
        return spark.table(cfg.sql_name(name))
    return read_stored(spark, cfg, name).select(*cfg.spec(name).schema.names)


@contextmanager
def _second_source(spark: SparkSession) -> Iterator[None]:
    """Parquet read through the second version of its source, which can take aggregates."""
    key = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(key)
    spark.conf.set(key, ",".join(s for s in before.split(",") if s.strip() != "parquet"))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored_extent(spark: SparkSession, cfg: LakeConfig, name: str) -> DataFrame:
    """(row_count, latest) of a table and its time column, one row, from file footers: no column is read.

    Footers hold times as microseconds, so that is what the files are asked for.  The partition
    column and a catalog's table are aggregated as usual.
    """
    spec = cfg.spec(name)
    ts = spec.ts_col
    kind = spec.schema[ts].dataType
    is_date = isinstance(kind, DateType)
    count, top = F.count(F.lit(1)).alias("row_count"), F.max(ts).alias("latest")
    if cfg.sql_catalog or spec.kind == "stream" or ts == spec.partition_by:
        return read_stored(spark, cfg, name).agg(count, top) if not cfg.sql_catalog else read_table(spark, cfg, name).agg(count, top)
    at = snapshot(spark, cfg, name)
    covered = set(at.state.covers)
    dirs = list(at.state.dirs) + [f"load_id={i}" for i in at.loads if i not in covered]
    if not dirs:
        return spark.createDataFrame([(0, None)], StructType([StructField("row_count", LongType(), False), StructField("latest", kind)]))
    # All columns as the files have them, flat: footers are looked up by position.
    schema = StructType([
        StructField(f.name, LongType() if f.name == ts and not is_date else f.dataType)
        for f in _stored_schema(spec).fields if f.name != spec.partition_by
    ])
    with _second_source(spark):
        rows = spark.read.schema(schema).parquet(*[f"{cfg.path(name)}/{d}" for d in dirs])
    found = rows.agg(count, top)
    return found if is_date else found.select("row_count", F.timestamp_micros("latest").alias("latest"))


def stream_table(
    spark: SparkSession, cfg: LakeConfig, name: str, max_files: int | None = None
) -> DataFrame:
    """Stream over a growing table; starts with what is already there."""
    if cfg.sql_catalog:
        return spark.readStream.table(cfg.sql_name(name))
    spec, root = cfg.spec(name), cfg.path(name)
    schema = _stored_schema(spec)
    if spec.kind == "loads":
        schema = StructType(schema.fields + [StructField("load_id", StringType())])
    _Dir(spark, root).create()
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(root).select(*spec.schema.names)


def register_views(spark: SparkSession, cfg: LakeConfig, prefix: str = "") -> list[str]:
    """Temporary views over the stored tables and the enriched KPI view."""
    from delaylake.operators.kpi import enrich

    views = []
    for name, spec in ((n, cfg.spec(n)) for n in _VIEWED):
        view = prefix + name.replace(".", "_")
        read_table(spark, cfg, name).createOrReplaceTempView(view)
        views.append(view)
    view = prefix + "gold_route_delay_kpi_enriched"
    enrich(
        read_table(spark, cfg, "gold.route_delay_kpi_daily"), read_table(spark, cfg, "silver.dim_route")
    ).createOrReplaceTempView(view)
    return views + [view]


_VIEWED = (
    "bronze.gtfs_rt_events", "bronze.eventhub_gtfs_raw", "bronze.dim_route_ref",
    "silver.fact_trip_delay_event", "silver.dim_route", "gold.route_delay_kpi_daily",
)


# --- writing ----------------------------------------------------------------------


def stage_load(df: DataFrame, cfg: LakeConfig, name: str) -> str:
    """Write a load out of sight; ``place_load`` makes it part of the table."""
    staged = f"_staging/{uuid.uuid4().hex}"
    conform(df, cfg.spec(name).schema).write.parquet(f"{cfg.path(name)}/{staged}")
    return staged


def place_load(
    spark: SparkSession, cfg: LakeConfig, name: str, staged: str, load_id: str, replace: bool = False
) -> bool:
    """Put a staged load in place; False when that load id was there already."""
    d, place = _Dir(spark, cfg.path(name)), f"load_id={load_id}"
    if d.exists(place):
        if not replace:
            d.delete(staged)
            return False
        # Aside first: whatever happens in between, one of both is still on disk.
        aside = f"_staging/{uuid.uuid4().hex}"
        d.rename(place, aside)
        if not d.rename(staged, place):
            d.rename(aside, place)
            raise RuntimeError(f"load {load_id} of {name} could not be replaced")
        d.delete(aside)
        return True
    if not d.rename(staged, place):
        raise RuntimeError(f"load {load_id} of {name} could not be placed")
    return True


def has_load(spark: SparkSession, cfg: LakeConfig, name: str, load_id: str) -> bool:
    """Whether a load is in place; one look-up, however many loads there are."""
    return _Dir(spark, cfg.path(name)).exists(f"load_id={load_id}")


def drop_loads(spark: SparkSession, cfg: LakeConfig, name: str, ids: Iterable[str]) -> None:
    """Take loads out of a table that serves as a queue."""
    d = _Dir(spark, cfg.path(name))
    for i in ids:
        d.delete(f"load_id={i}")


def drop_staged(spark: SparkSession, cfg: LakeConfig, name: str, staged: str) -> None:
    _Dir(spark, cfg.path(name)).delete(staged)


def append(df: DataFrame, cfg: LakeConfig, name: str, load_id: str, replace: bool = False) -> bool:
    """Append a load under an id; repeating the id adds nothing, or replaces on request."""
    spark = df.sparkSession
    if cfg.sql_catalog:
        conform(df, cfg.spec(name).schema).writeTo(cfg.sql_name(name)).append()
        return True
    if not replace and has_load(spark, cfg, name, load_id):
        return False
    return place_load(spark, cfg, name, stage_load(df, cfg, name), load_id, replace)


def _partition_dir(version: str, column: str, value: date | None) -> str:
    return f"{version}/{column}={_NULL_PARTITION if value is None else value.isoformat()}"


def publish(
    df: DataFrame,
    cfg: LakeConfig,
    name: str,
    replaces: Iterable[date | None] | None = None,
    covers: Sequence[str] = (),
    arranged: bool = False,
) -> int:
    """Write a new version and make it current; returns its number.

    ``replaces`` limits the change to those partitions, which ``df`` holds whole;
    the rest of the table is carried over.  ``arranged`` keeps the partitioning
    and order ``df`` already has.
    """
    spark, spec = df.sparkSession, cfg.spec(name)
    old = state(spark, cfg, name)
    # A directory of its own for each attempt: a writer that loses the race can't touch the winner's files.
    version = f"v={old.version + 1:012d}-{uuid.uuid4().hex[:12]}"
    root = cfg.path(name)
    stored = _stored_schema(spec)
    out = conform(df, stored)
    column = spec.partition_by
    if spec.kind == "loads":
        # Underscore: streams over the table read its loads, never the compacted copy.
        version = f"_base/{version}"
    if column is None:
        out.write.mode("overwrite").parquet(f"{root}/{version}")
        kept, added = [], [version]
    else:
        if not arranged:
            # AQE splits a large day over tasks and merges small ones.
            out = out.hint("rebalance", column)
        out.write.mode("overwrite").partitionBy(column).parquet(f"{root}/{version}")
        written = [n for n in _Dir(spark, root).names(version) if n.startswith(f"{column}=")]
        added = [f"{version}/{n}" for n in written]
        kept = []
        if replaces is not None:
            gone = {_partition_dir("", column, v) for v in replaces}
            gone |= {f"/{n}" for n in written}
            kept = [d for d in old.dirs if d[d.index("/"):] not in gone]
    try:
        _commit(spark, cfg, name, State(old.version + 1, kept + added, list(covers)))
    except RuntimeError:
        _Dir(spark, root).delete(version)
        raise
    return old.version + 1


def upsert_table(
    source: DataFrame, cfg: LakeConfig, name: str, keys: Sequence[str], set_cols: Sequence[str] | None = None
) -> int | None:
    """Upsert into a stored table: a new version, or ``MERGE`` on a row-level catalog.

    Sources are unique by key because each comes from a dedup or a grouping by it. Keys of stored tables are
    never NULL, so the partitioning that the dedup left is reused.
    """
    spark, spec = source.sparkSession, cfg.spec(name)
    if cfg.sql_catalog:
        staging = f"_staging_{name.replace('.', '_')}"
        conform(source, spec.schema).createOrReplaceTempView(staging)
        spark.sql(merge_sql(cfg.sql_name(name), staging, keys, set_cols))
        return None
    target = read_stored(spark, cfg, name)
    checked = conform(source, stored_contract(spec))
    return publish(upsert(target, checked, keys, set_cols, null_keys=False), cfg, name)


def drop_old_versions(spark: SparkSession, cfg: LakeConfig, name: str, keep: int = 2) -> list[str]:
    """Remove version directories that none of the newest ``keep`` versions names."""
    d = _Dir(spark, cfg.path(name))
    home = "_base/" if cfg.spec(name).kind == "loads" else ""
    needed = [x for f in d.names("_versions")[-keep:] for x in json.loads(d.read(f"_versions/{f}"))["dirs"]]
    roots = {x.removeprefix(home).split("/")[0] for x in needed}
    dropped = [home + n for n in d.names(home) if n.startswith("v=") and n not in roots]
    for n in dropped:
        d.delete(n)
    return dropped


# --- control table and logs -----------------------------------------------------------


def instant() -> Column:
    """The present as a literal: the same value in every action of a run."""
    return F.lit(datetime.now(timezone.utc))


def read_generation(spark: SparkSession, cfg: LakeConfig) -> int:
    """The stored number of full refreshes of the declarative tables."""
    known = _Dir(spark, cfg.generations()).names()
    return int(known[-1]) if known else 0


def next_generation(spark: SparkSession, cfg: LakeConfig) -> int:
    """Begin a full refresh; two at once can't get the same number."""
    new = read_generation(spark, cfg) + 1
    _Dir(spark, cfg.generations()).write_new(f"{new:012d}", "")
    return new


@contextmanager
def failures_logged(spark: SparkSession, cfg: LakeConfig, job: str, run_id: str) -> Iterator[None]:
    """A job that raises leaves a FAILED row in the run log; the error goes on."""
    begun = datetime.now(timezone.utc)
    try:
        yield
    except Exception as error:
        spent = (datetime.now(timezone.utc) - begun).total_seconds() * 1000
        log_runs(run_row(spark, job, run_id, F.lit(begun), "FAILED", None, spent, str(error)[:2000]), cfg)
        raise


def read_mark(spark: SparkSession, cfg: LakeConfig, key: str) -> int:
    """Stored high-water mark of a source; 0 when there is none."""
    marks = read_table(spark, cfg, "bronze._cosmos_watermarks")
    row = marks.filter(F.col("source_key") == key).agg(F.max("last_ts").alias("m")).first()
    return row["m"] or 0


def write_mark(spark: SparkSession, cfg: LakeConfig, key: str, mark: int, now: Column) -> None:
    """Move a source's mark."""
    row = spark.range(1).select(
        F.lit(key).alias("source_key"), F.lit(mark).cast("bigint").alias("last_ts"),
        now.cast("timestamp").alias("updated_at"),
    )
    upsert_table(row, cfg, "bronze._cosmos_watermarks", ["source_key"])


def run_row(
    spark: SparkSession, job: str, run_id: str, started_at: Column, result: str, rows: int | None,
    latency_ms: float | None, detail: str | None = None, life_cycle: str = "TERMINATED",
) -> DataFrame:
    """One run-log row."""
    return spark.range(1).select(
        F.lit(job).alias("job"), F.lit(run_id).alias("run_id"), started_at.alias("started_at"),
        F.lit(life_cycle).alias("life_cycle"), F.lit(result).alias("result"),
        F.lit(rows).cast("bigint").alias("rows"), F.lit(latency_ms).cast("double").alias("latency_ms"),
        F.lit(detail).cast("string").alias("detail"),
    )


def log_runs(rows: DataFrame, cfg: LakeConfig, load_id: str | None = None) -> None:
    """Append to the run log; metrics by route stay rows and never pass the driver."""
    append(rows, cfg, "ops.run_log", load_id or uuid.uuid4().hex)


def log_commit(
    spark: SparkSession, cfg: LakeConfig, table: str, version: int, operation: str, rows: int | None
) -> None:
    """Append to the operation log."""
    row = spark.range(1).select(
        F.lit(table).alias("table_name"), F.lit(version).cast("bigint").alias("version"),
        F.current_timestamp().alias("ts"), F.lit(operation).alias("operation"),
        F.lit(rows).cast("bigint").alias("rows_written"),
    )
    append(row, cfg, "ops.commit_log", uuid.uuid4().hex)

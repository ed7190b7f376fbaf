"""The daily run: documents to silver on one branch, reference to dimension on the other."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylake import storage
from delaylake.config import LakeConfig
from delaylake.plans import export, medallion
from delaylake.plans.branches import run_branches
from delaylake.plans.ingest import LoadResult, load_documents, load_reference


def run_daily(
    spark: SparkSession,
    cfg: LakeConfig,
    docs: DataFrame,
    routes: DataFrame,
    snapshot_date: str,
    now: Column | None = None,
    incremental: bool = False,
    jdbc: Mapping[str, str] | None = None,
) -> LoadResult:
    """Both branches side by side, joined at the KPIs, then the export where a database is given.

    A branch that fails leaves the other complete, and gold as it was.

    ``incremental`` merges only what bronze gained since the last run and
    recomputes only the changed days, those of an interrupted earlier run included; the
    tables come out the same. A run that raises leaves a FAILED row in the run log.
    """
    loading = threading.Event()

    def facts_branch() -> LoadResult:
        try:
            loaded = load_documents(spark, cfg, docs, now=now)
        finally:
            loading.set()
        if incremental:
            medallion.stream_silver(spark, cfg)
        else:
            medallion.run_silver(spark, cfg)
        return loaded

    def dimension_branch() -> None:
        load_reference(spark, cfg, routes, snapshot_date, now)
        # Routes that only documents name come from what bronze holds: this run's load, or earlier ones if it failed.
        loading.wait()
        medallion.run_dimension(spark, cfg, F.lit(snapshot_date).cast("date"))

    with storage.failures_logged(spark, cfg, "daily_run", uuid.uuid4().hex):
        loaded = run_branches(spark, cfg, "daily_run", {"facts": facts_branch, "dimension": dimension_branch})["facts"]
        if incremental:
            medallion.run_pending_gold(spark, cfg)
        else:
            medallion.run_gold(spark, cfg)
        if jdbc:
            export.export_all(spark, cfg, jdbc)
        return loaded

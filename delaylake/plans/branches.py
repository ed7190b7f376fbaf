"""Branches of a plan at the same time: a thread and a scheduler pool each."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from typing import Any

from pyspark import InheritableThread
from pyspark.sql import SparkSession

from delaylake import storage
from delaylake.config import LakeConfig

POOL = "spark.scheduler.pool"


class BranchFailure(RuntimeError):
    """Some branches failed; ``done`` holds what the others returned."""

    def __init__(self, failures: dict[str, BaseException], done: dict[str, Any]):
        super().__init__("; ".join(f"{name}: {error}" for name, error in failures.items()))
        self.failures, self.done = failures, done


def run_branches(spark: SparkSession, cfg: LakeConfig, job: str, branches: Mapping[str, Callable[[], Any]]) -> dict[str, Any]:
    """Run all branches side by side and wait for all; a failing one stops no other.

    Threads inherit the caller's local properties, and each branch submits its jobs to a pool
    of its own name, so under ``spark.scheduler.mode=FAIR`` a long branch leaves the others
    their share.  Every failed branch leaves a FAILED row in the run log.
    """
    done: dict[str, Any] = {}
    failures: dict[str, BaseException] = {}

    def go(name: str, branch: Callable[[], Any]) -> None:
        spark.sparkContext.setLocalProperty(POOL, f"{job}-{name}")
        try:
            with storage.failures_logged(spark, cfg, f"{job}.{name}", uuid.uuid4().hex):
                done[name] = branch()
        except BaseException as error:
            failures[name] = error

    threads = [InheritableThread(target=go, args=item, name=item[0]) for item in branches.items()]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if failures:
        raise BranchFailure(failures, done)
    return done

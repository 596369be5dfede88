"""Session construction and the shared scratch folder.

Everything that must survive an executor loss (lineage cuts, staging tables,
streaming checkpoints) lives under the folder the cluster names in
``spark.checkpoint.dir``. Only a session on a local master, as in tests, may
have none; it gets a folder of its own.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

# Settings every session built here gets. AQE re-plans joins and coalesces
# shuffle partitions at run time; skew join splits hot partitions; the time
# zone is pinned so calendar partitions do not depend on the machine.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "strata",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder. Only a local master may go
    without one: it gets a temporary folder, which its one machine shares."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
            current = tempfile.mkdtemp(prefix="strata-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current.rstrip("/")


def fine_partitions(spark: SparkSession) -> int:
    """Partitions for a join whose tasks hold sorts and hash tables of several
    operators at once: twice the session's own. One side dealt out by this
    number takes the other along, so that no row moves more often, and AQE
    does not put such partitions together again; a side small enough is still
    broadcast. AQE does not split them either: a key with many rows stays in
    one task, whose sort spills."""
    return 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = shared_dir(spark)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def at_once(spark: SparkSession, jobs: Sequence[Callable[[], T]]) -> list[T]:
    """The results of ``jobs``, each run in a thread of its own: while one
    waits for its slowest task, for a listing or a commit, the tasks of the
    others have the cores. All of them end before the first error, in the
    order of ``jobs``, is raised."""
    if len(jobs) < 2:
        return [job() for job in jobs]
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [r.result() for r in running]

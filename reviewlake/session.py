"""Session helpers: a tuned local session and the shared scratch location."""

from __future__ import annotations

import contextlib
import logging
import math
import os
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from reviewlake import filesystem

logger = logging.getLogger(__name__)

# Output files and the data of one shuffle task aim at this size.
TARGET_BYTES = 256 * 1024 * 1024
# So many partitions a writing task keeps open. Open columnar files hold their row groups, together no more
# than the task's rows, encoded; a task that meets more partitions sorts all its further rows, unpacked.
OPEN_FILES = 16
# The optimizer's estimate for inputs without statistics is near the largest long.
UNKNOWN_BYTES = 10**18


def local_session(cpus: int | str = 8, name: str = "reviewlake", **conf: str) -> SparkSession:
    """A ``local[cpus]`` session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("REVIEWLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="reviewlake-warehouse-"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for intermediate tables, visible to every executor.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one machine, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="reviewlake-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


_borrowed: dict[tuple[int, str], tuple[int, str | None]] = {}
_lock = threading.Lock()


@contextlib.contextmanager
def session_conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Set SQL options (``__`` stands for a dot) for one block and restore them after it.

    Blocks of several threads may overlap: the last to end restores the first value. Inside an
    overlap a thread may see another's value, so only options that do not affect results belong here.
    """
    keys = {name.replace("__", "."): value for name, value in settings.items()}
    with _lock:
        for key, value in keys.items():
            users, original = _borrowed.get((id(spark), key), (0, spark.conf.get(key, None)))
            _borrowed[id(spark), key] = users + 1, original
            spark.conf.set(key, value)
    try:
        yield
    finally:
        with _lock:
            for key in keys:
                users, original = _borrowed.pop((id(spark), key))
                if users > 1:
                    _borrowed[id(spark), key] = users - 1, original
                elif original is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, original)


def shuffles_dropped(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Writes in this block delete their shuffle files at their end, not once the driver collects garbage."""
    return session_conf(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


def shuffle_tasks_for(df: DataFrame, task_bytes: int = TARGET_BYTES) -> int:
    """Reduce tasks that the size of the rows asks for; runs no job.

    The size is the optimizer's estimate, or that of the input files where it has none.
    """
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if estimate >= UNKNOWN_BYTES:
        folders = {path.rsplit("/", 1)[0] for path in df.inputFiles()}
        estimate = sum(filesystem.size_in_bytes(df.sparkSession, folder) for folder in folders)
        logger.info("no size estimate; %d bytes in %d input folders", estimate, len(folders))
    return max(configured, math.ceil(estimate / task_bytes))


@contextlib.contextmanager
def write_sizing(
    spark: SparkSession, shuffled: DataFrame | None = None, file_bytes: int = TARGET_BYTES
) -> Iterator[None]:
    """Size the shuffles below a write by the rows they move.

    AQE merges small shuffle partitions but splits large ones only in joins and rebalances, so it
    must start with enough of them; it then merges them up to the size of an output file. Without
    ``shuffled``, as for aggregates that come out small, the session's own number stands.

    A task that brings at most ``OPEN_FILES`` partitions writes their files side by side instead of sorting
    all its rows, which would hold them unpacked in memory. From the first row of a further one on it sorts.
    """
    settings = {"spark__sql__adaptive__advisoryPartitionSizeInBytes": str(file_bytes),
                "spark__sql__maxConcurrentOutputFileWriters": str(OPEN_FILES)}
    if shuffled is not None:
        settings["spark__sql__adaptive__coalescePartitions__initialPartitionNum"] = str(
            shuffle_tasks_for(shuffled, file_bytes))
    with session_conf(spark, **settings):
        yield

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Skew splitting and run-time join choice are left to adaptive execution; no
# operator in this package carries a broadcast hint, so the broadcast threshold
# is the one size check that every small side has to pass.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # No Python call site per column expression: building a large plan is about twice as fast.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # De-duplication state of a day of readings outgrows an executor's heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


# Shuffled bytes that a task reads, rows of the input to a partition of a shuffle, and bytes of a file that a
# task reads, in a ``bounded_session``.
TASK_BYTES, TASK_ROWS, SPLIT_BYTES = 8 << 20, 500_000, 32 << 20


def build_session(app_name: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings above, of which ``conf`` may add to or replace any."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bounded_session(spark: SparkSession, rows: int) -> SparkSession:
    """A session like the given one, whose tasks behind a shuffle take about ``TASK_BYTES`` and ``TASK_ROWS`` at most,
    and those that read files ``SPLIT_BYTES``.

    Sums and joins of one task stand on each other's rows, and short rows compress well: adaptive
    execution's 64 MB can be five million of them, and a file split's 128 MB ten million readings that are summed
    before the shuffle. ``rows``: how many the input has; the more, the more partitions a
    shuffle begins with. Smaller settings of the given session stay, which is itself not changed.
    """
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            session.conf.set(name, value)
    bounds = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES,
        "spark.sql.files.maxPartitionBytes": SPLIT_BYTES,
    }
    for name, most in bounds.items():
        session.conf.set(name, min(byte_count(session.conf.get(name)), most))
    most = max(int(session.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))
    session.conf.set("spark.sql.shuffle.partitions", most)
    return session


def byte_count(size: str) -> int:
    """Bytes of a size as Spark's settings have it: a number, with a unit or none."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="wattfold-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor must reach.

    Only a local session may run without that setting; it then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"

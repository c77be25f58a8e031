"""Session construction and shared-storage helpers.

Everything that has to be written somewhere (staged source files, stream
checkpoints, materialised tables) goes under the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is missing on a local master
(unit tests) do we create and register one of our own.  Intermediate tables
live in one folder per application; :func:`scratch_scope` and
:func:`release_scratch` remove them.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter for the plans in this package.  AQE re-plans joins at
# runtime from real shuffle statistics (broadcast only below the threshold,
# split skewed partitions), which is the size check we rely on instead of
# hard-coded broadcast hints.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str = "local[*]",
    shuffle_partitions: int | None = None,
    app_name: str = "claimwright",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session configured the way the plans expect.

    The number of shuffle partitions is the cluster's own unless one is given.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering one only on a local master.

    On a cluster every executor would write to its own disk, so there the
    setting must name a shared folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no SparkContext
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not is_local(sc.master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all of {sc.master} shares")
        configured = tempfile.mkdtemp(prefix="claimwright-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def is_local(master: str) -> bool:
    """One process runs driver and tasks: ``local``, ``local[4]``, ``local[*]``."""
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    run = spark.conf.get("spark.app.id", None) or "run"
    return f"{base}/claimwright/{run}{_SCOPES[-1] if _SCOPES else ''}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the application's scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_SCOPES: list[str] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """What is stored inside the block lies in one folder, removed at its end.

    DataFrames made inside read those tables, so collect or write their rows
    before the block ends.
    """
    _SCOPES.append(f"{_SCOPES[-1] if _SCOPES else ''}/scope-{uuid.uuid4().hex[:12]}")
    root = scratch_root(spark)
    try:
        yield root
    finally:
        _SCOPES.pop()
        _remove(spark, root)


# Runs that write table after table would keep the shuffle files of all their jobs
# until the driver happens to collect its garbage, and the disk would hold many
# times the tables.  Inside :func:`disk_spared` each job's go at its end.
SPARING_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}
_spared: list[dict[str, str | None]] = []  # for each block inside, the values before the first
_spared_lock = threading.Lock()


@contextmanager
def disk_spared(spark: SparkSession) -> Iterator[None]:
    """Writes inside the block leave no shuffle files behind and store denser parquet.

    The settings are the session's, so blocks may nest and overlap in threads: the
    last one to end puts the earlier values back.
    """
    with _spared_lock:
        before = _spared[0] if _spared else {key: spark.conf.get(key, None) for key in SPARING_CONF}
        if not _spared:
            for key, value in SPARING_CONF.items():
                spark.conf.set(key, value)
        _spared.append(before)
    try:
        yield
    finally:
        with _spared_lock:
            _spared.pop()
            if not _spared:
                for key, value in before.items():
                    if value is None:
                        spark.conf.unset(key)
                    else:
                        spark.conf.set(key, value)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove an intermediate folder that nothing reads any more."""
    _remove(spark, path)


def release_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application (at its end)."""
    _remove(spark, scratch_root(spark))


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

"""Session construction, the shared scratch area, partition sizing.

Intermediate tables that must not be recomputed differently (sequence
numbering, stream logs in tests) are written below the cluster's
``spark.checkpoint.dir``; ``scratch_scope`` removes them after use.  The library never invents a machine-local folder:
``checkpoint_root`` raises when the setting is missing, and only
``ensure_checkpoint_root`` (used by tests, bench and the driver entry) sets a
fallback, and only under a ``local`` master with nothing configured.
"""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    app: str = "loadcast",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """SparkSession with the settings the library relies on.

    ANSI stays on (Spark 4 default): bad casts raise unless ``try_cast`` is
    used on purpose.  AQE re-plans joins and coalesces small shuffles at run
    time, and splits skewed join partitions.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``)."""
    try:
        d = spark.sparkContext.getCheckpointDir()
    except Exception:  # no SparkContext on a remote (Connect) session: use the setting
        d = None
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    raise RuntimeError(
        "spark.checkpoint.dir is not set; configure a shared folder for the cluster"
    )


def ensure_checkpoint_root(spark: SparkSession) -> str:
    """Like ``checkpoint_root`` but sets a local folder when none is configured.

    Meant for tests and single-machine runs only: under any other master than
    ``local`` a missing setting raises, since executors would write to disks
    of their own.
    """
    try:
        return checkpoint_root(spark)
    except RuntimeError:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local($|\[)", master):
            raise
        d = tempfile.mkdtemp(prefix="loadcast-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        return spark.sparkContext.getCheckpointDir() or d


# The open scopes of this thread (a thread that is started sees none of its parent's).
_SCOPES: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("scopes", default=())
_CREATED: list[str] = []
# Remove this process's own scratch folders when it exits (nothing else under the root).
CLEANUP_AT_EXIT = True


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the checkpoint root (recorded by an open ``scratch_scope``)."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/loadcast/{label}-{uuid.uuid4().hex}"
    if _SCOPES.get():
        _SCOPES.get()[-1].append(path)
    if not _CREATED:
        atexit.register(_cleanup_at_exit)
    _CREATED.append(path)
    return path


def _cleanup_at_exit() -> None:
    if not CLEANUP_AT_EXIT:
        return
    spark = SparkSession.getActiveSession()
    for path in reversed(_CREATED):
        try:
            if spark is not None:
                drop_path(spark, path)
            elif path.startswith("file:") or path.startswith("/"):
                shutil.rmtree(local_path(path), ignore_errors=True)
        except Exception:  # the JVM may already be gone; local paths are handled above
            if path.startswith("file:") or path.startswith("/"):
                shutil.rmtree(local_path(path), ignore_errors=True)


def drop_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` through the Hadoop FileSystem of its scheme.

    Returns False when the JVM is not reachable (a remote session).
    """
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    except Exception:
        return False
    return bool(fs.delete(p, True))


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the scratch folders created inside the block when it ends.

    Wrap the action that consumes the result (a write, a collect); frames
    that still read those folders must not be used after the block.
    """
    created: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), created))
    try:
        yield created
    finally:
        _SCOPES.reset(token)
        for path in created:
            drop_path(spark, path)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for APIs that need a plain local path."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.normpath(path)


def cluster_conf(total_cores: int, advisory_mb: int = 256, file_split_mb: int = 512) -> dict[str, str]:
    """Starting settings for a large cluster run (pass as ``build_session(conf=...)``).

    * shuffle partitions ~ 3 x cores: enough parallelism for the widest
      shuffle; AQE coalesces small ones to ``advisory_mb`` per task;
    * ``file_split_mb`` per scan task keeps the task count of a 100 TB scan
      near 200k instead of 800k at the 128 MB default;
    * skew join splitting on, broadcast joins only below Spark's measured
      threshold (AQE uses runtime sizes, not estimates);
    * RocksDB state store for the stateful speed layer.
    """
    return {
        "spark.sql.shuffle.partitions": str(max(200, 3 * int(total_cores))),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{advisory_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": f"{file_split_mb}m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Buckets written by `operators.bucketed` are one sorted file each: merge joins needn't sort them.
        "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
        # Streaming state (the stateful current view) off the JVM heap, checkpointed incrementally.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def parse_bytes(text: str) -> int:
    t = str(text).strip().lower()
    num = t.rstrip("bkmgt")
    unit = t[len(num):] or "b"
    return int(float(num) * _UNITS[unit])


_UNRELIABLE = re.compile(r"^[\s:+\-|]*(Aggregate|Join|Window|Generate|Expand|LogicalRDD|Union)\b", re.M)


def target_partitions(df) -> int | None:
    """Shuffle partitions for ``df`` at about the advisory partition size.

    Uses Catalyst's size estimate, but only for scan / filter / project
    plans, where it tracks the bytes read.  After an aggregate or a join the
    estimate without CBO is an upper bound that can be far off (a join is
    estimated as the product of its sides), so those return None and the
    session default applies, with AQE coalescing.  Also None when the default
    shuffle partition count already suffices.  Range exchanges need this
    because AQE can merge range partitions but never split an oversized one.
    """
    spark = df.sparkSession
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        if _UNRELIABLE.search(plan.toString()):
            return None
        size = int(plan.stats().sizeInBytes())
    except Exception:  # no JVM plan access (e.g. a remote session)
        return None
    if size >= (1 << 62):  # Catalyst's "unknown" (defaultSizeInBytes = Long.MaxValue)
        return None
    advisory = parse_bytes(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m"))
    default = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    want = min(-(-size // max(advisory, 1)), MAX_PARTITIONS)
    return int(want) if want > default else None


MAX_PARTITIONS = 200_000

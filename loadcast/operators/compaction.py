"""Compaction of a keyed log under a versioned manifest.

A log is written as ``<log>/batch_id=N/dt=DAY`` and grows with every batch.
``compact`` folds the batches that have arrived since, and the snapshots of the
days they touch, into new snapshots of those days (one row per key); the other
days stay as they are.  What counts is the manifest, one small JSON file a
version: the snapshot folder of each day and the last batch folded.  A version
is written whole under a new name, so a reader sees one or the other, and of two
compactions at a time the second fails.  Folders that a version no longer names are kept
for ``grace_s`` seconds, for readers of older versions, and then deleted.

Everything lives below the log: ``_manifest`` and ``_snapshots`` begin with an
underscore, so Spark doesn't take them for batches.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.operators.kv import BATCH, DAY, kv_current


@dataclass(frozen=True)
class Manifest:
    """``days``: the snapshot folder of each day; ``through``: the last batch that is in them;
    ``retired``: folders no version names any more, and when (epoch seconds) that began."""

    version: int = 0
    through: int = -1
    days: dict[str, str] = field(default_factory=dict)
    retired: list[tuple[str, float]] = field(default_factory=list)


class _Folder:
    """The log's folder, through the Hadoop FileSystem of its scheme."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._gateway, self._jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))

    def names(self, name: str = "") -> list[str]:
        path = self._path(name)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Write a file under a name that nobody has; it appears whole."""
        draft = self._path(f"{name.rsplit('/', 1)[0]}/_draft-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.NONE  # fails if the name is taken
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(draft, self._path(name), options)
        except Exception as e:
            self._fs.delete(draft, False)
            raise RuntimeError(f"{self.root}/{name} exists already: another compaction was faster") from e

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


def _version_name(version: int) -> str:
    return f"_manifest/v{version:010d}.json"


def _versions(folder: _Folder) -> list[int]:
    return sorted(int(m[1]) for m in (re.fullmatch(r"v(\d+)\.json", n) for n in folder.names("_manifest")) if m)


def is_log(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds batches or a manifest (and not a plain table)."""
    return any(n == "_manifest" or n.startswith(f"{BATCH}=") for n in _Folder(spark, path).names())


def read_manifest(spark: SparkSession, log_path: str) -> Manifest:
    """The latest version; one that names nothing if the log was never compacted."""
    folder = _Folder(spark, log_path)
    versions = _versions(folder)
    if not versions:
        return Manifest()
    found = json.loads(folder.read(_version_name(versions[-1])))
    return Manifest(found["version"], found["through"], found["days"], [(p, t) for p, t in found["retired"]])


def _batches(folder: _Folder, after: int) -> list[tuple[int, bool]]:
    """(batch, whether it's written whole) of the batches after one, in order."""
    found = sorted(int(m[1]) for m in (re.fullmatch(rf"{BATCH}=(\d+)", n) for n in folder.names()) if m)
    return [(b, folder.exists(f"{BATCH}={b}/_SUCCESS")) for b in found if b > after]


def live_batches(spark: SparkSession, log_path: str, manifest: Manifest) -> list[int]:
    """The whole batches that the manifest's snapshots don't hold."""
    return [b for b, whole in _batches(_Folder(spark, log_path), manifest.through) if whole]


def is_folded(spark: SparkSession, log_path: str, batch_id: int) -> bool:
    """Whether this batch is in a snapshot already.

    A stream replays only the last batch it wrote, so that one may be; an earlier
    one means another stream (a new checkpoint) on the same log, whose rows would
    be lost: that raises.
    """
    through = read_manifest(spark, log_path).through
    if batch_id < through:
        raise ValueError(f"batch {batch_id} of {log_path} is before the compacted batch {through}: a new stream needs a new log")
    return batch_id == through


def _snapshots(spark: SparkSession, log_path: str, manifest: Manifest, days: Sequence[str]) -> DataFrame | None:
    root = log_path.rstrip("/")
    paths = [f"{root}/{manifest.days[d]}" for d in days if d in manifest.days]
    if not paths:
        return None
    rows = spark.read.option("basePath", f"{root}/_snapshots").parquet(*paths)
    return rows.drop("snapshot").withColumns({DAY: F.col(DAY).cast("string"), BATCH: F.lit(manifest.through).cast("long")})


def _live(spark: SparkSession, log_path: str, batches: Sequence[int]) -> DataFrame | None:
    if not batches:
        return None
    root = log_path.rstrip("/")
    rows = spark.read.option("basePath", root).parquet(*[f"{root}/{BATCH}={b}" for b in batches])
    return rows.withColumns({DAY: F.col(DAY).cast("string"), BATCH: F.col(BATCH).cast("long")})


def _merged(parts: Sequence[DataFrame | None], key: str, seq: str | None, cells: Sequence[str]) -> DataFrame:
    columns = [key, DAY, BATCH, *([seq] if seq else []), *cells]
    rows = None
    for part in parts:
        if part is not None:
            rows = part.select(*columns) if rows is None else rows.unionByName(part.select(*columns))
    order = (BATCH, seq) if seq else (BATCH,)
    return kv_current(rows, key, order, cells, day=DAY).select(key, DAY, *([seq] if seq else []), *cells)


def read_current(spark: SparkSession, log_path: str, key: str = "key", seq: str | None = "seq", cells: Sequence[str] = ()) -> DataFrame:
    """The current table (key, day, seq, cells) of the latest version: its snapshots and the batches after them.

    Only the folders that the version names are in the plan.  Day and key
    ranges are applied before the merge (see ``kv_current``).
    """
    manifest = read_manifest(spark, log_path)
    parts = [_snapshots(spark, log_path, manifest, list(manifest.days)), _live(spark, log_path, live_batches(spark, log_path, manifest))]
    if not any(p is not None for p in parts):
        raise FileNotFoundError(f"{log_path} has no batch yet")
    return _merged(parts, key, seq, cells)


def compact(
    spark: SparkSession, log_path: str, key: str = "key", seq: str | None = "seq", cells: Sequence[str] = (), grace_s: float = 86_400
) -> Manifest:
    """Fold the batches written since the last compaction into the snapshots of their days.

    Stops before the first batch that isn't written whole.  Then deletes the
    folders that have been out of use for ``grace_s`` seconds.
    """
    folder, manifest = _Folder(spark, log_path), read_manifest(spark, log_path)
    todo: list[int] = []
    for batch, whole in _batches(folder, manifest.through):
        if not whole:
            break
        todo.append(batch)
    if todo:
        news = _live(spark, log_path, todo)
        days = sorted({n.split("=", 1)[1] for b in todo for n in folder.names(f"{BATCH}={b}") if n.startswith(f"{DAY}=")})
        path = f"_snapshots/snapshot={manifest.version + 1}-{uuid.uuid4().hex[:8]}"
        folded = _merged([_snapshots(spark, log_path, manifest, days), news], key, seq, cells)
        # small days share a task, large ones are split
        folded.hint("rebalance", DAY).write.mode("errorifexists").partitionBy(DAY).parquet(f"{folder.root}/{path}")
        now = time.time()
        out = [*(manifest.days[d] for d in days if d in manifest.days), *(f"{BATCH}={b}" for b in todo)]
        manifest = Manifest(
            manifest.version + 1, todo[-1], manifest.days | {d: f"{path}/{DAY}={d}" for d in days}, [*manifest.retired, *((p, now) for p in out)]
        )
        _publish(folder, manifest, orphan=path)
    return sweep(spark, log_path, grace_s)


def _publish(folder: _Folder, manifest: Manifest, orphan: str | None = None) -> None:
    try:
        folder.publish(_version_name(manifest.version), json.dumps(asdict(manifest)))
    except RuntimeError:
        if orphan:
            folder.delete(orphan)
        raise


def sweep(spark: SparkSession, log_path: str, grace_s: float = 86_400) -> Manifest:
    """Delete what no version has named for ``grace_s`` seconds, and the manifests but the last two."""
    folder, manifest = _Folder(spark, log_path), read_manifest(spark, log_path)
    old = [(p, t) for p, t in manifest.retired if t <= time.time() - grace_s]
    if old:
        for path, _ in old:
            folder.delete(path)
        manifest = Manifest(manifest.version + 1, manifest.through, manifest.days, [r for r in manifest.retired if r not in old])
        _publish(folder, manifest)
    for version in _versions(folder)[:-2]:
        folder.delete(_version_name(version))
    return manifest

"""Session construction and the shared working folder.

All intermediate tables, checkpoints and staging folders live below the folder the
cluster names in ``spark.checkpoint.dir`` (a shared file system on a real cluster).
We only pick a folder of our own when the session has none, as in local tests.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

from levain.sources import fs

# Settings every job in this package relies on.  The time zone is pinned so that
# DATE(ts) and friends do not depend on the machine; AQE re-plans joins and
# coalesces or splits shuffle partitions at run time.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.caseSensitive": "false",
}


def get_session(master: str | None = None, app_name: str = "levain", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the runtime options we depend on (safe to call repeatedly)."""
    for k, v in SESSION_DEFAULTS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on an already-running session
            pass
    checkpoint_root(spark)


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Runtime settings that hold within."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Shuffle files of a query go when it ends, not when the driver next collects garbage: for writes, whose plans are not run again.
SHUFFLES_REMOVED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and work tables.

    Read from ``spark.checkpoint.dir``; only when unset (local tests) do we make one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on the cluster's shared file system")
        # local mode only (tests): a folder of our own
        root = tempfile.mkdtemp(prefix="levain-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared folder; ``unique`` appends a fresh id (one per run)."""
    path = "/".join([checkpoint_root(spark), "levain", *parts])
    if unique:
        path = f"{path}/{uuid.uuid4().hex[:12]}"
    fs.make_dirs(spark, path)
    return path

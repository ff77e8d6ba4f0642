"""Spark session helpers and the shared scratch location.

All dates are derived from zone-less timestamps, so results do not depend on
the session time zone; the builder still pins UTC for readable output.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app_name: str = "adlens",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this library assumes.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data; AQE coalesces small shuffles at runtime either way.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a ``local`` session without one gets a folder of its own; anywhere
    else executors would write to their own disks, so that is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:  # a classic session; Spark Connect has no SparkContext here
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local") or \
                spark.conf.get("spark.master", "").startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="adlens-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused directory below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/adlens-scratch/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str):
    """Write ``df`` once to a fresh folder under the shared checkpoint folder
    and return it read back: lineage stops here and the plan runs once.

    (An eager ``DataFrame.checkpoint()`` runs one job to count and another
    to write; the second re-reads its inputs unless they end in a shuffle.)
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


@contextmanager
def stored(df, name: str):
    """``df`` written once, as ``materialize`` does, and deleted afterwards:
    for copies that nothing reads lazily once the block has ended."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    try:
        df.write.parquet(path)
        yield spark.read.parquet(path)
    finally:
        delete_path(spark, path)


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is at ``path``; other faults of the store are raised."""
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _file_system(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    if fs.exists(to):
        raise FileExistsError(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"{source} could not be renamed to {target}")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in the folder ``path``; none where it is missing."""
    fs, p = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

"""Session and shared-folder helpers."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "kestrel",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume:
    AQE with skew-join splitting and partition coalescing, Arrow transfer
    for pandas UDFs, UTC session time zone, UI off."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set by the deployment (a folder every executor
    can reach); unset, this raises.  Only a local master, as in tests, gets
    a fresh private folder."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not re.match(r"local(\[[^\]]*\])?$", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            d = tempfile.mkdtemp(prefix="kestrel-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique location under the shared checkpoint folder for a
    table the job writes and reads back (lineage cut that survives
    executor loss)."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/kestrel-{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def clean_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables made so far, once nothing reads them any
    more; returns how many existed."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def discard(spark: SparkSession, path: str) -> None:
    """Delete one scratch table that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def local_path(p: str) -> str:
    """Strip a ``file:`` scheme for stdlib access in tests."""
    if p.startswith("file:"):
        p = p[5:]
        while p.startswith("//"):
            p = p[1:]
    return os.path.abspath(p)


def free_shuffles(spark: SparkSession) -> None:
    """Free the shuffle files of plans that nothing holds any more: Spark's cleaner
    finds them when the driver collects its garbage, which it may not do for an hour."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_SHIPPED: set[int] = set()
_SHIPPING = threading.Lock()  # fits that run side by side ship once


def ensure_shipped(spark: SparkSession) -> None:
    """Make ``kestrel`` importable in Python workers (operators whose
    pandas UDFs call package helpers).  Skipped when workers can already
    import it (installed package); otherwise the package is zipped once
    per driver and registered with ``addPyFile``."""
    with _SHIPPING:
        _ship(spark.sparkContext)


def _ship(sc) -> None:
    if id(sc) in _SHIPPED:
        return
    import importlib.util
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    spec = importlib.util.find_spec("kestrel")
    installed = spec is not None and "site-packages" in (spec.origin or "")
    if not installed:
        zdir = tempfile.mkdtemp(prefix="kestrel-pyfiles-")
        zpath = os.path.join(zdir, "kestrel.zip")
        with zipfile.ZipFile(zpath, "w") as z:
            for root, _, files in os.walk(pkg_dir):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(root, f)
                        z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
        sc.addPyFile(zpath)
    _SHIPPED.add(id(sc))


_KEPT: list = []


def keep(df):
    """Persist an intermediate table (MEMORY_AND_DISK: spills instead of
    failing, recomputed from lineage if an executor is lost) and remember
    it so ``release_cached`` can free it once results are written."""
    from pyspark import StorageLevel
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    _KEPT.append(out)
    return out


def release_cached() -> int:
    """Unpersist every intermediate kept by kestrel operators so far;
    returns how many were released."""
    n = len(_KEPT)
    while _KEPT:
        _KEPT.pop().unpersist()
    return n

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on.  ANSI casts make bad text fail the job the
# way the typed layers demand; UTC keeps dates off the machine's zone.
BASE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# A session that keeps other values for these would give other answers.
ANSWERS_DEPEND_ON = ("spark.sql.ansi.enabled", "spark.sql.session.timeZone")


def build_session(master: str = "local[*]", app: str = "strata",
                  shuffle_partitions: int = 8, extra: dict | None = None,
                  driver_memory: str = "12g") -> SparkSession:
    """Local session for tests and the bench; clusters pass their own conf."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.driver.memory", driver_memory)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Put the runtime settings on a session someone else built, and make
    the package importable on executors."""
    for k, v in BASE_CONF.items():
        spark.conf.set(k, v)
    for k in ANSWERS_DEPEND_ON:
        if spark.conf.get(k) != BASE_CONF[k]:
            raise RuntimeError(f"{k} is {spark.conf.get(k)!r} and can't be set to {BASE_CONF[k]!r}")
    ship_package(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application.

    Python tasks that call library code (``mapInPandas`` fetches) unpickle
    objects of this package, so executors must be able to import it.
    Spark's own file distribution (``addPyFile``) carries the archive.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, archive = tempfile.mkstemp(prefix="strata-", suffix=".zip")
    os.close(fd)
    atexit.register(lambda: os.path.exists(archive) and os.unlink(archive))     # executors fetch it as long as the application lives
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def is_local_master(master: str) -> bool:
    """One JVM on one machine (``local``, ``local[N]``), not a cluster of any kind."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Only a ``local`` master may leave it unset; a temporary folder is made
    then.  On a cluster each executor would write such a folder on its own disk.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir()
    if not path:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            if not is_local_master(sc.master):
                raise RuntimeError("spark.checkpoint.dir is unset: name a folder that driver and executors share")
            path = tempfile.mkdtemp(prefix="strata-ckpt-")
        sc.setCheckpointDir(path)
        path = sc.getCheckpointDir() or path
    return path


#: Spark removes the shuffle files of a query when it ends, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _put_back(spark: SparkSession, setting: str, before: str | None) -> None:
    if before is None:
        spark.conf.unset(setting)
    else:
        spark.conf.set(setting, before)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """For runs of many written tables, whose shuffles nothing reads again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        _put_back(spark, CLEANUP, before)


#: Bytes of stored documents that a task reads, of dealt rows that it is given, and of input for each shuffle partition.
SCAN_BYTES, DEALT_BYTES, PARTITION_BYTES = 32 << 20, 16 << 20, 8 << 20
#: Dealt tasks a core, at least, where there is as much to deal: about one a core leaves most cores idle in a second wave.
TASKS_PER_CORE = 3


@contextmanager
def small_tasks(spark: SparkSession, volume: int = 0) -> Iterator[None]:
    """For runs over JSON documents, which shrink tenfold and more on disk: tasks read and are dealt
    so little that their sorts stay in memory.  There are at least as many shuffle
    partitions as ``volume``, the bytes of the input, asks for; no setting is made coarser than it is.
    Rows that come sorted are grouped as they come."""
    size = lambda c: int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(c)))
    scan, dealt, parts = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions"
    least, grouped = "spark.sql.adaptive.coalescePartitions.minPartitionNum", "spark.sql.execution.replaceHashWithSortAgg"
    held = {c: spark.conf.get(c, None) for c in (scan, dealt, parts, least, grouped)}
    spark.conf.set(scan, f"{min(size(scan), SCAN_BYTES)}b")
    spark.conf.set(dealt, f"{min(size(dealt), DEALT_BYTES)}b")
    spark.conf.set(parts, str(max(int(spark.conf.get(parts)), -(-volume // PARTITION_BYTES))))
    spark.conf.set(least, str(max(int(held[least] or 1), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)))
    spark.conf.set(grouped, "true")
    try:
        yield
    finally:
        for c, v in held.items():
            _put_back(spark, c, v)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder for one run's written tables."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/strata-scratch/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def is_local(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def ensure_local_dir(path: str) -> None:
    if is_local(path):
        os.makedirs(local_path(path), exist_ok=True)

"""SparkSession helpers: a local session for tests/bench and the checkpoint
folder that jobs use to cut lineage.

On a cluster the shared folder comes from ``spark.checkpoint.dir``; a
private folder under the system temp dir is only created when that setting
is absent (local tests).
"""

from __future__ import annotations

import os
import tempfile
import threading
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

_LOCK = threading.Lock()

# Settings that matter for the plans in this package.  AQE re-plans joins
# from measured sizes (broadcast only when the runtime size is small),
# splits skewed join partitions and coalesces tiny shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.bucketing.enabled": "true",
    # remove reliable-checkpoint files once their DataFrames are unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    """Local session used by tests and ``bench.py``."""
    b = (SparkSession.builder.master(f"local[{cores}]")
         .appName("starbi")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has none
        return None


def application_id(spark: SparkSession) -> str:
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", "starbi-app")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Reads the directory already set on the SparkContext or
    ``spark.checkpoint.dir``.  Only a local-mode session without either
    (tests) gets a private temporary folder; on a cluster a machine-local
    folder would be wrong, so a missing setting is an error there.
    """
    with _LOCK:
        sc = _context(spark)
        d = sc.getCheckpointDir() if sc is not None else None
        if d:
            return d
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if not conf:
            master = sc.master if sc is not None else spark.conf.get("spark.master", "")
            if str(master) != "local" and not str(master).startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
            conf = tempfile.mkdtemp(prefix="starbi-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(conf)
            return sc.getCheckpointDir() or conf
        return conf


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Let the application's JVM remove ``path`` when it ends."""
    sc = _context(spark)
    if sc is not None:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(p)


def workers_see_package(spark: SparkSession) -> None:
    """Python workers import this package from where the driver has it (on a
    cluster it is installed or passed with ``--py-files`` as usual)."""
    sc = _context(spark)
    if sc is not None:
        root = str(Path(__file__).resolve().parents[1])
        have = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in have:
            sc.environment["PYTHONPATH"] = os.pathsep.join([root, *have])


@contextmanager
def freeing_shuffles(spark: SparkSession):
    """Writes begun here remove their shuffle files as soon as they end.  Otherwise those
    of all jobs stay on disk until the driver's garbage collector meets their plans."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def describe_jobs(spark: SparkSession, text: str | None) -> None:
    """Label the jobs this thread submits (shown in event logs)."""
    sc = _context(spark)
    if sc is not None:
        sc.setJobDescription(text)

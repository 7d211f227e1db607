"""Session helpers: the settings the engine relies on, and the shared work root."""

from __future__ import annotations

import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ENGINE_CONF = {
    # Every expression assumes UTC when a zoned timestamp appears at all.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "carespark") -> SparkSession:
    """A local session for tests and the bench; clusters pass their own config."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        # Tests and the bench have no cluster-provided shared folder; a fresh
        # scratch folder stands in for it.
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="carespark-ckpt-"))
    )
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates and versioned tables.

    This is the folder named by ``spark.checkpoint.dir`` (shared storage on a
    cluster), as the URI it is given as.  Only a local session may go without:
    a fresh scratch folder is then registered as the checkpoint dir.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="carespark-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


#: Spark's own switch to free a query's shuffle files once it has ended.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FREEING: dict[str, list] = {}  # by session: blocks that are open, and the setting from before the first
_LOCK = threading.Lock()


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of tables written inside the block go with each write: nothing reads them once a table is there.

    Blocks may nest, and may run at once in several threads of a session.
    """
    me = session_id(spark)
    with _LOCK:
        opened = _FREEING.setdefault(me, [0, None])
        if opened[0] == 0:
            opened[1] = spark.conf.get(_FREE_SHUFFLES, "false")
            spark.conf.set(_FREE_SHUFFLES, "true")
        opened[0] += 1
    try:
        yield
    finally:
        with _LOCK:
            opened[0] -= 1
            if opened[0] == 0:
                spark.conf.set(_FREE_SHUFFLES, opened[1])


def _context(spark: SparkSession):
    """The SparkContext, or None on a session that has no local context (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions raise a connect-specific error
        return None


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.default.parallelism", "200"))


def session_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", str(id(spark)))

"""Session helpers: a local session for tests/bench and lineage cutting.

Lineage is cut by writing a table into the shared folder named by
``spark.checkpoint.dir``. On a cluster that setting must be present; a
private temporary folder is created only for local masters (tests, bench).
"""

from __future__ import annotations

import contextvars
import functools
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "casebook") -> SparkSession:
    """Session for tests and the benchmark: local master, AQE on, UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CASEBOOK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def spark_context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for lineage cuts.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset
    and the master is local (tests, bench) a private folder is made."""
    sc = spark_context(spark)
    if sc is not None:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        configured = sc.getConf().get("spark.checkpoint.dir", None)
        master = sc.master
    else:
        configured, master = None, spark.conf.get("spark.master", "local")
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="casebook-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder
    and read it back: the lineage ends there, and the planner sees the real
    size of the data. (A ``checkpoint()`` keeps the estimated statistics of
    the plan it came from; in iterative joins those estimates multiply round
    after round until planning itself stalls.)"""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/casebook-{uuid.uuid4().hex}"
    owner = _OWNER.get()
    if owner is not None:
        owner.tables.append(path)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


# Performance-only setting: lets AQE coalesce the shuffle output of cached
# plans. Without it every frame read from a cache keeps all
# spark.sql.shuffle.partitions partitions (200 by default), which made the
# iterative operators several times slower in a default session.
CACHED_COALESCE = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"


def reuse(df: DataFrame) -> DataFrame:
    """Cache a frame that is read several times within one step (not carried
    across iterations, so its lineage stays short); it is computed once and
    recomputed from that short lineage if an executor is lost."""
    from pyspark import StorageLevel
    spark = df.sparkSession
    if str(spark.conf.get(CACHED_COALESCE, "false")).lower() != "true":
        spark.conf.set(CACHED_COALESCE, "true")
    owner = _OWNER.get()
    if owner is not None:
        owner.frames.append(df)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


class _Owner:
    """What one call of an operator has written and cached."""

    def __init__(self):
        self.tables: list[str] = []
        self.frames: list[DataFrame] = []

    def release(self, spark: SparkSession) -> None:
        for frame in self.frames:
            frame.unpersist()
        sc = spark_context(spark)
        if sc is None:  # Spark Connect reaches no file system: the tables stay
            return
        for table in self.tables:
            path = sc._jvm.org.apache.hadoop.fs.Path(table)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


_OWNER: contextvars.ContextVar[_Owner | None] = contextvars.ContextVar("casebook_owner", default=None)


def settled(operator):
    """Decorator of operators that iterate: the result (a frame or several) is
    written as a table, and all other tables and caches made on the way are
    deleted, also when the operator fails. The result's table belongs to the
    caller, or to the settled operator that called this one."""
    @functools.wraps(operator)
    def run(df: DataFrame, *args, **kwargs):
        owner = _Owner()
        token = _OWNER.set(owner)
        try:
            out = operator(df, *args, **kwargs)
            outer = token.old_value if token.old_value is not contextvars.Token.MISSING else None
            _OWNER.set(outer)
            return tuple(cut_lineage(o) for o in out) if isinstance(out, tuple) else cut_lineage(out)
        finally:
            _OWNER.reset(token)
            owner.release(df.sparkSession)
    return run


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``casebook`` importable in Python workers (the functions run by
    ``mapInPandas`` refer to it): zip the package once and add it with
    ``addPyFile``, as one ships a library to a cluster. Without a
    SparkContext (Spark Connect) the package is pickled by value instead."""
    import shutil

    import casebook

    sc = spark_context(spark)
    if sc is None:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(casebook)
        return
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(casebook.__file__))
    out = tempfile.mkdtemp(prefix="casebook-pkg-")
    archive = shutil.make_archive(os.path.join(out, "casebook"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="casebook")
    sc.addPyFile(archive)
    _SHIPPED.add(key)

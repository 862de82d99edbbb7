"""Session defaults and the shared working folder."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import functools
import os
import shutil
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def build_session(app: str = "rareclass", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on; the cluster's own settings win where set."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        # Larger generated methods are not compiled by the JVM; wide tables reach that size.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        # Call-site capture costs more than building a wide plan does.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _scratch() -> str:
    root = tempfile.mkdtemp(prefix="rareclass-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local session without that setting
    (tests) gets a temporary folder of this machine, which goes when the process ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("Set spark.checkpoint.dir to a folder shared by all executors.")
        root = _scratch()
    path = os.path.join(root, f"{name}-{uuid.uuid4().hex}")
    for made in _scopes.get():
        made.append(path)
    return path


_scopes: contextvars.ContextVar[tuple[list, ...]] = contextvars.ContextVar("scratch", default=())


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete folders, wherever they are; what is not there is no error."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def scratch(spark: SparkSession, keep: tuple[str, ...] = ()):
    """Inside, work is done to its end: shared folders that this thread makes here go afterwards, but for ``keep``.

    After an error they go as well, so that a run that is made again finds room.
    """
    made: list[str] = []
    token = _scopes.set((*_scopes.get(), made))
    try:
        yield
    finally:
        _scopes.reset(token)
        discard(spark, *[p for p in made if p not in keep])


def materialize(df, name: str):
    """Write ``df`` once to the shared folder and read it back, which cuts its lineage.

    The folder stays as long as a result may read it: ``scratch`` bounds that where the work
    is known to be done.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def parallel(spark: SparkSession, n_jobs: int, jobs: list) -> list:
    """Run independent driver-side jobs; each is a series of distributed Spark jobs.

    What they write to shared folders belongs to the ``scratch`` of the caller.
    """
    with ThreadPoolExecutor(max_workers=n_jobs) as pool:
        return [f.result() for f in [pool.submit(contextvars.copy_context().run, inheritable_thread_target(spark)(j)) for j in jobs]]


def spread(df):
    """Use all cores on a small input: repartition only if it has fewer splits than cores.

    A large table has more splits than cores and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

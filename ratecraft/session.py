"""Session defaults and staging of intermediate results.

Staging writes a DataFrame as Parquet below the shared folder the cluster names
in ``spark.checkpoint.dir`` and reads it back.  That cuts lineage (long split and
fit cascades would otherwise re-plan every earlier step), survives executor loss
(files live on shared storage, not in executor memory) and gives later scans
column pruning and filter pushdown.
"""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

_STAGE_SUBDIR = "ratecraft-stage"


def get_spark(master: str | None = None, app: str = "ratecraft",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings the library is tuned for.

    Existing sessions are reused as they are; settings below only apply to a
    fresh local session (tests, bench).  On a cluster, pass the cluster's own
    configuration instead.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (SparkSession.builder
               .master(master or f"local[{cpus}]")
               .appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    Read from the session (``spark.checkpoint.dir`` or the context's directory).
    Only a local session without either gets a scratch folder; elsewhere a
    machine-local folder would lose rows, so that is an error.
    """
    sc = spark.sparkContext
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return _parent_of_context_dir(current, conf_dir)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    scratch = tempfile.mkdtemp(prefix="ratecraft-ckpt-")
    sc.setCheckpointDir(scratch)
    spark.conf.set("spark.checkpoint.dir", scratch)
    return scratch


def _parent_of_context_dir(context_dir: str, conf_dir: str | None) -> str:
    # SparkContext appends a per-application uuid folder to the configured dir.
    if conf_dir:
        return conf_dir
    return context_dir.rstrip("/").rsplit("/", 1)[0]


def _stage_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/{_STAGE_SUBDIR}/{spark.sparkContext.applicationId}"


def staged_path(spark: SparkSession, name: str) -> str:
    """A new path for a staged result of this application."""
    return f"{_stage_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back."""
    path = staged_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def stage_by(df: DataFrame, name: str, key: str) -> tuple[DataFrame, str]:
    """As ``stage``, in folders of the values of ``key``: a filter on it reads only theirs.  With the path."""
    path = staged_path(df.sparkSession, name)
    df.write.partitionBy(key).parquet(path)
    return df.sparkSession.read.parquet(path), path


#: Whether the shuffle files of a query go when it ends.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: For each session, the threads inside ``freed_shuffles`` and the setting that the first one found.
_freeing: dict[int, tuple[int, str | None]] = {}
_freeing_lock = threading.Lock()


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Queries inside delete their shuffle files when they end, instead of when the driver's
    garbage is collected: for loops of large jobs that each write their result.  The setting
    is the session's: it holds until the last of the threads inside leaves."""
    with _freeing_lock:
        inside, before = _freeing.get(id(spark)) or (0, spark.conf.get(_FREE_SHUFFLES, None))
        spark.conf.set(_FREE_SHUFFLES, "true")
        _freeing[id(spark)] = inside + 1, before
    try:
        yield
    finally:
        with _freeing_lock:
            inside, before = _freeing.pop(id(spark))
            if inside > 1:
                _freeing[id(spark)] = inside - 1, before
            elif before is None:
                spark.conf.unset(_FREE_SHUFFLES)
            else:
                spark.conf.set(_FREE_SHUFFLES, before)


def side_by_side(spark: SparkSession, *parts: Callable[[], DataFrame]) -> list[DataFrame]:
    """The results of parts that need nothing of each other.  Their jobs run beside each other,
    so that cores that one part leaves idle (few tasks, the end of a stage) go to another."""
    with ThreadPoolExecutor(len(parts)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(part)) for part in parts]]


def drop_stage(staged: DataFrame) -> None:
    """Delete the files of a staged result that nothing reads any more."""
    spark = staged.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in staged.inputFiles()}:
        if f"/{_STAGE_SUBDIR}/{spark.sparkContext.applicationId}/" in folder:
            path, files = _path(spark, folder)
            files.delete(path, True)


def stage_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """As ``stage``, dealt into ``buckets`` files by a hash of ``key``: aggregates and
    joins on the key read them without another shuffle.  The files lie in the
    staging folder; their table's entry in the catalog goes at once, as the frame
    that is returned knows its files and buckets."""
    spark = df.sparkSession
    table = f"ratecraft_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", staged_path(spark, name)).saveAsTable(table))
    out = spark.table(table)
    out.schema  # analysed while the catalog has the table
    spark.sql(f"DROP TABLE {table}")
    return out


def _path(spark: SparkSession, folder: str):
    """A folder and its file system, as the cluster's own file layer names them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_staged(spark: SparkSession) -> None:
    """Delete every staged result of this application; frames read from them end here."""
    path, files = _path(spark, _stage_folder(spark))
    files.delete(path, True)


def input_version(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of the files in ``folder`` and in its tables: a listing, no job."""
    path, files = _path(spark, folder)
    out = []
    for f in files.listStatus(path):
        parts = files.listStatus(f.getPath()) if f.isDirectory() else [f]
        out += [(f.getPath().getName(), x.getPath().getName(), x.getLen(), x.getModificationTime()) for x in parts]
    return tuple(sorted(out))

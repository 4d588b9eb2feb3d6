"""Cutting lineage in storage that outlives an executor."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}  # a local application's own folder, by application id
_KEPT: dict[str, list[str]] = {}  # what materialise() wrote, by application id


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; no setting is changed.

    Only a local session may do without: it gets one temporary folder per application, removed
    when the program ends. On a cluster a missing setting is an error, as a machine-local folder
    would be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="tillcast-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return _LOCAL[app]


def new_folder(spark: SparkSession) -> str:
    """A fresh path in the shared folder, which ``release`` deletes."""
    path = f"{shared_folder(spark)}/tillcast-{uuid.uuid4().hex}"
    _KEPT.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialise(df: DataFrame) -> DataFrame:
    """Write a result to the shared folder and read it back, so that later steps neither
    compute it again nor depend on the executors that made it. Parquet keeps column pruning."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    kept = df.sparkSession.read.parquet(path)
    kept._kept_path = path
    return kept


def is_kept(df: DataFrame) -> bool:
    """Whether this very frame reads a table that ``materialise`` wrote."""
    return getattr(df, "_kept_path", None) is not None


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that have ended: it does so once the driver has collected its garbage, which by
    itself may be much later than the next step needs the disk."""
    spark.sparkContext._jvm.System.gc()


def discard(*frames: DataFrame) -> None:
    """Delete what ``materialise`` wrote for these very frames, once all that read them is written itself."""
    for frame in frames:
        spark = frame.sparkSession
        path = getattr(frame, "_kept_path", None)
        kept = _KEPT.get(spark.sparkContext.applicationId, [])
        if path in kept:
            kept.remove(path)
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> int:
    """Delete everything this application has kept so far; to be called when the frames
    that read it are no longer used. Returns the number of folders."""
    paths = _KEPT.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)

"""Tables written to the folder that driver and executors share, to cut lineage between the steps of a job."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of light columns up to which a side of a join may be broadcast; their number is measured first.
BROADCAST_ROWS = 200_000
_own: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder of this application under ``spark.checkpoint.dir``.

    Where the session names none, a folder of our own that ends with the process, which only a local master can use;
    on a cluster an error is raised, since executors would each write to their own disk.
    """
    context = spark.sparkContext
    root, app = context.getConf().get("spark.checkpoint.dir", None), context.applicationId
    if root:
        return f"{root.rstrip('/')}/kasane-{app}"
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if app not in _own:
        folder = tempfile.mkdtemp(prefix="kasane-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _own[app] = f"file://{folder}"
        context.setCheckpointDir(_own[app])
    return _own[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared folder and read it back: later steps survive a lost executor without recomputing it."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(*staged: DataFrame) -> None:
    """Delete the files of staged tables that nothing reads any more: all that was made of them has been staged itself."""
    for df in staged:
        _delete(df.sparkSession, df.staged_path)


def clear(spark: SparkSession) -> None:
    """Delete all that this application has staged; results that read it must have been written before."""
    _delete(spark, shared_root(spark))


def sized(staged: DataFrame, most: int = BROADCAST_ROWS, weight: str = "1") -> DataFrame:
    """A staged side of a join, to be broadcast if its rows (each of ``weight``) add up to ``most`` or less, else joined by a shuffle."""
    total = staged.agg(F.sum(F.expr(weight))).first()[0] or 0
    return F.broadcast(staged) if total <= most else staged

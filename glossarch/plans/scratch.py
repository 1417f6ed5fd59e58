"""Tables written on the way, in the folder all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_fallback: list[str] = []
#: folders of the tables written so far that are not deleted
_tables: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session or the folder set as checkpoint folder of its context. Where neither is set, a local folder is made for
    a local master, which goes with the process; with any other master that is an error, as executors would write to their own disks."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    given = spark.sparkContext._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return given.get().rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _fallback:
        _fallback.append(tempfile.mkdtemp(prefix="glossarch-"))
        atexit.register(shutil.rmtree, _fallback[0], ignore_errors=True)
    return "file://" + _fallback[0]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet and read it back.

    Cuts the lineage (a lost executor costs no recomputation of what came before), keeps column pruning
    and filter pushdown for the readers, and gives every later use the same rows.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _tables.append(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> int:
    """Deletes all tables written so far, once the results that read them are used; their number."""
    done, _tables[:] = list(_tables), []
    for path in done:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return len(done)

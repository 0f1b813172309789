"""Tables that cut a lineage, in a folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: folders made for each application, for ``sweep``
_made: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, else below the warehouse on a cluster, else (local master only,
    as in tests) a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        local = master.startswith("local") and "cluster" not in master
        base = tempfile.mkdtemp(prefix="tessellar-") if local else spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/tessellar-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def sweep(spark: SparkSession) -> int:
    """Deletes the folders that this application's tables were written to, once nothing reads them any more, and returns the bytes that
    they held."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    freed = 0
    for path in _made.pop(spark.sparkContext.applicationId, []):
        at = hadoop.Path(path)
        fs = at.getFileSystem(conf)
        if fs.exists(at):
            freed += fs.getContentSummary(at).getLength()
            fs.delete(at, True)
    return freed


def materialize(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: its lineage ends there, and a lost
    executor costs nothing that was written."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

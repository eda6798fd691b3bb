"""Written tables that cut a plan where it must be evaluated once only."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame


def durable(df: DataFrame) -> DataFrame:
    """df written as Parquet in the folder of spark.checkpoint.dir, and read again.

    Only in local mode, where driver and executors are one process, may the session leave the folder unset."""
    spark = df.sparkSession
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = f"file://{tempfile.gettempdir()}/docketmill-shared"
    own = f"{folder.rstrip('/')}/docketmill-{spark.sparkContext.applicationId}"
    if own not in _folders:
        _folders.add(own)
        atexit.register(_remove, spark, own)
    path = f"{own}/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_folders: set[str] = set()


def _remove(spark, path: str) -> None:
    """Delete this application's tables when the driver's Python ends, if the session can still do it."""
    try:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    except Exception:  # noqa: BLE001  the session has ended: the files stay
        return

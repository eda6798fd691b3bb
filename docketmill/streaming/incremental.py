"""Incremental extraction: a file stream that processes what is new and keeps the cache table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import cache_key, case_number_of_file
from ..operators.dedup import last_wins


def new_files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """A stream of path, content, modificationTime."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).load(folder)


def run_incremental(spark: SparkSession, folder: str, state: str, version: str, process: Callable[[DataFrame], DataFrame], pattern: str = "*.pdf") -> None:
    """Process all files that came since the last run, in batches, then stop.

    process gets numero, path, content, cache_key and returns a row for each numero. Each batch's results and
    cache rows are written under the batch's number: a batch that runs again replaces its own files.
    """

    def batch(df: DataFrame, epoch: int) -> None:
        rows = df.select(case_number_of_file(F.col("path")).alias("numero"), "path", "content", "modificationTime", cache_key(F.col("content"), version).alias("cache_key"))
        known = read_state(spark, state, "cache")
        if known is not None:
            rows = rows.join(known.select("numero", F.col("cache_key").alias("_old")), "numero", "left").filter(~F.col("cache_key").eqNullSafe(F.col("_old"))).drop("_old")
        process(rows).write.mode("overwrite").parquet(f"{state}/results/batch={epoch}")
        rows.select("numero", "cache_key", "modificationTime").write.mode("overwrite").parquet(f"{state}/cache/batch={epoch}")

    query = new_files(spark, folder, pattern).writeStream.foreachBatch(batch).option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def read_state(spark: SparkSession, state: str, name: str) -> DataFrame | None:
    """The latest row of each numero in `cache` or `results`; None before the first batch."""
    from ..sources.tables import exists

    if not exists(spark, f"{state}/{name}/batch=*"):
        return None
    rows = spark.read.option("basePath", f"{state}/{name}").parquet(f"{state}/{name}")
    order = ["batch", "modificationTime"] if "modificationTime" in rows.columns else ["batch"]
    return last_wins(rows, ["numero"], order).drop("batch")

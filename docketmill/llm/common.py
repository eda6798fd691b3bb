"""Helpers shared by the corpus operators: reading tables, durable cuts of lineage, Arrow mapping."""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes that one Arrow batch may hold.
BATCH_ROWS, BATCH_BYTES = 2048, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Bound the Arrow batches of the session, as texts may be long; tighter bounds that it has stay.

    The queries and stages call this, the operators do not: they take batches of any size."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{key}"
        given = str(spark.conf.get(key)).rstrip("bB")
        if not given.isdigit() or not 0 < int(given) <= most:
            spark.conf.set(key, str(most))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    Only in local mode, where they are one process, may the session leave it unset."""
    given = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"file://{tempfile.gettempdir()}/docketmill-shared"


def own_dir(spark: SparkSession) -> str:
    """This application's folder in the shared one; it goes when the driver's Python ends."""
    path = f"{shared_dir(spark)}/docketmill-{spark.sparkContext.applicationId}"
    if path not in _folders:
        _folders.add(path)
        atexit.register(remove, spark, path)
    return path


_folders: set[str] = set()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if the session can still do it."""
    try:
        jvm = spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    except Exception:  # noqa: BLE001  the session has ended, or the store refuses: the files stay
        return


class Durable(NamedTuple):
    """A written table and where it is."""

    df: DataFrame
    path: str

    def drop(self) -> None:
        """Delete the table, once all that is made of it has been written."""
        remove(self.df.sparkSession, self.path)


def written(df: DataFrame) -> Durable:
    """Write df as Parquet in the shared folder and read it again.

    Cuts the lineage with replicated files rather than executor-held blocks, so a lost executor costs
    no recomputation and the plan is evaluated once.
    """
    spark = df.sparkSession
    path = f"{own_dir(spark)}/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return Durable(spark.read.schema(df.schema).parquet(path), path)


def durable(df: DataFrame) -> DataFrame:
    """A written table that stays until the application ends."""
    return written(df).df


#: How each module's tables, which a worker keeps from task to task, are emptied; whose task began last in it.
_tables: dict[str, Callable[[], object]] = {}
_last: list[str] = [""]


def keeps(owner: str, clear: Callable[[], object]) -> None:
    """Register how the tables that owner keeps in a worker are emptied."""
    _tables[owner] = clear


def begin(owner: str) -> None:
    """Free the tables that others have left in this worker; for the start of a task of owner.

    Spark hands a worker to the next stage as it is: tables that nothing will ask again would add up there."""
    if _last[0] == owner:
        return
    _last[0] = owner
    for other, clear in _tables.items():
        if other != owner:
            clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:  # what glibc holds of freed memory
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply fn to every Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from fn(batch)

    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions_for(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_of(df: DataFrame, text: str = "text") -> Column:
    """The text with null as empty."""
    return F.coalesce(df[text], F.lit(""))


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Cut a stream that is sorted by keys into tables that hold whole groups.

    Each table holds as many whole groups as the batches at hand; the last, possibly unfinished group
    of a batch waits for the next one. Memory is bounded by a batch plus the largest single group.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[batch.num_rows - 1] for k in keys]
        cut = batch.num_rows
        while cut and all(batch.column(k)[cut - 1] == v for k, v in zip(keys, last)):
            cut -= 1
        if cut or (held and any(held[-1].column(k)[held[-1].num_rows - 1] != batch.column(k)[0] for k in keys)):
            head = [*held, batch.slice(0, cut)] if cut else held
            yield pa.Table.from_batches(head)
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)

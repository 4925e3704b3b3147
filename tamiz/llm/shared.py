"""Storage, table and splitting helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows that Spark hands to Python at once: texts of several kilobytes make batches of a few megabytes, on both sides.
ROWS_PER_BATCH = 1000
#: Whether the shuffle files of a query are deleted when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def bounded(spark: SparkSession) -> None:
    """Bounds the Arrow batches of the session, whose default suits narrow rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder, read in a session with bounded batches."""
    bounded(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only where it is unset on one machine, as in tests, a temporary folder is made and set; a cluster without one is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        made = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = made.get() if made.isDefined() else None
    if not path and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not path:
        path = "file://" + tempfile.mkdtemp(prefix="tamiz-shared-")
        spark.sparkContext.setCheckpointDir(path)
    return path


def materialise(df: DataFrame, name: str, drop_shuffles: bool = False) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: cuts the lineage, and an
    executor that is lost later costs no recomputation of what stands before. With ``drop_shuffles``
    the shuffle files of the write go as soon as it has ended, and do not wait for Spark's cleaner."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tamiz-{name}-{uuid.uuid4().hex}"
    with _set(spark, SHUFFLE_CLEANUP, "true") if drop_shuffles else nullcontext():
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._table_path = path
    for made in _open:
        made.tables.append(out)
    return out


@contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session while it is open."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


class Scratch:
    """The tables that were written while it was open."""

    def __init__(self) -> None:
        self.tables: list[DataFrame] = []

    def sweep(self, *kept: DataFrame) -> None:
        """Deletes them but for ``kept``, once nothing else reads them; those that are gone already say nothing."""
        keep = {x._table_path for x in kept}
        gone = [x for x in self.tables if x._table_path not in keep]
        self.tables = [x for x in self.tables if x._table_path in keep]
        if gone:
            discard(*gone)


_open: list[Scratch] = []


@contextmanager
def scratch() -> Iterator[Scratch]:
    """Records the tables that ``materialise`` writes inside it."""
    made = Scratch()
    _open.append(made)
    try:
        yield made
    finally:
        _open.remove(made)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``materialise`` wrote and that nothing will read again, and releases shuffle files."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._table_path)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    release(tables[0].sparkSession)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files that no plan refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


def held_out(doc_id: Column | str) -> Column:
    """Rows that no label may be learned from: crc32(doc_id as text) mod 4 is 2."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def slices(batch: pa.RecordBatch, column: int, max_bytes: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with at most ``max_bytes`` of text each (a longer text is a
    part of its own), so that the kernels' memory does not grow with the number of rows."""
    n = batch.num_rows
    if n == 0:
        return
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    yield batch.slice(start, n - start)


def row_count_at_most(df: DataFrame, bound: int) -> bool:
    """Whether ``df`` has at most ``bound`` rows: the check before a broadcast."""
    return df.limit(bound + 1).count() <= bound


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of float64 vectors by id, streamed: (id, values)."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = np.frombuffer(x, np.float64)
            total[i] = total[i] + part if i in total else part
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["id", "values"])


def vector_sums(rows: DataFrame) -> dict[int, np.ndarray]:
    """The sum of the vectors (id int, values binary of float64) of each id: first in several tasks, then in one for each id.
    A few vectors of fixed size come to the driver."""
    once = rows.repartition(8, "id", F.spark_partition_id() % 8).mapInArrow(_add, "id int, values binary")
    return {i: np.frombuffer(x, np.float64) for i, x in once.repartition(4, "id").mapInArrow(_add, "id int, values binary").collect()}

"""What the corpus operators share: scratch tables, Arrow buffers and hashes of byte ranges."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows of an Arrow batch, and bytes after which it ends before; texts may be long, so it is well under Spark's default.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
#: Bytes of text that a kernel treats at once (a longer text is treated alone).
SLAB_BYTES = 4 << 20
#: Odd multiplier of the polynomial hashes modulo 2^64, and a finaliser.
P = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a local one only where none is set and the master is local, as in tests."""
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which goes when the application ends."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts lineage, and survives the loss of executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def released(df: DataFrame) -> None:
    """Deletes a saved table that nothing will read any more, so that the steps of a loop do not pile up."""
    spark = df.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.scratch)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def prepared(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def map_arrow(df: DataFrame, kernel: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """The kernel's rows. A worker outlives its task, so that what the task has freed is given back at its end."""
    prepared(df.sparkSession)

    def run(it):
        yield from kernel(it)
        memory_returned()

    return df.mapInArrow(run, schema)


def worker_cache() -> dict:
    """What a Python worker keeps from task to task."""
    name = "_corpus_worker_cache"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
        sys.modules[name].kept = {}
    return sys.modules[name].kept


def memory_returned() -> None:
    """Gives what this process has freed back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def byte_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column one after another, and the n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.binary()) if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type) else column
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, ends, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def slabs(offsets: np.ndarray, most: int = SLAB_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most `most` bytes together, or of one text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i modulo 2^64 for i up to n, kept by the worker up to a slab's size."""
    cache = worker_cache()
    if "powers" not in cache or len(cache["powers"][0]) <= n:
        size = max(n + 1, min(SLAB_BYTES + 1, 2 * n))
        inverse = np.uint64(pow(int(P), -1, 1 << 64))
        up, down = np.full(size, P), np.full(size, inverse)
        up[0] = down[0] = 1
        made = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size > SLAB_BYTES + 1:
            return made
        cache["powers"] = made
    return cache["powers"]


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """H and D so that (H[e] - H[s]) * D[s] is the polynomial hash of data[s:e]."""
    up, down = powers(len(data))
    h = np.empty(len(data) + 1, np.uint64)
    h[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=h[1:])
    return h, down


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MIX
    h = (h ^ (h >> np.uint64(29))) * P
    return h ^ (h >> np.uint64(32))


def batches(schema: pa.Schema, rows: int, columns: dict) -> Iterator[pa.RecordBatch]:
    """columns (arrays of equal length) as record batches of at most `rows` rows."""
    arrays = [x if isinstance(x := columns[f.name], (pa.Array, pa.ChunkedArray)) else pa.array(x, f.type) for f in schema]
    table = pa.table([a.cast(f.type) if a.type != f.type else a for a, f in zip(arrays, schema, strict=True)], schema=schema)
    yield from table.to_batches(max_chunksize=rows)

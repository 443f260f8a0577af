"""Shared helpers: table access, written intermediates and text rules."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Words are runs of characters other than space and U+0009..U+000D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_MASK = (1 << 64) - 1

#: Bytes, about, of a batch that goes to a Python worker, see :func:`small_batches`.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a folder of our own only in local mode, where none is configured."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        found = "file://" + tempfile.mkdtemp(prefix="quillon-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage and survives lost executors, since every machine sees the files.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quillon-{label}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Remove the files behind a table made by :func:`written` that is no longer needed."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for d in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/quillon-" in d:
            path = jvm.org.apache.hadoop.fs.Path(d)
            path.getFileSystem(conf).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """From now on the session sends rows to Python workers in batches of some ``BATCH_BYTES``, not of 10,000 rows.

    A batch of texts has several copies outside the heap, in the executor and in the worker, and neither
    gives all of that memory back.  Lower limits stay.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def drop_shuffles(spark: SparkSession) -> None:
    """From now on shuffle files go when their job ends, not when the driver happens to collect its garbage.

    Each step's rows are written, so none is needed again.
    """
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of the driver's.

    It goes to the JVM by Arrow.  Plain rows would go through Python workers of another kind, which every executor
    would keep beside those of the operators.
    """
    kind = StructType.fromDDL(schema)
    fields = to_arrow_schema(kind)
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields), kind)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan; for file scans the size of the files."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def small_or_plain(df: DataFrame, row_bytes: int, limit_bytes: int = 16 << 20) -> DataFrame:
    """Mark a *written* table for broadcast if its counted size is below the limit.

    Beyond the limit the table is returned as it is and the join shuffles.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit_bytes else df


def salted_left_join(big: DataFrame, small: DataFrame, on: list[str], row_bytes: int, salts: int = 32, limit_bytes: int = 16 << 20) -> DataFrame:
    """``big`` left-joined with a *written* table of unique keys.

    Below the limit the table is broadcast.  Beyond it, its rows are sent ``salts`` times, so that the
    rows of a hot key of ``big`` spread over that many tasks.
    """
    if small.count() * row_bytes <= limit_bytes:
        return big.join(F.broadcast(small), on, "left")
    salt = free_name([*big.columns, *small.columns], "salt")
    copies = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big.withColumn(salt, (F.monotonically_increasing_id() % salts).cast("int")).join(copies, [*on, salt], "left").drop(salt)


def free_name(taken: Iterable[str], wish: str) -> str:
    """``wish``, with underscores behind it until no taken name equals it (case set aside)."""
    low = {t.lower() for t in taken}
    while wish.lower() in low:
        wish += "_"
    return wish


def tidy(batches: Iterator, *caches: dict) -> Iterator:
    """Pass on what a task gives; at its end empty the caches and return memory to the system.

    Python workers outlive a task, so what stays allocated would be missing in the stages behind it.
    """
    import ctypes

    try:
        yield from batches
    finally:
        for c in caches:
            c.clear()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser on an array of uint64."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """Word (bytes) to 64-bit hash; filled on first use and emptied when it grows too large.

    The limit keeps it at some 30 MB.
    """

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


#: Emptied at the end of each task, see :func:`tidy`.
_words = WordHashes()


def word_hashes(text: bytes | None) -> np.ndarray:
    """Hashes of the words of a text, A-Z lower-cased, in order."""
    words = (text or b"").lower().split()
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def shingles(text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles.

    With fewer than k words (but some) the whole sequence is the one shingle.
    """
    words = word_hashes(text)
    n = len(words)
    if not n:
        return words
    with np.errstate(over="ignore"):
        factor = mix(np.arange(1, max(k, 1) + 1, dtype=np.uint64)) | np.uint64(1)
        if n < k:
            value = (words * factor[:n]).sum(dtype=np.uint64) + np.uint64(n * 0x9E3779B97F4A7C15 & _MASK)
            return mix(np.array([value], dtype=np.uint64))
        total = words[: n - k + 1] * factor[0]
        for i in range(1, k):
            total = total + words[i : n - k + 1 + i] * factor[i]
        return np.unique(mix(total))


def as_bytes(column) -> list:
    """An Arrow string column as Python bytes, without decoding."""
    kind = column.type
    return column.cast(pa.large_binary() if pa.types.is_large_string(kind) else pa.binary()).to_pylist()


def slices(batches: Iterable, rows: int = 512, limit: int = 8 << 20) -> Iterator:
    """Cut Arrow batches so that one slice holds few rows and bytes (one row at least)."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            take = min(rows, batch.num_rows - at)
            while take > 1 and batch.slice(at, take).nbytes > limit:
                take //= 2
            yield batch.slice(at, take)
            at += take

"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; a temporary one only where that is unset (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = f"file://{tempfile.gettempdir()}/checkpoints"
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return path.rstrip("/")


_TABLES: dict[str, SparkSession] = {}  # tables this driver wrote and hasn't discarded


def cut(df: DataFrame, name: str, pool: list[str] | None = None) -> DataFrame:
    """Write df once to the shared folder and read it back: lineage ends there, and lost executors cost nothing above it.

    pool collects the paths of tables that their operator discards once nothing reads them."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _TABLES:
        atexit.register(_discard_all)
    _TABLES[path] = spark
    df.write.parquet(path)
    if pool is not None:
        pool.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(pool: list[str], keep: int = 0) -> None:
    """Delete the tables of pool, the last keep of them excepted."""
    for path in pool[: len(pool) - keep]:
        if spark := _TABLES.pop(path, None):
            hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    del pool[: len(pool) - keep]


def _discard_all() -> None:
    with contextlib.suppress(Exception):  # the session may have ended before the driver
        discard(list(_TABLES))


#: A key with more than this part of all rows is dealt over several partitions.
SPLIT = 256


def salted_join(big: DataFrame, small: DataFrame, key: str, n: str = "n") -> DataFrame:
    """big joined to small by key. small has a row or few per key, and n: about how many rows of big have it.

    Rows of a key that holds over a SPLIT-th of them are dealt over several partitions, and its rows of small repeated. At
    most SPLIT keys can be so common, which bounds the broadcast that says so."""
    total = small.agg(F.sum(n)).first()[0] or 1
    often = small.groupBy(key).agg(F.max(n).alias(n)).where(F.col(n) * SPLIT > total)
    hot = F.broadcast(often.select(key, F.ceil(F.col(n) * SPLIT / F.lit(total)).cast("int").alias("__salts")))
    salts = F.coalesce("__salts", F.lit(1))
    left = big.join(hot, key, "left").withColumn("__salt", F.pmod(F.xxhash64(*big.columns), salts).cast("int")).drop("__salts")
    right = small.join(hot, key, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("__salts")
    return left.hint("merge").join(right, [key, "__salt"]).drop("__salt")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(key: Column) -> Column:
    """True where crc32(key as text) mod 5 is 0; null keys are not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


#: Bytes of an Arrow batch, on either side: two tasks of an executor hold two of them each, in the JVM and in Python.
BATCH = 8 << 20


def arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow with batches of bounded bytes, in workers that give their memory back after each task.

    Idle workers live on beside the JVM's next stages, so what they keep counts against the executor."""
    spark = df.sparkSession
    size = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
    if spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(str(size)) > BATCH:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))  # read when the plan runs: it can't be put back here

    def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # glibc alone has it
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return df.mapInArrow(trimmed, schema)


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column as bytes, without decoding."""
    col = batch.column(batch.schema.get_field_index(name))
    return col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()


def pieces(batches: Iterator[pa.RecordBatch], name: str, most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Batches whose column holds at most about so many bytes (one row may be larger); no row is lost."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(name))
        if col.nbytes <= most:
            if batch.num_rows:
                yield batch
            continue
        start, size = 0, 0
        for i, n in enumerate(pc.binary_length(col).to_pylist()):
            if size and size + (n or 0) > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n or 0
        yield batch.slice(start)


#: Bytes that the word pattern of op5 leaves out, as spaces; A-Z in lower case. Bytes of other code points stay.
ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_alnum(text: bytes | None) -> list[bytes]:
    return text.translate(ALNUM).split() if text else []


def words_space(text: bytes | None) -> list[bytes]:
    """Runs of bytes other than space and \\x09-\\x0D, A-Z in lower case."""
    return text.lower().split() if text else []

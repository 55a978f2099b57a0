"""What the corpus operators share: projection to plain columns, lineage cuts, sized joins, Arrow maps."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of at most so many bytes (rows x a stated width) may be broadcast; a larger one is shuffled.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only (doc_id long, text string): whatever else the table holds can't clash with what an operator makes."""
    return df.select(df[key].cast("long").alias("doc_id"), df[text].cast("string").alias("text"))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The cluster's shared folder is in spark.checkpoint.dir; a folder of our own is for local tests, where it is unset."""
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="checkpoint-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)


def remove(spark: SparkSession, path: str) -> None:
    """A folder that was written here, of any file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def cut(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared checkpoint folder, so that lost executors don't repeat or change them."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sized(df: DataFrame, width: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (already cut, so counting is cheap), hinted for broadcast if its rows of ``width`` bytes are within ``limit``."""
    return F.broadcast(df) if df.count() * width <= limit else df


#: Words of 64 bits of a sieve: its rows are broadcast, and there are never more than these, however many ids.
SIEVE = 1 << 18


def sieve(ids: DataFrame) -> DataFrame:
    """(__word, __bits) of ids, a frame of one column: a bitmap by hash, which says of an id that it is surely not among them, or may be. As ids grow beyond 64 x SIEVE it says less, but never wrong."""
    spread = ids.select(F.xxhash64(F.col(ids.columns[0]).cast("long")).alias("h")).select(F.expr(f"pmod(h, {SIEVE})").alias("__word"), F.expr("shiftleft(1L, cast(pmod(shiftright(h, 20), 64) as int))").alias("__bit"))
    return cut(spread.groupBy("__word").agg(F.bit_or("__bit").alias("__bits")))


def sifted(df: DataFrame, key: str, words: DataFrame) -> DataFrame:
    """df with __may: whether its key may be among the ids of the sieve. No shuffle."""
    h = F.xxhash64(df[key].cast("long"))
    hashed = df.withColumn("__h", h)
    joined = hashed.join(F.broadcast(words), F.expr(f"pmod(__h, {SIEVE})") == F.col("__word"), "left")
    return joined.withColumn("__may", F.expr("coalesce(shiftright(__bits, cast(pmod(shiftright(__h, 20), 64) as int)) & 1L, 0L) = 1L")).drop("__h", "__word", "__bits")


#: Rows of an Arrow batch where the session says nothing about them: texts are long, and a batch is held by the JVM and by Python at once.
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Takes BATCH_ROWS for the session unless its user chose a number, whichever it is."""
    if not spark._jsparkSession.sessionState().conf().contains(_BATCH):
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def map_batches(df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if out is not None and out.num_rows:
                yield out
        pa.default_memory_pool().release_unused()

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)

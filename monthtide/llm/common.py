"""What the operators of this subpackage share: words, keys, checkpoints, bounded broadcasts, batches."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

#: The six characters that separate words: blank, and tab to carriage return.
SPACES = " \t\n\x0b\f\r"
_SPLIT = r"[\x20\x09-\x0D]+"

#: Stands for a null id where an order is needed: null ids come last.
LAST_ID = 2**63 - 1

#: Rows up to which a counted side is broadcast (at most some 100 MB of narrow rows).
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    """The words of a text in their order; none for null."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, _SPLIT))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is computed once per row, however often body has it inside of lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def byte_words(text: str | None) -> list[bytes]:
    """The same words as UTF-8 bytes (bytes.split knows just these six characters)."""
    return (text or "").encode("utf-8", "surrogatepass").split()


#: What keyed() tells documents apart by, in their order.
KEY = ["id", "tag", "tag2"]


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, id, tag, tag2): id is doc_id with null last, the tags, 128 bits, tell rows of one id but different texts apart.

    Where an id is found once the tags are zero and so take little room in a shuffle. If more ids than can be broadcast
    are found more often, all rows have tags. docs is read once more for that, by its doc_id only.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"))
    again = settled(rows.where(F.col("id") != LAST_ID).groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id", F.lit(True).alias("again")))
    if again.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        rows = rows.join(F.broadcast(again), "id", "left")
        told_apart = F.col("again") | (F.col("id") == LAST_ID)
    else:
        told_apart = F.lit(True)
    tags = {"tag": F.xxhash64("text"), "tag2": F.xxhash64(F.lit("tag2"), "text")}
    return rows.select("doc_id", "text", "id", *(F.when(told_apart, tag).otherwise(0).alias(name) for name, tag in tags.items()))


def settled(df: DataFrame) -> DataFrame:
    """df, computed once and cut from its lineage by files in the shared checkpoint folder."""
    prepare_checkpoints(df.sparkSession)
    return df.checkpoint()


def prepare_checkpoints(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a temporary one only in local mode where none is set."""
    context = spark.sparkContext
    if (folder := context.getCheckpointDir()) is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return folder


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if counting shows that it has at most so many rows; else unchanged, to be shuffled."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of df has, in any case of letters."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def most_frequent(counted: DataFrame, most: int, n: str = "n") -> list[Row]:
    """The rows of counted with the largest n, as many as have places among so many; equal ones all or none.

    The driver gets counts of counts, by powers of two and eighths of these, then those within one such step, and the
    rows themselves, never more than most. counted is read three times, so it should be settled.
    """
    step = F.floor(F.log2(F.col(n)) * 8)
    room, least = most, None
    for row in sorted(counted.groupBy(step.alias("step")).agg(F.count("*").alias("rows"), F.min(n).alias("least")).collect(), key=lambda r: -r["step"]):
        if row["rows"] > room:
            for some in sorted(counted.where(step == row["step"]).groupBy(F.col(n).alias("n")).agg(F.count("*").alias("rows")).collect(), key=lambda r: -r["n"]):
                if some["rows"] > room:
                    break
                room, least = room - some["rows"], some["n"]
            break
        room, least = room - row["rows"], row["least"]
    return counted.where(F.col(n) >= least).collect() if least is not None else []


def per_batch(work: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function for mapInArrow that applies work to slices of limited bytes, so that long texts don't add up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                yield from work(piece)

    return tidy(run)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, after whose end the worker, which waits for further tasks, gives its free memory back."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only glibc has it
            ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def slices(batch: pa.RecordBatch, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch, of about so many bytes each and one row at least."""
    parts = max(1, -(-batch.nbytes // most))
    step = max(1, -(-batch.num_rows // parts))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)

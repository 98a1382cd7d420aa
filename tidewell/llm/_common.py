"""What the operators share: reading tables, the shared scratch folder, and the definition of a word."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.ordered import running
from tidewell.scratch import discard, scratch, written
from tidewell.ship import ship

__all__ = ["discard", "running", "scratch", "written"]  # of the whole library, used by the operators here

#: Space and the controls 9 to 13; a word is a longest run of other characters. ``bytes.split()`` splits at just these.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of one key, at least, that make it a hot key; and hot keys, at most, whatever the number of rows.
HOT_ROWS, HOT_KEYS = 2_000, 100_000


def ready(spark: SparkSession) -> None:
    """Ship the package. Where the session has Spark's default, an Arrow batch holds 1000 rows (and 64 MB) at most: they
    are texts, and some are very long. What the caller has set stays."""
    ship(spark)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(size) == "10000":
        spark.conf.set(size, "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """The rows of a scan, dealt by doc_id where the scan fills fewer tasks than there are cores; a larger one as it is.

    Only a scan of few splits is looked at, by a count that reads no column.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() > 2 * cores or rows.groupBy(F.spark_partition_id()).count().count() >= cores:
        return rows
    return rows.repartition(cores, "doc_id").sortWithinPartitions("doc_id", text_hash())


def join_keys(rows: DataFrame, keys: DataFrame, on: list[str], n: str, how: str = "inner") -> DataFrame:
    """Inner or left join with ``keys``: a written table, unique in ``on``, with the number ``n`` of rows of each key.

    Keys of many rows are broadcast and joined where their rows lie: there are at most HOT_KEYS of them, since each has
    at least that share of all rows. Rows of the other keys are shuffled. No key's rows meet in one task.
    """
    total = keys.agg(F.sum(n)).first()[0] or 0
    hot = keys.filter(F.col(n) >= max(HOT_ROWS, -(-total // HOT_KEYS)))
    here = rows.join(F.broadcast(hot), on)
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(keys, on, how)
    return here.unionByName(rest)


def row_of(docs: DataFrame) -> Column:
    """All columns of ``docs`` as the struct ``row``, so that none of their names can clash with another's."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")


def text_hash(column: str = "text") -> Column:
    """XXH64 (seed 42) of a text, null as empty; with doc_id the identity of a row."""
    return F.xxhash64(F.coalesce(column, F.lit("")))


def keep_rows(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``marks`` (doc_id, h, keep; one row for each identity that loses rows) drops.

    keep is 0 or 1: how many rows stay of those with this doc_id and text hash. What isn't marked stays as it is, so
    texts are joined with the few marks only, once. All columns of ``docs`` are kept, whatever their names.
    """
    rows = docs.select(row_of(docs), text_hash().alias("h")).alias("r")
    joined = rows.join(
        marks.alias("m"),
        F.col("r.row.doc_id").cast("long").eqNullSafe(F.col("m.doc_id")) & (F.col("r.h") == F.col("m.h")), "left",
    )
    once = joined.filter("m.keep = 1").groupBy(F.col("m.doc_id"), F.col("m.h")).agg(F.first("r.row").alias("row"))
    return joined.filter("m.keep is null").select("r.row.*").unionByName(once.select("row.*"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = 4_000_000) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of rows with about ``size`` bytes of text (one row at least), with their texts as UTF-8; null counts as empty."""
    for batch in batches:
        texts = batch.column(column)
        texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
        lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        begin = total = 0
        for i, n in enumerate(lengths):
            if total and total + n > size:
                yield batch.slice(begin, i - begin), [x or b"" for x in texts.slice(begin, i - begin).to_pylist()]
                begin, total = i, 0
            total += int(n)
        if begin < batch.num_rows:
            yield batch.slice(begin), [x or b"" for x in texts.slice(begin).to_pylist()]
    give_back()


def give_back() -> None:
    """Hand memory that a task has freed back to the system: workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _is_space(raw: np.ndarray) -> np.ndarray:
    return (raw == 32) | (raw - np.uint8(9) < 5)  # bytes below 9 wrap round


def words_of(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Every word of the texts in order, as a code (int32) into the list of distinct words, and where each text's words begin and end."""
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    space = _is_space(raw)
    first = ~space
    first[1:] &= space[:-1]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.flatnonzero(first)
    ends = np.concatenate([[0], np.searchsorted(begins, np.cumsum(lengths + 1))])
    if not len(begins):
        return np.zeros(0, np.int32), [], ends
    keep = ~space  # the characters of words, and one space after each word
    keep[1:] |= space[1:] & ~space[:-1]
    kept = raw[keep]
    stops = np.flatnonzero(_is_space(kept))
    offsets = np.concatenate([[0], stops + 1]).astype(np.int32)
    kept[stops] = 32
    coded = pa.BinaryArray.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(kept)],
    ).dictionary_encode()
    _, bounds, data = coded.dictionary.buffers()
    size = int(np.frombuffer(bounds, np.int32)[len(coded.dictionary)])
    return coded.indices.to_numpy(), data.slice(0, size).to_pybytes().split(b" ")[:-1], ends  # each ends with its space

"""Op 1. Token-ID files: ids of all documents in ascending doc_id order, Simple-8b coded, written and read back.

One file ("shard") holds the documents of a stretch of the order. All numbers are little-endian:

    8 bytes  magic ``TWS8B001``
    5 x u64  documents, ids, blocks, words, escapes
    i64[documents] doc_id; u8[documents] 1 where doc_id is null; u64[documents] ids of each document
    u64[blocks + 1] index of each block's first word (a block is 1024 ids), the number of words at last
    u64[words] Simple-8b words; u64[escapes] raw values

A file is written whole under a name of its own and counts only once its task has succeeded and the manifest lists it;
what a lost executor leaves behind is never read. The manifest has a row for each shard, not for each document; tasks
write it as a table, where a shard starts is a running sum over its ranges, and reading tasks take several shards each
where there are many, so none of it passes through the driver.

Rows: a very long text is encoded whole and lies in one shard, which it may make larger than others. Null text is an empty document (one end id). Documents with equal doc_id follow each other in the order of their
text's hash, null doc_ids come first. An empty table makes an empty manifest. Other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import simple8b
from tidewell.llm._common import running, scratch, slices, written
from tidewell.llm.tokens import default_path, encoder

MAGIC = b"TWS8B001"
CHUNK = 1024 * simple8b.BLOCK  # ids coded or decoded at a time; whole blocks
STRETCH = 8_000_000  # bytes of text encoded at a time
READ_IDS = 1 << 27  # ids of a reading task, about, where there are more tasks than cores can use


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class _Shard:
    """Gathers documents in order and writes them as one file."""

    def __init__(self, folder: str) -> None:
        self.folder, self.keys, self.lengths, self.rest, self.done = folder, [], [], [], 0
        self.held, self.words, self.offsets, self.escapes, self.n = 0, [], [], [], 0

    def add(self, keys: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.keys.append(keys)
        self.lengths.append(lengths)
        self.rest.append(ids)
        self.held += len(ids)
        self.n += len(ids)
        if self.held >= CHUNK:
            self._code(self.held // CHUNK * CHUNK)

    def _code(self, n: int) -> None:
        ids = np.concatenate(self.rest)
        for i in range(0, n, CHUNK):
            words, offsets, escapes = simple8b.encode(ids[i : min(i + CHUNK, n)])
            words[(words >> np.uint64(60)) == simple8b.ESCAPE] += np.uint64(sum(map(len, self.escapes)))
            self.words.append(words)
            self.offsets.append(offsets[:-1] + self.done)
            self.escapes.append(escapes)
            self.done += len(words)
        self.rest, self.held = [ids[n:]], len(ids) - n

    def write(self) -> tuple[str, int, int, int]:
        if self.held:
            self._code(self.held)
        docs = sum(map(len, self.keys))
        fs, path = _open(f"{self.folder}/{uuid.uuid4().hex}.s8b")
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(path, compression=None) as out:
            out.write(MAGIC + struct.pack("<5Q", docs, self.n, sum(map(len, self.offsets)), self.done, sum(map(len, self.escapes))))
            for k in self.keys:
                out.write(k.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            for k in self.keys:
                out.write(k.is_null().to_numpy(zero_copy_only=False).astype("u1").tobytes())
            for parts in (self.lengths, [*self.offsets, np.array([self.done])], self.words, self.escapes):
                for part in parts:
                    out.write(part.astype("<u8").tobytes())
        return f"{self.folder}/{path.rpartition('/')[2]}", docs, self.n, self.done


_MANIFEST = "shard long, path string, n_docs long, n_ids long, n_words long"


def write_tokens(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None, shard_ids: int = 1 << 24) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into shards of about ``shard_ids`` ids below ``folder``.

    Returns the manifest (shard, path, start, n_docs, n_ids, n_words): one row for each file, ``shard`` rising with ``start``. Documents are
    range-partitioned and sorted as text, so ids are never shuffled; each task streams through its stretch of the
    order and holds one shard at most.
    """
    spark = docs.sparkSession
    folder, tokenizer = folder or scratch(spark), tokenizer or default_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, shard, rows = TaskContext.get().partitionId() << 32, _Shard(folder), []
        for batch, texts in slices(batches, size=STRETCH):
            shard.add(batch.column("doc_id"), *encoder(tokenizer).encode(texts))
            if shard.n >= shard_ids:
                rows.append(shard.write())
                shard = _Shard(folder)
        if shard.keys:
            rows.append(shard.write())
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part + i for i in range(len(rows))], pa.int64()), *(pa.array(x) for x in zip(*rows, strict=True))],
                ["shard", "path", "n_docs", "n_ids", "n_words"],
            )

    order = ["doc_id", "_tie"]
    ordered = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_tie"),
    ).repartitionByRange(*order).sortWithinPartitions(*order)
    listed = written(ordered.select("doc_id", "text").mapInArrow(work, _MANIFEST), "manifest")  # files of failed attempts have no row
    placed = running(listed, ["shard"], "n_ids")
    return written(placed.select("shard", "path", (F.col("n_ids_upto") - F.col("n_ids")).alias("start"), "n_docs", "n_ids", "n_words"), "manifest")


def read_shard(path: str, rows: int = 2048) -> Iterator[tuple[list, np.ndarray, list[np.ndarray]]]:
    """doc_ids, start within the shard, and ids (uint32) of the documents of a file, some at a time."""
    fs, inner = _open(path)
    with fs.open_input_file(inner) as f:
        assert f.read(8) == MAGIC, path
        docs, n, blocks, n_words, n_escapes = struct.unpack("<5Q", f.read(40))
        take = lambda kind, count: np.frombuffer(f.read(count * np.dtype(kind).itemsize), kind)
        keys, null, lengths = take("<i8", docs), take("u1", docs), take("<u8", docs).astype(np.int64)
        offsets, words, escapes = take("<u8", blocks + 1).astype(np.int64), take("<u8", n_words), take("<u8", n_escapes)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    begin = 0
    while begin < docs:
        end = max(begin + 1, min(docs, begin + rows, int(np.searchsorted(starts, starts[begin] + CHUNK))))
        first = int(starts[begin]) // simple8b.BLOCK
        ids = simple8b.decode(words, offsets, n, escapes, first, -(-int(starts[end]) // simple8b.BLOCK) - first).astype("<u4")
        cut = starts[begin : end + 1] - first * simple8b.BLOCK
        yield [None if z else int(k) for k, z in zip(keys[begin:end], null[begin:end], strict=True)], starts[begin:end], [ids[a:b] for a, b in zip(cut, cut[1:], strict=False)]
        begin = end


def read_tokens(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (binary, little-endian u32) of every document, from the files."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                for keys, starts, ids in read_shard(path):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), pa.array(starts + base, pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())],
                        ["doc_id", "start", "ids"],
                    )

    files, ids = manifest.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_ids"), F.lit(0))).first()
    tasks = max(1, min(files, max(8 * spark.sparkContext.defaultParallelism, -(-ids // READ_IDS))))
    dealt = manifest.select("path", "start").repartitionByRange(tasks, "start")
    return dealt.mapInArrow(work, "doc_id long, start long, ids binary")

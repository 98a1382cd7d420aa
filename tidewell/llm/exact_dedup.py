"""Op 10. Exact dedup by composable polynomial fingerprints, checked by chunkwise streaming comparison.

Texts are equal when identical after every run of white space (space, controls 9 to 13) became one space.

1. Every text gets a fingerprint (two residues and its length) in one pass; only narrow rows leave it.
2. Rows are grouped by fingerprint (partial aggregation). Rows of groups of two or more are candidates; their texts
   alone are fetched, by doc_id, and compared chunk by chunk with the text of their group's first row. A large group is
   dealt into salted parts of about ``PART`` rows, each with a copy of that first row, so no task gets a group whole.
3. Rows that differ from their group's first row (a collision) form a class of the next round, until none is left.

Rows: null text counts as empty. A very long text is hashed in chunks and compared in chunks. Null doc_id sorts after all others; of rows that tie in doc_id and text one stays.
An empty table gives an empty result. Only doc_id and text are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm._common import discard, join_keys, keep_rows, slices, written
from tidewell.llm.polynomial import MODULI, fingerprints

PART = 32  # rows of a group in one part, about; each part has a copy of the first row
COMPARED = 1 << 16  # bytes compared at a time

_TO_SPACE = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_RUNS = re.compile(rb" {2,}")


def normalised(text: bytes) -> bytes:
    text = text.translate(_TO_SPACE)
    return _RUNS.sub(b" ", text) if b"  " in text else text


def _fingerprinted(docs: DataFrame, moduli: tuple[int, int], with_text: bool) -> DataFrame:
    """row (a number for each row of this pass), doc_id, fp, n_bytes, sha (SHA-256), h (XXH64 of the text as it is), and the normalised text where asked for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from xxhash import xxh64_intdigest

        row = TaskContext.get().partitionId() << 33
        for batch, texts in slices(batches):
            hashes = np.array([xxh64_intdigest(t, 42) for t in texts], np.uint64).view(np.int64)
            texts = [normalised(t) for t in texts]
            states = np.array(fingerprints(texts, moduli), np.int64).reshape(-1, 3)
            columns = [
                pa.array(np.arange(row, row + len(texts))), batch.column("doc_id"),
                pa.array(states[:, 0] << 31 | states[:, 1]), pa.array(states[:, 2]),
                pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()), pa.array(hashes),
            ]
            row += len(texts)
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(texts, pa.binary())] * with_text,
                ["row", "doc_id", "fp", "n_bytes", "sha", "h", "text"][: 6 + with_text],
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        work, "row long, doc_id long, fp long, n_bytes long, sha binary, h long" + ", text binary" * with_text,
    )


def _differing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a stream sorted by (fp, n_bytes, round, part, first row before others): the rows that differ from their part's first one."""
    key = first = None
    for batch in batches:
        texts, keep = batch.column("text"), []
        for i, at in enumerate(zip(*(batch.column(c).to_pylist() for c in ("fp", "n_bytes", "round", "part")), strict=True)):
            view = memoryview(texts[i].as_buffer()).cast("B")
            if at != key:
                key, first = at, bytes(view)
            elif any(view[j : j + COMPARED] != first[j : j + COMPARED] for j in range(0, max(len(view), len(first)), COMPARED)):
                keep.append(i)
        if keep:
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(keep)) for c in ("doc_id", "fp", "n_bytes", "sha", "round")],
                ["doc_id", "fp", "n_bytes", "sha", "round"],
            )


def _same(a: str, b: str, *columns: str) -> F.Column:
    out = F.lit(True)
    for c in columns:
        out &= F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) if c == "doc_id" else F.col(f"{a}.{c}") == F.col(f"{b}.{c}")
    return out


_CLASS = ["fp", "n_bytes", "round"]
_IDENTITY = ["doc_id", "fp", "n_bytes", "sha"]


def _colliding(docs: DataFrame, rows: DataFrame, large: DataFrame, round_: int, moduli: tuple[int, int]) -> DataFrame:
    """Identities of the rows of this round that differ in text from their class's first row."""
    firsts = large.filter(F.col("round") == round_).select(*_CLASS, "size", F.col("keep.row").alias("first"))
    met = join_keys(rows.filter(F.col("round") == round_), firsts, _CLASS, "size")
    wanted = written(met.groupBy(*_IDENTITY, "round", "size").agg(F.max(F.col("row") == F.col("first")).alias("is_first")), "wanted")
    ids = wanted.select("doc_id").distinct()
    texts = docs.select("doc_id", "text").join(
        ids.filter("doc_id is not null"), "doc_id", "left_semi",
    ).unionByName(docs.select("doc_id", "text").filter("doc_id is null"))
    found = _fingerprinted(texts, moduli, True).alias("t").join(wanted.alias("w"), _same("t", "w", *_IDENTITY)).select(
        "t.doc_id", "t.fp", "t.n_bytes", "t.sha", "w.round", "w.is_first", "w.size", "t.text",
    )
    parts = F.ceil(F.col("size") / PART).cast("int")
    dealt = found.withColumn(
        "part",
        F.explode(
            F.when(F.col("is_first"), F.sequence(F.lit(0), parts - 1)).otherwise(
                F.array(F.pmod(F.xxhash64("doc_id", "sha"), parts).cast("int"))
            )
        ),
    )
    key = [*_CLASS, "part"]
    streamed = dealt.repartition(*key).sortWithinPartitions(*key, F.col("is_first").desc(), "sha")
    return streamed.mapInArrow(_differing, "doc_id long, fp long, n_bytes long, sha binary, round int").distinct()


def exact_classes(docs: DataFrame, moduli: tuple[int, int] = MODULI) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text), n_bytes, h (XXH64 of the text as it is)."""
    rows, round_ = written(_fingerprinted(docs, moduli, False).withColumn("round", F.lit(0)), "rows"), 0
    while True:
        first = rows.groupBy(*_CLASS).agg(
            F.count(F.lit(1)).alias("size"),
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("keep"),
        )
        large = written(first.filter("size > 1"), "large")
        unlike = written(_colliding(docs, rows, large, round_, moduli), "unlike")
        if unlike.isEmpty():
            break
        marked = rows.alias("r").join(unlike.alias("u"), _same("r", "u", *_IDENTITY, "round"), "left").select(
            "r.row", "r.h", *(f"r.{c}" for c in _IDENTITY),
            (F.col("r.round") + F.col("u.fp").isNotNull().cast("int")).alias("round"),
        )
        before, rows, round_ = rows, written(marked, "rows"), round_ + 1
        for old in (before, large, unlike):
            discard(old)
    joined = join_keys(rows, large, _CLASS, "size", "left")
    return joined.select(
        "doc_id", F.when(
            F.col("size").isNull(), F.col("doc_id"),
        ).otherwise(F.col("keep.doc_id")).alias("keep_id"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (
            F.col("size").isNull() | (F.col("row") == F.col("keep.row"))
        ).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "n_bytes", "h",
    )


def dedup(docs: DataFrame, moduli: tuple[int, int] = MODULI) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    marks = exact_classes(docs, moduli).groupBy("doc_id", "h").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("kept").cast("int")).alias("keep"),
    )
    return keep_rows(docs, written(marks.filter("n > keep"), "marks"))

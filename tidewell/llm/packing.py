"""Op 8. Packing: sum-of-squares online packing of token documents into windows.

N(h) is the number of open windows filled to level h. A document of size s goes to the level h (an open window, or a
new one at h = 0) for which the sum of N(h)^2 over the partially filled levels gets smallest; the counts live in one
level array and a choice looks at every level that has room. A document longer than a window first fills whole windows
of its own; its remainder is placed like any document.

Every input partition packs its own stream. The documents in windows that are still open at its end are handed on, uncut,
to a second round, in which one task packs those of ``ROUND`` partitions by a level array of its own. Only what is open at
the end of that is drained: pieces are cut at window borders and joined, fullest first, so each task leaves at most one
window that isn't full. A stream leaves a few hundred open windows whatever its length, so the more documents, the less is
drained. A task holds the ids of its open windows, at worst those of its partition, and in the second round those that
``ROUND`` partitions left. Rounds are written; a task run anew on the same rows makes the same windows.

Rows: null text is an empty document (one end id). A text longer than a window spans several, and is encoded whole.
Equal doc_ids stay documents of their own. An empty table has no pieces. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm._common import slices, written
from tidewell.llm.tokens import default_path, encoder

Piece = tuple[int, int, int]  # document (any reference), start in the document, length

MEMO = 100_000, 200_000  # words and parts of words that a worker's encoder keeps: open windows and other stages need memory too
ROUND = 16  # partitions whose open windows one task of the second round gets


class SumOfSquares:
    """Online packing of sizes into windows of ``size``; closed windows come out as lists of pieces."""

    def __init__(self, size: int = 4096) -> None:
        self.size = size
        self.counts = np.zeros(size + 1, np.int64)
        self.open: dict[int, list[list[Piece]]] = {}

    def choose(self, s: int) -> int:
        """The level to place a document of ``s`` < size at; of equal ones the fullest."""
        levels = np.flatnonzero(self.counts[: self.size - s + 1])
        after = self.counts.copy()
        after[self.size] = 0  # full windows are closed and don't count
        gain = np.concatenate([[2 * after[s] + 1], 2 * (after[levels + s] - after[levels]) + 2])
        gain[1:][levels + s == self.size] = 1 - 2 * after[levels[levels + s == self.size]]
        levels = np.concatenate([[0], levels])
        best = np.flatnonzero(gain == gain.min())
        return int(levels[best[-1]])

    def add(self, doc: int, n: int) -> Iterator[list[Piece]]:
        whole = n // self.size * self.size
        for start in range(0, whole, self.size):
            yield [(doc, start, self.size)]
        if n == whole:
            return
        s = n - whole
        h = self.choose(s)
        if h:
            window = self.open[h].pop()
            self.counts[h] -= 1
        else:
            window = []
        window.append((doc, whole, s))
        if h + s == self.size:
            yield window
            return
        self.open.setdefault(h + s, []).append(window)
        self.counts[h + s] += 1

    def left(self) -> list[Piece]:
        """The pieces in open windows, in the order in which their documents came; nothing is open afterwards."""
        pieces = sorted(p for windows in self.open.values() for w in windows for p in w)
        self.open = {}
        self.counts[:] = 0
        return pieces

    def drain(self) -> Iterator[list[Piece]]:
        """Join the open windows' pieces into full windows; what is left over is the last one."""
        pieces = [p for h in sorted(self.open, reverse=True) for w in self.open[h] for p in w]
        self.open = {}
        self.counts[:] = 0
        window, level = [], 0
        for doc, start, n in pieces:
            while n:
                take = min(n, self.size - level)
                window.append((doc, start, take))
                start, n, level = start + take, n - take, level + take
                if level == self.size:
                    yield window
                    window, level = [], 0
        if window:
            yield window


_NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "part", "place"]
_PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, part long, place long"
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5]


class _Pieces:
    """Rows of pieces. Documents are held until all their ids are out."""

    def __init__(self, sequence: int) -> None:
        self.sequence, self.held, self.out = sequence, {}, [[] for _ in _NAMES]

    def hold(self, ref: int, doc_id: int | None, start: int, ids: np.ndarray, tokens: int) -> None:
        """A document's ids from ``start`` on, which are all that pieces with this reference may ask for."""
        self.held[ref] = [doc_id, start, ids, tokens, len(ids)]

    def _row(self, ref: int, start: int, n: int, *place: int | None) -> None:
        doc = self.held[ref]
        ids = doc[2][start : start + n].astype("<u4").tobytes()
        for x, v in zip(self.out, (doc[0], doc[1] + start, n, ids, doc[3], *place), strict=True):
            x.append(v)
        doc[4] -= n
        if not doc[4]:
            del self.held[ref]

    def emit(self, windows: Iterator[list[Piece]]) -> None:
        for window in windows:
            offset = 0
            for ref, start, n in window:
                self._row(ref, start, n, self.sequence, offset, None, None)
                offset += n
            self.sequence += 1

    def hand_on(self, pieces: list[Piece], part: int) -> None:
        for i, (ref, start, n) in enumerate(pieces):
            self._row(ref, start, n, None, None, part, i)

    def flush(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self.out[0]) >= least:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(self.out, _KINDS, strict=True)], _NAMES)
            self.out = [[] for _ in _NAMES]


def pack(docs: DataFrame, tokenizer: str | None = None, size: int = 4096) -> DataFrame:
    """One row for each piece: doc_id, start and length in the document, ids (binary, little-endian u32), doc_tokens,
    sequence_id (the task in the high bits) and offset in that sequence."""
    tokenizer = tokenizer or default_path()

    def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        packer, pieces, n_docs = SumOfSquares(size), _Pieces(part << 32), 0
        for batch, texts in slices(batches):
            ids, lengths = encoder(tokenizer, *MEMO).encode(texts)
            ids = ids.astype(np.min_scalar_type(ids.max(initial=0)))
            stops = np.cumsum(lengths)
            for key, a, b in zip(batch.column("doc_id").to_pylist(), stops - lengths, stops, strict=True):
                pieces.hold(n_docs, key, 0, ids[a:b].copy(), int(b - a))
                pieces.emit(packer.add(n_docs, int(b - a)))
                n_docs += 1
                yield from pieces.flush(2000)
        pieces.hand_on(packer.left(), part)
        yield from pieces.flush()

    def second(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).sort_by([("part", "ascending"), ("place", "ascending")])
        packer, pieces = SumOfSquares(size), _Pieces(1 << 62 | key[0].as_py() << 32)
        columns = [table.column(c) for c in ("doc_id", "start", "length", "ids", "doc_tokens")]
        for ref, (doc_id, start, n, ids, tokens) in enumerate(zip(*columns, strict=True)):
            pieces.hold(ref, doc_id.as_py(), start.as_py(), np.frombuffer(ids.as_py(), "<u4"), tokens.as_py())
            pieces.emit(packer.add(ref, n.as_py()))
            yield from pieces.flush(2000)
        pieces.emit(packer.drain())
        yield from pieces.flush()

    made = written(docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(streams, _PIECES), "windows")
    left = made.filter("sequence_id is null").withColumn("round", F.floor(F.col("part") / ROUND).cast("long"))
    again = left.groupBy("round").applyInArrow(second, _PIECES)
    return made.filter("sequence_id is not null").unionByName(again).drop("part", "place")

"""Op 4. Repeated passages by sparse suffix arrays.

Of a document's suffixes (one begins at each word) only those at minimiser positions are kept: of any ``WINDOW`` runs
of ``RUN`` words in a row, the one with the least hash. Every passage of WINDOW + RUN - 1 (50) words thus keeps a suffix
at the same place wherever it occurs. The suffixes are sorted by their first words, neighbours from different documents
are compared, and their match is extended to the right and to the left; matches of at least ``LEAST`` words are reported.

1. One pass over the texts gives narrow rows (document, position, hash of the first RUN words). Runs that one document
   alone has are dropped; the counts are pre-aggregated, and a very common run is joined where its rows lie.
2. Texts are joined once, by document, with the positions left in them; the words on either side come back as hashes,
   as many as a 50-word passage around the position can reach.
3. A range sort by run and the words to the right, then left, is the sparse suffix array: a very common passage spans
   many partitions, and each suffix is compared with its two neighbours only, never with all others.
4. Where a run has several surroundings, the suffix that shares a passage need not be a neighbour. There the (at most
   26) passages of LEAST words around each run are hashed (128 bits) and grouped as well: inside the task where it holds
   all of the run, and by a shuffle for runs that a border may cut, one row for each passage and piece that it is in.
   So no match depends on where a border lies or on the order of neighbours.
5. Matches of a document are united to its spans.

Words are compared by hashes: a neighbour's match by a 64-bit hash of RUN words and a 32-bit hash of each further word, a
passage by its 128 bits. A match may go on beyond SIDE words; another kept suffix of the same two texts then shows it.

Rows: null text has no words; documents of under 50 words have no spans. A very long text is read whole, and its rows are
as many as its kept suffixes. Null doc_id is a document like others; rows equal in doc_id and text are one document. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm._common import join_keys, slices, text_hash, words_of, written

RUN, WINDOW, LEAST = 25, 26, 50
SIDE = WINDOW  # words compared on each side of a run
RANGE = 1_000_000  # suffixes of one range of the sort, about
_NONE = -(2**63)  # doc_id null, inside this module

_BASE = 0x9E3779B97F4A7C15
_DOC = ["doc_id", "h"]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each word, and where each text's words begin and end."""
    from xxhash import xxh3_64_intdigest

    codes, distinct, ends = words_of(texts)
    return np.fromiter(map(xxh3_64_intdigest, distinct), np.uint64, len(distinct))[codes] if len(distinct) else np.zeros(0, np.uint64), ends


def run_hashes(words: np.ndarray, run: int = RUN) -> np.ndarray:
    """Polynomial hash (mod 2^64, mixed) of every run of words, from one running sum."""
    n = len(words)
    if n < run:
        return np.zeros(0, np.uint64)
    powers = lambda b: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers(pow(_BASE, -1, 1 << 64)))])
    h = (sums[run:] - sums[:-run]) * powers(_BASE)[: n - run + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """best() over every ``width`` values in a row."""
    out, have = values, 1
    while have * 2 <= width:
        out, have = best(out[:-have], out[have:]), have * 2
    return best(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


def minimisers(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions that hold the least hash of some ``window`` hashes in a row."""
    if len(hashes) < window:
        return np.zeros(0, np.int64)
    least = _sliding(hashes, window, np.minimum)
    padded = np.concatenate([np.zeros(window - 1, np.uint64), least, np.zeros(window - 1, np.uint64)])
    return np.flatnonzero(_sliding(padded, window, np.maximum) == hashes)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches):
        words, ends = word_hashes(texts)
        hashes = run_hashes(words)
        docs, places, keys = [], [], []
        for i in np.flatnonzero(np.diff(ends) >= RUN + WINDOW - 1).tolist():
            own = hashes[ends[i] : ends[i + 1] - RUN + 1]
            at = minimisers(own)
            docs.append(np.full(len(at), i))
            places.append(at)
            keys.append(own[at])
        if docs:
            who = pa.array(np.concatenate(docs))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(who) for c in _DOC), pa.array(np.concatenate(places).astype(np.int32)),
                    pa.array(np.concatenate(keys).view(np.int64)),
                ],
                [*_DOC, "place", "run"],
            )


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each kept suffix: the words after its run, and the words before it from the nearest on, as 4-byte hashes."""
    for batch, texts in slices(batches):
        words, ends = word_hashes(texts)
        small = (words >> np.uint64(32)).astype(">u4")
        whos, places, runs, rights, lefts = [], [], [], [], []
        for i, found in enumerate(batch.column("found").to_pylist()):
            own = small[ends[i] : ends[i + 1]]
            ahead, back = own.tobytes(), own[::-1].tobytes()
            n = len(own)
            for x in found:
                p = x["place"]
                whos.append(i)
                places.append(p)
                runs.append(x["run"])
                rights.append(ahead[4 * (p + RUN) : 4 * (p + RUN + SIDE)])
                lefts.append(back[4 * (n - p) : 4 * (n - p + SIDE)])
            if len(whos) > 50_000:
                yield _context_rows(batch, whos, places, runs, rights, lefts)
                whos, places, runs, rights, lefts = [], [], [], [], []
        if whos:
            yield _context_rows(batch, whos, places, runs, rights, lefts)


def _context_rows(batch: pa.RecordBatch, whos: list, places: list, runs: list, rights: list, lefts: list) -> pa.RecordBatch:
    who = pa.array(whos)
    next_ = np.frombuffer(b"".join(x[:8].ljust(8, b"\0") for x in rights), ">i8").astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(runs, pa.int64()), pa.array(next_), pa.array(rights, pa.binary()), pa.array(lefts, pa.binary()),
            *(batch.column(c).take(who) for c in _DOC), pa.array(places, pa.int32()),
        ],
        ["run", "next", "right", "left", *_DOC, "place"],
    )


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes by row, and how many each row has."""
    cells = [x.ljust(4 * SIDE, b"\0") for x in column.to_pylist()]
    return np.frombuffer(b"".join(cells), ">u4").reshape(-1, SIDE), pa.compute.binary_length(column).to_numpy() // 4


def _common(m: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading words rows a and b share."""
    out = np.empty(len(a), np.int64)
    for i in range(0, len(a), 65_536):
        x, y = a[i : i + 65_536], b[i : i + 65_536]
        differ = m[x] != m[y]
        out[i : i + 65_536] = np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), SIDE), np.minimum(n[x], n[y]))
    return out


_COLUMNS = ["run", "right", "left", *_DOC, "place"]
_FOUND = "doc_id long, h long, start int, end int, other long, window long, window2 long"
_NAMES = [x.split()[0] for x in _FOUND.split(", ")]


def _rows(
    doc: np.ndarray, h: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray | None = None,
    window: tuple[np.ndarray, np.ndarray] | None = None,
) -> pa.RecordBatch:
    """Matches with another document, or passages (``window``) that other pieces may find."""
    longs = lambda x: pa.nulls(len(doc), pa.int64()) if x is None else pa.array(x.view(np.int64))
    a, b = window or (None, None)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc), pa.array(h), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), longs(other), longs(a), longs(b)],
        _NAMES,
    )


def _neighbours(batches: Iterator[pa.RecordBatch], rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Matches of a sorted partition's suffixes with the next ones before and after that are of other documents.

    The partition streams through in pieces of about ``rows`` rows; a piece's last two documents stay for the next one.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) < rows:
            continue
        piece = _joined(held)
        begins = _begins(piece)
        if len(begins) < 3:
            continue
        yield _matches(piece, begins)
        held = [piece.slice(int(begins[-2]))]
    if held:
        piece = _joined(held)
        yield _matches(piece, _begins(piece))


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _begins(t: pa.RecordBatch) -> np.ndarray:
    """Where a document's suffixes with one run begin."""
    run, doc, h = (t.column(c).to_numpy() for c in ("run", "doc_id", "h"))
    return np.flatnonzero(np.concatenate([[True], (run[1:] != run[:-1]) | (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])]))


def _matches(t: pa.RecordBatch, begins: np.ndarray) -> pa.RecordBatch:
    run, doc, h, place = (t.column(c).to_numpy() for c in ("run", "doc_id", "h", "place"))
    n = len(run)
    group = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, n)))
    before, after, rows = begins[group] - 1, np.append(begins[1:], n)[group], np.arange(n)
    a = np.concatenate([rows[before >= 0], rows[after < n]])
    b = np.concatenate([before[before >= 0], after[after < n]])
    same = run[a] == run[b]
    a, b = a[same], b[same]
    right, left = _matrix(t.column("right")), _matrix(t.column("left"))
    r, l = _common(*right, a, b), _common(*left, a, b)  # noqa: E741
    far = r + l + RUN >= LEAST
    a, b, r, l = a[far], b[far], r[far], l[far]  # noqa: E741
    return _rows(doc[a], h[a], place[a] - l, place[a] + RUN + r, doc[b])


class _Windows:
    """The passages of LEAST words around the runs of a sorted partition that several documents hold.

    Rows come in by ``add``; they are searched in pieces of about ``rows`` rows, of whole runs where that is possible.
    A run at a border of the partition or of a piece is open: those of its passages come out as well by which other
    pieces can find them (``window``, half of the hash, is not null).
    """

    def __init__(self, rows: int = 50_000) -> None:
        self.rows, self.held, self.first_open, self.out = rows, [], True, []

    def add(self, batch: pa.RecordBatch) -> None:
        self.held.append(batch)
        if sum(map(len, self.held)) >= self.rows:
            self._search(last=False)

    def take(self) -> list[pa.RecordBatch]:
        out, self.out = self.out, []
        return out

    def close(self) -> None:
        if sum(map(len, self.held)):
            self._search(last=True)

    def _search(self, last: bool) -> None:
        piece = _joined(self.held)
        run = piece.column("run").to_numpy()
        begins = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        open_ = np.zeros(len(begins), bool)
        open_[0], upto = self.first_open, len(piece)
        if last or len(begins) == 1:
            open_[-1] = True
            self.held, self.first_open = [], True
        else:  # the last run waits for its other rows
            upto = int(begins[-1])
            begins, open_ = begins[:-1], open_[:-1]
            self.held, self.first_open = [piece.slice(upto)], False
        sizes = np.diff(np.append(begins, upto))
        same = np.ones(upto, bool)  # as the row before, or the first of its run
        same[1:] = np.asarray(
            pa.compute.and_(
                *(pa.compute.equal(piece.column(c).slice(1, upto - 1), piece.column(c).slice(0, upto - 1)) for c in ("right", "left"))
            )
        )
        same[begins] = True
        differ = ~np.logical_and.reduceat(same, begins)  # of two suffixes, or of equal ones, the neighbours tell all
        rows = np.flatnonzero(np.repeat(open_ | (differ & (sizes > 2)), sizes))
        if len(rows):
            self._group(piece.take(pa.array(rows)), np.repeat(open_, sizes)[rows])

    def _group(self, t: pa.RecordBatch, open_: np.ndarray) -> None:
        run, doc, h, place = (t.column(c).to_numpy() for c in ("run", "doc_id", "h", "place"))
        right, left = _matrix(t.column("right")), _matrix(t.column("left"))
        hashes, valid = _window_hashes(run, right, left)
        second, _ = _window_hashes(run, right, left, 3)
        who = (doc.view(np.uint64) * np.uint64(_BASE)) ^ h.view(np.uint64)
        row, back = np.nonzero(valid)
        flat, flat2 = hashes[row, back], second[row, back]
        order = np.lexsort((who[row], flat2, flat))
        flat, flat2, row, back = flat[order], flat2[order], row[order], back[order]
        if not len(flat):
            return
        begins = np.flatnonzero(np.concatenate([[True], (flat[1:] != flat[:-1]) | (flat2[1:] != flat2[:-1])]))
        sizes = np.diff(np.append(begins, len(flat)))
        least, most = row[begins], row[begins + sizes - 1]
        several = who[least] != who[most]
        shared, least, most = np.repeat(several, sizes), np.repeat(least, sizes), np.repeat(most, sizes)
        other = np.where(who[least] != who[row], least, most)
        found, others = np.zeros(valid.shape, bool), np.zeros(valid.shape, np.int64)
        found[row, back], others[row, back] = shared, other
        hit = np.flatnonzero(found.any(axis=1))
        near, far = found[hit].argmax(axis=1), found.shape[1] - 1 - found[hit][:, ::-1].argmax(axis=1)
        self.out.append(_rows(doc[hit], h[hit], place[hit] - far, place[hit] - near + LEAST, doc[others[hit, far]]))
        first = np.zeros(len(flat), bool)
        first[begins] = True
        keep = open_[row] & (~shared | first)
        a = row[keep]
        start = place[a] - back[keep]
        self.out.append(_rows(doc[a], h[a], start, start + LEAST, window=(flat[keep], flat2[keep])))


def _window_hashes(
    run: np.ndarray, right: tuple[np.ndarray, np.ndarray], left: tuple[np.ndarray, np.ndarray], seed: int = 1,
) -> tuple[np.ndarray, np.ndarray]:
    """For each row and number of words before the run, the hash of the LEAST words, and whether the text has as many."""
    more = LEAST - RUN

    def heads(side: np.ndarray, seed: int) -> np.ndarray:
        out = np.full((len(run), more + 1), seed, np.uint64)
        for i in range(more):
            x = (out[:, i] ^ side[:, i].astype(np.uint64)) * np.uint64(_BASE)
            out[:, i + 1] = x ^ (x >> np.uint64(29))
        return out

    ahead, before = heads(right[0], seed)[:, ::-1], heads(left[0], seed + 1)
    x = ((ahead * np.uint64(0xBF58476D1CE4E5B9)) ^ (ahead >> np.uint64(31))) + before
    x = (x ^ run.view(np.uint64)[:, None]) * np.uint64(0x94D049BB133111EB)
    back = np.arange(more + 1)
    return x ^ (x >> np.uint64(31)), (left[1][:, None] >= back) & (right[1][:, None] >= more - back)


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_neighbours`` and ``_Windows`` of one reading of a sorted partition."""
    windows = _Windows()

    def passing() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                windows.add(batch)
                yield batch

    for x in _neighbours(passing()):
        yield x
        yield from windows.take()
    windows.close()
    yield from windows.take()


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for spans in batch.column("found").to_pylist():
            one: list[dict] = []
            for x in sorted(spans, key=lambda x: (x["start"], x["end"], x["other"])):
                if one and x["start"] <= one[-1]["end"]:
                    one[-1]["end"] = max(one[-1]["end"], x["end"])
                    one[-1]["other"] = min(one[-1]["other"], x["other"])
                else:
                    one.append(dict(x))
            out.append([{**x, "other": None if x["other"] == _NONE else x["other"]} for x in one])
        ids = pa.array([None if x == _NONE else x for x in batch.column("doc_id").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                ids, batch.column("h"),
                pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("other", pa.int64())]))),
            ],
            ["doc_id", "h", "spans"],
        )


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, h (XXH64 of the text) and spans (start and end as word numbers, end exclusive, and the doc_id of another
    document with words of it) of every document that shares a passage of at least 50 words with another one."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NONE)).alias("doc_id"), text_hash().alias("h"), "text")
    anchors = written(rows.mapInArrow(_anchors, "doc_id long, h long, place int, run long"), "anchors")
    ends = [f(c).alias(f"{n}_{c}") for c in _DOC for n, f in (("min", F.min), ("max", F.max))]
    several = "min_doc_id != max_doc_id or min_h != max_h"
    shared = written(anchors.groupBy("run").agg(F.count(F.lit(1)).alias("n"), *ends).filter(several).select("run", "n"), "shared")
    kept = join_keys(anchors, shared, ["run"], "n").groupBy(*_DOC).agg(F.collect_set(F.struct("place", "run")).alias("found"))
    sided = rows.join(kept, _DOC).mapInArrow(_contexts, "run long, next long, right binary, left binary, doc_id long, h long, place int")
    # A number of ranges by rows: joined by bytes, ranges of copies, which compress well, would hold many times the others' rows.
    n_rows = shared.agg(F.sum("n")).first()[0] or 0
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // RANGE))
    array = sided.repartitionByRange(ranges, "run", "next", "doc_id", "place").sortWithinPartitions(*_COLUMNS).select(*_COLUMNS)
    found = written(array.mapInArrow(_searched, _FOUND), "found")
    cut_off = found.filter("window is not null").select("window", "window2", *_DOC, "start", "end")
    held = cut_off.groupBy("window", "window2").agg(*ends).filter(several)
    joined = cut_off.join(held, ["window", "window2"]).select(
        *_DOC, "start", "end",
        F.when(F.col("min_doc_id") != F.col("doc_id"), F.col("min_doc_id")).otherwise(F.col("max_doc_id")).alias("other"),
    )
    near = found.filter("window is null").select(*_DOC, "start", "end", "other")
    matches = near.unionByName(joined).select(*_DOC, F.struct("start", "end", "other").alias("m")).distinct()
    return matches.groupBy(*_DOC).agg(F.collect_list("m").alias("found")).mapInArrow(
        _united, "doc_id long, h long, spans array<struct<start:int,end:int,other:long>>",
    )


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans; each goes with the white space after it."""
    import re

    words = [m for m in re.finditer(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text)]
    head = text[: words[0].start()] if words else text
    return head + "".join(w[0] for i, w in enumerate(words) if not any(a <= i < b for a, b in spans))

"""Op 12. Vector code compression: product codes, with nearest entries found in a vantage-point tree for each part.

Components become integers, floor(``scale`` * x), and vectors are cut into equal parts. A part position's codebook starts
as that part of the vectors with the smallest ids; each round assigns every part to its nearest entry (squared Euclidean
distance, ties to the lower index) and replaces each entry by the floor of its parts' mean; unused entries stay.

A part position's entries form a vantage-point tree: a node's entry is the vantage point, the others go to the near or
the far half by their distance from it. A search carries the best entry so far and skips a half only if no point of it
can be as near: distances are rounded outward (the root of a squared distance lies between its integer root and that
plus one), so the bound is never too large, and a half whose bound equals the best distance is visited, since its entry
may have a lower index. Distances that decide are integers. Searches run over whole Arrow batches at once.

Integer vectors are written once. A round reads them, adds up counts and sums in each task, and shuffles one row for each
task, part and entry; what comes to the driver are the entries (parts x entries x part length numbers), however many
vectors there are. Sums over labels are aggregated before they are shuffled and joined back by ``join_keys``, so a label
with a third of the rows is joined where its rows lie.

Rows: vectors that are null or hold null, NaN or infinite components are left out, and so are those of another length
than the one with the smallest id (only vectors of one length have parts in common). Ties in vec_id are ordered by the
vectors; null ids come last. Repeated rows are vectors of their own; with fewer vectors than entries the codebook has so
many entries. Null labels are one label. Components so large that squared distances leave 64 bits are an error. An empty
table gives an empty result with a hash of no entries. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm._common import discard, join_keys, written

LEAF = 4  # entries of a node that isn't split


def squared(points: np.ndarray, entry: np.ndarray) -> np.ndarray:
    d = points - entry
    return np.einsum("ij,ij->i", d, d)


def roots(d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Integers not above and not below the square roots of d (int64); both are the root only where it is exact."""
    low = np.sqrt(d.astype(np.float64)).astype(np.int64)
    low -= low * low > d
    low += (low + 1) * (low + 1) <= d
    return low, low + (low * low < d)


class Tree:
    """A vantage-point tree over the rows of ``entries`` (int64)."""

    def __init__(self, entries: np.ndarray, own: np.ndarray | None = None) -> None:
        own = np.arange(len(entries)) if own is None else own
        self.entries, self.own, self.halves = entries, own, []
        if len(own) <= LEAF:
            return
        self.own, rest = own[:1], own[1:]
        d = squared(entries[rest], entries[own[0]])
        order = np.argsort(d, kind="stable")
        for half in (order[: len(order) // 2], order[len(order) // 2 :]):
            low, high = roots(d[half])
            self.halves.append((int(low.min()), int(high.max()), Tree(entries, rest[half])))

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (ties: the lowest) and its squared distance, for each point."""
        best = np.full(len(points), np.iinfo(np.int64).max)
        which = np.full(len(points), len(self.entries))
        self._visit(points, np.arange(len(points)), best, which)
        return which, best

    def _visit(self, points: np.ndarray, rows: np.ndarray, best: np.ndarray, which: np.ndarray) -> None:
        if not len(rows):
            return
        here = points[rows]
        for e in self.own:
            d = squared(here, self.entries[e])
            better = (d < best[rows]) | ((d == best[rows]) & (e < which[rows]))
            best[rows[better]], which[rows[better]] = d[better], e
        if not self.halves:
            return
        low, high = roots(d)  # of the distance from the vantage point
        bounds = [np.maximum(np.maximum(low - most, least - high), 0) for least, most, _ in self.halves]
        first = bounds[0] <= bounds[1]  # the half whose bound is smaller goes first
        for order in (0, 1):
            for half, (_, _, tree) in enumerate(self.halves):
                mine = first == (half == order)
                reach = bounds[half] * bounds[half] <= best[rows]  # not strict: an equal distance may have a lower index
                tree._visit(points, rows[mine & reach], best, which)


def _trees(books: np.ndarray) -> list[Tree]:
    return [Tree(b) for b in books]


def _parts(batch: pa.RecordBatch, n: int, width: int) -> np.ndarray:
    """Parts of a batch's vectors: (part, row, position)."""
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return flat.reshape(batch.num_rows, n, width).transpose(1, 0, 2)


def integers(vectors: DataFrame, parts: int = 8, scale: int = 4096) -> tuple[DataFrame, int]:
    """(vec_id, label, none, v) of every vector that stays, written; v holds the integers. And a vector's length."""
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).filter(e.isNotNull() & ~bad)
    least = sound.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select(F.size("embedding").alias("n")).limit(1).collect()
    length = least[0].n if least else parts
    if length % parts or not length:
        raise ValueError(f"vectors of {length} components can't be cut into {parts} equal parts")
    most = isqrt((1 << 60) // length)
    whole = lambda x: F.when(
        F.abs(x * scale) <= most, F.floor(x * scale),
    ).otherwise(F.raise_error(F.lit(f"a component times {scale} is above {most}: squared distances would leave 64 bits")).cast("long"))
    rows = sound.filter(F.size("embedding") == length).select(
        "vec_id", F.coalesce("label", F.lit("")).alias("label"), F.col("label").isNull().alias("none"), F.transform("embedding", whole).alias("v"),
    )
    return written(rows, "integers"), length


def codebooks(rows: DataFrame, length: int, parts: int = 8, entries: int = 16, rounds: int = 6) -> np.ndarray:
    """Entries (part, entry, position) after the rounds."""
    width = length // parts
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    books = np.array([r.v for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)
    schema = "part int, entry int, n long, position int, s long"

    def sums(books: np.ndarray):  # noqa: ANN202
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees, total = _trees(books), np.zeros(books.shape, np.int64)
            count = np.zeros(books.shape[:2], np.int64)
            for batch in batches:
                for p, points in enumerate(_parts(batch, parts, width)):
                    which, _ = trees[p].nearest(np.ascontiguousarray(points))
                    count[p] += np.bincount(which, minlength=books.shape[1])
                    np.add.at(total[p], which, points)
            part, entry, position = (x.ravel() for x in np.indices(books.shape))
            used = np.repeat(count.ravel() > 0, width)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[used], pa.int32()), pa.array(entry[used], pa.int32()), pa.array(np.repeat(count.ravel(), width)[used]),
                    pa.array(position[used], pa.int32()), pa.array(total.ravel()[used]),
                ],
                ["part", "entry", "n", "position", "s"],
            )

        return work

    for _ in range(rounds if len(first) else 0):
        found = rows.select("v").mapInArrow(sums(books), schema).groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        books = books.copy()
        for r in found.collect():  # one row for each number of the codebooks
            books[r.part, r.entry, r.position] = r.s // r.n
    return books


def fingerprint(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(rows: DataFrame, books: np.ndarray, length: int) -> DataFrame:
    """vec_id, label, none, code (bytes, one for each part: the entry's index) and error of every vector."""
    parts, width = len(books), length // len(books)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = _trees(books)
        for batch in batches:
            codes, error = np.zeros((batch.num_rows, parts), np.uint8), np.zeros(batch.num_rows, np.int64)
            for p, points in enumerate(_parts(batch, parts, width)):
                which, d = trees[p].nearest(np.ascontiguousarray(points))
                codes[:, p], error = which, error + d
            fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(parts), batch.num_rows, [None, pa.py_buffer(codes.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("none"), fixed.cast(pa.binary()), pa.array(error)],
                ["vec_id", "label", "none", "code", "error"],
            )

    return rows.mapInArrow(work, "vec_id long, label string, none boolean, code binary, error long")


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> tuple[DataFrame, np.ndarray]:
    """Codes of all sound vectors (vec_id, label, none, code, error, label_error), and the codebooks they refer to."""
    if not 0 < entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    rows, length = integers(vectors, parts, scale)
    books = codebooks(rows, length, parts, entries, rounds)
    if not books.size:
        return rows.selectExpr("vec_id", "label", "none", "cast(null as binary) code", "0L error", "0L label_error"), books
    coded = written(encode(rows, books, length), "codes")
    discard(rows)
    labels = written(coded.groupBy("none", "label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "labels")
    return join_keys(coded, labels, ["none", "label"], "n").drop("n"), books


def decode(code: bytes, books: np.ndarray, scale: int = 4096) -> np.ndarray:
    """The vector that a code stands for."""
    return np.concatenate([b[i] for b, i in zip(books, code, strict=True)]) / scale


def sql(table: str, length: int, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The same codes as DuckDB SQL, each round a step; for vectors of the given length."""
    width = length // parts
    steps = [
        f"""k AS MATERIALIZED (
            SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM {table}
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS MATERIALIZED (
            SELECT vec_id, s.p AS part, v[s.p * {width} + 1 : s.p * {width} + {width}] AS w FROM k, (SELECT unnest(range({parts})) AS p) s),
        b0 AS MATERIALIZED (
            SELECT part, e, w FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k ORDER BY vec_id LIMIT {entries}) USING (vec_id))"""
    ]
    far = "list_sum(list_transform(list_zip(p.w, b.w), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    for i in range(rounds + 1):
        steps.append(
            f"a{i} AS MATERIALIZED (SELECT p.vec_id, p.part, min((({far}), b.e)) AS m FROM p JOIN b{i} b USING (part) GROUP BY p.vec_id, p.part)"
        )
        if i < rounds:
            steps.append(f"""s{i} AS MATERIALIZED (
                SELECT part, e, i, sum(x)::BIGINT AS s, count(*) AS n
                FROM (SELECT p.part, m[2] AS e, unnest(p.w) AS x, unnest(range({width})) AS i FROM p JOIN a{i} USING (vec_id, part)) GROUP BY ALL),
            m{i} AS MATERIALIZED (SELECT part, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS w FROM s{i} GROUP BY part, e),
            b{i + 1} AS MATERIALIZED (SELECT part, e, coalesce(m.w, b.w) AS w FROM b{i} b LEFT JOIN m{i} m USING (part, e))""")
    steps.append(f"""c AS (
        SELECT vec_id, string_agg(lpad(lower(hex(m[2]::UTINYINT)), 2, '0'), '' ORDER BY part) AS code, sum(m[1])::BIGINT AS error FROM a{rounds} GROUP BY vec_id),
        h AS (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM b{rounds})""")
    return "WITH " + ",\n        ".join(steps) + """
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM c JOIN k USING (vec_id), h"""

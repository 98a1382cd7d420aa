"""Op 2. SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 2r bits have a common variant within r bits of both. Every distinct
fingerprint therefore stands for all its variants (2081 of them for r = 2), and fingerprints that share one collide.

The variants are shuffled by their leading bits (``region``): a fingerprint goes once to each region that holds a
variant of its, 1 + b + b(b-1)/2 rows instead of 2081, and the region's task writes out the variants that fall there.
b grows with the logarithm of the number of distinct fingerprints; a region with more of them than ``CELL`` is split by
a hash of the variant's other bits that is linear over bit flips, so the variants even of nearly equal fingerprints
spread evenly. Colliding fingerprints are verified by their Hamming distance and linked to the least of them (all that
share a variant are within 2r bits of each other), each task hands on a spanning forest, and components of that graph
are found by star rounds. Fingerprints are distinct before all this, so copies cost nothing; no group is written as pairs.

Rows: null text is a text with no words, of fingerprint zero. A very long text is read whole, by the task that has its row.
Ties, rows with one doc_id, are rows of their own; ``dedup`` keeps one of those that agree in doc_id and text. Other columns
are kept as they are by ``dedup``, whatever their names, and not read otherwise. Null doc_id gets a fingerprint and a component like any
row; a component of null doc_ids alone has a null id. Repeated rows stay. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm._common import keep_rows, slices, written
from tidewell.llm.components import components

BITS = 64
CELL = 1024  # fingerprints of a region, about, whose variants one task writes out at a time


def shingle_hashes(text: bytes, words: int = 4) -> list[int]:
    """XXH64 (seed 42) of every shingle of ``words`` words in a row, A-Z in lower case, joined by a space."""
    from xxhash import xxh64_intdigest as h

    parts = text.lower().split()
    joined = b" ".join(parts)
    if len(parts) <= words:
        return [h(joined, 42)] if parts else []
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate([[0], ends[:-words]])
    return [h(joined[a:b], 42) for a, b in zip(starts.tolist(), (ends[words - 1 :] - 1).tolist(), strict=True)]


def fingerprint(hashes: list[int]) -> int:
    """A bit is 1 if it is set in over half of the hashes."""
    if not hashes:
        return 0
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 65_536):
        part = np.array(hashes[i : i + 65_536], ">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) and h (XXH64 of the text) of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch, texts in slices(batches):
            fps = np.array([fingerprint(shingle_hashes(t, words)) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(fps),
                    pa.array(np.array([xxh64_intdigest(t, 42) for t in texts], np.uint64).view(np.int64)),
                ],
                ["doc_id", "fp", "h"],
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(work, "doc_id long, fp long, h long")


@lru_cache(maxsize=64)
def masks(bits: int, most: int) -> np.ndarray:
    """All masks of up to ``most`` of the ``bits`` low bits, fewest first (uint64)."""
    return np.array([sum(1 << i for i in c) for k in range(most + 1) for c in combinations(range(bits), k)], np.uint64)


def _codes(bits: int) -> np.ndarray:
    """A 16-bit code for each low bit; the XOR of the codes of a number's bits is a hash that is linear over flips."""
    return np.random.default_rng(64).integers(1, 1 << 16, bits, dtype=np.uint64)


def _linear(values: np.ndarray, codes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values), np.uint64)
    for i, c in enumerate(codes):
        out ^= np.where((values >> np.uint64(i)) & np.uint64(1), c, np.uint64(0))
    return out


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node that it is linked with, over any number of edges."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def cell_links(fps: np.ndarray, region: int, sub: int, splits: int, b: int, radius: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the fingerprints (uint64, distinct) that collide in the variants of one cell."""
    low = BITS - b
    codes = _codes(low)
    flips = np.bitwise_count((fps >> np.uint64(low)) ^ np.uint64(region))
    bodies = fps & np.uint64((1 << low) - 1)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for d in range(radius + 1):
        own = np.flatnonzero(flips == d)
        m = masks(low, radius - d)
        if splits == 1 or not len(own):
            parts.append((own, m))
            continue
        part = np.uint64(splits - 1)
        of_mask, of_body = _linear(m, codes) & part, _linear(bodies[own], codes) & part
        parts += [(own[of_body == x], m[of_mask == x ^ np.uint64(sub)]) for x in np.unique(of_body)]
    # The variant, hashed to 40 bits, above its owner: one plain sort brings colliding owners together.
    joined, at = np.empty(sum(len(who) * len(which) for who, which in parts), np.uint64), 0
    for who, which in parts:
        for i in range(0, len(who), 256):
            owners = who[i : i + 256]
            block = (bodies[owners][:, None] ^ which) * np.uint64(0x9E3779B97F4A7C15)
            block &= ~np.uint64((1 << 24) - 1)
            block |= owners.astype(np.uint64)[:, None]
            joined[at : at + block.size] = block.ravel()
            at += block.size
    joined.sort()
    same = (joined[1:] ^ joined[:-1]) < np.uint64(1 << 24)
    inside = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
    owner, bucket = (joined[inside] & np.uint64((1 << 24) - 1)).astype(np.int64), joined[inside] >> np.uint64(24)
    del joined
    if not len(owner):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    begins = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    which = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(owner))))
    first = owner[begins][which]
    near = np.bitwise_count(fps[owner] ^ fps[first]) <= 2 * radius
    edges = [np.unique((first << 24 | owner)[near])]
    for k in np.unique(which[~near]):  # variants that differ but hash alike: every pair of such a bucket is compared
        here = np.unique(owner[which == k])
        for x in here:
            edges.append(np.int64(x) << 24 | here[np.bitwise_count(fps[here] ^ fps[x]) <= 2 * radius])
    edges = np.concatenate(edges)
    label = _forest(len(fps), edges >> 24, edges & ((1 << 24) - 1))
    linked = np.flatnonzero(label != np.arange(len(fps)))
    return fps[linked], fps[label[linked]]


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of ``distinct`` fp within 2 * radius bits."""
    spark = distinct.sparkSession
    n = distinct.count()
    b = min(16, max(6, int(np.ceil(np.log2(max(n, 1) / CELL)))))
    low = BITS - b
    tops = masks(b, radius)
    # At most 2^b counts come to the driver (b at most 16), whatever the number of documents.
    own = np.zeros(1 << b, np.int64)
    for r, c in distinct.groupBy(F.shiftrightunsigned("fp", low).alias("r")).count().collect():
        own[r] = c
    sizes = [len(masks(low, radius - d)) for d in range(radius + 1)]
    load = sum(own[np.arange(1 << b) ^ int(t)] * sizes[int(t).bit_count()] for t in tops) / sizes[0]
    splits = (1 << np.maximum(0, np.ceil(np.log2(np.maximum(load, 1) / CELL))).astype(np.int64)).clip(1, 1 << 16)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _codes(low)
        for batch in batches:
            all_fps = batch.column("fp").to_numpy().view(np.uint64)
            for at in range(0, len(all_fps), 4096):
                fps = all_fps[at : at + 4096]
                linear = _linear(fps & np.uint64((1 << low) - 1), codes).astype(np.int64)
                cells, owners = [], []
                for t in tops:
                    region = (fps >> np.uint64(low)).astype(np.int64) ^ int(t)
                    s = splits[region]
                    if int(t).bit_count() == radius:  # one variant, in one part
                        cells.append(region << 16 | linear & (s - 1))
                        owners.append(fps)
                    else:
                        first = np.repeat(np.cumsum(s) - s, s)
                        cells.append(np.repeat(region << 16, s) | (np.arange(len(first)) - first))
                        owners.append(np.repeat(fps, s))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(cells)), pa.array(np.concatenate(owners).view(np.int64))], ["cell", "fp"],
                )

    def meet(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        cell = key[0].as_py()
        fps = np.unique(group.column("fp").to_numpy().view(np.uint64))
        x, y = cell_links(fps, cell >> 16, cell & 0xFFFF, int(splits[cell >> 16]), b, radius)
        return pa.table({"a": x.view(np.int64), "b": y.view(np.int64)})

    del spark
    return distinct.select("fp").mapInArrow(emit, "cell long, fp long").groupBy("cell").applyInArrow(meet, "a long, b long")


def near_classes(docs: DataFrame, words: int = 4, radius: int = 2) -> DataFrame:
    """doc_id, fp, h, root (least fp of the component) and component_id (least doc_id reachable over links of at most
    2 * radius bits) of every row."""
    prints = written(fingerprints(docs, words), "prints")
    least = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "least")
    roots = components(links(least.select("fp"), radius))
    rooted = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.join(groups, "root").select("fp", "root", "component_id"), "fp")


def dedup(docs: DataFrame, words: int = 4, radius: int = 2) -> DataFrame:
    """The row with the least doc_id of each component, with all its columns."""
    rows = written(near_classes(docs, words, radius).groupBy("root", "doc_id", "h").agg(F.count(F.lit(1)).alias("n")), "classes")
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("first"))
    marks = rows.join(first, "root").withColumn(
        "keep", (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("h") == F.col("first.h"))).cast("int"),
    )
    return keep_rows(docs, written(marks.filter("n > keep").select("doc_id", "h", "keep"), "marks"))

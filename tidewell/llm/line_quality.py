"""Op 5. Quality rules by cross-document line frequency.

Lines are normalised (lower case, digits to 0, white space joined) and hashed. For every host (``source``) the distinct
documents of a line are counted; a line above the limits is boilerplate and is removed, and a document that loses most
of its words is depleted and rejected. So are documents that fail the base rules (few words, much repetition).

A text counts once for a host however many rows hold it, so exact copies never make their lines frequent. Nothing else is
taken out of the counts: texts that differ are distinct documents, however alike they are, and a block of lines is
boilerplate whatever else its documents hold.

Texts are read once; what leaves the reading pass is a hash and a word count for each line. Counts are partially
aggregated before each shuffle, and frequent lines that many documents hold are joined where their rows lie, so a line of
a third of all documents is one row of each task.

Rows: null text has no words and fails the base rules. A very long text is measured whole, line by line. Null source is a host like others, null doc_id a document like
others; repeated rows all get the same verdict. An empty table gives an empty result. Other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm._common import join_keys, row_of, slices, text_hash, words_of, written

MIN_DOCS = 12  # a line of fewer distinct documents of a host is never boilerplate,
MIN_SHARE = 0.01  # nor one of a smaller share of the host's documents
DEPLETED = 0.3  # a document that keeps a smaller share of its words is rejected
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of words in repeated windows of three

_NORMAL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def line_hash(line: bytes) -> int:
    """Signed 64-bit hash of a normalised line."""
    from xxhash import xxh3_64_intdigest

    h = xxh3_64_intdigest(b" ".join(line.translate(_NORMAL).split()))
    return h - (1 << 64) if h >> 63 else h


def repeated_words(codes: np.ndarray) -> int:
    """Words that lie in a window of three words which the text has twice or more."""
    if len(codes) < 4:
        return 0
    base = np.int64(codes.max()) + 1
    pairs = codes[:-1].astype(np.int64) * base + codes[1:]
    if base >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, inverse, counts = np.unique(pairs[:-1] * base + codes[2:], return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    covered = np.zeros(len(codes), bool)
    for i in range(3):
        covered[i : i + len(twice)] |= twice
    return int(covered.sum())


_MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SCHEMA = "row long, doc_id long, host string, text_hash long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<long>, words array<int>"


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    from xxhash import xxh64_intdigest

    row = TaskContext.get().partitionId() << 33
    for batch, texts in slices(batches):
        codes, _, ends = words_of(texts)
        raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        stops = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
        count = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[stops])  # noqa: E731, B023
        chars, symbols = count(~_SPACE[raw] & ((raw & 0xC0) != 0x80)), count(_SYMBOL[raw])
        dups, repeats, hashes, lines, words = [], [], [], [], []
        for i, t in enumerate(texts):
            own = [x for x in t.split(b"\n") if x.strip()]
            dups.append(len(own) - len(set(own)))
            repeats.append(repeated_words(codes[ends[i] : ends[i + 1]]))
            hashes.append(xxh64_intdigest(t, 42))
            seen: dict[int, int] = {}
            for x in own:
                h = line_hash(x)
                seen[h] = seen.get(h, 0) + len(x.split())
            lines.append(list(seen))
            words.append(list(seen.values()))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(row, row + len(texts))), batch.column("doc_id"), batch.column("host"),
                pa.array(np.array(hashes, np.uint64).view(np.int64)), pa.array(np.diff(ends)), pa.array(chars),
                pa.array(symbols), pa.array(dups, pa.int64()), pa.array(repeats, pa.int64()),
                pa.array(lines, pa.list_(pa.int64())), pa.array(words, pa.list_(pa.int32())),
            ],
            ["row", "doc_id", "host", "text_hash", *_MEASURES, "lines", "words"],
        )
        row += len(texts)


def _host() -> list[Column]:
    """The host without null, and whether it is null: keys that can be joined by equality."""
    return [F.coalesce("host", F.lit("")).alias("host_key"), F.col("host").isNull().alias("no_host")]


def frequent_lines(measured: DataFrame, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> DataFrame:
    """(host_key, no_host, line, n_docs) of every line above the limits."""
    texts = measured.select(*_host(), "text_hash", "lines").dropDuplicates(["host_key", "no_host", "text_hash"])
    hosts = texts.groupBy("host_key", "no_host").agg(F.count(F.lit(1)).alias("host_docs"))
    counts = texts.select("host_key", "no_host", F.explode("lines").alias("line")).groupBy("host_key", "no_host", "line").agg(
        F.count(F.lit(1)).alias("n_docs"),
    ).filter(F.col("n_docs") >= min_docs)
    return counts.join(hosts, ["host_key", "no_host"]).filter(F.col("n_docs") >= min_share * F.col("host_docs")).drop("host_docs")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def judge(
    docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE,
    depleted: float = DEPLETED,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, host, text_hash (XXH64, seed 42), the measures, base_failed,
    removed_words (in frequent lines), removed (those lines' hashes, null for none) and kept."""
    measured = written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), "text",
        ).mapInArrow(_measured, _SCHEMA),
        "measured",
    )
    frequent = written(frequent_lines(measured, min_docs, min_share), "frequent")
    lines = measured.select("row", *_host(), F.explode(F.arrays_zip("lines", "words")).alias("x")).select(
        "row", "host_key", "no_host", F.col("x.lines").alias("line"), F.col("x.words").alias("n"),
    )
    hits = join_keys(lines, frequent, ["host_key", "no_host", "line"], "n_docs")
    lost = hits.groupBy("row").agg(F.sum("n").alias("removed_words"), F.collect_list("line").alias("removed"))
    out = measured.drop("lines", "words").join(lost, "row", "left").withColumn(
        "removed_words", F.coalesce("removed_words", F.lit(0).cast("long")),
    )
    rich = F.col("n_words") - F.col("removed_words") >= depleted * F.col("n_words")
    return out.select(
        "doc_id", "host", "text_hash", *_MEASURES, base_failed().alias("base_failed"), "removed_words", "removed",
        (~base_failed() & rich).alias("kept"),
    )


def clean(docs: DataFrame, host: str = "source", **limits: float) -> DataFrame:
    """``docs`` without rejected documents and without frequent lines; same columns (``n_chars`` follows the text)."""
    verdicts = judge(docs, host, **limits).filter(~F.col("kept") | F.col("removed").isNotNull())
    changes = written(
        verdicts.groupBy("doc_id", "host", "text_hash").agg(F.first("kept").alias("kept"), F.first("removed").alias("removed")),
        "changes",
    )
    rows = docs.select(row_of(docs), text_hash().alias("h")).alias("r")
    same = F.col("r.row.doc_id").cast("long").eqNullSafe(F.col("c.doc_id")) & F.col(f"r.row.{host}").cast("string").eqNullSafe(F.col("c.host")) & (
        F.col("r.h") == F.col("c.text_hash")
    )
    joined = rows.join(changes.alias("c"), same, "left").filter(F.coalesce("c.kept", F.lit(True))).select(
        "r.row", F.col("c.removed").alias("removed"),
    )
    columns, counted = docs.columns, "n_chars" in docs.columns

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = dict(zip(columns, batch.column("row").flatten(), strict=True))
            texts = kept["text"].to_pylist()
            for i, gone in enumerate(batch.column("removed").to_pylist()):
                if gone:
                    gone = set(gone)
                    texts[i] = "\n".join(x for x in texts[i].split("\n") if not x.strip() or line_hash(x.encode()) not in gone)
            kept["text"] = pa.array(texts, kept["text"].type)
            if counted:
                kept["n_chars"] = pc.coalesce(pc.utf8_length(kept["text"]).cast(kept["n_chars"].type), kept["n_chars"])
            yield pa.RecordBatch.from_arrays(list(kept.values()), columns)

    return joined.mapInArrow(strip, docs.schema)

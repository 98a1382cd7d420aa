"""Op 6. Language identification by compression.

Each language has a raw-content zstandard dictionary made of sampled training texts. A text is cut into pieces of
``PIECE`` bytes, every piece is compressed with every language's dictionary, and the language with the smallest sum
wins. The score is its margin over the runner-up, scaled to 0..1; where it is narrow the prediction is marked rejected.

Training: of each language the ``per_lang`` texts with the least hash of their text (a bounded sample; the bound is a
parameter); each gives its middle, so that all together fill the dictionary: the cut is by text. Only texts and
languages are learned from. The dictionaries (at most ``dict_bytes`` for each language) go to the tasks with the
function; prediction is one pass with no shuffle.

Rows: null text or a text without a letter is ``und`` with score 0. A very long text is compressed whole, piece by piece.
Null lang isn't learned from; null doc_id counts as not held out. If nothing can be learned from, every text is ``und``.
Of equal sizes the language with more texts wins. Repeated rows stay; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm._common import slices, written

PIECE = 1024
LEVEL = 6
NARROW = 0.01  # of the runner-up's size


def held_out() -> Column:
    """crc32 of doc_id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(training: DataFrame, per_lang: int = 400, dict_bytes: int = 112 * 1024) -> dict[str, bytes]:
    """Dictionary content for each language of ``training`` (text, lang), from at most ``per_lang`` texts of each; the most
    frequent language first, which wins ties."""
    rows = training.filter("lang is not null and length(text) > 0").select("lang", "text", F.xxhash64("text").alias("h"))
    # Hashes first, so that the sort of the sample carries no texts. Of a language with many texts only hashes below a
    # bound go to its window: four times per_lang of them are expected, so per_lang of them are there.
    hashes = written(rows.select("lang", "h").distinct(), "hashes")
    counts = hashes.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    part = F.least(F.lit(1.0), 4.0 * max(per_lang, 100) / F.col("n"))
    few = hashes.join(F.broadcast(counts), "lang").filter((F.col("h") / F.lit(2.0**64) + 0.5) <= part).drop("n")
    least = few.withColumn("i", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("i") <= per_lang).drop("i")
    # A text gives its middle, as much as is its share of the dictionary: dict_bytes for each language come to the driver.
    least = least.withColumn("share", F.ceil(F.lit(dict_bytes) / F.count("h").over(Window.partitionBy("lang"))).cast("int"))
    middle = F.substring("text", F.greatest(F.lit(1), ((F.length("text") - F.col("share")) / 2).cast("int") + 1), F.col("share"))
    found = rows.join(
        F.broadcast(least), ["lang", "h"],
    ).select("lang", "h", middle.alias("text")).groupBy("lang", "h").agg(F.min("text").alias("text")).orderBy("lang", "h").collect()
    texts: dict[str, list[bytes]] = {}
    for r in found:
        texts.setdefault(r.lang, []).append(r.text.lower().encode())
    ranks = [r.lang for r in training.filter("lang is not null").groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()]  # a row for each language
    return {k: b" ".join(texts[k])[-dict_bytes:] for k in ranks if k in texts}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        import zstandard as z

        self.langs = list(dictionaries)
        self.coders = []
        for k in self.langs:
            d = z.ZstdCompressionDict(dictionaries[k], dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.coders.append(z.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False).compress)

    def sizes(self, text: bytes) -> list[int]:
        return [sum(len(c(text[i : i + PIECE])) for i in range(0, len(text), PIECE)) for c in self.coders]

    def predict(self, text: bytes) -> tuple[str, float]:
        s = text.decode("utf-8", "replace").lower()
        if not self.langs or not any(map(str.isalpha, s)):
            return "und", 0.0
        ranked = sorted(zip(self.sizes(s.encode()), self.langs, strict=True), key=lambda x: x[0])
        if len(ranked) == 1:
            return ranked[0][1], 1.0
        return ranked[0][1], 1 - ranked[0][0] / ranked[1][0]


def identify(docs: DataFrame, dictionaries: dict[str, bytes], narrow: float = NARROW) -> DataFrame:
    """doc_id, lang_pred, score and rejected (a narrow margin, or no letter) of every row of ``docs`` (doc_id, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = Classifier(dictionaries).predict
        for batch, texts in slices(batches):
            langs, scores = zip(*map(predict, texts), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs), pa.array(scores), pa.array([s < narrow for s in scores])],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        work, "doc_id long, lang_pred string, score double, rejected boolean",
    )

"""Op 13. Phrase collocation mining by contiguous pattern growth from prefixes (PrefixSpan on words that stand together).

Texts are lower-cased (A-Z), cut into pieces at punctuation and line breaks, and pieces into words. Words are counted by
language. Then every occurrence of a word is projected: it goes, with the words to its right in its piece, to the task of
its prefix. There a frequent prefix is extended to the right by each next word, from the pointers to its occurrences
only, and the extensions are grown in turn; what isn't frequent is not grown any further. A task of the shuffle holds a
cell of prefixes, which are grown together. A phrase's score is the least, over its cuts, of 1,000,000 a² / (l r), with
the frequencies of the whole and of the two parts; phrases that a longer one mostly explains are dropped.

Skew and memory: equal occurrences within a stretch of text (``STRETCH`` bytes) are one pointer with a count before they
are shuffled. A cell holds about ``CELL`` occurrences; a prefix with more is spread over cells by the words to its right,
so its longest phrases are whole in one cell, and the counts of its shorter ones are added up afterwards (unpruned until
then). There are at most 2^21 such prefixes, whatever the size of the corpus (CELL rises with it), and they are known by
a 64-bit hash, eight bytes each: two words with one hash are spread alike, and nothing else depends on hashes.
Frequencies are joined to the cuts by ``join_keys``. Of each language only the first ``top`` phrases of each of many parts
meet in one task.

Rows: null text has no words; null language is ``und``, as is a language of that name. A very long text is one stretch.
Repeated rows count as often as they stand there. Ties in the ranking go to more frequent phrases, then to the smaller in
byte order. An empty table gives an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm._common import give_back, join_keys, slices, written

CELL = 1 << 18  # occurrences of a cell, about
MOST_SPREAD = 21  # at most 2^21 prefixes are spread
STRETCH = 16_000_000

#: A-Z to lower case; what ends a piece becomes a line break and a tab a space.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _words(raw: bytes) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Of folded text: a code for each word, the distinct words, each word's line and where it begins."""
    chars = np.frombuffer(raw, np.uint8)
    breaks = chars == 10
    inside = ~breaks & (chars != 32)
    edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(begins):
        return np.zeros(0, np.int64), pa.array([], pa.large_binary()), np.zeros(0, np.int64), begins
    line = np.cumsum(breaks)[begins]
    lengths = ends - begins
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    coded = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(chars[inside])],
    ).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, line, begins


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, pa.Array, np.ndarray]]:
    """Stretches of text by language: language, word codes, distinct words and each word's piece."""
    for batch, texts in slices(batches, size=STRETCH):
        langs = np.array(batch.column("lang").to_pylist(), object)
        for lang in dict.fromkeys(langs):
            own = b"\n".join(t for t, x in zip(texts, langs, strict=True) if x == lang).translate(_FOLD)
            codes, distinct, piece, _ = _words(own)
            if len(codes):
                yield lang, codes, distinct, piece


def _hashes(lang: str, words: pa.Array) -> np.ndarray:
    """64-bit hashes of the words in that language."""
    from xxhash import xxh3_64_intdigest

    seed = xxh3_64_intdigest(lang)
    return np.fromiter((xxh3_64_intdigest(w, seed) for w in words.to_pylist()), np.uint64, len(words))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, codes, distinct, _ in _stretches(batches):
        h = _hashes(lang, distinct).view(np.int64)
        n = np.bincount(codes, minlength=len(distinct))
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), distinct.cast(pa.binary()), pa.array(h), pa.array(n)], ["lang", "word", "h", "f"])


def _windows(codes: np.ndarray, piece: np.ndarray, n_words: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (word, next words within the piece) as a matrix of codes, -1 for none, and how often each occurs."""
    columns = np.full((longest, len(codes)), -1, np.int64)
    for k in range(longest):
        columns[k, : len(codes) - k] = codes[k:]
        columns[k, : len(codes) - k][piece[k:] != piece[: len(piece) - k]] = -1
        if k:
            columns[k, len(codes) - k :] = -1
    key, size = columns[0], n_words
    for c in columns[1:]:
        if size >= (1 << 62) // (n_words + 1):
            found, key = np.unique(key, return_inverse=True)
            size = len(found)
        key, size = key * (n_words + 1) + c + 1, size * (n_words + 1)
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    return columns[:, first], counts


def _spread_by(spread: tuple[np.ndarray, np.ndarray], h: np.ndarray) -> np.ndarray:
    """Over how many cells prefixes with these hashes go."""
    keys, cells = spread
    if not len(keys):
        return np.ones(len(h), np.int64)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return np.where(keys[at] == h, cells[at], 1)


def grow(
    matrix: np.ndarray, counts: np.ndarray, least: int, whole: np.ndarray, depth: int = 1,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Frequent phrases of the occurrences in ``matrix`` (a column for each, sorted by rows): (codes, frequency), from one
    word on, each length after the shorter ones. Occurrences that aren't ``whole`` belong to a prefix that other cells
    hold too: its phrases below the full length are all given, with the count found here."""
    rows = matrix[:depth]
    new = np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(axis=0)]) if rows.shape[1] else np.zeros(0, bool)
    begins = np.flatnonzero(new)
    if not len(begins):
        return
    f = np.add.reduceat(counts, begins)
    partial = ~whole[begins] & (depth < len(matrix))
    kept = (f >= least) | partial
    yield matrix[:depth, begins[kept]], f[kept]
    if depth < len(matrix):
        on = kept[np.cumsum(new) - 1] & (matrix[depth] >= 0)
        yield from grow(matrix[:, on], counts[on], least, whole[on], depth + 1)


def frequencies(docs: DataFrame, longest: int = 3, least: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, n) with all words of a language; (lang, phrase, f) of the frequent words and of the frequent longer phrases."""
    spark = docs.sparkSession
    texts = docs.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    words = texts.mapInArrow(_counted, "lang string, word binary, h long, f long")
    words = written(words.groupBy("lang", "word").agg(F.first("h").alias("h"), F.sum("f").alias("f")), "words")
    totals = written(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    total = totals.agg(F.sum("n")).first()[0] or 0
    cell = max(CELL, -(-total >> MOST_SPREAD))
    cells = max(1, -(-total // cell))
    # At most total / cell prefixes have that many occurrences: 2^21 of 16 bytes each.
    hot = words.filter(F.col("f") >= cell).groupBy("h").agg(F.max("f").alias("f")).select("h", F.ceil(F.col("f") / cell).alias("cells")).toArrow()
    h = hot.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    spread = spark.sparkContext.broadcast((h[order], hot.column("cells").to_numpy()[order]))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, codes, distinct, piece in _stretches(batches):
            matrix, counts = _windows(codes, piece, len(distinct), longest)
            hashed = _hashes(lang, distinct)
            prefix = hashed[matrix[0]]
            right = np.zeros(len(counts), np.uint64)
            for row in matrix[1:]:
                right = (right ^ np.where(row < 0, np.uint64(1), hashed[row])) * _MIX
                right ^= right >> np.uint64(29)
            over = _spread_by(spread.value, prefix)
            place = (prefix ^ (right % over.astype(np.uint64))) * _MIX
            at = ((place ^ (place >> np.uint64(32))) % np.uint64(cells)).astype(np.int64)
            sort = np.argsort(at, kind="stable")
            taken = [distinct.take(pa.array(r[sort], mask=r[sort] < 0)) for r in matrix]
            joined = pc.binary_join_element_wise(*taken, pa.scalar(b" ", pa.large_binary()), null_handling="skip")
            lines = pc.binary_join_element_wise(joined, pa.scalar(b"", pa.large_binary()), pa.scalar(b"\n", pa.large_binary()))
            own, begins = np.unique(at[sort], return_index=True)
            stops = np.append(begins, len(sort))
            offsets = np.frombuffer(lines.buffers()[1], np.int64, len(lines) + 1, lines.offset * 8)
            numbers = pa.py_buffer(counts[sort].astype("<u4"))
            binary = lambda o, buffer, n=len(own): pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), n, [None, pa.py_buffer(np.ascontiguousarray(o, np.int64)), buffer],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(own)), pa.array(own), binary(offsets[stops], lines.buffers()[2]).cast(pa.binary()),
                    binary(stops * 4, numbers).cast(pa.binary()),
                ],
                ["lang", "cell", "lines", "counts"],
            )
        give_back()

    def grown(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs, numbers = [], []
        for batch in batches:
            blobs += batch.column("lines").to_pylist()
            numbers += batch.column("counts").to_pylist()
        counts = np.frombuffer(b"".join(numbers), "<u4").astype(np.int64)
        codes, distinct, line, begins = _words(b"".join(blobs))
        del blobs, numbers
        matrix = np.full((longest, len(counts)), -1, np.int64)
        first = np.searchsorted(line, np.arange(len(counts)))  # every line has a word
        matrix[np.arange(len(line)) - first[line], line] = codes
        lang = key[0].as_py()
        order = np.lexsort(matrix[::-1])
        matrix, counts = matrix[:, order], counts[order]
        heads = np.unique(matrix[0])
        over = np.ones(len(distinct), np.int64)
        over[heads] = _spread_by(spread.value, _hashes(lang, distinct.take(pa.array(heads))))
        for found, f in grow(matrix, counts, least, over[matrix[0]] == 1):
            if len(found) > 1 and len(f):
                phrase = pc.binary_join_element_wise(*(distinct.take(pa.array(r)) for r in found), pa.scalar(b" ", pa.large_binary()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(f)), phrase.cast(pa.large_string()).cast(pa.string()), pa.array(f)], ["lang", "phrase", "f"],
                )

    cells_of = texts.mapInArrow(project, "lang string, cell long, lines binary, counts binary")
    phrases = cells_of.groupBy("lang", "cell").applyInArrow(grown, "lang string, phrase string, f long")
    phrases = phrases.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    single = words.filter(F.col("f") >= least).select("lang", F.col("word").cast("string").alias("phrase"), "f")
    return totals, single, written(phrases, "phrases")


def scored(single: DataFrame, phrases: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r and score of each phrase, by its lowest-scoring cut (ties: the first)."""
    w = F.split("phrase", " ")
    n = F.size(w)
    part = lambda a, m: F.array_join(F.slice(w, a, m), " ")
    sides = lambda k: F.array(
        F.struct(k.alias("k"), F.lit(True).alias("first"), part(F.lit(1), k).alias("part")),
        F.struct(k.alias("k"), F.lit(False).alias("first"), part(k + 1, n - k).alias("part")),
    )
    cuts = written(
        phrases.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.flatten(F.transform(F.sequence(F.lit(1), n - 1), sides))).alias("c"))
        .select("lang", "phrase", "a", "c.k", "c.first", "c.part"),
        "cuts",
    )
    known = single.unionByName(phrases).withColumnRenamed("phrase", "part")
    wanted = written(cuts.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("rows")).join(known, ["lang", "part"]), "parts")
    both = join_keys(cuts, wanted, ["lang", "part"], "rows").groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("first"), F.col("f"))).alias("l"), F.max(F.when(~F.col("first"), F.col("f"))).alias("r"),
    )
    exact = lambda c: f"cast({c} as decimal(18, 0))"
    score = F.expr(f"(cast(1000000 as decimal(7, 0)) * ({exact('a')} * {exact('a')})) div ({exact('l')} * {exact('r')})")
    return both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("m")).select(
        "lang", "phrase", "a", "m.l", "m.r", "m.score",
    )


def explained(phrases: DataFrame, longest: int, share: int = 50) -> DataFrame:
    """(lang, phrase) of those that a longer phrase holds whose frequency is ``share`` per cent of theirs, at least."""
    w = F.split("phrase", " ")
    inner = [
        F.when(F.size(w) >= a + m, F.array_join(F.slice(w, a + 1, m), " "))
        for m in range(2, longest) for a in range(longest - m + 1)
    ]
    if not inner:
        return phrases.select("lang", "phrase").limit(0)
    held = phrases.select("lang", "phrase", "f", F.explode(F.array_distinct(F.array_compact(F.array(*inner)))).alias("inner")).filter("inner != phrase")
    most = held.groupBy("lang", F.col("inner").alias("phrase")).agg(F.max("f").alias("most"))
    return phrases.join(most, ["lang", "phrase"]).filter(100 * F.col("most") >= share * F.col("f")).select("lang", "phrase")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first ``top`` phrases."""
    totals, single, phrases = frequencies(docs, longest, least)
    kept = scored(single, phrases).join(explained(phrases, longest, share), ["lang", "phrase"], "left_anti")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    place = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")
    some = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(parts))).withColumn("rank", place("lang", "salt")).filter(F.col("rank") <= top)
    first = some.drop("salt", "rank").withColumn("rank", place("lang")).filter(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def sql(table: str, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000) -> str:
    """The same phrases as DuckDB SQL."""
    grams = " UNION ALL ".join(
        f"SELECT lang, w[i : i + {m - 1}] AS g FROM (SELECT lang, w, unnest(range(1, len(w) - {m - 2})) AS i FROM p WHERE len(w) >= {m})"
        for m in range(1, longest + 1)
    )
    return rf"""
        WITH t AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS s
            FROM {table}),
        p AS MATERIALIZED (SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') AS w FROM t),
        n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
        f AS MATERIALIZED (SELECT lang, g, count(*) AS f FROM ({grams}) GROUP BY ALL HAVING count(*) >= {least}),
        c AS (
            SELECT f.lang, f.g, f.f AS a, x.f AS l, y.f AS r, k, ((1000000::HUGEINT * f.f * f.f) // (x.f::HUGEINT * y.f))::BIGINT AS score
            FROM (SELECT *, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1) f
            JOIN f x ON x.lang = f.lang AND x.g = f.g[1:k] JOIN f y ON y.lang = f.lang AND y.g = f.g[k + 1:]),
        m AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
        inside AS (
            SELECT lang, g[a : b] AS g, max(f) AS most
            FROM (SELECT lang, g, f, a, unnest(range(a + 1, len(g) + 1)) AS b FROM (SELECT *, unnest(range(1, len(g))) AS a FROM f WHERE len(g) > 2))
            WHERE b - a + 1 < len(g) GROUP BY ALL),
        z AS (
            SELECT m.lang, array_to_string(m.g, ' ') AS phrase, a, l, r, score FROM m LEFT JOIN inside i ON i.lang = m.lang AND i.g = m.g
            WHERE coalesce(100 * most < {share} * a, true))
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
        FROM z JOIN n USING (lang) QUALIFY rank <= {top}"""

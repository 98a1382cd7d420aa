"""Op 3. Mixing sources to target weights by weighted fair queueing.

Every document joins its source's queue in shuffled order (a seeded hash of its row), once for each time it may be
used. Its virtual finish time is its source's words up to and with it, divided by the source's target. All copies are
range-sorted by finish time and the stream is truncated at the total budget, so that each source is served its target.

Texts are read once for their sizes and hashes; all else is done on those narrow rows. They are range-sorted by source
and hash, so a source with a third of all rows lies in many ranges, and a document's place in its source's queue is a
running sum over ranges; nothing depends on where rows lie, and reruns agree. The cut is found from one number for each
range of the stream and a running sum in the one range that holds it. Within a source the copies taken are those before
one hash, so ``take`` needs two hashes for each source and shuffles no text.

Rows: null text has size 0; null source is a source, the last; null doc_id is a document like others. A very long text
is one document with a long turn. Repeated rows are documents of their own, also where they differ in other columns
only. Size-0 documents are taken with the stream they stand in and add no words. An empty table gives an
empty result. ``take`` keeps the columns of ``docs`` as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm._common import WORD, join_keys, row_of, running, text_hash, written

_QUEUE = ["none", "src", "key", "doc_id", "size"]  # the order of a source's queue


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _keyed(seed: int) -> dict[str, Column]:
    """A source without null, whether it is null, and the hash that shuffles."""
    return {
        "none": F.col("source").isNull(), "src": F.coalesce(F.col("source").cast("string"), F.lit("")),
        "key": F.xxhash64(F.lit(seed), "doc_id", "text", "source"),
    }


def targets(totals: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """none, src, source_size and target from none, src and source_size: one row for each source.

    Weights repeat over the sources by code point, null last. The level at which weight times level, stopped at ``most``
    times the size, adds up to ``share`` of all sizes follows from sorting sources by the level at which they stop.
    """
    placed = running(totals.withColumn("one", F.lit(1)), ["none", "src"], "one")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.col("one_upto") - 1) % len(weights) + 1).cast("int"))
    stops = placed.select(
        "none", "src", "source_size", weight.alias("weight"), (most * F.col("source_size")).alias("cap"),
    ).withColumn("stop", F.col("cap") / F.col("weight"))
    by = running(stops, ["stop", "none", "src"], "cap", "weight")
    sums = stops.agg(F.sum("source_size").alias("all_size"), F.sum("weight").alias("all_weight"))
    level = (
        F.col("all_size") * share - (F.col("cap_upto") - F.col("cap"))
    ) / (F.col("all_weight") - F.col("weight_upto") + F.col("weight"))
    levels = by.crossJoin(F.broadcast(sums)).withColumn("level", level)
    found = levels.agg(F.min(F.when(F.col("level") <= F.col("stop"), F.struct("stop", "level"))).alias("first"))
    return stops.crossJoin(F.broadcast(found)).select(
        "none", "src", "source_size",
        F.coalesce(F.least(F.col("weight") * F.col("first.level"), "cap"), "cap").alias("target"),
    )


def _finish(copy: int) -> Column:
    """Virtual finish time of a copy; a source without a target has no words and finishes at once."""
    return F.when(F.col("target") > 0, (F.col("upto") + copy * F.col("source_size")) / F.col("target")).otherwise(0.0)


def _cut(queued: DataFrame, budget: float, copies: int) -> tuple | None:
    """The last (finish, key, copy) of the globally sorted stream within the budget; None if all of it is."""
    stream = queued.select(
        "size", "key",
        F.explode(F.array(*(F.struct(_finish(i).alias("finish"), F.lit(i).alias("copy")) for i in range(copies)))).alias("c"),
    ).select("c.finish", "key", "c.copy", "size")
    order = ["finish", "key", "copy"]
    ranged = written(stream.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "stream")
    used = 0
    for r in sorted(ranged.groupBy("part").agg(F.sum("size").alias("n")).collect()):  # a row for each partition
        if used + r.n > budget:
            own = ranged.filter(F.col("part") == r.part).withColumn(
                "run",
                F.sum("size").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) + used,
            )
            last = own.filter(F.col("run") <= budget).agg(F.max(F.struct(*order)).alias("m")).first().m
            return tuple(last) if last else (own.agg(F.min("finish")).first()[0], -(2**63), -1)
        used += r.n
    return None


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, copies: int = 2, seed: int = 17) -> DataFrame:
    """One row for each row of ``docs``: doc_id, source, h (XXH64 of the text), size, source_size, target, copies (how often
    the mix takes it), finish (of its first copy), none, src and key (its place in the shuffle)."""
    keyed = _keyed(seed)
    narrow = written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), "source", text_hash().alias("h"),
            size_of(F.col("text")).alias("size"), *(c.alias(n) for n, c in keyed.items()),
        ),
        "sizes",
    )
    totals = written(narrow.groupBy("none", "src").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")), "totals")
    aims = written(
        targets(totals.drop("rows"), weights, share, copies).join(totals.select("none", "src", "rows"), ["none", "src"]),
        "targets",
    )
    budget = aims.agg(F.sum("target")).first()[0] or 0.0
    line = written(running(narrow, _QUEUE, "size"), "line")
    starts = line.groupBy("none", "src").agg(F.min(F.col("size_upto") - F.col("size")).alias("start"))
    heads = written(aims.join(starts, ["none", "src"]), "heads")
    queued = written(
        join_keys(line, heads, ["none", "src"], "rows").withColumn(
            "upto", F.col("size_upto") - F.col("start"),
        ).drop("rows", "start", "size_upto"),
        "queued",
    )
    last = _cut(queued, budget, copies)
    place = lambda i: F.struct(_finish(i).alias("finish"), "key", F.lit(i).alias("copy"))
    taken = sum(
        (
            F.lit(1) if last is None else (
                place(i) <= F.struct(F.lit(last[0]).cast("double"), F.lit(last[1]).cast("long"), F.lit(last[2]).cast("int"))
            ).cast("int") for i in range(copies)
        ),
        F.lit(0),
    )
    return queued.select(
        "doc_id", "source", "h", "size", "source_size", "target", taken.alias("copies"), _finish(0).alias("finish"),
        "none", "src", "key",
    )


def take(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, copies: int = 2, seed: int = 17) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns.

    A source's queue is in the order of the hash: copy i of its rows is taken up to the hash ``last[i]``. Only for rows
    with just such a hash (repeated rows, or a single one) the number taken is looked up: they share it evenly, numbered by
    a hash of all their columns, so rows that differ in other columns each keep their own, none more than ``copies`` times.
    """
    mixed = written(mix(docs, weights, share, copies, seed), "mixed")
    reach = [F.max(F.when(F.col("copies") > i, F.col("key"))) for i in range(copies)]
    ends = written(mixed.groupBy("none", "src").agg(F.count(F.lit(1)).alias("rows"), F.array(*reach).alias("last")), "ends")
    at_end = F.array_contains(F.array_compact("last"), F.col("key"))
    key = ["none", "src", "key"]
    edges = join_keys(mixed, ends, ["none", "src"], "rows").filter(at_end).groupBy(*key).agg(
        F.sum("copies").alias("n"), F.count(F.lit(1)).alias("m"),
    )
    rows = join_keys(
        docs.select(row_of(docs), *(c.alias(n) for n, c in _keyed(seed).items())), ends, ["none", "src"], "rows",
    ).withColumn("edge", at_end)
    n = F.size(F.filter(F.array_compact("last"), lambda x: F.col("key") < x))
    inner = rows.filter("not edge").select("row", n.alias("n"))
    own = rows.filter("edge").select(*key, "row", F.xxhash64(F.to_json(F.struct("row"))).alias("h"), F.lit(1).alias("i"))
    placed = written(running(own, [*key, "h"], "i"), "edges")
    starts = placed.groupBy(*key).agg((F.min("i_upto") - 1).alias("start"))
    shared = join_keys(placed, written(edges.join(starts, key), "shares"), key, "m")
    each = F.floor(F.col("n") / F.col("m"))
    outer = shared.select("row", (each + (F.col("i_upto") - F.col("start") <= F.col("n") - each * F.col("m")).cast("long")).cast("int").alias("n"))
    return inner.unionByName(outer).filter("n > 0").select(F.explode(F.array_repeat("row", F.col("n"))).alias("row")).select("row.*")

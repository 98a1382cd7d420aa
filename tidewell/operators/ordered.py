"""Places, running sums and exact quantiles in a global order, by range sorts: no task gets more than its range."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.scratch import written


def running(rows: DataFrame, order: list[str], *sums: str) -> DataFrame:
    """``rows`` with ``{c}_upto`` for each column c of ``sums``: its running sum in that order over all rows, the row
    included. Rows are sorted by ranges and written once; one total of each range passes through a window."""
    ranged = written(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("_part").agg(*(F.sum(c).alias(c) for c in sums))
    starts = parts.select("_part", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_before_{c}") for c in sums))
    own = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = ranged.withColumns({f"{c}_upto": F.sum(c).over(own) for c in sums}).join(F.broadcast(starts), "_part")
    return found.withColumns(
        {f"{c}_upto": F.col(f"{c}_upto") + F.col(f"_before_{c}") for c in sums}
    ).drop("_part", *(f"_before_{c}" for c in sums))


def numbered(rows: DataFrame, order: list[str], name: str = "__i") -> DataFrame:
    """``rows`` with their place in the order, from 1; nulls come first, and ties are in no particular order."""
    return running(rows.withColumn("_one", F.lit(1)), order, "_one").withColumnRenamed("_one_upto", name).drop("_one")


def quantiles(df: DataFrame, values: dict[str, Column], shares: Sequence[float], groups: Sequence[str] = ()) -> DataFrame:
    """One row (for each group; null groups have none): ``{name}_{k}``, the k-th share's interpolated quantile of each value.

    A value's rows are numbered within a range sort by group and value; only the few rows at the wanted places are
    picked. Nulls don't count, and a group without a value has nulls.
    """
    keys = [f"__k{j}" for j in range(len(groups))]
    named = [F.col(f"`{g}`").alias(k) for g, k in zip(groups, keys, strict=True)]
    bare = df.select(
        *named,
        F.explode(F.array(*(F.struct(F.lit(j).alias("c"), x.alias("x")) for j, x in enumerate(values.values())))).alias("v"),
    ).select(*keys, "v.c", "v.x").filter("x is not null")
    for k in keys:
        bare = bare.filter(F.col(k).isNotNull())
    rows = written(numbered(bare, [*keys, "c", "x"]), "numbered")
    spans = rows.groupBy(*keys, "c").agg(F.min("__i").alias("first"), F.count(F.lit(1)).alias("n"))
    at = lambda q: F.lit(float(q)) * (F.col("n") - 1)
    wanted = F.array(*(F.struct(F.lit(j).alias("q"), (F.col("first") + f(at(q)).cast("long")).alias("i"), w(at(q)).alias("w")) for j, q in enumerate(shares) for f, w in ((F.floor, lambda p: 1 - (p - F.floor(p))), (F.ceil, lambda p: p - F.floor(p)))))
    places = spans.select(*keys, "c", F.explode(wanted).alias("p")).select(
        *keys, "c", "p.q", F.col("p.i").alias("__i"), "p.w",
    ).filter("w > 0")
    found = places.join(rows.select("__i", "x"), "__i").groupBy(*keys).agg(
        *(F.sum(F.when((F.col("c") == c) & (F.col("q") == q), F.col("x") * F.col("w"))).alias(f"{name}_{q}") for c, name in enumerate(values) for q in range(len(shares)))
    )
    return found.withColumnsRenamed(dict(zip(keys, groups, strict=True)))


# ---------------------------------------------------------------- groups that span ranges


def _ranged(rows: DataFrame, groups: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, Column, DataFrame]:
    """Rows range-sorted by group and order with ``_part``, written; a group's key; and (``_part``, first, last): the groups
    at a range's ends. Only those can lie in several ranges, so only they need anything from other ranges."""
    ranged = written(rows.repartitionByRange(*groups, *order).withColumn("_part", F.spark_partition_id()), "ranged")
    key = F.struct(*groups) if groups else F.struct(F.lit(1).alias("one"))
    return ranged, key, ranged.groupBy("_part").agg(F.min(key).alias("_first"), F.max(key).alias("_last"))


def _carried(ranged: DataFrame, key: Column, ends: DataFrame, made: dict[str, Column], carry: Callable[[Column], Column]) -> DataFrame:
    """``ranged`` with ``_c_{name}``: ``carry`` of the aggregates ``made`` of the same group in all earlier ranges. Two rows
    a range pass through a window, whatever the number of rows."""
    edges = ranged.join(F.broadcast(ends), "_part").withColumn("_key", key).filter("_key <=> _first or _key <=> _last").groupBy(
        "_part", "_key",
    ).agg(*(c.alias(n) for n, c in made.items()))
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    found = edges.select("_part", "_key", *(carry(F.col(n)).over(earlier).alias(f"_c_{n}") for n in made)).alias("e")
    same = (F.col("r._part") == F.col("e._part")) & F.col("r._key").eqNullSafe(F.col("e._key"))
    joined = ranged.withColumn("_key", key).alias("r").join(F.broadcast(found), same, "left")
    return joined.select("r.*", *(f"e._c_{n}" for n in made)).drop("_key")


def group_running(rows: DataFrame, groups: Sequence[str], order: Sequence[str], *sums: str) -> DataFrame:
    """``rows`` with ``{c}_upto``: the running sum of c within its group in that order, the row included. A group of any size
    is spread over ranges; null is a group."""
    ranged, key, ends = _ranged(rows, groups, order)
    own = Window.partitionBy("_part", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumns({f"{c}_upto": F.sum(c).over(own) for c in sums})
    found = _carried(local, key, ends, {c: F.sum(c) for c in sums}, F.sum)
    return found.withColumns({f"{c}_upto": F.col(f"{c}_upto") + F.coalesce(f"_c_{c}", F.lit(0)) for c in sums}).drop("_part", *(f"_c_{c}" for c in sums))


def filled_forward(rows: DataFrame, groups: Sequence[str], order: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """``rows`` with each of ``values`` filled forward within its group: the last one that isn't null, up to this row. What a
    range's first group had last before it comes from one row for each earlier range."""
    ranged, key, ends = _ranged(rows.withColumns({f"_v_{n}": c for n, c in values.items()}), groups, order)
    own = Window.partitionBy("_part", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c: F.last(c, ignorenulls=True)
    local = ranged.withColumns({f"_l_{n}": last(F.col(f"_v_{n}")).over(own) for n in values})
    place = F.struct(*order)
    newest = {n: F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), place)) for n in values}
    found = _carried(local, key, ends, newest, last)
    return found.withColumns({n: F.coalesce(f"_l_{n}", f"_c_{n}") for n in values}).drop("_part", *(f"{p}{n}" for n in values for p in ("_v_", "_l_", "_c_")))


def with_halo(rows: DataFrame, groups: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """``rows`` in ranges by group and order, each range with the ``n`` rows before it (``_halo``), also if those lie in
    several ranges: ``_part``, ``_i`` (the place in the whole order) and ``_halo`` are added. A window by ``_part`` and group
    over the last n + 1 rows then has all it needs, and no task gets more than a range and n rows."""
    ranged, _, _ = _ranged(rows, groups, order)
    counts = sorted(ranged.groupBy("_part").count().collect())  # a row for each range
    starts, total = [], 0
    for part, count in counts:
        starts.append((part, total))
        total += count
    later = []  # the ranges that rows of a range are a halo of
    for at, (part, count) in enumerate(counts):
        end = starts[at][1] + count
        targets = []
        for p, a in starts[at + 1 :]:
            if a + 1 > end + n:
                break
            targets.append((p, a + 1))
        later.append((part, starts[at][1], targets))
    plan = rows.sparkSession.createDataFrame(later, "_part int, _start long, _later array<struct<p:int,a:long>>")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*groups, *order))
    placed = ranged.join(F.broadcast(plan), "_part").withColumn("_i", place + F.col("_start"))
    kept = F.lit(n)
    copies = placed.filter(F.exists("_later", lambda t: t["a"] <= F.col("_i") + kept)).withColumn(
        "_part", F.explode(F.transform(F.filter("_later", lambda t: t["a"] <= F.col("_i") + kept), lambda t: t["p"])),
    )
    own, halo = (x.drop("_start", "_later").withColumn("_halo", F.lit(h)) for x, h in ((placed, False), (copies, True)))
    return own.unionByName(halo)

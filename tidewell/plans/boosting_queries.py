"""Registered queries of boosted trees over order lines, each checked by SQL that grows the same trees.

The lines' quantities (with some nulls) and months make cells; sums over a cell are all that a split depends on, so the SQL
works on cells and the engine on rows. Amounts are in thousands.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.plans.boosting import Boosted, CatBoost, LightGBM, XGBoost, target_statistics
from tidewell.plans.queries import query, rounded, table

_LINES = """lines AS (SELECT CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_quantity::INTEGER END AS q, month(l_shipdate)::INTEGER AS m, l_extendedprice / 1e3 AS y FROM lineitem),
    base AS (SELECT avg(y) AS b FROM lines),
    c0 AS MATERIALIZED (SELECT q, m, count(*) AS n, sum(y) AS s, any_value(b) AS p, 0 AS leaf FROM lines, base GROUP BY q, m)"""


def _lines(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem")
    return x.select(
        F.when(F.col("l_linenumber") % 5 != 0, F.col("l_quantity").cast("int")).alias("q"), F.month("l_shipdate").alias("m"),
        (F.col("l_extendedprice") / 1e3).alias("y"),
    )


def _worth(g: str, h: str, alpha: float, lambda_: float) -> str:
    return f"power(greatest(abs({g}) - {alpha}, 0), 2) / ({h} + {lambda_})"


def _candidates(name: str, cells: str, alpha: float, lambda_: float, least: float) -> str:
    """CTEs up to ``name``: (leaf, f, cut, nl, gain) of every split of every leaf of ``cells``, with nl 1 where nulls go left."""
    sides = [f"{cells}_{f}{nl} AS (SELECT c.leaf, {i} AS f, v AS cut, {nl} AS nl, sum(CASE WHEN {go} THEN g END) AS gl, sum(CASE WHEN {go} THEN n END) AS hl, sum(g) AS g, sum(n) AS h FROM {cells}_g c, (SELECT DISTINCT {f} AS v FROM {cells} WHERE {f} IS NOT NULL) GROUP BY ALL)"
             for i, f in enumerate(("q", "m")) for nl in (1, 0) for go in (f"coalesce({f} <= v, {'true' if nl else 'false'})",)]
    union = " UNION ALL ".join(f"SELECT * FROM {cells}_{f}{nl}" for f in ("q", "m") for nl in (1, 0))
    gain = f"{_worth('gl', 'hl', alpha, lambda_)} + {_worth('(g - gl)', '(h - hl)', alpha, lambda_)} - {_worth('g', 'h', alpha, lambda_)}"
    return f"""{cells}_g AS (SELECT *, n * p - s AS g FROM {cells}), {', '.join(sides)},
    {name} AS (SELECT leaf, f, cut, nl, {gain} AS gain FROM ({union}) WHERE least(hl, h - hl) >= {least})"""


_LEFT = "coalesce(CASE b.f WHEN 0 THEN c.q <= b.cut ELSE c.m <= b.cut END, b.nl = 1)"


def _value(rate: float, alpha: float, lambda_: float) -> str:
    """CTE: what a leaf's rows are moved by, from (leaf, g, h)."""
    return f"-{rate} * sign(g) * greatest(abs(g) - {alpha}, 0) / (h + {lambda_})"


def _shown(cells: str) -> str:
    return f"SELECT q, m, n, round(p, 4) + 0.0 AS prediction FROM {cells}"


def _by_cell(model: Boosted, rows: DataFrame, features: Sequence[str] = ("q", "m")) -> DataFrame:
    found = model.fit(rows, features, "y").predict(rows, features)
    return rounded(found.groupBy("q", "m", F.round("prediction", 4).alias("prediction")).agg(F.count(F.lit(1)).alias("n")), 4)


def _moved(before: str, after: str, rate: float, alpha: float, lambda_: float) -> str:
    return f"""{after} AS MATERIALIZED (SELECT q, m, n, s, p + {_value(rate, alpha, lambda_)} AS p, 0 AS leaf FROM {before} JOIN (SELECT leaf, sum(n * p - s) AS g, sum(n) AS h FROM {before} GROUP BY leaf) USING (leaf))"""


def _leafwise(start: str, end: str, leaves: int, alpha: float, lambda_: float, least: float) -> str:
    """The leaf of the largest gain is split, ``leaves`` - 1 times."""
    steps, now = [], start
    for k in range(1, leaves):
        new = f"{start}_{k}"
        steps.append(f"""{_candidates(f'{new}_s', now, alpha, lambda_, least)},
    {new}_b AS MATERIALIZED (SELECT * FROM {new}_s WHERE gain > 1e-12 ORDER BY gain DESC, leaf, f, cut, nl DESC LIMIT 1),
    {new} AS MATERIALIZED (SELECT c.q, c.m, c.n, c.s, c.p, CASE WHEN c.leaf = b.leaf AND NOT {_LEFT} THEN {k} ELSE c.leaf END AS leaf FROM {now} c LEFT JOIN {new}_b b ON true)""")
        now = new
    return f"{', '.join(steps)}, {end} AS (SELECT * FROM {now})"


@query(f"WITH {_LINES}, {_leafwise('c0', 'grown', 4, 0, 0, 20)}, {_moved('grown', 'done', 1.0, 0, 0)} {_shown('done')}")
def lightgbm_four_leaves(spark: SparkSession, d: str) -> DataFrame:
    """One tree of four leaves, the largest gain first."""
    return _by_cell(LightGBM(n_estimators=1, num_leaves=4, learning_rate=1.0, nulls="learn"), _lines(spark, d))


def _stump(before: str, after: str, rate: float, alpha: float, lambda_: float, gamma: float, least: float) -> str:
    return f"""{_candidates(f'{before}_s', before, alpha, lambda_, least)},
    {before}_b AS MATERIALIZED (SELECT * FROM {before}_s WHERE gain > {gamma} ORDER BY gain DESC, f, cut, nl DESC LIMIT 1),
    {before}_t AS MATERIALIZED (SELECT c.q, c.m, c.n, c.s, c.p, CASE WHEN NOT {_LEFT} THEN 1 ELSE 0 END AS leaf FROM {before} c LEFT JOIN {before}_b b ON true),
    {_moved(f'{before}_t', after, rate, alpha, lambda_)}"""


@query(f"WITH {_LINES}, {_stump('c0', 'c1', 0.5, 10.0, 2.0, 0.1, 5)}, {_stump('c1', 'c2', 0.5, 10.0, 2.0, 0.1, 5)} {_shown('c2')}")
def xgboost_two_stumps(spark: SparkSession, d: str) -> DataFrame:
    """Two rounds of one split, with penalties; nulls go where they gain more."""
    made = XGBoost(
        n_estimators=2, max_depth=1, learning_rate=0.5, reg_alpha=10.0, reg_lambda=2.0, gamma=0.1, min_child_weight=5, nulls="learn",
    )
    return _by_cell(made, _lines(spark, d))


@query(f"""WITH {_LINES}, {_stump('c0', 'c1', 1.0, 0, 1.0, 1e9, 1)} SELECT q, m, n, round(p, 4) + 0.0 AS prediction FROM c1""")
def xgboost_large_gamma(spark: SparkSession, d: str) -> DataFrame:
    """No split gains as much as gamma asks for: every line has the mean."""
    return _by_cell(XGBoost(n_estimators=1, max_depth=3, learning_rate=1.0, gamma=1e9, nulls="learn"), _lines(spark, d))


def _symmetric(start: str, end: str, depth: int, lambda_: float) -> str:
    """All leaves are split by the condition whose gains add up to most."""
    steps, now = [], start
    for k in range(depth):
        new = f"{start}_{k}"
        steps.append(f"""{_candidates(f'{new}_s', now, 0, lambda_, 1)},
    {new}_b AS MATERIALIZED (SELECT f, cut, nl FROM {new}_s GROUP BY ALL ORDER BY sum(greatest(gain, 0)) DESC, f, cut, nl DESC LIMIT 1),
    {new} AS MATERIALIZED (SELECT c.q, c.m, c.n, c.s, c.p, 2 * c.leaf + CASE WHEN {_LEFT} THEN 0 ELSE 1 END AS leaf FROM {now} c, {new}_b b)""")
        now = new
    return f"{', '.join(steps)}, {end} AS (SELECT * FROM {now})"


@query(f"WITH {_LINES}, {_symmetric('c0', 'grown', 3, 3.0)}, {_moved('grown', 'done', 0.5, 0, 3.0)} {_shown('done')}")
def catboost_symmetric_tree(spark: SparkSession, d: str) -> DataFrame:
    """One tree of three levels, each split by one condition."""
    return _by_cell(CatBoost(iterations=1, depth=3, learning_rate=0.5, nulls="learn"), _lines(spark, d))


@query("""WITH p AS (SELECT avg(o_totalprice) AS prior FROM orders)
    SELECT o_orderkey, o_orderpriority, round((coalesce(sum(o_totalprice) OVER w, 0) + 2 * prior) / (count(*) OVER w + 2), 4) AS statistic
    FROM orders, p WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def catboost_target_statistics(spark: SparkSession, d: str) -> DataFrame:
    """The mean price of the orders of the same priority before each order: no order sees its own price."""
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    found = target_statistics(rows, "o_orderpriority", "o_totalprice", prior_weight=2.0, order_by=["o_orderkey"])
    return rounded(found.select("o_orderkey", "o_orderpriority", F.col("o_orderpriority_ordered").alias("statistic")), 4)

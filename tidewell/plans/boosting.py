"""Gradient boosting over histograms: the three common libraries' trees, grown by Spark aggregations.

Features are cut into bins once and rows are written as bins. A round needs the gradients' sums by leaf, feature and bin:
each task adds them up for its rows in Arrow batches, one aggregation adds up the tasks, and the driver gets only those
sums (leaves x features x bins, whatever the number of rows) to choose splits from. A row's leaf and prediction follow
from the trees so far; every ``KEEP`` trees the predictions are written anew, so no pass walks more than that many trees.

``leafwise`` (lightgbm) splits the leaf of the largest gain first, from a queue of leaves. A pass computes histograms for
all leaves in the queue at once: of a split's two children the smaller one is added up, the other is its parent's less
that. ``depthwise`` (xgboost) splits every leaf of a level; ``symmetric`` (catboost) splits all leaves of a level by one
condition. The objective is squared error to the second order: with g and h the sums of gradients and hessians, T(g) g
moved ``alpha`` towards zero, a leaf is worth T(g)²/(h + lambda) and predicts -T(g)/(h + lambda). A split is made where the
worth of both sides exceeds their parent's by more than ``gamma``. Nulls go to the side where they gain more.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidewell.functions.numbers import number
from tidewell.operators.features import col
from tidewell.operators.ordered import group_running
from tidewell.plans.models import Regressor
from tidewell.scratch import discard, written
from tidewell.ship import ship

KEEP = 10  # trees between two tables of predictions
SMALL = 20_000  # rows, counted, that the driver adds up itself: a monthly series needs no pass over a cluster


@dataclass
class Tree:
    """Nodes in lists: feature (-1: a leaf), bin (the last of the left side), whether nulls go left, children, value."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    nulls_left: list[bool] = field(default_factory=lambda: [True])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, bin_: int, nulls_left: bool, gain: float) -> tuple[int, int]:
        self.feature[node], self.bin[node], self.nulls_left[node], self.gain[node] = feature, bin_, nulls_left, gain
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for _ in range(2):
            for values, empty in ((self.feature, -1), (self.bin, 0), (self.nulls_left, True), (self.left, 0), (self.right, 0), (self.value, 0.0), (self.gain, 0.0)):
                values.append(empty)
        return self.left[node], self.right[node]

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of ``bins`` (row, feature; 0 is null)."""
        feature, cut = np.array(self.feature), np.array(self.bin)
        left, right, nulls = np.array(self.left), np.array(self.right), np.array(self.nulls_left)
        at = np.zeros(len(bins), np.int64)
        inner = np.flatnonzero(feature[at] >= 0)
        while len(inner):
            node = at[inner]
            b = bins[inner, feature[node]]
            at[inner] = np.where(np.where(b == 0, nulls[node], b <= cut[node]), left[node], right[node])
            inner = inner[feature[at[inner]] >= 0]
        return at


@dataclass(frozen=True)
class Rules:
    """How trees are grown; the libraries' parameters translate to these."""

    growth: str = "depthwise"
    trees: int = 100
    rate: float = 0.3
    depth: int = 6  # 0: any
    leaves: int = 0  # 0: any
    alpha: float = 0.0
    lambda_: float = 1.0
    gamma: float = 0.0
    child_weight: float = 1.0
    child_rows: int = 1
    rows_share: float = 1.0
    columns_share: float = 1.0
    bins: int = 256
    seed: int = 42


def worth(g: np.ndarray, h: np.ndarray, rules: Rules) -> np.ndarray:
    t = np.sign(g) * np.maximum(np.abs(g) - rules.alpha, 0.0)
    return np.divide(t * t, h + rules.lambda_, out=np.zeros_like(t, float), where=h + rules.lambda_ > 0)


def _value(g: float, h: float, rules: Rules) -> float:
    t = math.copysign(max(abs(g) - rules.alpha, 0.0), g)
    return -t / (h + rules.lambda_) if h + rules.lambda_ > 0 else 0.0


def gains(hist: np.ndarray, rules: Rules) -> np.ndarray:
    """Gain of each (feature, last bin of the left side, nulls left: 1, right: 0) of one leaf's histogram (3, feature, bin):
    sums of g, h and rows, bin 0 for nulls; -inf where a side is too small."""
    total = hist.sum(axis=2)[:, :1, None]
    some = np.cumsum(hist[:, :, 1:], axis=2)
    out = np.full((hist.shape[1], hist.shape[2] - 1, 2), -np.inf)
    for side in (1, 0):
        left = some + (hist[:, :, :1] if side else 0)
        right = total - left
        gain = worth(left[0], left[1], rules) + worth(right[0], right[1], rules) - worth(total[0], total[1], rules)
        fits = np.minimum(left[1], right[1]) >= max(rules.child_weight, 1e-12)
        fits &= np.minimum(left[2], right[2]) >= max(rules.child_rows, 1)
        out[:, :, side] = np.where(fits, gain, -np.inf)
    return out


def best(gain: np.ndarray, rules: Rules, usable: np.ndarray) -> tuple[float, int, int, bool] | None:
    """The largest gain above gamma: (gain, feature, last bin of the left side, nulls left); ties go to the first feature
    and bin, and nulls to the left."""
    g = np.where(usable[:, None, None], gain, -np.inf)[:, :, ::-1]  # left first
    f, b, side = np.unravel_index(np.argmax(g), g.shape)
    top = float(g[f, b, side])
    return (top, int(f), int(b) + 1, not side) if top > max(rules.gamma, 1e-12) and np.isfinite(top) else None


class Grower:
    """Grows one tree from ``histograms(nodes)``: {node: histogram} of the nodes asked for, in one pass over the rows."""

    def __init__(self, rules: Rules, usable: np.ndarray) -> None:
        self.rules, self.usable, self.tree, self.hist, self.depth = rules, usable, Tree(), {}, {0: 0}

    def ask(self, histograms: Any, pairs: list[tuple[int, int, int]]) -> None:
        """Histograms of the children of (parent, left, right): the smaller by a pass, the other by subtraction."""
        small = [min((left, right), key=lambda x: self.rows[x]) for _, left, right in pairs]
        found = histograms(small) if small else {}
        for (parent, left, right), s in zip(pairs, small, strict=True):
            other = right if s == left else left
            self.hist[s], self.hist[other] = found[s], self.hist[parent] - found[s]

    def sized(self, parent: int, split: tuple[float, int, int, bool], left: int, right: int) -> None:
        _, f, b, nulls = split
        n = self.hist[parent][2, f]
        self.rows[left] = n[1 : b + 1].sum() + (n[0] if nulls else 0)
        self.rows[right] = n.sum() - self.rows[left]
        self.depth[left] = self.depth[right] = self.depth[parent] + 1

    def grow(self, histograms: Any) -> Tree:
        self.hist, self.rows = histograms([0]), {0: 0.0}
        if len(self.usable):
            {"leafwise": self.leafwise, "depthwise": self.depthwise, "symmetric": self.symmetric}[self.rules.growth](histograms)
        for node, feature in enumerate(self.tree.feature):
            if feature < 0:
                g, h, _ = self.hist[node][:, 0].sum(axis=1)
                self.tree.value[node] = self.rules.rate * _value(float(g), float(h), self.rules)
        return self.tree

    def choice(self, node: int) -> tuple[float, int, int, bool] | None:
        if self.rules.depth and self.depth[node] >= self.rules.depth:
            return None
        return best(gains(self.hist[node], self.rules), self.rules, self.usable)

    def leafwise(self, histograms: Any) -> None:
        """Splits in order of gain. A leaf in the queue whose children aren't known holds the queue up until the next pass,
        which serves all leaves that wait: the tree is the same as with a pass for each split."""
        queue: list[tuple[float, int, tuple]] = []
        ready: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def enter(node: int) -> None:
            if (split := self.choice(node)) is not None:
                heapq.heappush(queue, (-split[0], node, split))

        enter(0)
        n, most = 1, self.rules.leaves or 1 << 30
        while queue and n < most:
            _, node, split = queue[0]
            if node not in ready:  # children of every leaf that waits, under names that the tree doesn't have yet
                waiting = [(x, s) for _, x, s in heapq.nsmallest(most - n, queue) if x not in ready]
                trial = Tree(*(list(v) for v in asdict(self.tree).values()))
                pairs = []
                for x, s in waiting:
                    left, right = trial.split(x, *s[1:], s[0])
                    self.sized(x, s, left, right)
                    pairs.append((x, left, right))
                kept, self.tree = self.tree, trial
                self.ask(histograms, pairs)
                self.tree = kept
                for (x, left, right), _ in zip(pairs, waiting, strict=True):
                    ready[x] = (self.hist.pop(left), self.hist.pop(right))
            heapq.heappop(queue)
            left, right = self.tree.split(node, *split[1:], split[0])
            self.sized(node, split, left, right)
            self.hist[left], self.hist[right] = ready.pop(node)
            n += 1
            enter(left)
            enter(right)

    def depthwise(self, histograms: Any) -> None:
        level, n, most = [0], 1, self.rules.leaves or 1 << 30
        while level:
            pairs = []
            for node in level:
                if n < most and (split := self.choice(node)) is not None:
                    left, right = self.tree.split(node, *split[1:], split[0])
                    self.sized(node, split, left, right)
                    pairs.append((node, left, right))
                    n += 1
            self.ask(histograms, pairs)
            level = [x for _, left, right in pairs for x in (left, right)]

    def symmetric(self, histograms: Any) -> None:
        """One condition for all leaves of a level: the largest sum of gains. A leaf that it doesn't cut has an empty side."""
        level = [0]
        free = Rules(**{**asdict(self.rules), "child_weight": 0.0, "child_rows": 0})
        for _ in range(self.rules.depth or 6):
            total = sum(np.maximum(_uncut(self.hist[x], free), 0.0) for x in level)
            split = best(total, self.rules, self.usable)
            if split is None:
                return
            pairs = []
            for node in level:
                left, right = self.tree.split(node, *split[1:], split[0] / len(level))
                self.sized(node, split, left, right)
                pairs.append((node, left, right))
            self.ask(histograms, pairs)
            level = [x for _, left, right in pairs for x in (left, right)]


def _uncut(hist: np.ndarray, rules: Rules) -> np.ndarray:
    """Gains of a leaf where a side may be empty (no gain then)."""
    g = gains(hist, Rules(**{**asdict(rules), "child_rows": 1}))
    return np.where(np.isfinite(g), g, 0.0)


# ---------------------------------------------------------------- over DataFrames


def cuts(rows: DataFrame, features: int, bins: int) -> list[list[float]]:
    """For each column f0, f1, ... the least values of its bins but the first: every value where there are few, else
    quantiles. What comes to the driver is bounded by features x bins."""
    exact = rows.agg(*(F.count_distinct(F.col(f"f{i}")).alias(f"f{i}") for i in range(features))).first() if features else ()
    few = [i for i in range(features) if exact[i] <= bins]
    many = [i for i in range(features) if exact[i] > bins]
    out: list[list[float]] = [[] for _ in range(features)]
    if few:
        found = rows.agg(*(F.sort_array(F.collect_set(f"f{i}")).alias(f"f{i}") for i in few)).first()
        for i in few:
            out[i] = list(found[f"f{i}"])[1:]
    if many:
        shares = F.array(*(F.lit(k / bins) for k in range(1, bins)))
        found = rows.agg(*(F.percentile_approx(f"f{i}", shares, F.lit(100 * bins)).alias(f"f{i}") for i in many)).first()
        for i in many:
            out[i] = sorted(set(found[f"f{i}"]))
    return out


def _binned(columns: list[pa.Array], edges: list[np.ndarray]) -> np.ndarray:
    out = np.empty((len(columns[0]) if columns else 0, len(columns)), np.int32)
    for i, (c, e) in enumerate(zip(columns, edges, strict=True)):
        x = c.to_numpy(zero_copy_only=False).astype(float)
        out[:, i] = np.where(np.isnan(x), 0, np.searchsorted(e, x, side="right") + 1)
    return out


class Boosted(Regressor):
    """Boosted trees under one of the three names; a parameter that isn't known is an error, none is left out silently.

    ``nulls``: "zero" takes null features for 0, as the other models here do; "learn" keeps them apart. Saved as JSON.
    """

    kind = ""
    #: Names of parameters (and their aliases) for those of ``Rules``.
    NAMES: dict[str, str] = {}
    DEFAULTS: dict[str, Any] = {}
    #: Parameters that are accepted and change nothing here: threads, output and the like.
    IGNORED = frozenset({"n_jobs", "nthread", "num_threads", "thread_count", "verbosity", "verbose", "silent", "allow_writing_files", "logging_level", "tree_method", "device"})

    def __init__(self, **params: Any) -> None:
        super().__init__(**params)
        rules = dict(self.DEFAULTS)
        self.nulls, self.categories = str(params.get("nulls", "zero")), list(params.get("cat_features", None) or [])
        if self.nulls not in ("zero", "learn"):
            raise ValueError(f'{self.kind}: nulls is "zero" or "learn", not {self.nulls!r}')
        for name, value in params.items():
            if name in ("nulls", *self.IGNORED) or (name == "cat_features" and self.kind == "catboost") or value is None:
                continue
            if name == "objective" or name == "loss_function":
                if str(value) not in ("reg:squarederror", "regression", "regression_l2", "l2", "mse", "RMSE"):
                    raise ValueError(f"{self.kind}: no objective {value!r}; there is squared error")
            elif name in ("grow_policy", "boosting_type"):
                rules |= self.policy(name, str(value))
            elif name not in self.NAMES:
                raise ValueError(f"{self.kind}: no parameter {name!r}; there are {', '.join(sorted([*self.NAMES, *self.IGNORED, 'nulls']))}")
            else:
                rules[self.NAMES[name]] = value
        kinds = {"growth": str} | {k: int for k in ("trees", "depth", "leaves", "child_rows", "bins", "seed")}
        self.rules = Rules(**{k: kinds.get(k, float)(v) for k, v in rules.items()})
        if self.rules.depth < 0:  # the usual sign for any depth
            self.rules = Rules(**{**asdict(self.rules), "depth": 0})
        r = self.rules
        wrong = [
            n for n, ok in (
                ("trees", r.trees >= 0), ("rate", r.rate > 0), ("alpha", r.alpha >= 0), ("lambda", r.lambda_ >= 0), ("gamma", r.gamma >= 0),
                ("row share", 0 < r.rows_share <= 1), ("column share", 0 < r.columns_share <= 1), ("bins", 2 <= r.bins <= 65_000),
            ) if not ok
        ]
        if wrong:
            raise ValueError(f"{self.kind}: out of range: {', '.join(wrong)}")
        self.trees: list[Tree] = []
        self.edges: list[list[float]] = []
        self.base = 0.0

    def policy(self, name: str, value: str) -> dict[str, Any]:
        raise ValueError(f"{self.kind}: no parameter {name!r}")

    def _features(self, df: DataFrame, features: Sequence[str]) -> dict[str, Any]:
        made = {f"f{i}": number(col(c)) for i, c in enumerate(features)}
        return made if self.nulls == "learn" else {k: F.coalesce(v, F.lit(0.0)) for k, v in made.items()}

    def fit(self, df: DataFrame, features: Sequence[str], target: str) -> Boosted:
        ship(df.sparkSession)
        rows = written(df.select(*(v.alias(k) for k, v in self._features(df, features).items()), F.coalesce(number(col(target)), F.lit(0.0)).alias("y")), "features")
        return self._fit(rows, len(features))

    def _fit(self, rows: DataFrame, n: int) -> Boosted:
        r = self.rules
        self.width, self.trees = n, []
        self.base = float(rows.agg(F.avg("y")).first()[0] or 0.0)
        self.edges = cuts(rows, n, r.bins - 1)
        edges = [np.array(e, float) for e in self.edges]
        # A row's number in its partition seeds whether it is in a tree's sample; the table is written, so passes agree.
        seeded = rows.withColumn("r", F.xxhash64(F.lit(r.seed), F.monotonically_increasing_id()))

        def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins = _binned([batch.column(f"f{i}") for i in range(n)], edges).astype("<u2")
                yield pa.RecordBatch.from_arrays([_fixed(bins, batch.num_rows), batch.column("g"), batch.column("r")], ["bins", "g", "r"])

        gradient = seeded.withColumn("g", F.lit(self.base) - F.col("y"))
        table = written(gradient.mapInArrow(to_bins, "bins binary, g double, r long"), "bins")
        discard(rows)
        width = max((len(e) for e in edges), default=0) + 2
        store = (_Held if table.limit(SMALL + 1).count() <= SMALL else _Spread)(table, n, width, r)
        rng = np.random.default_rng(r.seed)
        for k in range(r.trees):
            usable = np.zeros(n, bool)
            usable[rng.permutation(n)[: max(1, round(r.columns_share * n))] if n else []] = True
            grower = Grower(r, usable)
            tree = grower.grow(lambda nodes, k=k, g=grower: store.histograms(g.tree, nodes, k))
            self.trees.append(tree)
            if len(tree.feature) == 1 and r.rows_share == r.columns_share == 1:
                break  # nothing is left to split, and no later tree would see other rows or columns
            store.add(tree)
        discard(store.table)
        return self

    def predict(self, df: DataFrame, features: Sequence[str]) -> DataFrame:
        """One pass in Arrow batches; no shuffle."""
        ship(df.sparkSession)
        names = [f"__f{i}" for i in range(len(features))]
        df = df.drop("prediction")
        ready = df.select("*", *(v.alias(f"__{k}") for k, v in self._features(df, features).items()))
        edges, trees, base = [np.array(e, float) for e in self.edges], self.trees, self.base
        kept = list(df.columns)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins = _binned([batch.column(c) for c in names], edges).reshape(batch.num_rows, len(names))
                total = np.full(batch.num_rows, base)
                for t in trees:
                    total += np.array(t.value)[t.leaves(bins)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(total)], [*kept, "prediction"])

        return ready.mapInArrow(work, StructType([*df.schema.fields, StructField("prediction", DoubleType())]))

    def predict_one(self, values: Sequence[float]) -> float:
        bins = _binned([pa.array([float("nan") if v is None else float(v)], pa.float64()) for v in values], [np.array(e, float) for e in self.edges])
        bins, total = bins.reshape(1, len(values)), self.base
        for t in self.trees:  # in the order of predict()
            total += t.value[t.leaves(bins)[0]]
        return total

    def importances(self) -> list[float]:
        """Share of the gain that each feature's splits brought."""
        out = np.zeros(self.width)
        for t in self.trees:
            for f, g in zip(t.feature, t.gain, strict=True):
                if f >= 0:
                    out[f] += g
        return (out / out.sum() if out.sum() else out).tolist()

    def state(self) -> dict[str, Any]:
        return {"trees": [asdict(t) for t in self.trees], "edges": self.edges, "base": self.base, "width": self.width}

    def restore(self, state: dict[str, Any]) -> Boosted:
        self.trees, self.edges, self.base, self.width = [Tree(**t) for t in state["trees"]], state["edges"], state["base"], state["width"]
        return self


def _fixed(bins: np.ndarray, rows: int) -> pa.Array:
    size = 2 * bins.shape[1]
    if not size:
        return pa.array([b""] * rows, pa.binary())
    offsets = np.arange(0, (rows + 1) * size, size, dtype=np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(bins))])


def _sums(bins: np.ndarray, g: np.ndarray, node: np.ndarray, nodes: int, width: int) -> np.ndarray:
    """Sums of gradients and rows by node, feature and bin."""
    out = np.zeros((2, nodes, max(bins.shape[1], 1), width))
    for f in range(out.shape[2]):
        at = node * width + (bins[:, f] if bins.shape[1] else 0)
        out[0, :, f] = np.bincount(at, g, nodes * width).reshape(nodes, width)
        out[1, :, f] = np.bincount(at, minlength=nodes * width).reshape(nodes, width)
    return out


def _by_node(sums: np.ndarray, nodes: list[int]) -> dict[int, np.ndarray]:
    """{node: sums of gradients, hessians and rows}; squared error: every row's hessian is 1."""
    return {node: np.stack([sums[0, i], sums[1, i], sums[1, i]]) for i, node in enumerate(nodes)}


def _chosen(tree: Tree, nodes: list[int], bins: np.ndarray, r: np.ndarray, k: int, rules: Rules) -> tuple[np.ndarray, np.ndarray]:
    """Rows that lie in one of the nodes and in tree ``k``'s sample, and the number of their node."""
    lookup = np.full(len(tree.feature), -1)
    lookup[nodes] = np.arange(len(nodes))
    node = lookup[tree.leaves(bins)]
    keep = node >= 0
    if rules.rows_share < 1:
        keep &= _sampled(r, rules.seed, k, rules.rows_share)
    return keep, node[keep]


class _Held:
    """A small table's rows as arrays."""

    def __init__(self, table: DataFrame, n: int, width: int, rules: Rules) -> None:
        self.table, self.width, self.rules = table, width, rules
        found = table.toArrow()
        self.bins = np.frombuffer(b"".join(found.column("bins").to_pylist()), "<u2").reshape(found.num_rows, n).astype(np.int64)
        self.g, self.r = found.column("g").to_numpy().copy(), found.column("r").to_numpy()

    def histograms(self, tree: Tree, nodes: list[int], k: int) -> dict[int, np.ndarray]:
        keep, node = _chosen(tree, nodes, self.bins, self.r, k, self.rules)
        return _by_node(_sums(self.bins[keep], self.g[keep], node, len(nodes), self.width), nodes)

    def add(self, tree: Tree) -> None:
        self.g += np.array(tree.value)[tree.leaves(self.bins)]


class _Spread:
    """A table's rows where they lie; trees that its gradients don't have yet are walked in each pass."""

    def __init__(self, table: DataFrame, n: int, width: int, rules: Rules) -> None:
        self.table, self.n, self.width, self.rules, self.new = table, n, width, rules, []

    def histograms(self, tree: Tree, nodes: list[int], k: int) -> dict[int, np.ndarray]:
        new, n, width, rules = self.new, self.n, self.width, self.rules

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((2, len(nodes), max(n, 1), width))
            for batch in batches:
                bins, g = _moved_gradient(batch, new, n)
                keep, node = _chosen(tree, nodes, bins, batch.column("r").to_numpy(), k, rules)
                sums += _sums(bins[keep], g[keep], node, len(nodes), width)
            at = np.flatnonzero(sums[1].ravel())
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(sums[0].ravel()[at]), pa.array(sums[1].ravel()[at])], ["cell", "g", "n"],
            )

        found = self.table.mapInArrow(add, "cell long, g double, n double").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("n").alias("n")).toArrow()
        out = np.zeros((2, len(nodes) * max(n, 1) * width))
        out[:, found.column("cell").to_numpy()] = found.column("g").to_numpy(), found.column("n").to_numpy()
        return _by_node(out.reshape(2, len(nodes), max(n, 1), width), nodes)

    def add(self, tree: Tree) -> None:
        self.new.append(tree)
        if len(self.new) == KEEP:
            before, self.table = self.table, written(self.table.mapInArrow(_moved(self.new, self.n), "bins binary, g double, r long"), "bins")
            discard(before)
            self.new = []


def _moved_gradient(batch: pa.RecordBatch, trees: list[Tree], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bins and gradients (prediction less target) after the trees that the table doesn't have yet."""
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), "<u2").reshape(batch.num_rows, n).astype(np.int64)
    g = batch.column("g").to_numpy(zero_copy_only=False).copy()
    for t in trees:
        g += np.array(t.value)[t.leaves(bins)]
    return bins, g


def _moved(trees: list[Tree], n: int) -> Any:
    trees = list(trees)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, g = _moved_gradient(batch, trees, n)
            yield pa.RecordBatch.from_arrays([batch.column("bins"), pa.array(g), batch.column("r")], ["bins", "g", "r"])

    return work


def _sampled(r: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray:
    """Which rows a tree sees: a hash of the row's number and the tree's."""
    x = (r.astype(np.uint64) ^ np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(float) / float(1 << 53) < share


class XGBoost(Boosted):
    """Level by level, with lambda, alpha and gamma, and the least sum of hessians of a side."""

    kind = "xgboost"
    DEFAULTS = {"growth": "depthwise"}
    NAMES = {
        "n_estimators": "trees", "num_boost_round": "trees", "learning_rate": "rate", "eta": "rate", "max_depth": "depth", "max_leaves": "leaves",
        "reg_lambda": "lambda_", "lambda": "lambda_", "reg_alpha": "alpha", "alpha": "alpha", "gamma": "gamma", "min_split_loss": "gamma",
        "min_child_weight": "child_weight", "subsample": "rows_share", "colsample_bytree": "columns_share", "max_bin": "bins",
        "random_state": "seed", "seed": "seed",
    }

    def policy(self, name: str, value: str) -> dict[str, Any]:
        if name != "grow_policy" or value not in ("depthwise", "lossguide"):
            raise ValueError(f"{self.kind}: no {name} {value!r}")
        return {"growth": "leafwise" if value == "lossguide" else "depthwise"}


class LightGBM(Boosted):
    """Leaf by leaf, the largest gain first."""

    kind = "lightgbm"
    DEFAULTS = {
        "growth": "leafwise", "rate": 0.1, "depth": 0, "leaves": 31, "lambda_": 0.0, "child_weight": 1e-3, "child_rows": 20, "bins": 255,
    }
    NAMES = {
        "n_estimators": "trees", "num_iterations": "trees", "num_boost_round": "trees", "learning_rate": "rate", "num_leaves": "leaves",
        "max_depth": "depth", "reg_alpha": "alpha", "lambda_l1": "alpha", "reg_lambda": "lambda_", "lambda_l2": "lambda_", "min_split_gain": "gamma",
        "min_gain_to_split": "gamma", "min_child_weight": "child_weight", "min_sum_hessian_in_leaf": "child_weight",
        "min_child_samples": "child_rows", "min_data_in_leaf": "child_rows", "subsample": "rows_share", "bagging_fraction": "rows_share",
        "colsample_bytree": "columns_share", "feature_fraction": "columns_share", "max_bin": "bins", "random_state": "seed", "seed": "seed",
    }

    def policy(self, name: str, value: str) -> dict[str, Any]:
        if name != "boosting_type" or value != "gbdt":
            raise ValueError(f"{self.kind}: no {name} {value!r}")
        return {}


def target_statistics(
    df: DataFrame, category: str, target: str, seed: int = 42, prior_weight: float = 1.0, order_by: Sequence[str] = (),
) -> DataFrame:
    """``df`` with ``{category}_ordered``: the mean target of the rows of the same category that come earlier in a seeded order
    (a hash of the row) or in that of ``order_by``, with the overall mean as ``prior_weight`` rows before them; so no row's value depends on its own target. Null is a
    category. Running sums come from a range sort, so a category of any size lies in several ranges."""
    prior = df.agg(F.avg(number(col(target)))).first()[0] or 0.0
    y = F.coalesce(number(col(target)), F.lit(0.0))
    rows = df.select(
        F.struct(*(col(c) for c in df.columns)).alias("row"), col(category).isNull().alias("none"),
        F.coalesce(col(category).cast("string"), F.lit("")).alias("c"),
        (F.struct(*map(col, order_by)) if order_by else F.xxhash64(F.lit(seed), *(col(x) for x in df.columns if x != target))).alias("h"),
        y.alias("y"), F.lit(1).alias("n"),
    )
    found = group_running(rows, ["none", "c"], ["h", "y"], "y", "n")
    mean = (F.col("y_upto") - F.col("y") + F.lit(float(prior)) * prior_weight) / (F.col("n_upto") - 1 + prior_weight)
    return found.select("row.*", mean.alias(f"{category}_ordered"))


class CatBoost(Boosted):
    """Symmetric trees, and ordered target statistics of the features named in ``cat_features`` (text or numbers).

    Rows to be predicted get the statistics of all rows that were fitted; a category that wasn't seen gets the prior.
    """

    kind = "catboost"
    DEFAULTS = {"growth": "symmetric", "trees": 1000, "rate": 0.03, "lambda_": 3.0, "child_weight": 0.0, "bins": 255}
    NAMES = {
        "iterations": "trees", "n_estimators": "trees", "num_boost_round": "trees", "learning_rate": "rate", "depth": "depth", "max_depth": "depth",
        "l2_leaf_reg": "lambda_", "reg_lambda": "lambda_", "rsm": "columns_share", "colsample_bylevel": "columns_share", "subsample": "rows_share",
        "border_count": "bins", "max_bin": "bins", "random_seed": "seed", "random_state": "seed",
    }

    def policy(self, name: str, value: str) -> dict[str, Any]:
        if (name, value) not in (("boosting_type", "Plain"), ("grow_policy", "SymmetricTree")):
            raise ValueError(f"{self.kind}: no {name} {value!r}")
        return {}

    def fit(self, df: DataFrame, features: Sequence[str], target: str) -> CatBoost:
        missing = [c for c in self.categories if c not in features]
        if missing:
            raise ValueError(f"{self.kind}: cat_features that aren't features: {missing}")
        if not self.categories:
            return super().fit(df, features, target)
        ship(df.sparkSession)
        narrow = df.select(*(col(c) for c in dict.fromkeys([*features, target])))
        self.prior = float(narrow.agg(F.avg(number(col(target)))).first()[0] or 0.0)
        self.statistics: dict[str, DataFrame] = {}
        for c in self.categories:
            by = narrow.groupBy(col(c).cast("string").alias("c")).agg(F.sum(F.coalesce(number(col(target)), F.lit(0.0))).alias("s"), F.count(F.lit(1)).alias("n"))
            self.statistics[c] = written(by.select("c", ((F.col("s") + self.prior) / (F.col("n") + 1)).alias("v")), "statistics")
        for c in self.categories:
            narrow = target_statistics(narrow, c, target, self.rules.seed).drop(c).withColumnRenamed(f"{c}_ordered", c)
        return super().fit(narrow, features, target)

    def predict(self, df: DataFrame, features: Sequence[str]) -> DataFrame:
        if not self.categories:
            return super().predict(df, features)
        own, made = df.columns, df.select(F.struct(*(col(c) for c in df.columns)).alias("__row"), *(col(c) for c in features))
        for c in self.categories:
            right = self.statistics[c].select(F.col("c").alias("__c"), F.col("v").alias("__v"))
            made = made.join(right, col(c).cast("string").eqNullSafe(F.col("__c")), "left").withColumn(c, F.coalesce("__v", F.lit(self.prior))).drop("__c", "__v")
        found = super().predict(made, features)
        return found.select(*(F.col(f"__row.`{c}`").alias(c) for c in own if c != "prediction"), "prediction")

    def predict_one(self, values: Sequence[float]) -> float:
        if self.categories:
            raise ValueError("catboost with cat_features predicts tables, not single rows")
        return super().predict_one(values)

    def state(self) -> dict[str, Any]:
        if self.categories:
            raise ValueError("catboost with cat_features can't be saved: its statistics are a table")
        return super().state()

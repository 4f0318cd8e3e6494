"""Gradient boosting of regression trees with second-order gains, L1 and L2 penalties, as DataFrame aggregates.

Values are binned once at quantiles.  A level of a tree is one aggregate: sums of gradients and rows by (node, feature,
bin), which collapse in the map task; running sums over the bins give the gain of every cut, and one row a node
reaches the driver.  A fitted ensemble is a column expression, so prediction is part of whatever plan reads it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.session import pin

MISSING = -1        # bin of null and NaN
REWRITE = 8         # trees after which the predictions so far are written


@dataclass
class Node:
    """A node of a tree: sums of its training rows, and its cut if it has one (left: value < threshold)."""

    gradient: float
    rows: float
    feature: int | None = None
    bin: int | None = None
    threshold: float | None = None
    missing_left: bool = False
    gain: float | None = None


Tree = dict[int, Node]      # the root is 1, the children of n are 2n and 2n + 1


def soft(value, l1: float):
    """The value moved towards 0 by ``l1``, not beyond."""
    return max(abs(value) - l1, 0.0) * (1 if value > 0 else -1)


def _numbers(df: DataFrame, features: str | Sequence[str]) -> list[Column]:
    """The feature columns as doubles; a vector column gives one for each of its places.  NaN counts as missing."""
    if isinstance(features, str):
        parts = vector_to_array(F.col(features))
        size = df.select(F.size(parts).alias("n")).first()
        found = [parts[i] for i in range(size.n if size else 0)]
    else:
        found = [F.col(c).cast("double") for c in features]
    return [F.when(~F.isnan(c), c) for c in found]


@dataclass
class GradientBoosting:
    """Estimator of boosted trees for the squared error.

    ``l1`` and ``l2`` penalise leaf values, a cut must gain ``min_gain`` (trees are grown to ``depth``, then cut back) and leave
    ``min_rows`` rows on either side; ``subsample`` and ``feature_share`` choose rows and features of each tree by hashes of the seed.
    ``features``: a vector column or a list of number columns.  Missing values go to the side that gains more.
    """

    trees: int = 20
    depth: int = 2
    rate: float = 0.1
    l1: float = 0.0
    l2: float = 1.0
    min_gain: float = 0.0
    min_rows: float = 1.0
    subsample: float = 1.0
    feature_share: float = 1.0
    bins: int = 255
    base: float = 0.5
    seed: int = 7
    features: str | Sequence[str] = "features"
    label: str = "label"
    prediction: str = "prediction"

    def setLabelCol(self, name: str) -> GradientBoosting:      # as Spark ML names it, so that searches take either
        return replace(self, label=name)

    def setPredictionCol(self, name: str) -> GradientBoosting:
        return replace(self, prediction=name)

    def fit(self, df: DataFrame) -> BoostedModel:
        """Rows without a label are left out; a table without rows gives the base value."""
        return self.fit_many(df, [self.label])[0]

    def fit_many(self, df: DataFrame, labels: Sequence[str], predictions: Sequence[str] | None = None) -> list[BoostedModel]:
        """One ensemble for each label, grown side by side: a level of all their trees is one scan."""
        there = F.lit(False)
        for label in labels:
            there = there | F.col(label).isNotNull()
        df = df.filter(there)
        numbers = _numbers(df, self.features)
        edges = self._edges(df, numbers)
        rows = pin(self._binned(df, numbers, edges, labels), "boosting")
        made: list[list[Tree]] = [[] for _ in labels]
        for number in range(self.trees):
            trees = self._grow(rows, number, len(labels), edges)
            for t, tree in enumerate(trees):
                made[t].append(tree)
            if number + 1 < self.trees:
                rows = rows.withColumns({f"pred{t}": F.expr(f"pred{t} + {value_sql(tree, self._leaf)}") for t, tree in enumerate(trees)})
                if number % REWRITE == REWRITE - 1:
                    rows = pin(rows, "boosting")
        names = predictions or [self.prediction] * len(labels)
        return [BoostedModel(replace(self, label=label, prediction=name), trees)
                for label, name, trees in zip(labels, names, made, strict=True)]

    def _leaf(self, node: Node) -> float:
        return -soft(node.gradient, self.l1) / (node.rows + self.l2) * self.rate if node.rows + self.l2 else 0.0

    def _edges(self, df: DataFrame, numbers: list[Column]) -> list[list[float]]:
        """Ascending cuts of each feature: its quantiles but the least, all in one aggregate (at most ``bins`` numbers each)."""
        shares = F.array(*[F.lit(i / self.bins) for i in range(self.bins + 1)])
        if not numbers:
            return []
        found = df.agg(*[F.percentile_approx(c, shares, 100 * self.bins).alias(str(i)) for i, c in enumerate(numbers)]).first()
        return [sorted(set(values or []))[1:] for values in found]

    def _binned(self, df: DataFrame, numbers: list[Column], edges: list[list[float]], labels: Sequence[str]) -> DataFrame:
        """(b0, b1, ..., y0, ..., pred0, ..., row): for each feature the number of cuts at or below the value, or ``MISSING``."""
        rows = df.select(*[c.alias(f"x{i}") for i, c in enumerate(numbers)],
                         *[F.col(label).cast("double").alias(f"y{t}") for t, label in enumerate(labels)])
        rows = rows.withColumns({"row": F.xxhash64(*rows.columns), **{f"pred{t}": F.lit(float(self.base)) for t in range(len(labels))}})
        cut = [i for i, e in enumerate(edges) if e]
        if cut:
            rows = Bucketizer(inputCols=[f"x{i}" for i in cut], outputCols=[f"b{i}" for i in cut], handleInvalid="keep",
                              splitsArray=[[float("-inf"), *edges[i], float("inf")] for i in cut]).transform(rows)
        bins = [F.when(F.col(f"x{i}").isNull(), MISSING).otherwise(F.col(f"b{i}") if e else F.lit(0)).cast("int").alias(f"b{i}")
                for i, e in enumerate(edges)]
        return rows.select(*bins, *[c for c in rows.columns if c.startswith(("y", "pred", "row"))])

    def _grow(self, rows: DataFrame, number: int, many: int, edges: list[list[float]]) -> list[Tree]:
        """The next tree of each ensemble, level by level."""
        if self.subsample < 1:
            drawn = F.pmod(F.xxhash64("row", F.lit(self.seed), F.lit(number)), F.lit(1_000_003)) / 1_000_003.0
            rows = rows.filter(drawn < self.subsample)
        used = self._chosen(number, len(edges))
        trees: list[Tree] = [{} for _ in range(many)]
        for level in range(max(self.depth, 1)):
            for row in self._best_cuts(rows, trees, level, used):
                tree, b = trees[row.target], row.best
                node = tree.setdefault(row.node, Node(row.g, row.h))
                if b is None or self.depth == 0:
                    continue
                tree[row.node] = replace(node, feature=b.feature, bin=b.bin, threshold=edges[b.feature][b.bin],
                                         missing_left=b.missing_left, gain=b.gain)
                tree[2 * row.node] = Node(b.gl, b.hl)
                tree[2 * row.node + 1] = Node(row.g - b.gl, row.h - b.hl)
            if not any(n >= 1 << (level + 1) for tree in trees for n in tree):
                break
        for tree in trees:
            self._cut_back(tree)
        return trees

    def _cut_back(self, tree: Tree) -> None:
        """Undo, from the leaves up, cuts that gain too little; a tree of no rows is one leaf."""
        tree.setdefault(1, Node(0.0, 0.0))
        for n in sorted(tree, reverse=True):
            node = tree.get(n)
            if node and node.feature is not None and node.gain < self.min_gain and not any(
                    tree[c].feature is not None for c in (2 * n, 2 * n + 1)):
                tree[n] = Node(node.gradient, node.rows)
                del tree[2 * n], tree[2 * n + 1]

    def _chosen(self, number: int, n: int) -> list[int]:
        if self.feature_share >= 1:
            return list(range(n))
        import random

        return sorted(random.Random(f"{self.seed}-{number}").sample(range(n), max(1, int(n * self.feature_share))))

    def _best_cuts(self, rows: DataFrame, trees: list[Tree], level: int, used: list[int]) -> list:
        """(target, node, g, h, best) for each node of the level: the sums of its rows and its best cut, null where none gains."""
        ensembles = ", ".join(f"named_struct('target', {t}, 'node', CASE WHEN y{t} IS NOT NULL THEN {node_sql(tree, level)} END, "
                              f"'grad', pred{t} - y{t})" for t, tree in enumerate(trees))
        cells = ", ".join(f"named_struct('feature', {i}, 'bin', b{i})" for i in used) or "named_struct('feature', -1, 'bin', 0)"
        at = rows.selectExpr(f"array({cells}) AS cells", f"inline(array({ensembles}))").where("node IS NOT NULL")
        sums = (at.selectExpr("target", "node", "grad", "inline(cells)").groupBy("target", "node", "feature", "bin")
                .agg(F.expr("sum(grad) AS g"), F.expr("double(count(*)) AS h")))
        whole = "OVER (PARTITION BY target, node, feature)"
        upto = "OVER (PARTITION BY target, node, feature ORDER BY bin)"         # the missing bin comes first
        table = sums.selectExpr(
            "target", "node", "feature", "bin", f"sum(g) {whole} AS all_g", f"sum(h) {whole} AS all_h",
            f"coalesce(sum(CASE WHEN bin = {MISSING} THEN g END) {whole}, 0D) AS no_g",
            f"coalesce(sum(CASE WHEN bin = {MISSING} THEN h END) {whole}, 0D) AS no_h",
            f"coalesce(sum(CASE WHEN bin <> {MISSING} THEN g END) {upto}, 0D) AS low_g",
            f"coalesce(sum(CASE WHEN bin <> {MISSING} THEN h END) {upto}, 0D) AS low_h")
        sides = ("array(named_struct('missing_left', false, 'gl', low_g, 'hl', low_h), "
                 "named_struct('missing_left', true, 'gl', low_g + no_g, 'hl', low_h + no_h))")

        def strength(g: str, h: str) -> str:
            return f"coalesce(try_divide(pow(greatest(abs({g}) - {float(self.l1)}D, 0D), 2), {h} + {float(self.l2)}D), 0D)"

        cuts = table.selectExpr("*", f"inline({sides})").selectExpr(
            "*", f"{strength('gl', 'hl')} + {strength('(all_g - gl)', '(all_h - hl)')} - {strength('all_g', 'all_h')} AS gain")
        least = max(float(self.min_rows), 1e-9)
        good = f"bin <> {MISSING} AND feature >= 0 AND hl >= {least}D AND all_h - hl >= {least}D AND gain > 1e-9D"
        # equal gains: the first feature, the lowest cut, missing values to the right
        best = (f"max(CASE WHEN {good} THEN struct(gain, -feature AS f, -bin AS b, NOT missing_left AS m, feature, bin, missing_left, gl, hl) END)")
        return cuts.groupBy("target", "node").agg(
            F.expr("max_by(all_g, -feature) AS g"), F.expr("max(all_h) AS h"), F.expr(f"{best} AS best")).collect()


def _side(node: Node, left: str, right: str) -> str:
    """``left`` or ``right`` by the cut of the node."""
    below = f"b{node.feature} <= {node.bin}"
    below = f"({below})" if node.missing_left else f"(b{node.feature} <> {MISSING} AND {below})"      # the missing bin is below all
    return f"CASE WHEN {below} THEN {left} ELSE {right} END"


def node_sql(tree: Tree, level: int) -> str:
    """Number of the node of a level that a binned row is in, null if it is in a leaf above."""
    def at(n: int) -> str:
        if n >= 1 << level:
            return str(n)
        node = tree.get(n)
        return "NULL" if node is None or node.feature is None else _side(node, at(2 * n), at(2 * n + 1))

    return f"int({at(1)})"


def value_sql(tree: Tree, leaf) -> str:
    """Value of the leaf a binned row is in."""
    def at(n: int) -> str:
        node = tree[n]
        return f"double('{float(leaf(node))!r}')" if node.feature is None else _side(node, at(2 * n), at(2 * n + 1))

    return at(1)


@dataclass
class BoostedModel:
    settings: GradientBoosting
    trees: list[Tree] = field(default_factory=list)

    def _table(self, tree: Tree) -> Column:
        """The tree as a full one of ``depth`` levels: features, thresholds and missing sides by node, values by leaf."""
        depth = max(self.settings.depth, 1)
        inner = 1 << depth
        features, cuts, sides, values = [0] * inner, [float("inf")] * inner, [True] * inner, [0.0] * inner
        for n, node in tree.items():
            if node.feature is None:
                first, last = n, n              # the leaves below, where the tree ends above the last level
                while first < inner:
                    first, last = 2 * first, 2 * last + 1
                values[first - inner:last - inner + 1] = [float(self.settings._leaf(node))] * (last - first + 1)
            else:
                features[n], cuts[n], sides[n] = node.feature, float(node.threshold), node.missing_left
        return F.struct(*[F.array(*map(F.lit, part)).alias(name) for name, part in (
            ("feature", features), ("cut", cuts), ("left", sides), ("value", values))])

    def transform(self, df: DataFrame) -> DataFrame:
        return self.staged(df, {self.settings.prediction: len(self.trees)})

    def staged(self, df: DataFrame, counts: dict[str, int]) -> DataFrame:
        """Add a column with the prediction of the first so many trees, for each name in ``counts``.

        Trees are rows of a constant that one expression walks, so the plan does not grow with their number.
        """
        depth = max(self.settings.depth, 1)
        df = df.withColumn("_numbers", F.array(*_numbers(df, self.settings.features)))
        x = F.col("_numbers")

        def step(tree: Column, at: Column) -> Column:
            value = F.get(x, F.element_at(tree["feature"], at + 1))
            left = F.when(value.isNull(), F.element_at(tree["left"], at + 1)).otherwise(value < F.element_at(tree["cut"], at + 1))
            return 2 * at + F.when(left, 0).otherwise(1)

        def leaf(total: Column, tree: Column) -> Column:
            at = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(1), lambda n, _: step(tree, n))
            return total + F.element_at(tree["value"], at - (1 << depth) + 1)

        total, done, out = F.when(x.isNotNull(), float(self.settings.base)), 0, {}
        for name, n in sorted(counts.items(), key=lambda c: c[1]):
            if n > done:
                total, done = F.aggregate(F.array(*[self._table(t) for t in self.trees[done:n]]), total, leaf), n
            out[name] = total
        return df.withColumns(out).drop("_numbers")

    def describe(self, df: DataFrame) -> DataFrame:
        """One row a node: tree, node, feature, threshold, gain, and the value of a leaf."""
        rows = [(t, n, x.feature, x.threshold, x.gain, self.settings._leaf(x) if x.feature is None else None)
                for t, tree in enumerate(self.trees, 1) for n, x in sorted(tree.items())]
        return df.sparkSession.createDataFrame(rows, "tree int, node int, feature int, threshold double, gain double, value double")

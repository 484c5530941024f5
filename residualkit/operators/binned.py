"""Spark's gradient-boosted trees for all folds at once, on rows kept as small bins.

Spark's boosting keeps only the bin of each feature and the residuals, but holds them as objects, reads them once a fold
and level, and starts a few jobs for each. Here the rows of all folds are written once, in blocks: a byte or
two for the bin of each feature and one residual for each fold's model. A pass over the blocks adds up, for every model and open node, the
residuals by feature and bin; the driver chooses the splits. So a level of the trees of all folds is one job, and what a
task holds is one block and the sums.

The split candidates are those of Spark, found by Spark for each fold. Gains, limits, leaves, the pruning of equal
leaves, the gradients and the weights of the trees follow Spark as well, and the result is Spark's model; only the order in which
numbers are added differs. The residuals are written again every ``STORE`` trees; in between, the trees since then are applied on the fly.

The blocks of a fold are held out of its own model and give the loss after each tree for nothing. A model is finished when
``patience`` trees in a row brought no improvement.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import AbstractContextManager
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from py4j.java_gateway import JavaClass, JavaObject
from pyspark import SparkContext, TaskContext
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from residualkit.operators.metrics import best_prefix
from residualkit.staging import arrow_rows, delete_staged, new_path, session_conf, stage

BLOCK_ROWS = 1 << 15
BLOCK_CELLS = 1 << 19
STORE = 8
MOST_DEPTH = 7
MOST_BYTES = 1 << 26
ADDED_AT_ONCE = 32
CODED = 8
PART_ROWS = 1 << 17
TASKS_A_CORE = 3
SAMPLE_MARGIN = 1.2
EPSILON = 2.0**-52
NODES = 2 << MOST_DEPTH
#: Blocks are about a megabyte; small row groups spread them over the tasks and bound what a reader holds.
WRITTEN = {"parquet.block.size": str(16 << 20), "compression": "uncompressed"}

BLOCKS = "fold int, n int, bins binary, residuals binary"
SUMS = "part int, sums binary"


@dataclass
class Tree:
    """The ``number``-th tree of a model. Nodes have heap numbers: the root is 1, the children of i are 2 i and 2 i + 1.

    ``splits``: feature, place among the merged cuts and gain. ``sizes``: rows and sum of the targets. ``squares``: their sum of squares.
    """

    number: int
    weight: float
    splits: dict[int, tuple[int, int, float]] = field(default_factory=dict)
    sizes: dict[int, tuple[float, float]] = field(default_factory=dict)
    squares: dict[int, float] = field(default_factory=dict)
    known: dict[int, np.ndarray] = field(default_factory=dict)

    def reached(self, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A code for each row, and the node of each code; ``bins`` has a row for each feature.

        With few splits, the code has a bit for the side of every split.
        """
        if len(self.splits) > CODED:
            return self._walk(bins.shape[1], lambda i: bins[self.splits[i][0]] > self.splits[i][1]), np.arange(NODES)
        code = np.zeros(bins.shape[1], np.uint8)
        for bit, (feature, cut, _) in enumerate(self.splits.values()):
            code |= (bins[feature] > cut).view(np.uint8) * np.uint8(1 << bit)
        if len(self.splits) not in self.known:
            every, bits = np.arange(1 << len(self.splits)), {i: b for b, i in enumerate(self.splits)}
            self.known[len(self.splits)] = self._walk(len(every), lambda i: (every >> bits[i] & 1).astype(bool)).astype(np.intp)
        return code, self.known[len(self.splits)]

    def _walk(self, n: int, is_right: Callable[[int], np.ndarray]) -> np.ndarray:
        node = np.ones(n, np.uint8)
        for level in range(MOST_DEPTH):
            right, moved = np.zeros(n, bool), np.zeros(n, bool)
            for i in self.splits:
                if i >> level == 1:
                    own = node == i
                    right |= own & is_right(i)
                    moved |= own
            if not moved.any():
                break
            node = np.where(moved, 2 * node + right, node)
        return node

    def added(self, bins: np.ndarray) -> np.ndarray:
        """What the tree adds to the prediction of each row."""
        code, nodes = self.reached(bins)
        values = np.zeros(NODES)
        for i, (n, total) in self.sizes.items():
            values[i] = self.weight * (total / n)
        return looked_up(values[nodes], code)

    def impurity(self, i: int) -> float:
        n, total = self.sizes[i]
        return (self.squares.get(i, 0.0) - total * total / n) / n


@dataclass(frozen=True)
class Task:
    """What a pass does for one model: apply ``pending``, then add up the targets in the open nodes of ``tree``.

    Of two children only the smaller one, in ``nodes``, is added up by feature and bin; the other is the rest of their parent.
    The first pass of a tree also measures the last pending one. The rows in the bins of the root are the same for
    all trees, and ``counted`` once.
    """

    pending: tuple[Tree, ...]
    tree: Tree
    open: tuple[int, ...]
    nodes: tuple[int, ...]
    first: bool
    counted: bool

    def sums(self, width: int, depth: int) -> dict[str, np.ndarray]:
        """Zeros for: rows and targets by node, feature and bin; squares by open node, and by leaf of the last pending tree; losses held out."""
        n = len(self.nodes)
        rows = {} if self.counted else {"n": np.zeros((n, width, depth))}
        return rows | {"s": np.zeros((n, width, depth)), "q": np.zeros(len(self.open)), "leaf": np.zeros(NODES), "held": np.zeros(3)}

    def add(self, sums: dict[str, np.ndarray], target: np.ndarray, bins: np.ndarray) -> None:
        n, width, depth = sums["s"].shape
        code, nodes = self.tree.reached(bins)
        sums["q"] += np.bincount(code, target * target, len(nodes))[: len(nodes)] @ (nodes[:, None] == np.array(self.open))
        starts = np.full(NODES, -1)
        starts[list(self.nodes)] = np.arange(n) * depth
        start = looked_up(starts[nodes], code)
        if self.nodes != (1,):
            chosen = np.flatnonzero(start >= 0)
            start, target, bins = start[chosen], target[chosen], bins[:, chosen]
        for i in range(width):
            at = start + bins[i]
            sums["s"][:, i] += np.bincount(at, target, n * depth).reshape(n, depth)
            if not self.counted:
                sums["n"][:, i] += np.bincount(at, minlength=n * depth).reshape(n, depth)


def looked_up(values: np.ndarray, code: np.ndarray) -> np.ndarray:
    return values.take(code.astype(np.intp), mode="clip")


def targets(residual: np.ndarray, loss: str, number: int) -> np.ndarray:
    """What a tree is fitted to: the labels at first, then the negative gradient."""
    if number == 0:
        return residual
    return 2.0 * residual if loss == "squared" else np.where(residual < 0, -1.0, 1.0)


def _to_blocks(batches: Iterator[pa.RecordBatch], cuts: Sequence[np.ndarray], k: int, kind: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        folds, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        rows = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(folds), -1)
        for fold in np.unique(folds).tolist():
            at = np.flatnonzero(folds == fold)
            bins = np.stack([np.searchsorted(c, rows[at, i]) for i, c in enumerate(cuts)]).astype(kind)
            yield _block(fold, bins, np.tile(labels[at].astype(np.float64), (k, 1)))


def _block(fold: int, bins: np.ndarray, residuals: np.ndarray) -> pa.RecordBatch:
    values = [pa.array([fold], pa.int32()), pa.array([bins.shape[1]], pa.int32())]
    values += [pa.array([v.tobytes()], pa.binary()) for v in (bins, residuals)]
    return pa.RecordBatch.from_arrays(values, names=["fold", "n", "bins", "residuals"])


def _read_blocks(batches: Iterator[pa.RecordBatch], k: int, kind: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for fold, n, bins, residuals in zip(*(batch.column(i) for i in range(4)), strict=True):
            rows = n.as_py()
            yield fold.as_py(), np.frombuffer(bins.as_buffer(), kind).reshape(-1, rows), np.frombuffer(residuals.as_buffer()).reshape(k, rows)


def _advance(batches: Iterator[pa.RecordBatch], pending: Sequence[Sequence[Tree]], kind: str) -> Iterator[pa.RecordBatch]:
    """Blocks with the residuals after the pending trees of each model."""
    for fold, bins, residuals in _read_blocks(batches, len(pending), kind):
        left = residuals.copy()
        for own, trees in zip(left, pending, strict=True):
            for tree in trees:
                own -= tree.added(bins)
        yield _block(fold, bins, left)


def _added_up(
    batches: Iterator[pa.RecordBatch], tasks: Sequence[Task | None], loss: str, width: int, depth: int, kind: str
) -> Iterator[pa.RecordBatch]:
    """One row: the sums of all models over the blocks of a partition, one after the other."""
    sums = [t and t.sums(width, depth) for t in tasks]
    for fold, bins, residuals in _read_blocks(batches, len(tasks), kind):
        for j, (task, own) in enumerate(zip(tasks, sums, strict=True)):
            if task is None or (j == fold and not task.first):
                continue
            residual = residuals[j]
            for tree in task.pending:
                if task.first and j != fold and tree is task.pending[-1]:
                    code, nodes = tree.reached(bins)
                    squares = np.bincount(code, targets(residual, loss, tree.number) ** 2, len(nodes))
                    own["leaf"] += np.bincount(nodes, squares[: len(nodes)], NODES)
                residual = residual - tree.added(bins)
            if j == fold:
                own["held"] += (len(residual), np.abs(residual).sum(), (residual * residual).sum())
            elif task.open:
                task.add(own, targets(residual, loss, task.tree.number), bins)
    yield _packed(TaskContext.get().partitionId(), np.concatenate([v.ravel() for own in sums if own for v in own.values()]))


def _packed(part: int, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["part", "sums"])


def _total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, least = None, 0
    for batch in batches:
        for part, sums in zip(batch.column(0), batch.column(1), strict=True):
            own = np.frombuffer(sums.as_buffer())
            total, least = (own, part.as_py()) if total is None else (total + own, least)
    if total is not None:
        yield _packed(least, total)


@dataclass
class Fold:
    """The model of one fold: where its candidates lie among the merged cuts, its limits, and its trees so far."""

    places: list[np.ndarray]
    least_weight: float
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)
    stored: int = 0
    done: bool = False
    counts: np.ndarray | None = None
    tree: Tree | None = None
    open: tuple[int, ...] = ()
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    def task(self, first: bool) -> Task | None:
        if self.done or not (first or self.open):
            return None
        smaller = [min(pair, key=lambda i: self.tree.sizes[i][0]) for pair in zip(self.open[::2], self.open[1::2], strict=False)]
        nodes = tuple(smaller) if smaller else self.open
        return Task(tuple(self.trees[self.stored :]), self.tree, self.open, nodes, first, first and self.counts is not None)


@dataclass
class Binned:
    """All rows in blocks, and the models that are fitted on them."""

    estimator: GBTRegressor
    metric: str
    patience: int | None
    cuts: list[np.ndarray]
    folds: list[Fold]
    kind: str
    state: DataFrame
    path: str
    parts: int

    def fit(self) -> None:
        loss = self.estimator.getLossType()
        for number in range(self.estimator.getMaxIter()):
            weight = self.estimator.getStepSize() if number else 1.0
            for own in self.folds:
                own.tree, own.open = Tree(number, weight), (1,)
            for level in range(max(1, self.estimator.getMaxDepth())):
                tasks = [own.task(first=level == 0) for own in self.folds]
                if not any(tasks):
                    break
                for own, task, sums in zip(self.folds, tasks, self._pass(tasks, loss), strict=True):
                    if task is not None:
                        self._measure(own, task, sums)
                        if not own.done:
                            self._split(own, task, level, sums)
            grown = [own for own in self.folds if not own.done]
            if not grown:
                return
            for own in grown:
                own.trees.append(own.tree)
            if len(grown[0].trees) - grown[0].stored >= STORE and number + 1 < self.estimator.getMaxIter():
                self._store()
        for own in self.folds:
            own.open = ()
        tasks = [own.task(first=True) for own in self.folds]
        for own, task, sums in zip(self.folds, tasks, self._pass(tasks, loss), strict=True):
            if task is not None:
                self._measure(own, task, sums)

    def _pass(self, tasks: Sequence[Task | None], loss: str) -> list[dict[str, np.ndarray] | None]:
        width, depth = len(self.cuts), 1 + max(len(c) for c in self.cuts)
        work = partial(_added_up, tasks=tasks, loss=loss, width=width, depth=depth, kind=self.kind)
        with arrow_rows(self.state.sparkSession, 2), _many_tasks(self.state.sparkSession):
            rows = self.state.mapInArrow(work, SUMS)
            parts = self.parts
            while parts > ADDED_AT_ONCE:
                parts = -(-parts // ADDED_AT_ONCE)
                dealt = rows.repartition(parts, F.floor(F.col("part") / ADDED_AT_ONCE))
                rows = dealt.sortWithinPartitions("part").mapInArrow(_total, SUMS)
            found = sorted(rows.collect(), key=lambda r: r["part"])
        total = sum(np.frombuffer(r["sums"]) for r in found)
        out, begin = [], 0
        for task in tasks:
            sums = task and task.sums(width, depth)
            for name, zeros in (sums or {}).items():
                sums[name] = total[begin : begin + zeros.size].reshape(zeros.shape)
                begin += zeros.size
            out.append(sums)
        return out

    def _measure(self, own: Fold, task: Task, sums: dict[str, np.ndarray]) -> None:
        """Squares and loss of the last tree, from the first pass after it; and whether the model is finished."""
        if not task.first or not own.trees:
            return
        last = own.trees[-1]
        last.squares |= {i: sums["leaf"][i] for i in last.sizes if i not in last.splits}
        rows, absolute, squared = sums["held"]
        own.losses.append(float((absolute if self.metric == "absolute" else squared) / rows) if rows else float("nan"))
        if self.patience is not None:
            own.done = len(own.losses) - best_prefix(own.losses, self.patience) >= self.patience

    def _split(self, own: Fold, task: Task, level: int, sums: dict[str, np.ndarray]) -> None:
        """Split the open nodes where that gains."""
        if level == 0:
            own.counts = sums.get("n", own.counts)
            own.sums = {1: (own.counts[0], sums["s"][0])}
            own.tree.sizes[1] = (own.counts[0, 0].sum(), sums["s"][0, 0].sum())
        else:
            found = {i: (sums["n"][place], sums["s"][place]) for place, i in enumerate(task.nodes)}
            rest = {i ^ 1: tuple(a - b for a, b in zip(own.sums[i >> 1], v, strict=True)) for i, v in found.items()}
            own.sums = found | rest
        after: list[int] = []
        for i, squares in zip(task.open, sums["q"], strict=True):
            own.tree.squares[i] = float(squares)
            if level >= self.estimator.getMaxDepth() or (i > 1 and abs(own.tree.impurity(i)) < EPSILON):
                continue
            gain, feature, cut, left, right = self._best(own, *own.sums[i])
            if gain > 0:
                own.tree.splits[i] = (feature, cut, gain)
                own.tree.sizes |= {2 * i: left, 2 * i + 1: right}
                after += [2 * i, 2 * i + 1]
        own.open = tuple(after) if level + 1 < self.estimator.getMaxDepth() else ()

    def _best(
        self, own: Fold, rows: np.ndarray, totals: np.ndarray
    ) -> tuple[float, int, int, tuple[float, float], tuple[float, float]]:
        """Gain, feature, cut, and rows and sum of both sides of the best split; the first one of equals."""
        best = (0.0, 0, 0, (0.0, 0.0), (0.0, 0.0))
        least = max(self.estimator.getMinInstancesPerNode(), own.least_weight)
        for feature, places in enumerate(own.places):
            if not len(places):
                continue
            n, s = np.cumsum(rows[feature]), np.cumsum(totals[feature])
            left, left_sum = n[places], s[places]
            right, right_sum = n[-1] - left, s[-1] - left_sum
            with np.errstate(divide="ignore", invalid="ignore"):
                gains = (left_sum**2 / left + right_sum**2 / right - s[-1] ** 2 / n[-1]) / n[-1]
            gains = np.where((left >= least) & (right >= least) & (gains >= self.estimator.getMinInfoGain()), gains, -np.inf)
            at = int(np.argmax(gains))
            if gains[at] > best[0]:
                best = (float(gains[at]), feature, int(places[at]), (float(left[at]), float(left_sum[at])), (float(right[at]), float(right_sum[at])))
        return best

    def _store(self) -> None:
        pending = [own.trees[own.stored :] if not own.done else [] for own in self.folds]
        work = partial(_advance, pending=pending, kind=self.kind)
        before = self.path
        self.state, self.path, self.parts = _written(self.state.mapInArrow(work, BLOCKS), 2)
        delete_staged(self.state.sparkSession, before)
        for own in self.folds:
            own.stored = len(own.trees)

    def model(self, own: Fold) -> GBTRegressionModel:
        """The model of all trees, or of the best prefix where there is patience."""
        context = self.state.sparkSession.sparkContext
        java = Classes.of(context)
        kept = own.trees if self.patience is None else own.trees[: best_prefix(own.losses, self.patience)]
        trees = context._gateway.new_array(java.tree, len(kept))
        weights = context._gateway.new_array(java.double, len(kept))
        for i, tree in enumerate(kept):
            trees[i] = java.tree(self._node(java, tree, 1)[0], len(self.cuts))
            weights[i] = tree.weight
        made = GBTRegressionModel(java.model(f"{self.estimator.uid}_model", trees, weights, len(self.cuts)))
        return self.estimator._copyValues(made)

    def _node(self, java: Classes, tree: Tree, i: int) -> tuple[JavaObject, float | None]:
        """Spark's node, and its prediction if it is a leaf. Leaves of one parent that say the same are one leaf."""
        n, total = tree.sizes[i]
        stats = java.numbers((n, total, tree.squares.get(i, 0.0)))
        here, impurity = total / n, tree.impurity(i)
        if i not in tree.splits:
            return java.leaf(here, impurity, stats), here
        (left, one), (right, two) = (self._node(java, tree, c) for c in (2 * i, 2 * i + 1))
        if one is not None and one == two:
            return java.leaf(one, impurity, stats), one
        feature, cut, gain = tree.splits[i]
        split = java.split(feature, float(self.cuts[feature][cut]))
        return java.inner(here, impurity, gain, left, right, split, stats), None


@dataclass(frozen=True)
class Classes:
    """The classes of Spark that a model is made of, looked up once."""

    model: JavaClass
    tree: JavaClass
    leaf: JavaClass
    inner: JavaClass
    split: JavaClass
    calculator: JavaClass
    double: JavaClass
    array: Callable[[JavaClass, int], JavaObject]

    @classmethod
    def of(cls, context: SparkContext) -> Classes:
        ml, nodes = context._jvm.org.apache.spark.ml.regression, context._jvm.org.apache.spark.ml.tree
        variance = context._jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
        trees = (ml.GBTRegressionModel, ml.DecisionTreeRegressionModel, nodes.LeafNode, nodes.InternalNode, nodes.ContinuousSplit)
        return cls(*trees, variance, context._jvm.double, context._gateway.new_array)

    def numbers(self, values: tuple[float, float, float]) -> JavaObject:
        stats = self.array(self.double, 3)
        for i, v in enumerate(values):
            stats[i] = float(v)
        return self.calculator(stats, int(values[0]))


def _many_tasks(spark: SparkSession) -> AbstractContextManager[None]:
    """Blocks are read in more tasks than there are cores, so that no core waits long for the others."""
    return session_conf(spark, "spark.sql.files.minPartitionNum", str(TASKS_A_CORE * spark.sparkContext.defaultParallelism))


def _written(blocks: DataFrame, rows: int) -> tuple[DataFrame, str, int]:
    """Blocks that were written, their folder, and the number of partitions they are read in."""
    path = new_path(blocks.sparkSession, "binned")
    with arrow_rows(blocks.sparkSession, rows):
        state = stage(blocks, "binned", path=path, **WRITTEN)
    with _many_tasks(blocks.sparkSession):
        return state, path, state._jdf.rdd().getNumPartitions()


def covers(estimator: Estimator, vectors: DataFrame, k: int) -> bool:
    """Whether trees of this kind can be fitted here: of all rows and features, alike in weight, not too deep, and with few enough sums for the driver."""
    if type(estimator) is not GBTRegressor or k < 2 or not 1 <= estimator.getMaxIter() or not 0 <= estimator.getMaxDepth() <= MOST_DEPTH:
        return False
    named = [estimator.weightCol, estimator.validationIndicatorCol]
    if any(estimator.isSet(p) for p in named) or estimator.getSubsamplingRate() != 1.0:
        return False
    if estimator.getFeatureSubsetStrategy().lower() not in ("auto", "all"):
        return False
    one = vectors.select(estimator.getFeaturesCol()).first()
    if one is None or one[0] is None or not _categorical(vectors, estimator).isEmpty():
        return False
    sums = 2 ** max(0, estimator.getMaxDepth() - 1) * one[0].size * k * (estimator.getMaxBins() - 1) * k * 16
    return sums <= MOST_BYTES


def _scala(rows: DataFrame, name: str) -> JavaObject:
    """An object of Spark ML by its path below ``org.apache.spark.ml``."""
    found = rows.sparkSession.sparkContext._jvm.org.apache.spark.ml
    for part in f"{name}$.MODULE$".split("."):
        found = getattr(found, part)
    return found


def _categorical(rows: DataFrame, estimator: GBTRegressor) -> JavaObject:
    """The features that the column itself calls categories, a map of Scala."""
    return _scala(rows, "util.MetadataUtils").getCategoricalFeatures(rows._jdf.schema().apply(estimator.getFeaturesCol()))


def candidates(estimator: GBTRegressor, sample: DataFrame) -> list[np.ndarray]:
    """The thresholds Spark tries for each feature when it boosts on ``sample``."""
    java, util = estimator._to_java(), _scala(sample, "util.DatasetUtils")
    regression = sample.sparkSession.sparkContext._jvm.org.apache.spark.mllib.tree.configuration.Algo.Regression()
    strategy = java.getOldBoostingStrategy(_categorical(sample, estimator), regression).treeStrategy()
    instances = util.extractInstances(java, sample._jdf, getattr(util, "extractInstances$default$3")())
    metadata = _scala(sample, "tree.impl.DecisionTreeMetadata").buildMetadata(instances, strategy, 1, estimator.getFeatureSubsetStrategy())
    found = _scala(sample, "tree.impl.RandomForest").findSplits(instances, metadata, estimator.getSeed())
    return [np.array([s.threshold() for s in own], np.float64) for own in found]


def fit_folds(
    vectors: DataFrame, estimator: GBTRegressor, k: int, fold: str, patience: int | None = None, loss: str = "absolute"
) -> list[GBTRegressionModel]:
    """One model for each fold, fitted on the other folds; with ``patience``, cut to the best prefix on its own fold.

    Spark takes the thresholds it tries from about 10,000 rows, or the square of the bins; as many are drawn here for each
    fold, in one pass for all, and all rows where there are no more. The trees are fitted on all rows.
    """
    features, label = estimator.getFeaturesCol(), estimator.getLabelCol()
    sizes = {r[fold]: r["count"] for r in vectors.groupBy(fold).count().collect()}
    others = [sum(n for i, n in sizes.items() if i != j) for j in range(k)]
    wanted = SAMPLE_MARGIN * max(estimator.getMaxBins() ** 2, 10000)
    drawn = vectors.select(fold, label, features)
    if min(others) > wanted:
        drawn = stage(drawn.sample(wanted / min(others), estimator.getSeed()), "candidates")
    tried = [candidates(estimator, drawn.filter(F.col(fold) != j)) for j in range(k)]
    cuts = [np.unique(np.concatenate(own)) for own in zip(*tried, strict=True)]
    share = estimator.getMinWeightFractionPerNode()
    folds = [Fold([np.searchsorted(m, c) for m, c in zip(cuts, own, strict=True)], share * n) for own, n in zip(tried, others, strict=True)]
    kind = "uint8" if max(len(c) for c in cuts) < 256 else "uint16"
    # Labels and features that Spark does not fit are errors, as there.
    util = _scala(vectors, "util.DatasetUtils")
    vector, target = Column(util.checkNonNanVectors(features)), Column(util.checkRegressionLabels(label))
    rows = vectors.select(F.col(fold).cast("int").alias("fold"), target.cast("double").alias("label"), vector_to_array(vector).alias("features"))
    # A small table is one of few parts, since each costs a task in every pass.
    rows = rows.coalesce(-(-sum(sizes.values()) // PART_ROWS))
    blocks = rows.mapInArrow(partial(_to_blocks, cuts=cuts, k=k, kind=kind), BLOCKS)
    written = _written(blocks, max(1, min(BLOCK_ROWS, BLOCK_CELLS // len(cuts))))
    binned = Binned(estimator, loss, patience, cuts, folds, kind, *written)
    binned.fit()
    delete_staged(vectors.sparkSession, binned.path)
    return [binned.model(own) for own in folds]

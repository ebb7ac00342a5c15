"""Boosted trees as the library grows them, without a Spark job for each level of each tree.

The library starts one job a level: 1,500 jobs for 300 trees of depth 5. Here the rows stay in the tasks of one job, as
bin numbers of one byte, and the tasks exchange the histograms of a level through the shared folder. Splits,
row samples, feature samples, gains and the rules that end a branch are those of the library, drawn from the same
seeds: the same trees, but for the last bit of sums that are added in another order.
"""

from __future__ import annotations

import math
import os
import pickle
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, SparkContext, TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.session import scratch_path, shared_dir, stored

#: Rows of a task from which a further task is worth its share of the exchange; rows that are held in one piece.
ROWS_PER_TASK, PIECE = 150_000, 65_536
#: Rows of a task where many fits run side by side.
FIT_ROWS = 1_000_000
#: Fewer rows than this are fitted by the library.
LIBRARY_ROWS = 20_000
#: Branches end where the impurity is below this (the library's constant).
EPSILON = 2.0**-52
#: Deeper trees, or more bins than a byte can name, are left to the library.
MOST_DEPTH, MOST_BINS = 10, 256
_ALL = (1 << 64) - 1


@dataclass
class Spec:
    """What a task needs: sorted thresholds of each feature, and the parameters of the fit."""

    thresholds: list[np.ndarray]
    per_node: int
    min_rows: int
    min_gain: float
    depth: int
    trees: int
    rate: float
    subsample: float
    seed: int


@dataclass
class Tree:
    """Nodes in the order of their making; ``feature`` is -1 in a leaf, ``stats`` are sums of weight, w * y, w * y * y."""

    feature: np.ndarray
    cut: np.ndarray  # a row goes left if its bin is at most this
    left: np.ndarray
    right: np.ndarray
    prediction: np.ndarray
    impurity: np.ndarray
    gain: np.ndarray
    stats: np.ndarray
    count: np.ndarray


# ------------------------------------------------------------------- the library's random numbers
def _murmur(data: bytes, seed: int) -> int:
    """MurmurHash3 of eight bytes, as Scala's ``bytesHash`` has it."""
    h = seed
    for i in (0, 4):
        k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) * 0x1B873593 & 0xFFFFFFFF
        h ^= k
        h = ((h << 13 | h >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= 8
    for shift, by in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ h >> shift) * by & 0xFFFFFFFF
    return h ^ h >> 16


def _scrambled(seed: int) -> int:
    data = (seed & _ALL).to_bytes(8, "big")
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


def _step(x):
    x = x ^ (x << 21 & _ALL)
    x ^= x >> 35
    return x ^ (x << 4 & _ALL)


def _double(a, b):
    return ((a & 0x3FFFFFF) * 134217728 + (b & 0x7FFFFFF)) * 2.0**-53


def _image(matrix: list[int], x: int) -> int:
    out, b = 0, 0
    while x:
        if x & 1:
            out ^= matrix[b]
        x, b = x >> 1, b + 1
    return out


def _power(n: int) -> list[int]:
    """Images of the 64 bits after ``n`` steps of the generator: a step is linear over bits."""
    square, out = [_step(1 << b) for b in range(64)], [1 << b for b in range(64)]
    while n:
        if n & 1:
            out = [_image(square, x) for x in out]
        square, n = [_image(square, x) for x in square], n >> 1
    return out


class Draws:
    """Consecutive draws of the XORShift generator, from a given place on and many stretches of them side by side."""

    LANES = 1024
    starts: dict[int, np.ndarray] = {}

    def __init__(self, n: int, skip: int = 0):
        self.n, self.steps, self.skip = n, -(-n // self.LANES), _power(2 * skip)
        if self.steps not in self.starts:
            jump, table = _power(2 * self.steps), np.array([1 << b for b in range(64)], dtype=np.uint64)[:, None]
            while table.shape[1] < self.LANES:
                moved = np.zeros_like(table)
                for b, image in enumerate(jump):
                    moved ^= np.uint64(image) * (table >> np.uint64(b) & np.uint64(1))
                table, jump = np.concatenate([table, moved], axis=1), [_image(jump, x) for x in jump]
            self.starts[self.steps] = table

    def doubles(self, seed: int) -> np.ndarray:
        state = _image(self.skip, _scrambled(seed))
        bits = [b for b in range(64) if state >> b & 1]
        x = np.bitwise_xor.reduce(self.starts[self.steps][bits], axis=0)
        out = np.empty((self.steps, self.LANES))
        c21, c35, c4, c27 = (np.uint64(c) for c in (21, 35, 4, 27))
        low, high = np.uint64(0x3FFFFFF), np.uint64(0x7FFFFFF)
        for i in range(self.steps):
            a = x ^ x << c21
            a ^= a >> c35
            a ^= a << c4
            x = a ^ a << c21
            x ^= x >> c35
            x ^= x << c4
            out[i] = ((a & low) << c27) + (x & high)
        return (out.T.ravel() * 2.0**-53)[: self.n]


class _JavaRandom:
    """``java.util.Random``: its long numbers."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & (1 << 48) - 1

    def _next(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & (1 << 48) - 1
        x = self.state >> 16
        return x - (1 << 32) if x >> 31 else x

    def long(self) -> int:
        return (self._next() << 32) + self._next() & _ALL


def _reservoir(n: int, k: int, seed: int) -> np.ndarray:
    """``k`` of the features 0 to n - 1, in the order that the library looks at them."""
    kept, x = list(range(k)), _scrambled(seed)
    for item in range(k, n):
        a = _step(x)
        x = _step(a)
        at = int(_double(a, x) * (item + 1))
        if at < k:
            kept[at] = item
    return np.array(kept)


# ------------------------------------------------------------------------------- growing
class _Packing:
    """Features of few bins share a byte: 20 columns of 0 and 1 take 4, and a histogram's time goes by the byte."""

    def __init__(self, thresholds: list[np.ndarray]):
        self.bins = np.array([len(t) + 1 for t in thresholds])
        self.most = int(self.bins.max(initial=1))
        self.groups: list[list[int]] = []
        size = 0
        for f in np.argsort(self.bins, kind="stable").tolist():
            if not self.groups or size * self.bins[f] > self.most:
                self.groups.append([])
                size = 1
            self.groups[-1].append(f)
            size *= int(self.bins[f])
        self.column, self.radix = np.zeros(len(self.bins), np.int64), np.ones(len(self.bins), np.int64)
        for c, group in enumerate(self.groups):
            by = 1
            for f in group:
                self.column[f], self.radix[f] = c, by
                by *= int(self.bins[f])

    def packed(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.groups), codes.shape[1]), np.uint8)
        for f, code in enumerate(codes):
            out[self.column[f]] += code * np.uint8(self.radix[f])
        return out

    def by_feature(self, columns: np.ndarray) -> np.ndarray:
        """(sum, column, node, code) -> (sum, feature, node, bin)"""
        sums, _, nodes, _ = columns.shape
        out = np.zeros((sums, len(self.bins), nodes, self.most))
        for c, group in enumerate(self.groups):
            if len(group) == 1:
                out[:, group[0]] = columns[:, c]
                continue
            sizes = [int(self.bins[f]) for f in reversed(group)]
            cube = columns[:, c, :, : math.prod(sizes)].reshape(sums, nodes, *sizes)
            for i, f in enumerate(reversed(group)):
                out[:, f, :, : sizes[i]] = cube.sum(axis=tuple(j + 2 for j in range(len(sizes)) if j != i))
        return out


class Piece:
    """Rows that follow each other in one partition of the matrix, and what the fit knows of them."""

    def __init__(self, part: int, start: int, columns: bytes, label: bytes, weight: bytes | None, spec: Spec):
        self.part, self.start = part, start
        self.label = np.frombuffer(label, np.int8).astype(float)
        n = len(self.label)
        self.columns = np.frombuffer(columns, np.uint8).reshape(-1, n)  # column x row, one byte each
        self.weight = np.frombuffer(weight) if weight else None
        self.margin, self.node = np.zeros(n), np.zeros(n, np.int16)
        self.draws = Draws(n, start) if spec.subsample < 1 else None

    def kept(self, spec: Spec, seed: int) -> np.ndarray:
        """The library's sample: its generator starts anew in each partition."""
        return self.draws.doubles(seed + self.part + 1) < spec.subsample if self.draws else np.ones(len(self.label), bool)


def binned(values: np.ndarray, thresholds: list[np.ndarray]) -> np.ndarray:
    """Bin numbers, feature x row; a value at a threshold is in the lower bin."""
    return np.stack([np.searchsorted(t, values[:, f]).astype(np.uint8) for f, t in enumerate(thresholds)])


def _impurity(w, s, q):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(w == 0, 0.0, (q - s * s / w) / w)


def _best(hist: np.ndarray, own: np.ndarray, impurity: np.ndarray, subsets: list, root: bool, spec: Spec):
    """For each node (feature, cut, gain, left sums, right sums, own sums, own impurity); feature -1 if nothing may split it.

    ``hist`` is (sum, feature, node, bin), sums are rows, weight, w * y, w * y * y.
    """
    total = np.cumsum(hist, axis=3)
    left, right = total[..., :-1], total[..., -1:] - total[..., :-1]
    n_l, w_l, s_l, q_l = left
    n_r, w_r, s_r, q_r = right
    allowed = (n_l >= spec.min_rows) & (n_r >= spec.min_rows)
    sizes = np.array([len(t) for t in spec.thresholds])
    exists = np.arange(hist.shape[3] - 1)[None, None, :] < sizes[:, None, None]
    if root:
        for f in subsets[0]:
            if sizes[f]:
                own = (left[:, f, :, 0] + right[:, f, :, 0]).T
                break
        else:
            own = total[:, 0, :, -1].T
        impurity = _impurity(own[:, 1], own[:, 2], own[:, 3])
    weight = w_l + w_r
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = impurity[None, :, None] - w_l / weight * _impurity(w_l, s_l, q_l) - w_r / weight * _impurity(w_r, s_r, q_r)
    gain = np.where(allowed & exists & (gain >= spec.min_gain), gain, -np.inf)
    cut = gain.argmax(axis=2)
    top = np.take_along_axis(gain, cut[..., None], axis=2)[..., 0]
    out = []
    for k, subset in enumerate(subsets):
        some = subset[sizes[subset] > 0]
        f = int(some[top[some, k].argmax()]) if len(some) else -1
        if f < 0 or top[f, k] == -np.inf:
            out.append((-1, 0, -np.inf, None, None, own[k], impurity[k]))
        else:
            c = int(cut[f, k])
            out.append((f, c, float(top[f, k]), left[:, f, k, c], right[:, f, k, c], own[k], impurity[k]))
    return out


def _histograms(pieces: list[Piece], kept: list, target: list, slot_of: np.ndarray, nodes: int, packing: _Packing) -> np.ndarray:
    """(sum, feature, node, bin) over the sampled rows of the nodes that have a slot."""
    columns, size = len(packing.groups), nodes * packing.most
    weighted = bool(pieces) and pieces[0].weight is not None
    out = np.zeros((4, columns, size))
    for piece, use, y in zip(pieces, kept, target, strict=True):
        slot = slot_of[piece.node]
        at = np.flatnonzero(use & (slot >= 0))
        if not len(at):
            continue
        base = slot[at].astype(np.int64) * packing.most
        y = y[at]
        w = piece.weight[at] if weighted else None
        sums = (w * y, w * y * y) if weighted else (y, y * y)
        for c in range(columns):
            index = base + piece.columns[c][at]
            out[0, c] += np.bincount(index, minlength=size)
            if weighted:
                out[1, c] += np.bincount(index, w, size)
            out[2, c] += np.bincount(index, sums[0], size)
            out[3, c] += np.bincount(index, sums[1], size)
    if not weighted:
        out[1] = out[0]
    return packing.by_feature(out.reshape(4, columns, nodes, packing.most))


def _tree(pieces: list[Piece], kept: list, target: list, spec: Spec, packing: _Packing, seed: int, total: Callable) -> Tree:
    """One regression tree; every task grows the same one, and leaves ``node`` of its rows at their leaf."""
    features = len(spec.thresholds)
    rng = _JavaRandom(seed)
    feature, cut, left, right, gain = [-1], [0], [0], [0], [0.0]
    stats, impurity = [np.zeros(4)], [0.0]
    frontier, parent, above = [0], {}, None
    for level in range(spec.depth + 1):
        if not frontier:
            break
        counted = _counted(frontier, parent, left, right, stats)
        slot_of = np.full(len(feature), -1, dtype=np.int16)
        slot_of[counted] = range(len(counted))
        hist = total(_histograms(pieces, kept, target, slot_of, len(counted), packing))
        if len(counted) < len(frontier):
            hist = _with_siblings(hist, counted, frontier, parent, left, right, above)
        above = {node: hist[:, :, i] for i, node in enumerate(frontier)}
        if spec.per_node < features:
            subsets = [_reservoir(features, spec.per_node, rng.long()) for _ in frontier]
        else:
            subsets = [np.arange(features)] * len(frontier)
        known = np.array([stats[i] for i in frontier]), np.array([impurity[i] for i in frontier])
        following: list[int] = []
        for node, found in zip(frontier, _best(hist, *known, subsets, level == 0, spec), strict=True):
            f, c, g, l, r, own, imp = found
            stats[node], impurity[node] = own, float(imp)
            if f < 0:
                impurity[node] = -1.0
                continue
            gain[node] = g
            if g <= 0 or level == spec.depth:
                continue
            feature[node], cut[node] = f, c
            for side, sums in ((left, l), (right, r)):
                child = len(feature)
                side[node], parent[child] = child, node
                for column, value in ((feature, -1), (cut, 0), (left, child), (right, child), (gain, 0.0)):
                    column.append(value)
                stats.append(sums)
                impurity.append(float(_impurity(sums[1], sums[2], sums[3])))
                if level + 1 == spec.depth or abs(impurity[child]) < EPSILON:
                    continue
                following.insert(0, child)
        frontier = following
        ways = _ways(packing, feature, cut, left, right)
        for piece in pieces:
            _descend(piece, *ways)
    sums = np.array(stats)
    with np.errstate(divide="ignore", invalid="ignore"):
        prediction = np.where(sums[:, 1] == 0, 0.0, sums[:, 2] / sums[:, 1])
    return Tree(
        np.array(feature, np.int32), np.array(cut, np.int32), np.array(left, np.int32), np.array(right, np.int32),
        prediction, np.array(impurity), np.array(gain), sums[:, 1:], sums[:, 0].astype(np.int64),
    )


def _counted(frontier: list[int], parent: dict, left: list, right: list, stats: list) -> list[int]:
    """The nodes whose rows are read: of two siblings the one with fewer rows, the other is what is left of their parent."""
    at, out = set(frontier), []
    for node in frontier:
        if node in parent:
            l, r = left[parent[node]], right[parent[node]]
            if l in at and r in at and node != (l if stats[l][0] <= stats[r][0] else r):
                continue
        out.append(node)
    return out


def _with_siblings(hist: np.ndarray, counted: list, frontier: list, parent: dict, left: list, right: list, above: dict) -> np.ndarray:
    out = np.empty((*hist.shape[:2], len(frontier), hist.shape[3]))
    place = {node: i for i, node in enumerate(counted)}
    for i, node in enumerate(frontier):
        if node in place:
            out[:, :, i] = hist[:, :, place[node]]
        else:
            p = parent[node]
            rest = above[p] - hist[:, :, place[left[p] if right[p] == node else right[p]]]
            out[:, :, i] = rest * (rest[0] > 0)
    return out


def _ways(packing: _Packing, feature: list, cut: list, left: list, right: list) -> tuple[np.ndarray, np.ndarray]:
    """For each node the column that its split reads, and the node that each byte of it leads to."""
    split = np.maximum(feature, 0)
    code = np.arange(256)[None, :] // packing.radix[split][:, None] % packing.bins[split][:, None]
    lead = np.where(code <= np.array(cut)[:, None], np.array(left)[:, None], np.array(right)[:, None])
    return packing.column[split], lead.astype(np.int16).ravel()


def _descend(piece: Piece, column: np.ndarray, lead: np.ndarray) -> None:
    """Each row goes on to a child of its node; in a leaf it stays."""
    n = len(piece.node)
    byte = piece.columns.ravel()[(column * n)[piece.node] + np.arange(n)]
    piece.node = lead[piece.node.astype(np.int32) * 256 + byte]


def _pruned(tree: Tree) -> Tree:
    """Two leaves with the same prediction become one."""
    for node in range(len(tree.feature) - 1, -1, -1):
        if tree.feature[node] >= 0:
            l, r = tree.left[node], tree.right[node]
            if tree.feature[l] < 0 and tree.feature[r] < 0 and tree.prediction[l] == tree.prediction[r]:
                tree.feature[node], tree.left[node], tree.right[node] = -1, node, node
                tree.prediction[node] = tree.prediction[l]
    return tree


def grow(pieces: list[Piece], spec: Spec, total: Callable) -> list[Tree]:
    """All trees, one after the other, over the rows of this task and those that ``total`` adds."""
    packing, out = _Packing(spec.thresholds), []
    for m in range(spec.trees):
        seed = spec.seed + m
        kept = [p.kept(spec, seed) for p in pieces]
        with np.errstate(over="ignore"):
            target = [p.label if m == 0 else 4.0 * p.label / (1.0 + np.exp(2.0 * p.label * p.margin)) for p in pieces]
        tree = _tree(pieces, kept, target, spec, packing, seed, total)
        step = 1.0 if m == 0 else spec.rate
        for p in pieces:
            p.margin += tree.prediction[p.node] * step
            p.node[:] = 0
        out.append(_pruned(tree))
    return out


def margins(codes: np.ndarray, trees: list[Tree], rate: float) -> np.ndarray:
    """The ensemble's margin for each row."""
    n = codes.shape[1]
    out, flat, at = np.zeros(n), codes.ravel(), np.arange(n)
    for m, tree in enumerate(trees):
        node = np.zeros(n, dtype=np.int32)
        feature, last = np.maximum(tree.feature, 0) * n, None
        while last is None or (node != last).any():
            last = node
            node = np.where(flat[feature[node] + at] <= tree.cut[node], tree.left[node], tree.right[node])
        out += tree.prediction[node] * (1.0 if m == 0 else rate)
    return out


# ---------------------------------------------------------------------------- Spark's side
def _local(path: str) -> str | None:
    """A path that the machines have as a folder, without its scheme."""
    scheme, _, rest = path.rpartition(":")
    return f"/{rest.lstrip('/')}" if scheme in ("", "file") else None


def supported(estimator: GBTClassifier, df: DataFrame, tasks: int) -> bool:
    """Whether the fit can be grown here; anything else is left to the library.

    Tasks that exchange must all have started, and need a shared folder that is mounted, not only one that Spark reads.
    """
    spark = df.sparkSession
    alone = spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true" or not _local(shared_dir(spark))
    return (
        (tasks == 1 or not alone)
        and not estimator.isDefined("validationIndicatorCol")
        and estimator.getMaxDepth() <= MOST_DEPTH
        and estimator.getMaxBins() <= MOST_BINS
        and estimator.getMinWeightFractionPerNode() == 0
        and (estimator.getFeatureSubsetStrategy() in ("all", "auto") or "." in estimator.getFeatureSubsetStrategy())
    )


def thresholds(estimator: GBTClassifier, matrix: DataFrame) -> list[np.ndarray]:
    """The library's own candidate splits for these rows. Its check of labels, weights and features runs over all rows here."""
    jvm = matrix.sparkSession.sparkContext._jvm
    one = lambda name: getattr(getattr(jvm, f"{name}$"), "MODULE$")
    estimator._transfer_params_to_java()
    instances = one("org.apache.spark.ml.util.DatasetUtils").extractInstances(estimator._java_obj, matrix._jdf, jvm.scala.Option.apply(2))
    strategy = jvm.org.apache.spark.mllib.tree.configuration.Strategy.defaultStrategy("Regression")
    strategy.setMaxBins(estimator.getMaxBins())
    about = jvm.org.apache.spark.ml.tree.impl.DecisionTreeMetadata.buildMetadata(instances, strategy, 1, "all")
    splits = one("org.apache.spark.ml.tree.impl.RandomForest").findSplits(instances, about, estimator.getSeed())
    return [np.array([s.threshold() for s in feature], dtype=float) for feature in splits]


def specification(estimator: GBTClassifier, found: list[np.ndarray]) -> Spec:
    share = estimator.getFeatureSubsetStrategy()
    return Spec(
        found, math.ceil(float(share) * len(found)) if "." in share else len(found), estimator.getMinInstancesPerNode(),
        estimator.getMinInfoGain(), estimator.getMaxDepth(), estimator.getMaxIter(), estimator.getStepSize(),
        estimator.getSubsamplingRate(), estimator.getSeed(),
    )


def slots(df: DataFrame) -> int:
    """Tasks that can run at the same time."""
    context = df.sparkSession.sparkContext._jsc.sc()
    return max(1, context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile()))


def tasks_of_a_fit(matrix: DataFrame) -> int:
    """Tasks of one fit among many: as few as its rows allow, so that whole fits run side by side."""
    return max(1, min(slots(matrix), -(-matrix.count() // FIT_ROWS)))


BLOCK = "part int, start long, columns binary, label binary, weight binary"


def blocks(estimator: GBTClassifier, matrix: DataFrame, found: list[np.ndarray]) -> DataFrame:
    """The rows of ``matrix`` as blocks of bin numbers, which any task may take: a block knows its place in its partition."""
    label = estimator.getLabelCol()
    weight = estimator.getWeightCol() if estimator.isDefined("weightCol") else None
    packing = _Packing(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, held = TaskContext.get().partitionId(), 0, []

        def block() -> pa.RecordBatch:
            columns = np.concatenate([h[0] for h in held], axis=1).tobytes()
            y = np.concatenate([h[1] for h in held]).tobytes()
            w = np.concatenate([h[2] for h in held]).tobytes() if weight else None
            row = {"part": pa.array([part], pa.int32()), "start": pa.array([start], pa.int64())}
            row |= {k: pa.array([v], pa.binary()) for k, v in (("columns", columns), ("label", y), ("weight", w))}
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(n, len(found))
            y = (batch.column(label).to_numpy(zero_copy_only=False) * 2 - 1).astype(np.int8)
            w = batch.column(weight).to_numpy(zero_copy_only=False) if weight else None
            held.append((packing.packed(binned(x, found)), y, w))
            if sum(len(h[1]) for h in held) >= PIECE:
                yield block()
                start, held = start + sum(len(h[1]) for h in held), []
        if held:
            yield block()

    columns = [F.col(c).cast("double").alias(c) for c in (label, weight) if c]
    return matrix.select(vector_to_array(estimator.getFeaturesCol()).alias("features"), *columns).mapInArrow(run, BLOCK)


class _Exchange:
    """The sums of all tasks of a barrier stage, through files in the shared folder: ``allGather`` takes a second a turn."""

    WAIT = 600

    def __init__(self, folder: str, me: int, tasks: int, spec: Spec):
        self.folder, self.me, self.tasks, self.turn = folder, me, tasks, 0
        self.exists = np.arange(max(len(t) for t in spec.thresholds) + 1) <= np.array([[len(t)] for t in spec.thresholds])
        os.makedirs(folder, exist_ok=True)

    def _name(self, turn: int, task: int) -> str:
        return f"{self.folder}/{turn}-{task}"

    def _drop(self, turn: int) -> None:
        if turn >= 0:
            os.remove(self._name(turn, self.me))

    def total(self, hist: np.ndarray) -> np.ndarray:
        mask = np.broadcast_to(self.exists[:, None, :], hist.shape[1:])
        mine = self._name(self.turn, self.me)
        with open(f"{mine}.part", "wb") as f:
            f.write(hist[:, mask].tobytes())
        os.rename(f"{mine}.part", mine)
        out = np.zeros_like(hist)
        out[:, mask] = sum(self._read(task) for task in range(self.tasks)).reshape(len(hist), -1)
        self._drop(self.turn - 1)  # whoever has written this turn has read the last one
        self.turn += 1
        return out

    def _read(self, task: int) -> np.ndarray:
        until = time.monotonic() + self.WAIT
        while True:
            try:
                with open(self._name(self.turn, task), "rb") as f:
                    return np.frombuffer(f.read())
            except FileNotFoundError:
                if time.monotonic() > until:
                    raise TimeoutError(f"task {task} has not written turn {self.turn} to {self.folder}") from None
                time.sleep(0.001)

    def clear(self) -> None:
        self._drop(self.turn - 1)


def trees(rows: DataFrame, spec: Spec, tasks: int) -> list[Tree]:
    """The trees of a fit on ``blocks``, by so many tasks of one job. They exchange the sums of each level if there are several."""
    folder = _local(scratch_path(rows.sparkSession, "exchange")) if tasks > 1 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = [Piece(*row.values(), spec) for batch in batches for row in batch.to_pylist()]
        pieces.sort(key=lambda p: (p.part, p.start))
        me = TaskContext.get().partitionId()
        if tasks == 1:
            found = grow(pieces, spec, lambda hist: hist)
        else:
            context = BarrierTaskContext.get()
            attempt = context.allGather(uuid.uuid4().hex)[0]  # a stage that starts anew must not read what it wrote before
            exchange = _Exchange(f"{folder}/{attempt}", me, tasks, spec)
            found = grow(pieces, spec, exchange.total)
            context.barrier()
            exchange.clear()
        if me == 0:
            yield pa.RecordBatch.from_pydict({"trees": pa.array([pickle.dumps(found)], pa.binary())})

    if tasks == 1:
        out = rows.coalesce(1).mapInArrow(run, "trees binary").collect()
    else:
        place = F.pmod(F.col("part") + (F.col("start") / PIECE).cast("int"), F.lit(tasks))
        out = rows.repartitionById(tasks, place).mapInArrow(run, "trees binary", barrier=True).collect()
    return pickle.loads(out[0][0])


def scored(rows: DataFrame, estimator: GBTClassifier, found: list[np.ndarray], grown: list[Tree], p: str = "p") -> DataFrame:
    """Label and probability of each row under the trees, without the library's model: (label, p)."""
    label, rate = estimator.getLabelCol(), estimator.getStepSize()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(n, len(found))
            with np.errstate(over="ignore"):
                odds = np.exp(2.0 * margins(binned(x, found), grown, rate))
            yield pa.RecordBatch.from_arrays([batch.column(label), pa.array(1.0 - 1.0 / (1.0 + odds))], names=[label, p])

    read = rows.select(F.col(label).cast("int").alias(label), vector_to_array(estimator.getFeaturesCol()).alias("features"))
    return read.mapInArrow(run, f"{label} int, {p} double")


def fit(estimator: GBTClassifier, matrix: DataFrame) -> GBTClassificationModel:
    """The library's model of all trees; ``matrix`` has features, label and weight as stored rows.

    The library fits the first tree, so that it judges rows and parameters; all trees are then grown in one job. A small
    table is the library's: in nodes of a few rows the last bit of a sum decides between equal splits.
    """
    n = matrix.count()
    tasks = max(1, min(slots(matrix), -(-n // ROWS_PER_TASK)))
    if n < LIBRARY_ROWS or not supported(estimator, matrix, tasks):
        return estimator.fit(matrix)
    start = estimator.copy({estimator.maxIter: 1}).fit(matrix)
    found = thresholds(estimator, matrix)
    spec, rows = specification(estimator, found), stored(blocks(estimator, matrix, found), "blocks")
    return assembled(estimator, start, spec, trees(rows, spec, tasks))


def assembled(estimator: GBTClassifier, start: GBTClassificationModel, spec: Spec, grown: list[Tree]) -> GBTClassificationModel:
    """The library's own objects, so the model is saved, loaded, scored and explained as any other."""
    sc = SparkContext._active_spark_context
    jvm, gateway = sc._jvm, sc._gateway
    ml, features = jvm.org.apache.spark.ml, start.numFeatures
    # a name is looked up in the JVM part by part, so once
    calculator, copied = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator, jvm.java.util.Arrays.copyOfRange
    leaf, inner, split, model = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, ml.regression.DecisionTreeRegressionModel
    models = gateway.new_array(model, len(grown))
    weights = gateway.new_array(jvm.double, len(grown))

    def built(tree: Tree):
        size = len(tree.feature)
        flat = gateway.new_array(jvm.double, 3 * size)
        jvm.java.nio.ByteBuffer.wrap(bytearray(tree.stats.astype(">f8").tobytes())).asDoubleBuffer().get(flat)
        made: dict[int, object] = {}
        reached, todo = [], [0]
        while todo:
            node = todo.pop()
            reached.append(node)
            if tree.feature[node] >= 0:
                todo += [int(tree.left[node]), int(tree.right[node])]
        for node in sorted(reached, reverse=True):
            sums = calculator(copied(flat, 3 * node, 3 * node + 3), int(tree.count[node]))
            p, imp, f = float(tree.prediction[node]), float(tree.impurity[node]), int(tree.feature[node])
            if f < 0:
                made[node] = leaf(p, imp, sums)
            else:
                cut = split(f, float(spec.thresholds[f][tree.cut[node]]))
                children = made.pop(int(tree.left[node])), made.pop(int(tree.right[node]))
                made[node] = inner(p, imp, float(tree.gain[node]), *children, cut, sums)
        return model(made[0], features)

    with ThreadPoolExecutor(8) as pool:  # each object is a call to the JVM
        for m, tree in enumerate(pool.map(built, grown)):
            models[m], weights[m] = tree, 1.0 if m == 0 else spec.rate
    java = ml.classification.GBTClassificationModel(start.uid, models, weights, features, 2)
    estimator._java_obj.copyValues(java, ml.param.ParamMap())
    return estimator._copyValues(GBTClassificationModel(java))

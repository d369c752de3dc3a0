"""Trees for binary labels, grown on counts of binned features: the random forest and the boosted trees (K6, K7).

Spark ML's formulas (Gini or variance gain, Poisson bags, log loss with steps of 0.1), but all fits of a comparison
are trained together. Rows are held as blocks of one byte for each feature, each block of one fold, so that a fit
skips its held-out blocks. One job grows a level of all trees: tasks add up their blocks' counts tree by tree, a
shuffle brings the counts of a tree together, and only chosen splits reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

BINS = 32  # of a feature
POINTS = 4096  # of a feature's values that a task reports
CELLS = 1024  # of the features that are counted together
BLOCK_ROWS = 32_768
RUN_ROWS = 16_384  # that are counted at a time: of one block or several small ones
NEAR = 5  # levels of a tree
TREES_AT_ONCE = 25
ROUNDS_KEPT = 25  # of boosting that margins are carried on; then they are added up anew, which keeps their lineage short
LEAST_GAIN = 1e-12
# number of times a row is in a bag, by 16 random bits (Poisson of mean 1)
_BAG = np.searchsorted(np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)])), (np.arange(65_536) + 0.5) / 65_536).astype(np.uint8)


class Block(NamedTuple):
    """Rows of one fold: bins by feature, their packed groups, and the labels (0 or 1)."""

    key: tuple[int, int]
    fold: int
    bins: np.ndarray
    packed: np.ndarray
    label: np.ndarray


class Binned(NamedTuple):
    blocks: RDD
    cuts: list[np.ndarray]
    groups: list[list[int]]
    parts: int


class Trees(NamedTuple):
    """Trees as heaps of nodes. A leaf sends all rows to its left child, which repeats its value."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray  # times the rows, as importances need it

    @classmethod
    def empty(cls, n: int, depth: int) -> Trees:
        shape = (n, 2 ** (depth + 1) - 1)
        return cls(np.zeros(shape, np.intp), np.full(shape, 255, np.uint8), np.zeros(shape), np.zeros(shape))


# ---------------------------------------------------------------- bins and blocks
def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def choose_cuts(values: np.ndarray, weights: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Midpoints between neighbouring values: all if they are few, else those nearest to even shares of the weight."""
    values, at = np.unique(values, return_inverse=True)
    weights = np.bincount(at, weights)
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) < bins:
        return middle
    upto, stride = np.cumsum(weights), weights.sum() / bins
    found, target = [], stride
    for i in range(1, len(values)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            found.append(i - 1)
            target += stride
    return middle[found[:bins - 1]]


def cut_points(rows: DataFrame, bins: int = BINS) -> list[np.ndarray]:
    """Up to ``bins - 1`` thresholds of each feature of ``rows(x)``, from all rows: a task reports the values of a
    feature with their counts, or, if they are many, evenly spaced ones of its sorted values."""
    def reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [_matrix(b.column(0)) for b in batches if b.num_rows]
        x = np.concatenate(found) if found else np.zeros((0, 0))
        for k in range(x.shape[1]):
            values = np.sort(x[:, k][~np.isnan(x[:, k])])
            kinds, counts = np.unique(values, return_counts=True)
            if len(kinds) > POINTS:
                kinds, counts = values[((np.arange(POINTS) + 0.5) * len(values) / POINTS).astype(int)], np.full(POINTS, len(values) / POINTS)
            yield pa.RecordBatch.from_pydict({"k": pa.array([k], pa.int32()), "v": [kinds.tobytes()], "w": [counts.astype(float).tobytes()]})

    def chosen(of_feature):
        k, parts = of_feature
        return k, choose_cuts(np.concatenate([np.frombuffer(v) for v, _ in parts]), np.concatenate([np.frombuffer(w) for _, w in parts]), bins)

    reports = rows.select("x").mapInArrow(reported, "k int, v binary, w binary").rdd.map(lambda r: (r.k, (bytes(r.v), bytes(r.w))))
    cuts = reports.groupByKey(min(8, reports.getNumPartitions())).map(chosen).collectAsMap()
    return [cuts[k] for k in sorted(cuts)]


def binned(cuts: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """Bins by feature of rows of values; NaN goes to the last."""
    out = np.empty((len(cuts), len(x)), np.uint8)
    for k, c in enumerate(cuts):
        out[k] = np.searchsorted(c, x[:, k])
    return out


def feature_groups(cuts: list[np.ndarray]) -> list[list[int]]:
    """Features that are counted together, as their bins make up to ``CELLS`` combinations."""
    groups: list[list[int]] = []
    size: list[int] = []
    for k in sorted(range(len(cuts)), key=lambda k: -len(cuts[k])):
        n = len(cuts[k]) + 1
        at = next((i for i, s in enumerate(size) if s * n <= CELLS), None)
        if at is None:
            groups.append([k])
            size.append(n)
        else:
            groups[at].append(k)
            size[at] *= n
    return groups


def blocks(train: DataFrame, parts: int) -> Binned:
    """Blocks of ``train(label, features, fold)``, kept in at most ``parts`` partitions."""
    rows = train.select("label", F.coalesce("fold", F.lit(-1)).cast("int").alias("fold"), vector_to_array("features").alias("x")).coalesce(parts)
    cuts = cut_points(rows)
    groups = feature_groups(cuts)

    def packed(bins: np.ndarray) -> np.ndarray:
        out = np.zeros((len(groups), bins.shape[1]), np.uint16)
        for g, members in enumerate(groups):
            for k in members:
                out[g] = out[g] * (len(cuts[k]) + 1) + bins[k]
        return out

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, fold, bins = [], [], []
        for b in batches:
            if b.num_rows:
                label.append(b.column(0).to_numpy(zero_copy_only=False).astype(np.uint8))
                fold.append(b.column(1).to_numpy(zero_copy_only=False))
                bins.append(binned(cuts, _matrix(b.column(2))))
        if not label:
            return
        y, f, x = np.concatenate(label), np.concatenate(fold), np.concatenate(bins, axis=1)
        for one in np.unique(f):
            at = np.flatnonzero(f == one)
            for i in range(0, len(at), BLOCK_ROWS):
                own = at[i:i + BLOCK_ROWS]
                yield pa.RecordBatch.from_pydict({"fold": pa.array([one], pa.int32()), "y": [y[own].tobytes()], "x": [np.ascontiguousarray(x[:, own]).tobytes()]})

    def read(part: int, found) -> Iterator[Block]:
        for i, r in enumerate(found):
            bins = np.frombuffer(bytes(r.x), np.uint8).reshape(len(cuts), -1)
            yield Block((part, i), r.fold, bins, packed(bins), np.frombuffer(bytes(r.y), np.uint8))

    made = rows.mapInArrow(dealt, "fold int, y binary, x binary").rdd.mapPartitionsWithIndex(read)
    return Binned(made.persist(StorageLevel.MEMORY_AND_DISK), cuts, groups, parts)


# ---------------------------------------------------------------- levels
def places(feature: np.ndarray, cut: np.ndarray, bins: np.ndarray, depth: int) -> np.ndarray:
    """The node of a tree that each row reaches after ``depth`` steps."""
    n = bins.shape[1]
    near = np.zeros(n, np.uint8)  # on the first levels all rows are compared with each node's cut: no lookups
    for level in range(min(depth, NEAR)):
        go = np.zeros(n, bool)
        for j in range(2 ** level):
            node = 2 ** level - 1 + j
            if cut[node] < 255:
                go |= (near == j) & (bins[feature[node]] > cut[node])
        near *= 2
        near += go
    at = near.astype(np.intp)
    at += 2 ** min(depth, NEAR) - 1
    if depth > NEAR:
        rows, flat, start = np.arange(n), bins.reshape(-1), feature * n
        for _ in range(NEAR, depth):
            go = flat.take(start.take(at) + rows) > cut.take(at)
            at *= 2
            at += 1
            at += go
    return at


def best_splits(counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of ``(nodes, features, bins, 2)`` weights and sums of the target: each node's best feature, cut and gain, and the
    means of the target in the node and on both sides. No gain: no split. Gini's gain is in proportion to this one."""
    left = counts.cumsum(axis=2, dtype=float)
    whole = left[:, :1, -1:]
    left = left[:, :, :-1]
    right = whole - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[..., 1] ** 2 / left[..., 0] + right[..., 1] ** 2 / right[..., 0] - whole[..., 1] ** 2 / whole[..., 0]
        gain[~((left[..., 0] > 0) & (right[..., 0] > 0))] = -np.inf
        flat = gain.reshape(len(gain), -1)
        best = flat.argmax(axis=1)
        nodes = np.arange(len(gain))
        feature, cut = np.divmod(best, gain.shape[2])
        sides = [side[nodes, feature, cut] for side in (left, right)]
        means = [s[:, 1] / s[:, 0] for s in (whole[:, 0, 0], *sides)]
        top = flat[nodes, best]
        ok = top > LEAST_GAIN * whole[:, 0, 0, 0]
    return feature, cut, np.where(ok, top, 0.0), *means


def _split_level(found: Iterator) -> Iterator:
    """Adds up the counts of each tree, and its best splits."""
    sums: dict = {}
    for key, counts in found:
        if key in sums:
            sums[key] += counts
        else:
            sums[key] = counts.astype(float)
    for key, counts in sums.items():
        yield key, best_splits(counts)


def _chosen(counted: RDD, parts: int) -> dict:
    return counted.partitionBy(parts, int).mapPartitions(_split_level).collectAsMap()


def _grow(trees: Trees, t: int, nodes: np.ndarray, level: int, depth: int, found: tuple, subset: np.ndarray | None) -> np.ndarray:
    """Enters the splits of a tree's open nodes of a level; the nodes that are open on the next one."""
    feature, cut, gain, mean, left, right = found
    if level == 0:
        trees.value[t] = mean[0]
    split = gain > 0
    at, picked = nodes[split], feature[split]
    trees.feature[t, at] = picked if subset is None else subset[split, picked]
    trees.cut[t, at] = cut[split]
    trees.gain[t, at] = gain[split]
    for child, value in ((2 * at + 1, left[split]), (2 * at + 2, right[split])):
        for _ in range(level + 1, depth + 1):  # down to the last level, where rows are looked up
            trees.value[t, child] = value
            child = 2 * child + 1
    return np.sort(np.concatenate([2 * at + 1, 2 * at + 2])) if level + 1 < depth else at[:0]


def _slots(nodes: np.ndarray, depth: int) -> np.ndarray:
    out = np.full(2 ** (depth + 1) - 1, -1, np.intp)
    out[nodes] = np.arange(len(nodes))
    return out


def bag(seed: int, tree: int, key: tuple[int, int], n: int) -> np.ndarray:
    """How often each row of a block is in a tree's bag."""
    return _BAG[np.random.default_rng([seed, tree, *key]).integers(0, 65_536, n, dtype=np.uint16)]


def bagged(block: Block, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the rows in the bag twice the bins plus the label, and the weights."""
    rows = np.flatnonzero(weight)
    both = block.bins.take(rows, axis=1)
    both *= 2
    both += block.label.take(rows)
    return both, weight.take(rows).astype(float)


def bagged_counts(found: list[tuple[np.ndarray, np.ndarray]], tree: tuple[np.ndarray, np.ndarray], open_at: np.ndarray, subset: np.ndarray,
                  level: int) -> np.ndarray:
    """Weights and sums of the labels by open node, feature of its subset, and bin, of :func:`bagged` rows."""
    feature, cut = tree
    double = np.where(cut < 255, 2 * (cut % 128) + 1, 255).astype(np.uint8)
    kept = []
    for both, weight in found:
        slot, rows = open_at.take(places(feature, double, both, level)), np.arange(both.shape[1])
        if (slot < 0).any():
            rows = np.flatnonzero(slot >= 0)
            slot, weight = slot.take(rows), weight.take(rows)
        kept.append((both, slot, rows, weight))
    weights, size = np.concatenate([k[3] for k in kept]), 2 * BINS
    counts = np.empty((*subset.shape, BINS, 2))
    for j in range(subset.shape[1]):
        of = np.ascontiguousarray(subset[:, j])
        code = np.concatenate([both.reshape(-1).take((of * both.shape[1]).take(slot) + rows) + slot * size for both, slot, rows, _ in kept])
        counts[:, j] = np.bincount(code, weights, len(subset) * size).reshape(-1, BINS, 2)
    counts[..., 0] += counts[..., 1]
    return counts


def fit_forests(data: Binned, held_out: Sequence[int | None], trees: int = 100, depth: int = 10, seed: int = 42) -> list[Trees]:
    """A random forest for each held-out fold (None: all rows): Poisson bags, and at each node a random subset of
    features, as many as the root of their number. Leaves hold the share of label 1."""
    sc, n_features, fits = data.blocks.context, len(data.cuts), list(held_out)
    width = int(np.ceil(np.sqrt(n_features)))
    made = [Trees.empty(trees, depth) for _ in fits]
    for first in range(0, trees, TREES_AT_ONCE):
        chunk = range(first, min(trees, first + TREES_AT_ONCE))
        nodes = {(i, t): np.zeros(1, np.intp) for i in range(len(fits)) for t in chunk}
        for level in range(depth):
            subsets = {(i, t): np.sort(np.random.default_rng([seed, t, level]).random((len(v), n_features)).argsort(axis=1)[:, :width], axis=1)
                       for (i, t), v in nodes.items() if len(v)}
            if not subsets:
                break
            plan = sc.broadcast({(i, t): ((made[i].feature[t], made[i].cut[t]), _slots(nodes[i, t], depth), s) for (i, t), s in subsets.items()})

            def count(found, plan=plan, chunk=chunk, level=level):
                own = list(found)
                for t in chunk:
                    bags = [(b.fold, bagged(b, bag(seed, t, b.key, len(b.label)))) for b in own]
                    for i, fold in enumerate(fits):
                        part = [rows for of, rows in bags if fold is None or fold != of]
                        if part and (i, t) in plan.value:
                            yield t * len(fits) + i, bagged_counts(part, *plan.value[i, t], level).astype(np.int32)

            chosen = _chosen(data.blocks.mapPartitions(count), data.parts)
            plan.destroy()
            grown = {}
            for key, found in chosen.items():
                t, i = divmod(key, len(fits))
                grown[i, t] = _grow(made[i], t, nodes[i, t], level, depth, found, subsets[i, t])
            nodes = grown
    return made


def target_counts(found: Iterator[tuple[Block, np.ndarray, np.ndarray]], n_nodes: int, cuts: list[np.ndarray], groups: list[list[int]]) -> np.ndarray:
    """Rows and sums of the target by open node, feature and bin, of blocks with their rows' targets and open nodes (-1: none)."""
    sizes = [tuple(len(cuts[k]) + 1 for k in members) for members in groups]
    sums = [np.zeros((2, n_nodes * int(np.prod(s)))) for s in sizes]

    def add(run):
        targets = np.concatenate([r[1] for r in run])
        for g, size in enumerate(sizes):
            code = np.concatenate([slot * int(np.prod(size)) + b.packed[g][inside] for b, _, slot, inside in run])
            for c, weights in enumerate((None, targets)):
                sums[g][c] += np.bincount(code, weights, sums[g].shape[1])

    run, n = [], 0
    for b, target, slot in found:
        inside = slot >= 0
        run.append((b, target, slot, slice(None)) if inside.all() else (b, target[inside], slot[inside], inside))
        n += len(run[-1][1])
        if n > RUN_ROWS:
            add(run)
            run, n = [], 0
    if run:
        add(run)
    out = np.zeros((n_nodes, len(cuts), BINS, 2))
    for members, size, both in zip(groups, sizes, sums):
        for k, n in zip(members, size):  # the counts of its bins, then it is summed out
            both = both.reshape(2, n_nodes, n, -1)
            out[:, k, :n] = np.moveaxis(both.sum(axis=3), 0, -1)
            both = both.sum(axis=2)
    return out


def fit_boosted(data: Binned, held_out: Sequence[int | None], rounds: int = 100, depth: int = 5, step: float = 0.1) -> list[Trees]:
    """Boosted trees of log loss for each held-out fold (None: all rows): the first tree is of the labels (-1 and 1), the
    others of the gradient at the margins so far. Margins stay with the blocks; trees' values hold their steps."""
    fits, cuts, groups = list(held_out), data.cuts, data.groups
    made = [Trees.empty(rounds, depth) for _ in fits]
    used = lambda b: [i for i, fold in enumerate(fits) if fold is None or fold != b.fold]
    state = start = data.blocks.map(lambda b: (b, np.zeros((len(fits), len(b.label)))))
    before = None
    for m in range(rounds):
        nodes = {i: np.zeros(1, np.intp) for i in range(len(fits))}
        for level in range(depth):
            plan = {i: (made[i].feature[m].copy(), made[i].cut[m].copy(), _slots(v, depth), len(v)) for i, v in nodes.items() if len(v)}
            if not plan:
                break

            def count(found, plan=plan, level=level, first=m == 0):
                own = list(found)

                def rows(i, feature, cut, open_at):
                    for b, margins in own:
                        if i in used(b):
                            sign = 2.0 * b.label - 1.0
                            target = sign if first else 4.0 * sign / (1.0 + np.exp(2.0 * sign * margins[i]))
                            yield b, target, open_at.take(places(feature, cut, b.bins, level))

                for i, (*tree, n_nodes) in plan.items():
                    if any(i in used(b) for b, _ in own):
                        yield i, target_counts(rows(i, *tree), n_nodes, cuts, groups)

            chosen = _chosen(state.mapPartitions(count), min(len(fits), data.parts))
            if before is not None:  # this round's margins are kept now
                before.unpersist()
                before = None
            nodes = {i: _grow(made[i], m, nodes[i], level, depth, found, None) for i, found in chosen.items()}
        for trees in made:
            trees.value[m] *= 1.0 if m == 0 else step
        if m + 1 < rounds:
            anew = (m + 1) % ROUNDS_KEPT == 0
            since = [Trees(*[a[0 if anew else m:m + 1].copy() for a in t]) for t in made]

            def moved(item, since=since):
                b, margins = item
                margins = margins.copy()
                for i in used(b):
                    for feature, cut, value, _ in zip(*since[i]):
                        margins[i] += value.take(places(feature, cut, b.bins, depth))
                return b, margins

            before, state = state, (start if anew else state).map(moved).persist(StorageLevel.MEMORY_AND_DISK)
    state.unpersist()
    return made


# ---------------------------------------------------------------- models
class TreeModel(Model):
    """Fitted trees as a Spark ML model: adds ``probability`` and ``prediction`` to rows with ``features``."""

    def __init__(self, trees: Trees, cuts: list[np.ndarray], boosted: bool):
        super().__init__()
        self.trees, self.cuts, self.boosted = trees, cuts, boosted

    @property
    def featureImportances(self) -> DenseVector:
        """Gains by feature, of a forest each tree's in proportion to its sum; all add up to 1."""
        t, out = self.trees, np.zeros(len(self.cuts))
        for feature, gain in zip(t.feature, t.gain):
            own = np.bincount(feature, gain, len(self.cuts))
            out += own if self.boosted or not own.sum() else own / own.sum()
        return DenseVector(out / out.sum() if out.sum() else out)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 of rows of values."""
        t, bins, total = self.trees, binned(self.cuts, x), np.zeros(len(x))
        depth = int(np.log2(t.feature.shape[1] + 1)) - 1
        for feature, cut, value in zip(t.feature, t.cut, t.value):
            total += value.take(places(feature, cut, bins, depth))
        return 1.0 / (1.0 + np.exp(-2.0 * total)) if self.boosted else total / len(t.feature)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        plan = dataset.sparkSession.sparkContext.broadcast((self.trees, self.cuts, self.boosted))

        @arrow_udf("double")
        def score(x: pa.Array) -> pa.Array:
            return pa.array(TreeModel(*plan.value).scores(_matrix(x)))

        scored = dataset.withColumn("__score", score(vector_to_array("features")))
        return scored.withColumn("probability", array_to_vector(F.array(1 - F.col("__score"), "__score"))).withColumn(
            "prediction", (F.col("__score") > 0.5).cast("double")).drop("__score")


def models(found: list[Trees], cuts: list[np.ndarray], boosted: bool) -> list[PipelineModel]:
    return [PipelineModel(stages=[TreeModel(t, cuts, boosted)]) for t in found]

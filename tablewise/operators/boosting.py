"""Second-order gradient boosting of trees on binned rows (M1, M2; B17, B18 inside the trees).

Rows
    A numeric slot is cut at approximate quantiles of the training rows (at most ``MISSING``
    bins); a category slot's bin is its code; null, NaN and unseen categories have the bin
    ``MISSING``.  Spark bins the rows on the executors (``mapInArrow``) and keeps them there as
    blocks of bytes, training and test rows side by side.

A level
    One pass over the blocks gives the sums of gradient and hessian by (node, slot, bin); tasks
    send their sums, never rows.  Of two children only the one with the smaller hessian is
    summed, the other is the parent minus it.  The sums are small (nodes x slots x 256), and the
    driver finds the splits: the gain of the log-loss with an L2 term on the leaf values.

Splits
    numeric   every boundary between bins, missing rows tried on both sides
    category  values in the order of gradient / hessian; the best prefix of that order is the best
              of all subsets (the gain is convex in the two sums); kept as a 256-entry table,
              missing rows again tried on both sides

Rounds
    The pass for a new root also gives the test loss so far.  Boosting stops when the best round is
    ``patience`` rounds old; the ensemble is cut there, nothing is fitted twice.  Margins of
    earlier trees are a column of the blocks, renewed every ``REFRESH`` rounds from the
    first blocks and the trees, so the lineage never gets longer.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, DoubleType

from tablewise.operators.profile import qcol

MISSING = 255                # bin of missing values; the others are 0 to 254
WIDTH = 256
REFRESH = 8                  # rounds between renewals of the margins
CELLS_PER_TASK = 1 << 20     # rows x slots below which a further task costs more than it saves
DIRECT_BYTES = 64 << 20      # sums of all tasks that may reach the driver without a tree of sums
TINY = 1e-9                  # a hessian sum below it is an empty bin


@dataclass(frozen=True)
class BoostParams:
    rounds: int = 500
    patience: int = 20
    depth: int = 6
    step: float = 0.3
    l2: float = 1.0
    min_hessian: float = 1.0     # least hessian sum of a child
    min_gain: float = 1e-6


@dataclass
class Tree:
    """Nodes as arrays; node 0 is the root, ``slot`` -1 marks a leaf.  ``goes_left[node, bin]``
    holds for numbers, categories and missing rows alike."""
    slot: np.ndarray
    left: np.ndarray
    right: np.ndarray
    goes_left: np.ndarray
    value: np.ndarray
    cover: np.ndarray            # hessian sum
    depth: int

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """Node number of the leaf of every row; ``bins`` is slots x rows."""
        node = np.zeros(bins.shape[1], np.int32)
        rows = np.arange(bins.shape[1])
        for _ in range(self.depth):
            slot = self.slot[node]
            left = self.goes_left[node, bins[np.maximum(slot, 0), rows]]
            node = np.where(slot < 0, node, np.where(left, self.left[node], self.right[node]))
        return node

    def margin(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.leaf_of(bins)]


@dataclass
class Split:
    gain: float
    slot: int
    goes_left: np.ndarray        # 256 flags
    left: tuple                  # gradient and hessian sum
    right: tuple


def gain_of(g, h, l2: float):
    return g * g / (h + l2)


def best_split(G: np.ndarray, H: np.ndarray, category, p: BoostParams) -> Split | None:
    """Best split of one node from its sums ``G, H`` (slots x 256), None without a gain."""
    total_g, total_h = G[0].sum(), H[0].sum()
    parent = gain_of(total_g, total_h, p.l2)
    best = None
    order = np.tile(np.arange(MISSING), (len(G), 1))
    for j in np.flatnonzero(category):
        # by ratio; empty values last, where they are on the right of every prefix
        ratio = np.where(H[j, :MISSING] > TINY, G[j, :MISSING] / np.maximum(H[j, :MISSING], TINY), np.inf)
        order[j] = np.argsort(ratio, kind="stable")
    left_g = np.cumsum(np.take_along_axis(G[:, :MISSING], order, 1), axis=1)
    left_h = np.cumsum(np.take_along_axis(H[:, :MISSING], order, 1), axis=1)
    for missing_left in (False, True):
        lg = left_g + G[:, MISSING:] * missing_left
        lh = left_h + H[:, MISSING:] * missing_left
        rg, rh = total_g - lg, total_h - lh
        gain = 0.5 * (gain_of(lg, np.maximum(lh, 0.0), p.l2)
                      + gain_of(rg, np.maximum(rh, 0.0), p.l2) - parent)
        gain = np.where((lh >= p.min_hessian) & (rh >= p.min_hessian), gain, -np.inf)
        slot, at = np.unravel_index(np.argmax(gain), gain.shape)
        if gain[slot, at] > (best.gain if best else p.min_gain):
            goes_left = np.zeros(WIDTH, bool)
            goes_left[order[slot, :at + 1]] = True
            if category[slot]:
                goes_left[:MISSING] &= H[slot, :MISSING] > TINY
            goes_left[MISSING] = missing_left
            best = Split(float(gain[slot, at]), int(slot), goes_left,
                         (float(lg[slot, at]), float(lh[slot, at])),
                         (float(rg[slot, at]), float(rh[slot, at])))
    return best


class Growing:
    """A tree while it grows, level by level."""

    def __init__(self, p: BoostParams, g: float, h: float):
        self.p = p
        self.rows = [[-1, 0, 0, np.zeros(WIDTH, bool), g, h]]
        self.depth = 0

    def split(self, node: int, s: Split) -> tuple[int, int]:
        left = len(self.rows)
        self.rows[node][:4] = [s.slot, left, left + 1, s.goes_left]
        for g, h in (s.left, s.right):
            self.rows.append([-1, 0, 0, np.zeros(WIDTH, bool), g, h])
        return left, left + 1

    def tree(self) -> Tree:
        slot, left, right, goes, g, h = zip(*self.rows)
        g, h = np.array(g), np.array(h)
        return Tree(np.array(slot, np.int32), np.array(left, np.int32), np.array(right, np.int32),
                    np.stack(goes), -self.p.step * g / (np.maximum(h, 0.0) + self.p.l2), h, self.depth)


def grow(sums, category, p: BoostParams) -> Tree:
    """One tree.  ``sums(tree, nodes)`` gives ``G, H`` (nodes x slots x 256) of the rows in the
    given nodes of the tree so far."""
    G, H = sums(None, [0])
    growing = Growing(p, G[0, 0].sum(), H[0, 0].sum())
    level = {0: (G[0], H[0])}
    for d in range(p.depth):
        pairs = []
        for node, (g, h) in level.items():
            s = best_split(g, h, category, p)
            if s is not None:
                growing.depth = d + 1
                pairs.append((node, s, growing.split(node, s)))
        if not pairs or d + 1 == p.depth:
            break
        small = [kids[int(s.right[1] < s.left[1])] for _, s, kids in pairs]
        G, H = sums(growing.tree(), small)
        parents, level = level, {}
        for i, (node, _, kids) in enumerate(pairs):
            level[small[i]] = G[i], H[i]
            other = kids[0] + kids[1] - small[i]
            level[other] = parents[node][0] - G[i], parents[node][1] - H[i]
    return growing.tree()


@dataclass
class Block:
    """Rows on an executor: ``bins`` slots x rows, label, test flag, margin."""
    bins: np.ndarray
    y: np.ndarray
    test: np.ndarray
    margin: np.ndarray

    def later(self, trees) -> "Block":
        return Block(self.bins, self.y, self.test, self.margin + sum(t.margin(self.bins) for t in trees))


def log_loss(margin: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, margin) - y * margin


def block_sums(block: Block, trees, tree: Tree | None, nodes) -> tuple:
    """``G, H`` (nodes x slots x 256) of the training rows in ``nodes``, with the loss and the
    number of the test rows at the margin after ``trees``."""
    b = block.later(trees) if trees else block
    p = 1.0 / (1.0 + np.exp(-b.margin))
    place = np.zeros(len(b.y), np.int64)
    if tree is not None:
        number = np.full(len(tree.slot), -1, np.int64)
        number[list(nodes)] = np.arange(len(nodes))
        place = number[tree.leaf_of(b.bins)]
    at = np.flatnonzero((place >= 0) & ~b.test)
    g, h, place = (p - b.y)[at], (p * (1.0 - p))[at], place[at] * WIDTH
    shape = (len(nodes), len(b.bins), WIDTH)
    G, H = np.zeros(shape), np.zeros(shape)
    for j, column in enumerate(b.bins):
        key = place + column[at]
        G[:, j] = np.bincount(key, g, len(nodes) * WIDTH).reshape(-1, WIDTH)
        H[:, j] = np.bincount(key, h, len(nodes) * WIDTH).reshape(-1, WIDTH)
    loss = float(log_loss(b.margin[b.test], b.y[b.test]).sum()) if tree is None else 0.0
    return G, H, loss, int(b.test.sum())


def _add(a: tuple, b: tuple) -> tuple:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2], a[3] + b[3]


def gradient_sums(blocks: RDD, trees, tree: Tree | None, nodes, n_slots: int) -> tuple:
    """``block_sums`` of all blocks.  A task adds its blocks up; beyond ``DIRECT_BYTES`` the
    tasks' sums are added up by further tasks before they reach the driver."""
    def of_task(blocks):
        total = None
        for b in blocks:
            one = block_sums(b, trees, tree, nodes)
            total = one if total is None else _add(total, one)
        if total is not None:
            yield total

    sums = blocks.mapPartitions(of_task)
    size = 16 * WIDTH * n_slots * len(nodes) * blocks.getNumPartitions()
    empty = (np.zeros((len(nodes), n_slots, WIDTH)),) * 2 + (0.0, 0)
    if size <= DIRECT_BYTES:
        total = empty
        for one in sums.collect():
            total = _add(total, one)
        return total
    return sums.treeAggregate(empty, _add, _add, depth=3)


@dataclass
class BoostedTrees:
    """A fitted ensemble.  ``edges[slot]`` are the upper bounds of a numeric slot's bins (None
    for a category slot, whose values are bins already)."""
    slots: list
    edges: list
    base: float                  # log-odds of the training rows' label share
    trees: list
    losses: list = field(default_factory=list)   # mean test loss with 0, 1, ... trees
    fitted: int = 0              # trees grown; those after the best round are cut off

    @property
    def category(self) -> np.ndarray:
        return np.array([e is None for e in self.edges], bool)

    def bins_of(self, columns) -> np.ndarray:
        """Slots x rows of a batch's slot columns (doubles)."""
        return np.stack([bin_column(x, e) for x, e in zip(columns, self.edges)])

    def margin(self, bins: np.ndarray) -> np.ndarray:
        return self.base + sum((t.margin(bins) for t in self.trees), np.zeros(bins.shape[1]))


def bin_column(x: np.ndarray, edges) -> np.ndarray:
    missing = np.isnan(x)
    if edges is None:
        found = np.where(missing, MISSING, x)
    else:
        found = np.minimum(np.searchsorted(edges, x, "left"), MISSING - 1)
        found = np.where(missing, MISSING, found)
    return found.astype(np.uint8)


def slot_columns(batch, names) -> list:
    """Slot columns of an Arrow batch as doubles, null as NaN."""
    return [batch.column(n).cast("double").fill_null(np.nan).to_numpy(zero_copy_only=False)
            for n in names]


def quantile_edges(train: DataFrame, slots, category) -> list:
    """Per numeric slot the ascending upper bounds of its bins, from one aggregate over all of
    them; None per category slot."""
    numeric = [s for s, c in zip(slots, category) if not c]
    if not numeric:
        return [None] * len(slots)
    shares = [i / (MISSING - 1) for i in range(1, MISSING - 1)]
    row = {}
    for at in range(0, len(numeric), 64):        # bounded aggregates for wide tables
        part = numeric[at:at + 64]
        found = train.agg(*[F.percentile_approx(
            F.nanvl(qcol(s), F.lit(None).cast("double")), shares, 10_000) for s in part]).first()
        row.update(zip(part, found))
    return [None if c else np.array(sorted(set(row[s] or [])), float) for s, c in zip(slots, category)]


def make_blocks(data: DataFrame, model: BoostedTrees, label_col: str, test_col: str) -> RDD:
    """The rows of ``data`` as binned blocks at the model's base margin."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    slots, n_slots, base = list(model.slots), len(model.slots), model.base

    def pack(batches):
        for b in batches:
            if b.num_rows:
                cols = (model.bins_of(slot_columns(b, slots)),
                        b.column("__y").to_numpy(zero_copy_only=False),
                        b.column("__test").to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c.tobytes()], pa.binary()) for c in cols], ["bins", "y", "test"])

    def unpack(row) -> Block:
        y = np.frombuffer(row.y, np.float64)
        return Block(np.frombuffer(row.bins, np.uint8).reshape(n_slots, len(y)), y,
                     np.frombuffer(row.test, bool), np.full(len(y), base))

    rows = data.select(*[qcol(s) for s in slots], qcol(label_col).cast("double").alias("__y"),
                       qcol(test_col).alias("__test"))
    return rows.mapInArrow(pack, "bins binary, y binary, test binary").rdd.map(unpack)


def fit_boosted(data: DataFrame, slots, category, label_col: str, test_col: str,
                params: BoostParams = BoostParams()) -> BoostedTrees:
    """Trees up to the round with the smallest loss on the test rows (``test_col``), found with
    patience; best round + ``patience`` trees are fitted in all.  ``data`` is read twice and
    should be cached.  ``category``: per slot, whether its values are codes below ``MISSING``."""
    train = data.where(~qcol(test_col))
    n_rows, share = data.agg(F.count("*"), F.avg(F.when(
        ~qcol(test_col), qcol(label_col).cast("double")))).first()
    share = min(max(share if share is not None else 0.5, 1e-6), 1.0 - 1e-6)
    model = BoostedTrees(list(slots), quantile_edges(train, slots, category),
                         float(np.log(share / (1.0 - share))), [])
    first = make_blocks(data, model, label_col, test_col)
    tasks = max(1, -(-n_rows * len(model.slots) // CELLS_PER_TASK))
    if tasks < first.getNumPartitions():
        first = first.coalesce(tasks)
    first.persist(StorageLevel.MEMORY_AND_DISK)
    blocks, done, best = first, 0, 0
    trees: list[Tree] = []
    try:
        while True:
            recent = trees[done:]
            G, H, loss, n = gradient_sums(blocks, recent, None, [0], len(slots))
            model.losses.append(loss / max(n, 1))
            if trees:
                best = 1 + int(np.argmin(model.losses[1:]))
            if trees and (len(trees) >= params.rounds or len(trees) - best >= params.patience):
                break

            def sums(tree, nodes):
                if tree is None:
                    return G, H
                return gradient_sums(blocks, recent, tree, nodes, len(slots))[:2]

            trees.append(grow(sums, model.category, params))
            if len(trees) - done >= REFRESH:
                renewed = first.map(lambda b, t=tuple(trees): b.later(t)).persist(
                    StorageLevel.MEMORY_AND_DISK)
                if blocks is not first:
                    blocks.unpersist()
                blocks, done = renewed, len(trees)
    finally:
        first.unpersist()
        if blocks is not first:
            blocks.unpersist()
    model.trees, model.fitted = trees[:best], len(trees)
    return model


def with_margin(df: DataFrame, model: BoostedTrees, keep=()) -> DataFrame:
    """M3: ``keep`` columns, ``margin`` (log-odds), ``score`` (probability of label 1) and
    ``prediction`` (1.0 above one half) of every row that has the model's slot columns."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    slots, keep = list(model.slots), list(keep)

    def run(batches):
        for b in batches:
            margin = (model.margin(model.bins_of(slot_columns(b, slots))) if b.num_rows
                      else np.empty(0))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k) for k in keep), pa.array(margin, pa.float64())], [*keep, "margin"])

    schema = StructType([df.schema[k] for k in keep] + [StructField("margin", DoubleType())])
    rows = df.select(*[qcol(c) for c in dict.fromkeys([*keep, *slots])])
    return (rows.mapInArrow(run, schema)
            .withColumn("score", 1.0 / (1.0 + F.exp(-F.col("margin"))))
            .withColumn("prediction", (F.col("margin") > 0).cast("double")))


def gradient_table(data: DataFrame, model: BoostedTrees, label_col: str, test_col: str) -> DataFrame:
    """``slot, bin, gradient, hessian`` of the training rows at the model's margins: the sums from
    which the root of its next tree is split (non-empty bins; bin ``MISSING`` holds missing
    rows)."""
    blocks = make_blocks(data, model, label_col, test_col)
    G, H, _, _ = gradient_sums(blocks, model.trees, None, [0], len(model.slots))
    rows = [(s, b, float(G[0, j, b]), float(H[0, j, b])) for j, s in enumerate(model.slots)
            for b in np.flatnonzero(H[0, j] > 0.0).tolist()]
    return data.sparkSession.createDataFrame(rows, "slot string, bin int, gradient double, hessian double")


def root_split(data: DataFrame, model: BoostedTrees, label_col: str, test_col: str,
               params: BoostParams = BoostParams()) -> Split | None:
    """The split of the root of the model's next tree."""
    blocks = make_blocks(data, model, label_col, test_col)
    G, H, _, _ = gradient_sums(blocks, model.trees, None, [0], len(model.slots))
    return best_split(G[0], H[0], model.category, params)


__all__ = ["BoostParams", "BoostedTrees", "Tree", "Split", "MISSING", "best_split", "grow",
           "block_sums", "gradient_sums", "fit_boosted", "make_blocks", "with_margin",
           "quantile_edges", "gradient_table", "root_split"]

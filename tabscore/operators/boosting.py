"""Histogram gradient boosting of many fits in shared passes.

Features are cut into bins once.  All fits (every fold of every trial, and each trial on all rows) grow their trees side
by side: one pass over the training rows gives the gradient histograms of every leaf that any fit asks for, so 100
rounds of twelve fits cost as many passes as 100 rounds of one.  Per pass a task returns one array of bounded size
(leaves asked for x features x bins), and these are added up as a tree.

Trees grow by largest gain.  A leaf that would be split is split before its rivals' children are known, and
what turns out to lie beyond the leaf budget is given up again, so a tree needs a pass per level instead of a pass
per split and is still the tree that splitting one leaf at a time gives.  Rows with a missing value have a bin of their own and
go to the side that gains more, so nothing is imputed.

The rows' bins, and every fit's score of every row, are blocks of a persisted RDD: each task keeps numeric
arrays from pass to pass, which DataFrame operators can't.  Every ``CHECKPOINT_ROUNDS`` rounds the blocks are written to the
shared checkpoint folder, so a lost executor costs these rounds at most and the lineage stays short.

A frame that a task holds (the bounded training sample) needs no pass per level: ``fit_each`` sends its rows to a group per fit,
and the same growth runs in the groups.

Scoring is a Catalyst expression (``score_column``): the stored node table becomes nested conditions, one per tree.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCols, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscore.functions.text import col
from tabscore.operators import features as feat
from tabscore.session import ensure_checkpoint_dir

#: Bins of a feature, besides the one of missing values.
BINS = 63
#: Rows of a block at most; a task holds one block at a time.
BLOCK_ROWS = 200_000
CHECKPOINT_ROUNDS = 20
#: Parts whose histograms the driver adds up itself; beyond them they are added up as a tree.
DRIVER_PARTS = 16

NODES = "tree int, node int, feature int, threshold double, missing_left boolean, left int, right int, value double, gain double, n long"


@dataclass(frozen=True)
class Fit:
    """One fit: its parameters and the fold that is held out (-1: none)."""

    held_out: int = -1
    num_leaves: int = 31
    max_depth: int = 6
    learning_rate: float = 0.1
    min_data_in_leaf: int = 20
    l2: float = 1.0
    min_hessian: float = 1e-3


# ---- bins and blocks -----------------------------------------------------------------------------------------------

def bin_edges(df: DataFrame, cols: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Upper bin edges of each column: distinct quantiles of its values, from one aggregate."""
    cuts = [i / bins for i in range(1, bins)]
    aggs = []
    for i, c in enumerate(cols):
        x = col(c).cast("double")
        aggs.append(F.percentile_approx(F.when(~F.isnan(x), x), cuts, 10_000).alias(f"q{i}"))
    r = df.agg(*aggs).first()
    return [sorted(set(r[f"q{i}"] or [])) for i in range(len(cols))]


@dataclass
class Block:
    """Rows of a task: bins (0: missing), label, weight, fold, and a score per fit."""

    codes: np.ndarray
    y: np.ndarray
    w: np.ndarray
    fold: np.ndarray
    scores: np.ndarray


def coded_rows(columns: list, edges: list[list[float]]) -> np.ndarray:
    """Bins of rows (0: missing), a column per feature."""
    codes = np.zeros((len(columns[0]) if columns else 0, len(edges)), np.uint8)
    for i, (x, e) in enumerate(zip(columns, edges)):
        x = np.asarray(x, float)
        codes[:, i] = np.where(np.isnan(x), 0, 1 + np.searchsorted(np.array(e), x, "left"))
    return codes


def blocks(df: DataFrame, cols: Sequence[str], edges: list[list[float]], fits: int, parts: int | None):
    """RDD of ``Block`` over ``df`` (the columns and label, weight, fold)."""
    data = df.select(*[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)], F.col("label").cast("double").alias("label"),
                     F.col("weight").cast("double").alias("weight"), F.col("fold").cast("int").alias("fold"))

    def make(batches):
        import pyarrow as pa
        for batch in batches:
            codes = coded_rows([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(edges))], edges)
            rest = [batch.column(len(edges) + k).to_numpy(zero_copy_only=False) for k in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (codes, rest[0].astype("<f8"), rest[1].astype("<f8"), rest[2].astype("<i4"))],
                                             names=["codes", "y", "w", "fold"])

    def collected(rows):
        held, n = [], 0

        def block():
            y, w = (np.concatenate([np.frombuffer(r[k], "<f8") for r in held]) for k in ("y", "w"))
            codes = np.concatenate([np.frombuffer(r["codes"], np.uint8).reshape(-1, len(edges)) for r in held])
            return Block(codes, y, w, np.concatenate([np.frombuffer(r["fold"], "<i4") for r in held]), np.zeros((len(y), fits)))
        for r in rows:
            held.append(r)
            n += len(r["fold"]) // 4
            if n >= BLOCK_ROWS:
                yield block()
                held, n = [], 0
        if held:
            yield block()

    data = data.repartition(parts) if parts else data
    return data.mapInArrow(make, "codes binary, y binary, w binary, fold binary").rdd.mapPartitions(collected)


# ---- trees ---------------------------------------------------------------------------------------------------------

@dataclass
class Node:
    depth: int
    g: float
    h: float
    n: float
    split: tuple | None = None  # gain, feature, bin, missing goes left; None: unknown, (): there is none
    kids: tuple[int, int] | None = None
    stats: tuple | None = None  # of the kids


def walk(codes: np.ndarray, splits: tuple, at: np.ndarray) -> np.ndarray:
    """Nodes ``at`` of all rows, led on (in place) to their leaves."""
    feature, cut, missing_left, left, right = splits
    rows = np.flatnonzero(left[at] >= 0)
    while len(rows):
        node = at[rows]
        c = codes[rows, feature[node]]
        at[rows] = node = np.where(np.where(c == 0, missing_left[node], c <= cut[node]), left[node], right[node])
        rows = rows[left[node] >= 0]
    return at


@dataclass
class Tree:
    """A tree as arrays over its nodes; a leaf has ``left`` -1."""

    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    n: np.ndarray

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        """Leaf of every row."""
        return walk(codes, (self.feature, self.bin, self.missing_left, self.left, self.right), np.zeros(len(codes), np.int64))


def best_splits(hist: np.ndarray, fit: Fit) -> list[tuple]:
    """Per leaf of ``hist`` (leaves x features x bins x (gradient, hessian, rows)): its best split and the sums of both sides.
    Ties: the first feature, then the lowest bin, then missing values to the right."""
    total = hist[:, 0].sum(1)  # leaves x 3
    below = np.cumsum(hist[:, :, 1:], axis=2)
    sides = np.stack([below, below + hist[:, :, :1]], axis=3)  # leaves x features x bins x direction x 3
    rest = total[:, None, None, None] - sides

    def quality(s):
        return s[..., 0] ** 2 / (s[..., 1] + fit.l2)
    ok = ((sides[..., 2] >= fit.min_data_in_leaf) & (rest[..., 2] >= fit.min_data_in_leaf)
          & (sides[..., 1] >= fit.min_hessian) & (rest[..., 1] >= fit.min_hessian))
    with np.errstate(all="ignore"):
        gain = np.where(ok, quality(sides) + quality(rest) - quality(total)[:, None, None, None], -np.inf)
    flat = gain.reshape(len(hist), -1)
    out = []
    for leaf, at in enumerate(flat.argmax(1)):
        if not flat[leaf, at] > 1e-12:
            out.append(((), None))
            continue
        f, b, d = np.unravel_index(at, gain.shape[1:])
        out.append(((float(flat[leaf, at]), int(f), int(b) + 1, bool(d)), (tuple(sides[leaf, f, b, d]), tuple(rest[leaf, f, b, d]))))
    return out


@dataclass
class Growing:
    """A tree that grows by largest gain, a level of unknown leaves at a time."""

    fit: Fit
    nodes: list[Node] = field(default_factory=lambda: [Node(0, 0.0, 0.0, -1.0)])
    used: list[int] = field(default_factory=list)
    #: Per node: feature, bin, side of missing values, and both kids (-1: a leaf so far).
    splits: list[list] = field(default_factory=lambda: [[0, 0, False, -1, -1]])

    def wanted(self) -> list[int]:
        """Leaves whose histograms are needed to go on; none when the tree is done (then ``used`` are its splits)."""
        if self.nodes[0].split is None:
            return [0]
        heap, asked, self.used = [], [], []

        def offer(i):
            if self.nodes[i].split:
                heapq.heappush(heap, (-self.nodes[i].split[0], i))
        offer(0)
        while heap and len(self.used) < self.fit.num_leaves - 1:
            i = heapq.heappop(heap)[1]
            self.used.append(i)
            node = self.nodes[i]
            if node.kids is None:
                node.kids = (len(self.nodes), len(self.nodes) + 1)
                self.splits[i] = [*node.split[1:], *node.kids]
                self.splits += [[0, 0, False, -1, -1], [0, 0, False, -1, -1]]
                for g, h, n in node.stats:
                    done = node.depth + 1 >= self.fit.max_depth or n < 2 * self.fit.min_data_in_leaf
                    self.nodes.append(Node(node.depth + 1, g, h, n, () if done else None))
            for k in node.kids:
                if self.nodes[k].split is None:
                    asked.append(k)
                else:
                    offer(k)
        return asked

    def learn(self, leaves: list[int], hist: np.ndarray) -> None:
        if leaves == [0]:
            self.nodes[0].g, self.nodes[0].h, self.nodes[0].n = hist[0, 0].sum(0)
        for i, (split, stats) in zip(leaves, best_splits(hist, self.fit)):
            self.nodes[i].split, self.nodes[i].stats = split, stats

    def so_far(self) -> tuple:
        """The splits that were tried, as arrays over ``nodes``."""
        return tuple(np.array(x, k) for x, k in zip(zip(*self.splits), (np.int32, np.uint8, bool, np.int32, np.int32)))

    def tree(self) -> Tree:
        """The tree of the used splits."""
        order, at, split = [0], 0, set(self.used)
        while at < len(order):
            if order[at] in split:
                order += self.nodes[order[at]].kids
            at += 1
        number, rows = {i: k for k, i in enumerate(order)}, []
        for i in order:
            n = self.nodes[i]
            value = -n.g / (n.h + self.fit.l2) * self.fit.learning_rate if n.n > 0 else 0.0
            if i in split:
                gain, f, b, left = n.split
                rows.append((f, b, left, number[n.kids[0]], number[n.kids[1]], value, gain, n.n))
            else:
                rows.append((0, 0, False, -1, -1, value, 0.0, n.n))
        kinds = (np.int64, np.int64, bool, np.int64, np.int64, float, float, np.int64)
        return Tree(*[np.array(x, k) for x, k in zip(zip(*rows), kinds)])


def grow(fits: list[Fit], sums) -> list[Tree]:
    """A tree of every fit, side by side; ``sums(asked)`` gives the histograms of all asked leaves."""
    growing = [Growing(f) for f in fits]
    while True:
        wanted = [g.wanted() for g in growing]
        asked = [(i, f.held_out, growing[i].so_far(), leaves) for i, (f, leaves) in enumerate(zip(fits, wanted)) if leaves]
        if not asked:
            return [g.tree() for g in growing]
        total, at = sums(asked), 0
        for i, _, _, leaves in asked:
            growing[i].learn(leaves, total[at:at + len(leaves)])
            at += len(leaves)


#: What a worker remembers of the blocks it last saw: nodes, gradients and hessians per fit within a round.  Whatever is not there is made
#: again, so results never depend on it.
_SEEN: dict = {}
REMEMBERED_BLOCKS = 8


def seen(block: Block, place: tuple, run: tuple) -> dict:
    """The worker's memory of a block within a round (``run``)."""
    held = _SEEN.pop(place, None)
    if held is None or held[0] != run or held[2] != len(block.y):
        held = (run, {}, len(block.y))
    _SEEN[place] = held
    while len(_SEEN) > REMEMBERED_BLOCKS:
        _SEEN.pop(next(iter(_SEEN)))
    return held[1]


def histograms(block: Block, asked: list[tuple[int, int, tuple, list[int]]], known: dict) -> np.ndarray:
    """Gradient, hessian and row sums of a block for each asked leaf: ``asked`` holds (fit, held-out fold, splits so far, leaves);
    ``known`` is what the round's earlier passes left."""
    width, bins = block.codes.shape[1], BINS + 1
    out = []
    for fit, held_out, splits, leaves in asked:
        if fit not in known:
            p = 1.0 / (1.0 + np.exp(-block.scores[:, fit]))
            known[fit] = (np.zeros(len(p), np.int64), (p - block.y) * block.w, p * (1.0 - p) * block.w)
        at, g, h = known[fit]
        walk(block.codes, splits, at)
        slot = np.full(len(splits[0]), -1)
        slot[leaves] = np.arange(len(leaves))
        rows = np.flatnonzero((slot[at] >= 0) & (block.fold != held_out))
        cell = ((slot[at[rows], None] * width + np.arange(width)) * bins + block.codes[rows]).ravel()
        size = len(leaves) * width * bins
        sums = [np.bincount(cell, None if x is None else np.repeat(x[rows], width), size) for x in (g, h, None)]
        out.append(np.stack(sums, 1).reshape(len(leaves), width, bins, 3))
    return np.concatenate(out)


def fit_many(df: DataFrame, cols: Sequence[str], fits: list[Fit], rounds: int = 100, parts: int | None = None):
    """Grow ``rounds`` trees of every fit; ``df``: the columns, label (0/1), weight and fold; ``parts``: tasks of a pass (those
    of ``df`` if not given; a small frame is best in few).

    Returns ``(ensembles, edges, scored)``: the trees of each fit, the bin edges, and the RDD of blocks with each fit's raw
    scores of all rows (persisted: the caller releases it).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    edges = bin_edges(df, cols)
    state = blocks(df, cols, edges, len(fits), parts).persist(StorageLevel.MEMORY_AND_DISK)
    ensembles: list[list[Tree]] = [[] for _ in fits]
    before, width, name = None, state.getNumPartitions(), uuid.uuid4().hex
    for r in range(rounds):
        def sums(asked, state=state, run=(name, r)):
            shape = (sum(len(x[3]) for x in asked), len(cols), BINS + 1, 3)

            def add_up(part, bs):
                total = np.zeros(shape)
                for k, b in enumerate(bs):
                    total += histograms(b, asked, seen(b, (part, k), run))
                return [total]
            made = state.mapPartitionsWithIndex(add_up)
            return sum(made.collect(), np.zeros(shape)) if width <= DRIVER_PARTS else made.treeReduce(np.add)
        trees = grow(fits, sums)
        for e, t in zip(ensembles, trees):
            e.append(t)

        def add(b: Block, trees=trees):
            return Block(b.codes, b.y, b.w, b.fold, b.scores + np.stack([t.value[t.leaves(b.codes)] for t in trees], 1))
        if before is not None:
            before.unpersist()  # the blocks made from it are there since this round's first pass
        before, state = state, state.map(add).persist(StorageLevel.MEMORY_AND_DISK)
        if (r + 1) % CHECKPOINT_ROUNDS == 0 or r + 1 == rounds:
            state.checkpoint()
            state.count()
    if before is not None:
        before.unpersist()
    return ensembles, edges, state


def fit_each(df: DataFrame, cols: Sequence[str], fits: list[Fit], rounds: int = 100):
    """The same trees for a frame that a task holds (a bounded sample): rows go to each fit's group, and a group's passes stay in its task,
    so the fits run beside each other without a job per pass.

    Returns ``(ensembles, edges, scored)``, ``scored``: (fit, label, raw) of every fit's held-out rows, kept in the checkpoint folder.
    """
    import pickle

    import pyarrow as pa
    ensure_checkpoint_dir(df.sparkSession)
    edges = bin_edges(df, cols)
    rows = df.select(*[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)], F.col("label").cast("double").alias("label"),
                     F.col("weight").cast("double").alias("weight"), F.col("fold").cast("int").alias("fold"))
    shape = pa.schema([("fit", pa.int32()), ("trees", pa.binary()), ("label", pa.list_(pa.float64())), ("raw", pa.list_(pa.float64()))])

    def one(key, table):
        fit = fits[key[0].as_py()]
        y, w, fold = (table.column(c).to_numpy() for c in ("label", "weight", "fold"))
        block = Block(coded_rows([table.column(f"x{i}").to_numpy() for i in range(len(edges))], edges), y, w, fold, np.zeros((len(y), 1)))
        trees = []
        for _ in range(rounds):
            known: dict = {}
            trees += grow([fit], lambda asked, known=known: histograms(block, asked, known))
            block.scores[:, 0] += trees[-1].value[trees[-1].leaves(block.codes)]
        out = (fold == fit.held_out) & (fit.held_out >= 0)
        return pa.Table.from_pylist([{"fit": key[0].as_py(), "trees": pickle.dumps(trees), "label": y[out].tolist(), "raw": block.scores[out, 0].tolist()}], schema=shape)

    every = F.explode(F.sequence(F.lit(0), F.lit(len(fits) - 1))).alias("fit")
    # a range of one fit for each task; a group's rows are no more than the frame's
    dealt = rows.select("*", every).repartitionByRange(len(fits), "fit")
    made = dealt.groupBy("fit").applyInArrow(one, "fit int, trees binary, label array<double>, raw array<double>").checkpoint(eager=True)
    found = {r["fit"]: pickle.loads(r["trees"]) for r in made.select("fit", "trees").collect()}  # rounds x leaves nodes a fit
    scored = made.select("fit", F.inline(F.arrays_zip("label", "raw")))
    return [found.get(i, []) for i in range(len(fits))], edges, scored


# ---- node tables and scores ----------------------------------------------------------------------------------------

def node_rows(trees: list[Tree], edges: list[list[float]]) -> list[tuple]:
    """Rows of ``NODES``: a split's threshold is its bin's upper edge (all values: infinity)."""
    rows = []
    for k, t in enumerate(trees):
        for i in range(len(t.left)):
            f, b = int(t.feature[i]), int(t.bin[i])
            inner = t.left[i] >= 0
            high = (edges[f][b - 1] if b <= len(edges[f]) else math.inf) if inner else None
            rows.append((k, i, f if inner else None, high, bool(t.missing_left[i]) if inner else None, int(t.left[i]) if inner else None,
                         int(t.right[i]) if inner else None, None if inner else float(t.value[i]), float(t.gain[i]) if inner else None, int(t.n[i])))
    return rows


def by_tree(nodes: Sequence[tuple]) -> list[dict[int, tuple]]:
    trees: dict[int, dict[int, tuple]] = {}
    for r in nodes:
        trees.setdefault(r[0], {})[r[1]] = tuple(r)
    return [trees[k] for k in sorted(trees)]


def tree_sql(tree: dict[int, tuple], cols: Sequence[str], leaf=lambda r: repr(float(r[7])) + "D", node: int = 0) -> str:
    """A tree as nested conditions: ``x <= threshold`` goes left; missing values (NULL and NaN) go where the node says."""
    _, _, f, threshold, missing_left, left, right, *_ = tree[node]
    if left is None:
        return leaf(tree[node])
    x = cols[f]
    if threshold == math.inf:
        here = "TRUE" if missing_left else f"({x} IS NOT NULL AND NOT isnan({x}))"
    else:  # a comparison with NULL or NaN is not true, so missing values go right unless they are asked for
        here = f"{x} <= {float(threshold)!r}D"
        here = f"({x} IS NULL OR isnan({x}) OR {here})" if missing_left else here
    return f"CASE WHEN {here} THEN {tree_sql(tree, cols, leaf, left)} ELSE {tree_sql(tree, cols, leaf, right)} END"


def _quoted(cols: Sequence[str]) -> list[str]:
    return [f"CAST(`{c.replace('`', '``')}` AS DOUBLE)" for c in cols]


def raw_column(nodes: Sequence[tuple], cols: Sequence[str]) -> Column:
    """Sum of the trees' values as a Catalyst expression, added up in the trees' order.  The expression is handed over as SQL text:
    one call, however many nodes."""
    trees = [tree_sql(t, _quoted(cols)) for t in by_tree(nodes)]
    if not trees:
        return F.lit(0.0)
    # Only the first summand (0) is a lambda, which keeps the projection out of whole-stage code: there all trees would be one method, too
    # long for the JVM to compile.  As a plain projection the sum is generated code, split into short methods.
    return F.expr(f"aggregate(array({_quoted(cols)[0]}), 0D, (a, x) -> a) + {' + '.join(trees)}")


def leaf_columns(nodes: Sequence[tuple], cols: Sequence[str]) -> list[Column]:
    """Node number of the leaf that a row reaches, per tree, as Catalyst expressions."""
    return [F.expr(tree_sql(t, _quoted(cols), lambda r: str(r[1]))) for t in by_tree(nodes)]


def split_visits(df: DataFrame, nodes: Sequence[tuple], cols: Sequence[str]) -> DataFrame:
    """K15 by use: per feature its splits and the rows of ``df`` that pass them, added up: rows are counted per leaf in one pass, and the
    counts go up the (model-sized) node table."""
    leaves = F.array(*[F.struct(F.lit(k).alias("tree"), leaf.alias("leaf")) for k, leaf in enumerate(leaf_columns(nodes, cols))])
    counts = df.select(F.inline(leaves)).groupBy("tree", "leaf").agg(F.count("*").alias("rows"))
    passed = []  # (tree, leaf, feature) of every split above a leaf
    for t in by_tree(nodes):
        def below(i, above, t=t):
            if t[i][5] is None:
                passed.extend((t[i][0], i, cols[f]) for f in above)
            else:
                below(t[i][5], [*above, t[i][2]])
                below(t[i][6], [*above, t[i][2]])
        below(0, [])
    spark = df.sparkSession
    ways = spark.createDataFrame(passed, "tree int, leaf int, feature_name string")
    visits = counts.join(F.broadcast(ways), ["tree", "leaf"]).groupBy("feature_name").agg(F.sum("rows").alias("visits"))
    named = spark.createDataFrame([(cols[r[2]] if r[2] is not None else None, r[5], r[8]) for r in nodes], "feature_name string, left int, gain double")
    return split_importances(named, cols).join(visits, "feature_name", "left").na.fill(0, ["visits"])


def score_column(nodes: Sequence[tuple], cols: Sequence[str]) -> Column:
    """P(class 1) of a stored ensemble as a Catalyst expression."""
    return 1.0 / (1.0 + F.exp(-raw_column(nodes, cols)))


class Walk:
    """A node table as arrays over the values' places among the thresholds, made once for many batches.

    Per tree, feature and place of a value, a row of bits tells which leaves (from the left) the tree's splits on this feature leave
    open: a split that is not met closes the leaves of its left side.  The leaf that a row reaches is the first one
    that is open under all features, so a tree costs a look-up per feature, however deep it is."""

    def __init__(self, nodes: Sequence[tuple]):
        trees = by_tree(nodes)
        used = sorted({r[2] for t in trees for r in t.values() if r[5] is not None})
        #: Finite thresholds of each feature; a value's place is how many of them lie below it, a missing one's is the last.
        self.edges = {f: np.array(sorted({r[3] for t in trees for r in t.values() if r[5] is not None and r[2] == f and r[3] != math.inf}), float) for f in used}
        self.trees = [self._tables(t) for t in trees]

    def _tables(self, tree: dict[int, tuple]) -> tuple[list, np.ndarray]:
        values, splits = [], []

        def below(i: int) -> None:
            _, _, f, threshold, missing_left, left, right, value, *_ = tree[i]
            if left is None:
                values.append(value)
                return
            first = len(values)
            below(left)
            splits.append((f, threshold, missing_left, first, len(values)))
            below(right)
        below(0)
        masks = {f: np.full((-(-len(values) // 64), len(self.edges[f]) + 2), ~np.uint64(0)) for f in {x[0] for x in splits}}
        for f, threshold, missing_left, first, end in splits:
            edges, closed = self.edges[f], sum(1 << i for i in range(first, end))
            unmet = np.arange(len(edges) + 2) > (len(edges) if threshold == math.inf else np.searchsorted(edges, threshold))
            unmet[-1] = not missing_left
            for w in range(len(masks[f])):
                masks[f][w, unmet] &= np.uint64(~(closed >> (64 * w)) & ((1 << 64) - 1))
        return sorted(masks.items()), np.array(values, float)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """P(class 1) of the rows of a matrix (NaN: missing)."""
        at = {f: np.where(np.isnan(x[:, f]), len(e) + 1, np.searchsorted(e, x[:, f], "left")) for f, e in self.edges.items()}
        total = np.zeros(len(x))
        for masks, values in self.trees:
            leaf = np.zeros(len(x), np.int64)
            for w in reversed(range(len(masks[0][1]) if masks else 0)):
                is_open = masks[0][1][w][at[masks[0][0]]]
                for f, m in masks[1:]:
                    is_open &= m[w][at[f]]
                first = (is_open & (~is_open + np.uint64(1))).astype(float).view(np.int64) >> 52  # exponent of a power of two
                leaf = np.where(is_open != 0, first - 1023 + 64 * w, leaf)
            total += values[leaf]
        return 1.0 / (1.0 + np.exp(-total))


def score_arrays(nodes: Sequence[tuple], x: np.ndarray) -> np.ndarray:
    """P(class 1) of rows of a matrix (NaN: missing) from the node table in arrays: the form the expression is checked against."""
    return Walk(nodes)(x)


# ---- ML stages -----------------------------------------------------------------------------------------------------

class PopulationScaler(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """K1 as an ML stage: ``(x - mean) / population std`` per column; a zero std divides by 1, NULLs stay NULL."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "PopulationScalerModel":
        fitted = feat.fit_standard(df, self.getInputCols())
        means = [float(fitted[c][0] or 0.0) for c in self.getInputCols()]
        stds = [float(fitted[c][1] or 1.0) for c in self.getInputCols()]
        return PopulationScalerModel(inputCols=self.getInputCols(), outputCols=self.getOutputCols(), means=means, stds=stds)


class PopulationScalerModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted ``PopulationScaler``; a plain projection."""

    means = Param(Params._dummy(), "means", "mean of each column", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "population standard deviation of each column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, means=None, stds=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        names = zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.means), self.getOrDefault(self.stds))
        return df.withColumns({out: (col(c) - F.lit(m)) / F.lit(s) for c, out, m, s in names})


class HistBoost(Estimator, HasInputCols, HasLabelCol, HasWeightCol, DefaultParamsReadable, DefaultParamsWritable):
    """K6: binary gradient boosting on histograms."""

    rounds = Param(Params._dummy(), "rounds", "trees", TypeConverters.toInt)
    num_leaves = Param(Params._dummy(), "num_leaves", "leaves of a tree at most", TypeConverters.toInt)
    max_depth = Param(Params._dummy(), "max_depth", "depth of a tree at most", TypeConverters.toInt)
    learning_rate = Param(Params._dummy(), "learning_rate", "factor of each tree", TypeConverters.toFloat)
    min_data_in_leaf = Param(Params._dummy(), "min_data_in_leaf", "rows of a leaf at least", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol="label", weightCol=None, rounds=100, num_leaves=31, max_depth=6, learning_rate=0.1, min_data_in_leaf=20):
        super().__init__()
        self._setDefault(rounds=100, num_leaves=31, max_depth=6, learning_rate=0.1, min_data_in_leaf=20)
        self._set(**self._input_kwargs)

    def fit_params(self) -> dict:
        return {k: self.getOrDefault(k) for k in ("num_leaves", "max_depth", "learning_rate", "min_data_in_leaf")}

    def _fit(self, df: DataFrame) -> "HistBoostModel":
        weight = col(self.getWeightCol()) if self.isDefined("weightCol") else F.lit(1.0)
        rows = df.select(*[col(c) for c in self.getInputCols()], col(self.getLabelCol()).cast("double").alias("label"), weight.alias("weight"), F.lit(0).alias("fold"))
        ensembles, edges, state = fit_many(rows, self.getInputCols(), [Fit(**self.fit_params())], self.getOrDefault("rounds"))
        state.unpersist()
        return HistBoostModel(inputCols=self.getInputCols(), nodes=node_rows(ensembles[0], edges))


class _NodesWriter(MLWriter):
    def __init__(self, model: "HistBoostModel"):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = SparkSession.active()
        DefaultParamsWriter.saveMetadata(self.model, path, spark)
        spark.createDataFrame(self.model.nodes, NODES).coalesce(1).write.parquet(f"{path}/nodes")


class _NodesReader(MLReader):
    def load(self, path: str) -> "HistBoostModel":
        spark = SparkSession.active()
        meta = DefaultParamsReader.loadMetadata(path, spark)
        model = HistBoostModel(nodes=sorted(map(tuple, spark.read.parquet(f"{path}/nodes").collect())))  # rounds x leaves rows
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


class HistBoostModel(Model, HasInputCols, MLWritable, MLReadable):
    """Fitted ``HistBoost``: its node table, applied as an expression; adds ``probability`` (of class 1)."""

    def __init__(self, inputCols=None, nodes=()):
        super().__init__()
        self.nodes = [tuple(r) for r in nodes]
        if inputCols:
            self._set(inputCols=list(inputCols))

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("probability", score_column(self.nodes, self.getInputCols()))

    def node_table(self, spark: SparkSession) -> DataFrame:
        """The stored nodes, with the features' names."""
        names = F.array(*[F.lit(c) for c in self.getInputCols()])
        return spark.createDataFrame(self.nodes, NODES).withColumn("feature_name", F.get(names, F.col("feature")))

    def write(self) -> MLWriter:
        return _NodesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _NodesReader()


def split_importances(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """Splits and gain of every feature from a node table with ``feature_name``; features without a split have 0."""
    every = nodes.sparkSession.createDataFrame([(f,) for f in features], "feature_name string")
    found = nodes.where("left is not null").groupBy("feature_name").agg(F.count("*").alias("splits"), F.sum("gain").alias("gain"))
    return every.join(F.broadcast(found), "feature_name", "left").na.fill(0, ["splits"]).na.fill(0.0, ["gain"])  # a row per feature

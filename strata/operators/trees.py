"""Many tree ensembles grown together (M2-M4, M8; the fits of N1, N3): folds and grid points share each pass.

The training rows are written once as blocks: the features, their bins, label, fold and a hash of the key.  A pass is
one job over the blocks: every task adds up, for all trees that still grow, sums by (tree, node, feature, bin); partial
sums are added by tree, and the best split of each node is all that comes back.  So a level of all trees of all fits
costs one pass, however many fits there are.  Rows that fill no more than one partition (32 MB) are one task's input in
every pass: there the task makes the passes one after another, for its share of the fits, with the same functions.

* ``forest``: rows weighted by Poisson(1), a feature subset per node, Gini gain.
* ``extra``: one threshold per (tree, node, feature), drawn by hash between the node's least and largest value; no bins.
* ``boosting``: trees on the residuals of the logistic loss, leaves by one Newton step.
* ``second_order``: sums of gradients and hessians, gain with L2 penalty and least gain, a learned side for missing values.

Every random choice is a hash of the seed and the key, tree, node or feature, so a result depends neither on the
partitioning nor on which fits share a pass.  A tree grown without limits holds the trees of all depth and size limits
as its upper parts, a forest or a boosted ensemble those with fewer trees as its first ones: views of one fit.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.models_common import staged_table, workers_import_this

MAX_BINS = 32
MISSING = 255
#: Rows of a block, and bytes of a pass's sums that one task may hold.
BLOCK_ROWS, SUMS_BYTES = 20_000, 192 << 20
#: Bytes of all tasks' partial sums up to which the driver adds them.
FEW_BYTES = 16 << 20
#: Bytes of a level's sums up to which the driver keeps them, so of two boosted nodes only the smaller is added up.
KEPT_BYTES = 64 << 20
#: Bytes of blocks up to which they are one partition.
PART_BYTES = 32 << 20
#: Boosting rounds after which the running margins are written to the checkpoint folder again.
STORE_ROUNDS = 10
#: What a label counts in a sum that holds weights and labels: more than the weights of a block's rows.
PACKED = float(1 << 26)
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


@dataclass(frozen=True)
class Growth:
    """What is grown: ``trees`` of at most ``depth`` levels (None: no limit) on the rows outside ``fold`` (-1: all)."""

    kind: str
    trees: int = 100
    depth: int | None = None
    fold: int = -1
    min_leaf: int = 1
    rate: float = 0.1
    rows: float = 1.0
    columns: float = 1.0
    seed: int = 42
    penalty: float = 1.0
    least_gain: float = 0.0
    least_weight: float = 1.0

    @property
    def boosted(self) -> bool:
        return self.kind in ("boosting", "second_order")


@dataclass(frozen=True)
class View:
    """A part of a fit: its first ``trees``, cut at ``depth`` and at nodes of fewer than ``min_split`` rows."""

    trees: int
    depth: int | None = None
    min_split: int = 2


@dataclass
class Block:
    x: np.ndarray
    bins: np.ndarray
    y: np.ndarray
    fold: np.ndarray
    h: np.ndarray
    margins: dict[int, np.ndarray] = field(default_factory=dict)
    draws: dict[tuple, tuple] = field(default_factory=dict)
    codes: np.ndarray | None = None

    def coded(self, bins: int) -> np.ndarray:
        """The bins with ``bins`` for a missing value, made once for all trees of a pass."""
        if self.codes is None:
            self.codes = np.where(self.bins == MISSING, np.uint8(bins), self.bins)
        return self.codes

    def drawn(self, seed: int, purpose: int, *turn: int) -> np.ndarray:
        """:func:`mixed` of the rows' hashes. The last draw for a seed and purpose stays, for the fits and batches that share it."""
        return self.last((seed, purpose), turn, lambda: mixed(self.h, seed, purpose, *turn))

    def last(self, key: tuple, turn, make: Callable) -> np.ndarray:
        """What ``make`` gave for this key and turn, if that was the key's last turn."""
        if self.draws.get(key, (None,))[0] != turn:
            self.draws[key] = turn, make()
        return self.draws[key][1]


def mixed(h, *salts: int) -> np.ndarray:
    """Uniforms in [0, 1) from 64-bit hashes (the finalizer of SplitMix64) and salts."""
    z = np.asarray(h, np.uint64).copy() if np.ndim(h) else np.array(h, np.uint64)
    with np.errstate(over="ignore"):
        for salt in salts:
            z = z ^ (np.uint64(salt & 0xFFFFFFFFFFFFFFFF) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019))
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            z = z ^ (z >> np.uint64(31))
    return (z >> np.uint64(11)).astype(np.float64) / float(1 << 53)


#: A tree's nodes as arrays, in the order of their levels. A leaf has feature -1; the right child follows the left. ``path``
#: names a node by its way from the root, so its random draws don't depend on what else has grown. ``cut`` is the last bin left
#: of the threshold (not of ``extra``, which has no bins).
NODE = {"feature": np.int32, "threshold": np.float64, "missing_left": bool, "left": np.int32, "value": np.float64, "n": np.float64,
        "gain": np.float64, "path": np.uint64, "cut": np.uint8}
SAVED = [n for n in NODE if n not in ("path", "cut")]


def fresh_nodes(n: int) -> dict[str, np.ndarray]:
    return {name: np.full(n, -1 if name in ("feature", "left") else 0, kind) for name, kind in NODE.items()}


def walked(tree: dict[str, np.ndarray], x: np.ndarray, depth: int | None = None, min_split: float = 0, rows: np.ndarray | None = None,
           by: str = "threshold") -> np.ndarray:
    """The node in which each row of ``x``, or each of ``rows``, ends. ``by`` "cut": ``x`` are bins."""
    x = np.ascontiguousarray(x)
    start = (np.arange(len(x)) if rows is None else rows) * x.shape[1]
    node, moving, at = np.zeros(len(start), np.int64), np.arange(len(start)), np.zeros(len(start), np.int64)
    inner = (tree["feature"] >= 0) & (tree["n"] >= min_split)
    flat, level = x.reshape(-1), 0
    while len(moving) and (depth is None or level < depth):
        on = inner.take(at)
        if not on.all():
            node[moving[~on]] = at[~on]
            moving, at, start = moving[on], at[on], start[on]
        value = flat.take(start + tree["feature"].take(at))
        right, unknown = value > tree[by].take(at), np.isnan(value) if by == "threshold" else value == MISSING
        if unknown.any():
            right[unknown] = ~tree["missing_left"][at[unknown]]
        at = tree["left"].take(at) + right
        level += 1
    node[moving] = at
    return node


# ---- the rows -------------------------------------------------------------------------------

class Matrix:
    """The training rows as blocks. ``groups`` copies of few blocks let tasks share out the fits; many blocks need none."""

    def __init__(self, spark: SparkSession, stored: DataFrame, edges: list[np.ndarray], features: list[str], parallelism: int):
        self.spark, self.edges, self.features = spark, edges, features
        blocks = stored.rdd.map(_block).persist(StorageLevel.MEMORY_AND_DISK)
        self.parts = blocks.getNumPartitions()
        self.groups = max(1, parallelism // self.parts)
        copies = [blocks.map(lambda b, g=g: (g, b)) for g in range(self.groups)]
        self.copies = spark.sparkContext.union(copies) if self.groups > 1 else copies[0]  # a union of one would hand each pass's rows on twice
        self.blocks = blocks

    @classmethod
    def build(cls, df: DataFrame, features: Sequence[str], key: str, label: str = "label", fold: str | None = "fold",
              max_bins: int = MAX_BINS, parallelism: int | None = None, partitions: int | None = None) -> Matrix:
        """Bins are cut at quantiles (one aggregation for all features). NaN and NULL features are missing values; rows
        without a label are left out. Rows of a fold below 0 train every fit. ``partitions``: their number, if not by size."""
        spark, features = df.sparkSession, list(features)
        workers_import_this(spark)
        known = df.where(F.col(label).isNotNull())
        number = [F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")).alias(f"f{i}") for i, c in enumerate(features)]
        shares = [i / max_bins for i in range(1, max_bins)]
        cuts = known.select(*number).agg(*(F.percentile_approx(f"f{i}", shares, 10_000).alias(f"f{i}") for i in range(len(features)))).first()
        edges = [np.unique(np.array(cuts[i] or [], np.float64)) for i in range(len(features))]
        rows = known.select(F.xxhash64(key).alias("h"), F.col(label).cast("int").alias("y"),
                            (F.col(fold).cast("int") if fold else F.lit(-1)).alias("fold"), *number)

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK_ROWS):
                    part = batch.slice(at, BLOCK_ROWS)
                    h, y, f, *xs = (part.column(i).to_numpy(zero_copy_only=False) for i in range(part.num_columns))
                    x = np.stack(xs, 1).astype(np.float64) if xs else np.zeros((len(h), 0))
                    bins = np.stack([np.where(np.isnan(v), MISSING, np.searchsorted(e, v, "left")) for v, e in zip(x.T, edges)], 1).astype(np.uint8)
                    values = [x, bins, y.astype(np.int8), f.astype(np.int16), h.astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array([len(h)]), *(pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in values)],
                                                     names=["n", "x", "bins", "y", "fold", "h"])

        own_cores = parallelism or spark.sparkContext.defaultParallelism
        size = partitions or max(1, math.ceil(known.count() * (9 * len(features) + 11) / PART_BYTES))
        if size > 1 and not partitions:  # the rows are shared out in every pass: by all cores, in equal parts
            size = partitions = math.ceil(size / own_cores) * own_cores
        rows = rows.repartition(size) if partitions else rows.coalesce(size) if size < rows.rdd.getNumPartitions() else rows
        stored = staged_table(rows.mapInArrow(packed, "n long, x binary, bins binary, y binary, fold binary, h binary"), "blocks")
        stored = stored.coalesce(size) if size < stored.rdd.getNumPartitions() else stored
        return cls(spark, stored, edges, features, own_cores)

    def release(self) -> None:
        self.blocks.unpersist()


def _block(row) -> Block:
    h = np.frombuffer(row.h, np.int64)
    x = np.frombuffer(row.x, np.float64).reshape(len(h), -1) if len(h) else np.zeros((0, 0))
    return Block(x, np.frombuffer(row.bins, np.uint8).reshape(x.shape), np.frombuffer(row.y, np.int8).astype(np.float64),
                 np.frombuffer(row.fold, np.int16), h.view(np.uint64))


# ---- one level of one tree ------------------------------------------------------------------

@dataclass
class Job:
    """A tree that grows in a pass: its nodes so far, those that are split now, and the trees before it (boosting)."""

    id: tuple[int, int]
    growth: Growth
    tree: dict[str, np.ndarray]
    open: np.ndarray
    level: int = 0
    unit: float = 0.0  # boosting: terms are rounded to its multiples (0: not), so that their sums are exact
    thresholds: np.ndarray | None = None  # extra: one for each open node and feature
    drawn: np.ndarray | None = None
    way: tuple | None = None

    def subset(self, p: int) -> np.ndarray:
        """The features that each open node may use, ascending."""
        if self.drawn is None:
            self.drawn = self._subset(p)
        return self.drawn

    def _subset(self, p: int) -> np.ndarray:
        g = self.growth
        if g.boosted:
            m = max(1, int(round(g.columns * p)))
            draw = mixed(np.arange(p, dtype=np.uint64), g.seed, self.id[1], 3)
            return np.sort(np.argsort(draw, kind="stable")[:m])[None, :].repeat(len(self.open), 0)
        m = max(1, int(math.sqrt(p)))
        cells = self.tree["path"][self.open][:, None] * np.uint64(1009) + np.arange(p, dtype=np.uint64)
        draw = mixed(cells, g.seed, self.id[1], 5)
        return np.sort(np.argsort(draw, axis=1, kind="stable")[:, :m], axis=1)

    def reached(self, block: Block, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of ``rows`` that lie in open nodes, and these nodes' numbers. Rows whose node leads to none are dropped on the way."""
        extra = self.growth.kind == "extra"
        if self.way is None:
            t = self.tree
            number = np.full(len(t["feature"]), -1)
            number[self.open] = np.arange(len(self.open))
            inner = np.flatnonzero(t["feature"] >= 0)
            parent = np.zeros(len(number), np.int64)
            parent[t["left"][inner]] = parent[t["left"][inner] + 1] = inner
            leads, nodes = number >= 0, self.open
            for _ in range(self.level):
                nodes = np.unique(parent[nodes])
                leads[nodes] = True
            self.way = (number, leads, t["feature"].astype(np.int64), t["left"].astype(np.int64), t["threshold"] if extra else t["cut"],
                        t["missing_left"] if t["missing_left"].any() else None)
        number, leads, feature, left, limit, missing_left = self.way
        if not self.level:
            return rows, np.zeros(len(rows), np.int64)
        values = block.x if extra else block.bins
        start, at, flat = rows * values.shape[1], np.zeros(len(rows), np.int64), values.reshape(-1)
        for _ in range(self.level):
            value = flat.take(start + feature.take(at))
            lower = value <= limit.take(at)  # a missing value is to the right of any threshold
            if missing_left is not None:
                lower |= (value == MISSING) & missing_left.take(at)
            at = left.take(at) + ~lower
            on = leads.take(at)
            if not on.all():
                on = np.flatnonzero(on)
                rows, at, start = rows.take(on), at.take(on), start.take(on)
        return rows, number.take(at)


def row_weights(g: Growth, tree: int, block: Block) -> np.ndarray:
    used = (block.fold != g.fold) | (g.fold < 0)
    if g.kind == "forest":
        return used * block.last((g.seed, "poisson"), tree, lambda: np.searchsorted(POISSON, mixed(block.h, g.seed, tree, 1), "right"))
    if g.boosted and g.rows < 1:
        return used & (block.last((g.seed, "rows"), tree, lambda: mixed(block.h, g.seed, tree, 2)) < g.rows)
    return used


def _rows_of(job: Job, block: Block, margin: np.ndarray | None):
    """Rows that lie in open nodes: their index, the open node's number, and the sums' terms (boosting; else weight and label)."""
    weight = row_weights(job.growth, job.id[1], block)
    rows, node = job.reached(block, np.flatnonzero(weight))
    y = block.y.take(rows)
    if not job.growth.boosted:
        return rows, node, [weight.take(rows).astype(np.float64), y]
    p = 1 / (1 + np.exp(-margin.take(rows)))
    terms = [y - p, p * (1 - p)]
    return rows, node, [np.rint(t / job.unit) * job.unit for t in terms] if job.unit else terms


def level_sums(job: Job, block: Block, margin: np.ndarray | None, bins: int) -> np.ndarray:
    """(term, open node, feature of its subset, bin) sums of a block; the last bin holds missing values."""
    rows, node, terms = _rows_of(job, block, margin)
    p = block.bins.shape[1]
    subset = job.subset(p)
    n, m = subset.shape
    extra, boosted = job.growth.kind == "extra", job.growth.boosted
    bins = 2 if extra else bins
    cells, base = n * (bins + 1), node * (bins + 1)
    out = np.empty((3 if boosted else 2, n, m, bins + 1))
    if boosted:
        by_feature = np.ascontiguousarray(block.coded(bins).take(rows, axis=0).T)
    else:  # weights and labels are whole numbers: one sum holds both, exactly
        by_row, start, both = (block.x if extra else block.coded(bins)).reshape(-1), rows * p, terms[0] * (1 + PACKED * terms[1])
    for q in range(m):
        if boosted:  # the same feature in all nodes
            cell = base + by_feature[subset[0, q]]
            out[0, :, q] = np.bincount(cell, minlength=cells).reshape(n, bins + 1)
            for t, term in enumerate(terms):
                out[t + 1, :, q] = np.bincount(cell, term, cells).reshape(n, bins + 1)
            continue
        value = by_row.take(start + subset[:, q].take(node))
        if extra:
            unknown, value = np.isnan(value), value > job.thresholds[:, q].take(node)
            cell = base + value
            if unknown.any():
                cell[unknown] = base[unknown] + 2
        else:
            cell = base + value
        sums = np.bincount(cell, both, cells).reshape(n, bins + 1)
        ones = np.floor(sums / PACKED)
        out[0, :, q], out[1, :, q] = sums - ones * PACKED, ones
    return out


def value_ranges(job: Job, block: Block) -> np.ndarray:
    """(least and largest, open node, feature of its subset) of a block's values."""
    rows, node, _ = _rows_of(job, block, None)
    subset = job.subset(block.x.shape[1])
    out = np.stack([np.full(subset.shape, np.inf), np.full(subset.shape, -np.inf)])
    order = np.argsort(node.astype(np.int16) if len(job.open) < 1 << 15 else node, kind="stable")  # short numbers sort by radix
    sizes = np.bincount(node, minlength=len(job.open))
    there = np.flatnonzero(sizes)
    first = (np.cumsum(sizes) - sizes)[there]
    if len(there):
        start, node, values = rows.take(order) * block.x.shape[1], node.take(order), block.x.reshape(-1)
        for q in range(subset.shape[1]):
            x = values.take(start + subset[:, q].take(node))
            unknown = np.isnan(x)
            some = unknown.any()
            out[0, there, q] = np.minimum.reduceat(np.where(unknown, np.inf, x) if some else x, first)
            out[1, there, q] = np.maximum.reduceat(np.where(unknown, -np.inf, x) if some else x, first)
    return out


def drawn_thresholds(job: Job, ranges: np.ndarray, p: int) -> np.ndarray:
    subset = job.subset(p)
    cells = job.tree["path"][job.open][:, None] * np.uint64(1009) + subset.astype(np.uint64)
    low, high = ranges
    span = np.where(high > low, high - low, 0)
    return np.where(high >= low, low, 0) + mixed(cells, job.growth.seed, job.id[1], 7) * span


def gains(g: Growth, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The gain of splits whose sides have these sums; -inf where a side is too small."""
    (nl, gl, *hl), (nr, gr, *hr) = left, right
    small = (nl < max(g.min_leaf, 1e-9)) | (nr < max(g.min_leaf, 1e-9))
    with np.errstate(divide="ignore", invalid="ignore"):
        if g.kind == "second_order":
            score = lambda a, b: a * a / (b + g.penalty)
            out = 0.5 * (score(gl, hl[0]) + score(gr, hr[0]) - score(gl + gr, hl[0] + hr[0])) - g.least_gain
            small |= (hl[0] < g.least_weight) | (hr[0] < g.least_weight)
        elif g.kind == "boosting":
            out = nl * nr / (nl + nr) * (gl / nl - gr / nr) ** 2
        else:
            gini = lambda n, k: 2 * k * (n - k) / n  # n times the impurity
            out = gini(nl + nr, gl + gr) - gini(nl, gl) - gini(nr, gr)
    return np.where(small | ~np.isfinite(out), -np.inf, out)


def best_splits(job: Job, sums: np.ndarray, p: int, edges: list[np.ndarray]) -> dict[str, np.ndarray]:
    """Per open node the best split: feature (-1: none), threshold, side of missing values, gain, and both sides' sums."""
    subset = job.subset(p)
    total = sums.sum(3)
    inside = np.cumsum(sums[..., :-1], 3)[..., :-1]  # left of each cut
    missing = sums[..., -1:]
    sides = [inside] if job.growth.kind != "second_order" else [inside, inside + missing]
    found = np.stack([gains(job.growth, s, total[..., None] - s) for s in sides], -1)  # node, feature, cut, side
    nodes = np.arange(len(subset))
    whole = total[:, nodes, 0]
    if not found.shape[2]:  # every feature is constant
        nothing = np.zeros(len(nodes))
        return {"feature": np.full(len(nodes), -1), "threshold": nothing, "missing_left": nothing > 0, "gain": nothing, "cut": nothing,
                "left": whole, "right": whole, "whole": whole}
    at = found.reshape(len(nodes), -1).argmax(1)
    q, cut, side = np.unravel_index(at, found.shape[1:])
    gain = found[nodes, q, cut, side]
    feature = np.where(gain > 1e-12, subset[nodes, q], -1)
    left = np.stack(sides, -1)[:, nodes, q, cut, side]
    if job.growth.kind == "extra":
        threshold = job.thresholds[nodes, q]
    else:
        threshold = np.array([edges[f][c] if f >= 0 else 0.0 for f, c in zip(feature.tolist(), cut.tolist())])
    return {"feature": feature, "threshold": threshold, "missing_left": side == 1, "gain": np.maximum(gain, 0), "cut": cut,
            "left": left, "right": whole - left, "whole": whole}


def leaf_values(g: Growth, sums: np.ndarray) -> np.ndarray:
    n, first = sums[0], sums[1]
    below = n if not g.boosted else sums[2] + (g.penalty if g.kind == "second_order" else 0.0)
    return np.where(below > 1e-12, (g.rate if g.boosted else 1.0) * first / np.maximum(below, 1e-12), 0.0)


def opens(g: Growth, sums: np.ndarray, level: int) -> np.ndarray:
    """Which nodes of a level are to be split."""
    n = sums[0]
    if g.depth is not None and level >= g.depth:
        return np.zeros(len(n), bool)
    return (n >= max(2, 2 * g.min_leaf)) & (g.boosted | ((sums[1] > 0) & (sums[1] < n)))


# ---- passes ---------------------------------------------------------------------------------

def _group(id: tuple[int, int], boosted: bool, groups: int) -> int:
    """The copy of the blocks that a tree grows on; a boosted fit stays where its margins are."""
    return (id[0] if boosted else id[0] + id[1]) % groups


def added(partial: RDD, add: Callable, keys: int, size: int) -> RDD | list:
    """Tasks' partial sums (key, sums), added by key. ``size``: bytes of a task's sums; few of all tasks come back as they are,
    which spares a stage, others are shuffled."""
    if size * partial.getNumPartitions() > FEW_BYTES:
        return partial.reduceByKey(add, min(keys, partial.getNumPartitions()))
    held: dict = {}
    for key, sums in partial.collect():
        held[key] = add(held[key], sums) if key in held else sums
    return list(held.items())


def _distributed(rows: RDD, groups: int) -> Callable:
    """A pass as a Spark job over the blocks of ``rows``: partial sums in every task, added by tree."""
    def passed(jobs: list[Job], own: Callable, finish: Callable, add: Callable, cell_bytes: int) -> dict:
        by_id = {j.id: j for j in sorted(jobs, key=lambda j: j.id[::-1])}  # fits share a tree's draws

        def partial(parts):
            held: dict = {}
            for group, block in parts:
                for id, j in by_id.items():
                    if _group(id, j.growth.boosted, groups) == group:
                        sums = own(j, block)
                        held[id] = sums if id not in held else add(held[id], sums)
            yield from held.items()

        summed = added(rows.mapPartitions(partial), add, len(jobs), sum(len(j.open) for j in jobs) * cell_bytes)
        if isinstance(summed, list):
            return {id: finish(by_id[id], sums) for id, sums in summed}
        return dict(summed.map(lambda kv: (kv[0], finish(by_id[kv[0]], kv[1]))).collect())  # a few numbers for each node that is split

    return passed


def _in_task(blocks: list[Block]) -> Callable:
    """A pass inside the one task that holds all blocks."""
    def passed(jobs: list[Job], own: Callable, finish: Callable, add: Callable, cell_bytes: int) -> dict:
        return {j.id: finish(j, reduce(add, (own(j, b) for b in blocks))) for j in jobs}

    return passed


def _batches(jobs: list[Job], cell_bytes: int, most: int) -> Iterator[list[Job]]:
    batch, size = [], 0
    for j in jobs:
        own = len(j.open) * cell_bytes
        if batch and size + own > most:
            yield batch
            batch, size = [], 0
        batch.append(j)
        size += own
    if batch:
        yield batch


class _Growing:
    """A tree and its open nodes, at the driver."""

    def __init__(self, id: tuple[int, int], growth: Growth):
        self.id, self.growth, self.level = id, growth, 0
        self.tree = fresh_nodes(1) | {"path": np.ones(1, np.uint64)}
        self.open = np.zeros(1, np.int64)
        self.kept: np.ndarray | None = None  # the sums of the nodes split last, whose children start at ``first``
        self.first = 0

    def job(self, unit: float = 0.0) -> Job:
        return Job(self.id, self.growth, self.tree, self.open, self.level, unit)

    def smaller(self, unit: float) -> Job:
        """The job of the smaller child of each pair with an open one: the other's sums are what it leaves of the parent's."""
        job = self.job(unit)
        if self.kept is not None:
            pair, n = np.unique((self.open - self.first) // 2), self.tree["n"]
            left = self.first + 2 * pair
            job.open = left + (n[left + 1] < n[left])
        return job

    def filled(self, job: Job, sums: np.ndarray) -> np.ndarray:
        """The sums of all open nodes from those of :meth:`smaller`."""
        if self.kept is None:
            return sums
        pair = (self.open - self.first) // 2
        at = np.searchsorted((job.open - self.first) // 2, pair)
        out = sums[:, at]
        other = job.open[at] != self.open
        out[:, other] = self.kept[:, pair[other]] - out[:, other]
        return out

    def take(self, split: dict[str, np.ndarray], sums: np.ndarray | None = None) -> None:
        t, g = self.tree, self.growth
        done = split["feature"] >= 0
        if self.level == 0:
            t["n"][0], t["value"][0] = split["whole"][0][0], leaf_values(g, split["whole"])[0]
            done = done & opens(g, split["whole"], 0)
        nodes, self.level = self.open[done], self.level + 1
        for name in ("feature", "threshold", "missing_left", "gain", "cut"):
            t[name][nodes] = split[name][done]
        self.kept, self.first = None if sums is None else sums[:, done], len(t["feature"])
        t["left"][nodes] = len(t["feature"]) + 2 * np.arange(len(nodes))
        sums = np.stack([split["left"][:, done], split["right"][:, done]], 2).reshape(len(split["left"]), -1)
        new = fresh_nodes(2 * len(nodes))
        new["n"], new["value"] = sums[0], leaf_values(g, sums)
        parent = t["path"][nodes].repeat(2)
        new["path"] = np.where(parent < np.uint64(1 << 60), parent * np.uint64(2), parent * np.uint64(0x9E3779B97F4A7C15)) + np.tile([0, 1], len(nodes)).astype(np.uint64)
        self.open = len(t["feature"]) + np.flatnonzero(opens(g, sums, self.level))
        self.tree = {name: np.concatenate([t[name], new[name].astype(kind)]) for name, kind in NODE.items()}


def _grow(passed: Callable, edges: list[np.ndarray], growing: list[_Growing], margin: Callable | None = None, unit: float = 0.0) -> None:
    """Grow all trees to their ends, level by level. A level whose sums would need too much memory takes several passes.
    With a ``unit`` sums are exact, and a level's that aren't too large come to the driver: then the next adds up smaller nodes only."""
    p, bins = len(edges), max((len(e) for e in edges), default=0) + 1

    def own(job: Job, block: Block) -> np.ndarray:
        return level_sums(job, block, margin(job, block) if job.growth.boosted else None, bins)

    def finish(job: Job, sums: np.ndarray) -> dict[str, np.ndarray]:
        return best_splits(job, sums, p, edges)

    while active := {g.id: g for g in growing if len(g.open)}:
        m = max(1, p if growing[0].growth.boosted else int(math.sqrt(p)))
        cell_bytes = m * (bins + 1) * 24
        if unit and sum(len(g.open) for g in active.values()) * cell_bytes <= KEPT_BYTES:
            for some in _batches([g.smaller(unit) for g in active.values()], cell_bytes, SUMS_BYTES):
                by_id = {j.id: j for j in some}
                for id, sums in passed(some, own, lambda job, sums: sums, np.add, cell_bytes).items():
                    g = active[id]
                    sums = g.filled(by_id[id], sums)
                    g.take(best_splits(g.job(), sums, p, edges), sums)
            continue
        for some in _batches([g.job(unit) for g in active.values()], cell_bytes, SUMS_BYTES):
            drawn = [j for j in some if j.growth.kind == "extra"]
            if drawn:
                far = passed(drawn, value_ranges, lambda j, r: drawn_thresholds(j, r, p),
                             lambda a, b: np.stack([np.minimum(a[0], b[0]), np.maximum(a[1], b[1])]), cell_bytes)
                for j in drawn:
                    j.thresholds = far[j.id]
            for id, split in passed(some, own, finish, np.add, cell_bytes).items():
                active[id].take(split)


class Ensemble:
    """A fitted ensemble: trees, the margin they start from, and the share or margin that their values add up to."""

    probabilities = True

    def __init__(self, growth: Growth, features: list[str], start: float = 0.0):
        self.growth, self.features, self.start, self.trees = growth, features, start, []

    @property
    def fold(self) -> int:
        return self.growth.fold

    def scores(self, x: np.ndarray, view: View | None = None) -> np.ndarray:
        view = view or View(self.growth.trees)
        total = np.zeros(len(x))
        used, x = self.trees[:view.trees], np.ascontiguousarray(x)
        for tree in used:
            total += tree["value"][walked(tree, x, view.depth, view.min_split)]
        return 1 / (1 + np.exp(-(self.start + total))) if self.growth.boosted else total / max(1, len(used))

    def at(self, view: View) -> Ensemble:
        """The ensemble of a view alone."""
        part = Ensemble(self.growth, self.features, self.start)
        for tree in self.trees[:view.trees]:
            inner = (tree["n"] >= view.min_split) & (tree["feature"] >= 0)
            depth = np.zeros(len(inner), np.int64)
            for i in np.flatnonzero(tree["feature"] >= 0):
                depth[tree["left"][i]:tree["left"][i] + 2] = depth[i] + 1
            if view.depth is not None:
                inner &= depth < view.depth
            part.trees.append(tree | {"feature": np.where(inner, tree["feature"], -1)})
        return part

    def importances(self) -> np.ndarray:
        out = np.zeros(len(self.features))
        for tree in self.trees:
            own = np.zeros(len(self.features))
            reached = np.zeros(len(tree["feature"]), bool)
            reached[0] = True
            for i in np.flatnonzero(tree["feature"] >= 0):
                if reached[i]:
                    own[tree["feature"][i]] += tree["gain"][i]
                    reached[tree["left"][i]:tree["left"][i] + 2] = True
            out += own / own.sum() if own.sum() else own
        return out / out.sum() if out.sum() else out

    def score(self) -> Column:
        """The probability of class 1 as a column, a batch of rows at a time."""
        ensemble = self

        @F.pandas_udf("double")
        def scored(rows: pd.DataFrame) -> pd.Series:
            return pd.Series(ensemble.scores(rows.to_numpy(np.float64)))

        return scored(F.struct(*(F.col(f"`{c}`").cast("double") for c in self.features)))

    def rows(self) -> list[tuple]:
        return [(k, i, *(tree[n][i].item() for n in SAVED)) for k, tree in enumerate(self.trees) for i in range(len(tree["feature"]))]

    def save(self, spark: SparkSession, path: str) -> None:
        """The nodes as a table, with growth, features and start in a column of the first tree."""
        about = json.dumps({"growth": asdict(self.growth), "features": self.features, "start": self.start})
        nodes = spark.createDataFrame(self.rows(), "tree int, node int, feature int, threshold double, missing_left boolean, left int, "
                                                   "value double, n double, gain double")
        nodes.withColumn("about", F.when((F.col("tree") == 0) & (F.col("node") == 0), F.lit(about))).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Ensemble:
        table = spark.read.parquet(path).orderBy("tree", "node").toPandas()  # the model itself
        about = json.loads(table["about"].dropna().iloc[0])
        out = cls(Growth(**about["growth"]), about["features"], about["start"])
        for _, t in table.groupby("tree", sort=True):
            out.trees.append({n: t[n].to_numpy(NODE[n]) for n in SAVED})
        return out


def _task_blocks(parts) -> dict[int, list[Block]]:
    held: dict[int, list[Block]] = {}
    for group, block in parts:
        held.setdefault(group, []).append(block)
    return held


def grow_forests(matrix: Matrix, growths: Sequence[Growth]) -> list[Ensemble]:
    """Forests and extremely randomised trees: all trees of all fits at once."""
    out, edges, groups, growths = [Ensemble(g, matrix.features) for g in growths], matrix.edges, matrix.groups, list(growths)
    ids = [(k, t) for k, g in enumerate(growths) for t in range(g.trees)]

    def here(parts):
        for group, blocks in _task_blocks(parts).items():
            for id in ids:
                if _group(id, False, groups) == group:
                    one = _Growing(id, growths[id[0]])
                    _grow(_in_task(blocks), edges, [one])
                    yield id, one.tree

    if matrix.parts == 1:
        done = matrix.copies.mapPartitions(here).collectAsMap()
    else:
        growing = [_Growing(id, growths[id[0]]) for id in ids]
        _grow(_distributed(matrix.copies, groups), edges, growing)
        done = {g.id: g.tree for g in growing}
    for id in ids:
        out[id[0]].trees.append(done[id])
    return out


def _starts(matrix: Matrix, growths: list[Growth]) -> tuple[list[float], int]:
    """The log odds of the rows that train each fit, and the number of all rows."""
    counts = (matrix.blocks.flatMap(lambda b: [(int(f), (int((b.fold == f).sum()), float(b.y[b.fold == f].sum()))) for f in np.unique(b.fold)])
              .reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1])).collectAsMap())  # a row per fold
    out = []
    for g in growths:
        n, ones = (sum(c[i] for f, c in counts.items() if f != g.fold or g.fold < 0) for i in (0, 1))
        share = min(max(ones / n if n else 0.5, 1e-6), 1 - 1e-6)
        out.append(math.log(share / (1 - share)))
    return out, sum(n for n, _ in counts.values())


def _added(margin: np.ndarray, trees: list[dict], x: np.ndarray) -> np.ndarray:
    return margin + sum((t["value"][walked(t, x)] for t in trees), np.zeros(len(x)))


def grow_boosted(matrix: Matrix, growths: Sequence[Growth]) -> list[Ensemble]:
    """Boosted ensembles in step: a round grows the next tree of every fit. The rows' running margins are stored after every
    round, every few rounds to the checkpoint folder too, so neither a pass nor a lost executor goes back to the first tree."""
    out, edges, groups, growths = [Ensemble(g, matrix.features) for g in growths], matrix.edges, matrix.groups, list(growths)
    starts, n = _starts(matrix, growths)
    unit = 2.0 ** (n.bit_length() - 52)  # a sum of n terms up to 1 is exact
    for e, start in zip(out, starts):
        e.start = start

    def here(parts):
        for group, blocks in _task_blocks(parts).items():
            for k, g in enumerate(growths):
                if k % groups == group:
                    margins = [np.full(len(b.y), starts[k]) for b in blocks]
                    at = {id(b): i for i, b in enumerate(blocks)}
                    for turn in range(g.trees):
                        one = _Growing((k, turn), g)
                        _grow(_in_task(blocks), edges, [one], lambda job, b: margins[at[id(b)]])
                        margins = [_added(m, [one.tree], b.x) for m, b in zip(margins, blocks)]
                        yield (k, turn), one.tree

    def begun(part):
        group, b = part
        return group, Block(b.x, b.bins, b.y, b.fold, b.h, {k: np.full(len(b.y), s) for k, s in enumerate(starts) if k % groups == group})

    if matrix.parts == 1:
        done = matrix.copies.mapPartitions(here).collectAsMap()
        for k, e in enumerate(out):
            e.trees = [done[k, turn] for turn in range(growths[k].trees)]
        return out
    rows, before, turns = matrix.copies.map(begun).persist(StorageLevel.MEMORY_AND_DISK), None, max((g.trees for g in growths), default=0)
    for turn in range(turns):
        growing = [_Growing((k, turn), g) for k, g in enumerate(growths) if turn < g.trees]
        _grow(_distributed(rows, groups), edges, growing, lambda job, b: b.margins[job.id[0]], unit)  # its first pass stores the margins
        if before is not None:
            before.unpersist()
        last = {g.id[0]: g.tree for g in growing}
        for k, tree in last.items():
            out[k].trees.append(tree)

        def moved(part, last=last):
            group, b = part
            return group, Block(b.x, b.bins, b.y, b.fold, b.h,
                                {k: m + last[k]["value"][walked(last[k], b.bins, by="cut")] if k in last else m for k, m in b.margins.items()})

        if turn + 1 < turns:
            before, rows = rows, rows.map(moved).persist(StorageLevel.MEMORY_AND_DISK)
            if (turn + 1) % STORE_ROUNDS == 0:
                rows.checkpoint()
    rows.unpersist()
    return out


def held_out_scores(matrix: Matrix, models: Sequence, views: Sequence[tuple[int, View | None]]) -> DataFrame:
    """``view`` (its place in ``views``), ``score``, and how many rows of the fit's fold have it: ``pos``, ``neg``.
    ``views``: (model, view); models
    have ``fold`` and ``scores(x, view)``."""
    groups = matrix.groups
    used = sorted({k for k, _ in views})
    fits = {k: models[k] for k in used}

    def scored(parts):
        for group, block in parts:
            for number, (k, view) in enumerate(views):
                if k % groups == group:
                    rows = np.flatnonzero(block.fold == fits[k].fold)
                    values, at = np.unique(fits[k].scores(block.x[rows], view), return_inverse=True)
                    pos = np.bincount(at, block.y[rows], len(values)).astype(int)
                    neg = np.bincount(at, minlength=len(values)) - pos
                    yield from zip([number] * len(values), values.tolist(), pos.tolist(), neg.tolist())

    return matrix.spark.createDataFrame(matrix.copies.mapPartitions(scored), "view int, score double, pos long, neg long")

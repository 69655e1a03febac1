"""Many perceptrons trained together (M7; the fits of N1, N3, N4) by mini-batch Adam with early stopping.

Rows are dealt to an epoch's batches by a hash of key and epoch; a step adds up the gradients of its batch over the
blocks of :class:`strata.operators.trees.Matrix`, for all fits at once, and the moments stay with the weights, whose
size depends on the layers only.  Rows of more than one partition are shuffled by that hash once an epoch, so a step reads
the rows of its batch only, and one job makes all steps of an epoch where that keeps the cores busy.  A share of the training rows, by hash, is held out; training stops when its accuracy
hasn't risen for ``patience`` epochs, and the best weights are kept.  With ``state`` the weights and moments of all
fits are written there after every few epochs, and a later call with the same fits goes on from them.
"""

from __future__ import annotations

import itertools
import json
import math
import pickle
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from strata.operators import trees
from strata.operators.trees import Block, Matrix, added

#: Rows of a batch, and the most batches of an epoch: beyond that batches grow with the data.
BATCH, MOST_BATCHES = 200, 64
#: Epochs between two written states, and between two collections of the shuffles that no epoch reads any more.
STATE_EPOCHS = 10
#: Rows of a batch that are worth a task, and rows times bytes of weights that a core may be idle for to spare an epoch's jobs.
TASK_ROWS, IDLE_WORK = 1_000, 8e10


@dataclass(frozen=True)
class Net:
    """Fixed values of the source: hidden (100, 50), learning rate 0.001, L2 1e-4, 500 epochs, 10 % held out, patience 10."""

    hidden: tuple[int, ...] = (100, 50)
    rate: float = 0.001
    alpha: float = 1e-4
    epochs: int = 500
    held_out: float = 0.1
    patience: int = 10
    tolerance: float = 1e-4
    fold: int = -1
    seed: int = 42


class _State:
    def __init__(self, net: Net, p: int):
        rng = np.random.default_rng(net.seed)
        sizes = [p, *net.hidden, 1]
        self.weights = []
        for a, b in zip(sizes, sizes[1:]):
            bound = math.sqrt((2.0 if b == 1 else 6.0) / (a + b))
            self.weights += [rng.uniform(-bound, bound, (a, b)), rng.uniform(-bound, bound, b)]
        self.first, self.second = ([np.zeros_like(w) for w in self.weights] for _ in range(2))
        self.best, self.kept, self.stale, self.steps, self.epoch, self.done = -1.0, self.weights, 0, 0, 0, False

    def step(self, net: Net, n: int, gradient: list[np.ndarray]) -> None:
        self.steps += 1
        rate = net.rate * math.sqrt(1 - 0.999 ** self.steps) / (1 - 0.9 ** self.steps)
        new = []
        for i, (w, g) in enumerate(zip(self.weights, gradient)):
            g = (g + (net.alpha * w if w.ndim == 2 else 0.0)) / n
            self.first[i] = 0.9 * self.first[i] + 0.1 * g
            self.second[i] = 0.999 * self.second[i] + 0.001 * g * g
            new.append(w - rate * self.first[i] / (np.sqrt(self.second[i]) + 1e-8))
        self.weights = new

    def judge(self, net: Net, right: float, n: float) -> None:
        """After an epoch: keep the weights if they are the best, stop if nothing has improved for long."""
        self.epoch += 1
        accuracy = right / n if n else 0.0
        self.stale = 0 if accuracy > self.best + net.tolerance else self.stale + 1
        if accuracy > self.best:
            self.best, self.kept = accuracy, self.weights
        self.done = self.stale >= net.patience or self.epoch >= net.epochs


def forward(weights: list[np.ndarray], x: np.ndarray) -> list[np.ndarray]:
    """The layers' outputs; the last are margins."""
    layers = [np.nan_to_num(x)]
    for i in range(0, len(weights), 2):
        z = layers[-1] @ weights[i] + weights[i + 1]
        layers.append(z if i == len(weights) - 2 else np.maximum(z, 0))
    return layers


def gradients(weights: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of the summed logistic loss."""
    layers = forward(weights, x)
    delta = (1 / (1 + np.exp(-layers[-1][:, 0])) - y)[:, None]
    out: list[np.ndarray] = []
    for i in range(len(weights) - 2, -1, -2):
        out = [layers[i // 2].T @ delta, delta.sum(0), *out]
        if i:
            delta = (delta @ weights[i].T) * (layers[i // 2] > 0)
    return out


def _parts(net: Net, b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Rows that train the fit, and rows held out from it."""
    used = (b.fold != net.fold) | (net.fold < 0)
    out = b.drawn(net.seed, 11) < net.held_out
    return used & ~out, used & out


def _batch_sums(net: Net, weights: list[np.ndarray], epoch: int, batch: int, batches: int, b: Block) -> list:
    rows = _parts(net, b)[0]
    rows = rows & (np.minimum((b.drawn(net.seed, 13, epoch) * batches).astype(int), batches - 1) == batch)
    return [int(rows.sum()), *gradients(weights, b.x[rows], b.y[rows])]


def _right(net: Net, weights: list[np.ndarray], b: Block) -> list:
    rows = _parts(net, b)[1]
    return [int(rows.sum()), int(((forward(weights, b.x[rows])[-1][:, 0] > 0) == (b.y[rows] > 0)).sum())]


def _added(a: list, b: list) -> list:
    return [x + y for x, y in zip(a, b)]


def _trained(nets: dict[int, Net], p: int, passed: Callable, states: dict[int, _State] | None = None, written: Callable | None = None,
             turned: Callable | None = None) -> dict[int, _State]:
    """``passed(own)``: for each fit that ``own`` maps to (function, arguments), its sums over all blocks. ``turned``: all steps
    of an epoch at once, if not by ``passed``."""
    states = states or {i: _State(net, p) for i, net in nets.items()}
    rows = passed({i: (_right, (net, states[i].weights)) for i, net in nets.items()})
    sizes = passed({i: (_train_size, (net,)) for i, net in nets.items()})
    batches = {i: min(MOST_BATCHES, max(1, round(sizes[i][0] / BATCH))) for i in nets}
    while moving := [i for i in nets if not states[i].done]:
        if turned:
            states.update(turned({i: nets[i] for i in moving}, {i: states[i] for i in moving}, batches))
        for batch in range(0 if turned else max(batches[i] for i in moving)):
            own = {i: (_batch_sums, (nets[i], states[i].weights, states[i].epoch, batch, batches[i])) for i in moving if batch < batches[i]}
            for i, (n, *gradient) in passed(own).items():
                if n:
                    states[i].step(nets[i], n, gradient)
        for i, (n, right) in passed({i: (_right, (nets[i], states[i].weights)) for i in moving}).items():
            states[i].judge(nets[i], right, n)
        if written and any(states[i].epoch % STATE_EPOCHS == 0 for i in moving):
            written(states)
    return states


def _train_size(net: Net, b: Block) -> list:
    return [int(_parts(net, b)[0].sum())]


class Perceptron:
    def __init__(self, net: Net, features: list[str], weights: list[np.ndarray], epochs: int = 0, held_out_accuracy: float = math.nan):
        self.net, self.features, self.weights = net, list(features), weights
        self.epochs, self.held_out_accuracy = epochs, held_out_accuracy

    @property
    def fold(self) -> int:
        return self.net.fold

    def scores(self, x: np.ndarray, view=None) -> np.ndarray:
        return 1 / (1 + np.exp(-forward(self.weights, x)[-1][:, 0]))

    probabilities = True

    def score(self) -> Column:
        model = self

        @F.pandas_udf("double")
        def scored(rows: pd.DataFrame) -> pd.Series:
            return pd.Series(model.scores(rows.to_numpy(np.float64)))

        return scored(F.struct(*(F.col(f"`{c}`").cast("double") for c in self.features)))

    def importances(self) -> None:
        return None

    def save(self, spark: SparkSession, path: str) -> None:
        about = json.dumps({"net": asdict(self.net), "features": self.features, "weights": [w.tolist() for w in self.weights],
                            "epochs": self.epochs, "held_out_accuracy": self.held_out_accuracy})
        spark.createDataFrame([(about,)], "about string").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Perceptron:
        about = json.loads(spark.read.parquet(path).first()["about"])
        about["net"]["hidden"] = tuple(about["net"]["hidden"])
        return cls(Net(**about["net"]), about["features"], [np.array(w) for w in about["weights"]], about["epochs"], about["held_out_accuracy"])


def _span(batch: int, batches: int) -> range:
    """The slots whose rows a batch may have; where slots and batches differ one more on each side, as products are rounded."""
    if batches == MOST_BATCHES:
        return range(batch, batch + 1)
    return range(max(0, MOST_BATCHES * batch // batches - 1), min(MOST_BATCHES, -(-MOST_BATCHES * (batch + 1) // batches) + 1))


def _joined(parts: list[tuple]) -> Block:
    x, y, fold, h = (np.concatenate(a) for a in zip(*parts))
    return Block(x, np.zeros((len(y), 0), np.uint8), y, fold, h)


class _Epochs:
    """The rows, shuffled by the hash that deals them to an epoch's batches: ``MOST_BATCHES`` slots of equal width.

    A job costs much more than the few rows of a batch, so a task makes an epoch's steps for its share of the fits, one slot
    after another (:meth:`turned`).  Where that would leave cores idle for longer than the steps' jobs take, a step is a job on
    the batch's slots, of ``share`` partitions each (:meth:`step`)."""

    def __init__(self, matrix: Matrix, sizes: dict[int, int]):
        self.matrix, self.sizes, self.dealt, self.turns = matrix, sizes, {}, 0
        self.cores = matrix.spark.sparkContext.defaultParallelism
        n = matrix.blocks.map(lambda b: len(b.y)).sum()
        idle = math.ceil(len(sizes) / self.cores) - len(sizes) / self.cores
        self.streamed = idle * n * max(sizes.values(), default=0) <= IDLE_WORK
        self.share = 1 if self.streamed else max(1, min(matrix.parts, math.ceil(n / MOST_BATCHES / TASK_ROWS)))

    def _rows(self, seed: int, epoch: int):
        if self.dealt.get(seed, (None,))[0] != epoch:
            share, slots = self.share, MOST_BATCHES

            def split(part, blocks):
                for b in blocks:
                    slot = np.minimum((b.drawn(seed, 13, epoch) * slots).astype(int), slots - 1)
                    order = np.argsort(slot.astype(np.int16), kind="stable")
                    at = np.searchsorted(slot[order], np.arange(slots + 1))
                    for s in range(slots):
                        rows = order[at[s]:at[s + 1]]
                        yield s * share + part % share, (b.x[rows], b.y[rows], b.fold[rows], b.h[rows])

            self.dealt[seed] = epoch, self.matrix.blocks.mapPartitionsWithIndex(split).partitionBy(slots * share, int)
            self.turns += 1
            if self.turns % STATE_EPOCHS == 0:  # Spark deletes a shuffle's files when its RDD is collected
                self.matrix.spark.sparkContext._jvm.System.gc()
        return self.dealt[seed][1]

    def turned(self, nets: dict[int, Net], states: dict[int, _State], batches: dict[int, int]) -> dict[int, _State]:
        """The states after all steps of an epoch."""
        out = {}
        for seed, epoch in sorted({(nets[i].seed, states[i].epoch) for i in states}):
            own = [i for i in states if (nets[i].seed, states[i].epoch) == (seed, epoch)]
            tasks, rows = min(len(own), self.cores), self._rows(seed, epoch)
            held = {i: (nets[i], states[i], batches[i]) for i in own}

            def stepped(task, parts):
                mine, early, near, next_slot = own[task::tasks], {}, {}, 0
                at = dict.fromkeys(mine, 0)
                for slot, arrays in itertools.chain(itertools.groupby(parts, lambda part: part[0]), [(None, ())]):
                    if slot is not None:
                        early[slot] = _joined([a for _, a in arrays])
                    while next_slot in early:  # whatever order the slots come in, the steps are in theirs
                        near[next_slot] = early.pop(next_slot)
                        next_slot += 1
                        for i in mine:
                            net, state, n = held[i]
                            while at[i] < n and (span := _span(at[i], n)).stop <= next_slot:
                                parts_of = [_batch_sums(net, state.weights, epoch, at[i], n, near[s]) for s in span]
                                count, *gradient = reduce(_added, parts_of)
                                if count:
                                    state.step(net, count, gradient)
                                at[i] += 1
                        least = min(_span(at[i], held[i][2]).start if at[i] < held[i][2] else MOST_BATCHES for i in mine)
                        near = {s: b for s, b in near.items() if s >= least}
                yield from ((i, held[i][1]) for i in mine)

            # a task reads all slots; its only partition is the shuffle's, one after another
            every = [rows.coalesce(1) for _ in range(tasks)]
            every = self.matrix.spark.sparkContext.union(every) if tasks > 1 else every[0]
            out.update(every.mapPartitionsWithIndex(stepped).collect())  # weights and moments of each fit
        return out

    def step(self, own: dict[int, tuple]) -> dict[int, list]:
        """The sums of one batch of each fit."""
        out: dict[int, list] = {}
        for seed, epoch in sorted({(net.seed, epoch) for _, (net, _, epoch, _, _) in own.values()}):
            rows, jobs = self._rows(seed, epoch), [{}]
            for i, (_, arguments) in own.items():
                if (arguments[0].seed, arguments[2]) == (seed, epoch):
                    if jobs[-1] and (sum(self.sizes[k] for k in jobs[-1]) + self.sizes[i]) * self.share > trees.FEW_BYTES:
                        jobs.append({})  # the driver adds up what a job's tasks find
                    jobs[-1][i] = arguments
            for job in jobs:
                def partial(parts, job=job):
                    arrays = [a for _, a in parts]
                    b = _joined(arrays) if arrays else None
                    return [(i, _batch_sums(*arguments, b)) for i, arguments in job.items()] if b else []

                slots = sorted({s for _, _, _, batch, n in job.values() for s in _span(batch, n)})
                for i, sums in self.matrix.spark.sparkContext.runJob(rows, partial, [s * self.share + k for s in slots for k in range(self.share)]):
                    out[i] = _added(out[i], sums) if i in out else sums
        return out


def fit_perceptrons(matrix: Matrix, nets: Sequence[Net], state: str | None = None) -> list[Perceptron]:
    """All ``nets``, each on the rows outside its fold. ``state``: a folder shared by the cluster."""
    spark, p, groups, wanted = matrix.spark, len(matrix.features), matrix.groups, dict(enumerate(nets))

    def here(parts):
        held: dict[int, list[Block]] = {}
        for group, block in parts:
            held.setdefault(group, []).append(block)
        for group, blocks in held.items():
            def passed(own):
                out = {}
                for i, (function, arguments) in own.items():
                    sums = [function(*arguments, b) for b in blocks]
                    out[i] = sums[0] if len(sums) == 1 else [sum(x) for x in zip(*sums)]
                return out

            for i, net in wanted.items():
                if i % groups == group:
                    s = _trained({i: net}, p, passed)[i]
                    yield i, (s.kept, s.epoch, s.best)

    sizes = {i: 8 * sum(a * b + b for a, b in zip((p, *net.hidden), (*net.hidden, 1))) for i, net in wanted.items()}

    def passed(own):
        if epochs and all(function is _batch_sums for function, _ in own.values()):
            return epochs.step(own)

        def partial(parts):
            held: dict[int, list] = {}
            for group, block in parts:
                for i, (function, arguments) in own.items():
                    if i % groups == group:
                        sums = function(*arguments, block)
                        held[i] = _added(held[i], sums) if i in held else sums
            yield from held.items()

        sums = added(matrix.copies.mapPartitions(partial), _added, len(own), sum(sizes[i] for i in own))
        return dict(sums if isinstance(sums, list) else sums.collect())  # the layers' numbers for each fit

    epochs = _Epochs(matrix, sizes) if matrix.parts > 1 else None
    if matrix.parts == 1:
        found = matrix.copies.mapPartitions(here).collectAsMap()
    else:
        states = _read_state(spark, state, wanted)
        done = _trained(wanted, p, passed, states, (lambda s: _write_state(spark, state, wanted, s)) if state else None,
                        epochs.turned if epochs.streamed else None)
        found = {i: (s.kept, s.epoch, s.best) for i, s in done.items()}
    return [Perceptron(net, matrix.features, *found[i]) for i, net in wanted.items()]


def _write_state(spark: SparkSession, folder: str, nets: dict[int, Net], states: dict[int, _State]) -> None:
    """Adds a row; the row with the most epochs counts."""
    row = (repr(sorted(nets.items())), max(s.epoch for s in states.values()), bytearray(pickle.dumps(states)))
    spark.createDataFrame([row], "fits string, epoch int, states binary").write.mode("append").parquet(folder)


def _read_state(spark: SparkSession, folder: str | None, nets: dict[int, Net]) -> dict[int, _State] | None:
    from strata.sources.io import _exists
    if not folder or not _exists(spark, folder):
        return None
    row = spark.read.parquet(folder).where(F.col("fits") == repr(sorted(nets.items()))).agg(F.max_by("states", "epoch")).first()
    return pickle.loads(bytes(row[0])) if row[0] is not None else None

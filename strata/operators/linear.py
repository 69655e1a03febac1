"""Many linear models fitted together (M1, M5; the fits of N1, N3, N4): every fold and every point of a grid shares each
pass over the blocks of :class:`strata.operators.trees.Matrix`.

A pass adds up loss, gradient and Hessian of every fit; the Newton steps, with coordinate descent where the penalty is
L1, are taken from these sums, whose size depends on the number of features only.  Kernels are explicit maps of the rows
inside the pass: random Fourier features for ``rbf``, TensorSketch (Pham & Pagh, "Fast and Scalable Polynomial Kernels
via Explicit Feature Maps", 2013) for ``poly``.  The hinge is rounded off, so it has a Hessian: first over a wide margin,
where Newton steps are safe from anywhere, then over narrower ones, each starting from the optimum of the one before.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.trees import Block, Matrix

ROUNDS = (2.0, 0.5, 0.1)
STEPS, TOLERANCE = 150, 1e-7


@dataclass(frozen=True)
class Kernel:
    """``kind`` linear, rbf or poly; ``gamma`` a number, ``scale`` (1 / (features * variance)) or ``auto`` (1 / features)."""

    kind: str = "linear"
    gamma: float | str = "scale"
    degree: int = 3
    shift: float = 0.0
    size: int = 100
    seed: int = 42


@dataclass(frozen=True)
class LinearFit:
    """``loss`` logistic or hinge; the sum of losses times ``cost`` plus half the squared weights (``l2``) or their sum (``l1``)."""

    loss: str = "logistic"
    cost: float = 1.0
    penalty: str = "l2"
    fold: int = -1
    kernel: Kernel = Kernel()


class Map:
    """A kernel's explicit map, with gamma resolved."""

    def __init__(self, kernel: Kernel, p: int):
        self.kernel, self.p = kernel, p
        rng = np.random.default_rng(kernel.seed)
        if kernel.kind == "rbf":
            self.w = rng.normal(0.0, math.sqrt(2.0 * kernel.gamma), (p, kernel.size))
            self.b = rng.uniform(0.0, 2.0 * math.pi, kernel.size)
        elif kernel.kind == "poly":
            self.bucket = rng.integers(0, kernel.size, (kernel.degree, p + 1))
            self.sign = rng.choice([-1.0, 1.0], (kernel.degree, p + 1))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        k = self.kernel
        x = np.nan_to_num(x)
        if k.kind == "rbf":
            return math.sqrt(2.0 / k.size) * np.cos(x @ self.w + self.b)
        if k.kind == "poly":
            own = np.concatenate([math.sqrt(k.gamma) * x, np.full((len(x), 1), math.sqrt(k.shift))], 1)
            product = np.ones((len(x), k.size // 2 + 1), complex)
            for bucket, sign in zip(self.bucket, self.sign):
                sketch = np.zeros((self.p + 1, k.size))
                sketch[np.arange(self.p + 1), bucket] = sign
                product *= np.fft.rfft(own @ sketch, axis=1)  # the transform of a convolution: a sketch of the tensor product
            return np.fft.irfft(product, k.size, axis=1)
        return x


def resolved(matrix: Matrix, kernels: Sequence[Kernel]) -> dict[Kernel, Kernel]:
    """Kernels with a number for gamma; ``scale`` takes one pass for all of them."""
    p = len(matrix.features)
    n, first, second = matrix.blocks.map(lambda b: np.array([b.x.size, np.nansum(b.x), np.nansum(b.x ** 2)])).reduce(np.add) \
        if any(k.gamma == "scale" and k.kind != "linear" for k in kernels) else (1, 0, 1)
    spread = second / max(n, 1) - (first / max(n, 1)) ** 2
    number = {"scale": 1 / (p * spread) if spread > 0 else 1.0, "auto": 1 / max(p, 1)}
    return {k: replace(k, gamma=number.get(k.gamma, k.gamma)) if k.kind != "linear" else k for k in kernels}


def _sums(fits: list[LinearFit], maps: dict[Kernel, Map], weights: dict[int, tuple], block: Block) -> dict[int, tuple]:
    """(rows, loss, gradient, Hessian) of each fit that is still moving, at its (weights, width of the rounding)."""
    out = {}
    mapped = rows = shared = None
    for i in sorted(weights, key=lambda i: (repr(fits[i].kernel), fits[i].fold)):  # fits that share their rows follow each other
        (w, width), f = weights[i], fits[i]
        if mapped is None or f.kernel != mapped[0]:
            mapped, shared = (f.kernel, np.concatenate([maps[f.kernel](block.x), np.ones((len(block.y), 1))], 1)), None
        if shared != f.fold:
            used, shared = (block.fold != f.fold) | (f.fold < 0), f.fold
            rows = (mapped[1], block.y * 2 - 1) if used.all() else (mapped[1][used], block.y[used] * 2 - 1)
        z, y = rows
        m = y * (z @ w)
        if f.loss == "logistic":
            loss, p = np.logaddexp(0, -m), 1 / (1 + np.exp(m))
            slope, bend = -p, p * (1 - p)
            bent = (z * bend[:, None]).T @ z
        else:
            gap = 1 - m
            loss = np.where(gap <= 0, 0, np.where(gap < width, gap * gap / (2 * width), gap - width / 2))
            slope, curved = -np.clip(gap / width, 0, 1), z[(gap > 0) & (gap < width)]  # no other row bends the loss
            bent = curved.T @ curved / width
        out[i] = (len(y), float(loss.sum()), z.T @ (y * slope), bent)
    return out


def _add(a: tuple, b: tuple) -> tuple:
    return tuple(x + y for x, y in zip(a, b))


def _objective(f: LinearFit, loss: float, w: np.ndarray) -> float:
    own = w[:-1]
    return f.cost * loss + (0.5 * own @ own if f.penalty == "l2" else np.abs(own).sum())


def _step(f: LinearFit, w: np.ndarray, gradient: np.ndarray, bend: np.ndarray) -> np.ndarray:
    """Where the quadratic model of the objective at ``w`` is least."""
    gradient, bend = f.cost * gradient, f.cost * bend + 1e-9 * np.eye(len(w))
    free = np.arange(len(w)) < len(w) - 1  # the last weight is the offset
    if f.penalty == "l2":
        return w - np.linalg.solve(bend + np.diag(free + 1e-6 * ~free), gradient + free * w)
    new, ahead = w.copy(), np.zeros(len(w))  # ahead: bend @ (new - w)
    for _ in range(200):
        most = 0.0
        for j in range(len(w)):
            curve = bend[j, j] + 1e-9
            target = new[j] - (gradient[j] + ahead[j]) / curve
            value = math.copysign(max(abs(target) - 1 / curve, 0.0), target) if free[j] else target
            if value != new[j]:
                ahead += bend[:, j] * (value - new[j])
                most, new[j] = max(most, abs(value - new[j])), value
        if most < 1e-9:
            break
    return new


def _minimised(fits: list[LinearFit], sizes: dict[int, int], passed: Callable) -> dict[int, np.ndarray]:
    """Damped Newton steps for all fits at once. ``passed(weights)`` gives the sums at these weights."""
    stages = {i: list(ROUNDS) if fits[i].loss == "hinge" else [0.0] for i in sizes}
    moving = {i: np.zeros(n + 1) for i, n in sizes.items()}
    best: dict[int, tuple] = {}  # objective, weights
    whole = dict.fromkeys(sizes, False)  # whether the weights tried are those of a whole step
    done = {}
    for _ in range(STEPS):
        for i, (_, loss, gradient, bend) in passed({i: (w, stages[i][0]) for i, w in moving.items()}).items():
            f, w = fits[i], moving[i]
            value = _objective(f, loss, w)
            last = best[i][0] if i in best else math.inf
            over = False
            if value <= last + 1e-12 * abs(last):
                over = whole[i] and last - value < TOLERANCE * max(1.0, abs(value))
                best[i], whole[i], moving[i] = (value, w), True, _step(f, w, gradient, bend)
            else:
                whole[i], moving[i] = False, (w + best[i][1]) / 2  # too far: half way back
                over = np.abs(moving[i] - best[i][1]).max() < 1e-9 * (1 + np.abs(w).max())
            if over:
                w = best.pop(i)[1]
                stages[i].pop(0)
                moving[i], whole[i] = w, False
                if not stages[i]:
                    done[i] = moving.pop(i)
        if not moving:
            break
    return done | {i: best[i][1] if i in best else w for i, w in moving.items()}


class LinearModel:
    """Weights (the offset last), and the sigmoid that turns margins into probabilities where it has been fitted."""

    def __init__(self, fit: LinearFit, features: list[str], weights: np.ndarray, sigmoid: tuple[float, float] | None = None):
        self.fit, self.features, self.weights, self.sigmoid = fit, list(features), np.asarray(weights), sigmoid
        self._map: Map | None = None

    @property
    def fold(self) -> int:
        return self.fit.fold

    def margins(self, x: np.ndarray) -> np.ndarray:
        self._map = self._map or Map(self.fit.kernel, len(self.features))
        return self._map(x) @ self.weights[:-1] + self.weights[-1]

    def scores(self, x: np.ndarray, view=None) -> np.ndarray:
        """Probabilities, or margins of a hinge model without a sigmoid."""
        m = self.margins(x)
        if self.fit.loss == "logistic":
            return 1 / (1 + np.exp(-m))
        return m if self.sigmoid is None else 1 / (1 + np.exp(-(self.sigmoid[0] * m + self.sigmoid[1])))

    @property
    def probabilities(self) -> bool:
        return self.fit.loss == "logistic" or self.sigmoid is not None

    def score(self) -> Column:
        if self.fit.kernel.kind == "linear":  # plain arithmetic, no Python
            margin = F.lit(float(self.weights[-1]))
            for c, w in zip(self.features, self.weights):
                margin = margin + F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) * F.lit(float(w))
            a, b = (1.0, 0.0) if self.fit.loss == "logistic" else (self.sigmoid or (None, None))
            return margin if a is None else 1.0 / (1.0 + F.exp(-(F.lit(a) * margin + F.lit(b))))
        model = self

        @F.pandas_udf("double")
        def scored(rows: pd.DataFrame) -> pd.Series:
            return pd.Series(model.scores(rows.to_numpy(np.float64)))

        return scored(F.struct(*(F.col(f"`{c}`").cast("double") for c in self.features)))

    def importances(self) -> np.ndarray | None:
        return np.abs(self.weights[:-1]) if self.fit.kernel.kind == "linear" else None

    def save(self, spark: SparkSession, path: str) -> None:
        about = json.dumps({"fit": asdict(self.fit), "features": self.features, "weights": self.weights.tolist(), "sigmoid": self.sigmoid})
        spark.createDataFrame([(about,)], "about string").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearModel:
        about = json.loads(spark.read.parquet(path).first()["about"])
        kernel = Kernel(**about["fit"].pop("kernel"))
        return cls(LinearFit(**about["fit"], kernel=kernel), about["features"], np.array(about["weights"]), about["sigmoid"] and tuple(about["sigmoid"]))


def fit_linear(matrix: Matrix, fits: Sequence[LinearFit]) -> list[LinearModel]:
    """All ``fits``, each on the rows outside its fold."""
    kernels = resolved(matrix, list({f.kernel for f in fits}))
    fits, p, groups = [replace(f, kernel=kernels[f.kernel]) for f in fits], len(matrix.features), matrix.groups
    sizes = {i: p if f.kernel.kind == "linear" else f.kernel.size for i, f in enumerate(fits)}

    def here(parts):
        maps = {f.kernel: Map(f.kernel, p) for f in fits}
        held: dict[int, list[Block]] = {}
        for group, block in parts:
            held.setdefault(group, []).append(block)
        for group, blocks in held.items():
            mine = {i: n for i, n in sizes.items() if i % groups == group}

            def passed(weights):
                out: dict[int, tuple] = {}
                for b in blocks:
                    for i, sums in _sums(fits, maps, weights, b).items():
                        out[i] = _add(out[i], sums) if i in out else sums
                return out

            yield from _minimised(fits, mine, passed).items()

    def passed(weights):
        def partial(parts):
            maps = {fits[i].kernel: Map(fits[i].kernel, p) for i in weights}
            held: dict[int, tuple] = {}
            for group, block in parts:
                own = {i: w for i, w in weights.items() if i % groups == group}
                for i, sums in _sums(fits, maps, own, block).items():
                    held[i] = _add(held[i], sums) if i in held else sums
            yield from held.items()

        return dict(matrix.copies.mapPartitions(partial).reduceByKey(_add, min(len(weights), matrix.parts)).collect())  # features ** 2 numbers a fit

    found = matrix.copies.mapPartitions(here).collectAsMap() if matrix.parts == 1 else _minimised(fits, sizes, passed)
    return [LinearModel(f, matrix.features, found[i]) for i, f in enumerate(fits)]


def fit_sigmoid(margins: DataFrame, score: str = "score", pos: str = "pos", neg: str = "neg", steps: int = 60) -> tuple[float, float]:
    """Slope and offset of Platt's sigmoid for out-of-fold margins (rows: a margin, and how many positives and negatives
    have it): damped Newton steps on a few sums each, with the targets moved off 0 and 1 by one row."""
    m, p, q = (F.col(c).cast("double") for c in (score, pos, neg))
    ones, zeros, spread = margins.agg(F.sum(p), F.sum(q), F.sqrt(F.sum((p + q) * m * m) / F.sum(p + q))).first()
    ones, zeros, unit = ones or 0.0, zeros or 0.0, spread or 1.0
    high, low = (ones + 1) / (ones + 2), 1 / (zeros + 2)
    n, goal, z = p + q, p * F.lit(high) + q * F.lit(low), m / F.lit(float(unit))

    def sums(a: float, b: float) -> list[float]:
        t = F.lit(a) * z + F.lit(b)
        s = 1.0 / (1.0 + F.exp(-t))
        loss = n * (F.greatest(t, F.lit(0.0)) + F.log1p(F.exp(-F.abs(t)))) - goal * t
        w, d = n * s * (1 - s), n * s - goal
        return [float(v or 0.0) for v in margins.agg(F.sum(loss), F.sum(d * z), F.sum(d), F.sum(w * z * z), F.sum(w * z), F.sum(w)).first()]

    now = (0.0, math.log((ones + 1) / (zeros + 1)))
    loss, ga, gb, haa, hab, hbb = sums(*now)
    for _ in range(steps):
        haa, hbb = haa + 1e-10, hbb + 1e-10
        det = haa * hbb - hab * hab
        step, size = ((hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det), 1.0
        while size > 1e-4:
            new = (now[0] - size * step[0], now[1] - size * step[1])
            found = sums(*new)
            if found[0] <= loss:
                break
            size /= 2
        else:
            break
        gain, now, (loss, ga, gb, haa, hab, hbb) = loss - found[0], new, found
        if gain <= 1e-10 * max(1.0, abs(loss)):
            break
    return now[0] / unit, now[1]

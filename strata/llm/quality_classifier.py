"""Quality scores: random Fourier features of document statistics (Rahimi & Recht, "Random Features for Large-Scale
Kernel Machines", 2007), ridge regression by normal equations that are summed per partition, isotonic calibration.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACED_WORDS, byte_table, chunks, executors_import_this, packed_words, staged, text_buffer, word_spans

FEATURES, RIDGE, SEED = 256, 1e-3, 17
#: Bins of the raw score that isotonic regression sees; their number bounds what the driver gets.
BINS = 2000
#: Share of the learning rows that calibrate, in fifths of what is not held out: crc32 mod 5 is 4.
HELD_OUT, CALIBRATE, FOLDS = 0, 4, 5
#: Partitions whose sums meet in one group.
TREE = 256


def _one_of(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


CLASSES = (
    _one_of(bytes(range(ord("a"), ord("z") + 1))), _one_of(bytes(range(ord("A"), ord("Z") + 1))), _one_of(b"0123456789"),
    _one_of(b"#*$%&|<>"), _one_of(b".,;:!?"), _one_of(b"\n"), ~byte_table([(0x80, 0xFF)]),
)
N_STATS = 6 + len(CLASSES) + 8


def _distinct(rows: np.ndarray, codes: np.ndarray, n: int) -> np.ndarray:
    """Distinct codes per row."""
    return np.bincount(np.unique(rows * (int(codes.max(initial=0)) + 1) + codes) // (int(codes.max(initial=0)) + 1), minlength=n) if len(rows) else np.zeros(n)


def _per(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(1, b)


def statistics(texts: pa.Array) -> np.ndarray:
    """Statistics of each whole text, one row each; an empty text has zeros."""
    data, off = text_buffer(texts)
    n, size = len(off) - 1, np.diff(off)
    starts, ends, firsts = word_spans(data, off, SPACED_WORDS)
    n_words, length = np.diff(firsts), (ends - starts).astype(np.float64)
    rows = np.repeat(np.arange(n), n_words)
    sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[firsts])
    codes = packed_words(data, starts, ends, SPACED_WORDS).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    same = np.zeros(len(codes), bool)
    same[1:] = (codes[1:] == codes[:-1]) & (rows[1:] == rows[:-1])
    before = np.zeros(len(codes), np.int64)  # 0 for the first word of a row
    before[1:] = np.where(rows[1:] == rows[:-1], codes[:-1] + 1, 0)
    pairs = before * (int(codes.max(initial=0)) + 1) + codes
    pairs = np.unique(pairs, return_inverse=True)[1] if len(pairs) else pairs
    marked = CLASSES[3][data[starts]] | CLASSES[3][data[ends - 1]] if len(starts) else np.zeros(0, bool)
    lines = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    line_rows = np.repeat(np.arange(n), pc.list_value_length(lines).to_numpy(zero_copy_only=False))
    line_codes = lines.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n_lines = np.bincount(line_rows, minlength=n)
    mean = _per(sums(length), n_words)
    columns = [np.log1p(size), np.log1p(n_words), mean, np.sqrt(np.maximum(0, _per(sums(length ** 2), n_words) - mean ** 2)),
               np.log1p(n_lines), _per(n_lines, n_words)]
    for table in CLASSES:
        total = np.concatenate([[0], np.cumsum(table[data])])
        columns.append(_per(total[off[1:]] - total[off[:-1]], size))
    distinct = _distinct(rows, codes, n)
    columns += [_per(distinct, n_words), distinct / np.maximum(1, np.sqrt(n_words)), _per(sums(same), n_words), _per(_distinct(rows, pairs, n), n_words),
                _per(sums(marked), n_words), _per(sums(length <= 2), n_words), _per(_distinct(line_rows, line_codes, n), n_lines),
                (n_words == 0).astype(float)]
    return np.stack([np.asarray(c, np.float64) for c in columns], 1)


def document_statistics(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, x``: the statistics of every row's text."""
    executors_import_this(docs.sparkSession)

    def computed(batches):
        for batch in batches:
            for part in chunks(batch, "t"):
                x = statistics(part.column(1))
                lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["id", "x"])

    read = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("t"))
    return read.mapInArrow(computed, "id long, x array<double>")


class FourierMap:
    """Standardised statistics to random Fourier features of a Gaussian kernel, and a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, features: int):
        rng = np.random.default_rng(SEED)
        self.mean, self.spread = mean, np.maximum(spread, 1e-6)
        self.w = rng.standard_normal((len(mean), features)) / np.sqrt(len(mean)) * 1.5
        self.b = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -5, 5)
        waves = np.sqrt(2 / len(self.b)) * np.cos(z @ self.w + self.b)
        return np.concatenate([waves, np.ones((len(x), 1))], 1)


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATS)


def _normal_equations(rows: DataFrame, fourier: FourierMap) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y: each partition sums its own, row by row of the matrix; one row's sums meet ``TREE`` partitions at a
    time, and then theirs."""
    width = len(fourier.b) + 1

    def partition(batches):
        total = np.zeros((width, width + 1))
        for batch in batches:
            z = fourier(_matrix(batch.column(0)))
            total += z.T @ np.concatenate([z, batch.column(1).to_numpy(zero_copy_only=False)[:, None]], 1)
        branch = TaskContext.get().partitionId() // TREE
        yield pa.RecordBatch.from_arrays([pa.array(range(width)), pa.array([branch] * width), pa.array([r.tobytes() for r in total])],
                                         names=["i", "branch", "sums"])

    def summed(key, group):
        return pd.DataFrame({"i": [key[0]], "sums": [np.sum([np.frombuffer(s) for s in group["sums"]], axis=0).tobytes()]})

    parts = rows.select("x", "y").mapInArrow(partition, "i long, branch long, sums binary")
    for keys in (["i", "branch"], ["i"]):
        parts = parts.groupBy(*keys).applyInPandas(summed, "i long, sums binary")
    sums = {r.i: np.frombuffer(r.sums) for r in parts.collect()}  # a row per feature
    both = np.stack([sums.get(i, np.zeros(width + 1)) for i in range(width)])
    return both[:, :-1], both[:, -1]


def fold(id: Column) -> Column:
    return F.pmod(F.crc32(id.cast("string").cast("binary")), F.lit(FOLDS))


def score_quality(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "quality",
                  features: int = FEATURES) -> DataFrame:
    """``id``, ``held_out`` and ``score`` (0 to 1, the calibrated chance of label 1) of every row.

    Learns from labelled rows whose ``crc32(id) mod 5`` isn't 0: 4 calibrates, the others fit the ridge. Null labels and
    ids teach nothing; rows that repeat an id or a label count each. A null text is empty. Without any learning row all
    scores are 0.5, without a calibrating one the ridge's are clipped. A null id isn't held out. An empty table gives no
    rows. To the driver come the sums of ``features`` squared numbers and ``BINS`` bins.
    """
    stats = staged(document_statistics(docs, id=id, text=text), "statistics")
    known = labels.where(F.col(label).isNotNull()).select(F.col(id).cast("long").alias("id"), F.col(label).cast("double").alias("y"))
    learn = staged(stats.join(known.where(fold(F.col("id")) != HELD_OUT), "id"), "learning")
    fit, calibrate = learn.where(fold(F.col("id")) != CALIBRATE), learn.where(fold(F.col("id")) == CALIBRATE)
    moments = fit.select(*(F.get("x", F.lit(i)).alias(f"x{i}") for i in range(N_STATS))).agg(
        F.count("*"), *(F.avg(f"x{i}") for i in range(N_STATS)), *(F.stddev_pop(f"x{i}") for i in range(N_STATS))).first()
    if not moments[0]:
        return stats.select(F.col("id").alias(id), F.coalesce(fold(F.col("id")) == HELD_OUT, F.lit(False)).alias("held_out"), F.lit(0.5).alias("score"))
    fourier = FourierMap(np.array(moments[1:1 + N_STATS]), np.array(moments[1 + N_STATS:]), features)
    squares, products = _normal_equations(fit, fourier)
    weights = np.linalg.solve(squares + RIDGE * max(1, moments[0]) * np.eye(len(products)) / features, products)

    def scored(knots, beside="id"):
        def score(batches):
            for batch in batches:
                raw = fourier(_matrix(batch.column(1))) @ weights
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.clip(np.interp(raw, *knots), 0, 1) if knots else raw)],
                                                 names=[beside, "score"])

        return score

    raw = calibrate.select("y", "x").mapInArrow(scored(None, "y"), "y double, score double")
    bins = raw.groupBy((F.floor(F.least(F.greatest(F.col("score"), F.lit(-0.5)), F.lit(1.5)) * BINS / 2) * 2 / BINS).alias("bin")).agg(
        F.avg("y").alias("y"), F.count("*").cast("double").alias("weight"))
    bins = staged(bins, "bins")
    knots = ([0.0, 1.0], [0.0, 1.0])
    if bins.count():
        model = IsotonicRegression(featuresCol="bin", labelCol="y", weightCol="weight").fit(bins)
        knots = (model.boundaries.toArray(), model.predictions.toArray())
    return stats.mapInArrow(scored(knots), "id long, score double").select(
        F.col("id").alias(id), F.coalesce(fold(F.col("id")) == HELD_OUT, F.lit(False)).alias("held_out"), "score")

"""Language identification by nearest centroid: hashed character n-grams weighted by TF-IDF, a few spherical k-means
centroids per language, cosine similarity, and rejection of texts that lie too far from the nearest centroid.

Digits, signs and white space all count as one word boundary, and n-grams without a letter are left out, so texts that
are alike by their signs only are not alike.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import chunks, executors_import_this, staged, text_buffer

BUCKETS, CENTROIDS, ROUNDS, SEED = 4096, 3, 12, 23
#: Learning texts per language whose vectors are clustered (a sample by hash of the id; expected number).
SAMPLE = 1500
#: Languages whose centroids are sent to the tasks together.
BLOCK_LANGUAGES = 500
#: Standard deviations below a centroid's mean similarity at which a text is rejected.
REJECT = 4.0
UNKNOWN = "und"
HELD_OUT, FOLDS = 2, 4
#: Bytes and rows of text that are counted at once: a row has ``BUCKETS`` counts.
COUNT_BYTES, COUNT_ROWS = 2 << 20, 512


LETTER = np.zeros(256, bool)
LETTER[ord("a"):ord("z") + 1] = True
LETTER[128:] = True
BOUNDED = np.where(LETTER, np.arange(256), 0x20).astype(np.uint8)


def ngram_counts(texts: pa.Array) -> np.ndarray:
    """Hashed counts of the byte pairs and triples of each lower-cased text that hold a letter; what is no letter is a blank."""
    raw, off = text_buffer(pc.utf8_lower(pc.fill_null(texts, "")))
    n = len(off) - 1
    counts = np.zeros(n * BUCKETS, np.int64)
    letter = LETTER[raw]
    wide, rows = BOUNDED[raw].astype(np.uint32), np.repeat(np.arange(n), np.diff(off))
    for size in (2, 3):
        if len(wide) < size:
            continue
        last = len(wide) - size + 1
        gram, known = wide[:last].copy(), letter[:last].copy()
        for k in range(1, size):
            gram = gram * np.uint32(257) + wide[k:last + k]
            known |= letter[k:last + k]
        inside = (rows[:last] == rows[size - 1:]) & known
        bucket = (gram * np.uint32(2654435761) >> np.uint32(20)).astype(np.int64)
        counts += np.bincount((rows[:last] * BUCKETS + bucket)[inside], minlength=n * BUCKETS)
    return counts.reshape(n, BUCKETS)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    return (v / np.maximum(1e-12, np.linalg.norm(v, axis=1))[:, None]).astype(np.float32)


def _clustered(vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: centroids, and for each the similarity below which a text is rejected. The first centres are
    drawn apart from each other (k-means++)."""
    rng = np.random.default_rng(SEED)
    centres = vectors[rng.integers(len(vectors))][None]
    while len(centres) < min(k, len(vectors)):
        far = np.clip(1 - (vectors @ centres.T).max(1), 0, None).astype(np.float64) ** 2
        if far.sum() <= 1e-12:
            break
        centres = np.concatenate([centres, vectors[rng.choice(len(vectors), p=far / far.sum())][None]])
    for _ in range(ROUNDS):
        own = (vectors @ centres.T).argmax(1)
        sums = np.stack([vectors[own == c].sum(0) if (own == c).any() else centres[c] for c in range(len(centres))])
        centres = sums / np.maximum(1e-12, np.linalg.norm(sums, axis=1))[:, None]
    near = vectors @ centres.T
    own = near.argmax(1)
    limits = [(lambda x: float(x.mean() - REJECT * x.std()) if len(x) else 0.0)(near[own == c, c]) for c in range(len(centres))]
    return centres.astype(np.float32), np.array(limits)


def fold(id: Column) -> Column:
    return F.pmod(F.crc32(id.cast("string").cast("binary")), F.lit(FOLDS))


def _counted_corpus(learn: DataFrame) -> DataFrame:
    """Per task one row with its documents' number and frequencies of the buckets; and the counts of sampled texts."""
    def counted(batches):
        seen, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for part in chunks(batch, "t", COUNT_BYTES, COUNT_ROWS):
                counts = ngram_counts(part.column(0))
                seen, n = seen + (counts > 0).sum(0), n + len(counts)
                pick = np.flatnonzero(part.column(2).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([part.column(1).take(pa.array(pick)), pa.array([counts[i].astype(np.int32).tobytes() for i in pick], pa.binary()),
                                                  pa.array([None] * len(pick), pa.int64())], names=["lang", "counts", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([seen.tobytes()]), pa.array([n])], names=["lang", "counts", "n"])

    return learn.select("t", "lang", "pick").mapInArrow(counted, "lang string, counts binary, n long")


def fit_centroids(docs: DataFrame, *, text: str = "text", lang: str = "lang", order: str = "doc_id") -> list[dict] | None:
    """IDF over all rows of ``docs`` that have a language and a letter; centroids of a sample per language (by hash of id
    and text). The model is a list of blocks of at most ``BLOCK_LANGUAGES`` languages, with ``BUCKETS`` numbers per
    centroid, in the languages' order; there may be any number of languages. None without learning texts."""
    executors_import_this(docs.sparkSession)
    learn = docs.select(F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("lang"), F.col(order).alias("o")).where(
        F.col("lang").isNotNull() & F.col("t").rlike(r"\p{L}"))
    rates = staged(learn.groupBy("lang").agg((F.lit(float(SAMPLE)) / F.count("*")).alias("rate")), "language_sizes")
    learn = learn.join(rates, "lang")
    rate = F.least(F.col("rate"), F.lit(1.0))
    by_chance = F.pmod(F.xxhash64("o", "t"), F.lit(1 << 20)) < rate * (1 << 20)
    found = staged(_counted_corpus(learn.withColumn("pick", by_chance)), "language_counts")
    totals = found.where("n IS NOT NULL")

    def summed(key, group):
        return pd.DataFrame({"g": [key[0]], "counts": [np.sum([np.frombuffer(x, np.int64) for x in group["counts"]], axis=0).tobytes()], "n": [group["n"].sum()]})

    few = totals.withColumn("g", F.pmod(F.xxhash64("counts"), F.lit(64))).groupBy("g").applyInPandas(summed, "g long, counts binary, n long").collect()
    n = sum(r.n for r in few)
    idf = np.log((1 + n) / (1 + np.sum([np.frombuffer(r.counts, np.int64) for r in few], axis=0))) + 0.1

    def clustered(key, group):
        centres, limits = _clustered(_weighted(np.stack([np.frombuffer(x, np.int32) for x in group["counts"]]), idf), CENTROIDS)
        return pd.DataFrame({"lang": key[0], "centre": [c.tobytes() for c in centres], "low": limits})

    rows = staged(found.where("n IS NULL").groupBy("lang").applyInPandas(clustered, "lang string, centre binary, low double"), "centroids")
    langs = [r.lang for r in rows.select("lang").distinct().orderBy("lang").collect()]
    blocks = []
    for at in range(0, len(langs), BLOCK_LANGUAGES):
        own = rows.where(F.col("lang").between(langs[at], langs[min(at + BLOCK_LANGUAGES, len(langs)) - 1])).orderBy("lang", "centre").collect()
        blocks.append({"idf": idf, "langs": [r.lang for r in own], "centres": np.stack([np.frombuffer(r.centre, np.float32) for r in own]),
                       "low": np.array([r.low for r in own])})
    return blocks or None


def identify(docs: DataFrame, model: list[dict] | None, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default: all) of every row with ``nearest`` (the language of the nearest centroid), ``score`` (its cosine, 0 to 1),
    ``rejected`` (further than usual) and ``lang_pred`` (``nearest``; ``und`` if rejected).

    Null texts, texts without a letter, and all texts if there is no model, are ``und`` with score 0 in all columns and
    rejected. Equal similarities go to the language that sorts first. Repeated rows and null ids are rows like others. An
    input column with the name of a result column is left out. A text is read whole, however long. An empty table gives
    no rows. Each block of the model is a step of its own, and holds no other block.
    """
    spark = docs.sparkSession
    executors_import_this(spark)
    added = {"nearest": "string", "score": "double", "rejected": "boolean"}
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (*added, "lang_pred")]
    row = F.struct(*(F.col(f"`{c}`") for c in keep), F.lit(0).alias("__none"))
    found = docs.select(row.alias("__row"), F.col(text).cast("string").alias("__text"), F.lit(UNKNOWN).alias("nearest"),
                        F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))

    def nearer(block):
        sent = spark.sparkContext.broadcast(block)

        def named(batches):
            m = sent.value
            for batch in batches:
                for part in chunks(batch, "__text", COUNT_BYTES, COUNT_ROWS):
                    texts = part.column(1)
                    nearest, score, far = (part.column(i).to_numpy(zero_copy_only=False).copy() for i in (2, 3, 4))
                    at = np.flatnonzero(pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False))
                    if len(at):
                        near = _weighted(ngram_counts(texts.take(pa.array(at))), m["idf"]) @ m["centres"].T
                        best = near.argmax(1)
                        cosine = np.clip(near[np.arange(len(at)), best], 0, 1)
                        better = (cosine > score[at]) | (nearest[at] == UNKNOWN)
                        at, best, cosine = at[better], best[better], cosine[better]
                        score[at], nearest[at], far[at] = cosine, np.array(m["langs"], object)[best], cosine < m["low"][best]
                    yield pa.RecordBatch.from_arrays([part.column(0), texts, pa.array(nearest, pa.string()), pa.array(score), pa.array(far)], names=names)

        return named

    names = found.columns
    for block in model or ():
        found = found.mapInArrow(nearer(block), found.schema)
    return found.select(*(F.col(f"__row.`{c}`") for c in keep), *added, F.when(F.col("rejected"), UNKNOWN).otherwise(F.col("nearest")).alias("lang_pred"))

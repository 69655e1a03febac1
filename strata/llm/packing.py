"""Packing along a space-filling curve: hashed token vectors of the documents are projected to a few dimensions,
range-sorted by Hilbert key, and cut into sequences where they lie, so neighbours on the curve share sequences.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import LOWER, SPACED_WORDS, chunks, executors_import_this, staged, text_buffer, word_spans
from strata.llm.hilbert import hilbert_keys

SEQUENCE = 4096
END_ID = 2
#: Hashed vectors, their projection and the bits of each axis of the curve.
BUCKETS, AXES, BITS, SEED = 512, 4, 12, 11
#: Bytes of the words whose ids a worker keeps (with WORD_COST for each word's entry), and bytes that it handles at once.
CACHE_BYTES, WORD_COST, ENCODE_BYTES = 88 << 20, 140, 2 << 20

LETTER = np.zeros(256, bool)
LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
POINT = np.zeros(256, bool)
POINT[list(b".,;:!?")] = True


class WordTokens:
    """Ids of word pieces by a tokenizer that drops white space and folds ASCII case (``word_bpe_49k.json``).

    Such a tokenizer handles the text between white space alone, and a letter followed by ``.,;:!?`` always ends a
    token; so each distinct piece is encoded once and kept.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ids, self.starts, self.used, self.held = np.zeros(1 << 16, np.uint16), np.zeros(1 << 14, np.int64), 0, 0

    def _learn(self, words: list[bytes]) -> None:
        plain = [w.isalpha() and w.isascii() and w.islower() for w in words]
        others = self.tokenizer.encode_batch_fast([w.decode() for w, p in zip(words, plain) if not p], add_special_tokens=False)
        rest, model = iter(others), self.tokenizer.model
        ids = [[t.id for t in model.tokenize(w.decode())] if p else next(rest).ids for w, p in zip(words, plain)]
        n, at = len(self.number), self.used
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        total = int(lengths.sum())
        while len(self.starts) < n + len(words) + 1:
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        while len(self.ids) < at + total:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[at:at + total] = np.fromiter((x for w in ids for x in w), np.uint16, total)
        self.starts[n + 1:n + 1 + len(words)] = at + np.cumsum(lengths)
        self.used = at + total
        self.held += sum(map(len, words)) + WORD_COST * len(words)
        self.number.update(zip(words, range(n, n + len(words))))

    def encode(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all rows in one array, and how many each row has."""
        rows = len(off) - 1
        data = raw if b"<|" in raw.tobytes() else LOWER[raw]  # special tokens are matched before case is folded
        starts, ends, firsts = word_spans(data, off, SPACED_WORDS, np.flatnonzero(POINT[data[1:]] & LETTER[data[:-1]]) + 1)
        bounds = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=bounds[1:])
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[SPACED_WORDS[data]])])
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if self.held > CACHE_BYTES:
            self.clear()
        number = self.number
        if new := [w for w in distinct if w not in number]:
            self._learn(new)
        entry = np.fromiter((number[w] for w in distinct), np.int64, len(distinct))
        entry = entry[coded.indices.to_numpy(zero_copy_only=False)]
        begin = self.starts[entry]
        length = self.starts[entry + 1] - begin
        until = np.cumsum(length)
        ids = self.ids[np.arange(int(until[-1]) if len(until) else 0) + np.repeat(begin - (until - length), length)]
        total = np.concatenate([[0], until])[firsts]
        return ids, np.diff(total) if rows else np.zeros(0, np.int64)


_WORKERS: dict[str, WordTokens] = {}


def _worker(path: str) -> WordTokens:
    if path not in _WORKERS:
        _WORKERS[path] = WordTokens(path)
    return _WORKERS[path]


def curve_keys(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hilbert key per row: unit vectors of hashed token counts, projected by a fixed Gaussian matrix."""
    n = len(counts)
    bucket = (ids.astype(np.int64) * 0x9E3779B1 >> 12) % BUCKETS
    vectors = np.bincount(np.repeat(np.arange(n), counts) * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS)
    vectors = vectors / np.maximum(1e-9, np.sqrt((vectors.astype(np.float64) ** 2).sum(1)))[:, None]
    axes = np.random.default_rng(SEED).standard_normal((BUCKETS, AXES))
    points = np.clip((vectors @ axes + 4) / 8, 0, 1) * ((1 << BITS) - 1)
    return hilbert_keys(points.astype(np.int64), BITS)


def tokenized(docs: DataFrame, tokenizer: str, *, id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """``id``, ``ids`` (binary, unsigned 16 bits each, the end id last), ``n`` and ``key`` per row; null texts are empty."""
    executors_import_this(docs.sparkSession)

    def encoded(batches):
        worker = _worker(tokenizer)
        for batch in batches:
            for part in chunks(batch, "t", ENCODE_BYTES):
                ids, counts = worker.encode(*text_buffer(part.column(1)))
                bounds = np.concatenate([[0], np.cumsum(counts + 1)])
                whole = np.full(int(bounds[-1]), end_id, np.uint16)
                inner = np.ones(len(whole), bool)
                inner[bounds[1:] - 1] = False
                whole[inner] = ids
                binary = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(2 * bounds), pa.py_buffer(whole)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), binary.cast(pa.binary()), pa.array(counts + 1), pa.array(curve_keys(ids, counts))],
                    names=["id", "ids", "n", "key"])

    schema = T.StructType([T.StructField("id", docs.schema[id].dataType), T.StructField("ids", T.BinaryType()),
                           T.StructField("n", T.LongType()), T.StructField("key", T.LongType())])
    return docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("t")).mapInArrow(encoded, schema)


def _positions(tokens: DataFrame) -> tuple[DataFrame, int]:
    """``row`` and its first position on the curve; all positions' number. Totals are summed per range of the curve."""
    ranges = staged(tokens.select("key", "id", "row", "n").repartitionByRange("key", "id", "row")
                    .select("*", F.spark_partition_id().alias("range")), "curve")
    totals = ranges.groupBy("range").agg(F.sum("n").alias("all"))  # a row per range
    before = totals.select("range", (F.sum("all").over(Window.orderBy("range")) - F.col("all")).alias("before"))
    along = Window.partitionBy("range").orderBy("key", "id", "row").rowsBetween(Window.unboundedPreceding, 0)
    placed = ranges.withColumn("own", F.sum("n").over(along) - F.col("n")).join(before, "range")
    return placed.select("row", (F.col("before") + F.col("own")).alias("position")), totals.agg(F.sum("all")).first()[0] or 0


def pack(docs: DataFrame, tokenizer: str, *, id: str = "doc_id", text: str = "text", sequence: int = SEQUENCE,
         end_id: int = END_ID) -> DataFrame:
    """One row per piece: the document's id (column ``id``), ``start`` (its ids before the piece), ``length``, ``ids``
    (binary, little-endian unsigned 32 bits each), ``doc_tokens``, ``sequence_id`` and ``offset`` in the sequence.

    The ids of all rows, each closed by ``end_id``, follow one another along the curve and are cut every ``sequence``
    ids; what remains at the end is cut into sequences of a power of two each, so nothing is padded. Rows with equal
    keys go by id, then as read. Null and empty texts are a single end id; null ids and repeated ids are packed like
    others. An empty table gives no rows. The tokenizer's ids must fit 16 bits.
    """
    tokens = staged(tokenized(docs, tokenizer, id=id, text=text, end_id=end_id)
                    .withColumn("row", F.monotonically_increasing_id()), "tokens")
    placed, total = _positions(tokens)
    rest = total % sequence
    tail = sorted(total - rest + (rest >> b << b) for b in range(rest.bit_length()) if rest >> b & 1)  # ends of its sequences

    def cut(batches):
        for batch in batches:
            for part in chunks(batch, "ids", ENCODE_BYTES):
                own, start, length, sent, n_tokens, number, offset = [], [], [], [], [], [], []
                raw, bounds = text_buffer(part.column(1))
                wide = raw.view(np.uint16).astype("<u4")
                for row, (n, position) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist())):
                    cuts = [*range(position // sequence * sequence, min(position + n, total - rest + 1), sequence)]
                    cuts = sorted({position, position + n, *(x for x in [*cuts, *tail, total - rest] if position < x < position + n)})
                    for a, b in zip(cuts, cuts[1:]):
                        late = [x for x in tail if x <= a]
                        own.append(row)
                        start.append(a - position)
                        length.append(b - a)
                        sent.append(4 * (bounds[row] // 2 + b - position))
                        n_tokens.append(n)
                        number.append(min(a, total - rest) // sequence + len(late))
                        offset.append(a - max([a // sequence * sequence if a < total - rest else total - rest, *late]))
                ids = pa.Array.from_buffers(pa.large_binary(), len(sent), [None, pa.py_buffer(np.array([0, *sent], np.int64)), pa.py_buffer(wide)])
                numbers = [pa.array(x, pa.int64()) for x in (n_tokens, number, offset)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(own, pa.int64())), pa.array(start, pa.int64()),
                                                  pa.array(length, pa.int64()), ids.cast(pa.binary()), *numbers], names=schema.names)

    joined = tokens.join(placed, "row").select(F.col("id"), "ids", "n", "position")
    long = T.LongType()
    schema = T.StructType([T.StructField(id, docs.schema[id].dataType), T.StructField("start", long), T.StructField("length", long),
                           T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", long),
                           T.StructField("sequence_id", long), T.StructField("offset", long)])
    return joined.mapInArrow(cut, schema)

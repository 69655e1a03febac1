"""Benchmark decontamination: every shard of the corpus gets an FM-index in which the benchmark's phrases are
searched backwards; the located occurrences are merged into removal spans.

A task indexes the documents that it reads, shard by shard, so nothing is shuffled and a lost task is read
again alone.  Words that no phrase holds end a run: a phrase can only lie within a run of known words, and runs
shorter than the shortest phrase are left out of the index.  This changes no result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import ALNUM_WORDS, LOWER, chunks, executors_import_this, packed_words, released, staged, text_buffer, word_spans
from strata.llm.fm_index import FMIndex

#: Words of a window.
WINDOW = 13
#: A block of the query set holds at most so many bytes of item texts (one item may be longer).
BLOCK_BYTES = 32 << 20
#: Bytes of text that one index covers (one document may be longer).
SHARD_BYTES = 4 << 20
#: Percent of a document's words that must be hit.
CONTAMINATED_PERCENT = 5

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("contaminated", T.BooleanType())])


def words_of(text: str | None) -> list[bytes]:
    data, off = text_buffer(pa.array([text or ""]))
    data = LOWER[data]
    starts, ends, _ = word_spans(data, off, ALNUM_WORDS)
    return packed_words(data, starts, ends, ALNUM_WORDS).to_pylist()


class Phrases:
    """The windows of a block of items: their vocabulary, their symbols and the items that hold them."""

    def __init__(self, items: list[tuple], window: int):
        owners: dict[tuple, set] = {}
        for item, text in items:
            words = words_of(text)
            for i in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(tuple(words[i:i + window]), set()).add(str(item))
        self.vocabulary = sorted({w for phrase in owners for w in phrase})
        number = {w: i + 1 for i, w in enumerate(self.vocabulary)}
        self.symbols = np.zeros((len(owners), window), np.int64)
        for i, phrase in enumerate(owners):
            self.symbols[i, window - len(phrase):] = [number[w] for w in phrase]
        self.lengths = np.array([len(x) for x in owners], np.int64)
        self.owners = [sorted(x) for x in owners.values()]


def occurrences(numbers: np.ndarray, rows: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(word index, phrase) of every occurrence in a shard. ``numbers``: its words' symbols, 0 if unknown;
    ``rows``: the document of each word."""
    known = numbers > 0
    begins = known.copy()
    begins[1:] &= ~known[:-1] | (rows[1:] != rows[:-1])
    ends = known.copy()
    ends[:-1] &= ~known[1:] | (rows[1:] != rows[:-1])
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    long = last - first >= phrases.lengths.min()
    first, last = first[long], last[long]
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = last - first + 1  # with the end of the run
    base = np.cumsum(size) - size
    word = np.arange(size.sum()) - np.repeat(base - first, size)
    seq = np.zeros(len(word), np.int64)
    body = np.ones(len(word), bool)
    body[base + size - 1] = False
    seq[body] = numbers[word[body]]
    index = FMIndex(seq, len(phrases.vocabulary))
    low, high = index.search(phrases.symbols)
    found = np.repeat(np.arange(len(low)), high - low)
    count = (high - low)[high > low]
    at = np.arange(len(found)) - np.repeat(np.cumsum(count) - count, count) + low[found]
    return word[index.locate(at)], found


def _hits(words: pa.Array, rows: np.ndarray, phrases: Phrases, items: list[set]) -> np.ndarray:
    """Which words lie inside an occurrence of a block's phrase; the phrases' items are added to their row's."""
    total = len(words)
    change = np.zeros(total + 1, np.int64)
    if len(phrases.lengths) and total:
        numbers = pc.index_in(words, value_set=pa.array(phrases.vocabulary, pa.large_binary()))
        numbers = pc.add(pc.fill_null(numbers, -1), 1).to_numpy(zero_copy_only=False).astype(np.int64)
        at, phrase = occurrences(numbers, rows, phrases)
        np.add.at(change, at, 1)
        np.add.at(change, at + phrases.lengths[phrase], -1)
        for row, p in np.unique(np.stack([rows[at], phrase], 1), axis=0).tolist() if len(at) else ():
            items[row].update(phrases.owners[p])
    return np.cumsum(change)[:total] > 0


def _judged(n_words: np.ndarray, rows: np.ndarray, hit: np.ndarray, items: list[set], raw, off, starts, ends) -> list[pa.Array]:
    n = len(n_words)
    hits = np.bincount(rows[hit], minlength=n)
    spans: list[list] = [[] for _ in range(n)]
    at = np.flatnonzero(hit)
    if len(at):
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | (np.diff(rows[at]) > 0)
        opens = np.flatnonzero(new)
        closes = np.append(opens[1:], len(at)) - 1
        for row in np.unique(rows[at]).tolist():
            mine = slice(*np.searchsorted(rows[at[opens]], [row, row + 1]).tolist())
            chars = np.concatenate([[0], np.cumsum((raw[off[row]:off[row + 1]] & 0xC0) != 0x80)])
            begin, end = starts[at[opens[mine]]] - off[row], ends[at[closes[mine]]] - off[row]
            spans[row] = [{"start": a, "end": b} for a, b in zip(chars[begin].tolist(), chars[end].tolist())]
    contaminated = (hits > 0) & (100 * hits >= CONTAMINATED_PERCENT * n_words)
    return [pa.array(n_words, pa.int64()), pa.array(hits, pa.int64()),
            pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(contaminated)]


def _shard(part: pa.RecordBatch, phrases: Phrases, last: bool) -> list[pa.Array]:
    """Of a shard's rows (own, text, hit, items) what one block adds: the words hit so far (a bit each) and the items, or,
    with the last block, the result."""
    raw, off = text_buffer(part.column(1))
    data = LOWER[raw]
    starts, ends, firsts = word_spans(data, off, ALNUM_WORDS)
    n_words = np.diff(firsts)
    rows = np.repeat(np.arange(part.num_rows), n_words)
    items = [set(x or ()) for x in part.column(3).to_pylist()]
    hit = _hits(packed_words(data, starts, ends, ALNUM_WORDS), rows, phrases, items)
    for row, bits in enumerate(part.column(2).to_pylist()):
        if bits:
            hit[firsts[row]:firsts[row + 1]] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=int(n_words[row])).astype(bool)
    if last:
        return _judged(n_words, rows, hit, items, raw, off, starts, ends)
    some = np.bincount(rows[hit], minlength=part.num_rows) > 0
    bits = [np.packbits(hit[firsts[i]:firsts[i + 1]]).tobytes() if some[i] else None for i in range(part.num_rows)]
    return [pa.array(bits, pa.binary()), pa.array([sorted(x) for x in items], pa.list_(pa.string()))]


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id",
                  item_text: str = "text", keep: list[str] | None = None, window: int = WINDOW,
                  shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per row of ``docs``: its ``keep`` columns (default: all) and ``n_words``, ``n_hit`` (words inside an
    occurrence of a benchmark window), ``items`` (sorted ids, as strings, of the items with occurring windows),
    ``spans`` (merged removal spans, code points) and ``contaminated`` (any hit, and at least 5 % of the words).

    Null texts have no words; items without words have no window; a shorter item is one window. An input column
    with the name of a result column is left out. Repeated rows and null ids give a row each. Texts are searched whole,
    however long. An empty table gives no rows; an empty benchmark hits nothing.

    The benchmark is the query set: Spark deals its items to blocks of about ``BLOCK_BYTES``, and each block is searched in
    all shards by a pass of its own, so the driver and a task hold one block at most, whatever their number. What the
    passes have found is carried with the texts, in a table between two passes.
    """
    spark = docs.sparkSession
    executors_import_this(spark)
    queries = benchmark.select(F.col(f"`{item}`").alias("item"), F.col(f"`{item_text}`").cast("string").alias("text"))
    size = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-4 * size // BLOCK_BYTES))  # a block's phrases take about four times its text
    added = RESULT.names
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    carried = text if text in keep and isinstance(docs.schema[text].dataType, T.StringType) else None  # once
    own = F.struct(*(F.col(f"`{c}`") for c in keep if c != carried), F.lit(0).alias("__none"))
    rows = docs.select(own.alias("own"), F.col(f"`{text}`").cast("string").alias("text"), F.lit(None).cast("binary").alias("hit"),
                       F.array().cast("array<string>").alias("items"))
    between = rows.schema
    whole = T.StructType([between["own"], *([between["text"]] if carried else []), *RESULT])

    def search(sent, last):
        names = whole.names if last else between.names

        def shards(batches):
            for batch in batches:
                for part in chunks(batch, "text", shard_bytes):
                    kept = [part.column(0), part.column(1)] if carried or not last else [part.column(0)]
                    yield pa.RecordBatch.from_arrays([*kept, *_shard(part, sent.value, last)], names=names)

        return shards

    for block in range(blocks):
        dealt = queries.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        sent = spark.sparkContext.broadcast(Phrases([(r.item, r.text) for r in dealt.collect()], window))  # one block
        last = block == blocks - 1
        found = rows.mapInArrow(search(sent, last), whole if last else between)
        if last:
            return found.select(*(F.col("text").alias(c) if c == carried else F.col(f"own.`{c}`") for c in keep), *added)
        found = staged(found, "decontaminated")
        sent.unpersist()
        if block:
            released(rows)
        rows = found


def items_digest(items) -> F.Column:
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)

"""SimHash near-duplicates: fingerprints of word shingles, linked by a binary-trie self-join.

The trie is walked a few bits at a time and node pairs go down together: a pair (a, b) at one level becomes the
pairs of their children, the bits in which they differ are added up, and pairs beyond the error budget are pruned.
Pairs that differ by at most k bits differ by at most k // 2 in the first half of the bits, or by fewer than
k - k // 2 in the second; so two tries, one with the halves swapped, need half the budget in their upper levels,
where a trie over many fingerprints prunes little otherwise. Node pairs are rows of a DataFrame, each level two
equi-joins and a table in the shared folder: the driver plans and follows one level at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import LOWER, SPACED_WORDS, chunks, executors_import_this, released, staged, text_buffer, word_spans
from strata.llm.components import components
from strata.session import scratch_path

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Hashes whose bits are counted at once.
HASH_BLOCK = 1 << 17
#: Trie levels (bits from the root): by error masks down to the half, by children below it.
UPPER, LOWER_LEVELS = (16, 24, 32), (40, 48, 56, 64)


def _shingle_hashes(data: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle, and the row of each."""
    starts, ends, firsts = word_spans(data, off, SPACED_WORDS)
    n = np.diff(firsts)
    rows = np.repeat(np.arange(len(n)), n)
    length = ends - starts
    begin = np.cumsum(length + 1) - (length + 1)
    joined = np.full(int((length + 1).sum()), 0x20, np.uint8)
    room = np.ones(len(joined), bool)
    room[begin + length] = False
    joined[room] = data[SPACED_WORDS[data]]
    at, stop = np.arange(len(rows)), firsts[1:][rows]
    whole = (stop - at >= size) | (at == firsts[:-1][rows])
    last = np.minimum(at + size, stop)[whole] - 1
    text, digest = memoryview(joined), xxhash.xxh64_intdigest
    spans = zip(begin[whole].tolist(), (begin + length)[last].tolist())
    return np.fromiter((digest(text[i:j], SEED) for i, j in spans), np.uint64, int(whole.sum())), rows[whole]


def _fingerprints(data: np.ndarray, off: np.ndarray, size: int) -> np.ndarray:
    hashes, rows = _shingle_hashes(LOWER[data], off, size)
    n = len(off) - 1
    counts = np.zeros((n, 64), np.int64)
    for i in range(0, len(hashes), HASH_BLOCK):
        part = hashes[i:i + HASH_BLOCK]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own, first = np.unique(rows[i:i + HASH_BLOCK], return_index=True)
        counts[own] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    over = 2 * counts > np.bincount(rows, minlength=n)[:, None]
    return np.packbits(over, axis=1, bitorder="little").view("<i8")[:, 0]


def fingerprints(docs: DataFrame, *, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS,
                 keep: Sequence[Column] = ()) -> DataFrame:
    """``id``, the ``keep`` columns and ``fp`` (long, the 64 bits) per row; null and wordless texts have fingerprint 0."""
    executors_import_this(docs.sparkSession)

    def hashed(batches):
        for batch in batches:
            for part in chunks(batch, "t"):
                prints = pa.array(_fingerprints(*text_buffer(part.column(0)), shingle))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], prints], names=names)

    read = docs.select(F.col(f"`{text}`").cast("string").alias("t"), F.col(f"`{id}`").alias("id"), *keep)
    schema = T.StructType([*read.schema.fields[1:], T.StructField("fp", T.LongType())])
    names = schema.names
    return read.mapInArrow(hashed, schema)


def _masks(bits: int, most: int) -> Column:
    """All error masks of up to ``most`` of ``bits`` bits, with their weight."""
    masks = [(sum(1 << i for i in at), n) for n in range(most + 1) for at in combinations(range(bits), n)]
    return F.array(*(F.struct(F.lit(m).cast("long").alias("mask"), F.lit(n).alias("cost")) for m, n in masks))


def _trie(leaves: DataFrame) -> DataFrame:
    """``t, node, leaves, level``: all nodes of the tries with the number of leaves below them, counted in one aggregate and
    stored by level, so each of a level's joins reads a small table and counts nothing again."""
    levels = F.array(*(F.struct(F.lit(n).alias("level"), F.shiftrightunsigned("leaf", 64 - n).alias("node")) for n in (*UPPER, *LOWER_LEVELS)))
    nodes = leaves.select("t", F.inline(levels)).groupBy("t", "node", "level").agg(F.count("*").alias("leaves"))
    path = scratch_path(nodes.sparkSession, "trie")
    nodes = nodes.select("t", "node", "leaves", "level")
    nodes.write.partitionBy("level").parquet(path)
    return nodes.sparkSession.read.schema(nodes.schema).parquet(path)


def trie_links(prints: DataFrame, max_bits: int = MAX_BITS, fp: str = "fp") -> DataFrame:
    """``a, b`` for all pairs of distinct fingerprints that differ in at most ``max_bits`` bits, each pair once."""
    budget = {1: max_bits // 2, 2: max_bits - max_bits // 2 - 1}
    v = F.col(fp)
    swapped = F.shiftleft(v, 32).bitwiseOR(F.shiftrightunsigned(v, 32))
    tries = F.array(F.struct(F.lit(1).alias("t"), v.alias("leaf")), F.struct(F.lit(2).alias("t"), swapped.alias("leaf")))
    leaves = prints.select(fp).distinct().select(F.inline(tries)).where(F.col("t") == 1 if budget[2] < 0 else F.lit(True))
    allowed = F.when(F.col("t") == 1, budget[1]).otherwise(budget[2])
    trie = _trie(leaves)

    def nodes(level: int, side: str) -> DataFrame:
        """Nodes at a level with the number of leaves below them."""
        return trie.where(F.col("level") == level).select("t", F.col("node").alias(side), "leaves")

    def children(above: int, level: int, side: str) -> DataFrame:
        down = level - above
        return nodes(level, side + "_").select(
            "t", F.shiftrightunsigned(side + "_", down).alias(side), side + "_", F.col("leaves").alias(f"{side}_leaves"))

    def cut(pairs: DataFrame, last: DataFrame | None) -> DataFrame:
        """A level's pairs as a table, so that no plan holds more than one level; the level above goes."""
        now = staged(pairs, "trie_pairs")
        if last is not None:
            released(last)
        return now

    above, pairs = 0, None
    for level in UPPER:
        if pairs is None:
            down = nodes(level, "a_").select("t", "a_", F.col("leaves").alias("a_leaves"), F.lit(0).alias("e"), F.lit(0).cast("long").alias("b"))
        else:
            down = pairs.join(children(above, level, "a"), ["t", "a"])
        width = level - above
        down = (down.select("*", F.inline(_masks(width, max(budget.values())))).where(F.col("e") + F.col("cost") <= allowed)
                .withColumn("b_", F.shiftleft("b", width).bitwiseOR(F.col("a_").bitwiseAND((1 << width) - 1).bitwiseXOR(F.col("mask"))))
                .where((F.col("a_") < F.col("b_")) | ((F.col("a_") == F.col("b_")) & (F.col("a_leaves") > 1))))
        there = nodes(level, "b_").select("t", "b_")
        pairs = cut(down.join(there, ["t", "b_"], "left_semi").select(
            "t", F.col("a_").alias("a"), F.col("b_").alias("b"), (F.col("e") + F.col("cost")).alias("e")), pairs)
        above = level
    for level in LOWER_LEVELS:
        down = pairs.join(children(above, level, "a"), ["t", "a"]).join(children(above, level, "b"), ["t", "b"])
        low = (1 << (level - above)) - 1
        differ = F.bit_count(F.col("a_").bitwiseXOR(F.col("b_")).bitwiseAND(low))
        pair = ((F.col("a") != F.col("b")) | (F.col("a_") < F.col("b_"))  # any order of a node's children will do
                | ((F.col("a_") == F.col("b_")) & (F.col("a_leaves") > 1)))
        found = (down.withColumn("e", F.col("e") + differ).where((F.col("e") <= max_bits) & pair)
                 .select("t", F.col("a_").alias("a"), F.col("b_").alias("b"), "e"))
        pairs = found if level == LOWER_LEVELS[-1] else cut(found, pairs)
        above = level
    first_half = F.bit_count(F.col("a").bitwiseXOR(F.col("b")).bitwiseAND((1 << 32) - 1))  # in the second trie it is below
    own = lambda c: F.when(F.col("t") == 1, F.col(c)).otherwise(F.shiftleft(c, 32).bitwiseOR(F.shiftrightunsigned(c, 32)))
    return (pairs.where(F.col("a") != F.col("b")).where((F.col("t") == 1) | (first_half > budget[1]))
            .select(own("a").alias("a"), own("b").alias("b")))


def near_duplicates(docs: DataFrame, *, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS, keep: Sequence[Column] = ()) -> DataFrame:
    """``id``, the ``keep`` columns (expressions over ``docs``, other names than the result's), ``fp``, ``component`` (the
    smallest id reachable by links) and ``group`` (the component's smallest fingerprint) per row.

    Null, empty and wordless texts share fingerprint 0 and link to each other. Rows with a null id get a fingerprint
    and a null component, and link nothing. Fingerprints are linked, not ids: rows that repeat an id with different texts
    are judged each by its own fingerprint, and groups that merely share an id stay apart (``group`` tells them from each
    other). Texts are read whole, however long; ids may be of any type that can be ordered; other columns are ignored. An
    empty table gives no rows.
    """
    own = staged(fingerprints(docs, id=id, text=text, shingle=shingle, keep=keep), "simhash")
    prints = staged(own.where("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("first")), "simhash_prints")
    roots = components(trie_links(prints, max_bits))
    grouped = prints.join(roots, prints["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("group"))
    grouped = staged(grouped, "simhash_groups")
    classes = grouped.select("fp", "group").join(grouped.groupBy("group").agg(F.min("first").alias("component")), "group")
    more = [c for c in own.columns if c not in ("id", "fp")]
    named = F.col("id").isNotNull()
    return own.join(classes, "fp", "left").select(
        F.col("id").alias(id), *more, "fp", F.when(named, F.col("component")).alias("component"), F.when(named, F.col("group")).alias("group"))

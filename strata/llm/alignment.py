"""Alignment of two tokenizers over a corpus: which tokens of B lie over which tokens of A, and how often.

Fast path: an array gives for each id of A the id of B with the same bytes. A group of one A and one B token with these
ids is counted in a vector of A's vocabulary, one per task; only the links of other groups are counted by pair, once
for each chunk of text, and enter a shuffle. Chunks are written as one row each: the second pass looks their distinct
pairs up in the corpus-wide counts and needs no tokenizer.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strata.llm.common import chunks, executors_import_this, staged, text_buffer

#: Bytes of text of a chunk; one document may be longer.
CHUNK = 1 << 20
#: A pair's code is a << SHIFT | b, so B's ids must be below 2 ** SHIFT.
SHIFT = 20
#: Fixed value: how byte-level BPE files with `use_regex` split a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
RESULT = [*COUNTS, "n_best", "count_sum", "groups_sha256"]


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 stands for itself, and the other
    bytes, in order, for the letters from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b < 127 or 161 <= b != 173]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTable:
    """The bytes of all ids, flat, for building the bytes of many ids at once."""

    def __init__(self, entries: list[bytes]):
        self.flat = np.frombuffer(b"".join(entries), np.uint8)
        self.length = np.array([len(e) for e in entries], np.int64)
        self.start = np.cumsum(self.length) - self.length

    def joined(self, ids: np.ndarray) -> np.ndarray:
        length = self.length[ids]
        before = np.cumsum(length) - length
        return self.flat[np.repeat(self.start[ids] - before, length) + np.arange(int(length.sum()))]


class Decimals:
    """Ids as decimal digits, each with a separator behind it."""

    def __init__(self, n: int):
        words = [str(i).encode() for i in range(n)]
        self.width = np.array([len(w) for w in words])
        room = int(self.width.max()) + 1
        self.digits = np.frombuffer(b"".join(w.ljust(room) for w in words), np.uint8).reshape(n, room)
        self.used = np.arange(room) <= self.width[:, None]

    def written(self, ids: np.ndarray, separators: np.ndarray) -> np.ndarray:
        rows = self.digits[ids]
        rows[np.arange(len(ids)), self.width[ids]] = separators
        return rows[self.used[ids]]


class Aligner:
    """Both tokenizers, their entries as bytes, and the map of A's ids to B's ids with the same bytes (-1: none)."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        own = byte_of_letter()
        with open(a_path, encoding="utf-8") as f:
            said = json.load(f)
        vocabulary, special = said["model"]["vocab"], {t["content"] for t in said["added_tokens"]}
        entries = [b""] * (max(vocabulary.values()) + 1)
        for letters, i in vocabulary.items():
            entries[i] = b"" if letters in special else bytes(own[c] for c in letters)
        self.a = ByteTable(entries)
        self._encode_a = self._fast(said, entries, special) or self._plain(a_path)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        n = self.pieces.vocab_size()
        if n > 1 << SHIFT:
            raise ValueError("B's vocabulary is too large for the pair codes")
        raw = [self.pieces.is_byte(i) for i in range(n)]
        names = [self.pieces.id_to_piece(i) for i in range(n)]
        other = [bytes([int(p[3:5], 16)]) if r else p.replace("▁", " ").encode() for p, r in zip(names, raw)]
        self.b = ByteTable(other)
        usable = [i for i in range(n) if not (self.pieces.is_control(i) or self.pieces.is_unknown(i))]
        first = {other[i]: i for i in sorted(usable, key=lambda i: (not raw[i], i), reverse=True)}  # a piece before its raw byte
        first.update({other[i]: i for i in usable if not raw[i]})
        self.same = np.array([first.get(e, -1) if e else -1 for e in entries], np.int64)
        self.decimals = Decimals(max(len(entries), n))

    @staticmethod
    def _fast(said: dict, entries: list[bytes], special: set[str]):
        """tiktoken over the file's own vocabulary, where its ids are the order of its merges; the ids are the same."""
        import tiktoken

        own, model, split = byte_of_letter(), said["model"], said["pre_tokenizer"] or {}
        merged = [bytes(own[c] for c in "".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        if not plain or said["normalizer"] or entries[256:256 + len(merged)] != merged or any(len(e) != 1 for e in entries[:256]):
            return None
        coding = tiktoken.Encoding("aligned", pat_str=SPLIT, mergeable_ranks={e: i for i, e in enumerate(entries) if e}, special_tokens={})
        return lambda text: coding.encode_to_numpy(text, disallowed_special=())

    @staticmethod
    def _plain(path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.int64)

    def encoded(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        return ([self._encode_a(" " + t).astype(np.int64) if t else np.zeros(0, np.int64) for t in texts],
                [np.array(ids, np.int64) for ids in self.pieces.encode(texts, num_threads=1)] if texts else [])

    def groups(self, data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
        """Of texts that lie in ``data`` from ``off`` to ``off``: per text the four counts, ``sha`` and ``n_fast``; per link
        of one-to-one groups ``fast`` (A's id), per other link ``code``, both text by text."""
        n = len(off) - 1
        raw = data.tobytes()
        ids_a, ids_b = self.encoded([raw[off[i]:off[i + 1]].decode() for i in range(n)])
        size = np.where(np.diff(off) > 0, np.diff(off) + 1, 0)
        right = np.array([len(x) > 0 and self.a.length[x].sum() == self.b.length[y].sum() == s for x, y, s in zip(ids_a, ids_b, size)], bool)
        spaced = np.insert(data, off[:-1], 32)
        begin = off[:-1] + np.arange(n)
        for i in np.flatnonzero(right):
            text = spaced[begin[i]:begin[i] + size[i]]
            right[i] = np.array_equal(self.a.joined(ids_a[i]), text) and np.array_equal(self.b.joined(ids_b[i]), text)
        used = np.flatnonzero(right)
        a, b = (np.concatenate([ids[i] for i in used]) if len(used) else np.zeros(0, np.int64) for ids in (ids_a, ids_b))
        n_a, n_b = (np.array([len(ids[i]) if right[i] else 0 for i in range(n)], np.int64) for ids in (ids_a, ids_b))
        ends_a, ends_b, until = np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b]), np.cumsum(np.where(right, size, 0))
        both, links = np.intersect1d(ends_a, ends_b, assume_unique=True), np.union1d(ends_a, ends_b)
        group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        in_a, in_b = np.bincount(group_a, minlength=len(both)), np.bincount(group_b, minlength=len(both))
        # between two neighbouring ends there is one token of A over one of B: a link
        link_a, link_b, group = a[np.searchsorted(ends_a, links)], b[np.searchsorted(ends_b, links)], np.searchsorted(both, links)
        fast = (in_a[group] == 1) & (in_b[group] == 1) & (self.same[link_a] == link_b)
        text = np.searchsorted(until, links)
        # A's ids of a group come before B's
        place_a, place_b = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a], np.arange(len(b)) + np.cumsum(in_a)[group_b]
        ids, marks = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.uint8)
        ids[place_a], ids[place_b] = a, b
        marks[place_a] = np.where(both[group_a] == ends_a, ord("|"), ord(","))
        marks[place_b] = np.where(both[group_b] == ends_b, ord(";"), ord(","))
        written = memoryview(self.decimals.written(ids, marks).tobytes())
        stop = np.concatenate([[0], np.cumsum(self.decimals.width[ids] + 1)])[np.cumsum(n_a + n_b)]
        start = np.concatenate([[0], stop[:-1]])
        sha = [hashlib.sha256(written[start[i]:stop[i] - 1]).hexdigest() if right[i] else "" for i in range(n)]
        return {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(np.searchsorted(until, both), minlength=n),
                "n_links": np.bincount(text, minlength=n), "sha": np.array(sha, object), "n_fast": np.bincount(text[fast], minlength=n),
                "fast": link_a[fast], "code": link_a[~fast] << SHIFT | link_b[~fast]}


_WORKERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _WORKERS:
        _WORKERS[a_path, b_path] = Aligner(a_path, b_path)
    return _WORKERS[a_path, b_path]


def _chunk_rows(rows: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A row per chunk of ``rows`` (``own, t``), and one per task with the vector of its one-to-one groups."""
    long, longs, binary = T.LongType(), T.ArrayType(T.LongType()), T.BinaryType()
    doc = T.StructType([T.StructField("own", rows.schema["own"].dataType), *(T.StructField(c, long) for c in (*COUNTS, "n_fast")),
                        T.StructField("groups_sha256", T.StringType())])
    schema = T.StructType([T.StructField("chunk", long), T.StructField("docs", T.ArrayType(doc)), T.StructField("fast", binary),
                           T.StructField("links", binary), T.StructField("codes", longs), T.StructField("counts", longs),
                           T.StructField("same", longs), T.StructField("same_counts", longs)])
    arrow = to_arrow_schema(schema)

    def row(chunk: int, docs: pa.StructArray, fast=b"", links=b"", codes=(), counts=(), same=(), same_counts=()) -> pa.RecordBatch:
        lists = [pa.array([np.asarray(x, np.int64)], pa.list_(pa.int64())) for x in (codes, counts, same, same_counts)]
        listed = pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)
        return pa.RecordBatch.from_arrays([pa.array([chunk]), listed, pa.array([fast], pa.binary()), pa.array([links], pa.binary()), *lists], schema=arrow)

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = aligner(a_path, b_path)
        seen = np.zeros(len(worker.same), np.int64)
        number = TaskContext.get().partitionId() << 32
        fields = list(arrow.field("docs").type.value_type)
        for batch in batches:
            for part in chunks(batch, "t", CHUNK):
                found = worker.groups(*text_buffer(part.column(1)))
                seen += np.bincount(found["fast"], minlength=len(seen))
                codes, at, counts = np.unique(found["code"], return_inverse=True, return_counts=True)
                columns = [part.column(0), *(pa.array(found[c], pa.int64()) for c in (*COUNTS, "n_fast")), pa.array(found["sha"], pa.string())]
                docs = pa.StructArray.from_arrays(columns, fields=fields)
                yield row(number, docs, found["fast"].astype(np.uint32).tobytes(), at.astype(np.uint32).tobytes(), codes, counts)
                number += 1
        ids = np.flatnonzero(seen)
        none = pa.StructArray.from_arrays([pa.array([], f.type) for f in fields], fields=fields)
        yield row(-1, none, same=ids << SHIFT | worker.same[ids], same_counts=seen[ids])

    return rows.mapInArrow(aligned, schema)


def _pairs(table: DataFrame) -> DataFrame:
    """``code, n, same``: how often each pair is linked; ``same`` where the one-to-one groups hold it."""
    other = table.select(F.explode(F.arrays_zip("codes", "counts")).alias("x")).select(F.col("x.codes").alias("code"), F.col("x.counts").alias("n"), F.lit(0).alias("same"))
    same = table.select(F.explode(F.arrays_zip("same", "same_counts")).alias("x")).select(F.col("x.same"), F.col("x.same_counts"), F.lit(1))
    return other.union(same).groupBy("code").agg(F.sum("n").alias("n"), F.max("same").alias("same"))


def align(docs: DataFrame, a_path: str, b_path: str, *, text: str = "text",
          keep: Sequence[str | Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """The ``keep`` columns (default: all) of every row with ``n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``, and the table of pairs ``a, b, n`` (links of these ids in all texts).

    A (a byte-level BPE file of tokenizers) encodes a space and the text, B (a sentencepiece model, which adds the space)
    the text; strings of special tokens are plain text. Offsets where tokens of both end cut them into groups, and two
    tokens that share a byte are linked. ``n_best`` counts the links whose pair has the highest count of its B id, ties
    included; ``count_sum`` adds the pairs' counts over the links. Texts that are null or empty, or that either tokenizer
    doesn't give back byte for byte, have no tokens: zeros and an empty string. Texts are aligned whole; a text over
    1 MiB is a chunk by itself. Rows may repeat, ids may be null; an empty table gives two empty ones. Input columns named
    like the result's are left out.
    """
    executors_import_this(docs.sparkSession)
    keep = [c for c in (docs.columns if keep is None else keep) if isinstance(c, Column) or c not in RESULT]
    named = [F.col(f"`{c}`") if isinstance(c, str) else c for c in keep]
    rows = docs.select(F.struct(*named, F.lit(0).alias("__")).alias("own"), F.col(f"`{text}`").cast("string").alias("t"))
    table = staged(_chunk_rows(rows, a_path, b_path), "aligned")
    pairs = staged(_pairs(table), "pairs")
    b_id = F.col("code").bitwiseAND(F.lit((1 << SHIFT) - 1))
    same = {r.code >> SHIFT: r.n for r in pairs.where("same = 1").collect()}  # an entry of A's vocabulary each
    most = {r.b: r.n for r in pairs.groupBy(b_id.alias("b")).agg(F.max("n").alias("n")).collect()}  # an entry of B's each
    size_a, size_b = max(same, default=0) + 1, max(most, default=0) + 1
    n_same = np.array([same.get(i, 0) for i in range(size_a)], np.int64)
    n_most = np.array([most.get(i, 0) for i in range(size_b)], np.int64)

    exploded = table.where("chunk >= 0").select("chunk", F.posexplode("codes").alias("at", "code"))
    found = (exploded.join(pairs.select("code", "n"), "code").groupBy("chunk")
             .agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("found")))  # the distinct pairs of a chunk
    joined = (table.where("chunk >= 0").select("chunk", "docs", "fast", "links", "codes").join(found, "chunk", "left")
              .select("docs", "fast", "links", "codes", F.coalesce(F.col("found.n"), F.array().cast("array<bigint>")).alias("n")))
    doc = table.schema["docs"].dataType.elementType
    long = T.LongType()
    schema = T.StructType([doc["own"], *(T.StructField(c, T.StringType() if c == "groups_sha256" else long) for c in RESULT)])
    arrow = to_arrow_schema(schema)

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = aligner(a_path, b_path)
        best_same = n_same == np.where(worker.same[:size_a] >= 0, n_most[np.clip(worker.same[:size_a], 0, size_b - 1)], -1)
        for batch in batches:
            for i in range(batch.num_rows):
                docs = batch.column(0)[i].values
                fast = np.frombuffer(batch.column(1)[i].as_py(), np.uint32)
                at = np.frombuffer(batch.column(2)[i].as_py(), np.uint32)
                codes, n = (batch.column(k)[i].values.to_numpy(zero_copy_only=False).astype(np.int64) for k in (3, 4))
                best = n == n_most[codes & (1 << SHIFT) - 1]
                own = {f.name: docs.field(k) for k, f in enumerate(docs.type)}
                n_fast = own["n_fast"].to_numpy(zero_copy_only=False)
                n_rest = own["n_links"].to_numpy(zero_copy_only=False) - n_fast

                def sums(values: np.ndarray, per: np.ndarray) -> np.ndarray:
                    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[np.concatenate([[0], np.cumsum(per)])])

                own["count_sum"] = pa.array(sums(n_same[fast], n_fast) + sums(n[at], n_rest))
                own["n_best"] = pa.array(sums(best_same[fast], n_fast) + sums(best[at], n_rest))
                yield pa.RecordBatch.from_arrays([own[f.name] for f in arrow], schema=arrow)

    result = joined.mapInArrow(looked_up, schema).select("own.*", *RESULT).drop("__")
    return result, pairs.select(F.shiftright("code", SHIFT).alias("a"), b_id.alias("b"), "n")

"""Line dedup that can be taken back: exact reference counts of line keys, and sharded cuckoo filters of the
repeated keys that tell cheaply which lines need a look at the counts.

State (``LineIndex``), all in tables:
* postings (k1, k2, doc, batch, bucket): a row per document and distinct key, the exact base that deletions need. A change
  adds a part, or the ids that are gone; parts are put together after some changes;
* ``refs`` (k1, k2, n_docs, last_doc, bucket): the counts of the keys that are repeated now;
* ``filters`` (shard, room, filter): a cuckoo filter of each shard's repeated keys, of any number of shards.
Postings and counts are stored by bucket of the key, so ``insert`` and ``delete`` read and write the buckets of the keys
that their documents hold, and the filters take in and give up the keys that have crossed the threshold. A filter that
fills up is built again with more room, and shards that outgrow their keys are halved. ``deduplicate`` reads the state and
never changes it: lines go where their shard's filter lies, in as many copies as the shard's lines need.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import chunks, executors_import_this, staged
from strata.session import scratch_path
from strata.llm.cuckoo import SLOTS, CuckooFilter

MIN_CHARS = 40
MIN_DOCS = 5
BLANKS = " \t\n\x0b\x0c\r"
#: Repeated keys of a filter shard at most; the number of shards follows the number of repeated keys.
SHARD_KEYS = 200_000
#: Share of a filter's room that is used before it is built again.
FULL = 0.85
#: Lines that one copy of a filter screens, at least; more where the filter is larger than they are.
SCREEN_ROWS = 1 << 14
#: Buckets of keys in which postings and counts are stored, and changes after which their parts are put together.
BUCKETS, PARTS = 64, 16

POSTINGS = "k1 long, k2 long, doc long"
FILTERS = "shard long, room long, filter binary"


def _line_keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, line and 128-bit key of every line that is long enough; lines per row."""
    lines = pc.split_pattern(pc.ascii_lower(pc.fill_null(texts, "")), "\n")
    count = pc.list_value_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    keys = pc.ascii_trim(lines.flatten(), characters=BLANKS)
    long = np.flatnonzero(pc.greater_equal(pc.utf8_length(keys), MIN_CHARS).to_numpy(zero_copy_only=False))
    digest = xxhash.xxh3_128_digest
    hashed = np.frombuffer(b"".join(digest(x) for x in keys.take(pa.array(long)).cast(pa.large_binary()).to_pylist()), "<i8")
    rows = np.repeat(np.arange(len(texts)), count)
    line = np.arange(len(rows)) - (np.cumsum(count) - count)[rows]
    return rows[long], line[long], hashed.reshape(-1, 2), count


def _once_per_row(rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
    order = np.lexsort((keys[:, 1], keys[:, 0], rows))
    first = np.ones(len(order), bool)
    r, k = rows[order], keys[order]
    first[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1]).any(1)
    return order[first]


def postings(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``k1, k2, doc`` per row of ``docs`` and distinct key of at least ``MIN_CHARS`` code points."""
    executors_import_this(docs.sparkSession)

    def keyed(batches):
        for batch in batches:
            for part in chunks(batch, "t"):
                rows, _, keys, _ = _line_keys(part.column(1))
                own = _once_per_row(rows, keys) if len(rows) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[own, 0]), pa.array(keys[own, 1]), part.column(0).take(pa.array(rows[own]))], names=["k1", "k2", "doc"])

    return docs.select(F.col(id).cast("long").alias("doc"), F.col(text).cast("string").alias("t")).mapInArrow(keyed, POSTINGS)


def _bucket():
    return F.pmod("k1", F.lit(BUCKETS).cast("long")).cast("int")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """A table by bucket of the key: what is asked of some buckets reads no other. Large buckets are written by several tasks."""
    df = df.withColumn("bucket", _bucket())
    path = scratch_path(df.sparkSession, name)
    df.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _counts(found: DataFrame) -> DataFrame:
    return found.groupBy("k1", "k2").agg(F.count("*").alias("n_docs"), F.max("doc").alias("last_doc"))


def _shard(shards: int):
    return F.pmod("k2", F.lit(shards).cast("long"))


def _updated_filters(changed: DataFrame, filters: DataFrame | None, shards: int) -> DataFrame:
    """``changed``: k1, k2 and whether the key enters (add) or leaves. A group is one shard's distinct keys, of which a
    shard has no more than ``SHARD_KEYS`` before it is halved. New filters have room for twice their keys."""
    def update(shard, changed, old):
        enter = changed.loc[changed["add"], "k1"].to_numpy(np.int64)
        leave = changed.loc[~changed["add"], "k1"].to_numpy(np.int64)
        f = CuckooFilter(max(64, 2 * len(enter)), old["filter"].iloc[0] if len(old) else None)
        f.insert(enter)
        f.delete(leave)
        return pd.DataFrame({"shard": [shard[0]], "room": [f.buckets * SLOTS], "filter": [f.to_bytes()]})

    spark = changed.sparkSession
    executors_import_this(spark)
    sharded = changed.select(_shard(shards).alias("shard"), "k1", "add")
    old = filters if filters is not None else spark.createDataFrame([], FILTERS)
    return staged(sharded.groupBy("shard").cogroup(old.groupBy("shard")).applyInPandas(update, FILTERS), "line_filters")


@dataclass(frozen=True)
class LineIndex:
    """Reversible state of line dedup; every change gives a new one."""

    parts: tuple[DataFrame, ...]
    gone: DataFrame
    refs: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int = MIN_DOCS
    batch: int = 0

    @classmethod
    def build(cls, docs: DataFrame, *, id: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS) -> LineIndex:
        """Insert ``docs`` into an empty index."""
        spark = docs.sparkSession
        found = _stored(postings(docs, id=id, text=text).withColumn("batch", F.lit(0)), "line_postings")
        refs = _stored(_counts(found).where(F.col("n_docs") >= min_docs), "line_refs")
        shards = max(1, -(-refs.count() // SHARD_KEYS))
        filters = _updated_filters(refs.select("k1", "k2", F.lit(True).alias("add")), None, shards)
        return cls((found,), spark.createDataFrame([], "doc long, until int"), refs, filters, shards, min_docs)

    def postings(self, buckets: list[int] | None = None) -> DataFrame:
        """``k1, k2, doc, batch`` of all documents that are in, or of some buckets' keys."""
        every = reduce(DataFrame.unionByName, (p if buckets is None else p.where(F.col("bucket").isin(buckets)) for p in self.parts))
        out = self.gone.groupBy("doc").agg(F.max("until").alias("until"))
        return (every.join(out, every["doc"].eqNullSafe(out["doc"]) & (every["batch"] <= out["until"]), "left_anti")
                .select("k1", "k2", "doc", "batch"))

    def _changed(self, keys: DataFrame) -> LineIndex:
        """This index with the counts and filters of ``keys`` (distinct), the only ones that a change has touched."""
        touched = sorted(r.bucket for r in keys.select(_bucket().alias("bucket")).distinct().collect())  # BUCKETS numbers at most
        if not touched:
            return self
        within = F.col("bucket").isin(touched)
        before, now = self.refs.where(within), self.postings(touched).join(keys, ["k1", "k2"], "left_semi")
        counted = staged(_counts(now).where(F.col("n_docs") >= self.min_docs), "line_counts")
        rows = before.join(keys, ["k1", "k2"], "left_anti").drop("bucket").unionByName(counted)
        refs = self.refs.where(~within).unionByName(_stored(rows, "line_refs"))
        known = before.join(keys, ["k1", "k2"], "left_semi").select("k1", "k2")
        crossed = (counted.join(known, ["k1", "k2"], "left_anti").select("k1", "k2", F.lit(True).alias("add"))
                   .unionByName(known.join(counted, ["k1", "k2"], "left_anti").select("k1", "k2", F.lit(False).alias("add"))))
        n = refs.count()
        every = refs.select("k1", "k2", F.lit(True).alias("add"))
        if n > self.shards * SHARD_KEYS:  # twice the shards, for as many keys again
            shards = 2 * self.shards
            return replace(self, refs=refs, shards=shards, filters=_updated_filters(every, None, shards))
        sizes = refs.groupBy(_shard(self.shards).alias("shard")).agg(F.count("*").alias("n"))
        tight = staged(sizes.join(self.filters.select("shard", "room"), "shard").where(F.col("n") > F.lit(FULL) * F.col("room")).select("shard"), "line_tight")
        in_tight = lambda df: df.withColumn("shard", _shard(self.shards)).join(tight, "shard", "left_semi").drop("shard")
        rest = crossed.withColumn("shard", _shard(self.shards)).join(tight, "shard", "left_anti").drop("shard")
        same = _updated_filters(rest, self.filters.join(tight, "shard", "left_anti"), self.shards)
        return replace(self, refs=refs, filters=same.unionByName(_updated_filters(in_tight(every), None, self.shards)))

    def _tidied(self) -> LineIndex:
        """Parts put together once there are many, and the plan of the counts cut: the cost of a scan, once in ``PARTS`` changes."""
        if self.batch % PARTS:
            return self
        whole = _stored(self.postings(), "line_postings")
        return replace(self, parts=(whole,), gone=self.gone.limit(0), refs=_stored(self.refs.drop("bucket"), "line_refs"), filters=staged(self.filters, "line_filters"))

    def insert(self, docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> LineIndex:
        """Take these documents in; those with an id that is in already count as documents of their own."""
        batch = self.batch + 1
        new = _stored(postings(docs, id=id, text=text).withColumn("batch", F.lit(batch)), "line_postings")
        grown = replace(self, parts=(*self.parts, new), batch=batch)
        return grown._changed(staged(new.select("k1", "k2").distinct(), "line_keys"))._tidied()

    def delete(self, ids: DataFrame, *, id: str = "doc_id") -> LineIndex:
        """Take the documents with these ids out again (a null id: those without one)."""
        batch = self.batch + 1
        out = staged(ids.select(F.col(id).cast("long").alias("doc"), F.lit(self.batch).alias("until")).distinct(), "line_gone")
        keys = staged(self.postings().alias("p").join(out.select("doc").alias("o"), F.col("p.doc").eqNullSafe(F.col("o.doc")), "left_semi")
                      .select("k1", "k2").distinct(), "line_keys")
        return replace(self, gone=self.gone.unionByName(out), batch=batch)._changed(keys)._tidied()

    def screened(self, found: DataFrame) -> DataFrame:
        """The rows of ``found`` (k1, k2, doc) whose key a filter may hold. Lines and filters meet by shard; a shard's
        lines are dealt over copies of its filter, so a hot key is screened by many tasks."""
        executors_import_this(found.sparkSession)
        rows = found.select("k1", "k2", "doc", _shard(self.shards).alias("shard"))
        load = rows.groupBy("shard").agg(F.count("*").alias("n")).join(self.filters, "shard")
        per = F.greatest(F.lit(SCREEN_ROWS), F.length("filter") / 3)  # a line takes 24 bytes: the copies stay an eighth of the lines
        held = staged(load.select("shard", F.ceil(F.col("n") / per).cast("int").alias("copies"), "filter"), "line_screens")
        none = F.lit(None)
        filters = held.select("shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), "filter",
                              none.cast("long").alias("k1"), none.cast("long").alias("k2"), none.cast("long").alias("doc"))
        copy = F.pmod(F.xxhash64("k1", "k2", "doc"), F.col("copies")).cast("int").alias("copy")
        lines = rows.join(held.select("shard", "copies"), "shard").select("shard", copy, none.cast("binary").alias("filter"), "k1", "k2", "doc")

        def screen(batches):
            f = None
            for batch in batches:
                at = np.flatnonzero(batch.column(2).is_valid().to_numpy(zero_copy_only=False)).tolist()
                for begin, end in zip([-1, *at], [*at, batch.num_rows]):
                    if begin >= 0:
                        f = CuckooFilter(0, batch.column(2)[begin].as_py())
                    part = batch.slice(begin + 1, end - begin - 1)
                    if part.num_rows:
                        keep = pa.array(f.may_hold(part.column(3).to_numpy(zero_copy_only=False).astype(np.int64)))
                        yield pa.RecordBatch.from_arrays([part.column(i).filter(keep) for i in (3, 4, 5)], names=["k1", "k2", "doc"])

        dealt = filters.unionByName(lines).repartition("shard", "copy").sortWithinPartitions("shard", "copy", F.col("filter").isNull())
        return dealt.mapInArrow(screen, POSTINGS)

    def deduplicate(self, docs: DataFrame, *, id: str = "doc_id", text: str = "text", keep: list[str] | None = None,
                    found: DataFrame | None = None) -> DataFrame:
        """The ``keep`` columns of ``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text`` (see :func:`deduplicate_lines`).
        ``found``: the postings of ``docs``, where they are known."""
        maybe = self.screened(postings(docs, id=id, text=text) if found is None else found)
        drops = (maybe.join(self.refs.drop("bucket"), ["k1", "k2"]).where(F.col("last_doc").isNotNull() & ~F.col("doc").eqNullSafe(F.col("last_doc")))
                 .groupBy("doc").agg(F.collect_set("k1").alias("__drop")))
        added = {"n_lines": T.LongType(), "n_dropped": T.LongType(), "kept_text": T.StringType()}
        keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
        row = F.struct(*(F.col(f"`{c}`") for c in keep), F.lit(0).alias("__none"))
        read = docs.select(row.alias("__row"), F.col(id).cast("long").alias("__id"), F.col(text).cast("string").alias("__text"))
        joined = read.join(drops, F.col("__id").eqNullSafe(F.col("doc")), "left").select("__row", "__text", "__drop")

        def rebuilt(batches):
            for batch in batches:
                for part in chunks(batch, "__text"):
                    texts, drop = part.column(1), part.column(2)
                    lines = pc.add(pc.fill_null(pc.count_substring(texts, "\n"), 0), 1).cast(pa.int64())
                    dropped, kept = np.zeros(part.num_rows, np.int64), texts
                    some = np.flatnonzero(drop.is_valid().to_numpy(zero_copy_only=False))
                    if len(some):
                        rows, line, keys, _ = _line_keys(texts.take(pa.array(some)))
                        gone: list[set] = [set() for _ in some]
                        listed = [set(x) for x in drop.take(pa.array(some)).to_pylist()]
                        for r, at, key in zip(rows.tolist(), line.tolist(), keys[:, 0].tolist()):
                            if key in listed[r]:
                                gone[r].add(at)
                        new = ["\n".join(x for at, x in enumerate(t.split("\n")) if at not in g)
                               for t, g in zip(texts.take(pa.array(some)).to_pylist(), gone)]
                        mask = np.zeros(part.num_rows, bool)
                        mask[some] = True
                        kept = pc.replace_with_mask(texts, pa.array(mask), pa.array(new, texts.type))
                        dropped[some] = [len(g) for g in gone]
                    yield pa.RecordBatch.from_arrays([part.column(0), lines, pa.array(dropped), kept], names=["__row", *added])

        schema = T.StructType([joined.schema["__row"], *(T.StructField(c, t) for c, t in added.items())])
        return joined.mapInArrow(rebuilt, schema).select(*(F.col(f"__row.`{c}`") for c in keep), *added)


def deduplicate_lines(docs: DataFrame, *, id: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS,
                      keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default: all) of every row with ``n_lines`` (of the whole text, split at newlines), ``n_dropped`` and ``kept_text``.

    A line's key is the line without blanks at its ends, A-Z lower-cased. Keys of at least ``MIN_CHARS`` code points
    in at least ``min_docs`` rows lose all their lines except in the largest id that holds them. Null and empty texts
    are one empty line; a null text stays null. Rows that repeat an id count as documents of their own and share its fate; a null id is never
    the largest, and a key that only null ids hold loses nothing. An input column with the name of a result column is
    left out. Texts are split whole, however long. Ids must be whole numbers (they are cast to long). An empty table gives no rows.
    """
    index = LineIndex.build(docs, id=id, text=text, min_docs=min_docs)
    return index.deduplicate(docs, id=id, text=text, keep=keep, found=index.postings())

"""The prefix trie of conversations, with sums over subtrees by depth-band rollup.

A node is a distinct sequence of first turns. Its key is the sum of its turns' hashes, each taken with the turn's
position: such sums can be built block by block, so no conversation has to fit one task. For the sums over subtrees a
node explodes to its ancestors within its band of ``BAND`` depths only; the bands' roots form a trie that is ``BAND``
times lower and is summed in the same way, and its completed totals then go to the ancestors in the band above each
root. So a trie of depth D takes log(D) rounds, and no node is multiplied more than ``BAND`` times in a round.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import executors_import_this, staged

BAND = 8
#: Turns of a conversation that one window sums.
BLOCK = 4096
#: Ids (2 ** this) that one row of a digest's input holds.
DIGEST_BITS = 12
KEY = ["depth", "k1", "k2"]


def numbered(turns: DataFrame, *, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, position`` (from 1), ``t1, t2`` (hashes of role and text) and ``chars`` (code points of the text) per turn,
    by ``turn`` (nulls first). Rows are sorted in ranges; a conversation may spread over many."""
    said = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text)]
    narrow = turns.where(F.col(f"`{id}`").isNotNull()).select(
        F.col(f"`{id}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.xxhash64(F.lit(1), *said).alias("t1"),
        F.xxhash64(F.lit(2), *said).alias("t2"), F.length(said[1]).cast("long").alias("chars"))
    order = [F.col("turn").asc_nulls_first(), "t1", "t2", "row"]
    rows = staged(narrow.withColumn("row", F.monotonically_increasing_id()).repartitionByRange("conv", *order)
                  .withColumn("range", F.spark_partition_id()), "turns")
    sizes = rows.groupBy("range", "conv").agg(F.count("*").alias("n"))
    first = F.broadcast(sizes.groupBy("range").agg(F.min("conv").alias("conv")))  # what goes on in a range is its first
    earlier = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    begun = (sizes.join(first.select("conv").distinct(), "conv", "left_semi")
             .withColumn("before", F.sum("n").over(earlier)).where("before > 0").select("range", "conv", "before"))
    nth = F.row_number().over(Window.partitionBy("range", "conv").orderBy(*order))
    return (rows.withColumn("nth", nth).join(F.broadcast(begun), ["range", "conv"], "left")  # a row per range at most
            .select("conv", (F.col("nth") + F.coalesce("before", F.lit(0))).alias("position"), "t1", "t2", "chars"))


def with_openings(turns: DataFrame, *, family: int = 100, shared: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on their family's first one, and the list of all (``conv``). Conversation c takes the first
    h turns of c - c % ``family`` (its sign is c's) and then its own after the first h, with h = crc32(c) % ``shared``.
    ``turns`` is :func:`numbered`'s result; the rebuilt turns have ``depth`` for ``position``."""
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(shared)).cast("int")
    base = F.col("conv") - F.col("conv") % F.lit(family)
    said = ["t1", "t2", "chars"]
    opening = (turns.where((F.col("position") < shared) & (F.col("conv") == base)).groupBy(F.col("conv").alias("base"))
               .agg(F.sort_array(F.collect_list(F.struct("position", *said))).alias("opening")))  # fewer than ``shared`` turns
    convs = turns.where("position = 1").select("conv")
    given = (convs.withColumn("base", base).withColumn("h", h).join(opening, "base")
             .select("conv", F.explode(F.slice("opening", F.lit(1), F.col("h"))).alias("o")).select("conv", F.col("o.position").alias("depth"), *(f"o.{c}" for c in said)))
    taken = F.least("h", F.coalesce(F.size("opening"), F.lit(0)))
    own = (turns.withColumn("base", base).withColumn("h", h).where("position > h").join(opening, "base", "left")
           .select("conv", (F.col("position") - F.col("h") + taken).alias("depth"), *said))
    return given.unionByName(own), convs


def _key(sums: list[Column], depth: Column) -> list[Column]:
    return [F.xxhash64(*sums[:2], depth), F.xxhash64(*sums[2:], depth)]


def chains(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``conv``, the node's key (``depth, k1, k2``), its parent's (``p1, p2``) and ``chars`` for every first part of every
    conversation, the empty one included. ``turns``: ``conv, depth`` (gapless from 1), ``t1, t2, chars``."""
    x, y = F.xxhash64("t1", "t2", "depth"), F.xxhash64("depth", "t2", "t1")
    halves = [f(v) for v in (x, y) for f in (lambda v: F.shiftrightunsigned(v, 32), lambda v: v.bitwiseAND(F.lit(0xFFFFFFFF)))]
    names = [f"h{i}" for i in range(4)]
    rows = turns.select("conv", "depth", "chars", *(v.alias(n) for v, n in zip(halves, names)), F.floor(F.col("depth") / BLOCK).alias("block"))
    totals = rows.where(F.col("depth") >= 0).groupBy("conv", "block").agg(*(F.sum(n).alias(n) for n in names))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    long = rows.where("block > 0").select("conv").distinct()
    before = (totals.join(long, "conv", "left_semi").select("conv", "block", *(F.sum(n).over(earlier).alias(f"b{n}") for n in names))
              .where("block > 0"))
    so_far = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.select("*", *(F.sum(n).over(so_far).alias(f"s{n}") for n in names)).join(before, ["conv", "block"], "left")
    sums = [F.col(f"s{n}") + F.coalesce(f"b{n}", F.lit(0)) for n in names]
    depth = F.col("depth").cast("long")
    keys = [*_key(sums, depth), *_key([s - F.col(n) for s, n in zip(sums, names)], depth - 1)]
    deep = summed.select("conv", depth.alias("depth"), *(k.alias(n) for k, n in zip(keys, ("k1", "k2", "p1", "p2"))), "chars")
    zero = F.lit(0).cast("long")
    none = F.lit(None).cast("long")
    root = _key([zero] * 4, zero)
    return deep.unionByName(convs.select("conv", zero.alias("depth"), root[0].alias("k1"), root[1].alias("k2"), none.alias("p1"),
                                         none.alias("p2"), zero.alias("chars")))


def subtree_sums(nodes: DataFrame, chain: DataFrame, values: list[str], *, band: int = BAND) -> DataFrame:
    """``depth, k1, k2`` and the sums of ``values`` over each node's subtree, itself included. ``nodes`` has the keys, the
    ``values`` and ``conv``, the smallest member; ``chain`` has the keys of all parts of the members."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0

    def gathered(rows: DataFrame, unit: int, own_band: Column, upper: Column) -> DataFrame:
        """Sums of what ``rows`` send to the nodes of their conversation in the band ``own_band`` that ``upper`` admits."""
        line = chain.where(F.col("depth") % unit == 0).select(*KEY, "conv", F.floor(F.col("depth") / (unit * band)).alias("band"))
        sent = rows.select(F.col("depth").alias("from"), "conv", *values, own_band.alias("band"))
        return (sent.join(line, ["conv", "band"]).where(upper).groupBy(*KEY)
                .agg(F.min("conv").alias("conv"), *(F.sum(v).alias(v) for v in values)))

    def totals(level: DataFrame, unit: int) -> DataFrame:
        wide = unit * band
        inside = gathered(level, unit, F.floor(F.col("depth") / wide), F.col("depth") <= F.col("from"))
        if deepest < wide:
            return inside
        inside = staged(inside, "bands")
        roots = staged(totals(inside.where(F.col("depth") % wide == 0), wide), "roots")
        below = gathered(roots.where("depth > 0"), unit, F.floor(F.col("depth") / wide) - 1, F.col("depth") % wide != 0)
        rest = inside.where(F.col("depth") % wide != 0).unionByName(below)
        return roots.unionByName(rest.groupBy(*KEY).agg(F.min("conv").alias("conv"), *(F.sum(v).alias(v) for v in values)))

    return totals(nodes, 1).drop("conv")


def _digests(ends: DataFrame) -> DataFrame:
    """The node's key and the SHA-256 of the ids (column ``conv``) at each node, in order and joined by commas. The ids are
    joined in parallel, a few thousand a row; only the hash itself is taken one after another, as a stream."""
    executors_import_this(ends.sparkSession)
    some = ends.groupBy(*KEY, F.shiftright("conv", DIGEST_BITS).alias("part")).agg(
        F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))  # 2 ** DIGEST_BITS ids at most
    schema = "depth long, k1 long, k2 long, ends_sha256 string"

    def hashed(batches):
        now, state, names = None, None, ["depth", "k1", "k2", "ends_sha256"]
        for batch in batches:
            done = []
            *keys, ids = (batch.column(i).to_pylist() for i in range(4))
            for key, part in zip(zip(*keys), ids):
                if key == now:
                    state.update(b"," + part.encode())
                    continue
                if state:
                    done.append((*now, state.hexdigest()))
                now, state = key, hashlib.sha256(part.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate((pa.int64(),) * 3 + (pa.string(),))], names=names)
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, state.hexdigest())], names=names)

    return some.repartition(*KEY).sortWithinPartitions(*KEY, "part").select(*KEY, "ids").mapInArrow(hashed, schema)


def prefix_trie(turns: DataFrame, convs: DataFrame, *, band: int = BAND) -> DataFrame:
    """A row per node of the trie of ``turns`` (``conv, depth, t1, t2, chars``; depths gapless from 1) of the conversations
    ``convs`` (``conv``, distinct; those without turns end at the root): ``conv_id`` (the smallest member), ``depth``,
    ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    Sequences count as equal by 128 bits of hash. Any number of conversations may share a turn, a node or an end, and a
    conversation may have any number of turns. Without conversations there are no rows, not even the root.
    """
    chain = staged(chains(turns, convs), "chain")
    nodes = staged(chain.groupBy(*KEY).agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("p1").alias("p1"),
                                           F.max("p2").alias("p2"), F.max("chars").alias("chars")), "nodes")
    children = (nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
                .agg(F.count("*").alias("n_children")))
    counted = staged(nodes.join(children, KEY, "left").select(
        *KEY, "conv", "n_convs", "p1", "p2", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")), "counted")
    sums = subtree_sums(counted.select(*KEY, "conv", "n_leaves", "saved_tokens"), chain.select(*KEY, "conv"), ["n_leaves", "saved_tokens"], band=band)
    last = chain.groupBy("conv").agg(F.max(F.struct(*KEY)).alias("last")).select("conv", "last.*")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent_conv_id"))
    whole = (counted.drop("n_leaves", "saved_tokens").join(sums, KEY).join(_digests(last), KEY, "left")
             .join(parents, ["depth", "p1", "p2"], "left"))
    return whole.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, *, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                      family: int = 100, shared: int = 6, band: int = BAND) -> DataFrame:
    """:func:`prefix_trie` of conversations rebuilt :func:`with_openings`.

    Turns go by ``turn``, nulls first, and where turns are equal by a hash of role and text; repeated rows are turns of
    their own. A null role or text is empty. Rows with a null id belong to no conversation and are left out; ids are
    whole numbers. Texts are hashed whole, however long. Other columns, whatever their names, are ignored.
    """
    rows = staged(numbered(conversations, id=id, turn=turn, role=role, text=text), "numbered")
    rebuilt, convs = with_openings(rows, family=family, shared=shared)
    return prefix_trie(rebuilt, convs, band=band)

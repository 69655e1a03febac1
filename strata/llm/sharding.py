"""Sharding by balanced label propagation: linked rows move towards their neighbours' shards, round by round, as far
as the shards' capacity allows (after Ugander & Backstrom, "Balanced Label Propagation for Partitioning Massive
Graphs", 2013). Only DataFrame operations: joins, counts and windows.

Law of sizes: ``rows`` - the shards' row counts differ by one at most. Rows without links don't care where they are,
so only linked rows take part in the rounds; the others fill the shards up at the end. Moves between two shards that
no capacity covers are matched against moves out of the full shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import released, staged

SHARDS = 8
ROUNDS = 12
#: Rows of a ranking bucket; a bucket is sorted by one task.
BUCKET_ROWS = 8192
#: Gains above this count as equal when capacity decides who moves first.
TOP_GAIN = 7


def ranked(rows: DataFrame, key: str, parts: list[str], n: int, first: Column | None = None, salt: int = 0) -> DataFrame:
    """``rows`` with a gapless ``rank`` from 0 within each value of ``parts``: by ``first`` (few values), then by hash
    buckets of ``key``, then by key. Rows are sorted within buckets only; the buckets' sizes are summed before them.
    ``n``: the number of rows, from which the number of buckets follows. Where ``parts`` follow from an earlier rank,
    another ``salt`` deals them over all buckets again."""
    buckets = max(16, n // BUCKET_ROWS)
    own = rows.withColumn("__first", F.lit(0) if first is None else first).withColumn("__bucket", F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(buckets)))
    group = [*parts, "__first", "__bucket"]
    before = Window.partitionBy(*parts).orderBy("__first", "__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = own.groupBy(*group).agg(F.count("*").alias("__n"))
    starts = sizes.select(*group, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return (own.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(key))).join(starts, group)
            .withColumn("rank", F.col("rank") - 1 + F.col("__start")).drop("__first", "__bucket", "__start"))


def _accepted(wanted: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many of the wanted moves between each pair of shards fit: what enters a shard may exceed what leaves it by
    its room. Numbers per pair of shards only."""
    accepted = dict(wanted)
    while True:
        over = False
        for shard in range(len(room)):
            into = sum(n for (_, b), n in accepted.items() if b == shard)
            most = room[shard] + sum(n for (a, _), n in accepted.items() if a == shard)
            excess = into - most
            for pair in sorted(p for p in accepted if p[1] == shard):
                if excess > 0:
                    cut = min(accepted[pair], -(-excess * accepted[pair] // max(1, into)))
                    accepted[pair] -= cut
                    excess, over = excess - cut, True
        if not over:
            return accepted


def propagate(nodes: DataFrame, links: DataFrame, total: int, *, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``node, shard`` for the linked ``nodes`` (column ``node``), of ``total`` rows in all. ``links``: ``a, b``.

    A round: every active node counts its neighbours' shards; if another shard holds more of them than its own, it
    wants to move there. Half of the nodes, by hash, are active in a round, so that neighbours don't swap places
    forever. Of the moves between two shards those with the highest gain go first.
    """
    capacity = [total // shards + (i < total % shards) for i in range(shards)]
    both = staged(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    n = nodes.count()
    state = staged(ranked(nodes.select("node"), "node", [], n).select("node", F.pmod("rank", F.lit(shards)).cast("int").alias("shard")), "shards")
    idle = 0
    for turn in range(rounds if n else 0):
        active = state.where(F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(2)) == 0).select(F.col("node").alias("a"), F.col("shard").alias("own"))
        votes = (both.join(state.select(F.col("node").alias("b"), "shard"), "b").groupBy("a", "shard").agg(F.count("*").alias("n"))
                 .join(active, "a").groupBy("a", "own").agg(
                     F.max(F.struct("n", F.xxhash64("a", "shard", F.lit(turn)), "shard")).alias("best"),  # ties by chance, or all drift one way
                     F.sum(F.when(F.col("shard") == F.col("own"), F.col("n")).otherwise(0)).alias("here")))
        movers = staged(votes.where("best.n > here").select(
            F.col("a").alias("node"), F.col("own").alias("src"), F.col("best.shard").alias("dst"), (F.col("best.n") - F.col("here")).alias("gain")), "moves")
        wanted = {(r.src, r.dst): r["count"] for r in movers.groupBy("src", "dst").count().collect()}  # at most shards ** 2 numbers
        used = {r.shard: r["count"] for r in state.groupBy("shard").count().collect()}
        accepted = _accepted(wanted, [capacity[i] - used.get(i, 0) for i in range(shards)])
        idle = 0 if sum(accepted.values()) else idle + 1
        if idle == 2:  # neither half of the nodes moves any more
            break
        if idle:
            continue
        if accepted != wanted:
            allowed = F.create_map(*(F.lit(x) for (a, b), k in accepted.items() for x in (a * shards + b, k)))
            movers = (ranked(movers, "node", ["src", "dst"], sum(wanted.values()), -F.least("gain", F.lit(TOP_GAIN)))
                      .where(F.col("rank") < allowed[F.col("src") * shards + F.col("dst")]))
        new = staged(state.join(movers.select("node", "dst"), "node", "left").select("node", F.coalesce("dst", "shard").alias("shard")), "shards")
        released(state)
        state = new
    return state


def copy_links(rows: DataFrame, row: str, group: str, total: int) -> DataFrame:
    """``a, b``: links that join all rows of an equal ``group`` without listing pairs. A group's rows are dealt over
    hash blocks; each links to the first of its block, and that one to the first of the group."""
    blocks = max(64, total // 4096)
    dealt = rows.where(F.col(group).isNotNull()).select(F.col(row).alias("a"), F.col(group).alias("g"), F.pmod(F.xxhash64(row), F.lit(blocks)).alias("block"))
    hubs = dealt.groupBy("g", "block").agg(F.min("a").alias("hub"), F.count("*").alias("n"))
    tops = hubs.groupBy("g").agg(F.min("hub").alias("top"), F.sum("n").alias("n")).where("n > 1").drop("n")
    hubs = staged(hubs.drop("n").join(tops, "g"), "hubs")
    members = dealt.join(hubs, ["g", "block"]).select("a", F.col("hub").alias("b"))
    return members.unionByName(hubs.select(F.col("hub").alias("a"), F.col("top").alias("b"))).where("a <> b")


def shard_rows(rows: DataFrame, links: DataFrame, row: str, *, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (gapless from 0 within the shard). ``row`` names a column of distinct
    non-null keys, ``links`` (a, b) has pairs of them. Shard sizes differ by one row at most, whatever the links; an
    empty table gives no rows, and with fewer rows than shards some shards stay empty. An input column with the name of
    a result column is left out. ``rows`` must be a table or cheap: it is read several times."""
    rows = rows.drop("shard", "slot", "rank")
    total = rows.count()
    links = staged(links, "links")
    nodes = staged(links.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    state = propagate(nodes, links, total, shards=shards, rounds=rounds)
    used = {r.shard: r["count"] for r in state.groupBy("shard").count().collect()}
    free = rows.select(F.col(row).alias("node")).join(nodes, "node", "left_anti")
    until, sofar = F.when(F.lit(False), 0), 0
    for i in range(shards):
        sofar += total // shards + (i < total % shards) - used.get(i, 0)
        until = until.when(F.col("rank") < sofar, i)
    filled = ranked(free, "node", [], total).select("node", until.alias("shard"))
    dealt = staged(state.unionByName(filled), "dealt")
    placed = ranked(dealt, "node", ["shard"], total // shards + 1, salt=1).withColumnRenamed("rank", "slot")
    return rows.join(placed, F.col(row) == F.col("node")).drop("node")


def shard_documents(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """The ``keep`` columns (default: all) of every row with ``size`` (UTF-8 bytes of the text and 1), ``text_crc32``,
    ``shard`` and ``slot``. Equal texts are linked, so copies come together as far as the law of sizes allows. A null
    text has size 1, the CRC of nothing, and no links; empty texts are equal. Repeated rows and null ids are rows like
    others. The rows are written once, without the text unless it is kept."""
    added = ["size", "text_crc32", "shard", "slot"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    data = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = staged(docs.select(*keep, (F.length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
                              F.when(F.col(text).isNotNull(), F.sha2(data, 256)).alias("__group"), F.monotonically_increasing_id().alias("__row")), "rows")
    links = copy_links(rows, "__row", "__group", rows.count())
    return shard_rows(rows, links, "__row", shards=shards, rounds=rounds).select(*keep, *added)

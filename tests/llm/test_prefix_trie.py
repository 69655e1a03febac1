import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm.prefix_trie import conversation_trie, prefix_trie, subtree_sums
from strata.llm.queries import op11_conversation_prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + ts[h:]
    return out


def expected(convs):
    """All prefixes of all conversations in one dictionary."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(int)
    for seq in members:
        if seq:
            children[seq[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for seq, cs in members.items():
        for d in range(len(seq) + 1):
            leaves[seq[:d]] += not children[seq]
            saved[seq[:d]] += (len(cs) - 1) * len(seq[-1][1]) if seq else 0
    return sorted((min(cs), len(seq), min(members[seq[:-1]]) if seq else -1, len(cs), children[seq], leaves[seq], saved[seq],
                   hashlib.sha256(",".join(map(str, sorted(ends[seq]))).encode()).hexdigest()) for seq, cs in members.items())


def got(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(*COLUMNS).collect())


def made(seed=3):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(40), *range(100, 130), 205, 333, 4096, 8192, 10**12, -7, -100, -150]:
        for t in range(rnd.choice([1, 2, 3, 5, 7, 11, 20])):
            rows.append((c, t, rnd.choice(["user", "assistant", None]), rnd.choice([None, "", "hi", "hé", "yo 😀", "long " * 50])))
    rows += [(c, t, "user", f"same {t}") for c in range(500, 600) for t in range(9)]  # a very common conversation
    rows += [(777, None, "user", "first"), (None, 0, "user", "nobody's"), (None, None, None, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)


def test_query_against_brute_force(spark, tmp_path):
    rows = made()
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    assert got(op11_conversation_prefix_trie(spark, str(tmp_path))) == expected(rebuilt(rows))


def test_given_table(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(op11_conversation_prefix_trie(spark, d)) == expected(rebuilt(rows))


@pytest.mark.parametrize("band", [2, 3, 8])
def test_deep_tries_take_several_rounds(spark, band):
    rows = [(0, t, "user", "ab") for t in range(70)] + [(c, t, "user", "ab" if t < 66 - c % 30 else f"x{c}") for c in range(1, 40) for t in range(70)]
    assert got(conversation_trie(frame(spark, rows), band=band)) == expected(rebuilt(rows))


def test_one_conversation_over_many_blocks_and_ranges(spark):
    rows = [(5, t, "u", f"t{t}") for t in range(9000)] + [(c, t, "u", f"t{t}") for c in (1, 9) for t in range(40)]
    found = conversation_trie(frame(spark, rows).withColumn("depth", F.lit("clash")))
    deepest = found.orderBy(F.desc("depth")).first()
    n = len(rebuilt(rows)[5])
    assert (deepest.depth, deepest.conv_id, deepest.n_leaves) == (n, 5, 1)
    top = found.where("depth = 0").first()
    assert found.count() == len({tuple(ts[:d]) for c, ts in rebuilt(rows).items() if c != 5 for d in range(len(ts) + 1)}
                                | {tuple(rebuilt(rows)[5][:d]) for d in range(41)}) + max(0, n - 40)
    assert top.n_convs == 3 and top.parent_conv_id is None


def test_empty_and_turnless(spark):
    assert conversation_trie(frame(spark, [])).collect() == []
    turns = spark.createDataFrame([], "conv long, depth long, t1 long, t2 long, chars long")
    convs = spark.createDataFrame([(3,), (11,)], "conv long")
    assert got(prefix_trie(turns, convs)) == expected({3: [], 11: []})


def test_repeated_rows_and_equal_turns(spark):
    rows = [(100, 0, "u", "a"), (100, 0, "u", "a"), (100, 0, "u", "b"), (102, 1, "u", "x")]
    once = got(conversation_trie(frame(spark, rows)))
    assert once == got(conversation_trie(frame(spark, rows[::-1]))) and sum(r[3] for r in once if r[1] == 0) == 2


def test_subtree_sums_of_a_line(spark):
    chain = spark.range(100).selectExpr("id AS depth", "id AS k1", "0L AS k2", "1L AS conv")
    sums = {r.depth: r.v for r in subtree_sums(chain.withColumn("v", F.lit(1).cast("long")), chain, ["v"], band=3).collect()}
    assert sums == {d: 100 - d for d in range(100)}

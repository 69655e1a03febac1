import random
import re

import xxhash

from pyspark.sql import functions as F

from strata.llm.components import _with_least, components
from strata.llm.queries import op3_simhash_near_dedup
from strata.llm.simhash import near_duplicates, trie_links


def fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def brute(rows):
    prints = {i: fingerprint(t) for i, t in rows}
    ids = list(prints)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if (prints[a] ^ prints[b]).bit_count() <= 2]
    return {i: (f"{prints[i]:016x}", r) for i, r in roots(ids, pairs).items()}


def test_whole_table_against_all_pairs(spark, tmp_path, prose):
    spark.createDataFrame(prose[0], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op3_simhash_near_dedup(spark, str(tmp_path)).collect()}
    assert got == brute(prose[0])


def test_given_table_against_all_pairs(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op3_simhash_near_dedup(spark, d).collect()}
    assert got == brute(rows)


def test_trie_loses_no_link(spark):
    rnd = random.Random(1)
    prints = {rnd.getrandbits(64) for _ in range(150)} | {0, 2**64 - 1, 2**63, 1, 3}
    for p in list(prints):
        for _ in range(3):
            prints.add(p ^ sum(1 << b for b in set(rnd.choices(range(64), k=rnd.randint(1, 4)))))
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed + signed[:20]], "fp long").repartition(4)
    for most in (0, 1, 2, 3):
        want = {frozenset((a, b)) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & (2**64 - 1)).bit_count() <= most}
        got = [frozenset(r) for r in trie_links(df, most).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_no_plan_holds_more_than_one_level_of_the_tries(spark):
    rnd = random.Random(3)
    prints = [rnd.getrandbits(63) for _ in range(100)]
    df = spark.createDataFrame([(p ^ flip,) for p in prints for flip in (0, 1, 1 << 40)], "fp long")
    links = trie_links(df)
    assert links.count() == 300
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 2 and plan.count("Exchange") <= 4 and "HashAggregate" not in plan


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(10, 60)] + [(100, i) for i in range(101, 160)] + [(300, 301), (301, 300), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = roots({x for p in links for x in p}, links)
    assert got == {n: r for n, r in want.items() if n != r}


def test_stars_whose_hub_holds_most_links(spark):
    for hub in (0, 5_000, 20_000):  # the smallest, a middling and the largest node
        links = [(hub, i) if i % 2 else (i, hub) for i in range(1, 10_001) if i != hub] + [(30_000 + i, 30_001 + i) for i in range(40)]
        random.Random(1).shuffle(links)
        got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long").repartition(6)).collect()}
        want = roots({x for p in links for x in p}, links)
        assert got == {n: r for n, r in want.items() if n != r}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_hubs_rows_stay_where_they_are(spark):
    rows = spark.range(0, 10_000, 1, 8).select(F.when(F.col("id") < 9_000, 1).otherwise(F.col("id")).alias("u"), F.col("id").alias("v"))
    least = rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    placed = _with_least(rows, least, 10_000)
    assert placed.groupBy("u").agg(F.min("m").alias("m"), F.count("*").alias("n")).exceptAll(least).count() == 0
    assert max(r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()) <= 1_250


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = [(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (9, "A B C D"), (11, None), (12, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.component) for r in near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, None), (7, 7), (7, 7), (9, 7), (11, 11), (12, 11)], key=str)
    assert near_duplicates(df.limit(0)).collect() == []


def test_one_id_with_different_texts(spark):
    rows = [("1", "alpha beta gamma"), ("1", "other words stand here"), ("2", "other words stand here"), ("3", "lone text by itself")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    found = near_duplicates(df, keep=[df["text"].alias("said")]).collect()
    assert {(r.said, r.component) for r in found} == {(rows[0][1], "1"), (rows[1][1], "1"), (rows[3][1], "3")}
    groups = {r.said: r.group for r in found}
    assert len(set(groups.values())) == 3

import math
import re
from collections import Counter

import xxhash

from strata.llm.queries import op1_quality_rules
from strata.llm.quality_rules import BUCKETS, MIN_RATIO, SLACK, judge

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words, lines = WORD.findall(text or ""), (text or "").split("\n")
    lines = [x for x in lines if WORD.search(x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed)


def buckets(text):
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORD.findall((text or "").lower())]
    pairs = [((a << 1) & (2**64 - 1)) ^ (b >> 3) for a, b in zip(hashes, hashes[1:])]
    return [(h - 2**64 if h >= 2**63 else h) % BUCKETS for h in hashes + pairs]


def ratios(rows, trusted):
    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(buckets(t))
        target.update(buckets(t) if i in trusted else [])
    n, m = sum(raw.values()), sum(target.values())
    weight = [math.log((target[b] + 1) / (m + BUCKETS)) - math.log((raw[b] + 1) / (n + BUCKETS)) if m else 0 for b in range(BUCKETS)]
    return {i: sum(weight[b] for b in buckets(t)) / max(1, len(buckets(t))) for i, t in rows}


def passes(ratio, n_words):
    return ratio >= MIN_RATIO - SLACK / math.sqrt(max(1, 2 * n_words - 1))


def check(result, rows, trusted):
    want, seen = ratios(rows, trusted), 0
    texts = dict(rows)
    for r in result.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(texts[r.doc_id])
        assert abs(r.ratio - want[r.doc_id]) < 1e-9
        assert r.kept == (not r.base_failed and passes(r.ratio, r.n_words))
        seen += 1
    assert seen == len(rows)


def test_query_against_brute_force(spark, tmp_path, prose):
    rows = prose[0] + [(900 + k, ("a b c d e f " * k) + "x y z # * $\n\nx\nx\n \n") for k in range(6)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i % 4 > 0), int(i % 7 == 0)) for i, _ in rows if i % 2] + [(None, 1, 0), (3, 1, 0), (5, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    trusted = {i for i, q, t in labels if q == 1 and not t and i is not None}
    check(op1_quality_rules(spark, str(tmp_path)), rows, trusted)


def test_given_tables(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    trusted = {r.doc_id for r in spark.read.parquet(f"{d}/labels.parquet").where("quality = 1 AND toxic = 0").collect()}
    check(op1_quality_rules(spark, d), rows, trusted)


def test_labelled_documents_are_told_apart(spark):
    d = "/root/testdata/sf0.1"
    found = op1_quality_rules(spark, d).where("NOT base_failed").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in found.groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) == 0 and n[0, False] > 5 * n[0, True]


def test_edge_tables(spark):
    rows = [(None, None, 1.0), (1, "", 1.0), (2, "one two three four five six seven eight nine ten", 1.0), (2, "x", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ratio double")
    none = spark.createDataFrame([], "doc_id long")
    got = judge(df, none)
    assert got.columns[:3] == ["doc_id", "text", "n_words"]
    assert sorted((r.n_words, r.ratio, r.kept) for r in got.collect()) == [(0, 0.0, False), (0, 0.0, False), (1, 0.0, False), (10, 0.0, True)]
    assert judge(df.limit(0), none).collect() == []

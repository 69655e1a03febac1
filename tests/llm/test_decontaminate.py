import hashlib
import random
import re
import weakref

import numpy as np
from pyspark.sql import functions as F

from strata.llm import decontaminate as module
from strata.llm.decontaminate import decontaminate
from strata.llm.fm_index import FMIndex, suffix_order
from strata.llm.queries import op9_benchmark_decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(rows, items):
    windows = {}
    for item, text in items:
        words = WORD.findall(lower(text))
        for i in range(max(1, len(words) - 12) if words else 0):
            windows.setdefault(tuple(words[i:i + 13]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for i, text in rows:
        words, hit, found = WORD.findall(lower(text)), set(), set()
        for size in sizes:
            for a in range(len(words) - size + 1):
                if owners := windows.get(tuple(words[a:a + size])):
                    hit.update(range(a, a + size))
                    found |= owners
        out[i] = (len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                  len(hit) > 0 and 20 * len(hit) >= len(words))
    return out


def result(df):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()}


def test_query_against_brute_force(spark, tmp_path, prose):
    rows, shared = prose
    items = [(1, shared[0]), (2, shared[1].upper()), (30, "one"), (4, None), (5, "!!"), (6, " ".join(shared[2].split()[5:30])),
             (7, shared[0]), (8, "wa0 wb1"), (9, "the of the of the of the of the of the of the of")]
    rows = rows + [(900, "the of " * 40), (901, "one " * 30), (902, shared[2][:200] + " " + shared[0])]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = result(op9_benchmark_decontamination(spark, str(tmp_path)))
    assert got == brute(rows, items) and sum(x[4] for x in got.values()) > 5


def test_given_tables_against_brute_force(spark):
    d = "/root/testdata/sf0.01"
    rows, items = ([tuple(r) for r in spark.read.parquet(f"{d}/{t}.parquet").select(i, "text").collect()]
                   for t, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert result(op9_benchmark_decontamination(spark, d)) == brute(rows, items)


def test_spans_are_code_points_and_shards_do_not_matter(spark, prose, docs):
    bench = spark.createDataFrame([(1, prose[1][0])], "item_id long, text string")
    whole, small = (sorted((r.doc_id, r.n_words, r.n_hit, [tuple(s) for s in r.spans]) for r in
                           decontaminate(docs, bench, shard_bytes=b).collect()) for b in (1 << 22, 100))
    assert whole == small
    texts = dict(prose[0])
    for i, _, hit, spans in whole:
        covered = [w for a, b in spans for w in WORD.findall(lower(texts[i])[a:b])]
        assert len(covered) == hit


def test_edge_tables(spark, docs):
    bench = spark.createDataFrame([(1, "one")], "item_id long, text string")
    got = decontaminate(docs, bench)
    assert got.columns == ["doc_id", "text", "n_words", "n_hit", "items", "spans", "contaminated"]  # the clashing column is left out
    assert decontaminate(docs.limit(0), bench).count() == 0
    assert not decontaminate(docs, bench.limit(0)).where("contaminated OR n_hit > 0").count()
    rows = spark.createDataFrame([(None, "one one"), (3, "one"), (3, "one")], "doc_id long, text string")
    assert [r.n_hit for r in decontaminate(rows, bench).orderBy("doc_id").collect()] == [2, 1, 1]


def test_one_block_of_the_benchmark_is_held_at_a_time(spark, prose, docs, monkeypatch):
    items = [(i, " ".join(prose[1][i % 4].split()[i:])) for i in range(12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(str, decontaminate(docs, bench, keep=["doc_id"]).collect()))
    live, most, build = weakref.WeakSet(), [], module.Phrases.__init__

    def counted(self, *args):
        build(self, *args)
        live.add(self)
        most.append(len(live))

    monkeypatch.setattr(module.Phrases, "__init__", counted)
    monkeypatch.setattr(module, "BLOCK_BYTES", 1000)
    blocks = decontaminate(docs, bench, keep=["doc_id"], shard_bytes=20_000)
    assert len(most) > 5 and max(most) == 1  # on the driver
    assert sorted(map(str, blocks.collect())) == whole
    texts = decontaminate(docs, bench, shard_bytes=20_000).select("doc_id", "text")
    assert sorted(map(str, texts.collect())) == sorted(map(str, docs.select("doc_id", "text").collect()))  # carried through all passes


def test_many_blocks_against_brute_force(spark, prose, docs, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_BYTES", 1500)
    items = [(i, " ".join(prose[1][i % 4].split()[i:])) for i in range(12)] + [(20, None), (21, "two words"), (22, "?!")]
    found = decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"), keep=["doc_id"])
    digest = module.items_digest(F.col("items")).alias("digest")
    got = {r.doc_id: (r.n_words, r.n_hit, len(r["items"]), r.digest, r.contaminated) for r in found.select("*", digest).collect()}
    assert got == brute(prose[0], items)


def test_index_finds_every_occurrence():
    rnd = random.Random(3)
    runs = [[rnd.randint(1, 5) for _ in range(rnd.randint(1, 40))] for _ in range(30)] + [[1] * 50, [2]]
    seq = np.array([x for r in runs for x in [*r, 0]])
    assert sorted(suffix_order(seq).tolist()) == list(range(len(seq)))
    index = FMIndex(seq, 5, sample=7)
    phrases = [[rnd.randint(1, 5) for _ in range(rnd.randint(1, 4))] for _ in range(60)]
    padded = np.array([[0] * (4 - len(p)) + p for p in phrases])
    for p, low, high in zip(phrases, *index.search(padded)):
        want = [i for i in range(len(seq)) if seq[i:i + len(p)].tolist() == p]
        assert sorted(index.locate(np.arange(low, high)).tolist()) == want

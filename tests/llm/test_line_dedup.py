import hashlib
import re

import duckdb
import numpy as np

from strata.llm import line_dedup
from strata.llm.cuckoo import CuckooFilter
from strata.llm.line_dedup import LineIndex, deduplicate_lines
from strata.llm.queries import ORACLE, op8_line_dedup


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line).strip(" \t\n\x0b\x0c\r")


def kept(rows, least=5):
    """The rows with the lines that stay."""
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(i)
    return [(i, "\n".join(x for x in (text or "").split("\n") if len(holders.get(key(x), ())) < least or i == max(holders[key(x)])))
            for i, text in rows]


def brute(rows, least=5):
    out = {}
    for (i, text), (_, new) in zip(rows, kept(rows, least)):
        lines = (text or "").split("\n")
        gone = [x for x in lines if x not in new.split("\n")]
        out[i] = (len(lines), len(gone), hashlib.sha256(new.encode()).hexdigest())
    return out


def result(df):
    return {r.doc_id: (r.n_lines, r.n_dropped, hashlib.sha256((r.kept_text or "").encode()).hexdigest()) for r in df.collect()}


def test_query_and_sql_against_brute_force(spark, tmp_path, prose):
    spark.createDataFrame(prose[0], "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want = brute(prose[0])
    assert sum(x[1] for x in want.values()) > 10
    assert {r[0]: tuple(r)[1:] for r in op8_line_dedup(spark, str(tmp_path)).collect()} == want
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert {r[0]: tuple(r[1:]) for r in con.sql(ORACLE["op8_line_dedup"]).fetchall()} == want


def test_insert_and_delete_are_reversible(spark, prose):
    rows = prose[0]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    first, late = df.where("doc_id % 3 <> 0"), df.where("doc_id % 3 = 0")
    start = LineIndex.build(first)
    grown = start.insert(late)
    assert result(grown.deduplicate(df)) == brute(rows)
    back = grown.delete(late.select("doc_id"))
    some = [r for r in rows if r[0] % 3]
    assert result(back.deduplicate(first)) == brute(some)
    assert sorted((r.k1, r.k2, r.n_docs, r.last_doc) for r in back.refs.collect()) == sorted((r.k1, r.k2, r.n_docs, r.last_doc) for r in start.refs.collect())
    held = {bytes(r.filter) for r in back.filters.collect()}
    assert all(CuckooFilter(0, f).may_hold(np.array([r.k1 for r in back.refs.collect()])).all() for f in held)
    again = back.insert(late)  # ids that were taken out come in again
    assert result(again.deduplicate(df)) == brute(rows)


def test_an_index_grows_from_a_tiny_one_and_back(spark, monkeypatch):
    """Shards are halved, filters built again, parts put together; deletes lead back to the start."""
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 40)
    monkeypatch.setattr(line_dedup, "SCREEN_ROWS", 16)
    monkeypatch.setattr(line_dedup, "PARTS", 3)

    def text(i):
        return "\n".join(f"line number {j} of at least forty code points, repeated" for j in range(i, i + 12))

    rows = [(i, text(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    start = LineIndex.build(df.where("doc_id < 6"))
    assert start.shards == 1
    index = start
    for lo, hi in ((6, 7), (7, 20), (20, 60), (60, 100)):
        index = index.insert(df.where(f"doc_id >= {lo} AND doc_id < {hi}"))
    assert index.shards > 1 and len(index.parts) <= 3 and result(index.deduplicate(df)) == brute(rows)
    for r in index.filters.collect():
        assert len(CuckooFilter(0, bytes(r.filter)).beside) == 0
    for lo, hi in ((50, 100), (6, 50)):
        index = index.delete(df.where(f"doc_id >= {lo} AND doc_id < {hi}").select("doc_id"))
    key = lambda r: (r.k1, r.k2, r.n_docs, r.last_doc)
    assert sorted(map(key, index.refs.collect())) == sorted(map(key, start.refs.collect()))
    first = df.where("doc_id < 6")
    assert result(index.deduplicate(first)) == brute(rows[:6])


def test_a_change_reads_only_the_buckets_it_touches(spark):
    rows = [(i, f"a line of its own with more than forty code points {i % 7}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    index = LineIndex.build(df)
    plan = index.postings([3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan
    assert index.delete(df.where("doc_id > 1000").select("doc_id")).refs is index.refs  # nothing is touched


def test_cuckoo_filter_inserts_deletes_and_overflows():
    rnd = np.random.default_rng(2)
    keys = rnd.integers(-2**63, 2**63 - 1, 3000)
    f = CuckooFilter(500)  # far too small: the rest lies beside the table
    f.insert(keys)
    f = CuckooFilter(0, f.to_bytes())
    assert f.may_hold(keys).all()
    f.delete(keys[:2000])
    assert f.may_hold(keys[2000:]).all()
    f.delete(keys[2000:])
    assert not f.table.any() and not f.beside
    g = CuckooFilter(3000)
    g.insert(keys)
    assert g.may_hold(rnd.integers(-2**63, 2**63 - 1, 20000)).mean() < 0.01


def test_null_ids_repeated_rows_clashing_columns_and_empty_table(spark):
    line = "a line of at least forty code points, with blanks"
    rows = [(None, line, 1), (1, line, 1), (1, line, 1), (2, f"{line}\nx", 1), (3, f" {line.upper()}\t", 1), (4, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_dropped int")
    got = deduplicate_lines(df)
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped", "kept_text"]
    assert sorted(((r.doc_id, r.n_dropped, r.kept_text) for r in got.collect()), key=str) == sorted(
        [(None, 1, ""), (1, 1, ""), (1, 1, ""), (2, 1, "x"), (3, 0, f" {line.upper()}\t"), (4, 0, None)], key=str)
    assert deduplicate_lines(df.limit(0)).collect() == []

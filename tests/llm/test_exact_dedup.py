import hashlib
import re

from pyspark.sql import functions as F

from strata.llm import exact_dedup
from strata.llm.exact_dedup import exact_duplicates
from strata.llm.queries import op12_exact_dedup


def normal(text):
    return re.sub("[ \t-\r]", "", text or "")


def expected(rows):
    """By all texts at once: id, keep_id, size, kept (rows with distinct ids)."""
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append((-len(t or ""), i is None, i if i is not None else 0, i))
    out = []
    for i, t in rows:
        group = groups[normal(t)]
        out.append((i, min(group)[3], len(group), min(group)[3] == i))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()), key=str)


def test_query_against_brute_force(spark, prose, tmp_path):
    texts = [t for _, t in prose[0]]
    texts += [t and t.replace(" ", "  ") for t in texts[::4]] + [" ", "a b", "ab", "a b", "a\x0bb", "\x1ca b"] + ["copy of all"] * 200
    head = "same beginning " * 10
    texts += [head + "one", head + "two", head + "one ", head + "three"] + ["y" * 70_000 + c for c in "aabc"]
    rows = list(enumerate(texts))
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    result = op12_exact_dedup(spark, str(tmp_path))
    assert got(result) == expected(rows)
    assert {r.doc_id: r.text_sha256 for r in result.collect()} == {i: hashlib.sha256(normal(t).encode()).hexdigest() for i, t in rows}


def test_whole_texts_are_hashed_for_shared_beginnings_only(spark, monkeypatch):
    """Rows with a length or a beginning of their own never reach the last step."""
    tables = {}
    keep = exact_dedup.staged
    monkeypatch.setattr(exact_dedup, "staged", lambda df, name: tables.setdefault(name, keep(df, name)))
    rows = [(0, "own length here"), (1, "aaaa bbbb"), (2, "cccc dddd"), (3, "twin"), (4, "tw in")]
    exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert tables["texts"].count() == 5 and sorted(r.id for r in tables["hashed"].collect()) == [3, 4]


def test_odd_rows(spark):
    rows = [(None, "a", 1), (None, "a ", 2), (7, "a", 3), (7, "a", 3), (None, None, 4), (None, " ", 5), (9, "solo", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int").withColumn("id", F.lit("x")).withColumn("row", F.lit(0))
    found = exact_duplicates(df)
    assert found.columns == ["doc_id", "text", "id", "row", "keep_id", "group_size", "kept"]
    out = {(r.text, r.doc_id, r.kept): (r.keep_id, r.group_size) for r in found.collect()}
    assert out[("a ", None, True)] == (None, 4) and out[("a", 7, False)] == (None, 4)  # most code points stay, although the id is null
    assert out[(" ", None, True)] == (None, 2) and out[("solo", 9, True)] == (9, 1)
    assert sum(r.kept for r in found.collect()) == 3
    repeated = exact_duplicates(spark.createDataFrame([(7, "b"), (7, "b"), (None, "b")], "doc_id long, text string")).collect()
    assert sorted((r.keep_id, r.kept) for r in repeated) == [(7, False), (7, False), (7, True)]


def test_empty_table_and_text_ids(spark):
    assert exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = spark.createDataFrame([("b", "t t"), ("a", "tt "), ("c", "t t")], "name string, body string")
    assert {(r.name, r.keep_id, r.kept) for r in exact_duplicates(df, id="name", text="body").collect()} == {("a", "a", True), ("b", "a", False), ("c", "a", False)}

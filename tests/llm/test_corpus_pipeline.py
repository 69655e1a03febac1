from collections import defaultdict

import corpus_pipeline
import test_decontaminate
import test_line_dedup
import test_packing
import test_quality_rules
import test_simhash

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows, trusted, items):
    """(doc_id, text) of the documents that each stage keeps, by the operators' brute-force versions."""
    ratio = test_quality_rules.ratios(rows, trusted)
    rows = [(i, t) for i, t in rows if not (b := test_quality_rules.base(t))[5] and test_quality_rules.passes(ratio[i], b[0])]
    yield rows
    rows = test_line_dedup.kept(rows)
    yield rows
    groups = test_simhash.brute(rows)
    rows = [(i, t) for i, t in rows if groups[i][1] == i]
    yield rows
    hit = test_decontaminate.brute(rows, items)
    yield [(i, t) for i, t in rows if not hit[i][4]]


def run_stages(spark, docs, sf_dir, tmp_path):
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        yield name, docs


def test_stages_against_brute_force(spark, tmp_path, prose):
    rows, shared = prose
    rows = rows + [(900, shared[1] + " tail"), (901, " ".join(f"w{chr(97 + i % 26)}{i}" for i in range(20)) + " " + shared[0][:150])]
    items = [(1, shared[1]), (2, shared[0][:140])]
    labels = [(i, int(i % 4 > 0), 0) for i, _ in rows if i % 2]
    spark.createDataFrame([(i, t, "en", None, len(t or "")) for i, t in rows], COLUMNS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    wanted = list(brute(rows, {i for i, q, _ in labels if q}, items))
    assert len({len(w) for w in wanted}) >= 3  # stages take effect
    for (name, got), want in zip(run_stages(spark, docs, str(tmp_path), f"{tmp_path}/out"), [*wanted, None]):
        if want is not None:
            assert got.columns == docs.columns
            assert sorted((r.doc_id, r.text, r.n_chars) for r in got.collect()) == sorted((i, t, len(t)) for i, t in want), name
    last = [r.asDict() for r in got.collect()]
    test_packing.check_pieces(wanted[-1], last)
    again = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in got.collect())


def test_nulls_repeats_and_extra_columns(spark, tmp_path):
    text = "ten words of plain text stand here for a test row"
    rows = [(None, text, 1), (5, text, 2), (5, text, 2), (6, None, 3), (7, text + " and some more words that differ from the others", 4)]
    docs = spark.createDataFrame([(i, t, None, None, None, k) for i, t, k in rows], COLUMNS + ", kept int")  # a clashing name
    for t, schema in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{t}.parquet")
    results = dict(run_stages(spark, docs, str(tmp_path), f"{tmp_path}/out"))
    assert sorted(r.kept for r in results["quality_rules"].collect()) == [1, 2, 2, 4]
    assert sorted(r.kept for r in results["benchmark_decontamination"].collect()) == [1, 2, 4]
    by = defaultdict(int)
    for r in results["packing"].collect():
        by[r.doc_id] += r.length
    assert set(by) == {None, 5, 7}


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], COLUMNS)
    for t, schema in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{t}.parquet")
    assert all(not df.count() for _, df in run_stages(spark, docs, str(tmp_path), f"{tmp_path}/out"))


def test_different_texts_under_one_id_stay(spark):
    rows = [(1, "first text of its own kind here"), (1, "second text that says other things"), (2, "third text about nothing at all"),
            (1, "second text that says other things"), (5, "second text that says other things")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], COLUMNS)
    kept = corpus_pipeline.simhash_near_dedup(spark, docs, "")
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(rows[:3])

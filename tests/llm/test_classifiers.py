import math
import zlib

import numpy as np
import pyarrow as pa

from strata.llm import langid
from strata.llm.common import chunks
from strata.llm.quality_classifier import BINS, N_STATS, RIDGE, FourierMap, score_quality, statistics
from strata.llm.queries import op6_quality_classifier, op7_language_id

D = "/root/testdata/sf0.1"


def test_quality_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{D}/labels.parquet").collect()}
    rows = op6_quality_classifier(spark, D).collect()
    assert len(rows) == spark.read.parquet(f"{D}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = ([s for s, _, y in held if y == want] for want in (1, 0))
    auc = sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.98 and sum(p == y for _, p, y in held) > 0.97 * len(held)


def test_statistics_of_a_text():
    text = "Ab ab ab\nAb ab ab\n12 #x é."
    names = statistics(pa.array([text, None, "", "z" * 100_000]))
    assert names.shape == (4, N_STATS) and np.isfinite(names).all()
    size, words, lines = len(text.encode()), text.split(), text.split("\n")
    x = names[0]
    assert np.allclose(x[:3], [math.log1p(size), math.log1p(len(words)), sum(len(w.encode()) for w in words) / len(words)])
    assert np.allclose(x[6:13], [sum(map(ok, text.encode())) / size for ok in (
        lambda b: 97 <= b <= 122, lambda b: 65 <= b <= 90, lambda b: 48 <= b <= 57, lambda b: b in b"#*$%&|<>", lambda b: b in b".,;:!?",
        lambda b: b == 10, lambda b: b >= 128)])
    assert np.isclose(x[13], len(set(words)) / len(words)) and np.isclose(x[15], 2 / len(words)) and np.isclose(x[19], 2 / len(lines))
    assert (names[1] == names[2]).all()


def test_statistics_do_not_depend_on_neighbours(prose):
    texts = [t for _, t in prose[0]]
    whole = statistics(pa.array(texts))
    assert np.allclose(whole, np.concatenate([statistics(pa.array([t], pa.string())) for t in texts]))


def pooled(x, y, weight):
    """Adjacent violators pooled: knots of the non-decreasing step function, ends of each block."""
    blocks = []
    for a, b, w in sorted(zip(x, y, weight)):
        blocks.append([a, a, b, w])
        while len(blocks) > 1 and blocks[-2][2] >= blocks[-1][2]:
            _, hi, v, w = blocks.pop()
            last = blocks[-1]
            blocks[-1] = [last[0], hi, (last[2] * last[3] + v * w) / (last[3] + w), last[3] + w]
    return [k for lo, hi, _, _ in blocks for k in (lo, hi)], [v for _, _, v, _ in blocks for _ in (0, 1)]


def test_quality_against_plain_ridge_and_pooling(spark):
    rnd = np.random.default_rng(4)
    docs, labels = [], []
    for i in range(400):
        good = int(rnd.random() < 0.5)
        words = rnd.choice(["alpha", "beta", "gamma", "delta.", "Epsilon", "#x", "12"] if rnd.random() < 0.8 == good else ["zz", "$$", "%", "alpha", "1 2"], 30 + i % 50)
        docs.append((i, " ".join(words)))
        labels += [(i, good)] * (2 if i % 7 == 0 else 1)  # repeated labels count each
    got = {r.doc_id: r.score for r in score_quality(spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                                                   spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    x = dict(zip((i for i, _ in docs), statistics(pa.array([t for _, t in docs]))))
    part = lambda i: zlib.crc32(str(i).encode()) % 5
    fit = [(x[i], y) for i, y in labels if part(i) in (1, 2, 3)]
    rows, y = np.array([a for a, _ in fit]), np.array([b for _, b in fit], float)
    fourier = FourierMap(rows.mean(0), rows.std(0), 256)
    z = np.stack([np.append(np.sqrt(2 / 256) * np.cos(np.clip((r - fourier.mean) / fourier.spread, -5, 5) @ fourier.w + fourier.b), 1) for r in rows])
    w = np.linalg.solve(z.T @ z + RIDGE * len(y) / 256 * np.eye(257), z.T @ y)
    raw = {i: float(fourier(v[None])[0] @ w) for i, v in x.items()}
    bins = {}
    for i, label in labels:
        if part(i) == 4:
            bins.setdefault(math.floor(min(max(raw[i], -0.5), 1.5) * BINS / 2) * 2 / BINS, []).append(label)
    knots = pooled(bins, (np.mean(v) for v in bins.values()), map(len, bins.values()))
    want = {i: float(np.clip(np.interp(v, *knots), 0, 1)) for i, v in raw.items()}
    assert len(set(want.values())) > 3 and max(abs(got[i] - want[i]) for i in want) < 1e-5


def test_quality_edge_tables(spark):
    docs = spark.createDataFrame([(None, None, "x"), (1, "", "x"), (1, "", "x"), (2, "a b", "x")], "doc_id long, text string, quality string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in score_quality(docs, none).collect()] == [0.5] * 4
    some = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, 1), (None, 1), (4, None)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in score_quality(docs, some).collect())
    assert score_quality(docs.limit(0), some).collect() == []


def test_language_on_held_out_rows(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op7_language_id(spark, D).collect()
    assert len(rows) == len(langs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) > 0.99 * len(held) and {r.lang_pred for r in rows} <= set(langs.values())


def test_ngrams_against_a_plain_count():
    texts = ["Abcab", None, "é!", "xy", "a", "a1 b%%% &&& ***", "%%%", "x\n y"]
    got = langid.ngram_counts(pa.array(texts))
    for text, row in zip(texts, got):
        data, want = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in (text or "").lower().encode()), np.zeros(langid.BUCKETS, int)
        for size in (2, 3):
            for i in range(len(data) - size + 1):
                if not data[i:i + size].strip(b" "):
                    continue
                gram = 0
                for b in data[i:i + size]:
                    gram = gram * 257 + b
                want[((gram * 2654435761) % 2**32) >> 20] += 1
        assert (row == want).all()


def test_chunks_bound_bytes_and_rows():
    texts = ["a" * n for n in (0, 0, 5, 3, 9, 0, 40, 1, 1, 1)] + [None] * 5
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["t"])
    for limit, rows in ((10, 100), (10, 3), (1, 1), (1000, 4)):
        parts = list(chunks(batch, "t", limit, rows))
        assert [x for p in parts for x in p.column(0).to_pylist()] == texts
        assert all(p.num_rows <= rows and (p.num_rows == 1 or sum(len(x or "") for x in p.column(0).to_pylist()) <= limit) for p in parts)


def test_language_edge_tables(spark):
    rows = [(1, "alpha beta gamma delta", "aa"), (2, "omega psi chi phi", "bb"), (3, None, "aa"), (4, "12 34", "bb"), (None, "alpha beta", None), (1, "alpha", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_centroids(docs)
    assert [set(m["langs"]) for m in model] == [{"aa", "bb"}]
    got = langid.identify(docs.withColumnRenamed("lang", "score"), model)
    assert got.columns == ["doc_id", "text", "nearest", "score", "rejected", "lang_pred"]
    near = {(r.doc_id, r.text): (r.nearest, r.score) for r in got.collect()}
    assert near[1, rows[0][1]][0] == "aa" and near[2, rows[1][1]][0] == "bb" and near[None, "alpha beta"][0] == "aa"
    assert near[3, None] == near[4, "12 34"] == ("und", 0.0)
    assert langid.fit_centroids(docs.limit(0)) is None and langid.identify(docs.limit(0), model).collect() == []
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}


def test_many_languages_go_in_blocks_and_ties_to_the_first(spark, monkeypatch):
    monkeypatch.setattr(langid, "BLOCK_LANGUAGES", 2)
    words = ["alpha", "bravo", "charlie", "delta", "echo"]
    rows = [(i, f"{w} {w}s", f"l{i}") for i, w in enumerate(words)] + [(7, "alpha alphas", "l9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_centroids(docs)
    assert [m["langs"] for m in model] == [["l0", "l1"], ["l2", "l3"], ["l4", "l9"]]
    near = {r.text: r.nearest for r in langid.identify(docs, model).collect()}
    assert near == {f"{w} {w}s": f"l{i}" for i, w in enumerate(words)}  # l0 and l9 are alike


def test_centroids_against_brute_force(spark):
    """IDF, weights, and the nearest centroid of one text per language: with one text each a centroid is that text."""
    texts = ["the cat sat on the mat", "le chat est sur la table", "die katze ist auf dem tisch"]
    docs = spark.createDataFrame([(i, t, f"l{i}") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    model, = langid.fit_centroids(docs)
    counts = langid.ngram_counts(pa.array(texts))
    idf = np.log(4 / (1 + (counts > 0).sum(0))) + 0.1
    v = np.log1p(counts) * idf
    v /= np.linalg.norm(v, axis=1)[:, None]
    assert np.allclose(model["idf"], idf) and np.allclose(model["centres"], v, atol=1e-6)
    others = ["the mat", "la table est", "auf dem"]
    w = np.log1p(langid.ngram_counts(pa.array(others))) * idf
    cosine = (w / np.linalg.norm(w, axis=1)[:, None]) @ v.T
    got = sorted((r.doc_id, r.nearest, r.score) for r in langid.identify(spark.createDataFrame(list(enumerate(others)), "doc_id long, text string"), [model]).collect())
    assert [(i, f"l{c.argmax()}") for i, c in enumerate(cosine)] == [x[:2] for x in got] and np.allclose([x[2] for x in got], cosine.max(1), atol=1e-5)

import random

import pytest

from strata.operators import evaluate


def _brute_auc(ys, ss):
    pos = [s for y, s in zip(ys, ss) if y == 1]
    neg = [s for y, s in zip(ys, ss) if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def scored(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(800):
        y = 1 if rnd.random() < 0.35 else 0
        s = round(min(1.0, max(0.0, rnd.gauss(0.6 if y else 0.4, 0.2))), 2)  # ties on purpose
        rows.append((i, y, s, int(s >= 0.5)))
    return rows, spark.createDataFrame(rows, "k int, label int, score double, pred int")


def test_auc_matches_brute_force(scored):
    rows, df = scored
    got = evaluate.roc_auc(df).first()["roc_auc"]
    assert abs(got - _brute_auc([r[1] for r in rows], [r[2] for r in rows])) < 1e-12


def test_auc_flip_symmetry(scored, spark):
    rows, df = scored
    a = evaluate.roc_auc(df).first()["roc_auc"]
    b = evaluate.roc_auc(df.selectExpr("label", "1 - score AS score")).first()["roc_auc"]
    assert abs(a + b - 1.0) < 1e-12


def test_confusion_sums_and_metrics(scored):
    rows, df = scored
    cells = {(r["label"], r["pred"]): r["n"] for r in evaluate.confusion_matrix(df).collect()}
    assert sum(cells.values()) == len(rows)
    tp, fp, fn = cells[(1, 1)], cells[(0, 1)], cells[(1, 0)]
    m = evaluate.binary_metrics(df).first()
    assert abs(m["precision"] - tp / (tp + fp)) < 1e-12 and abs(m["recall"] - tp / (tp + fn)) < 1e-12


def test_one_class_predictions_give_zeros(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 0)], "label int, pred int")
    m = evaluate.binary_metrics(df).first()
    assert (m["precision"], m["recall"], m["f1"]) == (0.0, 0.0, 0.0)


def test_threshold_sweep_matches_direct_count(scored):
    rows, df = scored
    sweep = {r["i"]: r for r in evaluate.threshold_sweep(df).collect()}
    n = len(rows)
    P = sum(r[1] for r in rows)
    for i in (0, 10, 37, 50, 73, 99):
        t = i / 99.0
        tp = sum(1 for r in rows if r[2] >= t and r[1] == 1)
        pp = sum(1 for r in rows if r[2] >= t)
        if pp in (0, n):
            assert sweep[i]["precision"] == 0.0
        else:
            assert abs(sweep[i]["precision"] - tp / pp) < 1e-12
            assert abs(sweep[i]["recall"] - tp / P) < 1e-12
    best = [r for r in sweep.values() if r["is_best"]]
    assert len(best) == 1 and best[0]["f1"] == max(r["f1"] for r in sweep.values())


def test_curves_end_points(scored):
    _, df = scored
    roc = evaluate.roc_curve(df).collect()
    assert max(r["fpr"] for r in roc) == 1.0 and max(r["tpr"] for r in roc) == 1.0
    pr = evaluate.pr_curve(df).collect()
    assert any(r["threshold"] is None and r["precision"] == 1.0 and r["recall"] == 0.0 for r in pr)


def test_class_report_rows(scored):
    _, df = scored
    rep = {r["class"]: r for r in evaluate.classification_report(df).collect()}
    assert set(rep) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert rep["macro avg"]["support"] == rep["weighted avg"]["support"] == 800


def test_roc_drop_intermediate_matches_numpy_rule(scored):
    import numpy as np
    rows, df = scored
    full = [r for r in evaluate.roc_curve(df).collect() if r["threshold"] is not None]
    full.sort(key=lambda r: -r["threshold"])
    fps = np.array([r["fpr"] for r in full])
    tps = np.array([r["tpr"] for r in full])
    keep = np.where(np.r_[True, np.logical_or(np.abs(np.diff(fps, 2)) > 1e-12,
                                              np.abs(np.diff(tps, 2)) > 1e-12), True])[0]
    want = sorted(full[i]["threshold"] for i in keep)
    got = sorted(r["threshold"] for r in evaluate.roc_curve(df, drop_intermediate=True).collect()
                 if r["threshold"] is not None)
    assert got == want and len(got) < len(full)

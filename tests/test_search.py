import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import evaluate, linear, models, perceptron, search, split, trees
from strata.operators.linear import Kernel, LinearFit, Map, fit_linear
from strata.operators.perceptron import Net, fit_perceptrons
from strata.operators.trees import Growth, Matrix, View, grow_boosted, grow_forests

FEATURES = ["x1", "x2", "x3", "x4", "x5"]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(700).selectExpr("id AS k", "rand(1) AS x1", "rand(2) AS x2", "randn(3) AS x3", "cast(id % 4 AS double) AS x4",
                                     "CASE WHEN id % 9 = 0 THEN NULL ELSE rand(5) END AS x5")
    p = 1 / (1 + F.exp(-(6 * F.col("x1") - 3 + 2 * F.col("x3") * (F.col("x2") - 0.5) + F.coalesce("x5", F.lit(2.0)))))
    df = df.withColumn("label", (F.rand(7) < p).cast("int"))
    df = split.assign_folds(df, "k", "label", k=3)
    path = f"{spark.conf.get('spark.checkpoint.dir')}/search-rows"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def one(rows):
    return Matrix.build(rows, FEATURES, "k")


@pytest.fixture(scope="module")
def several(rows):
    return Matrix.build(rows, FEATURES, "k", partitions=3)


@pytest.fixture(scope="module")
def block(one):
    return one.blocks.collect()[0]


def same(a, b):
    return len(a.trees) == len(b.trees) and all(
        np.array_equal(s["feature"], t["feature"]) and np.allclose(s["threshold"], t["threshold"]) and np.allclose(s["value"], t["value"]) for s, t in zip(a.trees, b.trees))


def test_a_pass_over_many_partitions_gives_the_same_trees(one, several, monkeypatch):
    assert one.parts == 1 and several.parts == 3
    growths = [Growth("forest", 4, 5, 0), Growth("extra", 3, 4, -1), Growth("forest", 2, 4, 1, min_leaf=4)]
    assert all(same(a, b) for a, b in zip(grow_forests(one, growths), grow_forests(several, growths)))
    monkeypatch.setattr(trees, "STORE_ROUNDS", 2)
    monkeypatch.setattr(trees, "SUMS_BYTES", 4000)
    growths = [Growth("second_order", 5, 3, 0, rows=0.8, columns=0.8), Growth("boosting", 3, 2, 1)]
    for a, b in zip(grow_boosted(one, growths), grow_boosted(several, growths)):
        assert a.start == pytest.approx(b.start) and same(a, b)


def test_views_are_the_fits_themselves(one, block):
    whole = grow_forests(one, [Growth("forest", 6, None, 0, min_leaf=2)])[0]
    part = grow_forests(one, [Growth("forest", 4, 3, 0, min_leaf=2)])[0]
    assert np.allclose(whole.scores(block.x, View(4, 3)), part.scores(block.x))
    cut = whole.at(View(5, 4, 30))
    assert np.allclose(whole.scores(block.x, View(5, 4, 30)), cut.scores(block.x)) and len(cut.trees) == 5
    assert all((t["n"][t["feature"] >= 0] >= 30).all() for t in cut.trees)
    for kind in ("boosting", "second_order"):
        long, short = grow_boosted(one, [Growth(kind, 12, 3, 1, rows=0.9), Growth(kind, 7, 3, 1, rows=0.9)])
        assert np.allclose(long.scores(block.x, View(7)), short.scores(block.x))


def brute_extra(block, growth, tree, x, y):
    """One extremely randomised tree, node by node."""
    def node(rows, path, depth):
        n, k = len(rows), y[rows].sum()
        if depth == growth.depth or n < 2 or k in (0, n):
            return k / n
        p = x.shape[1]
        m = max(1, int(math.sqrt(p)))
        draw = trees.mixed(np.array([path * 1009 + f for f in range(p)], np.uint64), growth.seed, tree, 5)
        best = (1e-12, None, None)
        for f in sorted(np.argsort(draw, kind="stable")[:m].tolist()):
            v = x[rows, f]
            seen = v[~np.isnan(v)]
            if not len(seen):
                continue
            u = trees.mixed(np.array([path * 1009 + f], np.uint64), growth.seed, tree, 7)[0]
            t = seen.min() + u * (seen.max() - seen.min())
            left = rows[v <= t]
            right = rows[~(v <= t)]
            if len(left) and len(right):
                gini = lambda r: 2 * y[r].sum() * (len(r) - y[r].sum()) / len(r)
                gain = gini(rows) - gini(left) - gini(right)
                if gain > best[0] and not math.isclose(gain, best[0], rel_tol=1e-12):
                    best = (gain, f, t)
        if best[1] is None:
            return k / n
        go = x[rows, best[1]] <= best[2]
        return best[1], best[2], node(rows[go], path * 2, depth + 1), node(rows[~go], path * 2 + 1, depth + 1)

    def walk(t, r):
        while isinstance(t, tuple):
            t = t[2] if r[t[0]] <= t[1] else t[3]
        return t

    root = node(np.flatnonzero(block.fold != growth.fold), 1, 0)
    return np.array([walk(root, r) for r in x])


def test_extra_trees_against_brute_force(one, block):
    growth = Growth("extra", 3, 6, 2)
    grown = grow_forests(one, [growth])[0]
    for i, tree in enumerate(grown.trees):
        assert np.allclose(brute_extra(block, growth, i, block.x, block.y), tree["value"][trees.walked(tree, block.x)])


def test_second_order_leaves_are_sums(spark, rows, one):
    growth = Growth("second_order", 1, 2, 0, rate=0.3, penalty=2.0)
    model = grow_boosted(one, [growth])[0]
    tree, start = model.trees[0], model.start
    own = rows.where("fold <> 0")
    assert start == pytest.approx(math.log(own.agg(F.avg("label")).first()[0] / (1 - own.agg(F.avg("label")).first()[0])))

    @F.pandas_udf("long")
    def leaf(*cols):
        import pandas as pd
        return pd.Series(trees.walked(tree, np.stack([c.to_numpy(float) for c in cols], 1)))

    p = 1 / (1 + math.exp(-start))
    sums = own.groupBy(leaf(*FEATURES).alias("leaf")).agg(F.sum(F.col("label") - p).alias("g"), (F.count("*") * p * (1 - p)).alias("h")).collect()
    assert 2 <= len(sums) <= 4
    for r in sums:
        assert tree["value"][r.leaf] == pytest.approx(0.3 * r.g / (r.h + 2.0))
    # the root's gain is the best over all cuts of all features, missing values on either side
    gains = []
    for c in FEATURES:
        cuts = [float(v) for v in one.edges[FEATURES.index(c)]]
        per = own.select(*(F.sum(F.when(cond, F.col("label") - p).otherwise(0.0)).alias(f"g{i}_{s}") for i, cut in enumerate(cuts) for s, cond in
                           ((0, F.col(c) <= cut), (1, (F.col(c) <= cut) | F.col(c).isNull()))),
                         *(F.count_if(cond).alias(f"n{i}_{s}") for i, cut in enumerate(cuts) for s, cond in ((0, F.col(c) <= cut), (1, (F.col(c) <= cut) | F.col(c).isNull())))).first()
        n, g, h = own.count(), own.agg(F.sum(F.col("label") - p)).first()[0], p * (1 - p)
        for i in range(len(cuts)):
            for s in (0, 1):
                gl, nl = per[f"g{i}_{s}"], per[f"n{i}_{s}"]
                if nl * h >= 1 and (n - nl) * h >= 1:
                    gains.append(0.5 * (gl ** 2 / (nl * h + 2) + (g - gl) ** 2 / ((n - nl) * h + 2) - g ** 2 / (n * h + 2)))
    assert tree["gain"][0] == pytest.approx(max(gains))


def test_forest_and_boosting_rank_like_mllib(rows, one):
    ours = search.cross_validated(one, [("random_forest", search.MODELS["random_forest"]), ("gradient_boosting", {"n_estimators": 50, "max_depth": 3})], folds=3)
    filled = rows.fillna(2.0)
    from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
    for est, (name, aucs) in zip((RandomForestClassifier(numTrees=100, maxDepth=10, seed=1), GBTClassifier(maxIter=50, maxDepth=3, stepSize=0.1, seed=1)),
                                 ((k[0], v) for k, v in ours.items())):
        _, mean, _ = models.cross_validate(est, filled, FEATURES)
        assert abs(mean[0] - np.mean(aucs)) < 0.03, name


def test_linear_fits_are_optima(one, several, block):
    fits = [LinearFit(cost=0.5, fold=0), LinearFit(cost=2.0, penalty="l1", fold=1), LinearFit("hinge", 1.0), LinearFit("hinge", 1.0, kernel=Kernel("rbf", "scale"))]
    found = fit_linear(one, fits)
    for a, b in zip(found, fit_linear(several, fits)):
        assert np.allclose(a.weights, b.weights, atol=1e-4)
    x = np.nan_to_num(block.x)
    for m in found[:2]:
        used = block.fold != m.fold
        z = np.c_[x[used], np.ones(used.sum())]
        slope = m.fit.cost * z.T @ (1 / (1 + np.exp(-z @ m.weights)) - block.y[used])
        if m.fit.penalty == "l2":
            assert np.abs(slope + np.r_[m.weights[:-1], 0]).max() < 1e-2
        else:
            w = m.weights[:-1]
            assert (np.abs(slope[:-1]) <= 1 + 1e-2).all() and np.allclose(slope[:-1][w != 0], -np.sign(w[w != 0]), atol=1e-2)


def test_kernel_maps_approximate_kernels():
    points = np.random.default_rng(4).normal(0, 0.6, (12, 4))
    rbf = Map(Kernel("rbf", 0.5, size=4000), 4)(points)
    far = ((points[:, None] - points) ** 2).sum(2)
    assert np.abs(rbf @ rbf.T - np.exp(-0.5 * far)).max() < 0.06
    poly = Map(Kernel("poly", 0.3, degree=3, shift=0.5, size=8192), 4)(points)
    assert np.abs(poly @ poly.T - (0.3 * points @ points.T + 0.5) ** 3).max() < 0.06
    assert len(search.grid("svm")) == 24 and len(search.grid("neural_network")) == 36 and len(search.grid("random_forest")) == 108


def test_sigmoid_matches_logistic_regression(spark):
    margins = spark.range(400).selectExpr("cast(id - 200 AS double) / 7 AS score", "cast(rand(3) < 1 / (1 + exp(-(id - 180) / 30.0)) AS long) AS pos").selectExpr("score", "pos", "1 - pos AS neg")
    a, b = linear.fit_sigmoid(margins)
    rows = margins.collect()
    ones = sum(r.pos for r in rows)
    goal = {1: (ones + 1) / (ones + 2), 0: 1 / (len(rows) - ones + 2)}
    miss = [(1 / (1 + math.exp(-(a * r.score + b))) - goal[r.pos], r.score) for r in rows]
    assert abs(sum(d for d, _ in miss)) < 1e-3 and abs(sum(d * s for d, s in miss)) < 1e-2
    wide = margins.selectExpr("score * 1000 AS score", "pos", "neg")
    assert linear.fit_sigmoid(wide)[0] == pytest.approx(a / 1000, rel=1e-3)


def test_perceptrons(one, several, block, tmp_path, monkeypatch):
    nets = [Net((8,), epochs=12, fold=0), Net((8,), rate=0.1, epochs=12, fold=0), Net((8,), epochs=12, fold=0)]
    a, fast, again = fit_perceptrons(one, nets)
    assert all(np.array_equal(u, v) for u, v in zip(a.weights, again.weights))
    assert not np.allclose(a.weights[0], fast.weights[0])
    x, y = np.nan_to_num(block.x), block.y

    def loss(m):
        return float(np.mean(np.logaddexp(0, np.where(y > 0, -1, 1) * perceptron.forward(m.weights, x)[-1][:, 0])))

    begun = perceptron._State(nets[0], len(FEATURES))
    assert loss(a) < np.mean(np.logaddexp(0, np.where(y > 0, -1, 1) * perceptron.forward(begun.weights, x)[-1][:, 0]))
    w = [v.copy() for v in begun.weights]
    g = perceptron.gradients(w, x, y)
    for i in range(len(w)):
        at = tuple(0 for _ in w[i].shape)
        up = [v.copy() for v in w]
        up[i][at] += 1e-6
        f = [float(np.logaddexp(0, np.where(y > 0, -1, 1) * perceptron.forward(v, x)[-1][:, 0]).sum()) for v in (w, up)]
        assert (f[1] - f[0]) / 1e-6 == pytest.approx(g[i][at], rel=1e-3, abs=1e-3)
    monkeypatch.setattr(perceptron, "STATE_EPOCHS", 2)
    folder, short = f"{tmp_path}/states", Net((4,), epochs=4, fold=1)
    spread = fit_perceptrons(several, [short], folder)[0]
    assert all(np.allclose(u, v, atol=1e-8) for u, v in zip(spread.weights, fit_perceptrons(one, [short])[0].weights))
    monkeypatch.setattr(perceptron, "_batch_sums", None)  # no step is left to do
    assert all(np.array_equal(u, v) for u, v in zip(spread.weights, fit_perceptrons(several, [short], folder)[0].weights))


def test_a_killed_search_goes_on(one, tmp_path, monkeypatch):
    names, journal = ["logistic_regression", "naive_bayes", "neural_network"], f"{tmp_path}/journal"
    want = search.search(one, names, n=2, folds=3)
    fit = search.fit_points
    seen = []

    def killed(matrix, points, state=None):
        seen.append(points[0][0])
        if points[0][0] == "neural_network" and len(seen) < 4:
            raise RuntimeError("lost")
        return fit(matrix, points, state)

    monkeypatch.setattr(search, "fit_points", killed)
    with pytest.raises(RuntimeError):
        search.search(one, names, n=2, folds=3, journal=journal)
    seen.extend(["x", "y"])
    assert search.search(one, names, n=2, folds=3, journal=journal) == want
    assert seen.count("logistic_regression") == 1 and want["naive_bayes"] == (None, None)


def test_saved_models_score_alike(spark, rows, one, tmp_path):
    points = {"extra_trees": {"n_estimators": 3}, "xgboost": {"n_estimators": 4}, "svm": {}, "neural_network": {"hidden_layer_sizes": (5,), "learning_rate_init": 0.05}, "naive_bayes": {}, "logistic_regression": {}}
    fitted = search.fitted(one, points, folds=3)
    for name, model in fitted.items():
        search.save(model, f"{tmp_path}/{name}", f"{tmp_path}/registry-{name}", name, spark)
        back = search.load(spark, f"{tmp_path}/registry-{name}")
        a, b = ([r.score for r in search.scored_rows(m, rows.orderBy("k"), ["k"]).collect()] for m in (model, back))
        assert np.allclose(a, b) and 0 <= min(a) and max(a) <= 1, (name, min(a), max(a))
        auc = evaluate.roc_auc(search.scored_rows(model, rows, ["label"])).first()["roc_auc"]
        assert auc > 0.6, (name, auc)
    vote = search.soft_vote(fitted, rows, "k")
    assert vote.count() == 700 and vote.columns == ["k", "score", "pred"]
    assert search.importances(fitted["xgboost"], spark, 3).count() == 3 and search.importances(fitted["naive_bayes"], spark).count() == 0


def test_bad_points_are_skipped_and_lost_executors_are_not(one, monkeypatch):
    def broken(matrix, points, state=None):
        raise ValueError("no such data")

    monkeypatch.setattr(search, "fit_points", broken)
    assert search.cross_validated(one, [("svm", {})], 3, on_error="skip") == {}
    with pytest.raises(ValueError):
        search.cross_validated(one, [("svm", {})], 3)
    monkeypatch.setattr(search, "fit_points", lambda *a: (_ for _ in ()).throw(RuntimeError("executor lost")))
    with pytest.raises(RuntimeError):
        search.cross_validated(one, [("svm", {})], 3, on_error="skip")


def test_blocks_of_more_than_one_partition_are_shared_out_to_all_cores(rows, one, monkeypatch):
    monkeypatch.setattr(trees, "PART_BYTES", 20_000)
    shared = Matrix.build(rows, FEATURES, "k", parallelism=4)
    assert shared.parts == 4 and shared.groups == 1
    growths = [Growth("second_order", 3, 3, 0)]
    assert same(grow_boosted(one, growths)[0], grow_boosted(shared, growths)[0])


def test_the_baseline_fits_no_fold_twice(one, rows, monkeypatch):
    asked, fit_points = [], search.fit_points
    monkeypatch.setattr(search, "fit_points", lambda matrix, points, state=None: (asked.append([(n, f) for n, _, f in points]), fit_points(matrix, points, state))[1])
    _, models = search.baseline(one, rows, ["svm", "naive_bayes"], folds=3)
    assert set(models) == {"svm", "naive_bayes"} and models["svm"].sigmoid is not None
    fits = [fit for points in asked for fit in points]
    assert len(fits) == len(set(fits)) == 8
    alone = search.fitted(one, {"svm": search.MODELS["svm"]}, 3)["svm"]
    assert np.allclose(alone.weights, models["svm"].weights) and np.allclose(alone.sigmoid, models["svm"].sigmoid)


def test_boosted_families_share_their_passes_and_fail_alone(one, monkeypatch):
    asked, fit_points = [], search.fit_points
    points = [("gradient_boosting", {"n_estimators": 2, "max_depth": 2}), ("xgboost", {"n_estimators": 2, "max_depth": 2})]
    monkeypatch.setattr(search, "fit_points", lambda matrix, wanted, state=None: (asked.append({n for n, *_ in wanted}), fit_points(matrix, wanted, state))[1])
    together = search.cross_validated(one, points, 3)
    assert asked == [{"gradient_boosting", "xgboost"}]

    def bad(matrix, wanted, state=None):
        if any(n == "xgboost" for n, *_ in wanted):
            raise ValueError("bad")
        return fit_points(matrix, wanted, state)

    monkeypatch.setattr(search, "fit_points", bad)
    left = search.cross_validated(one, points, 3, on_error="skip")
    assert {name for name, _ in left} == {"gradient_boosting"} and all(together[k] == pytest.approx(v) for k, v in left.items())


def test_a_round_starts_from_stored_margins(several, monkeypatch):
    seen, distributed = [], trees._distributed
    monkeypatch.setattr(trees, "_distributed", lambda rows, groups: (seen.append(rows.map(lambda part: part[1]).collect()), distributed(rows, groups))[1])
    fit = grow_boosted(several, [Growth("boosting", 3, 2, 1)])[0]
    for turn, blocks in enumerate(seen):
        for b in blocks:
            assert np.allclose(b.margins[0], fit.start + sum((t["value"][trees.walked(t, b.x)] for t in fit.trees[:turn]), np.zeros(len(b.y))))


def test_rows_of_one_group_are_handed_on_once(several):
    assert several.groups == 1 and type(several.copies).__name__ == "PipelinedRDD"


def test_few_sums_and_shuffled_sums_give_the_same(several, monkeypatch):
    def fits():
        return (*grow_forests(several, [Growth("forest", 3, 4, 0), Growth("extra", 2, 3)]), *grow_boosted(several, [Growth("second_order", 2, 2)])), \
            fit_perceptrons(several, [Net((4,), epochs=2), Net((3, 2), epochs=2, fold=1)])

    few = fits()
    monkeypatch.setattr(trees, "FEW_BYTES", 0)
    for a, b in zip(few[0], (shuffled := fits())[0]):
        assert same(a, b)
    for a, b in zip(few[1], shuffled[1]):
        assert all(np.allclose(x, y) for x, y in zip(a.weights, b.weights))


def test_some_rows_end_where_they_end_among_all(one, block):
    tree = grow_forests(one, [Growth("forest", 1, None, 0)])[0].trees[0]
    some = np.arange(0, len(block.y), 3)
    for depth, least in ((None, 0), (2, 0), (None, 20)):
        assert np.array_equal(trees.walked(tree, block.x, depth, least, some), trees.walked(tree, np.asfortranarray(block.x), depth, least)[some])


def test_the_smaller_of_two_nodes_is_added_up(one, several, monkeypatch):
    growths = [Growth("second_order", 3, 4, 0, rows=0.9), Growth("boosting", 2, 4, 1, columns=0.8)]
    want, seen, distributed = grow_boosted(one, growths), [], trees._distributed

    def counted(rows, groups):
        passed = distributed(rows, groups)
        return lambda jobs, *rest: (seen.append({j.id: (len(j.open), int((j.tree["feature"] >= 0).sum())) for j in jobs}), passed(jobs, *rest))[1]

    monkeypatch.setattr(trees, "_distributed", counted)
    assert all(same(a, b) for a, b in zip(want, grow_boosted(several, growths)))
    deep = [sizes for of_pass in seen for sizes in of_pass.values() if sizes[1]]
    assert deep and all(n <= (inner + 1) // 2 for n, inner in deep)  # of a full level's 2 * k nodes k
    monkeypatch.setattr(trees, "KEPT_BYTES", 0)
    assert all(same(a, b) for a, b in zip(want, grow_boosted(several, growths)))


def test_sums_of_boosted_nodes_are_exact(rows, several):
    other = Matrix.build(rows, FEATURES, "k", partitions=5)
    a, b = (grow_boosted(m, [Growth("second_order", 4, 3, 0)])[0] for m in (several, other))
    assert all(np.array_equal(s[n], t[n]) for s, t in zip(a.trees, b.trees) for n in ("feature", "threshold", "value"))


@pytest.mark.parametrize("idle", [math.inf, -1.0])
def test_an_epoch_is_a_few_jobs_or_steps_on_their_rows(spark, block, several, monkeypatch, idle):
    monkeypatch.setattr(perceptron, "BATCH", 15)
    monkeypatch.setattr(perceptron, "IDLE_WORK", idle)
    monkeypatch.setattr(perceptron, "TASK_ROWS", 3)
    nets = [Net((4,), epochs=3, fold=0), Net((3, 2), rate=0.01, epochs=3), Net((4,), epochs=2, fold=1, seed=7)]
    want = perceptron._trained(dict(enumerate(nets)), len(FEATURES), lambda own: {i: f(*arguments, block) for i, (f, arguments) in own.items()})
    spark.sparkContext.setJobGroup(f"epochs {idle}", "")
    try:
        found = fit_perceptrons(several, nets)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"epochs {idle}"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for i, b in enumerate(found):
        assert want[i].epoch == b.epochs and all(np.allclose(u, v, atol=1e-9) for u, v in zip(want[i].kept, b.weights))
    assert (jobs < 20) == (idle > 0)  # 42 steps an epoch


def test_an_epoch_of_few_sums_a_job(several, monkeypatch):
    nets = [Net((4,), epochs=2), Net((3, 2), epochs=2, fold=1)]
    want = fit_perceptrons(several, nets)
    monkeypatch.setattr(perceptron, "IDLE_WORK", -1.0)
    monkeypatch.setattr(trees, "FEW_BYTES", 1)
    for a, b in zip(want, fit_perceptrons(several, nets)):
        assert all(np.allclose(u, v, atol=1e-9) for u, v in zip(a.weights, b.weights))

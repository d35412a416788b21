"""The distributed booster against a plain one that loops over rows."""

import math
import random

import numpy as np
import pytest

from ledgerloom import learn
from ledgerloom.learn.histogram import PUBLISHED, UNIT, _features_of_round, bin_edges, importance_rows, to_bins

EDGES = [[float(i) for i in range(0, 100, 7)], [0.5, 2.5, 4.5, 6.5], [0.0]]
SETTINGS = learn.HistogramSettings(learning_rate=0.3, rounds=6, max_depth=4, max_leaves=9, l1=0.05, l2=0.1, min_gain=0.01, min_child_weight=2.0, feature_share=1.0, patience=50)


def made(n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        a, b, c = rng.uniform(0, 100), rng.choice([None, 1.0, 3.0, 5.0, 8.0]), rng.choice([-1.0, 1.0, float("nan"), float("inf")])
        y = int(a + rng.gauss(0, 15) + (20 if b is None else 0) > 60) if k % 10 else None
        rows.append((k, y, k % 4, a, b, c))
    return rows


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(made(), "k long, y int, fold int, a double, b double, `c.d` double").repartition(5)


def plain(rows, edges, s, held, seed_rounds):
    """Trees as nested tuples, grown one node at a time over lists of rows."""
    train = [r for r in rows if r[1] is not None and r[2] != held]
    bins = [[0 if v is None or math.isnan(v) else 1 + sum(e < v for e in cut) for v, cut in zip(r[3:], edges)] for r in train]
    share = sum(r[1] for r in train) / len(train)
    margin = [math.log(share / (1 - share))] * len(train)
    squeeze = lambda g: math.copysign(max(abs(g) - s.l1, 0), g)
    score = lambda g, h: squeeze(g) ** 2 / (h + s.l2)
    trees = []
    for round_ in range(seed_rounds):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        g = [round((q - r[1]) * UNIT) for q, r in zip(p, train)]
        h = [round(q * (1 - q) * UNIT) for q in p]
        use = _features_of_round(s, len(edges), round_)

        def best(members):
            found = None
            all_g, all_h = sum(g[i] for i in members) / UNIT, sum(h[i] for i in members) / UNIT
            for missing_left in (False, True):
                for f in np.flatnonzero(use):
                    for b in range(1, max(len(e) for e in edges) + 2):
                        left = [i for i in members if (missing_left if bins[i][f] == 0 else bins[i][f] <= b)]
                        gl, hl = sum(g[i] for i in left) / UNIT, sum(h[i] for i in left) / UNIT
                        gr, hr = all_g - gl, all_h - hl
                        if min(hl, hr) < s.min_child_weight or min(hl, hr) <= 0:
                            continue
                        gain = score(gl, hl) + score(gr, hr) - score(all_g, all_h)
                        if gain > s.min_gain and (found is None or gain > found[0] + 1e-9):
                            found = (gain, int(f), b, missing_left, gl, hl, gr, hr)
            return found

        leaf = lambda a, b: -s.learning_rate * squeeze(a) / (b + s.l2)
        members, values, splits = {0: list(range(len(train)))}, {0: 0.0}, {}
        total = sum(g) / UNIT, sum(h) / UNIT
        level, created = [0], 1
        for depth in range(s.max_depth):
            options = {n: best(members[n]) for n in level}
            if depth == 0 and options[0] is None:
                values[0] = leaf(*total)
            level = []
            for n, o in sorted(((n, o) for n, o in options.items() if o), key=lambda x: (-x[1][0], x[0])):
                if len(splits) + 1 >= s.max_leaves:
                    continue
                _, f, b, missing_left, gl, hl, gr, hr = o
                goes = [missing_left if bins[i][f] == 0 else bins[i][f] <= b for i in members[n]]
                splits[n] = (f, b, missing_left, created, created + 1)
                members[created] = [i for i, x in zip(members[n], goes) if x]
                members[created + 1] = [i for i, x in zip(members[n], goes) if not x]
                values[created], values[created + 1] = leaf(gl, hl), leaf(gr, hr)
                level += [created, created + 1]
                created += 2
        for n, which in members.items():
            if n not in splits:
                for i in which:
                    margin[i] += values[n]
        trees.append((splits, {n: round(v, 9) for n, v in values.items()}))
    return trees


def shape(tree):
    splits = {n: (f, b, m, x, y) for n, (f, b, m, x, y) in enumerate(zip(tree.feature, tree.bin, tree.missing_left, tree.left, tree.right)) if f >= 0}
    return splits, {n: round(v, 9) for n, v in enumerate(tree.value)}


@pytest.mark.parametrize("share, held", [(1.0, 1), (0.7, None)])
def test_trees_equal_plain_ones(rows, share, held):
    settings = learn.HistogramSettings(**{**SETTINGS.__dict__, "feature_share": share})
    model = learn.fit_models(rows, "y", ["a", "b", "c.d"], [settings], [held], edges=EDGES)[0]
    assert [shape(t) for t in model.trees] == plain(made(), EDGES, settings, held, 6)


def test_models_grown_together_equal_models_grown_alone(rows):
    other = learn.HistogramSettings(**{**SETTINGS.__dict__, "learning_rate": 0.1, "max_depth": 2, "rounds": 3})
    together = learn.fit_models(rows, "y", ["a", "b"], [SETTINGS, other], [0, 2], edges=EDGES[:2])
    alone = [learn.fit_models(rows.coalesce(1), "y", ["a", "b"], [s], [h], edges=EDGES[:2])[0] for s, h in ((SETTINGS, 0), (other, 2))]
    assert together == alone and [len(m.trees) for m in together] == [6, 3]


def test_training_stops_before_all_rounds(rows):
    settings = learn.HistogramSettings(**{**SETTINGS.__dict__, "rounds": 500, "patience": 3, "metric": "log_loss"})
    model = learn.fit_models(rows, "y", ["a", "b"], [settings], [0])[0]
    assert len(model.trees) < 60 and len(model.metrics) - 1 == model.best + 3 == len(model.trees)
    assert model.metrics[model.best] == max(model.metrics) and max(model.metrics[model.best :]) == model.metrics[model.best]


def test_settled_scores_change_nothing(rows, monkeypatch):
    settings = learn.HistogramSettings(**{**SETTINGS.__dict__, "rounds": 5})
    once = learn.fit_models(rows, "y", ["a", "b"], [settings], [0], edges=EDGES[:2])
    monkeypatch.setattr("ledgerloom.learn.histogram.SETTLE", 2)
    assert learn.fit_models(rows, "y", ["a", "b"], [settings], [0], edges=EDGES[:2]) == once


def test_metric_is_the_held_out_area(rows):
    from ledgerloom import operators as O

    model = learn.fit_models(rows, "y", ["a", "b"], [SETTINGS], [0])[0]
    scored = learn.score_models(rows.where("y IS NOT NULL AND fold = 0"), ["y"], [model], rounds=[0, 1, 6])
    for n in (0, 1, 6):
        assert O.roc_auc(scored, "y", f"score_{n}").first()["auc"] == pytest.approx(model.metrics[n], abs=2e-3)


def test_saved_model_scores_alike(spark, rows, tmp_path):
    model = learn.fit_models(rows, "y", ["a", "b", "c.d"], [SETTINGS], [None])[0]
    model.save(spark, str(tmp_path / "m"))
    again = learn.HistogramModel.load(spark, str(tmp_path / "m"))
    assert again == model
    scores = learn.score_models(rows, ["k"], [again])
    assert scores.count() == 400 and scores.where("score IS NULL OR score <= 0 OR score >= 1").count() == 0
    assert sum(s for _, _, s, _ in importance_rows([model])) == sum(f >= 0 for t in model.trees for f in t.feature)


def test_folds_score_every_row_once(rows):
    result = learn.train_folds(rows.drop("fold"), "k", "y", ["a", "b"], SETTINGS, k=3)
    assert result.out_of_fold.select("k").distinct().count() == 360 == result.out_of_fold.count()
    assert result.scores.count() == 40 and result.overall_auc > 0.8
    model = learn.refit(rows, "y", ["a", "b"], result, SETTINGS)
    assert len(model.trees) in {r["best_iter"] for r in result.folds.collect()}


def test_staged_grid_equals_separate_fits(rows):
    from ledgerloom import operators as O

    grid = {"learning_rate": [0.05, 0.3], "n_estimators": [4, 2]}
    best, table = learn.tune_staged(rows.drop("fold"), "k", "y", ["a", "b"], grid, 3, SETTINGS)
    got = {(r["learning_rate"], r["n_estimators"]): r["auc"] for r in table.collect()}
    assert set(got) == {(r, n) for r in (0.05, 0.3) for n in (2, 4)} and got[best["learning_rate"], best["n_estimators"]] == max(got.values())
    folded = learn.assign_folds(rows.drop("fold").where("y IS NOT NULL"), ["k"], 3)
    for (rate, rounds), auc in got.items():
        settings = learn.HistogramSettings(**{**SETTINGS.__dict__, "learning_rate": rate, "rounds": rounds, "patience": 2**31})
        models = [learn.fit_models(folded, "y", ["a", "b"], [settings], [f])[0] for f in range(3)]
        each = [O.roc_auc(learn.score_models(folded.where(f"fold = {f}"), ["y"], [m], rounds=[rounds]), "y", f"score_{rounds}").first()["auc"] for f, m in enumerate(models)]
        assert auc == pytest.approx(sum(each) / 3, abs=1e-12)


def test_edges_and_bins(spark):
    df = spark.createDataFrame([(float(i), None) for i in range(1000)] + [(float("nan"), float("nan"))], "a double, b double")
    edges = bin_edges(df, ["a", "b"], 4)
    assert len(edges[0]) == 3 and edges[1] == [] and abs(edges[0][1] - 500) < 5
    assert to_bins(np.array([[np.nan, 1.0], [-np.inf, np.nan], [np.inf, 0.0]]), edges).tolist() == [[0, 1], [1, 0], [4, 1]]
    with pytest.raises(ValueError):
        bin_edges(df, ["a"], 1000)


def test_settings_by_name():
    assert learn.HistogramSettings.from_names(PUBLISHED) == learn.HistogramSettings()
    with pytest.raises(ValueError):
        learn.HistogramSettings.from_names({"subsample_freq": 1})


def test_tables_without_a_label_or_feature(spark, rows):
    one_class = rows.withColumn("y", rows["y"] * 0)
    model = learn.fit_models(one_class, "y", ["a"], [SETTINGS], [0])[0]
    assert learn.score_models(rows, ["k"], [model]).where("score < 0.01").count() == 400
    none = learn.fit_models(rows.where("y IS NULL"), "y", ["a"], [SETTINGS], [0])[0]
    assert learn.score_models(rows, ["k"], [none]).where("score = 0.5").count() == 400

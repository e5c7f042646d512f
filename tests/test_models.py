"""Learned operators: seeded, finite, better than a constant baseline."""

import math

from pyspark.sql import functions as F

from quarry.operators import evaluation as ev
from quarry.operators import regression as rg
from quarry.operators import tuning as tn
from quarry.plans import workflows as wf


def test_cv_grid_best_and_refit(spark, sf_small):
    train, test = wf.particle_split(spark, sf_small)
    model, named = tn.cross_validate(train, "rf", wf.PARTICLE_FEATURES,
                                     grid={"maxDepth": [3, 6], "numTrees": [3]}, folds=2)
    metrics = list(model.avgMetrics)
    table = tn.cv_results(spark, "rf", metrics, named)
    assert table.count() == 2
    best = tn.best_params(metrics, named)
    assert best in named
    assert table.filter("rank = 1").first().params.find(str(best["maxDepth"])) >= 0
    fitted = tn.refit(train, "rf", wf.PARTICLE_FEATURES, best)
    acc = ev.accuracy(fitted.transform(test), "label").first().accuracy
    assert acc > 0.9
    imp = tn.feature_importances(spark, "rf", fitted, wf.PARTICLE_FEATURES, top=4)
    assert abs(imp.agg(F.sum("importance")).first()[0] - 1.0) < 1e-9


def test_cv_is_seeded(spark, sf_small):
    train, _ = wf.particle_split(spark, sf_small)
    grid = {"maxDepth": [2], "maxIter": [3]}
    a, _ = tn.cross_validate(train, "gbt", wf.PARTICLE_FEATURES, grid=grid, folds=2)
    b, _ = tn.cross_validate(train, "gbt", wf.PARTICLE_FEATURES, grid=grid, folds=2)
    assert a.avgMetrics == b.avgMetrics


def test_mlp_learns_with_scaling(spark, sf_small):
    train, test = wf.particle_split(spark, sf_small)
    n = len(wf.PARTICLE_FEATURES)
    fitted = tn.refit(train, "mlp", wf.PARTICLE_FEATURES, {"layers": [n, 8, 2], "maxIter": 100},
                      scale=True)
    assert ev.accuracy(fitted.transform(test), "label").first().accuracy > 0.9


def test_claims_models(spark, sf_small):
    train, test, ohe, idx = wf.claims_prepared(spark, sf_small)
    assert "Cat7" + "ohe" not in ohe
    lasso = rg.lasso(train, ohe)
    m = ev.regression_metrics(lasso.transform(test), rg.TARGET).first()
    assert math.isfinite(m.mse) and m.n == test.count()
    tree = rg.claim_tree(train, ohe)
    glm = rg.gamma_glm(train, idx)
    preds = rg.two_part_predict(test, tree, glm)
    bad = preds.filter(F.isnan("prediction") | F.col("prediction").isNull()).count()
    assert bad == 0
    assert preds.count() == test.count()


def test_claims_fit_on_train_only(spark, sf_small):
    train, test, ohe, idx = wf.claims_prepared(spark, sf_small, fit_on="train")
    assert train.count() > 0 and test.count() > 0
    model = rg.lasso(train, ohe)
    m = ev.regression_metrics(model.transform(test), rg.TARGET).first()
    assert math.isfinite(m.mse)


def test_gamma_glm_predictions_finite(spark, sf_small):
    train, test, _, idx = wf.claims_prepared(spark, sf_small)
    glm = rg.gamma_glm(train, idx)
    preds = glm.transform(test.filter(F.col(rg.TARGET) > 0))
    bad = preds.filter(F.isnan("prediction") | (F.abs("prediction") == float("inf"))).count()
    assert bad == 0 and preds.count() > 0


def test_original_grids_are_valid_param_grids(spark):
    sizes = {}
    for kind in ("rf", "gbt", "mlp"):
        clf = tn.classifier(kind)
        sizes[kind] = len(tn.param_maps(clf, tn.original_grid(kind, n_inputs=4)))
    assert sizes == {"rf": 243, "gbt": 81, "mlp": 486}


def test_als_accepts_ids_beyond_int(spark):
    from quarry.operators import recsys as rs

    base = 2 ** 40
    rows = [(base + u, base * 2 + m, float(1 + (u + m) % 5)) for u in range(12) for m in range(6)]
    ratings, users = rs.als_ready(spark.createDataFrame(rows, "userId long, movieId long, rating double"))
    model = rs.als_estimator(rank=3, max_iter=2).fit(ratings)
    got = {r.userId for r in rs.user_vectors(model, users).collect()}
    assert got == {base + u for u in range(12)}
    small = spark.createDataFrame([(1, 2, 3.0)], "userId long, movieId long, rating double")
    assert rs.als_ready(small)[1] is None


def test_claims_models_beat_the_constant(spark, sf_small):
    """The claim rule is learnable but not given away by one column."""
    from pyspark.sql import functions as F

    from quarry.plans import workflows as wf

    train, test, ohe, idx = wf.claims_prepared(spark, sf_small)
    log = wf._log_glm(spark, sf_small).transform(test.filter("Claim_Amount > 0"))
    mean = train.filter("Claim_Amount > 0").agg(F.avg("Claim_Amount")).first()[0]
    row = log.agg(F.avg(F.abs(F.col("prediction") - F.col("Claim_Amount"))).alias("model"),
                  F.avg(F.abs(F.lit(mean) - F.col("Claim_Amount"))).alias("constant"),
                  F.stddev("prediction").alias("spread")).first()
    assert row.model < row.constant and row.spread > 0
    tree = wf.tree_table(spark, sf_small).first()
    assert 0.5 < tree.auc_score < 0.999


def test_registered_searches_run_the_original_grids(spark, sf_small, monkeypatch):
    from quarry.operators import search as se
    from quarry.plans.registry import QUERIES

    asked = {}

    def recorded(table, kind, features, grid, *, folds, **_):
        maps = [{p.name: v for p, v in m.items()} for m in tn.param_maps(tn.classifier(kind), grid)]
        asked[kind] = (len(maps), folds, len(features))
        return maps, [0.5] * len(maps)

    monkeypatch.setattr(se, "grid_scores", recorded)
    monkeypatch.setattr(wf, "_MEMO", {})
    assert [QUERIES[f"{k}_cv"](spark, sf_small).count() for k in wf.MODELS] == [243, 81, 486]
    assert asked == {"rf": (243, 5, 28), "gbt": (81, 5, 28), "mlp": (486, 5, 28)}


def test_claims_models_see_the_whole_width(spark, sf_small):
    _, _, ohe, idx = wf.claims_prepared(spark, sf_small)
    assert len(ohe) == len(idx) == 33 and "Cat7ohe" not in ohe


def test_claims_tables_hold_numbers_only(spark, sf_small):
    """One-hot vectors are made of the indices on reading; they say the same and are not written."""
    balanced, test, hot, cats, nums = wf.claims_indexed(spark, sf_small)
    for table in (balanced, test):
        assert {f.dataType.simpleString() for f in table.schema.fields if f.name != "row_key"} <= {"double", "bigint"}
        assert len(table.columns) == len(cats) + len(nums) + 2
    row = hot.transform(test).first()
    for c, size in zip(cats, hot.categorySizes):
        vector = row[c + "ohe"]
        at = int(row[c + "_index"])
        assert vector.size == size - 1 and list(vector.indices) == ([at] if at < size - 1 else [])

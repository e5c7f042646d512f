"""The four workflows end to end, built from the operators.

Fitted models are memoised per (application, data folder, step) so that several
registered queries over the same fitted search do not refit it, and so are
frames over tables that were written to the checkpoint folder.
"""

from __future__ import annotations

import threading
import uuid
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import evaluation as ev
from quarry.operators import recsys as rs
from quarry.operators import optimality as op
from quarry.operators import regression as rg
from quarry.operators import search as se
from quarry.operators import splits as sp
from quarry.operators import tabular as tb
from quarry.operators import tuning as tn
from quarry.sources import standins as si
from quarry.sources.files import CLAIMS_CATEGORICAL, CLAIMS_NUMERIC, PARTICLE_FEATURES, cast_all, freeze

_MEMO: dict = {}
_LOCKS: dict = {}
_GUARD = threading.Lock()


def _memo(spark: SparkSession, sf_dir: str, step: str, fn):
    """Compute ``fn`` once per key; threads asking for the same key wait."""
    key = (spark.sparkContext.applicationId, sf_dir, step)
    with _GUARD:
        lock = _LOCKS.setdefault(key, threading.Lock())
    with lock:
        if key not in _MEMO:
            _MEMO[key] = fn()
        return _MEMO[key]


# ------------------------------------------------------- classification ----

MODELS = ("rf", "gbt", "mlp")
TUNING_ROWS = 1_500  # labelled rows, on average, that a search is tuned on
FOLDS = 5


def particle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_all(si.load_particle_text(spark, sf_dir), "double", exclude=("row_key",))


def particle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The particle file in full: label, 28 features and a row key (a hash of all values)."""
    rows = si.load_particle_csv(spark, sf_dir)
    # numbers are parsed once: a filter on the key does not pass a generator, below which it would parse them all again
    rows = rows.select(F.inline(F.array(F.struct(*rows.columns))))
    return rows.withColumn("row_key", F.xxhash64("label", *PARTICLE_FEATURES).cast("string"))


def particle_split(spark: SparkSession, sf_dir: str, fraction: float = 1.0):
    """R1 + R2 (deterministic form): sample ``fraction`` (seed 42), split 70/30 (seed 21)."""
    df = sp.hash_sample(particle_rows(spark, sf_dir), "row_key", fraction, seed=42)
    tagged = sp.hash_split(df, "row_key", (0.7, 0.3), seed=21)
    return (tagged.filter("side = 'train'").drop("side"),
            tagged.filter("side = 'test'").drop("side"))


def _tuning(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, str]:
    """The frozen training rows, a hash sample of them to tune on (as the original did), and their fingerprint."""
    def run():
        train = freeze(particle_split(spark, sf_dir)[0], "particle_train")
        sample = sp.hash_sample(train, "row_key", min(1.0, TUNING_ROWS / max(1, train.count())), seed=42)
        return train, freeze(sample, "particle_tuning"), se.fingerprint(train)
    return _memo(spark, sf_dir, "tuning", run)


def search_path(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Where a search keeps its scores and its model: by data, grid, folds and rows."""
    grid = tn.original_grid(kind, len(PARTICLE_FEATURES))
    return f"{se.store_dir(spark)}/{kind}-{se.store_key(_tuning(spark, sf_dir)[2], grid, FOLDS, TUNING_ROWS, PARTICLE_FEATURES)}"


def search(spark: SparkSession, sf_dir: str, kind: str) -> tuple[list[dict], list[float]]:
    """The whole original grid with 5 folds on all 28 inputs: (maps, mean scores).

    Scores found in the store aren't made again.
    """
    def run():
        return se.grid_scores(_tuning(spark, sf_dir)[1], kind, PARTICLE_FEATURES, tn.original_grid(kind, len(PARTICLE_FEATURES)),
                              key="row_key", folds=FOLDS, parallelism=16, store=f"{search_path(spark, sf_dir, kind)}/scores")
    return _memo(spark, sf_dir, f"search:{kind}", run)


def cv_table(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    named, means = search(spark, sf_dir, kind)
    return tn.cv_results(spark, kind, means, named)


def best_params_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M15 for every model: (model, param, value) with values as JSON text."""
    import json

    rows = []
    for kind in MODELS:
        named, means = search(spark, sf_dir, kind)
        for name, value in sorted(tn.best_params(means, named).items()):
            rows.append((kind, name, json.dumps(tn._jsonable(value))))
    return spark.createDataFrame(rows, "model string, param string, value string")


def refit(spark: SparkSession, sf_dir: str, kind: str):
    """The best map fitted on all training rows, or the model that another application saved."""
    def run():
        named, means = search(spark, sf_dir, kind)
        fit = lambda: tn.refit(_tuning(spark, sf_dir)[0], kind, PARTICLE_FEATURES, tn.best_params(means, named))
        return se.saved_model(spark, f"{search_path(spark, sf_dir, kind)}/model", fit)
    return _memo(spark, sf_dir, f"refit:{kind}", run)


def refit_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M16 + E2-E4: each refit model scored on the held-out rows."""
    _, test = particle_split(spark, sf_dir)
    rows = []
    for kind in MODELS:
        s = ev.confusion_scores(refit(spark, sf_dir, kind).transform(test), "label", raw="rawPrediction")
        rows.append((kind, s["accuracy"], s["f1"], s["auc_hard"], s["auc_score"]))
    return spark.createDataFrame(rows, "model string, accuracy double, f1 double, "
                                       "auc_hard double, auc_score double")


def importance_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [tn.feature_importances(spark, kind, refit(spark, sf_dir, kind), PARTICLE_FEATURES)
             for kind in ("rf", "gbt")]
    return parts[0].unionByName(parts[1])


def random_split_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = sp.random_split(particle(spark, sf_dir), (0.7, 0.3), seed=21)
    return (train.select("row_key", F.lit("train").alias("side"))
            .unionByName(test.select("row_key", F.lit("test").alias("side"))))


def frozen_split_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = sf_dir.rstrip("/").rsplit("/", 1)[-1].replace(".", "_")
    train, test = sp.frozen_split(particle(spark, sf_dir), f"particle_{tag}", (0.7, 0.3), seed=21)
    return (train.select("row_key", F.lit("train").alias("side"))
            .unionByName(test.select("row_key", F.lit("test").alias("side"))))


def random_split_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: one row that proves the seeded split disjoint, complete and of the asked share."""
    return sp.split_manifest(freeze(random_split_table(spark, sf_dir), "random_sides"))


def frozen_split_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of the split frozen to Parquet."""
    return sp.split_manifest(frozen_split_table(spark, sf_dir))


# ------------------------------------------------------------ claims -------

ID_COLUMNS = ("Row_ID", "Household_ID")
CLAIM_COLUMNS = ["Row_ID", "Household_ID", "Blind_Make", "Cat1", "Cat2", "Cat7", "OrdCat",
                 "Calendar_Year", "Var1", "Var2", "Var3", "Var4", "Claim_Amount"]


def claims_prepared(spark: SparkSession, sf_dir: str, fit_on: str = "all"):
    """Missing tokens -> null -> mode fill/drop -> index + one-hot -> split -> rebalance, on the whole file.

    All 16 categorical and 17 numeric features of the claims CSV take part.

    ``fit_on='all'`` (as coded, D21) computes modes and fits the encoders
    before the split; ``fit_on='train'`` learns them from the training side
    only and maps unseen test labels to an extra index (``handleInvalid='keep'``).
    Returns (balanced train, test, one-hot features, index features).
    """
    balanced, test, hot, cats, nums = claims_indexed(spark, sf_dir, fit_on)
    return hot.transform(balanced), hot.transform(test), [c + "ohe" for c in cats] + nums, [c + "_index" for c in cats] + nums


def claims_indexed(spark: SparkSession, sf_dir: str, fit_on: str = "all"):
    """The steps of :func:`claims_prepared` up to the index columns, as written: (balanced train, test, one-hot model, categories, numbers).

    The text is parsed once, and the tables hold numbers only: a one-hot vector is made
    of its index while it is read.
    """
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on must be 'all' or 'train'")
    claims = si.load_claims_csv(spark, sf_dir).withColumn("row_key", F.concat_ws("|", "Row_ID", "Vehicle"))
    tagged = freeze(sp.hash_split(claims, "row_key", (0.7, 0.3), seed=21), "claims_sides")
    basis = tagged if fit_on == "all" else tagged.filter("side = 'train'")
    filled = tb.apply_modes(tagged, tb.modes_for_fill(basis, [*CLAIMS_CATEGORICAL, "Cat7", *CLAIMS_NUMERIC, rg.TARGET]))
    cats = [c for c in CLAIMS_CATEGORICAL if c in filled.columns]
    nums = [c for c in CLAIMS_NUMERIC if c in filled.columns]
    basis = filled if fit_on == "all" else filled.filter("side = 'train'")
    invalid = "error" if fit_on == "all" else "keep"
    index, hot = tb.encode_pipeline(cats, handle_invalid=invalid).fit(basis).stages
    encoded = index.transform(filled).select("row_key", "side", *[c + "_index" for c in cats], *nums, rg.TARGET)
    train = encoded.filter("side = 'train'").drop("side")
    test = encoded.filter("side = 'test'").drop("side")
    train, test = freeze(train, "claims_train"), freeze(test, "claims_test")  # the Parquet boundary
    balanced = freeze(sp.downsample(train, "row_key", seed=3), "claims_balanced")
    return balanced, test, hot, cats, nums


def _claims_indexed(spark, sf_dir):
    return _memo(spark, sf_dir, "claims_indexed", lambda: claims_indexed(spark, sf_dir))


def _claims(spark, sf_dir):
    """As :func:`claims_prepared`, of tables written once."""
    def run():
        balanced, test, hot, cats, nums = _claims_indexed(spark, sf_dir)
        return hot.transform(balanced), hot.transform(test), [c + "ohe" for c in cats] + nums, [c + "_index" for c in cats] + nums
    return _memo(spark, sf_dir, "claims", run)


def _tagged_metrics(df: DataFrame, model: str, label: str = rg.TARGET) -> DataFrame:
    return ev.regression_metrics(df, label).select(F.lit(model).alias("model"), "*")


def lasso_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test, ohe, _ = _claims(spark, sf_dir)
    model = rg.lasso(train, ohe)
    return _tagged_metrics(model.transform(test), "lasso")


def _tree(spark, sf_dir):
    def run():
        train, _, hot, cats, nums = _claims_indexed(spark, sf_dir)
        width = sum(hot.categorySizes) + len(nums)
        train = rg.spread_for_trees(train, width, "row_key")
        return rg.claim_tree(hot.transform(train), [c + "ohe" for c in cats] + nums)
    return _memo(spark, sf_dir, "tree", run)


def _glm(spark, sf_dir):
    def run():
        train, _, _, idx = _claims(spark, sf_dir)
        return rg.gamma_glm(train, idx)
    return _memo(spark, sf_dir, "glm", run)


def tree_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test, _, _ = _claims(spark, sf_dir)
    preds = _tree(spark, sf_dir).transform(tb.claim_flag(test))
    s = ev.confusion_scores(preds, "binary", raw="rawPrediction")
    return spark.createDataFrame([("tree", s["accuracy"], s["f1"], s["auc_hard"], s["auc_score"])],
                                 "model string, accuracy double, f1 double, auc_hard double, "
                                 "auc_score double")


def _log_glm(spark, sf_dir):
    def run():
        train, _, _, idx = _claims(spark, sf_dir)
        return rg.gamma_glm(train, [c for c in idx if c not in ID_COLUMNS], link="log")
    return _memo(spark, sf_dir, "log_glm", run)


def log_glm_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M20 with the log link and without id columns: positive predictions that vary."""
    _, test, _, _ = _claims(spark, sf_dir)
    preds = _log_glm(spark, sf_dir).transform(test.filter(F.col(rg.TARGET) > 0))
    return _tagged_metrics(preds, "gamma_glm_log")


def glm_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test, _, _ = _claims(spark, sf_dir)
    preds = _glm(spark, sf_dir).transform(test.filter(F.col(rg.TARGET) > 0))
    return _tagged_metrics(preds, "gamma_glm")


def two_part_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test, _, _ = _claims(spark, sf_dir)
    preds = rg.two_part_predict(test, _tree(spark, sf_dir), _log_glm(spark, sf_dir))
    return _tagged_metrics(preds, "two_part")


MULTIPLES = {f"Var{k}" for k in range(2, 9)} | {f"NVVar{k}" for k in range(2, 5)}  # of Var1 and NVVar1 in the stand-in


def lasso_optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far a lasso run to its end is from the optimality conditions, and that ten iterations are no closer.

    Inputs that are multiples of others are left out: on them the solver's line search
    gives up before the optimum (relative gap 0.15 on all index features).
    """
    train, _, _, idx = _claims(spark, sf_dir)
    gaps, n, inputs = [], train.count(), [c for c in idx if c not in MULTIPLES]
    for most, tol in ((1000, 1e-9), (10, 1e-6)):
        model = rg.lasso(train, inputs, max_iter=most, tol=tol)
        gaps.append(op.lasso_gap(model.stages[-1], model.stages[0].transform(train), rg.TARGET, rg.REG))
    return spark.createDataFrame([("lasso", n, round(float(gaps[0]), 3) + 0.0, gaps[0] <= gaps[1] + 1e-9)],
                                 "model string, n long, gap double, better_than_ten boolean")


def glm_optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the gamma model is from solving its score equations."""
    train, _, _, _ = _claims(spark, sf_dir)
    model, rows = _log_glm(spark, sf_dir), train.filter(F.col(rg.TARGET) > 0)
    gap = op.glm_gap(model.stages[-1], model.stages[0].transform(rows), rg.TARGET, rg.REG, "log")
    return spark.createDataFrame([("log", rows.count(), round(float(gap), 3) + 0.0)], "model string, n long, gap double")


def _tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.session import scratch_path

    def run():
        path = f"{scratch_path(spark, 'claim_tree')}-{uuid.uuid4().hex}"
        return op.tree_nodes(spark, _tree(spark, sf_dir).stages[-1], path)
    return _memo(spark, sf_dir, "tree_nodes", run)


def claim_tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The root's counts, and how many nodes differ from what the training rows give."""
    train, _, _, _ = _claims(spark, sf_dir)
    model = _tree(spark, sf_dir)
    rows = model.stages[0].transform(tb.claim_flag(train)).select("binary", "features")
    checked = freeze(op.checked_nodes(rows, _tree_nodes(spark, sf_dir), "binary", model.stages[-1].depth), "tree_nodes")
    off = lambda c: F.count_if(~F.col(c))
    root = F.col("id") == 0
    leaves = _tree_nodes(spark, sf_dir).where("left < 0").join(checked, "id").agg(F.sum("n")).first()[0]
    return checked.agg(F.lit(0).alias("id"), F.max(F.when(root, F.col("n"))).alias("n"),
                       F.max(F.when(root, F.col("positives"))).alias("positives"), off("counts_ok").alias("counts_off"),
                       off("impurity_ok").alias("impurity_off"), off("gain_ok").alias("gain_off")).withColumn(
        "leaves_ok", F.col("n") == leaves)


def two_part_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows, and those whose expected claim is not chance x severity by the two models' own numbers."""
    _, test, _, _ = _claims(spark, sf_dir)
    test = freeze(test.withColumn("_row", F.monotonically_increasing_id()), "numbered_test")
    tree, glm = _tree(spark, sf_dir), _log_glm(spark, sf_dir)
    said = rg.two_part_predict(test, tree, glm).select("_row", "prediction")
    nodes = _tree_nodes(spark, sf_dir)
    leaves = nodes.where("left < 0").select("id", (F.col("counts")[1] / (F.col("counts")[0] + F.col("counts")[1])).alias("chance"))
    chance = op.reached_nodes(tree.stages[0].transform(test), nodes, tree.stages[-1].depth, ["_row"]).join(F.broadcast(leaves), "id")
    rows = glm.stages[0].transform(test)
    eta = op.linear_predictor(rows, glm.stages[-1].coefficients, glm.stages[-1].intercept)
    own = rows.select("_row", F.exp(eta).alias("severity")).join(chance, "_row")
    both = said.join(own, "_row", "left")
    wanted = F.col("chance") * F.col("severity")
    off = F.coalesce(F.abs(F.col("prediction") - wanted) > 1e-9 * (1 + F.abs(wanted)), F.lit(True))
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(off).alias("n_off"))


# ------------------------------------------------------------ recsys -------

def _ratings(spark, sf_dir):
    return si.load_ratings(spark, sf_dir)


def als_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memo(spark, sf_dir, "als_matrix",
                 lambda: rs.evaluate_settings(_ratings(spark, sf_dir)))


def als_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 + M6: per setting and split, the largest relative residual of the users' normal equations.

    ``beats_mean``: the factors describe the rows they learned from better than the
    mean rating does.
    """
    ratings, _ = rs.als_ready(_ratings(spark, sf_dir))
    cuts, out = _cuts(spark, sf_dir), []
    for p in sp.CHRONO_FRACTIONS:
        train, _ = sp.split_at(ratings, cuts[p], p)
        with se.pinned(train.select("userId", "movieId", "rating")) as held:
            spread = held.agg(F.stddev_pop("rating")).first()[0]
            for i, (rank, reg) in enumerate(rs.ALS_SETTINGS, start=1):
                model = rs.fit_als(held, rank, reg)
                rmse = rs.regression_scores(model.transform(held))["rmse"]
                users, rows, worst = op.als_residuals(model, held, reg).agg(F.count(F.lit(1)), F.sum("n"), F.max("residual")).first()
                out.append((i, rank, float(reg), float(p), users, rows, round(worst, 3) + 0.0, rmse < spread))
    return spark.createDataFrame(out, "setting int, rank int, reg double, fraction double, n_users long, n_train long, "
                                      "residual double, beats_mean boolean")


def taste_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 + A12: users of each split, those not in the cluster of the nearest centre, and whether the sizes add up."""
    fits, out = _all_taste(spark, sf_dir), []
    for p in sp.CHRONO_FRACTIONS:
        _, _, km, preds = fits[p]
        checked = op.nearest_centres(preds, km.clusterCenters())
        users, off = checked.agg(F.count(F.lit(1)), F.count_if("off")).first()
        own = {r.nearest: r.n for r in checked.groupBy("nearest").agg(F.count(F.lit(1)).alias("n")).collect()}
        given = {r[0]: r[1] for r in rs.cluster_sizes(preds).select("prediction", "size").collect()}
        largest = {r.prediction for r in rs.largest_group(preds, group_col="prediction").select("prediction").distinct().collect()}
        first = min(own, key=lambda c: (-own[c], c))
        out.append((float(p), users, off, len(given), own == given, largest == {first}))
    return spark.createDataFrame(out, "fraction double, n_users long, n_off long, n_clusters long, sizes_ok boolean, largest_ok boolean")


def _cuts(spark, sf_dir):
    return _memo(spark, sf_dir, "cuts", lambda: sp.chrono_cutoffs(_ratings(spark, sf_dir)))


def _taste(spark, sf_dir, p):
    """ALS (first setting) on the split's training side -> user vectors -> k-means."""
    def run():
        ratings, users = _memo(spark, sf_dir, "als_ready", lambda: rs.als_ready(_ratings(spark, sf_dir)))
        train, _ = sp.split_at(ratings, _cuts(spark, sf_dir)[p], p)
        rank, reg = rs.ALS_SETTINGS[0]
        als = rs.fit_als(train, rank, reg)
        vectors = rs.user_vectors(als, users)
        km, preds = rs.taste_clusters(vectors, k=20)
        return als, vectors, km, preds
    return _memo(spark, sf_dir, f"taste:{p}", run)


def _all_taste(spark, sf_dir):
    """The three per-split fits, run as concurrent Spark jobs while they are small."""
    from concurrent.futures import ThreadPoolExecutor

    _cuts(spark, sf_dir)  # shared inputs first, then the independent fits
    with ThreadPoolExecutor(max_workers=rs.fits_at_once(_ratings(spark, sf_dir), len(sp.CHRONO_FRACTIONS))) as pool:
        return dict(zip(sp.CHRONO_FRACTIONS,
                        pool.map(lambda p: _taste(spark, sf_dir, p), sp.CHRONO_FRACTIONS)))


def user_vectors_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 for every split: (fraction, userId, features)."""
    fits = _all_taste(spark, sf_dir)
    parts = [fits[p][1].select(F.lit(float(p)).alias("fraction"), "*") for p in sp.CHRONO_FRACTIONS]
    return reduce(DataFrame.unionByName, parts)


def user_vector_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(fraction, userId, dimension) of the learned user vectors."""
    return user_vectors_table(spark, sf_dir).select(
        "fraction", F.col("userId").cast("long"), F.size(vector_to_array("features")).alias("dimension"))


def taste_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(fraction, n_users): users that got a taste cluster."""
    return taste_cluster_table(spark, sf_dir).groupBy("fraction").agg(F.sum("size").alias("n_users"))


def als_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(setting, rank, reg, fraction, n_train, n_scored): what each ALS fit learns from and is scored on.

    A test row is scored if its user and its movie are both in the training
    side, i.e. their first ratings are; cold ones are dropped.
    """
    ratings = _ratings(spark, sf_dir).select("userId", "movieId", "timestamp")
    users = ratings.groupBy("userId").agg(F.min("timestamp").alias("user_first"))
    films = ratings.groupBy("movieId").agg(F.min("timestamp").alias("movie_first"))
    rows = ratings.join(users, "userId").join(films, "movieId")
    counts = []
    for p, cut in sorted(_cuts(spark, sf_dir).items()):
        at = F.lit(cut)
        known = (F.col("user_first") <= at) & (F.col("movie_first") <= at)
        counts.append(F.struct(F.lit(float(p)).alias("fraction"), F.count_if(F.col("timestamp") <= at).alias("n_train"),
                               F.count_if((F.col("timestamp") > at) & known).alias("n_scored")))
    settings = [F.struct(F.lit(i).alias("setting"), F.lit(rank).alias("rank"), F.lit(float(reg)).alias("reg"))
                for i, (rank, reg) in enumerate(rs.ALS_SETTINGS, start=1)]
    return (rows.agg(F.array(*counts).alias("c")).select(F.inline("c"))
            .select(F.inline(F.array(*settings)), "fraction", "n_train", "n_scored"))


def taste_cluster_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    fits = _all_taste(spark, sf_dir)
    parts = []
    for p in sp.CHRONO_FRACTIONS:
        preds = fits[p][3]
        parts.append(rs.cluster_sizes(preds).select(F.lit(float(p)).alias("fraction"), "*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def cluster_genre_table(spark: SparkSession, sf_dir: str, mode: str = "anti") -> DataFrame:
    """M9: genre profile of each split's largest taste cluster, one plan for all splits."""
    fits = _all_taste(spark, sf_dir)
    members = None
    for p in sp.CHRONO_FRACTIONS:
        part = (rs.largest_group(fits[p][3], group_col="prediction")
                .select(F.lit(float(p)).alias("fraction"), "userId"))
        members = part if members is None else members.unionByName(part)
    return rs.genre_profiles(_ratings(spark, sf_dir), si.load_movies(spark, sf_dir), members,
                             _cuts(spark, sf_dir), mode=mode)

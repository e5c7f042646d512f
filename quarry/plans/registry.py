"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver's tables (through the stand-in builders) and runs
the whole table; the matching DuckDB text lives in :mod:`quarry.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import evaluation as ev
from quarry.operators import recsys as rs
from quarry.operators import splits as sp
from quarry.operators import tabular as tb
from quarry.operators import weblog as wl
from quarry.plans import workflows as wf
from quarry.sources import standins as si
from quarry.sources.files import cast_all, freeze
from quarry.sources.tables import load_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


# --------------------------------------------------------------- web log ---

def _parsed(spark, sf_dir):
    return wl.parse_log(si.load_access_log(spark, sf_dir))


@query("log_parse")
def q_log_parse(spark, sf_dir):
    return _parsed(spark, sf_dir)


@query("requests_by_group")
def q_requests_by_group(spark, sf_dir):
    return wl.requests_by_group(_parsed(spark, sf_dir))


@query("hosts_by_group")
def q_hosts_by_group(spark, sf_dir):
    return wl.hosts_by_group(_parsed(spark, sf_dir))


@query("org_requests")
def q_org_requests(spark, sf_dir):
    return wl.org_requests(_parsed(spark, sf_dir))


@query("org_topk")
def q_org_topk(spark, sf_dir):
    return (wl.top_k(wl.org_requests(_parsed(spark, sf_dir)), 9)
            .select("grp", "rank", "org", "requests"))


@query("org_topk_rest")
def q_org_topk_rest(spark, sf_dir):
    return wl.top_k_with_rest(wl.org_requests(_parsed(spark, sf_dir)), 9)


@query("org_share")
def q_org_share(spark, sf_dir):
    return wl.with_share(wl.top_k_with_rest(wl.org_requests(_parsed(spark, sf_dir)), 9))


def _leader_cells(spark, sf_dir):
    # written once: the log is scanned and parsed once, whatever is asked of the cells
    return wl.leader_cells(freeze(wl.org_hour_cells(_parsed(spark, sf_dir)), "org_hour_cells"))


@query("leader_requests")
def q_leader_requests(spark, sf_dir):
    return wl.leader_cell_requests(_leader_cells(spark, sf_dir))


@query("heat_sparse")
def q_heat_sparse(spark, sf_dir):
    return wl.cell_heat(_leader_cells(spark, sf_dir)).orderBy("grp", "day", "hour")


@query("heat_dense")
def q_heat_dense(spark, sf_dir):
    lc = _leader_cells(spark, sf_dir)
    return wl.dense_grid(wl.cell_heat(lc), wl.cell_span(lc))


@query("heat_peak")
def q_heat_peak(spark, sf_dir):
    return (wl.cell_heat(_leader_cells(spark, sf_dir)).groupBy("grp")
            .agg(F.max("requests").alias("peak_requests")))


@query("log_time_span")
def q_log_time_span(spark, sf_dir):
    return wl.cell_span(_leader_cells(spark, sf_dir))


# ------------------------------------------------------------ splits -------


def _particle(spark, sf_dir):
    return cast_all(si.load_particle_text(spark, sf_dir), "double", exclude=("row_key",))


@query("bulk_cast")
def q_bulk_cast(spark, sf_dir):
    return _particle(spark, sf_dir)


@query("percent_rank")
def q_percent_rank(spark, sf_dir):
    return sp.percent_rank(si.load_ratings(spark, sf_dir))


@query("chrono_split")
def q_chrono_split(spark, sf_dir):
    return sp.chrono_split_summary(si.load_ratings(spark, sf_dir))


@query("hash_split")
def q_hash_split(spark, sf_dir):
    return sp.hash_split(_particle(spark, sf_dir), "row_key", (0.7, 0.3), seed=21).select("row_key", "side")


@query("hash_sample")
def q_hash_sample(spark, sf_dir):
    return sp.hash_sample(_particle(spark, sf_dir), "row_key", 0.01, seed=42)


def _claims(spark, sf_dir):
    return tb.token_to_null(si.load_claims_raw(spark, sf_dir))


def _claims_train(spark, sf_dir):
    return (sp.hash_split(_claims(spark, sf_dir), "row_key", (0.7, 0.3), seed=21)
            .filter("side = 'train'").drop("side"))


@query("zero_positive_counts")
def q_zero_positive_counts(spark, sf_dir):
    return sp.zero_positive_counts(_claims_train(spark, sf_dir))


@query("downsample_union")
def q_downsample_union(spark, sf_dir):
    return sp.downsample(_claims_train(spark, sf_dir), "row_key", seed=3).select("row_key", "Claim_Amount")


# ------------------------------------------------------------ tabular ------

CLAIM_COLUMNS = wf.CLAIM_COLUMNS


@query("token_to_null")
def q_token_to_null(spark, sf_dir):
    return _claims(spark, sf_dir)


@query("null_profile")
def q_null_profile(spark, sf_dir):
    return tb.null_profile(_claims(spark, sf_dir), CLAIM_COLUMNS)


@query("mode_nullaware")
def q_mode_nullaware(spark, sf_dir):
    return tb.mode_nullaware(_claims(spark, sf_dir), CLAIM_COLUMNS)


def _filled(spark, sf_dir, cols=CLAIM_COLUMNS):
    return tb.fill_nulls(_claims(spark, sf_dir).select("row_key", *cols), cols)


def _long(df, cols, value_name, cast="string"):
    """Unpivot ``cols`` to (row_key, column_name, value): dropped columns have no rows."""
    return (df.select("row_key", *[F.col(c).cast(cast).alias(c) for c in cols])
            .unpivot(["row_key"], cols, "column_name", value_name))


@query("mode_fill")
def q_mode_fill(spark, sf_dir):
    filled = _filled(spark, sf_dir)
    return _long(filled, [c for c in CLAIM_COLUMNS if c in filled.columns], "value")


def _categorical(df):
    return [c for c in si.CLAIMS_STANDIN_CATEGORICAL if c in df.columns]


@query("string_index")
def q_string_index(spark, sf_dir):
    filled = _filled(spark, sf_dir, si.CLAIMS_STANDIN_CATEGORICAL)
    cats = _categorical(filled)
    _, out = tb.index_columns(filled, cats)
    long = _long(out.select("row_key", *[F.col(c + "_index").alias(c) for c in cats]),
                 cats, "index", cast="double")
    return long


@query("one_hot")
def q_one_hot(spark, sf_dir):
    filled = _filled(spark, sf_dir, si.CLAIMS_STANDIN_CATEGORICAL)
    cats = _categorical(filled)
    _, idx = tb.index_columns(filled, cats)
    _, enc = tb.one_hot(idx, [c + "_index" for c in cats], suffix="_ohe")
    cells = []
    for c in cats:
        size, hot = tb.hot_position(c + "_index_ohe")
        cells.append(F.struct(F.lit(c).alias("column_name"), size.alias("size"), hot.alias("hot")))
    return enc.select("row_key", F.inline(F.array(*cells)))


@query("claim_flag")
def q_claim_flag(spark, sf_dir):
    return tb.claim_flag(_claims(spark, sf_dir)).select("row_key", "Claim_Amount", "binary")


# ------------------------------------------------------------ recsys -------

@query("genre_explode")
def q_genre_explode(spark, sf_dir):
    return rs.genre_explode(si.load_movies(spark, sf_dir))


def _genre_profile(spark, sf_dir, mode):
    ratings = si.load_ratings(spark, sf_dir)
    members = rs.largest_group(si.user_segments(load_table(spark, sf_dir, "customer")))
    return rs.genre_profiles(ratings, si.load_movies(spark, sf_dir), members,
                             rs.chrono_cuts(ratings), mode=mode)


@query("genre_profile_anti")
def q_genre_profile_anti(spark, sf_dir):
    return _genre_profile(spark, sf_dir, "anti")


@query("genre_profile_semi")
def q_genre_profile_semi(spark, sf_dir):
    return _genre_profile(spark, sf_dir, "semi")


@query("cluster_outer_join")
def q_cluster_outer_join(spark, sf_dir):
    return rs.user_clusters_outer(si.load_ratings(spark, sf_dir),
                                  si.user_segments(load_table(spark, sf_dir, "customer")))


# ------------------------------------------------------------ metrics ------

@query("reg_metrics")
def q_reg_metrics(spark, sf_dir):
    return ev.regression_metrics(si.rule_regression(load_table(spark, sf_dir, "lineitem")), "label")


@query("cls_accuracy")
def q_cls_accuracy(spark, sf_dir):
    return ev.accuracy(si.rule_classification(load_table(spark, sf_dir, "lineitem")), "label")


@query("cls_f1")
def q_cls_f1(spark, sf_dir):
    return ev.weighted_f1(si.rule_classification(load_table(spark, sf_dir, "lineitem")), "label")


@query("auc_hard")
def q_auc_hard(spark, sf_dir):
    return ev.auc_hard(si.rule_classification(load_table(spark, sf_dir, "lineitem")), "label")


@query("auc_score")
def q_auc_score(spark, sf_dir):
    rows = load_table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_extendedprice") > 40000, 1.0).otherwise(0.0).alias("label"), F.col("l_quantity").alias("score"))
    return ev.auc_score(rows, "label", "score")


# ------------------------------------------------------- CSV round trips ---

query("ratings_csv")(si.load_ratings_csv)
query("movies_csv")(si.load_movies_csv)
query("particle_csv")(si.load_particle_csv)
query("claims_csv")(si.load_claims_csv)


# ------------------------------------------------- learned entries ---------

query("random_split_keys")(lambda spark, sf_dir: wf.random_split_table(spark, sf_dir).select("row_key"))
query("frozen_split_keys")(lambda spark, sf_dir: wf.frozen_split_table(spark, sf_dir).select("row_key"))
query("als_rows")(wf.als_rows)
query("user_vector_shape")(wf.user_vector_shape)
query("taste_users")(wf.taste_users)
query("log_link_glm")(wf.log_glm_table)

query("random_split_manifest")(wf.random_split_manifest)
query("frozen_split_manifest")(wf.frozen_split_manifest)
query("als_residual")(wf.als_residual)
query("taste_check")(wf.taste_check)
query("lasso_optimality")(wf.lasso_optimality)
query("glm_optimality")(wf.glm_optimality)
query("claim_tree_nodes")(wf.claim_tree_nodes)
query("two_part_product")(wf.two_part_product)


@query("ratings_sorted")
def q_ratings_sorted(spark, sf_dir):
    return sp.sorted_positions(si.load_ratings(spark, sf_dir), ["timestamp", "userId", "movieId", "rating"])


query("random_split")(wf.random_split_table)
query("parquet_frozen_split")(wf.frozen_split_table)
query("als_matrix")(wf.als_matrix)
query("user_vectors")(wf.user_vectors_table)
query("taste_clusters")(wf.taste_cluster_table)
query("cluster_genre_profile")(wf.cluster_genre_table)
query("rf_cv")(lambda spark, sf_dir: wf.cv_table(spark, sf_dir, "rf"))
query("gbt_cv")(lambda spark, sf_dir: wf.cv_table(spark, sf_dir, "gbt"))
query("mlp_cv")(lambda spark, sf_dir: wf.cv_table(spark, sf_dir, "mlp"))
query("best_params")(wf.best_params_table)
query("best_refit")(wf.refit_scores)
query("feature_importance")(wf.importance_table)
query("lasso")(wf.lasso_table)
query("claim_tree")(wf.tree_table)
query("gamma_glm")(wf.glm_table)
query("two_part")(wf.two_part_table)

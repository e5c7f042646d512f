"""DuckDB twins of the registered queries (the independent SQL oracle).

The text is written by hand against the same Parquet views and shares no
code path with the Spark side beyond the fixed values it must agree on.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# ------------------------------------------------------------- web log -----

LOG_CTE = r"""
log AS (
  SELECT 'h' || CAST(user_id AS VARCHAR) || '.dept' || CAST(user_id % 13 AS VARCHAR)
         || (['.ac.jp', '.ac.uk', '.edu', '.example.com'])[CAST(user_id % 4 AS INTEGER) + 1]
         || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' -0400] "GET /' || event_type
         || '.html HTTP/1.0" '
         || CASE WHEN event_type = 'error' THEN '404 -'
                 ELSE '200 ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS value
  FROM events
),
parsed AS (
  SELECT regexp_extract(value, '^(.*) - -.*', 1) AS host,
         regexp_extract(value, '.* - - \[(.*)\].*', 1) AS timestamp,
         regexp_extract(value, '.*"(.*)".*', 1) AS request,
         TRY_CAST(string_split(value, ' ')[-2] AS INTEGER) AS status,
         TRY_CAST(string_split(value, ' ')[-1] AS INTEGER) AS bytes
  FROM log
),
grouped AS (
  SELECT *, CASE WHEN ends_with(host, '.ac.jp') THEN 'JP'
                 WHEN ends_with(host, '.ac.uk') THEN 'UK'
                 WHEN ends_with(host, '.edu') THEN 'US' END AS grp
  FROM parsed
),
orgs AS (
  SELECT *, CASE WHEN grp IN ('JP', 'UK') THEN regexp_extract(host, '([^\.]+\.\w+\.\w+$)', 1)
                 ELSE regexp_extract(host, '([^\.]+\.\w+$)', 1) END AS org
  FROM grouped WHERE grp IS NOT NULL
),
org_counts AS (
  SELECT grp, org, COUNT(*) AS requests FROM orgs GROUP BY grp, org
),
ranked AS (
  SELECT grp, org, requests,
         ROW_NUMBER() OVER (PARTITION BY grp ORDER BY requests DESC, org ASC) AS rank
  FROM org_counts
),
topk AS (SELECT * FROM ranked WHERE rank <= 9),
topk_rest AS (
  SELECT grp, CAST(rank AS INTEGER) AS rank, org, requests FROM topk
  UNION ALL
  SELECT t.grp, 10 AS rank, 'rest' AS org,
         CAST(t.total - s.top AS BIGINT) AS requests
  FROM (SELECT grp, SUM(requests) AS total FROM org_counts GROUP BY grp) t
  JOIN (SELECT grp, SUM(requests) AS top FROM topk GROUP BY grp) s USING (grp)
),
leaders AS (SELECT grp, org AS leader FROM ranked WHERE rank = 1),
lead_rows AS (
  SELECT o.*, l.leader FROM orgs o JOIN leaders l
    ON o.grp = l.grp AND contains(o.org, l.leader)
),
heat AS (
  SELECT grp, string_split(timestamp, '/')[1] AS day,
         string_split(timestamp, ':')[2] AS hour, COUNT(*) AS requests
  FROM lead_rows GROUP BY ALL
),
lead_times AS (
  SELECT grp, try_strptime(split_part(timestamp, ' ', 1), '%d/%b/%Y:%H:%M:%S') AS t
  FROM lead_rows
)
"""


def _with(cte: str, body: str) -> str:
    return "WITH " + cte.strip() + "\n" + body.strip()


ORACLE["log_parse"] = _with(LOG_CTE, "SELECT * FROM parsed")
ORACLE["requests_by_group"] = _with(LOG_CTE, """
SELECT g.grp, COALESCE(c.requests, 0) AS requests
FROM (VALUES ('JP'), ('UK'), ('US')) g(grp)
LEFT JOIN (SELECT grp, COUNT(*) AS requests FROM grouped WHERE grp IS NOT NULL GROUP BY grp) c
USING (grp)""")
ORACLE["hosts_by_group"] = _with(LOG_CTE, """
SELECT g.grp, COALESCE(c.hosts, 0) AS hosts, COALESCE(c.requests, 0) AS requests
FROM (VALUES ('JP'), ('UK'), ('US')) g(grp)
LEFT JOIN (SELECT grp, COUNT(DISTINCT host) AS hosts, CAST(COUNT(*) AS BIGINT) AS requests
           FROM grouped WHERE grp IS NOT NULL GROUP BY grp) c
USING (grp)""")
ORACLE["org_requests"] = _with(LOG_CTE, "SELECT * FROM org_counts")
ORACLE["org_topk"] = _with(LOG_CTE, "SELECT grp, CAST(rank AS INTEGER) AS rank, org, requests FROM topk")
ORACLE["org_topk_rest"] = _with(LOG_CTE, "SELECT * FROM topk_rest")
ORACLE["org_share"] = _with(LOG_CTE, """
SELECT *, requests / SUM(requests) OVER (PARTITION BY grp) AS share FROM topk_rest""")
ORACLE["leader_requests"] = _with(LOG_CTE, """
SELECT grp, leader, COUNT(*) AS requests FROM lead_rows GROUP BY grp, leader""")
ORACLE["heat_sparse"] = _with(LOG_CTE, "SELECT * FROM heat ORDER BY grp, day, hour")
ORACLE["heat_dense"] = _with(LOG_CTE + """,
span AS (
  SELECT grp, CAST(MIN(t) AS DATE) AS d0, CAST(MAX(t) AS DATE) AS d1
  FROM lead_times GROUP BY grp
),
days AS (
  SELECT DISTINCT grp, strftime(d, '%d') AS day
  FROM span, unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS u(d)
),
grid AS (
  SELECT grp, day, lpad(CAST(h AS VARCHAR), 2, '0') AS hour
  FROM days, unnest(generate_series(0, 23)) AS v(h)
)""", """
SELECT grp, day, hour, COALESCE(h.requests, 0) AS requests
FROM grid g FULL OUTER JOIN heat h USING (grp, day, hour)
ORDER BY grp, day, hour""")
ORACLE["heat_peak"] = _with(LOG_CTE, "SELECT grp, MAX(requests) AS peak_requests FROM heat GROUP BY grp")
ORACLE["log_time_span"] = _with(LOG_CTE, """
SELECT grp, MIN(t) AS first_request, MAX(t) AS last_request FROM lead_times GROUP BY grp""")


# ------------------------------------------------------------ splits -------

KEY = "concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def _uniform(key_sql: str, seed: int) -> str:
    return (f"(CAST(CAST(('0x' || substr(md5('{seed}|' || {key_sql}), 1, 8)) AS BIGINT) AS DOUBLE)"
            f" / CAST(4294967296 AS DOUBLE))")


PARTICLE_CTE = f"""
particle AS (
  SELECT {KEY} AS row_key,
         CAST(CASE WHEN l_quantity * (1 - l_discount) > 24 THEN 1 ELSE 0 END AS DOUBLE) AS label,
         TRY_CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE) AS l_quantity,
         TRY_CAST(CAST(l_extendedprice AS VARCHAR) AS DOUBLE) AS l_extendedprice,
         TRY_CAST(CAST(l_discount AS VARCHAR) AS DOUBLE) AS l_discount,
         TRY_CAST(CAST(l_tax AS VARCHAR) AS DOUBLE) AS l_tax
  FROM lineitem
)"""

RATINGS_CTE = """
ratings AS (
  SELECT o_custkey AS userId, l_partkey AS movieId,
         CAST(ceil(l_quantity / 10) AS DOUBLE) AS rating,
         date_diff('second', TIMESTAMP '1970-01-01 00:00:00', o_orderdate) AS timestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
pr AS (SELECT *, percent_rank() OVER (ORDER BY timestamp) AS percent_rank FROM ratings),
fr AS (SELECT CAST(f AS DOUBLE) AS fraction FROM (VALUES (0.5), (0.65), (0.8)) v(f)),
tagged AS (
  SELECT fr.fraction, CASE WHEN percent_rank < fr.fraction THEN 'train' ELSE 'test' END AS side,
         userId, movieId, rating, timestamp
  FROM pr, fr
)"""

CLAIM_AMOUNT = f"""CASE WHEN {_uniform(KEY, 77)} < CAST(0.04 AS DOUBLE)
           + CASE WHEN l_quantity > 35 THEN CAST(0.15 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
           + CASE WHEN l_tax >= CAST(0.06 AS DOUBLE) AND p_size % 5 >= 3 THEN CAST(0.35 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
         THEN l_extendedprice * (CAST(0.05 AS DOUBLE) + l_tax) ELSE CAST(0 AS DOUBLE) END"""

CLAIMS_CTE = f"""
claims AS (
  SELECT {KEY} AS row_key,
         l_orderkey AS Row_ID, l_suppkey AS Household_ID, p_brand AS Blind_Make,
         CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_type END AS Cat1,
         l_linestatus AS Cat2,
         CASE WHEN l_returnflag = 'R' THEN l_returnflag ELSE NULL END AS Cat7,
         CAST(p_size % 5 + 1 AS VARCHAR) AS OrdCat,
         CAST(year(l_shipdate) AS INTEGER) AS Calendar_Year,
         l_quantity AS Var1, l_tax AS Var2, p_retailprice AS Var3, l_discount AS Var4,
         {CLAIM_AMOUNT} AS Claim_Amount
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
claims_train AS (
  SELECT * FROM claims WHERE {_uniform('row_key', 21)} < CAST(0.7 AS DOUBLE)
)"""

ORACLE["bulk_cast"] = _with(PARTICLE_CTE, "SELECT * FROM particle")
ORACLE["percent_rank"] = _with(RATINGS_CTE, "SELECT * FROM pr")
ORACLE["chrono_split"] = _with(RATINGS_CTE, """
SELECT fraction, side, COUNT(*) AS n_rows, MIN(timestamp) AS min_ts, MAX(timestamp) AS max_ts
FROM tagged GROUP BY fraction, side""")
ORACLE["hash_split"] = _with(PARTICLE_CTE, f"""
SELECT row_key, CASE WHEN {_uniform('row_key', 21)} < CAST(0.7 AS DOUBLE) THEN 'train' ELSE 'test' END AS side
FROM particle""")
ORACLE["hash_sample"] = _with(PARTICLE_CTE, f"""
SELECT * FROM particle WHERE {_uniform('row_key', 42)} < CAST(0.01 AS DOUBLE)""")
ORACLE["zero_positive_counts"] = _with(CLAIMS_CTE, """
SELECT COUNT(*) FILTER (WHERE Claim_Amount = 0) AS n_zero,
       COUNT(*) FILTER (WHERE Claim_Amount > 0) AS n_positive,
       COUNT(*) AS n_total,
       CAST(COUNT(*) FILTER (WHERE Claim_Amount > 0) AS DOUBLE)
         / CAST(COUNT(*) FILTER (WHERE Claim_Amount = 0) AS DOUBLE) AS fraction
FROM claims_train""")
ORACLE["downsample_union"] = _with(CLAIMS_CTE + """,
frac AS (
  SELECT LEAST(1.0, CAST(COUNT(*) FILTER (WHERE Claim_Amount > 0) AS DOUBLE)
                    / CAST(COUNT(*) FILTER (WHERE Claim_Amount = 0) AS DOUBLE)) AS f
  FROM claims_train
)""", f"""
SELECT row_key, Claim_Amount FROM claims_train, frac
WHERE Claim_Amount = 0 AND {_uniform('row_key', 3)} < frac.f
UNION ALL
SELECT row_key, Claim_Amount FROM claims_train WHERE Claim_Amount > 0""")

# ------------------------------------------------------------ CSV input ----

ORACLE["ratings_csv"] = _with(RATINGS_CTE, "SELECT * FROM ratings")
ORACLE["movies_csv"] = "SELECT p_partkey AS movieId, p_name AS title, replace(p_name, ' ', '|') AS genres FROM part"
_BASE = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
_PARTICLE_NAMES = [
    "lepton_pT", "lepton_eta", "lepton_phi", "missing_energy_magnitude",
    "missing_energy_phi", "jet_1_pt", "jet_1_eta", "jet_1_phi", "jet_1_btag",
    "jet_2_pt", "jet_2_eta", "jet_2_phi", "jet_2_btag", "jet_3_pt", "jet_3_eta",
    "jet_3_phi", "jet_3_btag", "jet_4_pt", "jet_4_eta", "jet_4_phi",
    "jet_4_btag", "mjj", "mjjj", "mlv", "mjlv", "mbb", "mwbb", "mwwbb"]
ORACLE["particle_csv"] = (
    "SELECT CAST(CASE WHEN l_quantity * (1 - l_discount) > 24 THEN 1 ELSE 0 END AS DOUBLE) AS label, "
    + ", ".join(f"CAST({_BASE[k % 4]} * {k + 1} AS DOUBLE) AS {name}" for k, name in enumerate(_PARTICLE_NAMES))
    + " FROM lineitem")


def _letter(key: str, n: int) -> str:
    return f"chr(CAST(65 + {key} % {n} AS INTEGER))"


ORACLE["claims_csv"] = f"""
SELECT l_orderkey AS Row_ID, l_suppkey AS Household_ID, CAST(l_linenumber AS BIGINT) AS Vehicle,
       year(l_shipdate) AS Calendar_Year, CAST(year(l_shipdate) - p_size % 7 AS BIGINT) AS Model_Year,
       p_brand AS Blind_Make, p_brand || '.' || (p_size % 5) AS Blind_Model, p_brand || '.' || p_size AS Blind_Submodel,
       CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_type END AS Cat1, l_linestatus AS Cat2,
       {_letter('l_partkey', 3)} AS Cat3, CASE WHEN l_linenumber > 5 THEN NULL ELSE {_letter('l_partkey', 4)} END AS Cat4,
       CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE {_letter('l_suppkey', 3)} END AS Cat5, {_letter('l_partkey', 6)} AS Cat6,
       CASE WHEN l_returnflag <> 'R' THEN NULL ELSE l_returnflag END AS Cat7, {_letter('l_suppkey', 2)} AS Cat8,
       {_letter('l_suppkey', 5)} AS Cat9, {_letter('l_orderkey', 3)} AS Cat10, {_letter('l_orderkey', 7)} AS Cat11,
       CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE {_letter('l_orderkey', 8)} END AS Cat12,
       CAST(p_size % 5 + 1 AS VARCHAR) AS OrdCat,
       {', '.join(f"l_quantity * {k} + l_tax AS Var{k}" for k in range(1, 9))},
       {_letter('l_linenumber', 9)} AS NVCat, {', '.join(f"l_discount * {k} AS NVVar{k}" for k in range(1, 5))},
       {CLAIM_AMOUNT} AS Claim_Amount
FROM lineitem JOIN part ON l_partkey = p_partkey"""

# ---------------------------------- deterministic part of learned entries ---

_ALL_KEYS = f"SELECT {KEY} AS row_key FROM lineitem"
ORACLE["random_split_keys"] = _ALL_KEYS
ORACLE["frozen_split_keys"] = _ALL_KEYS
_FIRST_CTE = RATINGS_CTE + """,
train AS (SELECT * FROM tagged WHERE side = 'train'),
test AS (SELECT * FROM tagged WHERE side = 'test'),
train_counts AS (SELECT fraction, COUNT(*) AS n_train FROM train GROUP BY fraction),
scored AS (
  SELECT fraction, COUNT(*) AS n_scored FROM test t
  WHERE EXISTS (SELECT 1 FROM train u WHERE u.fraction = t.fraction AND u.userId = t.userId)
    AND EXISTS (SELECT 1 FROM train m WHERE m.fraction = t.fraction AND m.movieId = t.movieId)
  GROUP BY fraction
)"""
ORACLE["als_rows"] = _with(_FIRST_CTE, """
SELECT CAST(s.setting AS INTEGER) AS setting, CAST(s.rank AS INTEGER) AS rank, CAST(s.reg AS DOUBLE) AS reg,
       fraction, n_train, COALESCE(n_scored, 0) AS n_scored
FROM train_counts LEFT JOIN scored USING (fraction),
     (VALUES (1, 10, 0.1), (2, 20, 0.1), (3, 20, 0.05)) s(setting, rank, reg)""")
ORACLE["user_vector_shape"] = _with(_FIRST_CTE, """
SELECT DISTINCT fraction, userId, CAST(10 AS INTEGER) AS dimension FROM train""")
ORACLE["taste_users"] = _with(_FIRST_CTE, """
SELECT fraction, COUNT(DISTINCT userId) AS n_users FROM train GROUP BY fraction""")

ORACLE["random_split_manifest"] = ORACLE["frozen_split_manifest"] = f"""
SELECT COUNT(*) AS n_rows, CAST(SUM(CAST(('0x' || substr(md5({KEY}), 1, 8)) AS BIGINT)) AS BIGINT) AS key_sum,
       CAST(0 AS BIGINT) AS shared_keys, TRUE AS share_ok
FROM lineitem"""

# What a fit must meet: the residuals and counts of misses are 0 and the claims TRUE; the sizes come from the tables.
ORACLE["als_residual"] = _with(_FIRST_CTE, """
SELECT CAST(s.setting AS INTEGER) AS setting, CAST(s.rank AS INTEGER) AS rank, CAST(s.reg AS DOUBLE) AS reg, fraction,
       COUNT(DISTINCT userId) AS n_users, COUNT(*) AS n_train, CAST(0 AS DOUBLE) AS residual, TRUE AS beats_mean
FROM train, (VALUES (1, 10, 0.1), (2, 20, 0.1), (3, 20, 0.05)) s(setting, rank, reg)
GROUP BY ALL""")
ORACLE["taste_check"] = _with(_FIRST_CTE, """
SELECT fraction, COUNT(DISTINCT userId) AS n_users, CAST(0 AS BIGINT) AS n_off, CAST(20 AS BIGINT) AS n_clusters, TRUE AS sizes_ok,
       TRUE AS largest_ok
FROM train GROUP BY fraction""")

_BALANCED_CTE = f"""
claims AS (SELECT *, concat_ws('|', Row_ID, Vehicle) AS row_key FROM ({ORACLE["claims_csv"]})),
sides AS (SELECT *, CASE WHEN {_uniform('row_key', 21)} < CAST(0.7 AS DOUBLE) THEN 'train' ELSE 'test' END AS side FROM claims),
train AS (SELECT * FROM sides WHERE side = 'train'),
frac AS (SELECT CAST(COUNT(*) FILTER (WHERE Claim_Amount > 0) AS DOUBLE) / COUNT(*) FILTER (WHERE Claim_Amount = 0) AS f FROM train),
balanced AS (
  SELECT train.* FROM train, frac WHERE Claim_Amount > 0 OR (Claim_Amount = 0 AND {_uniform('row_key', 3)} < f)
)"""
ORACLE["lasso_optimality"] = _with(_BALANCED_CTE, """
SELECT 'lasso' AS model, COUNT(*) AS n, CAST(0 AS DOUBLE) AS gap, TRUE AS better_than_ten FROM balanced""")
ORACLE["glm_optimality"] = _with(_BALANCED_CTE, """
SELECT link AS model, COUNT(*) AS n, CAST(0 AS DOUBLE) AS gap FROM balanced, (VALUES ('log')) l(link)
WHERE Claim_Amount > 0 GROUP BY link""")
ORACLE["claim_tree_nodes"] = _with(_BALANCED_CTE, """
SELECT CAST(0 AS INTEGER) AS id, COUNT(*) AS n, COUNT(*) FILTER (WHERE Claim_Amount > 0) AS positives,
       CAST(0 AS BIGINT) AS counts_off, CAST(0 AS BIGINT) AS impurity_off, CAST(0 AS BIGINT) AS gain_off, TRUE AS leaves_ok
FROM balanced""")
ORACLE["two_part_product"] = _with(_BALANCED_CTE, """
SELECT COUNT(*) AS n, CAST(0 AS BIGINT) AS n_off FROM sides WHERE side = 'test'""")
ORACLE["ratings_sorted"] = _with(RATINGS_CTE, """
SELECT ROW_NUMBER() OVER (ORDER BY timestamp, userId, movieId, rating) - 1 AS position, userId, movieId, rating, timestamp FROM ratings""")

# ------------------------------------------------------------ tabular ------

CLAIM_COLUMNS = ["Row_ID", "Household_ID", "Blind_Make", "Cat1", "Cat2", "Cat7", "OrdCat",
                 "Calendar_Year", "Var1", "Var2", "Var3", "Var4", "Claim_Amount"]
CLAIM_CATEGORICAL = ["Blind_Make", "Cat1", "Cat2", "OrdCat"]

_CELLS = "\n  UNION ALL ".join(
    f"SELECT row_key, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM claims"
    for c in CLAIM_COLUMNS)
_CATS = ", ".join(f"'{c}'" for c in CLAIM_CATEGORICAL)
MODES_CTE = CLAIMS_CTE + f""",
cells AS (
  {_CELLS}
),
modes AS (
  SELECT column_name, value AS mode, mode_count FROM (
    SELECT column_name, value, COUNT(*) AS mode_count,
           row_number() OVER (PARTITION BY column_name
                              ORDER BY COUNT(*) DESC, value ASC NULLS FIRST) AS rn
    FROM cells GROUP BY column_name, value) WHERE rn = 1
),
filled AS (
  SELECT c.row_key, c.column_name, COALESCE(c.value, m.mode) AS value
  FROM cells c JOIN modes m USING (column_name) WHERE m.mode IS NOT NULL
),
cat_cells AS (SELECT * FROM filled WHERE column_name IN ({_CATS})),
labels AS (
  SELECT column_name, value,
         row_number() OVER (PARTITION BY column_name ORDER BY COUNT(*) DESC, value ASC) - 1 AS idx,
         COUNT(*) OVER (PARTITION BY column_name) AS n_labels
  FROM cat_cells GROUP BY column_name, value
),
indexed AS (
  SELECT row_key, column_name, idx, n_labels FROM cat_cells JOIN labels USING (column_name, value)
)"""

ORACLE["token_to_null"] = _with(CLAIMS_CTE, "SELECT * FROM claims")
ORACLE["null_profile"] = _with(CLAIMS_CTE, "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM claims"
    for c in CLAIM_COLUMNS))
ORACLE["mode_nullaware"] = _with(MODES_CTE, "SELECT * FROM modes")
ORACLE["mode_fill"] = _with(MODES_CTE, "SELECT * FROM filled")
ORACLE["string_index"] = _with(MODES_CTE, """
SELECT row_key, column_name, CAST(idx AS DOUBLE) AS index FROM indexed""")
ORACLE["one_hot"] = _with(MODES_CTE, """
SELECT row_key, column_name, CAST(n_labels - 1 AS INTEGER) AS size,
       CASE WHEN idx < n_labels - 1 THEN CAST(idx AS INTEGER) END AS hot
FROM indexed""")
ORACLE["claim_flag"] = _with(CLAIMS_CTE, """
SELECT row_key, Claim_Amount, CASE WHEN Claim_Amount > 0 THEN 1 ELSE 0 END AS binary FROM claims""")

# ------------------------------------------------------------ recsys -------

MOVIES_CTE = """
movies AS (
  SELECT p_partkey AS movieId, p_name AS title,
         replace(p_name, ' ', '|') AS genres
  FROM part
)"""

PROFILE_CTE = RATINGS_CTE + "," + MOVIES_CTE + """,
top_seg AS (
  SELECT c_mktsegment AS cluster FROM customer GROUP BY c_mktsegment
  ORDER BY COUNT(*) DESC, c_mktsegment ASC LIMIT 1
),
members AS (
  SELECT c_custkey AS userId FROM customer
  WHERE c_mktsegment IN (SELECT cluster FROM top_seg)
),
liked AS (
  SELECT DISTINCT fraction, side, movieId FROM tagged
  WHERE rating >= 4 AND userId IN (SELECT userId FROM members)
),
sides AS (SELECT DISTINCT fraction, side FROM tagged)"""


def _profile(selection: str) -> str:
    return _with(PROFILE_CTE + f""",
chosen AS ({selection}),
g AS (SELECT fraction, side, unnest(string_split(genres, '|')) AS genre FROM chosen),
counts AS (SELECT fraction, side, genre, COUNT(*) AS movies FROM g GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY fraction, side ORDER BY movies DESC, genre ASC) AS rank
  FROM counts
)""", "SELECT fraction, side, CAST(rank AS INTEGER) AS rank, genre, movies FROM ranked WHERE rank <= 5")


ORACLE["genre_explode"] = _with(MOVIES_CTE, """
SELECT movieId, title, unnest(string_split(genres, '|')) AS genre FROM movies""")
ORACLE["genre_profile_anti"] = _profile("""
  SELECT s.fraction, s.side, m.movieId, m.genres FROM sides s, movies m
  WHERE NOT EXISTS (SELECT 1 FROM liked l
                    WHERE l.fraction = s.fraction AND l.side = s.side AND l.movieId = m.movieId)""")
ORACLE["genre_profile_semi"] = _profile("""
  SELECT l.fraction, l.side, m.movieId, m.genres FROM liked l JOIN movies m USING (movieId)""")
ORACLE["cluster_outer_join"] = _with(RATINGS_CTE, """
SELECT u.userId, s.cluster
FROM (SELECT DISTINCT userId FROM ratings) u
LEFT JOIN (SELECT c_custkey AS userId, c_mktsegment AS cluster FROM customer) s
USING (userId)""")

# ------------------------------------------------------------ metrics ------

ORACLE["reg_metrics"] = """
WITH e AS (
  SELECT floor(l_extendedprice / 1500) - l_quantity AS err FROM lineitem
)
SELECT COUNT(*) AS n, sqrt(SUM(err * err) / COUNT(*)) AS rmse, SUM(err * err) / COUNT(*) AS mse,
       SUM(abs(err)) / COUNT(*) AS mae
FROM e"""

CLS_CTE = """
cls AS (
  SELECT CASE WHEN l_extendedprice > 40000 THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
         CASE WHEN l_quantity > 25 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
  FROM lineitem
)"""
ORACLE["cls_accuracy"] = _with(CLS_CTE, """
SELECT COUNT(*) AS n, CAST(COUNT(*) FILTER (WHERE label = prediction) AS DOUBLE) / COUNT(*) AS accuracy
FROM cls""")
ORACLE["cls_f1"] = _with(CLS_CTE + """,
per AS (
  SELECT c.label, c.n_label, c.tp, COALESCE(p.n_pred, 0) AS n_pred FROM
    (SELECT label, COUNT(*) AS n_label, COUNT(*) FILTER (WHERE label = prediction) AS tp
     FROM cls GROUP BY label) c
  LEFT JOIN (SELECT prediction AS label, COUNT(*) AS n_pred FROM cls GROUP BY prediction) p
  USING (label)
),
pr AS (
  SELECT n_label,
         CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS prec,
         CASE WHEN n_label > 0 THEN tp / n_label ELSE 0.0 END AS rec
  FROM per
)""", """
SELECT CAST(SUM(n_label) AS BIGINT) AS n,
       SUM(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END * n_label)
         / SUM(n_label) AS f1
FROM pr""")
ORACLE["auc_hard"] = _with(CLS_CTE + """,
c AS (
  SELECT COUNT(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
         COUNT(*) FILTER (WHERE label = 1 AND prediction <> 1) AS fn,
         COUNT(*) FILTER (WHERE label <> 1 AND prediction = 1) AS fp,
         COUNT(*) FILTER (WHERE label <> 1 AND prediction <> 1) AS tn
  FROM cls
)""", """
SELECT tp + fn + fp + tn AS n, (1.0 + tp / (tp + fn) - fp / (fp + tn)) / 2 AS auc_hard FROM c""")
# The share of (positive, negative) pairs in the right order, ties counted half; quantities tie often.
ORACLE["auc_score"] = """
WITH c AS (
  SELECT l_quantity AS score, COUNT(*) FILTER (WHERE l_extendedprice > 40000) AS pos, COUNT(*) FILTER (WHERE l_extendedprice <= 40000) AS neg
  FROM lineitem GROUP BY l_quantity
),
b AS (SELECT *, SUM(neg) OVER (ORDER BY score) - neg AS below FROM c)
SELECT CAST(SUM(pos) + SUM(neg) AS BIGINT) AS n,
       CAST(SUM(pos * (2 * below + neg)) AS DOUBLE) / (2.0 * CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE)) AS auc_score
FROM b"""

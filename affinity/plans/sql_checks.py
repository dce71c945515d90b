"""DuckDB SQL equal in meaning to the registered Spark queries.

Used as independent oracles: the same tables, written as plain SQL with no
code shared with the Spark operators except the fixed constants.
"""

from __future__ import annotations

from affinity.functions.hashing import PRIME, params_values_sql
from affinity.operators.draws import KEYS as DRAW_KEYS, PRIME as DRAW_PRIME
from affinity.sources.fixtures import (DOC_WORDS_SQL, EVENT_ITEMS_SQL, LABELLED_DOCUMENTS_SQL,
                                       RATINGS_SQL, TEXTS_OF_PARTS_SQL, WORD_NUMBER_SQL)

K = 100


def split_cte(train: float = 0.6, val: float = 0.2, min_user: int = 5, min_item: int = 5) -> str:
    """CTEs r (ratings), f (filtered), s (with split)."""
    upper = train + val
    return f"""
r AS ({RATINGS_SQL}),
r1 AS (SELECT * FROM r WHERE item_id IN
        (SELECT item_id FROM r GROUP BY item_id HAVING count(*) >= {min_item})),
f AS (SELECT * FROM r1 WHERE user_id IN
        (SELECT user_id FROM r1 GROUP BY user_id HAVING count(*) >= {min_user})),
n AS (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) - 1)
                / count(*) OVER (PARTITION BY user_id) AS pos FROM f),
s AS (SELECT user_id, item_id, rating, ts,
             CASE WHEN pos <= {train!r} THEN 'train' WHEN pos <= {upper!r} THEN 'val'
                  ELSE 'test' END AS split FROM n)"""


def metrics_tail(hits_cte: str, users_cte: str, k: int = K) -> str:
    """Given CTE ``hits`` (user_id, rank) and ``users`` (user_id, n_rel)."""
    return f"""
{hits_cte},
{users_cte},
hj AS (SELECT user_id, rank, row_number() OVER (PARTITION BY user_id ORDER BY rank) AS j
       FROM hits),
st AS (SELECT user_id, count(*) AS n_hits, sum(1.0 / ln(rank + 1)) AS dcg,
              sum(j / rank) AS ap FROM hj GROUP BY user_id),
idcg AS (SELECT m, sum(1.0 / ln(m + 1)) OVER (ORDER BY m) AS idcg FROM range(1, {k + 1}) t(m)),
pu AS (SELECT u.user_id, u.n_rel, coalesce(st.n_hits, 0) AS n_hits, coalesce(st.dcg, 0) AS dcg,
              coalesce(st.ap, 0) AS ap, least(u.n_rel, {k}) AS m
       FROM users u LEFT JOIN st USING (user_id))
SELECT count(*) AS n_users,
       round(avg(n_hits / {float(k)}), 6) AS precision_at_k,
       round(avg(n_hits / n_rel), 6) AS recall_at_k,
       round(avg(dcg / idcg), 6) AS ndcg_at_k,
       round(avg(ap / pu.m), 6) AS map_at_k
FROM pu JOIN idcg ON pu.m = idcg.m"""


def popularity_quality(on: str = "test", k: int = K) -> str:
    return f"""
WITH {split_cte()},
pop AS (SELECT item_id, count(user_id) AS popularity FROM s WHERE split = 'train'
        GROUP BY item_id ORDER BY popularity DESC, item_id LIMIT {k}),
ranked AS (SELECT item_id, row_number() OVER (ORDER BY popularity DESC, item_id) AS rank
           FROM pop),
rel AS (SELECT DISTINCT user_id, item_id FROM s WHERE split = '{on}'),
{metrics_tail(
    "hits AS (SELECT rel.user_id, ranked.rank FROM rel JOIN ranked USING (item_id))",
    "users AS (SELECT user_id, count(*) AS n_rel FROM rel GROUP BY user_id)", k)}
"""


# ---------------------------------------------------------------- profiling

def ratings_profile() -> str:
    return f"""WITH r AS ({RATINGS_SQL})
SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_user_id,
       count(DISTINCT item_id) AS n_item_id FROM r"""


def null_counts_documents() -> str:
    cols = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]
    sel = ", ".join(f"CAST(sum(CAST({c} IS NULL AS INT)) AS BIGINT) AS {c}" for c in cols)
    return f"WITH d AS ({LABELLED_DOCUMENTS_SQL}) SELECT {sel} FROM d"


def rating_distribution() -> str:
    return f"""WITH r AS ({RATINGS_SQL})
SELECT rating, count(*) AS "count" FROM r GROUP BY rating ORDER BY rating"""


def part_name_word_counts() -> str:
    return """SELECT value, count(*) AS "count"
FROM (SELECT unnest(string_split(p_name, ' ')) AS value FROM part)
GROUP BY value ORDER BY "count" DESC, value"""


def describe_sql(source_cte: str, col: str) -> str:
    return f"""WITH src AS ({source_cte})
SELECT '{col}' AS "column", count({col}) AS "count", round(avg({col}::DOUBLE), 6) AS mean,
       round(stddev_samp({col}::DOUBLE), 6) AS stddev, round(min({col})::DOUBLE, 6) AS "min",
       round(quantile_cont({col}::DOUBLE, 0.25), 6) AS p25,
       round(quantile_cont({col}::DOUBLE, 0.5), 6) AS p50,
       round(quantile_cont({col}::DOUBLE, 0.75), 6) AS p75,
       round(max({col})::DOUBLE, 6) AS "max" FROM src"""


def rating_summary() -> str:
    return describe_sql(RATINGS_SQL, "rating")


def doc_set_size_summary() -> str:
    return describe_sql(
        f"SELECT doc_id, count(*) AS n_items FROM ({DOC_WORDS_SQL}) GROUP BY doc_id", "n_items")


def texts_csv_roundtrip() -> str:
    return TEXTS_OF_PARTS_SQL


def ratings_schema() -> str:
    return f"""WITH r AS ({RATINGS_SQL})
SELECT CAST(unnest([0, 1, 2, 3]) AS INT) AS position, unnest(['user_id', 'item_id', 'rating', 'ts']) AS name,
       unnest(['int', 'int', 'double', (SELECT CASE typeof(any_value(ts)) WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(typeof(any_value(ts))) END FROM r)]) AS type,
       unnest([TRUE, TRUE, TRUE, TRUE]) AS nullable,
       unnest([(SELECT count(user_id) FROM r), (SELECT count(item_id) FROM r), (SELECT count(rating) FROM r), (SELECT count(ts) FROM r)]) AS n_present"""


def ratings_sample(n: int = 20) -> str:
    return f"""WITH r AS ({RATINGS_SQL})
SELECT * FROM r ORDER BY user_id, item_id LIMIT {n}"""


def sparse_filter_report() -> str:
    return f"""WITH {split_cte()},
b AS (SELECT count(*) AS rows_before, count(DISTINCT user_id) AS users_before,
             count(DISTINCT item_id) AS items_before FROM r),
a AS (SELECT count(*) AS rows_after, count(DISTINCT user_id) AS users_after,
             count(DISTINCT item_id) AS items_after FROM f)
SELECT *, rows_before - rows_after AS rows_dropped, users_before - users_after AS users_dropped,
       items_before - items_after AS items_dropped FROM b, a"""


# ---------------------------------------------------------------- MinHash / LSH

def sig_ctes(src_sql: str, user: str, min_items: int = 3, n_bands: int = 32,
             rows: int = 4) -> str:
    """CTEs: sets, sizes, hp, h (user, i, h), sig (user, n_items, sig list),
    bnd (user, band_idx, band list), cand (user pairs), grp (signature groups)."""
    number = WORD_NUMBER_SQL if user == "doc_id" else "item_id"
    return f"""
src AS ({src_sql}),
sets AS (SELECT DISTINCT {user} AS u, item_id FROM src WHERE item_id IS NOT NULL),
sizes AS (SELECT u, count(*) AS n_items FROM sets GROUP BY u HAVING count(*) >= {min_items}),
hp AS (SELECT * FROM (VALUES {params_values_sql()}) t(i, a, b)),
h AS (SELECT s.u, hp.i, min((hp.a::BIGINT * s.number + hp.b) % {PRIME}) AS h
      FROM (SELECT u, {number} AS number FROM sets) s JOIN sizes USING (u) CROSS JOIN hp GROUP BY s.u, hp.i),
sig AS (SELECT h.u, sizes.n_items, list(h.h ORDER BY h.i) AS sig
        FROM h JOIN sizes USING (u) GROUP BY h.u, sizes.n_items),
bnd AS (SELECT u, i // {rows} AS band_idx, list(h ORDER BY i) AS band FROM h
        GROUP BY u, i // {rows}),
cand AS (SELECT x.u AS user1, y.u AS user2, count(*) AS "count"
         FROM bnd x JOIN bnd y ON x.band_idx = y.band_idx AND x.band = y.band AND x.u < y.u
         GROUP BY x.u, y.u),
grp AS (SELECT sig, min(u) AS rep, count(*) AS n FROM sig GROUP BY sig)"""


def signature_counts(src_sql: str, user: str) -> str:
    return f"""WITH {sig_ctes(src_sql, user, min_items=1)},
e AS (SELECT sig, count(*) AS n, count(*) FILTER (n_items >= 3) AS big FROM sig GROUP BY sig)
SELECT CAST(sum(n) AS BIGINT) AS n_users, count(*) AS n_signatures, CAST(sum(big) AS BIGINT) AS n_users_filtered,
       count(*) FILTER (big > 0) AS n_signatures_filtered FROM e"""


def signature_digest(src_sql: str, user: str) -> str:
    return f"""WITH {sig_ctes(src_sql, user)}
SELECT u AS {user}, n_items, sig[1]::INT AS h_first, sig[128]::INT AS h_last,
       list_sum(sig)::BIGINT AS h_sum FROM sig"""


def signature_clusters(src_sql: str, user: str, k: int = 10) -> str:
    return f"""WITH {sig_ctes(src_sql, user)}
SELECT min(u) AS rep, count(*) AS n_users, sig[1]::INT AS h_first FROM sig GROUP BY sig
ORDER BY n_users DESC, rep LIMIT {k}"""


def cluster_members(src_sql: str, user: str, k: int = 1) -> str:
    return f"""WITH {sig_ctes(src_sql, user)},
top AS (SELECT sig, min(u) AS rep FROM sig GROUP BY sig ORDER BY count(*) DESC, rep LIMIT {k}),
who AS (SELECT top.rep, sig.u FROM sig JOIN top ON sig.sig = top.sig)
SELECT who.rep, who.u AS {user}, src.item_id FROM who JOIN src ON src.{user} = who.u"""


def lsh_buckets(src_sql: str, user: str) -> str:
    return f"""WITH {sig_ctes(src_sql, user)}
SELECT band_idx, band[1]::INT AS b0, band[2]::INT AS b1, band[3]::INT AS b2, band[4]::INT AS b3,
       count(*) AS n_users, min(u) AS min_user, max(u) AS max_user
FROM bnd GROUP BY band_idx, band"""


def bucket_stats(src_sql: str, user: str) -> str:
    return f"""WITH {sig_ctes(src_sql, user)},
bk AS (SELECT count(*) AS n_users FROM bnd GROUP BY band_idx, band)
SELECT count(*) AS n_buckets, round(avg(n_users), 6) AS mean_size,
       round(stddev_samp(n_users), 6) AS stddev_size,
       min(n_users) AS min_size, round(quantile_cont(n_users, 0.5), 6) AS median_size,
       CAST(sum(CAST(n_users > 1 AS BIGINT)) AS BIGINT) AS n_shared_buckets,
       max(n_users) AS max_size FROM bk"""


def candidate_pairs(src_sql: str, user: str) -> str:
    return f"""WITH {sig_ctes(src_sql, user)}
SELECT a.rep AS rep1, b.rep AS rep2, a.n AS n1, b.n AS n2, c."count"
FROM cand c JOIN grp a ON a.rep = c.user1 JOIN grp b ON b.rep = c.user2
UNION ALL SELECT rep, rep, n, n, 32 FROM grp WHERE n > 1"""


def similar_pairs_with_sets(src_sql: str, user: str) -> str:
    return f"""WITH {top_pairs_cte(src_sql, user)}
SELECT t.user1, t.user2, s.item_id, bool_or(s.u = t.user1) AS in1, bool_or(s.u = t.user2) AS in2
FROM top t JOIN sets s ON s.u = t.user1 OR s.u = t.user2 GROUP BY t.user1, t.user2, s.item_id"""


def top_pairs(src_sql: str, user: str, k: int = K) -> str:
    return f"""WITH {sig_ctes(src_sql, user)}
SELECT * FROM cand ORDER BY "count" DESC, user1, user2 LIMIT {k}"""


def top_pairs_cte(src_sql: str, user: str, k: int = K) -> str:
    return f"""{sig_ctes(src_sql, user)},
top AS (SELECT * FROM cand ORDER BY "count" DESC, user1, user2 LIMIT {k})"""


def similar_pairs(src_sql: str, user: str, k: int = K) -> str:
    return f"""WITH {top_pairs_cte(src_sql, user, k)},
allsz AS (SELECT u, count(*) AS n FROM sets GROUP BY u),
sh AS (SELECT t.user1, t.user2, count(*) AS n_shared FROM top t
       JOIN sets a ON a.u = t.user1 JOIN sets b ON b.u = t.user2 AND b.item_id = a.item_id
       GROUP BY t.user1, t.user2)
SELECT t.user1, t.user2, t."count", s1.n AS n_items1, s2.n AS n_items2,
       coalesce(sh.n_shared, 0) AS n_shared,
       coalesce(sh.n_shared, 0)::DOUBLE / (s1.n + s2.n - coalesce(sh.n_shared, 0)) AS jaccard
FROM top t JOIN allsz s1 ON s1.u = t.user1 JOIN allsz s2 ON s2.u = t.user2
LEFT JOIN sh ON sh.user1 = t.user1 AND sh.user2 = t.user2"""


def jaccard_summary(src_sql: str, user: str, k: int = K) -> str:
    return f"""WITH sp AS ({similar_pairs(src_sql, user, k)})
SELECT 'jaccard' AS "column", count(jaccard) AS "count", round(avg(jaccard), 6) AS mean,
       round(stddev_samp(jaccard), 6) AS stddev, round(min(jaccard), 6) AS "min",
       round(quantile_cont(jaccard, 0.25), 6) AS p25, round(quantile_cont(jaccard, 0.5), 6) AS p50,
       round(quantile_cont(jaccard, 0.75), 6) AS p75, round(max(jaccard), 6) AS "max" FROM sp"""


# ---------------------------------------------------------------- pair validation

def _pearson(x: str, y: str) -> str:
    return f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)"


def _scrambled(rows: str) -> str:
    """Rows (i, x, n, half) with x scrambled: rounds on (left, right) = (x div half, x mod half)."""
    sql = f"SELECT i, n, half, x // half AS l, x % half AS r FROM {rows}"
    for a, b, c in DRAW_KEYS:
        for step in (f"(r * {a} + {b}) % {DRAW_PRIME}", f"(t * t + {c}) % {DRAW_PRIME}", f"(t * t + {a}) % {DRAW_PRIME}"):
            sql = f"SELECT i, n, half, l, r, {step} AS t FROM ({sql})"
        sql = f"SELECT i, n, half, r AS l, (l + t) % half AS r FROM ({sql})"
    return f"SELECT i, l * half + r AS x, n, half FROM ({sql})"


def random_pairs_cte(src: str, n: int) -> str:
    """rp: the first n draws of pairs, by a Feistel network that walks until it is back in range."""
    return f"""
ru AS MATERIALIZED (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS k FROM (SELECT DISTINCT user_id FROM {src} WHERE user_id IS NOT NULL)),
rn AS MATERIALIZED (SELECT count(*) AS u, count(*) * (count(*) - 1) // 2 AS n FROM ru),
rh AS MATERIALIZED (SELECT u, n, (SELECT min(1::BIGINT << b) FROM range(31) t(b) WHERE (1::BIGINT << b) * (1::BIGINT << b) >= n) AS half FROM rn),
rdraw AS MATERIALIZED (
  WITH RECURSIVE walk AS (
    ({_scrambled(f"(SELECT i, i AS x, n, half FROM range({n}) d(i), rh WHERE i < n)")})
    UNION ALL
    ({_scrambled("(SELECT * FROM walk WHERE x >= n)")}))
  SELECT x FROM walk WHERE x < n),
rp AS (SELECT least(a.user_id, b.user_id) AS user1, greatest(a.user_id, b.user_id) AS user2
       FROM rdraw, rn JOIN ru a ON a.k = x % u JOIN ru b ON b.k = (x % u + x // u + 1) % u)"""


def shared_cte(pairs: str, src: str, name: str = "sh") -> str:
    return f"""{name} AS (SELECT p.user1, p.user2, a.item_id, a.rating AS rating1, b.rating AS rating2
       FROM {pairs} p JOIN {src} a ON a.user_id = p.user1
       JOIN {src} b ON b.user_id = p.user2 AND b.item_id = a.item_id)"""


def corr_cte(shared: str, name: str) -> str:
    return f"""{name} AS (SELECT user1, user2, {_pearson('rating1', 'rating2')} AS rating_correlation,
       count(*) AS overlap_count FROM {shared} GROUP BY user1, user2)"""


def spread(x: str) -> str:
    return (f"round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS sd, "
            f"min({x}) AS least, max({x}) AS most")


def summary_select(src: str) -> str:
    return f"""SELECT count(*) AS n_pairs, round(avg(rating_correlation), 6) AS mean,
       round(stddev_samp(rating_correlation), 6) AS sd, round(min(rating_correlation), 6) AS least,
       round(max(rating_correlation), 6) AS most, round(avg(overlap_count), 6) AS mean_overlap FROM {src}"""


def _events_top() -> str:
    return f"""{top_pairs_cte(EVENT_ITEMS_SQL, 'user_id')},
{shared_cte('top', 'src')},
c AS (SELECT user1, user2, {_pearson('rating1', 'rating2')} AS rating_correlation,
             count(*) AS overlap_count FROM sh GROUP BY user1, user2)"""


def similar_pair_correlations() -> str:
    return f"""WITH {_events_top()}
SELECT user1, user2, round(rating_correlation, 6) AS rating_correlation, overlap_count FROM c"""


def similar_correlation_summary() -> str:
    return f"""WITH {_events_top()}
{summary_select('c WHERE rating_correlation IS NOT NULL')}"""


def _pick(src: str, n: int = 100) -> str:
    return f"SELECT * FROM {src} ORDER BY md5(user1 || ':' || user2), user1, user2 LIMIT {n}"


def random_pairs_ratings(n: int = 1000) -> str:
    return f"WITH r AS ({RATINGS_SQL}), {random_pairs_cte('r', n)} SELECT * FROM rp"


def random_pairs_events(n: int = 1000) -> str:
    return f"WITH r AS ({EVENT_ITEMS_SQL}), {random_pairs_cte('r', n)} SELECT * FROM rp"


def random_correlation_summary(n: int = 1000) -> str:
    return f"""WITH r AS ({RATINGS_SQL}), {random_pairs_cte('r', n)},
{shared_cte('rp', 'r', 'rsh')},
{corr_cte('rsh', 'rc')},
pick AS ({_pick('(SELECT * FROM rc WHERE rating_correlation IS NOT NULL)')})
{summary_select('pick')}"""


def _dropped_ctes(n: int = 1000) -> str:
    return f"""r AS ({RATINGS_SQL}), {random_pairs_cte('r', n)},
{shared_cte('rp', 'r', 'rsh')},
{corr_cte('rsh', 'rc')},
st AS (SELECT rp.user1, rp.user2, rc.overlap_count, rc.rating_correlation FROM rp LEFT JOIN rc USING (user1, user2)),
dropped AS (SELECT user1, user2, overlap_count FROM st WHERE rating_correlation IS NULL),
{shared_cte('dropped', 'r', 'dsh')}"""


def defined_pairs_ratings() -> str:
    return f"""WITH {_dropped_ctes()} SELECT user1, user2, round(rating_correlation, 6) AS rating_correlation, overlap_count
FROM st WHERE rating_correlation IS NOT NULL"""


def dropped_pairs_ratings() -> str:
    return f"WITH {_dropped_ctes()} SELECT user1, user2, overlap_count FROM dropped"


def dropped_overlap_summary() -> str:
    return f"WITH {_dropped_ctes()} SELECT count(*) AS n_pairs, {spread('overlap_count')} FROM dropped"


def zero_variance_pairs() -> str:
    return f"""WITH {_dropped_ctes()}
SELECT user1, user2, count(*) AS n_shared, count(DISTINCT rating1) = 1 AS constant1, count(DISTINCT rating2) = 1 AS constant2
FROM dsh GROUP BY user1, user2 HAVING constant1 OR constant2"""


def rating_gap() -> str:
    return f"""WITH {_dropped_ctes()}
SELECT user1, user2, round(avg(rating1), 6) AS mean1, round(avg(rating2), 6) AS mean2,
       round(abs(avg(rating1) - avg(rating2)), 6) AS gap
FROM dsh GROUP BY user1, user2"""


def similar_vs_random(n: int = 1000) -> str:
    return f"""WITH {_events_top()},
{random_pairs_cte('src', n)},
{shared_cte('rp', 'src', 'rsh')},
{corr_cte('rsh', 'rc')},
pick AS ({_pick('(SELECT * FROM rc WHERE rating_correlation IS NOT NULL)')})
SELECT *, 'similar' AS "group" FROM ({summary_select('c WHERE rating_correlation IS NOT NULL')})
UNION ALL
SELECT *, 'random' AS "group" FROM ({summary_select('pick')})"""


# ---------------------------------------------------------------- properties of ALS fits

def _als_users(split: str) -> str:
    """Users of a split that the model knows from train."""
    return (f"(SELECT count(*) FROM (SELECT DISTINCT user_id FROM s WHERE split = '{split}' "
            f"AND user_id IN (SELECT user_id FROM s WHERE split = 'train')))")


def als_explicit_test() -> str:
    return f"WITH {split_cte()} SELECT {_als_users('test')} AS n_users, TRUE AS fit_optimal, TRUE AS metrics_in_range"


als_implicit_test = als_explicit_test


def als_recommendations(k: int = K) -> str:
    return f"""WITH {split_cte()},
tr AS (SELECT DISTINCT user_id, item_id FROM s WHERE split = 'train'),
most AS (SELECT least({k}, count(DISTINCT item_id)) AS n FROM tr)
SELECT user_id, n AS n_items, 1 AS first_rank, CAST(n AS INT) AS last_rank, n AS n_distinct, n AS n_from_train, TRUE AS ordered
FROM (SELECT DISTINCT user_id FROM tr), most"""


def _tuning(grid: list[tuple]) -> str:
    rows = ", ".join(f"({r}, {g}::DOUBLE, {'NULL' if a is None else float(a)}::DOUBLE)" for r, a, g in grid)
    return f"""WITH {split_cte()}
SELECT 'val' AS split, CAST(rank AS INT) AS rank, reg, alpha, {_als_users('val')} AS n_users, TRUE AS metrics_in_range,
       CAST(NULL AS BOOLEAN) AS best_of_grid FROM (VALUES {rows}) t(rank, reg, alpha)
UNION ALL SELECT 'test', NULL, NULL, NULL, {_als_users('test')}, TRUE, TRUE"""


# Fixed values of the study: ranks, regularisation, confidence weights.
def als_explicit_tuning() -> str:
    return _tuning([(r, None, g) for r in (20, 25, 30) for g in (0.04, 0.05, 0.06)])


def als_implicit_tuning() -> str:
    return _tuning([(r, a, g) for r in (25, 26) for a in (1, 5, 10) for g in (0.125, 0.15)])


# ---------------------------------------------------------------- splits and popularity

def time_split_rows() -> str:
    return f"WITH {split_cte()} SELECT user_id, item_id, rating, ts, split FROM s"


def split_sizes() -> str:
    return f"WITH {split_cte()} SELECT split, count(*) AS n_rows FROM s GROUP BY split"


def _faults_cte() -> str:
    """s0: the split; s: with the faults of plans/recsys put in."""
    return split_cte().replace("\ns AS (", "\ns0 AS (") + """,
s AS (SELECT user_id, item_id, rating, ts, CASE WHEN user_id % 3 = 0 AND split = 'train' THEN 'test'
             WHEN user_id % 3 = 0 AND split = 'test' THEN 'train' ELSE split END AS split FROM s0
      UNION ALL SELECT user_id, item_id, rating, ts, 'test' FROM s0 WHERE split = 'train' AND item_id % 5 = 0)"""


def split_overlap(ctes: str | None = None) -> str:
    return f"""WITH {ctes or split_cte()},
tr AS (SELECT DISTINCT user_id, item_id FROM s WHERE split = 'train'),
va AS (SELECT DISTINCT user_id, item_id FROM s WHERE split = 'val'),
te AS (SELECT DISTINCT user_id, item_id FROM s WHERE split = 'test')
SELECT (SELECT count(*) FROM (SELECT * FROM tr INTERSECT SELECT * FROM va)) AS train_val,
       (SELECT count(*) FROM (SELECT * FROM tr INTERSECT SELECT * FROM te)) AS train_test,
       (SELECT count(*) FROM (SELECT * FROM va INTERSECT SELECT * FROM te)) AS val_test"""


def split_overlap_faults() -> str:
    return split_overlap(_faults_cte())


def split_ranges() -> str:
    return f"WITH {split_cte()} SELECT split, min(ts) AS min_ts, max(ts) AS max_ts FROM s GROUP BY split"


def split_order_violations(ctes: str | None = None) -> str:
    return f"""WITH {ctes or split_cte()},
pu AS (SELECT user_id,
              max(CASE WHEN split = 'train' THEN ts END) AS train_max,
              min(CASE WHEN split = 'val' THEN ts END) AS val_min,
              max(CASE WHEN split = 'val' THEN ts END) AS val_max,
              min(CASE WHEN split = 'test' THEN ts END) AS test_min FROM s GROUP BY user_id)
SELECT * FROM pu WHERE train_max > val_min OR val_max > test_min OR train_max > test_min"""


def split_order_faults() -> str:
    return split_order_violations(_faults_cte())


def _pop_cte(k: int = K) -> str:
    return f"""{split_cte()},
pop AS (SELECT item_id, count(user_id) AS popularity FROM s WHERE split = 'train'
        GROUP BY item_id ORDER BY popularity DESC, item_id LIMIT {k}),
ranked AS (SELECT item_id, popularity,
                  CAST(row_number() OVER (ORDER BY popularity DESC, item_id) AS INT) AS rank
           FROM pop)"""


def popular_items() -> str:
    return f"WITH {_pop_cte()} SELECT item_id, popularity, rank FROM ranked"


def popular_recommendations() -> str:
    return f"""WITH {_pop_cte()}
SELECT u.user_id, ranked.rank, ranked.item_id
FROM (SELECT DISTINCT user_id FROM s WHERE split = 'test') u CROSS JOIN ranked"""


def popularity_per_user(k: int = K) -> str:
    return f"""WITH {_pop_cte(k)},
rel AS (SELECT DISTINCT user_id, item_id FROM s WHERE split = 'test'),
hits AS (SELECT rel.user_id, ranked.rank FROM rel JOIN ranked USING (item_id)),
users AS (SELECT user_id, count(*) AS n_rel FROM rel GROUP BY user_id),
hj AS (SELECT user_id, rank, row_number() OVER (PARTITION BY user_id ORDER BY rank) AS j FROM hits),
st AS (SELECT user_id, count(*) AS n_hits, sum(1.0 / ln(rank + 1)) AS dcg, sum(j / rank) AS ap
       FROM hj GROUP BY user_id),
idcg AS (SELECT m, sum(1.0 / ln(m + 1)) OVER (ORDER BY m) AS idcg FROM range(1, {k + 1}) t(m))
SELECT u.user_id, u.n_rel, coalesce(st.n_hits, 0) AS n_hits,
       round(coalesce(st.n_hits, 0) / {float(k)}, 6) AS precision_at_k,
       round(coalesce(st.n_hits, 0) / u.n_rel, 6) AS recall_at_k,
       round(coalesce(st.dcg, 0) / idcg.idcg, 6) AS ndcg_at_k,
       round(coalesce(st.ap, 0) / least(u.n_rel, {k}), 6) AS map_at_k
FROM users u LEFT JOIN st USING (user_id) JOIN idcg ON idcg.m = least(u.n_rel, {k})"""


def implicit_ratings() -> str:
    return (f"WITH {split_cte()} SELECT user_id, item_id, CAST(1.0 AS DOUBLE) AS rating "
            f"FROM s WHERE split = 'train'")


def ratings_csv_roundtrip() -> str:
    return f"""WITH r AS ({RATINGS_SQL})
SELECT user_id, item_id, rating FROM r
WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND rating IS NOT NULL"""


def popularity_sample_lists(n: int = 5) -> str:
    return f"""WITH {_pop_cte()},
test AS (SELECT DISTINCT user_id, item_id FROM s WHERE split = 'test'),
chosen AS (SELECT DISTINCT user_id FROM test ORDER BY user_id LIMIT {n})
SELECT c.user_id, 'predicted' AS source, CAST(ranked.rank AS INT) AS rank, ranked.item_id
FROM chosen c CROSS JOIN ranked
UNION ALL
SELECT t.user_id, 'actual' AS source, CAST(NULL AS INT) AS rank, t.item_id
FROM test t JOIN chosen c USING (user_id)"""

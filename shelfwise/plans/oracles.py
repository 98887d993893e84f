"""The registered queries in SQL, over the same tables, for an independent engine."""

from shelfwise.schemas import EMPTY_MESSAGE

# Name -> (tables it builds on, text). ``_with`` puts together what a query needs.
STEPS = {
    "reviews": ((), """
        SELECT CASE WHEN l_partkey % 101 = 0 THEN NULL
                    ELSE 'U' || CAST(o_custkey AS VARCHAR) END AS reviewerID,
               'P' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS asin,
               CASE WHEN l_suppkey % 53 = 0 THEN NULL ELSE l_quantity / 8 END AS overall
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "complete": (("reviews",), """
        SELECT reviewerID AS user_id, asin AS product_id, overall AS rating FROM reviews
        WHERE reviewerID IS NOT NULL AND asin IS NOT NULL AND overall IS NOT NULL"""),
    "ratings": (("complete",), """
        SELECT DISTINCT user_id, product_id, rating FROM complete
        WHERE rating BETWEEN 1 AND 5"""),
    "users": (("ratings",), """
        SELECT user_id, count(*) AS n,
               CAST(row_number() OVER (ORDER BY count(*) DESC, user_id) - 1 AS INTEGER)
                   AS user_id_int
        FROM ratings GROUP BY user_id"""),
    "products": (("ratings",), """
        SELECT product_id, count(*) AS n,
               CAST(row_number() OVER (ORDER BY count(*) DESC, product_id) - 1 AS INTEGER)
                   AS product_id_int
        FROM ratings GROUP BY product_id"""),
    "encoded": (("ratings", "users", "products"), """
        SELECT r.user_id, r.product_id, r.rating, u.user_id_int, p.product_id_int,
               substr(md5(r.user_id || '|' || r.product_id), 1, 8) AS h
        FROM ratings r JOIN users u ON r.user_id = u.user_id
                       JOIN products p ON r.product_id = p.product_id"""),
    "train": (("encoded",), "SELECT * FROM encoded WHERE h >= '33333333'"),
    "test": (("encoded",), "SELECT * FROM encoded WHERE h < '33333333'"),
    "sparse_train": (("encoded",), "SELECT * FROM encoded WHERE h >= 'f8000000'"),
    "sparse_test": (("encoded",), "SELECT * FROM encoded WHERE h < 'f8000000'"),
    "requests": ((), """
        SELECT event_id AS request_id, user_id * 20 AS user_id,
               CAST(event_id % 7 AS INTEGER) AS n FROM events"""),
    "stored": ((), """
        SELECT o_custkey * 3 AS user_id, CAST(o_orderkey % 2147483647 AS INTEGER) AS product_id,
               o_totalprice AS score,
               strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp"
        FROM orders"""),
    "first_stored": (("stored",), """
        SELECT user_id, product_id, score, "timestamp" FROM stored
        QUALIFY row_number() OVER (
            PARTITION BY user_id ORDER BY "timestamp", product_id, score) = 1"""),
    "sizes": (("users", "products"), """
        SELECT (SELECT count(*) FROM users) AS n_users,
               (SELECT count(*) FROM products) AS n_products"""),
    "answers": (("requests", "first_stored", "sizes"), """
        SELECT request_id, r.user_id, n, product_id, score, "timestamp",
               CASE WHEN n > 0 AND r.user_id < n_users THEN 'model'
                    WHEN s.user_id IS NOT NULL THEN 'stored' ELSE 'none' END AS source,
               CAST(CASE WHEN n > 0 AND r.user_id < n_users THEN least(n, n_products)
                    WHEN s.user_id IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS n_items
        FROM requests r CROSS JOIN sizes
        LEFT JOIN first_stored s ON r.user_id = s.user_id"""),
    "train_items": (("train",), "SELECT count(DISTINCT product_id) AS n_items FROM train"),
    "listed": (("train", "train_items"), """
        SELECT DISTINCT user_id, user_id_int, n_items FROM train CROSS JOIN train_items"""),
    "ranks": ((), "SELECT CAST(unnest(range(1, 11)) AS INTEGER) AS rank"),
}


def _with(*needed: str, select: str) -> str:
    order: list[str] = []

    def add(name):
        for base in STEPS[name][0]:
            add(base)
        if name not in order:
            order.append(name)

    for name in needed:
        add(name)
    tables = ",\n".join(f"{name} AS ({STEPS[name][1]})" for name in order)
    return f"WITH {tables}\n{select}"


def _survivors(train: str, test: str) -> str:
    return _with(train, test, select=f"""
        SELECT user_id, product_id, rating FROM {test}
        WHERE user_id IN (SELECT user_id FROM {train})
          AND product_id IN (SELECT product_id FROM {train})""")


def _coverage(train: str, test: str) -> str:
    return _with(train, test, select=f"""
        SELECT count(*) FILTER (known) AS valid, count(*) AS total,
               round(count(*) FILTER (known) * 100.0 / count(*), 1)::DOUBLE AS percent
        FROM (SELECT user_id IN (SELECT user_id FROM {train})
                 AND product_id IN (SELECT product_id FROM {train}) AS known FROM {test})""")


CLEAN = _with("ratings", select="SELECT user_id, product_id, rating FROM ratings")
USER_RANKS = _with("listed", "ranks", select="""
    SELECT user_id, rank FROM listed JOIN ranks ON rank <= n_items""")
ANSWER_SHAPE = _with("answers", select="""
    SELECT request_id, user_id, n, source, n_items FROM answers""")

ORACLES = {
    "clean_reviews": CLEAN,
    "clean_reviews_csv": CLEAN,
    "ratings_csv_roundtrip": CLEAN,
    "clean_drop_nulls": _with("complete", select="SELECT * FROM complete"),
    "clean_dedup": _with("complete", select="SELECT DISTINCT * FROM complete"),
    "clean_valid_ratings": _with("reviews", select="""
        SELECT reviewerID AS user_id, asin AS product_id, overall AS rating FROM reviews
        WHERE overall >= 1 AND overall <= 5"""),
    "cleaning_audit": _with("reviews", "complete", "ratings", select="""
        SELECT (SELECT count(*) FROM reviews) AS raw_rows,
               (SELECT count(*) FROM complete) AS complete_rows,
               (SELECT count(*) FROM (SELECT DISTINCT * FROM complete)) AS distinct_rows,
               (SELECT count(*) FROM ratings) AS final_rows,
               (SELECT count(*) FROM reviews)
                   - (SELECT count(*) FROM (SELECT DISTINCT * FROM complete)) AS removed_rows"""),
    "cleaning_audit_malformed": _with("reviews", select="""
        , formed AS (
            SELECT * FROM reviews WHERE CAST(substr(asin, 2, 9) AS BIGINT) % 97 NOT IN (1, 2, 3)),
        whole AS (
            SELECT reviewerID, asin, overall FROM formed
            WHERE reviewerID IS NOT NULL AND overall IS NOT NULL),
        once AS (SELECT DISTINCT * FROM whole)
        SELECT (SELECT count(*) FROM formed) AS raw_rows,
               (SELECT count(*) FROM whole) AS complete_rows,
               (SELECT count(*) FROM once) AS distinct_rows,
               (SELECT count(*) FROM once WHERE overall BETWEEN 1 AND 5) AS final_rows,
               (SELECT count(*) FROM formed) - (SELECT count(*) FROM once) AS removed_rows,
               (SELECT count(*) FROM reviews) - (SELECT count(*) FROM formed)
                   AS malformed_rows"""),
    "raw_shape": _with("reviews", select="""
        SELECT count(*) AS "rows", 4 AS "columns" FROM reviews"""),
    "first_ratings": _with("ratings", select="""
        SELECT user_id, product_id, rating FROM ratings
        ORDER BY user_id, product_id, rating LIMIT 5"""),
    "user_index": _with("users", select="SELECT user_id, user_id_int, n FROM users"),
    "product_index": _with(
        "products", select="SELECT product_id, product_id_int, n FROM products"),
    "encoded_ratings": _with("encoded", select="""
        SELECT user_id, product_id, rating, user_id_int, product_id_int FROM encoded"""),
    "index_extended": _with("ratings", select="""
        , halved AS (
            SELECT *, substr(md5(user_id || '|' || product_id), 1, 8) >= '80000000' AS early
            FROM ratings),
        counted AS (
            SELECT 'user_id' AS map, user_id AS id, count(*) AS n,
                   count(*) FILTER (early) AS early FROM halved GROUP BY user_id
            UNION ALL SELECT 'product_id', product_id, count(*), count(*) FILTER (early)
            FROM halved GROUP BY product_id)
        SELECT map, id, n, CAST(CASE WHEN early > 0 THEN 0
                ELSE (SELECT count(*) FROM counted c WHERE c.map = t.map AND c.early > 0) END
            + row_number() OVER (PARTITION BY map, early > 0
                                 ORDER BY CASE WHEN early > 0 THEN early ELSE n END DESC, id)
            - 1 AS INTEGER) AS "index"
        FROM counted t"""),
    "encode_unseen": _with("ratings", select="""
        , fitted AS (
            SELECT * FROM ratings
            WHERE substr(md5(user_id || '|' || product_id), 1, 8) >= 'f8000000'),
        u AS (SELECT user_id, row_number() OVER (ORDER BY count(*) DESC, user_id) - 1 AS i
              FROM fitted GROUP BY user_id),
        p AS (SELECT product_id,
                     row_number() OVER (ORDER BY count(*) DESC, product_id) - 1 AS i
              FROM fitted GROUP BY product_id)
        SELECT r.user_id, r.product_id, r.rating,
               CAST(coalesce(u.i, (SELECT count(*) FROM u)) AS INTEGER) AS user_id_int,
               CAST(coalesce(p.i, (SELECT count(*) FROM p)) AS INTEGER) AS product_id_int
        FROM ratings r LEFT JOIN u ON r.user_id = u.user_id
                       LEFT JOIN p ON r.product_id = p.product_id"""),
    "user_mapping": _with("train", select="SELECT DISTINCT user_id, user_id_int FROM train"),
    "product_mapping": _with(
        "train", select="SELECT DISTINCT product_id, product_id_int FROM train"),
    "decode_ratings": CLEAN,
    "map_exports": _with("users", "products", select="""
        , both_maps AS (
            SELECT 'user_id' AS map, user_id AS id, user_id_int AS "index" FROM users
            UNION ALL SELECT 'product_id', product_id, product_id_int FROM products)
        SELECT map, format, id, "index" FROM both_maps
        CROSS JOIN (VALUES ('csv'), ('json')) AS f(format)"""),
    "split_counts": _with("encoded", select="""
        SELECT CASE WHEN h >= '33333333' THEN 'train' ELSE 'test' END AS half, count(*) AS n
        FROM encoded GROUP BY 1"""),
    "random_split_total": _with("ratings", select="""
        SELECT user_id, product_id, rating, CAST(1 AS BIGINT) AS n FROM ratings"""),
    "rating_summary": _with("ratings", select="""
        SELECT 'rating' AS column_name, count(rating) AS n, round(avg(rating), 6) AS mean,
               round(stddev_samp(rating), 6) AS stddev, min(rating) AS min,
               max(rating) AS max
        FROM ratings"""),
    "rmse_baseline": _with("train", "test", select="""
        , means AS (SELECT product_id, avg(rating) AS prediction FROM train GROUP BY product_id)
        SELECT count(prediction) AS n,
               round(sqrt(avg((rating - prediction) * (rating - prediction))), 6) AS rmse
        FROM test LEFT JOIN means ON test.product_id = means.product_id"""),
    "coldstart_survivors": _survivors("train", "test"),
    "coldstart_survivors_sparse": _survivors("sparse_train", "sparse_test"),
    "prediction_coverage": _coverage("train", "test"),
    "prediction_coverage_sparse": _coverage("sparse_train", "sparse_test"),
    "evaluation_report": f"""
        SELECT total AS test_rows, valid AS predicted_rows, percent, true AS rmse_agrees
        FROM ({_coverage("train", "test")})""",
    "model_roundtrip": _with("train", "test", select="""
        SELECT user_id, product_id, rating, true AS same FROM test
        WHERE user_id IN (SELECT user_id FROM train)
          AND product_id IN (SELECT product_id FROM train)"""),
    "recs_all_shape": _with("listed", select="""
        SELECT user_id_int, CAST(least(10, n_items) AS INTEGER) AS n_items FROM listed"""),
    "recs_subset_shape": _with("listed", "requests", select="""
        SELECT user_id_int, CAST(least(5, n_items) AS INTEGER) AS n_items FROM listed
        WHERE user_id_int IN (SELECT user_id FROM requests)"""),
    "recs_long": _with("listed", "ranks", select="""
        SELECT user_id_int, rank FROM listed JOIN ranks ON rank <= n_items"""),
    "recs_unseen": _with("train", "listed", "ranks", select="""
        , rated AS (
            SELECT user_id_int, count(DISTINCT product_id_int) AS n FROM train GROUP BY user_id_int)
        SELECT user_id_int, rank, false AS rated FROM listed JOIN rated USING (user_id_int)
        JOIN ranks ON rank <= n_items - rated.n"""),
    "serve_decoded": _with("ratings", select="""
        SELECT CAST(v AS INTEGER) AS version, user_id, product_id, rating AS score
        FROM ratings CROSS JOIN range(1, 3) AS t(v)"""),
    "export_manifest": _with("listed", "sizes", select="""
        , n AS (SELECT count(*) AS lists, sum(least(10, n_items)) AS entries FROM listed)
        SELECT 2 AS run, name, CAST(CASE name WHEN 'decoded' THEN entries
            WHEN 'user_map' THEN n_users WHEN 'product_map' THEN n_products
            ELSE lists END AS BIGINT) AS n
        FROM n CROSS JOIN sizes CROSS JOIN (VALUES ('recommendations'), ('recommendations_json'),
            ('recommendations_csv'), ('decoded'), ('user_map'), ('product_map')) AS t(name)"""),
    "recs_decoded": USER_RANKS,
    "recommend_all_export": USER_RANKS,
    "recs_json_roundtrip": _with("listed", select="""
        SELECT user_id_int, CAST(least(10, n_items) AS INTEGER) AS n_items,
               true AS json_same, true AS csv_same FROM listed"""),
    "legacy_recs_parse": _with("ranks", select="""
        , whole AS (SELECT *, CAST(CAST(trunc(value) AS INTEGER) AS VARCHAR) AS w FROM events)
        SELECT CAST(event_id % 2147483647 AS INTEGER) AS user_id_int, rank,
               CAST((user_id * 100 + rank - 1) % 2147483647 AS INTEGER) AS product_id,
               CAST(CASE (rank - 1) % 3 WHEN 0 THEN '-' || w || '.5'
                    WHEN 1 THEN w || '.25e-05' ELSE w || '.75' END AS DOUBLE)
                   AS predicted_rating
        FROM whole CROSS JOIN ranks"""),
    "topk_dot_product": """
        SELECT u.vec_id AS user_vec, v.vec_id AS item_vec,
               list_inner_product(CAST(u.embedding AS DOUBLE[]),
                                  CAST(v.embedding AS DOUBLE[])) AS dot,
               CAST(row_number() OVER (PARTITION BY u.vec_id ORDER BY dot DESC, v.vec_id)
                    AS INTEGER) AS rank,
               round(dot, 6) AS score
        FROM embeddings u CROSS JOIN embeddings v
        QUALIFY rank <= 5""",
    "recs_match_builtin": _with("listed", "ranks", select="""
        SELECT user_id_int, rank, true AS same_score FROM listed JOIN ranks ON rank <= n_items"""),
    "recs_export_lengths": _with("listed", select="""
        SELECT user_id_int, n AS n_parquet, n AS n_json, n AS n_csv, n AS n_decoded
        FROM (SELECT user_id_int, CAST(least(20, n_items) AS INTEGER) AS n FROM listed)"""),
    "ratings_csv_awkward": _with("ratings", select="""
        SELECT ' ' || user_id || CASE WHEN ends_with(user_id, '7') THEN chr(10) || '"x'
               ELSE ' ' END AS user_id, product_id, rating FROM ratings"""),
    "serve_two_streams": _with("answers", select="""
        SELECT user_id, 2 * count(*) AS n_answers,
               2 * count(*) FILTER (source = 'model') AS n_logged
        FROM answers GROUP BY user_id"""),
    "serve_batch": ANSWER_SHAPE,
    "serve_stream": ANSWER_SHAPE,
    "serve_stream_repeats": ANSWER_SHAPE,
    "serve_stream_versions": """
        SELECT event_id AS request_id, CAST(1 + event_id % 2 AS INTEGER) AS version FROM events""",
    "first_answers_table": _with("first_stored", select="""
        SELECT user_id, "timestamp", product_id, score FROM first_stored"""),
    "serve_fallback": _with("answers", select="""
        SELECT request_id, user_id, "timestamp", product_id, score FROM answers
        WHERE source = 'stored'"""),
    "answer_documents": _with("answers", select=f"""
        SELECT request_id, user_id, n_items, source <> 'none' AS has_time,
               CASE WHEN source = 'none' THEN '{EMPTY_MESSAGE}' END AS message FROM answers"""),
    "serve_log": _with("answers", select="""
        SELECT user_id, n_items, count(*) AS n FROM answers WHERE source = 'model'
        GROUP BY user_id, n_items"""),
    "publish_current": _with("sizes", select="""
        SELECT CAST(v AS INTEGER) AS version, v = 3 AS is_current, v >= 2 AS is_kept,
               10 AS rank, 10 AS max_iter, CAST(0.1 AS DOUBLE) AS reg_param,
               'drop' AS cold_start, n_users AS users, n_products AS products
        FROM sizes CROSS JOIN range(1, 4) AS t(v)"""),
    "retrain_report": _with("reviews", "complete", "train", "test", "sizes", select="""
        SELECT 1 AS version, (SELECT count(*) FROM test) AS test_rows,
               (SELECT count(*) FROM test
                WHERE user_id IN (SELECT user_id FROM train)
                  AND product_id IN (SELECT product_id FROM train)) AS predicted_rows,
               (SELECT count(*) FROM train) AS train_rows,
               (SELECT count(*) FROM reviews) AS raw_rows,
               (SELECT count(*) FROM reviews)
                   - (SELECT count(*) FROM (SELECT DISTINCT * FROM complete)) AS removed_rows,
               (SELECT count(*) FROM ratings) AS final_rows,
               n_users AS users, n_products AS products
        FROM sizes"""),
}
ORACLES["topk_dot_product"] = (
    f"SELECT user_vec, rank, item_vec, score FROM ({ORACLES['topk_dot_product']})"
)

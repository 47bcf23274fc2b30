"""ANSI SQL for the registered queries, written apart from the Spark code."""

from __future__ import annotations

from basketry.sources.feature_store import FEATURE_DEFINITIONS

# Common table expressions -------------------------------------------------------

_CTE = {
    "users_text": ("", """
        SELECT CAST(c_custkey AS VARCHAR) AS user_id,
               CASE WHEN c_custkey % 53 = 0 THEN NULL WHEN c_custkey % 59 = 0 THEN 'unknown'
                    WHEN c_custkey % 97 = 0 THEN '999'
                    ELSE CAST(18 + c_custkey % 48 AS VARCHAR) END AS age,
               CASE WHEN c_custkey % 61 = 0 THEN NULL WHEN c_custkey % 67 = 0 THEN 'M'
                    WHEN c_custkey % 73 = 0 THEN NULL
                    WHEN c_nationkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
               CASE WHEN c_custkey % 43 = 0 THEN 'Phone' WHEN c_custkey % 47 = 0 THEN NULL
                    WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN 'Mobile'
                    WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Tablet' ELSE 'Desktop' END AS device,
               'users_1' AS source_file, c_custkey AS row_seq
        FROM customer
        UNION ALL
        SELECT CASE WHEN c_custkey % 100 = 0 THEN CAST(c_custkey AS VARCHAR)
                    ELSE 'u' || CAST(c_custkey AS VARCHAR) END, '77', 'F', NULL,
               'users_2', c_custkey
        FROM customer WHERE c_custkey % 100 = 0 OR c_custkey % 149 = 0"""),
    "users_raw": ("users_text", """
        SELECT TRY_CAST(user_id AS BIGINT) AS user_id, TRY_CAST(age AS DOUBLE) AS age,
               gender, device, source_file, row_seq
        FROM users_text WHERE TRY_CAST(user_id AS BIGINT) IS NOT NULL"""),
    "users_first": ("users_raw", """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY source_file, row_seq) AS rn
            FROM users_raw) t WHERE rn = 1"""),
    "users_filled": ("users_first", """
        SELECT user_id,
               coalesce(age, (SELECT quantile_cont(age, 0.5) FROM users_first)) AS age,
               coalesce(gender, (SELECT gender FROM users_first WHERE gender IS NOT NULL
                                 GROUP BY gender ORDER BY count(*) DESC, gender LIMIT 1)) AS gender,
               coalesce(device, (SELECT device FROM users_first WHERE device IS NOT NULL
                                 GROUP BY device ORDER BY count(*) DESC, device LIMIT 1)) AS device
        FROM users_first"""),
    "users_clean": ("users_filled", """
        SELECT user_id, age, gender, device,
               dense_rank() OVER (ORDER BY gender) - 1 AS gender_encoded,
               dense_rank() OVER (ORDER BY device) - 1 AS device_encoded,
               (age - min(age) OVER ()) / (max(age) OVER () - min(age) OVER ()) AS age_normalized
        FROM users_filled"""),
    "products_raw": ("", """
        SELECT p_partkey AS item_id,
               CASE WHEN p_partkey % 37 <> 0 THEN p_retailprice END AS price, p_brand AS brand,
               CASE WHEN p_partkey % 101 <> 0 THEN p_type END AS category,
               CASE WHEN p_partkey % 41 <> 0
                    THEN 1 + CAST(p_size % 41 AS DOUBLE) / 10 END AS rating,
               p_size % 5 <> 0 AS in_stock, 'products_1' AS source_file
        FROM part
        UNION ALL
        SELECT p_partkey, CASE WHEN p_partkey % 37 <> 0 THEN p_retailprice END + 1, 'Other',
               CASE WHEN p_partkey % 101 <> 0 THEN p_type END,
               CASE WHEN p_partkey % 41 <> 0 THEN 1 + CAST(p_size % 41 AS DOUBLE) / 10 END,
               p_size % 5 <> 0, 'products_2'
        FROM part WHERE p_partkey % 250 = 0"""),
    "products_first": ("products_raw", """
        SELECT item_id, price, brand, category, rating, in_stock FROM (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY source_file) AS rn
            FROM products_raw) t WHERE rn = 1"""),
    "order_triples": ("facts", """
        SELECT user_id, item_id, CAST(max(rating) AS DOUBLE) AS score FROM facts
        GROUP BY user_id, item_id"""),
    "products_filled": ("products_first", """
        SELECT p.item_id, coalesce(p.price, m.median_price) AS price, p.brand, p.category,
               coalesce(p.rating, (SELECT avg(rating) FROM products_first)) AS rating, p.in_stock
        FROM products_first p
        LEFT JOIN (SELECT category, quantile_cont(price, 0.5) AS median_price
                   FROM products_first WHERE category IS NOT NULL GROUP BY category) m
          ON p.category = m.category"""),
    "products_clean": ("products_filled", """
        SELECT item_id, price, brand, category, rating, in_stock,
               dense_rank() OVER (ORDER BY coalesce(category, 'None')) - 1 AS category_encoded,
               dense_rank() OVER (ORDER BY coalesce(brand, 'None')) - 1 AS brand_encoded,
               (price - min(price) OVER ()) / (max(price) OVER () - min(price) OVER ())
                   AS price_normalized,
               CASE WHEN price IS NULL THEN NULL
                    WHEN round(price, 9) <= round(e1, 9) THEN 'low'
                    WHEN round(price, 9) <= round(e2, 9) THEN 'medium' ELSE 'high' END AS price_tier
        FROM products_filled,
             (SELECT quantile_cont(price, 1.0/3) AS e1, quantile_cont(price, 2.0/3) AS e2
              FROM products_filled) q"""),
    "inter_raw": ("", """
        SELECT event_id,
               user_id + CASE WHEN event_id % 50 = 0 THEN 10000000 ELSE 0 END AS user_id,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
               CASE WHEN event_type = 'click' THEN 'add_to_cart' ELSE event_type END AS view_mode,
               CASE WHEN event_id % 31 = 0 THEN NULL WHEN event_id % 67 = 0 THEN 9
                    ELSE 1 + CAST(floor(value) AS BIGINT) % 5 END AS rating,
               CASE WHEN event_id % 83 = 0 OR event_id % 89 = 0 THEN NULL
                    WHEN event_id % 2 = 0 THEN date_trunc('second', ts) ELSE ts END AS ts
        FROM events"""),
    "inter_clean": ("inter_raw users_raw products_raw", """
        SELECT *, dense_rank() OVER (ORDER BY view_mode) - 1 AS view_mode_encoded,
               CASE view_mode WHEN 'view' THEN 1 WHEN 'add_to_cart' THEN 2
                    WHEN 'purchase' THEN 3 END AS implicit_score
        FROM inter_raw
        WHERE ts IS NOT NULL AND user_id IN (SELECT user_id FROM users_raw)
          AND item_id IN (SELECT item_id FROM products_raw)"""),
    "inter_features": ("inter_clean", """
        SELECT *, exp(-days_since / 30.0) AS recency_weight, (rating - 1) / 4.0 AS rating_normalized,
               implicit_score / 3.0 * 0.3 + (rating - 1) / 4.0 * 0.5 + exp(-days_since / 30.0) * 0.2
                   AS user_item_affinity
        FROM (SELECT *, CAST(floor(epoch_us(mx.m - ts_) / 86400000000.0) AS BIGINT) AS days_since
              FROM (SELECT *, ts AS ts_ FROM inter_clean) a, (SELECT max(ts) AS m FROM inter_clean) mx
             ) b"""),
    "triples": ("inter_features", """
        SELECT user_id, item_id, max(user_item_affinity * 4 + 1) AS score
        FROM inter_features WHERE user_item_affinity IS NOT NULL GROUP BY user_id, item_id"""),
    "split": ("triples", """
        SELECT *, CASE WHEN substr(md5(CAST(user_id AS VARCHAR) || '-' || CAST(item_id AS VARCHAR)
                                       || '-42'), 1, 8) < 'cccccccc' THEN 'train' ELSE 'test' END AS part
        FROM triples"""),
    "facts": ("", """
        SELECT o_custkey AS user_id, l_partkey AS item_id,
               CASE l_returnflag WHEN 'N' THEN 'view' WHEN 'A' THEN 'add_to_cart'
                    ELSE 'purchase' END AS view_mode,
               1 + CAST(l_quantity AS BIGINT) % 5 AS rating, l_shipdate AS ts
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "item_stats": ("facts", """
        SELECT item_id, count(user_id) AS popularity_score, avg(rating) AS avg_item_rating,
               count(*) FILTER (WHERE view_mode = 'purchase') AS purchase_count,
               count(*) FILTER (WHERE view_mode = 'view') AS view_count
        FROM facts GROUP BY item_id"""),
    "biases": ("split", """
        SELECT * FROM (SELECT avg(score) AS mu FROM split WHERE part = 'train') m"""),
    "bias_i": ("biases", """
        SELECT item_id, sum(score - mu) / (count(*) + 10) AS item_bias
        FROM split, biases WHERE part = 'train' GROUP BY item_id"""),
    "bias_u": ("bias_i", """
        SELECT user_id, sum(score - mu - item_bias) / (count(*) + 15) AS user_bias
        FROM split JOIN bias_i USING (item_id), biases WHERE part = 'train' GROUP BY user_id"""),
    "pairs": ("facts", "SELECT DISTINCT user_id, item_id FROM facts"),
    "pairs_split": ("pairs", """
        SELECT *, substr(md5(CAST(user_id AS VARCHAR) || '-' || CAST(item_id AS VARCHAR) || '-42'),
                         1, 8) < 'cccccccc' AS in_train FROM pairs"""),
    "eval_scores": ("pairs_split", """
        SELECT item_id, count(*) AS score FROM pairs_split WHERE in_train GROUP BY item_id"""),
    "eval_lists": ("eval_scores", """
        SELECT user_id, item_id, rnk FROM (
            SELECT u.user_id, s.item_id,
                   row_number() OVER (PARTITION BY u.user_id
                                      ORDER BY s.score DESC, s.item_id) AS rnk
            FROM (SELECT DISTINCT user_id FROM pairs_split WHERE in_train) u CROSS JOIN eval_scores s
            WHERE NOT EXISTS (SELECT 1 FROM pairs_split p WHERE p.in_train
                              AND p.user_id = u.user_id AND p.item_id = s.item_id)) t
        WHERE rnk <= 20"""),
    "eval_users": ("eval_lists", """
        SELECT l.user_id, count(*) AS n_listed,
               max(t.n_relevant) AS n_relevant
        FROM eval_lists l JOIN (SELECT user_id, count(*) AS n_relevant FROM pairs_split
                                WHERE NOT in_train GROUP BY user_id) t USING (user_id)
        GROUP BY l.user_id"""),
    "eval_hits": ("eval_lists", """
        SELECT l.user_id, l.rnk FROM eval_lists l JOIN pairs_split p
          ON p.user_id = l.user_id AND p.item_id = l.item_id AND NOT p.in_train"""),
    "eval_metrics": ("eval_users eval_hits", """
        WITH ks AS (SELECT unnest([5, 10, 20]) AS k),
             per AS (SELECT u.user_id, k, n_listed, n_relevant,
                            (SELECT count(*) FROM eval_hits h
                             WHERE h.user_id = u.user_id AND h.rnk <= k) AS hits,
                            (SELECT coalesce(sum(1.0 / log2(h.rnk + 1)), 0) FROM eval_hits h
                             WHERE h.user_id = u.user_id AND h.rnk <= k) AS dcg,
                            (SELECT sum(1.0 / log2(i + 1)) FROM range(1, 21) r(i)
                             WHERE i <= least(n_relevant, k)) AS idcg
                     FROM eval_users u CROSS JOIN ks)
        SELECT user_id, 'precision' AS metric, k, hits / least(k, n_listed) AS value FROM per
        UNION ALL SELECT user_id, 'recall', k, hits / n_relevant FROM per
        UNION ALL SELECT user_id, 'ndcg', k, dcg / idcg FROM per
        UNION ALL SELECT user_id, 'hit_rate', k, CASE WHEN hits > 0 THEN 1.0 ELSE 0.0 END FROM per
        UNION ALL SELECT user_id, 'mrr', NULL, coalesce(
            (SELECT 1.0 / min(h.rnk) FROM eval_hits h WHERE h.user_id = u.user_id), 0.0)
        FROM eval_users u"""),
    "wire": ("", """
        SELECT e.*, event_id % 97 = 0 AS broken,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
               CASE WHEN event_type = 'click' THEN 'add_to_cart' ELSE event_type END AS view_mode,
               CASE WHEN event_id % 31 = 0 THEN NULL WHEN event_id % 67 = 0 THEN 9
                    WHEN event_id % 71 = 0 THEN NULL
                    ELSE 1 + CAST(floor(value) AS BIGINT) % 5 END AS rating,
               event_id % 31 <> 0 AND (event_id % 67 = 0 OR event_id % 71 = 0) AS bad_rating,
               event_id % 13 <> 0 AND event_id % 89 = 0 AS bad_ts,
               event_id % 90 - 2 AS age,
               CASE WHEN event_id % 17 = 0 THEN 'X' WHEN event_id % 2 = 0 THEN 'M' ELSE 'F' END
                   AS gender,
               CASE WHEN event_id % 19 = 0 THEN 'Phone' WHEN event_id % 3 = 0 THEN 'Mobile'
                    ELSE 'Tablet' END AS device,
               CASE WHEN event_id % 10 = 0 THEN 2 ELSE 1 END AS copies
        FROM events e"""),
    "wire_valid": ("wire", """
        SELECT w.* FROM wire w
        WHERE event_type <> 'signup' AND NOT broken AND NOT bad_rating AND NOT bad_ts
          AND view_mode IN ('view', 'add_to_cart', 'purchase')"""),
}



def _r(expr: str, name: str) -> str:
    """Six decimals, and no negative zero."""
    return f"round({expr}, 6) + 0.0 AS {name}"


def _ts(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS {name}"


def _with(body: str, *needs: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for parent in _CTE[name][0].split():
            add(parent)
        if name not in order:
            order.append(name)

    for n in needs:
        add(n)
    if not order:
        return body
    # A body that starts with a comma adds expressions of its own.
    return "WITH " + ",\n".join(f"{n} AS ({_CTE[n][1]})" for n in order) + "\n" + body


# Rules ------------------------------------------------------------------------------

def _rule(dataset: str, source: str, check: str, kind: str, value: str, threshold: float,
          wording: str) -> str:
    passed = f"v >= {threshold}" if kind == "rate" else f"v <= {threshold}"
    shown = "printf('%.1f%%', v * 100)" if kind == "rate" else "CAST(CAST(v AS BIGINT) AS VARCHAR)"
    return (f"SELECT '{dataset}' AS dataset, n AS record_count, '{check}' AS \"check\", "
            f"'error' AS severity, '{kind}' AS kind, round(v, 6) AS value, "
            f"CAST({threshold} AS DOUBLE) AS threshold, {passed} AS passed, "
            f"{shown} || ' {wording}' AS details "
            f"FROM (SELECT CAST({value} AS DOUBLE) AS v, count(*) AS n FROM {source}) t")


def _share(test: str) -> str:
    return f"avg(CASE WHEN {test} THEN 1.0 ELSE 0.0 END)"


def _dups(key: str) -> str:
    return f"count(*) - count(DISTINCT {key}) - max(CASE WHEN {key} IS NULL THEN 1 ELSE 0 END)"


def _nulls(column: str) -> str:
    return f"count(*) - count({column})"


_USER_RULES = " UNION ALL ".join([
    _rule("users", "users_raw", "user_id_unique", "count", _dups("user_id"), 0, "duplicates found"),
    _rule("users", "users_raw", "age_in_range_18_65", "rate", _share("age BETWEEN 18 AND 65"),
          0.95, "within range"),
    _rule("users", "users_raw", "gender_valid", "rate",
          _share("gender IN ('M', 'F', 'Male', 'Female')"), 0.95, "valid values"),
    _rule("users", "users_raw", "device_valid", "rate",
          _share("device IN ('Mobile', 'Desktop', 'Tablet')"), 0.95, "valid values"),
    _rule("users", "users_raw", "no_null_user_ids", "count", _nulls("user_id"), 0,
          "nulls in user_id")])
_PRODUCT_RULES = " UNION ALL ".join([
    _rule("products", "products_raw", "item_id_unique", "count", _dups("item_id"), 0,
          "duplicates found"),
    _rule("products", "products_raw", "price_positive", "rate", _share("price > 0"), 0.99,
          "positive prices"),
    _rule("products", "products_raw", "rating_in_range_1_5", "rate",
          _share("rating BETWEEN 1 AND 5"), 0.95, "within range"),
    *[_rule("products", "products_raw", f"{c}_not_null", "count", _nulls(c), 0, f"nulls in {c}")
      for c in ("item_id", "price", "category")]])
_INTERACTION_RULES = " UNION ALL ".join([
    _rule("transactions", "inter_raw", "user_id_foreign_key", "rate",
          _share("user_id IN (SELECT user_id FROM users_raw)"), 0.9, "valid user references"),
    _rule("transactions", "inter_raw", "item_id_foreign_key", "rate",
          _share("item_id IN (SELECT item_id FROM products_raw)"), 0.9, "valid item references"),
    _rule("transactions", "inter_raw", "view_mode_valid", "rate",
          _share("view_mode IN ('view', 'add_to_cart', 'purchase')"), 0.99,
          "valid interaction types"),
    _rule("transactions", "inter_raw", "rating_in_range_1_5", "rate",
          _share("rating BETWEEN 1 AND 5"), 0.95, "within range"),
    _rule("transactions", "inter_raw", "timestamp_valid", "rate", _share("ts IS NOT NULL"), 0.99,
          "valid timestamps")])
_RULE_NEEDS = ("users_raw", "products_raw", "inter_raw")
_ALL_RULES = " UNION ALL ".join([_USER_RULES, _PRODUCT_RULES, _INTERACTION_RULES])


def _warning(dataset: str, source: str, check: str, value: str) -> str:
    return (f"SELECT '{dataset}' AS dataset, n AS record_count, '{check}' AS \"check\", "
            f"'warn' AS severity, 'count' AS kind, v AS value, CAST(0 AS DOUBLE) AS threshold, v <= 0 AS passed "
            f"FROM (SELECT CAST({value} AS DOUBLE) AS v, count(*) AS n FROM {source}) t")


_WARNINGS = " UNION ALL ".join([
    _warning("users", "users_raw", "duplicate_user_id", _dups("user_id")),
    _warning("users", "users_raw", "missing_columns", "max(0)"),
    _warning("products", "products_raw", "null_item_id", _nulls("item_id")),
    _warning("products", "products_raw", "null_price", _nulls("price")),
    _warning("products", "products_raw", "null_category", _nulls("category")),
    _warning("products", "products_raw", "duplicate_item_id", _dups("item_id")),
    _warning("products", "products_raw", "missing_columns", "max(1)"),
    _warning("transactions", "inter_raw", "invalid_view_mode",
             "count(*) FILTER (WHERE view_mode NOT IN ('view', 'add_to_cart', 'purchase'))"),
    _warning("transactions", "inter_raw", "missing_columns", "max(0)")])


def _profile(source: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT count(*) AS record_count, '{c}' AS column_name, {i} AS position, "
        f"'{t}' AS data_type, count(*) - count({c}) AS null_count FROM {source}"
        for i, (c, t) in enumerate(columns.items()))


_DRIFT_OLD = _profile("(SELECT * FROM products_raw WHERE source_file = 'products_1') o", {
    "item_id": "bigint", "price": "double", "brand": "string", "category": "string",
    "rating": "double", "in_stock": "boolean"})
_DRIFT_NEW = _profile("(SELECT *, price * 0.1 AS discount FROM products_raw) n", {
    "item_id": "bigint", "price": "double", "brand": "string", "category": "string",
    "rating": "string", "discount": "double"})


def _one_hot() -> str:
    """The test tables hold 25 brands and 6 types, numbered and named."""
    brands = [f"Brand#{i}" for i in range(1, 26)]
    types = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    flags = [f"CASE WHEN brand = '{b}' THEN CAST(1 AS DOUBLE) ELSE 0 END AS \"brand_{b}\"" for b in brands]
    flags += [f"CASE WHEN category = '{t}' THEN CAST(1 AS DOUBLE) ELSE 0 END AS \"category_{t}\""
              for t in types]
    return (f"SELECT item_id, round(price, 6) AS price, round(rating, 6) AS rating, "
            f"{', '.join(flags)} FROM products_first")


def _list_facts(users: str, items: str) -> str:
    """Users with the number of items they know, and all items: what the lists must come to."""
    return (f", u AS {users}, size AS (SELECT count(*) AS items FROM {items} i), "
            "unseen AS (SELECT least(10, items - n) AS k FROM u, size) "
            "SELECT 'users' AS fact, count(*) AS value FROM unseen WHERE k > 0 UNION ALL "
            "SELECT 'list_rows', CAST(sum(k) AS BIGINT) FROM unseen UNION ALL "
            "SELECT * FROM (VALUES ('bad_ranks', 0), ('rising_scores', 0), ('outside_scale', 0), "
            "('known_pairs', 0)) v(fact, value)")


def _metrics(dataset: str, source: str, columns: list[str], valid: str, key: str) -> str:
    filled = " + ".join(f"count({c})" for c in columns)
    return (f"SELECT '{dataset}' AS dataset, 'completeness' AS metric, round(v, 6) AS value, "
            f"CAST(0.98 AS DOUBLE) AS target, v >= 0.98 AS passed FROM (SELECT ({filled}) "
            f"/ ({len(columns)}.0 * count(*)) AS v FROM {source}) a UNION ALL "
            f"SELECT '{dataset}', 'schema_validity', round(v, 6), 1.0, v >= 1 FROM "
            f"(SELECT avg(CASE WHEN {valid} THEN 1.0 ELSE 0.0 END) AS v FROM {source}) b UNION ALL "
            f"SELECT '{dataset}', 'duplicate_rate', round(v, 6), 0.01, v < 0.01 FROM "
            f"(SELECT 1.0 - count(DISTINCT {key}) / count(*) AS v FROM {source}) c")


def _correlations() -> str:
    columns = ["rating", "implicit_score", "view_mode_encoded", "days_since",
               "user_item_affinity"]
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, {_r(f'corr({a}, {b})', 'correlation')} "
        f"FROM inter_features" for a in columns for b in columns)


def _describe(column: str) -> str:
    return (f"SELECT '{column}' AS column_name, count({column}) AS n, {_r(f'avg({column})', 'mean')}, "
            f"{_r(f'stddev_samp({column})', 'std')}, {_r(f'min({column})', 'min')}, "
            f"{_r(f'max({column})', 'max')}, {_r(f'quantile_cont({column}, 0.5)', 'median')} "
            f"FROM products_raw")


def _distribution(column: str) -> str:
    return (f"SELECT '{column}' AS column_name, {column} AS value, count(*) AS row_count, "
            f"{_r('count(*) / (SELECT count(*) FROM users_raw)', 'share')} "
            f"FROM users_raw GROUP BY {column}")


def _activity(key: str, source: str) -> str:
    return (f"SELECT '{key}' AS entity, {_r('avg(n)', 'mean')}, "
            f"{_r('quantile_cont(n, 0.5)', 'median')}, max(n) AS max, "
            f"{_r('avg(CASE WHEN n = 0 THEN 1.0 ELSE 0.0 END)', 'zero_share')} "
            f"FROM (SELECT d.{key}, count(f.{key}) AS n FROM (SELECT DISTINCT {key} FROM {source}) d "
            f"LEFT JOIN facts f ON f.{key} = d.{key} GROUP BY d.{key}) t")


def _samples(column: str, text: str) -> str:
    return (f"SELECT '{column}' AS column_name, string_agg(v, ', ' ORDER BY v) AS samples FROM "
            f"(SELECT DISTINCT {text} AS v FROM users_raw WHERE {column} IS NOT NULL "
            f"ORDER BY v LIMIT 3) t")


def _registry() -> str:
    rows = ", ".join("(" + ", ".join(f"'{v}'" for v in d) + ")" for d in FEATURE_DEFINITIONS)
    return (f", d AS (SELECT * FROM (VALUES {rows}) v(feature_name, feature_type, description, "
            "data_type, source_table, computation_logic)) "
            "SELECT d.*, '2024-01-01 00:00:00' AS created_at, CASE WHEN feature_type = 'item' "
            "THEN '2024-02-01 00:00:00' ELSE '2024-01-01 00:00:00' END AS updated_at, "
            "CASE WHEN feature_type = 'user' THEN (SELECT count(DISTINCT user_id) FROM facts) "
            "ELSE (SELECT count(DISTINCT item_id) FROM facts) END AS covered_ids FROM d")


_EVENT = "event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, round(value, 6) AS value, props"


def oracle_sql() -> dict[str, str]:
    users_row = f"user_id, {_r('age', 'age')}, gender, device, source_file, row_seq"
    clean_user = (f"{_r('age', 'age')}, gender, device, gender_encoded, device_encoded, "
                  f"{_r('age_normalized', 'age_normalized')}")
    clean_product = (f"{_r('price', 'price')}, brand, category, {_r('rating', 'rating')}, in_stock, "
                     f"category_encoded, brand_encoded, "
                     f"{_r('price_normalized', 'price_normalized')}, price_tier")
    stats = (f"popularity_score, {_r('avg_item_rating', 'avg_item_rating')}, purchase_count, "
             f"view_count")
    rate = _r("CASE WHEN view_count > 0 THEN purchase_count / view_count ELSE 0.0 END",
              "view_to_purchase_rate")
    baseline = _with(
        ", m AS (SELECT avg(score) AS mu FROM order_triples), "
        "bi AS (SELECT item_id, sum(score - mu) / (count(*) + 10) AS b FROM order_triples, m GROUP BY 1), "
        "bu AS (SELECT user_id, sum(score - mu - b) / (count(*) + 15) AS b "
        "FROM order_triples JOIN bi USING (item_id), m GROUP BY 1), "
        "u AS (SELECT user_id, round((mu + b) * 1048576) / 1048576 AS x FROM bu, m), "
        "i AS (SELECT item_id, round(b * 1048576) / 1048576 AS y FROM bi) "
        "SELECT user_id, item_id, round(s, 6) AS predicted_score, rnk AS rank FROM ("
        "SELECT user_id, item_id, s, row_number() OVER (PARTITION BY user_id "
        "ORDER BY s DESC, item_id) AS rnk FROM ("
        "SELECT u.user_id, i.item_id, least(5.0, greatest(1.0, x + y)) AS s FROM u CROSS JOIN i "
        "WHERE NOT EXISTS (SELECT 1 FROM order_triples t WHERE t.user_id = u.user_id "
        "AND t.item_id = i.item_id)) a) b WHERE rnk <= 10", "order_triples")
    sql = {
        "users_ingest_clean": _with(f"SELECT {users_row} FROM users_raw", "users_raw"),
        "users_dedup_first": _with(f"SELECT {users_row} FROM users_first", "users_first"),
        "users_distinct_plausible": _with(
            "SELECT user_id, CASE WHEN age BETWEEN 0 AND 110 THEN age END AS age, gender, device "
            "FROM (SELECT DISTINCT user_id, age, gender, device FROM users_raw) t", "users_raw"),
        "users_clean": _with(f"SELECT user_id, {clean_user} FROM users_clean", "users_clean"),
        "products_clean": _with(f"SELECT item_id, {clean_product} FROM products_clean",
                                "products_clean"),
        "products_one_hot": _with(_one_hot(), "products_first"),
        "products_one_hot_sparse": _with(
            "SELECT item_id, 'brand_' || brand AS entry, CAST(1 AS DOUBLE) AS value "
            "FROM products_first WHERE brand IS NOT NULL UNION ALL SELECT item_id, "
            "'category_' || category, 1 FROM products_first WHERE category IS NOT NULL",
            "products_first"),
        "products_standard_scaled": _with(
            f"SELECT item_id, {_r('(price - avg(price) OVER ()) / stddev_pop(price) OVER ()', 'price_scaled')}, "
            f"{_r('(rating - avg(rating) OVER ()) / stddev_pop(rating) OVER ()', 'rating_scaled')} "
            "FROM products_first", "products_first"),
        "interactions_clean": _with(
            f"SELECT event_id, user_id, item_id, view_mode, rating, {_ts('ts', 'timestamp')}, "
            "view_mode_encoded, implicit_score FROM inter_clean", "inter_clean"),
        "quality_users": _with(_USER_RULES, "users_raw"),
        "quality_products": _with(_PRODUCT_RULES, "products_raw"),
        "quality_interactions": _with(_INTERACTION_RULES, *_RULE_NEEDS),
        "quality_overall": _with(
            f", rules AS ({_ALL_RULES}) "
            "SELECT dataset, count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed_checks, "
            f"{_r('count(*) FILTER (WHERE passed) / count(*)', 'quality_score')} "
            "FROM (SELECT dataset, passed FROM rules UNION ALL SELECT 'overall', passed FROM rules) t "
            "GROUP BY dataset", *_RULE_NEEDS),
        "quality_report_saved": _with(_ALL_RULES, *_RULE_NEEDS),
        "quality_gate": _with(
            f", rules AS ({_ALL_RULES}) SELECT round(s, 6) AS quality_score, "
            "CAST(0.9 AS DOUBLE) AS threshold, s >= 0.9 AS passed "
            "FROM (SELECT count(*) FILTER (WHERE passed) / count(*) AS s FROM rules) t",
            *_RULE_NEEDS),
        "ingest_warnings": _with(_WARNINGS, *_RULE_NEEDS),
        "fk_orphans": _with(
            "SELECT user_id, count(*) AS row_count FROM inter_raw "
            "WHERE user_id NOT IN (SELECT user_id FROM users_raw) GROUP BY user_id",
            "inter_raw", "users_raw"),
        "invalid_modes": _with(
            "SELECT view_mode, count(*) AS row_count FROM inter_raw "
            "WHERE view_mode NOT IN ('view', 'add_to_cart', 'purchase') GROUP BY view_mode",
            "inter_raw"),
        "quality_metrics": _with(
            " UNION ALL ".join([
                _metrics("users", "users_raw", ["user_id", "age", "gender", "device"],
                         "age BETWEEN 18 AND 65", "user_id"),
                _metrics("products", "products_raw",
                         ["item_id", "price", "brand", "category", "rating", "in_stock"],
                         "price > 0", "item_id"),
                _metrics("transactions", "inter_raw",
                         ["user_id", "item_id", "view_mode", "rating", "ts"],
                         "view_mode IN ('view', 'add_to_cart', 'purchase')", "event_id")]),
            "users_raw", "products_raw", "inter_raw"),
        "feature_freshness": _with(
            "SELECT d AS age_days, d < 1 AS passed FROM (SELECT "
            "date_diff('day', CAST(max(ts) AS DATE), DATE '2001-12-01') AS d FROM facts) t",
            "facts"),
        "snapshot_profile": _with(_profile("users_raw", {
            "user_id": "bigint", "age": "double", "gender": "string", "device": "string"}),
            "users_raw"),
        "snapshot_drift": _with(
            f", old AS ({_DRIFT_OLD}), new AS ({_DRIFT_NEW}) "
            "SELECT coalesce(o.column_name, n.column_name) AS column_name, o.data_type AS old_type, "
            "o.record_count AS old_rows, round(o.null_count / o.record_count, 6) AS old_null_share, "
            "n.data_type AS new_type, n.record_count AS new_rows, "
            "round(n.null_count / n.record_count, 6) AS new_null_share, "
            "CASE WHEN o.data_type IS NULL THEN 'added' WHEN n.data_type IS NULL THEN 'removed' "
            "WHEN o.data_type <> n.data_type THEN 'retyped' ELSE 'kept' END AS change, "
            f"{_r('n.null_count / n.record_count - o.null_count / o.record_count', 'null_share_change')} "
            "FROM old o FULL JOIN new n ON o.column_name = n.column_name", "products_raw"),
        "content_md5": _with(
            "SELECT count(*) AS record_count, CAST(sum(CAST(CAST('0x' || substr(md5("
            "CAST(user_id AS VARCHAR) || '|' || coalesce(CAST(age AS VARCHAR), '\\N') || '|' || "
            "coalesce(gender, '\\N') || '|' || coalesce(device, '\\N') || '|' || source_file "
            "|| '|' || CAST(row_seq AS VARCHAR)), 1, 15) AS BIGINT) AS HUGEINT)) "
            "AS VARCHAR) AS content_hash FROM users_raw", "users_raw"),
        "latest_partition": f"SELECT {_EVENT} FROM events "
                            "WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)",
        "snapshot_as_of": f"SELECT {_EVENT} FROM events WHERE CAST(ts AS DATE) = (SELECT "
                          "max(CAST(ts AS DATE)) FROM events WHERE ts < '2024-01-16')",
        "all_partitions": f"SELECT {_EVENT}, strftime(ts, '%Y-%m-%d') AS dt FROM events",
        "users_csv_scan": _with("SELECT user_id, round(age, 6) AS age, gender, device "
                                "FROM users_raw", "users_raw"),
        "transactions_csv_scan": _with(
            f"SELECT user_id, item_id, view_mode, rating, {_ts('ts', 'timestamp')} FROM inter_raw",
            "inter_raw"),
        "quarantined_files": "SELECT 'user_matrix_0.csv' AS file, 'age,gender,device' AS "
                             "missing_columns FROM customer LIMIT 1",
        "products_json_scan": _with(
            "SELECT item_id, round(price, 6) AS price, brand, category, round(rating, 6) AS rating, "
            "in_stock FROM products_raw", "products_raw"),
        "user_features": _with(
            f"SELECT u.user_id, coalesce(a.n, 0) AS user_activity_count, "
            f"{_r('CASE WHEN a.n IS NULL THEN 0.0 ELSE a.mean_rating END', 'avg_rating_given')}, "
            f"{_r('CASE WHEN a.n IS NULL THEN 0.0 ELSE a.purchases / a.n END', 'purchase_ratio')}, "
            f"coalesce(c.category, 'Unknown') AS preferred_category, {clean_user} "
            "FROM users_clean u LEFT JOIN (SELECT user_id, count(*) AS n, avg(rating) AS mean_rating, "
            "count(*) FILTER (WHERE view_mode = 'purchase') AS purchases FROM facts GROUP BY user_id) a "
            "USING (user_id) LEFT JOIN (SELECT user_id, category FROM (SELECT user_id, category, "
            "row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, category) AS rn "
            "FROM facts JOIN products_clean USING (item_id) WHERE category IS NOT NULL "
            "GROUP BY user_id, category) t WHERE rn = 1) c USING (user_id)",
            "users_clean", "products_clean", "facts"),
        "item_features": _with(
            f"SELECT p.item_id, {clean_product}, coalesce(popularity_score, 0) AS popularity_score, "
            f"{_r('coalesce(avg_item_rating, 0.0)', 'avg_item_rating')}, purchase_count, view_count, "
            f"{rate} FROM products_clean p LEFT JOIN item_stats s USING (item_id)",
            "products_clean", "item_stats"),
        "interaction_features": _with(
            f"SELECT event_id, user_id, item_id, view_mode, rating, {_ts('ts', 'timestamp')}, "
            "view_mode_encoded, implicit_score, days_since, "
            f"{_r('recency_weight', 'recency_weight')}, {_r('rating_normalized', 'rating_normalized')}, "
            f"{_r('user_item_affinity', 'user_item_affinity')} FROM inter_features",
            "inter_features"),
        "feature_lookup": _with(
            f"SELECT item_id, {stats}, {rate}, '2024-02-01 00:00:00' AS updated_at FROM item_stats "
            "WHERE item_id IN (SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) FROM events)",
            "item_stats"),
        "feature_upsert": _with(
            "SELECT item_id, coalesce(n.c, o.c) AS popularity_score, "
            "CASE WHEN o.c IS NOT NULL THEN '2024-01-01 00:00:00' ELSE '2024-02-01 00:00:00' END "
            "AS created_at, CASE WHEN n.c IS NOT NULL THEN '2024-02-01 00:00:00' "
            "ELSE '2024-01-01 00:00:00' END AS updated_at "
            "FROM (SELECT item_id, count(*) AS c FROM facts WHERE ts < '1998-06-01' GROUP BY 1) o "
            "FULL JOIN (SELECT item_id, count(*) AS c FROM facts WHERE ts >= '1998-06-01' GROUP BY 1) n "
            "USING (item_id)", "facts"),
        "feature_registry": _with(_registry(), "facts"),
        "rating_triples": _with(f"SELECT user_id, item_id, {_r('score', 'score')} FROM triples",
                                "triples"),
        "train_test_split": _with(
            f"SELECT user_id, item_id, {_r('score', 'score')}, part FROM split", "split"),
        "popularity_topk": _with(
            "SELECT item_id, count(*) AS popularity FROM facts GROUP BY item_id "
            "ORDER BY popularity DESC, item_id LIMIT 20", "facts"),
        "unseen_topk": _with(
            ", scores AS (SELECT item_id, count(*) AS score FROM facts GROUP BY item_id) "
            "SELECT user_id, item_id, CAST(score AS DOUBLE) AS predicted_score, rnk AS rank FROM ("
            "SELECT u.user_id, s.item_id, s.score, row_number() OVER (PARTITION BY u.user_id "
            "ORDER BY s.score DESC, s.item_id) AS rnk "
            "FROM (SELECT DISTINCT user_id FROM facts) u CROSS JOIN scores s "
            "WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.user_id = u.user_id "
            "AND p.item_id = s.item_id)) t WHERE rnk <= 10", "pairs"),
        "baseline_predict": _with(
            f"SELECT s.user_id, s.item_id, {_r('s.score', 'score')}, "
            f"{_r('least(5.0, greatest(1.0, mu + coalesce(item_bias, 0) + coalesce(user_bias, 0)))', 'prediction')} "
            "FROM split s LEFT JOIN bias_i USING (item_id) LEFT JOIN bias_u USING (user_id), biases "
            "WHERE part = 'test'", "bias_u"),
        "baseline_topk": baseline,
        "recommendation_sample": (
            f"SELECT user_id, item_id, predicted_score, rank, '2024-02-01' AS inference_date, "
            f"saved_rows FROM (SELECT *, count(*) OVER () AS saved_rows, row_number() OVER "
            f"(ORDER BY user_id, rank) AS place FROM ({baseline}) l) s WHERE place <= 20"),
        "model_saved_and_served": _with(_list_facts(
            "(SELECT user_id, count(*) AS n FROM pairs WHERE user_id = "
            "(SELECT min(user_id) FROM pairs) GROUP BY user_id)",
            "(SELECT DISTINCT item_id FROM pairs)"), "pairs"),
        "baseline_topk_work": _with(
            ", n AS (SELECT count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items "
            "FROM pairs), lists AS (SELECT least(10, items - count(*)) AS k FROM pairs, n "
            "GROUP BY user_id, items) "
            "SELECT 'pairs' AS fact, users * items AS value FROM n UNION ALL "
            "SELECT 'list_rows', CAST(sum(k) AS BIGINT) FROM lists UNION ALL "
            "SELECT 'all_products', 0", "pairs"),
        "sgd_quality": _with(
            ", s AS (SELECT *, substr(md5(CAST(user_id AS VARCHAR) || '-' || CAST(item_id AS VARCHAR) "
            "|| '-42'), 1, 8) < 'cccccccc' AS train FROM pairs) "
            "SELECT 'train_rows' AS fact, count(*) AS value FROM s WHERE train UNION ALL "
            "SELECT 'test_rows', count(*) FROM s WHERE NOT train UNION ALL "
            "SELECT 'users', count(DISTINCT user_id) FROM s WHERE train UNION ALL "
            "SELECT 'items', count(DISTINCT item_id) FROM s WHERE train UNION ALL "
            "SELECT * FROM (VALUES ('epochs', 20), ('rising_epochs', 0), "
            "('no_better_than_biases', 0)) v(fact, value)", "pairs"),
        "als_topk": _with(_list_facts(
            "(SELECT user_id, count(*) AS n FROM pairs GROUP BY user_id)",
            "(SELECT DISTINCT item_id FROM pairs)"), "pairs"),
        "hybrid_topk": _with(_list_facts(
            "(SELECT c.user_id, count(p.item_id) AS n FROM (SELECT DISTINCT user_id FROM users_raw) c "
            "LEFT JOIN pairs p USING (user_id) GROUP BY c.user_id)",
            "products_first"), "pairs", "users_raw", "products_first"),
        "content_similar": _with(
            ", p AS (SELECT item_id, coalesce(brand, 'None') AS brand, "
            "coalesce(category, 'None') AS category FROM products_first) "
            "SELECT item_id, similar_item_id, similarity, rnk AS rank FROM ("
            "SELECT a.item_id, b.item_id AS similar_item_id, "
            "((CASE WHEN a.brand = b.brand THEN 1 ELSE 0 END) "
            "+ (CASE WHEN a.category = b.category THEN 1 ELSE 0 END)) / 2.0 AS similarity, "
            "row_number() OVER (PARTITION BY a.item_id ORDER BY "
            "(CASE WHEN a.brand = b.brand THEN 1 ELSE 0 END) "
            "+ (CASE WHEN a.category = b.category THEN 1 ELSE 0 END) DESC, b.item_id) AS rnk "
            "FROM p a JOIN p b ON a.item_id <> b.item_id "
            "AND (a.brand = b.brand OR a.category = b.category)) t WHERE rnk <= 10",
            "products_first"),
        "rank_metrics": _with(
            f"SELECT user_id, metric, CAST(k AS BIGINT) AS k, {_r('value', 'value')} "
            "FROM eval_metrics", "eval_metrics"),
        "rank_metrics_summary": _with(
            f"SELECT metric, CAST(k AS BIGINT) AS k, {_r('avg(value)', 'mean')}, "
            f"{_r('stddev_pop(value)', 'std')}, {_r('min(value)', 'min')}, {_r('max(value)', 'max')}, "
            "count(*) AS users FROM eval_metrics GROUP BY metric, k", "eval_metrics"),
        "eda_describe": _with(f"{_describe('price')} UNION ALL {_describe('rating')}",
                              "products_raw"),
        "eda_distribution": _with(f"{_distribution('gender')} UNION ALL {_distribution('device')}",
                                  "users_raw"),
        "eda_histogram": _with(
            ", s AS (SELECT min(price) AS lo, max(price) AS hi FROM products_raw), "
            "c AS (SELECT least(29, CAST(floor((price - lo) / (hi - lo) * 30) AS BIGINT)) AS bin, "
            "count(*) AS n FROM products_raw, s WHERE price IS NOT NULL GROUP BY 1) "
            f"SELECT g.bin, {_r('lo + g.bin * (hi - lo) / 30', 'bin_start')}, "
            f"{_r('lo + (g.bin + 1) * (hi - lo) / 30', 'bin_end')}, coalesce(c.n, 0) AS row_count "
            "FROM (SELECT unnest(range(30)) AS bin) g LEFT JOIN c USING (bin), s", "products_raw"),
        "eda_correlation": _with(_correlations(), "inter_features"),
        "eda_sparsity": _with(
            "SELECT users, items, filled_cells, users * items AS possible_cells, "
            f"{_r('filled_cells / (users * items)', 'density')}, "
            f"{_r('1 - filled_cells / (users * items)', 'sparsity')} FROM "
            "(SELECT (SELECT count(DISTINCT user_id) FROM users_raw) AS users, "
            "(SELECT count(DISTINCT item_id) FROM products_raw) AS items, "
            "(SELECT count(*) FROM pairs) AS filled_cells) t", "users_raw", "products_raw", "pairs"),
        "eda_activity": _with(
            f"{_activity('user_id', 'users_raw')} UNION ALL {_activity('item_id', 'products_raw')}",
            "facts", "users_raw", "products_raw"),
        "eda_daily": _with("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS interactions "
                           "FROM facts GROUP BY 1", "facts"),
        "eda_rating_counts": _with("SELECT rating, count(*) AS row_count FROM inter_clean "
                                   "GROUP BY rating", "inter_clean"),
        "user_item_matrix": _with(
            "SELECT user_id, " + ", ".join(
                f"CAST(coalesce(sum(implicit_score) FILTER (WHERE item_id = {i}), 0) AS BIGINT) "
                f"AS \"{i}\"" for i in range(100))
            + " FROM inter_clean GROUP BY user_id", "inter_clean"),
        "user_item_rows": _with(
            "SELECT user_id, item_id, CAST(sum(implicit_score) AS BIGINT) AS value "
            "FROM inter_clean GROUP BY user_id, item_id", "inter_clean"),
        "completeness": _with(
            "SELECT 'users' AS dataset, count(*) AS record_count, 4 AS attributes, "
            "CAST(floor(round((count(user_id) + count(age) + count(gender) + count(device)) "
            "* 100.0 / (4 * count(*)), 9)) AS BIGINT) AS score, "
            "(count(user_id) + count(age) + count(gender) + count(device)) * 100.0 "
            "/ (4 * count(*)) >= 95 AS healthy FROM users_raw UNION ALL "
            "SELECT 'products', count(*), 6, CAST(floor(round((count(item_id) + count(price) "
            "+ count(brand) + count(category) + count(rating) + count(in_stock)) "
            "* 100.0 / (6 * count(*)), 9)) AS BIGINT), (count(item_id) + count(price) + count(brand) "
            "+ count(category) + count(rating) + count(in_stock)) * 100.0 / (6 * count(*)) >= 95 "
            "FROM products_raw", "users_raw", "products_raw"),
        "sample_values": _with(" UNION ALL ".join([
            _samples("user_id", "CAST(user_id AS VARCHAR)"),
            _samples("age", "CAST(age AS VARCHAR)"),
            _samples("gender", "gender"), _samples("device", "device")]), "users_raw"),
        "stream_valid_events": _with(
            "SELECT user_id, item_id, view_mode, rating, "
            f"{_ts('ts', 'timestamp')}, 'e' || CAST(event_id AS VARCHAR) AS event_id, "
            "CASE view_mode WHEN 'view' THEN 1 WHEN 'add_to_cart' THEN 2 ELSE 3 END AS implicit_score "
            "FROM wire_valid, range(1, 3) c(i) WHERE i <= copies", "wire_valid"),
        "stream_valid_users": _with(
            "SELECT user_id, age, gender, device FROM wire, range(1, 3) c(i) "
            "WHERE i <= copies AND event_type = 'signup' AND NOT broken AND age > 0 "
            "AND gender <> 'X' AND device <> 'Phone'", "wire"),
        "stream_rejects": _with(
            ", r AS (SELECT copies, CASE WHEN broken THEN 'json' "
            "WHEN event_type = 'signup' THEN concat_ws(',', CASE WHEN age <= 0 THEN 'age' END, "
            "CASE WHEN gender = 'X' THEN 'gender' END, CASE WHEN device = 'Phone' THEN 'device' END) "
            "ELSE concat_ws(',', CASE WHEN view_mode NOT IN ('view', 'add_to_cart', 'purchase') "
            "THEN 'view_mode' END, CASE WHEN bad_rating THEN 'rating' END, "
            "CASE WHEN bad_ts THEN 'timestamp' END) END AS reasons FROM wire) "
            "SELECT reasons, CAST(sum(copies) AS BIGINT) AS events FROM r WHERE reasons <> '' GROUP BY reasons",
            "wire"),
        "stream_dedup": _with(
            "SELECT user_id, item_id, view_mode, rating, "
            f"{_ts('ts', 'timestamp')}, 'e' || CAST(event_id AS VARCHAR) AS event_id, "
            "CASE view_mode WHEN 'view' THEN 1 WHEN 'add_to_cart' THEN 2 ELSE 3 END AS implicit_score "
            "FROM wire_valid", "wire_valid"),
        "stream_window_counts": _with(
            ", d AS (SELECT *, event_id % 3 AS n, date_trunc('day', ts) AS day FROM wire_valid "
            "WHERE item_id IS NOT NULL), "
            "edge AS (SELECT max(ts) FILTER (WHERE n = 0) AS one, max(ts) FILTER (WHERE n < 2) AS two FROM d), "
            "m AS (SELECT d.*, coalesce(CASE n WHEN 1 THEN day + INTERVAL 8 DAY <= one "
            "WHEN 2 THEN day + INTERVAL 8 DAY <= two END, FALSE) AS late FROM d, edge) "
            "SELECT CASE WHEN late THEN 'late' ELSE 'window' END AS kind, item_id, "
            "strftime(day, '%Y-%m-%d %H:%M:%S') AS window_start, CAST(sum(copies) AS BIGINT) AS events, "
            "CAST(coalesce(sum(copies) FILTER (WHERE view_mode = 'purchase'), 0) AS BIGINT) AS purchases, "
            "CAST(coalesce(sum(copies * rating), 0) AS BIGINT) AS rating_sum "
            "FROM m GROUP BY late, item_id, day", "wire_valid"),
        "stream_buffered":
            "SELECT lane, count(*) AS events, CAST(ceil(count(*) / 100.0) AS BIGINT) AS groups, "
            "count(*) // 100 AS full_groups, least(100, count(*)) AS largest "
            "FROM (SELECT user_id % 4 AS lane FROM events) e GROUP BY lane",
        "stream_item_counts": _with(
            f", s AS (SELECT item_id, CAST(sum(copies) AS BIGINT) AS popularity_score, "
            "sum(copies * rating) / sum(CASE WHEN rating IS NOT NULL THEN copies END) AS avg_item_rating, "
            "CAST(coalesce(sum(copies) FILTER (WHERE view_mode = 'purchase'), 0) AS BIGINT) AS purchase_count, "
            "CAST(coalesce(sum(copies) FILTER (WHERE view_mode = 'view'), 0) AS BIGINT) AS view_count "
            "FROM wire_valid GROUP BY item_id) "
            f"SELECT item_id, {stats}, {rate} FROM s", "wire_valid"),
        "stream_new_files": "SELECT event_type, count(*) AS events, 1 AS run FROM events "
                            "WHERE event_id % 2 = 0 GROUP BY event_type UNION ALL "
                            "SELECT event_type, count(*), 2 FROM events GROUP BY event_type",
        "stream_user_counts": _with(
            ", s AS (SELECT user_id, CAST(sum(copies) AS BIGINT) AS user_activity_count, "
            "sum(copies * rating) / sum(CASE WHEN rating IS NOT NULL THEN copies END) AS avg_rating_given, "
            "CAST(coalesce(sum(copies) FILTER (WHERE view_mode = 'purchase'), 0) AS BIGINT) AS purchase_count "
            "FROM wire_valid GROUP BY user_id) "
            f"SELECT user_id, user_activity_count, {_r('avg_rating_given', 'avg_rating_given')}, "
            f"purchase_count, {_r('purchase_count / user_activity_count', 'purchase_ratio')} FROM s",
            "wire_valid"),
        "stream_staged_union": _with(
            "SELECT view_mode, CAST(sum(copies) AS BIGINT) AS row_count, CAST(sum(copies * rating) AS BIGINT) AS rating_sum FROM ("
            "SELECT view_mode, rating, 1 AS copies FROM inter_raw UNION ALL "
            "SELECT view_mode, rating, copies FROM wire_valid) t GROUP BY view_mode",
            "inter_raw", "wire_valid"),
        "stream_wire_format":
            "SELECT CAST(user_id AS VARCHAR) AS \"key\", '{\"user_id\":' || user_id || ',\"item_id\":' "
            "|| k || ',\"view_mode\":\"' || event_type || '\",\"event_id\":\"' || user_id || '_' || k "
            "|| '_' || (epoch_us(ts) // 1000) || '\"}' AS value, 'transactions' AS topic "
            "FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events) e",
    }
    return sql

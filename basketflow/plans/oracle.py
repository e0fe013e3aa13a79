"""SQL oracles: for each relational query of the catalogue, the same result written in plain SQL.

They run in DuckDB over the given tables (``orders``, ``lineitem``, ``part`` ...), so every
statement starts by building the retail view (FIXTURES.md) from them. The SQL is written from
the operator definitions, independently of the Spark code, and serves as the correctness check.
Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

# ------------------------------------------------------------------ view and feature fragments
# Each entry is one CTE "name AS (...)"; a query lists the ones it needs, in order.

CTE = {}

CTE["o_base"] = """o_base AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS order_number,
         count(*) OVER (PARTITION BY o_custkey) AS n_orders,
         lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev_date
  FROM orders)"""

CTE["r_orders"] = """r_orders AS (
  SELECT order_id, user_id,
         CASE WHEN order_number < n_orders THEN 'prior' WHEN user_id % 3 = 0 THEN 'test' ELSE 'train' END AS eval_set,
         CAST(order_number AS INTEGER) AS order_number,
         CAST(dayofweek(o_orderdate) AS INTEGER) AS order_dow,
         CAST(order_id % 24 AS INTEGER) AS order_hour_of_day,
         CASE WHEN prev_date IS NULL THEN NULL
              ELSE least(30.0, CAST(floor(date_diff('day', prev_date, o_orderdate) / 8.0) AS DOUBLE)) END
           AS days_since_prior_order
  FROM o_base)"""

CTE["l_base"] = """l_base AS (
  SELECT l_orderkey AS order_id,
         CAST(((CASE WHEN o_custkey % 2 = 0 THEN 0 ELSE o_custkey * 37 END) + l_partkey % 50)
              % (SELECT count(*) FROM part) + 1 AS INTEGER) AS product_id, min(l_linenumber) AS ln
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""

CTE["r_lines"] = """r_lines AS (
  SELECT l.order_id, l.product_id,
         CAST(row_number() OVER (PARTITION BY l.order_id ORDER BY l.ln, l.product_id) AS INTEGER) AS add_to_cart_order,
         CAST(CASE WHEN row_number() OVER (PARTITION BY r.user_id, l.product_id ORDER BY r.order_number) > 1
                   THEN 1 ELSE 0 END AS INTEGER) AS reordered,
         r.eval_set, r.user_id, r.order_number
  FROM l_base l JOIN r_orders r ON l.order_id = r.order_id)"""

CTE["r_products"] = """r_products AS (
  SELECT CAST(p_partkey + 1 AS INTEGER) AS product_id, p_name AS product_name,
         CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS aisle_id, CAST(p_size % 7 + 1 AS INTEGER) AS department_id
  FROM part)"""

CTE["prior_l"] = "prior_l AS (SELECT * FROM r_lines WHERE eval_set = 'prior')"
CTE["train_l"] = "train_l AS (SELECT * FROM r_lines WHERE eval_set = 'train')"
CTE["test_l"] = "test_l AS (SELECT * FROM r_lines WHERE eval_set = 'test')"

CTE["pairs"] = """pairs AS (
  SELECT user_id, product_id, count(*) AS n, CAST(sum(reordered) AS BIGINT) AS r,
         count(*) FILTER (WHERE order_number > 1) AS nf, CAST(sum(add_to_cart_order) AS BIGINT) AS pos
  FROM prior_l GROUP BY 1, 2)"""

CTE["users_f"] = """u_o AS (
  SELECT user_id, avg(days_since_prior_order) AS user_average_days_between_orders,
         count(*) AS user_total_orders, sum(days_since_prior_order) AS user_period
  FROM r_orders GROUP BY 1),
u_p AS (
  SELECT user_id, CAST(sum(n) AS BIGINT) AS user_total_items, count(*) AS total_distinct_items,
         CAST(sum(r) AS DOUBLE) / nullif(CAST(sum(nf) AS DOUBLE), 0) AS user_reorder_ratio
  FROM pairs GROUP BY 1),
u_b AS (
  SELECT user_id, median(basket_size) AS user_median_basket
  FROM (SELECT user_id, order_id, max(add_to_cart_order) AS basket_size FROM prior_l GROUP BY 1, 2) GROUP BY 1),
u_s AS (
  SELECT p.user_id, count(DISTINCT pr.aisle_id) AS user_nb_aisles, count(DISTINCT pr.department_id) AS user_nb_departments
  FROM pairs p LEFT JOIN r_products pr ON p.product_id = pr.product_id GROUP BY 1),
users_f AS (
  SELECT u_o.user_id, u_o.user_average_days_between_orders, u_o.user_total_orders, u_o.user_period,
         u_p.user_total_items, u_p.total_distinct_items, u_p.user_reorder_ratio,
         u_b.user_median_basket, u_s.user_nb_aisles, u_s.user_nb_departments,
         CAST(u_p.user_total_items AS DOUBLE) / nullif(CAST(u_o.user_total_orders AS DOUBLE), 0) AS user_average_basket
  FROM u_o LEFT JOIN u_p ON u_o.user_id = u_p.user_id LEFT JOIN u_b ON u_o.user_id = u_b.user_id
       LEFT JOIN u_s ON u_o.user_id = u_s.user_id)"""

CTE["orders_da"] = """orders_cum AS (
  SELECT *, CASE WHEN days_since_prior_order IS NULL THEN 0.0
                 ELSE sum(days_since_prior_order) OVER (PARTITION BY user_id ORDER BY order_number
                                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS cum
  FROM r_orders),
orders_da AS (
  SELECT order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day, days_since_prior_order,
         CAST(trunc(max(cum) OVER (PARTITION BY user_id) - cum) AS INTEGER) AS days_ago_since_last
  FROM orders_cum)"""

CTE["orders_ratio"] = """orders_ratio AS (
  SELECT o.*, o.days_since_prior_order / nullif(u.user_average_days_between_orders, 0) AS days_since_ratio
  FROM orders_da o LEFT JOIN users_f u ON o.user_id = u.user_id)"""

CTE["lines_da"] = """lines_da AS (
  SELECT l.order_id, l.product_id, l.add_to_cart_order, l.reordered, l.user_id, l.order_number,
         o.days_ago_since_last, o.order_hour_of_day
  FROM prior_l l JOIN orders_da o ON l.order_id = o.order_id)"""

CTE["gaps"] = """gaps AS (
  SELECT *, lag(days_ago_since_last) OVER (PARTITION BY user_id, product_id ORDER BY order_number)
            - days_ago_since_last AS gap
  FROM lines_da)"""

CTE["freq"] = """freq_mu AS (SELECT product_id, avg(gap) AS mu FROM gaps WHERE gap IS NOT NULL GROUP BY 1),
freq_mom AS (
  SELECT g.product_id, avg(g.gap) AS frequency_mean, stddev_pop(g.gap) AS frequency_std,
         avg(power(g.gap - m.mu, 2)) AS m2, avg(power(g.gap - m.mu, 3)) AS m3, avg(power(g.gap - m.mu, 4)) AS m4
  FROM gaps g JOIN freq_mu m ON g.product_id = m.product_id WHERE g.gap IS NOT NULL GROUP BY 1),
freq AS (
  SELECT product_id, frequency_mean, frequency_std,
         CASE WHEN m2 = 0 THEN NULL ELSE m3 / power(m2, 1.5) END AS frequency_skew,
         CASE WHEN m2 = 0 THEN NULL ELSE m4 / (m2 * m2) - 3.0 END AS frequency_kurtosis
  FROM freq_mom)"""

CTE["prod_f"] = """prod_s AS (
  SELECT product_id, CAST(sum(n) AS BIGINT) AS product_orders, CAST(sum(r) AS BIGINT) AS product_reorders,
         count(*) AS product_nb_users, CAST(sum(pos) AS BIGINT) AS pos_sum,
         count(*) AS prod_buy_first_time_total_cnt,
         count(*) FILTER (WHERE n >= 2) AS prod_buy_second_time_total_cnt
  FROM pairs GROUP BY 1),
prod_f AS (
  SELECT p.product_id, p.product_name, p.aisle_id, p.department_id,
         s.product_orders, s.product_reorders,
         CAST(s.product_reorders AS DOUBLE) / nullif(CAST(s.product_orders AS DOUBLE), 0) AS product_reorder_rate,
         s.product_nb_users,
         CAST(s.pos_sum AS DOUBLE) / nullif(CAST(s.product_orders AS DOUBLE), 0) AS product_mean_add_to_cart_position,
         s.prod_buy_first_time_total_cnt, s.prod_buy_second_time_total_cnt,
         CAST(s.prod_buy_second_time_total_cnt AS DOUBLE)
           / nullif(CAST(s.prod_buy_first_time_total_cnt AS DOUBLE), 0) AS product_reorder_probability
  FROM r_products p LEFT JOIN prod_s s ON p.product_id = s.product_id)"""

CTE["up_f"] = """up_f AS (
  SELECT l.user_id, l.product_id, count(*) AS UP_orders,
         arg_max(l.order_id, l.order_number) AS UP_last_order_id,
         CAST(sum(l.add_to_cart_order) AS BIGINT) AS UP_sum_pos_in_cart,
         min(l.order_number) AS UP_first_order, max(l.order_number) AS UP_last_order,
         sum(1 + CAST(l.order_number AS DOUBLE) / CAST(u.user_total_orders AS DOUBLE)) AS UP_recency,
         CAST(sum(CAST(1.0::DOUBLE / (l.days_ago_since_last + 1) AS DECIMAL(28, 18))) AS DOUBLE) AS UP_recency_day,
         sum(exp(-0.02 * CAST(l.days_ago_since_last AS DOUBLE))) AS UP_recency_exp,
         CAST(count(*) AS DOUBLE)
           / nullif(CAST(max(u.user_total_orders) - min(l.order_number) + 1 AS DOUBLE), 0) AS UP_order_rate_since_first_order,
         arg_max(l.order_hour_of_day, l.order_number) AS UP_last_order_hour
  FROM lines_da l LEFT JOIN users_f u ON l.user_id = u.user_id GROUP BY 1, 2)"""

CTE["intervals"] = """intervals AS (
  SELECT user_id, product_id, avg(gap) AS UP_interval_mean, stddev_pop(gap) AS UP_interval_std,
         CASE WHEN count(*) = 1 THEN CAST(arg_max(days_ago_since_last, order_number) AS DOUBLE)
              ELSE abs(arg_max(days_ago_since_last, order_number) - avg(gap)) END AS UP_interval_distance,
         avg(order_number) / max(order_number) AS UP_order_number_skew
  FROM gaps GROUP BY 1, 2)"""

CTE["streak"] = """recent AS (
  SELECT order_id, user_id, order_number
  FROM (SELECT order_id, user_id, order_number,
               row_number() OVER (PARTITION BY user_id ORDER BY order_number DESC) AS k FROM r_orders)
  WHERE k <= 6),
recent_lines AS (
  SELECT l.order_id, l.product_id, r.user_id, r.order_number FROM prior_l l JOIN recent r ON l.order_id = r.order_id),
kept_orders AS (
  SELECT user_id, order_id, row_number() OVER (PARTITION BY user_id ORDER BY order_number DESC) AS age
  FROM (SELECT DISTINCT user_id, order_id, order_number FROM recent_lines)),
seen_pairs AS (SELECT DISTINCT user_id, product_id FROM recent_lines),
marks AS (
  SELECT p.user_id, p.product_id, k.age, EXISTS (SELECT 1 FROM recent_lines l WHERE l.order_id = k.order_id AND l.product_id = p.product_id) AS bought
  FROM seen_pairs p JOIN kept_orders k USING (user_id)),
newest AS (SELECT *, first_value(bought) OVER (PARTITION BY user_id, product_id ORDER BY age) AS state FROM marks),
streak AS (
  SELECT user_id, product_id,
         CAST((CASE WHEN any_value(state) THEN 1 ELSE -1 END) * (coalesce(min(age) FILTER (WHERE bought <> state), max(age) + 1) - 1) AS INTEGER) AS UP_order_streak
  FROM newest GROUP BY 1, 2)"""

CTE["t_orders"] = "t_orders AS (SELECT order_id, user_id FROM r_orders WHERE eval_set = 'test')"
CTE["hist"] = """hist AS (
  SELECT user_id, order_number, product_id FROM prior_l WHERE user_id IN (SELECT user_id FROM t_orders))"""
CTE["b1"] = """last_o AS (SELECT user_id, max(order_number) AS order_number FROM hist GROUP BY 1),
b1 AS (
  SELECT t.order_id, string_agg(CAST(h.product_id AS VARCHAR), ' ' ORDER BY h.product_id) AS products
  FROM (SELECT DISTINCT h.user_id, h.product_id FROM hist h
        JOIN last_o lo ON h.user_id = lo.user_id AND h.order_number = lo.order_number) h
  LEFT JOIN t_orders t ON h.user_id = t.user_id GROUP BY 1)"""
CTE["b2"] = """cnts AS (SELECT user_id, product_id, count(*) AS cnt FROM hist GROUP BY 1, 2),
topk AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY cnt DESC, product_id) AS rk FROM cnts),
b2 AS (
  SELECT t.order_id, string_agg(CAST(k.product_id AS VARCHAR), ' ' ORDER BY k.rk) AS products
  FROM topk k JOIN t_orders t ON k.user_id = t.user_id WHERE k.rk <= 5 GROUP BY 1)"""
CTE["truth_test"] = """truth_test AS (
  SELECT o.order_id,
         coalesce(string_agg(CASE WHEN l.reordered = 1 THEN CAST(l.product_id AS VARCHAR) END, ' '
                             ORDER BY l.add_to_cart_order), 'None') AS products
  FROM t_orders o LEFT JOIN test_l l ON o.order_id = l.order_id GROUP BY 1)"""
CTE["truth_train"] = """truth_train AS (
  SELECT o.order_id,
         coalesce(string_agg(CASE WHEN l.reordered = 1 THEN CAST(l.product_id AS VARCHAR) END, ' '
                             ORDER BY l.add_to_cart_order), 'None') AS products
  FROM (SELECT order_id FROM r_orders WHERE eval_set = 'train') o LEFT JOIN train_l l ON o.order_id = l.order_id
  GROUP BY 1)"""

CTE["cand"] = """tgt AS (SELECT order_id, user_id, eval_set, order_hour_of_day FROM r_orders WHERE eval_set <> 'prior'),
cand AS (
  SELECT t.order_id, p.user_id, p.product_id FROM pairs p JOIN tgt t ON p.user_id = t.user_id)"""
CTE["blend"] = """score_a AS (
  SELECT order_id, product_id, CAST((user_id * 37 + product_id * 11) % 997 + 1 AS DOUBLE) / 1000 AS prediction FROM cand),
score_b AS (
  SELECT order_id, product_id, CAST((user_id * 13 + product_id * 29) % 991 + 1 AS DOUBLE) / 1000 AS prediction FROM cand),
blend AS (
  SELECT a.order_id, a.product_id, a.prediction * 0.7 + b.prediction * 0.3 AS prediction
  FROM score_a a JOIN score_b b ON a.order_id = b.order_id AND a.product_id = b.product_id)"""

# True-count distributions of the top k (prefix) and of the rest (suffix), folded one
# score at a time by recursion, then the expected F1 of every (k, with/without None).
CTE["select_f1"] = """sel_in AS (SELECT order_id, product_id, prediction AS p FROM blend WHERE prediction > 0.01),
ranked AS (
  SELECT order_id, product_id, p,
         row_number() OVER (PARTITION BY order_id ORDER BY p DESC, product_id) AS i,
         count(*) OVER (PARTITION BY order_id) AS n
  FROM sel_in),
heads AS (SELECT DISTINCT order_id, n FROM ranked),
pre AS (
  SELECT order_id, 0 AS k, [1.0]::DOUBLE[] AS v FROM heads
  UNION ALL
  SELECT pre.order_id, pre.k + 1,
         list_transform(range(1, len(pre.v) + 2),
                        lambda j: coalesce(pre.v[j], 0) * (1 - r.p) + coalesce(CASE WHEN j > 1 THEN pre.v[j - 1] END, 0) * r.p)
  FROM pre JOIN ranked r ON r.order_id = pre.order_id AND r.i = pre.k + 1),
suf AS (
  SELECT order_id, n AS k, [1.0]::DOUBLE[] AS v FROM heads
  UNION ALL
  SELECT suf.order_id, suf.k - 1,
         list_transform(range(1, len(suf.v) + 2),
                        lambda j: coalesce(suf.v[j], 0) * (1 - r.p) + coalesce(CASE WHEN j > 1 THEN suf.v[j - 1] END, 0) * r.p)
  FROM suf JOIN ranked r ON r.order_id = suf.order_id AND r.i = suf.k),
p_none AS (SELECT order_id, v[1] AS pn FROM suf WHERE k = 0),
pre_rows AS (SELECT order_id, k, unnest(range(len(v))) AS a, unnest(v) AS ca FROM pre),
suf_rows AS (SELECT order_id, k, unnest(range(len(v))) AS b, unnest(v) AS rb FROM suf),
f1_tab AS (
  SELECT x.order_id, x.k,
         sum(CASE WHEN x.k + x.a + y.b = 0 THEN 0.0 ELSE x.ca * y.rb * 2.0 * x.a / (x.k + x.a + y.b) END) AS f1,
         sum(x.ca * y.rb * 2.0 * x.a / (x.k + x.a + y.b + 1)) AS f1n
  FROM pre_rows x JOIN suf_rows y ON x.order_id = y.order_id AND x.k = y.k GROUP BY 1, 2),
choices AS (
  SELECT t.order_id, t.k, 0 AS flag, t.f1n + 2.0 * pn.pn / (2 + t.k) AS val
  FROM f1_tab t JOIN p_none pn ON t.order_id = pn.order_id
  UNION ALL
  SELECT order_id, k, 1 AS flag, f1 AS val FROM f1_tab),
best AS (
  SELECT order_id, k, flag, val FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY val DESC, flag, k) AS pick FROM choices)
  WHERE pick = 1)"""

VIEW = ["o_base", "r_orders", "l_base", "r_lines", "r_products"]
PRIOR = VIEW + ["prior_l"]
USERS = PRIOR + ["pairs", "users_f"]
LINES_DA = PRIOR + ["orders_da", "lines_da", "gaps"]
BASELINE = PRIOR + ["t_orders", "hist"]


def with_ctes(names: list[str], body: str, extra: str | None = None) -> str:
    """``body`` preceded by the named CTE fragments (in order) and an optional extra CTE text."""
    seen, parts = set(), []
    for n in names:
        if n not in seen:
            seen.add(n)
            parts.append(CTE[n])
    if extra:
        parts.append(extra.strip())
    head = "WITH RECURSIVE " if "select_f1" in seen else "WITH "
    return head + ",\n".join(parts) + "\n" + body


def rounded(body: str, doubles: list[str]) -> str:
    """Round the named double columns of ``body``'s result to 6 places."""
    if not doubles:
        return body
    rep = ", ".join(f"round({c}, 6) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM (\n{body}\n) q"


def f1_body(pred: str, truth: str, method: str) -> str:
    """Mean per-order F1 of decision table ``pred`` against ``truth`` (E5) as one SELECT."""
    return f"""SELECT '{method}' AS method, avg(coalesce(f1, 0.0)) AS mean_f1, count(*) AS n_orders FROM (
  SELECT order_id,
         2.0 * count(*) FILTER (WHERE p AND t)
           / nullif(2.0 * count(*) FILTER (WHERE p AND t) + count(*) FILTER (WHERE p AND NOT t)
                    + count(*) FILTER (WHERE t AND NOT p), 0) AS f1
  FROM (
    SELECT coalesce(pp.order_id, tt.order_id) AS order_id, pp.token IS NOT NULL AS p, tt.token IS NOT NULL AS t
    FROM (SELECT DISTINCT order_id, token FROM (
            SELECT x.order_id, unnest(string_split(coalesce(y.products, 'None'), ' ')) AS token
            FROM {truth} x LEFT JOIN {pred} y ON x.order_id = y.order_id) WHERE token <> '') pp
    FULL OUTER JOIN
         (SELECT DISTINCT order_id, token FROM (
            SELECT order_id, unnest(string_split(products, ' ')) AS token FROM {truth}) WHERE token <> '') tt
    ON pp.order_id = tt.order_id AND pp.token = tt.token)
  GROUP BY order_id)"""


def _q() -> dict[str, str]:
    q: dict[str, str] = {}
    ORD_COLS = "order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day, days_since_prior_order"
    q["s_scan_orders"] = with_ctes(VIEW, f"SELECT {ORD_COLS} FROM r_orders")
    q["s_scan_lines"] = with_ctes(VIEW, "SELECT order_id, product_id, add_to_cart_order, reordered, eval_set FROM r_lines")
    q["s_scan_products"] = with_ctes(VIEW, "SELECT product_id, product_name, aisle_id, department_id FROM r_products")
    days_ago = with_ctes(VIEW + ["orders_da"],
                         "SELECT order_id, user_id, order_number, days_ago_since_last FROM orders_da")
    q["w_days_ago"] = days_ago
    q["s_roundtrip_stage"] = days_ago
    q["s_csv_typed_scan"] = q["s_scan_orders"]
    q["p_eval_set_filter"] = with_ctes(VIEW, f"SELECT {ORD_COLS} FROM r_orders WHERE eval_set <> 'prior'")
    q["p_user_history"] = with_ctes(VIEW, f"SELECT {ORD_COLS} FROM r_orders WHERE user_id = 1")

    q["a_product_stats"] = rounded(with_ctes(USERS + ["prod_f"], "SELECT * FROM prod_f"),
                                   ["product_reorder_rate", "product_mean_add_to_cart_position",
                                    "product_reorder_probability"])
    q["a_purchase_ordinals"] = rounded(with_ctes(PRIOR, """
SELECT product_id, count(*) FILTER (WHERE ordinal = 1) AS prod_buy_first_time_total_cnt,
       count(*) FILTER (WHERE ordinal = 2) AS prod_buy_second_time_total_cnt,
       CAST(count(*) FILTER (WHERE ordinal = 2) AS DOUBLE)
         / nullif(CAST(count(*) FILTER (WHERE ordinal = 1) AS DOUBLE), 0) AS product_reorder_probability
FROM ords GROUP BY 1""", extra="""ords AS (
  SELECT product_id, row_number() OVER (PARTITION BY user_id, product_id ORDER BY order_number) AS ordinal FROM prior_l)"""), ["product_reorder_probability"])
    q["a_user_features"] = rounded(with_ctes(USERS, "SELECT * FROM users_f"),
                                   ["user_average_days_between_orders", "user_period", "user_reorder_ratio",
                                    "user_median_basket", "user_average_basket"])
    q["w_days_since_ratio"] = rounded(with_ctes(USERS + ["orders_da", "orders_ratio"],
                                                "SELECT order_id, user_id, days_since_ratio FROM orders_ratio"),
                                      ["days_since_ratio"])
    q["a_product_gaps"] = rounded(with_ctes(LINES_DA + ["freq"], "SELECT * FROM freq"),
                                  ["frequency_mean", "frequency_std", "frequency_skew", "frequency_kurtosis"])
    q["a_user_product"] = rounded(with_ctes(USERS + ["orders_da", "lines_da", "up_f"], """
SELECT user_id, product_id, UP_orders, UP_last_order_id, UP_sum_pos_in_cart, UP_first_order, UP_last_order,
       UP_recency, UP_recency_day, UP_recency_exp, UP_order_rate_since_first_order FROM up_f"""),
        ["UP_recency", "UP_recency_day", "UP_recency_exp", "UP_order_rate_since_first_order"])
    q["a_pair_intervals"] = rounded(with_ctes(LINES_DA + ["intervals"], """
SELECT user_id, product_id, UP_interval_mean, UP_interval_std, UP_interval_distance FROM intervals"""),
        ["UP_interval_mean", "UP_interval_std", "UP_interval_distance"])
    q["a_pair_skew"] = rounded(with_ctes(LINES_DA + ["intervals"],
                                         "SELECT user_id, product_id, UP_order_number_skew FROM intervals"),
                               ["UP_order_number_skew"])
    q["w_order_streak"] = with_ctes(PRIOR + ["streak"], "SELECT * FROM streak")

    q["a_eval_set_counts"] = with_ctes(VIEW, """
SELECT eval_set, count(*) AS n_orders, count(DISTINCT user_id) AS n_users FROM r_orders GROUP BY 1""")
    q["a_distinct_entities"] = with_ctes(VIEW, """
SELECT (SELECT count(*) FROM r_orders) AS n_orders, (SELECT count(DISTINCT user_id) FROM r_orders) AS n_users,
       (SELECT count(DISTINCT product_id) FROM r_products) AS n_products""")
    q["a_history_histogram"] = rounded(with_ctes(VIEW, """
SELECT history_len, n_users,
       CAST(sum(history_len * n_users) OVER () AS DOUBLE) / sum(n_users) OVER () AS avg_history_len
FROM hh ORDER BY n_users DESC, history_len LIMIT 80""", extra="""hh AS (
  SELECT history_len, count(*) AS n_users
  FROM (SELECT user_id, max(order_number) AS history_len FROM r_orders GROUP BY 1) GROUP BY 1)"""), ["avg_history_len"])
    q["a_basket_histogram"] = rounded(with_ctes(PRIOR, """
SELECT basket_size, n_orders,
       CAST(sum(basket_size * n_orders) OVER () AS DOUBLE) / sum(n_orders) OVER () AS avg_basket_size
FROM bh""", extra="""bh AS (
  SELECT basket_size, count(*) AS n_orders
  FROM (SELECT order_id, max(add_to_cart_order) AS basket_size FROM prior_l GROUP BY 1) GROUP BY 1)"""), ["avg_basket_size"])
    for key, col in (("a_orders_by_hour", "order_hour_of_day"), ("a_orders_by_dow", "order_dow"),
                     ("a_orders_by_gap", "days_since_prior_order")):
        q[key] = with_ctes(VIEW, f"SELECT {col}, count(*) AS n_orders FROM r_orders WHERE {col} IS NOT NULL GROUP BY 1")
    q["a_reorder_by_dow_hour"] = rounded(with_ctes(VIEW + ["train_l"], """
SELECT o.order_dow, o.order_hour_of_day, avg(l.reordered) AS reorder_ratio
FROM train_l l LEFT JOIN r_orders o ON l.order_id = o.order_id GROUP BY 1, 2"""), ["reorder_ratio"])
    hours = ", ".join(f"avg(l.reordered) FILTER (WHERE o.order_hour_of_day = {h}) AS h{h}" for h in range(24))
    q["a_reorder_pivot"] = rounded(with_ctes(VIEW + ["train_l"], f"""
SELECT o.order_dow, {hours}
FROM train_l l LEFT JOIN r_orders o ON l.order_id = o.order_id GROUP BY 1"""), [f"h{h}" for h in range(24)])
    q["a_top_products"] = with_ctes(PRIOR, """
SELECT p.product_name, CAST(sum(c.cnt) AS BIGINT) AS frequency_count
FROM (SELECT product_id, count(*) AS cnt FROM prior_l GROUP BY 1) c
LEFT JOIN r_products p ON c.product_id = p.product_id
GROUP BY 1 ORDER BY frequency_count DESC, p.product_name LIMIT 20""")
    rates = """rates AS (
  SELECT s.product_id, s.reordered, s.order_cnt, CAST(s.reordered AS DOUBLE) / s.order_cnt AS reorder_rate, p.product_name
  FROM (SELECT l.product_id, CAST(sum(l.reordered) AS BIGINT) AS reordered, count(*) AS order_cnt
        FROM prior_l l JOIN r_orders o ON l.order_id = o.order_id GROUP BY 1) s
  LEFT JOIN r_products p ON s.product_id = p.product_id
  WHERE s.order_cnt > 100)"""
    q["a_reorder_rate_rank"] = rounded(with_ctes(PRIOR, """
SELECT * FROM rates ORDER BY reorder_rate DESC, product_id LIMIT 10""", extra=rates),
        ["reorder_rate"])
    q["a_reorder_rate_bottom"] = rounded(with_ctes(PRIOR, """
SELECT * FROM rates ORDER BY reorder_rate ASC, product_id DESC LIMIT 10""", extra=rates),
        ["reorder_rate"])
    q["a_reorder_by_cart_pos"] = rounded(with_ctes(PRIOR, """
SELECT least(add_to_cart_order, 60) AS add_to_cart_order_mod, avg(reordered) AS reorder_ratio
FROM prior_l GROUP BY 1"""), ["reorder_ratio"])
    reordered = """tg AS (SELECT order_id, user_id, order_number FROM r_orders WHERE eval_set <> 'prior'),
rl AS (
  SELECT t.order_id, t.user_id, t.order_number, l.product_id, count(*) AS n_times
  FROM tg t JOIN r_orders o ON o.user_id = t.user_id AND o.eval_set = 'prior'
  JOIN prior_l l ON l.order_id = o.order_id
  WHERE l.reordered = 1 GROUP BY 1, 2, 3, 4)"""
    q["a_user_reordered_lists"] = with_ctes(PRIOR, """
SELECT *, CAST(sum(n_times) OVER (PARTITION BY order_id) AS BIGINT) AS num_products_reordered FROM rl""", extra=reordered)
    # One Lee-Seung round at k = 2: H <- H * W'X / (W'W H + eps), then W <- W * XH' / (W HH' + eps).
    q["m_nmf_round"] = rounded(with_ctes(PRIOR, """
SELECT 'user' AS side, user_id AS id, f0, f1 FROM w1
UNION ALL SELECT 'product' AS side, CAST(product_id AS BIGINT) AS id, f0, f1 FROM h1""", extra=reordered + """,
x AS (SELECT user_id, product_id, CAST(n_times AS DOUBLE) AS cnt FROM rl),
w0 AS (SELECT user_id, CAST((user_id * 7) % 13 + 1 AS DOUBLE) / 10 AS f0, CAST((user_id * 5) % 11 + 1 AS DOUBLE) / 10 AS f1
       FROM (SELECT DISTINCT user_id FROM x)),
h0 AS (SELECT product_id, CAST((product_id * 3) % 17 + 1 AS DOUBLE) / 10 AS f0, CAST((product_id * 11) % 7 + 1 AS DOUBLE) / 10 AS f1
       FROM (SELECT DISTINCT product_id FROM x)),
gw AS (SELECT sum(f0 * f0) AS g00, sum(f0 * f1) AS g01, sum(f1 * f1) AS g11 FROM w0),
nh AS (SELECT product_id, sum(cnt * f0) AS n0, sum(cnt * f1) AS n1 FROM x JOIN w0 USING (user_id) GROUP BY 1),
h1 AS (SELECT product_id, f0 * n0 / (f0 * g00 + f1 * g01 + 1e-10) AS f0, f1 * n1 / (f0 * g01 + f1 * g11 + 1e-10) AS f1
       FROM h0 JOIN nh USING (product_id), gw),
gh AS (SELECT sum(f0 * f0) AS g00, sum(f0 * f1) AS g01, sum(f1 * f1) AS g11 FROM h1),
nw AS (SELECT user_id, sum(cnt * f0) AS n0, sum(cnt * f1) AS n1 FROM x JOIN h1 USING (product_id) GROUP BY 1),
w1 AS (SELECT user_id, f0 * n0 / (f0 * g00 + f1 * g01 + 1e-10) AS f0, f1 * n1 / (f0 * g01 + f1 * g11 + 1e-10) AS f1
       FROM w0 JOIN nw USING (user_id), gh)"""), ["f0", "f1"])
    # One sweep of coordinate descent at k = 2: first component, then the second at the new first; H, then W.
    sweep = lambda key, old, num, g: f"""SELECT {key}, f0, greatest(0.0, f1 + (n1 - (f0 * g01 + f1 * g11)) / g11) AS f1 FROM (
  SELECT {key}, greatest(0.0, f0 + (n0 - (f0 * g00 + f1 * g01)) / g00) AS f0, f1, n1, g01, g11 FROM {old} JOIN {num} USING ({key}), {g})"""  # noqa: E731
    q["m_nmf_sweep"] = q["m_nmf_round"]
    for name, key, old, num, g in (("h1", "product_id", "h0", "nh", "gw"), ("w1", "user_id", "w0", "nw", "gh")):
        text = q["m_nmf_sweep"]
        start = text.index(f"{name} AS (SELECT {key}, f0 * n0")
        end = text.index(f"{g})", start) + len(g) + 1
        q["m_nmf_sweep"] = text[:start] + f"{name} AS ({sweep(key, old, num, g)})" + text[end:]
    # Principal axes of two columns in closed form: (cov, lambda - var x), each made positive in its largest loading.
    q["m_formula_pca"] = rounded(with_ctes(VIEW, """
SELECT product_id, s1 * (dx * b + dy * (l1 - a)) / sqrt(b * b + (l1 - a) * (l1 - a)) AS vec1,
       s2 * (dx * b + dy * (l2 - a)) / sqrt(b * b + (l2 - a) * (l2 - a)) AS vec2
FROM (SELECT *, sign(CASE WHEN abs(b) >= abs(l1 - a) THEN b ELSE l1 - a END) AS s1,
             sign(CASE WHEN abs(b) >= abs(l2 - a) THEN b ELSE l2 - a END) AS s2 FROM eig),
     (SELECT product_id, x - avg(x) OVER () AS dx, y - avg(y) OVER () AS dy FROM v)""", extra="""
v AS (SELECT product_id, x, CAST((product_id * 11) % 53 AS DOUBLE) / 10 + x / 2 AS y
      FROM (SELECT product_id, CAST((product_id * 37) % 101 AS DOUBLE) / 10 AS x FROM r_products)),
cov AS (SELECT var_samp(x) AS a, var_samp(y) AS c, covar_samp(x, y) AS b FROM v),
eig AS (SELECT a, b, (a + c) / 2 + sqrt((a - c) * (a - c) / 4 + b * b) AS l1,
               (a + c) / 2 - sqrt((a - c) * (a - c) / 4 + b * b) AS l2 FROM cov)"""), ["vec1", "vec2"])
    # Keys that the learned results must cover, complete and in range.
    q["m_score_coverage"] = with_ctes(PRIOR + ["pairs", "cand"], """
SELECT c.order_id, c.product_id, CAST(2 AS BIGINT) AS n_scores, TRUE AS in_range
FROM cand c JOIN tgt t ON c.order_id = t.order_id WHERE t.eval_set = 'test'""")
    q["m_factor_coverage"] = with_ctes(PRIOR, "SELECT DISTINCT user_id, TRUE AS unit_row FROM rl", extra=reordered)
    q["m_vector_coverage"] = with_ctes(VIEW, """
SELECT p.product_id, coalesce(s.n >= 5, FALSE) AS has_vector
FROM r_products p LEFT JOIN (SELECT product_id, count(*) AS n FROM r_lines WHERE eval_set IN ('prior', 'train') GROUP BY 1) s
  ON s.product_id = p.product_id""")
    files = {"orders": ("r_orders", ["order_id", "user_id", "eval_set", "order_number", "order_dow", "order_hour_of_day", "days_since_prior_order"]),
             "prior": ("r_lines WHERE eval_set = 'prior'", ["order_id", "product_id", "add_to_cart_order", "reordered"]),
             "train": ("r_lines WHERE eval_set = 'train'", ["order_id", "product_id", "add_to_cart_order", "reordered"]),
             "products": ("r_products", ["product_id", "product_name", "aisle_id", "department_id"]),
             "aisles": ("(SELECT DISTINCT aisle_id, 'aisle ' || aisle_id AS aisle FROM r_products)", ["aisle_id", "aisle"]),
             "departments": ("(SELECT DISTINCT department_id, 'department ' || department_id AS department FROM r_products)", ["department_id", "department"])}
    fields = "\nUNION ALL ".join(f"SELECT '{name}' AS file, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS v FROM {table}"
                                 for name, (table, columns) in files.items() for c in columns)
    q["s_csv_inferred"] = with_ctes(VIEW, f"""SELECT file, "column", CASE WHEN bool_and(regexp_full_match(v, '-?[0-9]+')) THEN
    CASE WHEN max(abs(TRY_CAST(v AS BIGINT))) < 2147483648 THEN 'int' ELSE 'bigint' END
    WHEN bool_and(regexp_full_match(v, '-?[0-9]+[.][0-9]+')) THEN 'double' ELSE 'string' END AS type,
  count(v) AS n_values, count(*) - count(v) AS n_nulls FROM ({fields}) GROUP BY 1, 2""")
    q["s_csv_history"] = with_ctes(VIEW, """
SELECT order_id, product_id, add_to_cart_order, reordered, eval_set, user_id, order_number FROM r_lines WHERE eval_set <> 'test'""")
    q["a_incremental_gaps"] = q["a_product_gaps"]
    q["a_sketched_users"] = with_ctes(PRIOR, "SELECT product_id, count(DISTINCT user_id) AS n_users, TRUE AS within_error FROM prior_l GROUP BY 1")
    q["s_snapshots"] = with_ctes(VIEW, """
SELECT version, eval_set, count(*) AS n_orders, CAST(sum(CASE WHEN version = 2 AND eval_set = 'train' THEN -order_number ELSE order_number END) AS BIGINT) AS sum_number
FROM r_orders, (VALUES (1), (2)) v(version) GROUP BY 1, 2""")
    q["m_ppmi"] = rounded(with_ctes(VIEW, """
SELECT c.a, c.b, c.n, ln(c.n * CAST(t.n AS DOUBLE) / (CAST(x.n AS DOUBLE) * CAST(y.n AS DOUBLE))) AS value
FROM c JOIN marg x ON x.a = c.a JOIN marg y ON y.a = c.b, (SELECT sum(n) AS n FROM c) t
WHERE ln(c.n * CAST(t.n AS DOUBLE) / (CAST(x.n AS DOUBLE) * CAST(y.n AS DOUBLE))) > 0""", extra="""
known AS (SELECT product_id FROM r_lines WHERE eval_set IN ('prior', 'train') GROUP BY 1 HAVING count(*) >= 5),
seen AS (SELECT order_id, product_id, add_to_cart_order AS place FROM r_lines WHERE eval_set IN ('prior', 'train') AND product_id IN (FROM known)),
c AS (SELECT l.product_id AS a, r.product_id AS b, count(*) AS n FROM seen l JOIN seen r
  ON l.order_id = r.order_id AND l.place <> r.place AND abs(l.place - r.place) <= 5 GROUP BY 1, 2),
marg AS (SELECT a, sum(n) AS n FROM c GROUP BY 1)"""), ["value"])
    q["u_basket_sentences"] = with_ctes(VIEW, """
SELECT order_id, string_agg(CAST(product_id AS VARCHAR), ' ' ORDER BY add_to_cart_order) AS sentence, count(*) AS n_tokens
FROM r_lines WHERE eval_set IN ('prior', 'train') GROUP BY 1""")
    q["b_repeat_last_order"] = with_ctes(BASELINE + ["b1"], "SELECT order_id, products FROM b1")
    q["b_top_k_products"] = with_ctes(BASELINE + ["b2"], "SELECT order_id, products FROM b2")
    truth_train = with_ctes(VIEW + ["train_l", "truth_train"], "SELECT order_id, products FROM truth_train")
    q["e_ground_truth"] = truth_train
    q["s_csv_sink_roundtrip"] = truth_train
    q["m_blend_scores"] = rounded(with_ctes(PRIOR + ["pairs", "cand", "blend"],
                                            "SELECT order_id, product_id, prediction FROM blend"), ["prediction"])
    q["s_prediction_store"] = with_ctes(PRIOR + ["pairs", "cand", "blend"], """
SELECT order_id, product_id, prediction, 'a' AS model FROM score_a
UNION ALL SELECT order_id, product_id, prediction, 'b' AS model FROM score_b""")
    # AUC as the rank statistic: ties count half.
    q["m_formula_metrics"] = rounded(with_ctes(PRIOR + ["train_l", "pairs", "cand", "blend"], """
SELECT (sum(rk) FILTER (WHERE y = 1) - (count(*) FILTER (WHERE y = 1)) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
         / ((count(*) FILTER (WHERE y = 1)) * (count(*) FILTER (WHERE y = 0))) AS auc,
       avg(CASE WHEN y = 1 THEN -ln(least(greatest(p, 1e-15), 1 - 1e-15)) ELSE -ln(1 - least(greatest(p, 1e-15), 1 - 1e-15)) END) AS logloss
FROM (SELECT y, p, (rank() OVER (ORDER BY p) + count(*) OVER (ORDER BY p) ) / 2.0 AS rk FROM scored)""", extra="""scored AS (
  SELECT s.prediction AS p, CASE WHEN l.product_id IS NULL THEN 0 ELSE 1 END AS y
  FROM score_a s JOIN r_orders o ON s.order_id = o.order_id AND o.eval_set = 'train'
  LEFT JOIN (SELECT DISTINCT order_id, product_id FROM train_l) l ON l.order_id = s.order_id AND l.product_id = s.product_id)"""),
        ["auc", "logloss"])
    f = [f"CAST((user_id * {j + 3}) % 7 AS DOUBLE)" for j in range(4)]
    norm = "sqrt(" + " + ".join(f"{x} * {x}" for x in f) + ")"
    q["m_normalised_rows"] = rounded(with_ctes(VIEW, "SELECT user_id, " + ", ".join(
        f"coalesce({x} / nullif({norm}, 0), 0.0) AS f{j}" for j, x in enumerate(f))
        + " FROM (SELECT DISTINCT user_id FROM r_orders)"), ["f0", "f1", "f2", "f3"])
    q["e_select_f1"] = rounded(with_ctes(PRIOR + ["pairs", "cand", "blend", "select_f1"], """
SELECT b.order_id,
       concat_ws(' ', CASE WHEN b.flag = 0 THEN 'None' END,
                 (SELECT string_agg(CAST(r.product_id AS VARCHAR), ' ' ORDER BY r.i)
                  FROM ranked r WHERE r.order_id = b.order_id AND r.i <= b.k)) AS products,
       CAST(b.k AS INTEGER) AS best_k, b.flag = 0 AS pred_none, b.val AS expected_f1
FROM best b"""), ["expected_f1"])
    q["f_feature_matrix"] = rounded(with_ctes(
        USERS + ["train_l", "orders_da", "orders_ratio", "lines_da", "gaps", "freq", "prod_f", "up_f", "intervals",
                 "streak"], """
SELECT t.order_id, up.user_id, up.product_id, t.eval_set,
       CASE WHEN lb.user_id IS NULL THEN 0 ELSE 1 END AS label,
       u.user_total_orders, u.user_total_items, u.total_distinct_items, u.user_average_days_between_orders,
       u.user_average_basket, u.user_median_basket, u.user_reorder_ratio, u.user_period, u.user_nb_aisles,
       u.user_nb_departments,
       t.order_hour_of_day, t.days_since_prior_order, t.days_since_ratio,
       p.aisle_id, p.department_id, p.product_orders, p.product_reorders, p.product_reorder_rate,
       p.product_reorder_probability, p.product_nb_users, p.product_mean_add_to_cart_position,
       p.prod_buy_second_time_total_cnt, f.frequency_mean, f.frequency_std,
       up.UP_orders,
       CAST(up.UP_orders AS DOUBLE) / nullif(CAST(u.user_total_orders AS DOUBLE), 0) AS UP_orders_ratio,
       CAST(up.UP_sum_pos_in_cart AS DOUBLE) / nullif(CAST(up.UP_orders AS DOUBLE), 0) AS UP_average_pos_in_cart,
       u.user_total_orders - up.UP_last_order AS UP_orders_since_last,
       least(abs(t.order_hour_of_day - up.UP_last_order_hour), 24 - abs(t.order_hour_of_day - up.UP_last_order_hour))
         AS UP_delta_hour_vs_last,
       up.UP_first_order, up.UP_last_order, up.UP_order_rate_since_first_order,
       up.UP_recency, up.UP_recency_day, up.UP_recency_exp,
       iv.UP_interval_distance, iv.UP_interval_mean, iv.UP_interval_std, iv.UP_order_number_skew,
       sk.UP_order_streak
FROM up_f up
JOIN orders_ratio t ON t.user_id = up.user_id AND t.eval_set <> 'prior'
JOIN users_f u ON u.user_id = up.user_id
LEFT JOIN prod_f p ON p.product_id = up.product_id
LEFT JOIN freq f ON f.product_id = up.product_id
LEFT JOIN intervals iv ON iv.user_id = up.user_id AND iv.product_id = up.product_id
LEFT JOIN streak sk ON sk.user_id = up.user_id AND sk.product_id = up.product_id
LEFT JOIN (SELECT DISTINCT user_id, product_id FROM train_l) lb
       ON lb.user_id = up.user_id AND lb.product_id = up.product_id"""),
        ["user_average_days_between_orders", "user_average_basket", "user_median_basket", "user_reorder_ratio",
         "user_period", "days_since_prior_order", "days_since_ratio", "product_reorder_rate",
         "product_reorder_probability", "product_mean_add_to_cart_position", "frequency_mean", "frequency_std",
         "UP_orders_ratio", "UP_average_pos_in_cart", "UP_order_rate_since_first_order", "UP_recency",
         "UP_recency_day", "UP_recency_exp", "UP_interval_distance", "UP_interval_mean", "UP_interval_std",
         "UP_order_number_skew"])
    q["e_mean_f1"] = rounded(with_ctes(
        BASELINE + ["b1", "b2", "test_l", "truth_test"],
        f1_body("b1", "truth_test", "repeat_last_order") + "\nUNION ALL\n"
        + f1_body("b2", "truth_test", "top_k_products")), ["mean_f1"])
    return q


ORACLE_SQL = _q()


def _tree_parts() -> dict[str, str]:
    from basketflow.operators.matrix import RELATIONAL_COLUMNS
    from basketflow.plans import oracle_trees as ot
    metrics = rounded(with_ctes(PRIOR + ["train_l", "pairs", "cand", "blend"], ot.MARGIN_METRICS, extra=ot.MARGIN_SCORED), ["auc", "logloss"])
    return {**ot.tree_sql(ORACLE_SQL["f_feature_matrix"], RELATIONAL_COLUMNS, trees=6, depth=3), "m_margin_metrics": metrics}


ORACLE_SQL.update(_tree_parts())

"""SQL of the booster's parts: bins, the first tree's upper splits, the walk of a node table, AUC and log-loss.

Written from the definitions: values instead of bytes, one row per (row, feature), plain windows.
"""

from __future__ import annotations

# Fixed values, as in the trainer: bins, categorical features, fixed-point unit, penalties, least hessian and rows, rate.
FEATURES_CAT = "('aisle_id', 'department_id')"
UNIT = "1048576.0"


def _long(matrix: str, features: list[str], where: str) -> str:
    """CTEs m (one row per candidate, rid) and long (rid, feature, v)."""
    columns = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in features)
    return f"""m AS MATERIALIZED (SELECT row_number() OVER () AS rid, order_id, product_id, label, {columns} FROM ({matrix}) WHERE {where}),
long AS MATERIALIZED (SELECT rid, feature, v FROM (SELECT * EXCLUDE (order_id, product_id, label) FROM m)
  UNPIVOT INCLUDE NULLS (v FOR feature IN ({", ".join(features)})))"""


BINS = f"""counts AS (SELECT feature, v, count(*) AS n FROM long WHERE v IS NOT NULL GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER f AS rnk, count(*) OVER (PARTITION BY feature) AS d,
    coalesce(sum(n) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below, sum(n) OVER (PARTITION BY feature) AS total,
    row_number() OVER (PARTITION BY feature ORDER BY n DESC, v) AS by_count FROM counts WINDOW f AS (PARTITION BY feature ORDER BY v)),
cuts AS (SELECT feature, v, CASE WHEN feature IN {FEATURES_CAT} THEN by_count WHEN d <= 255 THEN rnk ELSE floor(below * 255 / total) END AS cut
  FROM ranked WHERE feature NOT IN {FEATURES_CAT} OR by_count <= 255),
binned AS MATERIALIZED (SELECT feature, v, dense_rank() OVER (PARTITION BY feature ORDER BY cut) AS bin FROM cuts),
spans AS (SELECT feature, bin, min(v) AS low, max(v) AS high FROM binned GROUP BY 1, 2)"""


def _level(k: int) -> str:
    """Splits of the nodes of level k (table rows{k}: rid, node) and the rows of the next level."""
    score = lambda g, h: f"pow(greatest(abs({g} / {UNIT}) - 1.0, 0.0), 2) / ({h} / {UNIT} + l2)"
    return f"""sums{k} AS (SELECT node, feature, bin, sum(g) AS g, sum(h) AS h, count(*) AS n FROM rows{k} JOIN code USING (rid) JOIN gh USING (rid) GROUP BY 1, 2, 3),
placed{k} AS (SELECT *, feature IN {FEATURES_CAT} AS cat, CASE WHEN feature IN {FEATURES_CAT} THEN 20.0 ELSE 10.0 END AS l2,
    sum(g) OVER w AS ga, sum(h) OVER w AS ha, sum(n) OVER w AS na,
    coalesce(sum(g) FILTER (bin = 0) OVER w, 0) AS g0, coalesce(sum(h) FILTER (bin = 0) OVER w, 0) AS h0, coalesce(sum(n) FILTER (bin = 0) OVER w, 0) AS n0,
    CASE WHEN feature IN {FEATURES_CAT} THEN (g / {UNIT}) / (h / {UNIT} + 10.0) ELSE bin END AS o
  FROM sums{k} WINDOW w AS (PARTITION BY node, feature)),
prefix{k} AS (SELECT *, sum(g) OVER p AS gl, sum(h) OVER p AS hl, sum(n) OVER p AS nl, row_number() OVER (PARTITION BY node, feature ORDER BY o, bin) AS place
  FROM placed{k} WHERE bin > 0 WINDOW p AS (PARTITION BY node, feature ORDER BY o, bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
sides{k} AS (SELECT node, feature, bin, place, cat, side, l2, ga, ha, na, gl + side * g0 AS gl, hl + side * h0 AS hl, nl + side * n0 AS nl
  FROM prefix{k}, (VALUES (0), (1)) s(side)),
gains{k} AS (SELECT *, {score("gl", "hl")} + {score("(ga - gl)", "(ha - hl)")} - {score("ga", "ha")} AS gain FROM sides{k}
  WHERE least(hl, ha - hl) >= 20 * {UNIT} AND least(nl, na - nl) >= 20),
split{k} AS MATERIALIZED (SELECT g.* FROM gains{k} g JOIN f USING (feature) WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f.i, CASE WHEN cat THEN place ELSE bin END, side) = 1),
left{k} AS (SELECT s.node, s.feature, p.bin FROM split{k} s JOIN prefix{k} p ON p.node = s.node AND p.feature = s.feature AND p.place <= s.place
  UNION ALL SELECT node, feature, 0 FROM split{k} WHERE side = 1),
rows{k + 1} AS MATERIALIZED (SELECT r.rid, 2 * r.node + CASE WHEN l.bin IS NULL THEN 1 ELSE 0 END AS node
  FROM rows{k} r JOIN split{k} s USING (node) JOIN code c ON c.rid = r.rid AND c.feature = s.feature
  LEFT JOIN left{k} l ON l.node = r.node AND l.bin = c.bin)"""


def tree_sql(matrix: str, features: list[str], trees: int, depth: int) -> dict[str, str]:
    """The texts, given the SQL of the rounded feature matrix."""
    q = {}
    q["m_feature_bins"] = f"""WITH {_long(matrix, features, "eval_set = 'train'")},
{BINS}
SELECT feature, bin, round(low, 6) AS low, round(high, 6) AS high FROM spans"""

    values = ", ".join(f"('{f}', {i})" for i, f in enumerate(features))
    q["m_first_splits"] = f"""WITH {_long(matrix, features, "eval_set = 'train'")},
{BINS},
f(feature, i) AS (VALUES {values}),
code AS MATERIALIZED (SELECT rid, feature, coalesce(bin, 0) AS bin FROM long LEFT JOIN binned USING (feature, v)),
share AS (SELECT avg(label) AS s FROM m),
gh AS MATERIALIZED (SELECT rid, round((p - label) * {UNIT})::BIGINT AS g, greatest(round(p * (1 - p) * {UNIT}), 1)::BIGINT AS h
  FROM m, (SELECT 1.0 / (1.0 + exp(-ln(s / (1 - s)))) AS p FROM share)),
rows0 AS MATERIALIZED (SELECT rid, 1 AS node FROM m),
{_level(0)},
{_level(1)},
rows_all AS (SELECT * FROM rows0 UNION ALL SELECT * FROM rows1 UNION ALL SELECT * FROM rows2),
stats AS (SELECT node, sum(g) / {UNIT} AS g, sum(h) / {UNIT} AS h, count(*) AS n FROM rows_all JOIN gh USING (rid) GROUP BY 1),
splits AS (SELECT * FROM split0 UNION ALL SELECT * FROM split1),
lefts AS (SELECT * FROM left0 UNION ALL SELECT * FROM left1),
cats AS (SELECT node, string_agg(CAST(CAST(low AS INTEGER) AS VARCHAR), ',' ORDER BY low) AS categories
  FROM lefts JOIN spans USING (feature, bin) WHERE feature IN {FEATURES_CAT} GROUP BY 1)
SELECT CAST(stats.node AS BIGINT) AS node, s.feature, CASE WHEN NOT cat THEN round((a.high + b.low) / 2, 6) END AS threshold, c.categories,
  s.side = 1 AS missing_left, round(s.gain, 6) AS gain,
  CASE WHEN s.node IS NULL THEN round(-sign(stats.g) * greatest(abs(stats.g) - 1.0, 0.0) / (stats.h + 10.0) * 0.05, 6) END AS value,
  round(stats.h, 6) AS hessian, stats.n AS n_rows
FROM stats LEFT JOIN splits s ON s.node = stats.node LEFT JOIN cats c ON c.node = stats.node
LEFT JOIN spans a ON a.feature = s.feature AND a.bin = s.bin LEFT JOIN spans b ON b.feature = s.feature AND b.bin = s.bin + 1"""

    inner, last = 2 ** depth, 2 ** (depth + 1)
    names = "[" + ", ".join(f"'{f}'" for f in features) + "]"
    q["m_tree_walk"] = f"""WITH RECURSIVE {_long(matrix, features, "TRUE")},
nodes AS (SELECT t, n, t = {trees - 1} AND n = 1 AS by_category,
    CASE WHEN n >= {inner} THEN NULL WHEN t = {trees - 1} AND n = 1 THEN 'aisle_id' ELSE {names}[(t * 7 + n * 3) % {len(features)} + 1] END AS feature,
    ((t * 13 + n * 5) % 17) / 2.0 AS threshold, (t + n) % 2 = 0 AND NOT (t = {trees - 1} AND n = 1) AS missing_left, ((t * 31 + n * 17) % 101 - 50) / 100.0 AS value
  FROM range(0, {trees}) a(t), range(1, {last}) b(n)),
walk(rid, t, n) AS (
  SELECT rid, t, CAST(1 AS BIGINT) FROM m, range(0, {trees}) a(t)
  UNION ALL
  SELECT w.rid, w.t, 2 * w.n + CASE WHEN CASE WHEN v IS NULL THEN missing_left WHEN by_category THEN v BETWEEN 11 AND 59 AND (v - 11) % 3 = 0 ELSE v <= threshold END THEN 0 ELSE 1 END
  FROM walk w JOIN nodes ON nodes.t = w.t AND nodes.n = w.n JOIN long ON long.rid = w.rid AND long.feature = nodes.feature)
SELECT order_id, product_id, round(1.0 / (1.0 + exp(-(-0.25 + total))), 6) AS prediction
FROM m JOIN (SELECT rid, sum(CAST(value AS DOUBLE)) AS total FROM walk JOIN nodes USING (t, n) WHERE feature IS NULL GROUP BY 1) USING (rid)"""
    return q


MARGIN_METRICS = """SELECT model, (sum(rk) FILTER (WHERE y = 1) - (count(*) FILTER (WHERE y = 1)) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
         / ((count(*) FILTER (WHERE y = 1)) * (count(*) FILTER (WHERE y = 0))) AS auc,
       avg(CASE WHEN y = 1 THEN -ln(p) ELSE -ln(1 - p) END) AS logloss
FROM (SELECT model, y, p, (rank() OVER (PARTITION BY model ORDER BY p) + count(*) OVER (PARTITION BY model ORDER BY p)) / 2.0 AS rk FROM scored) GROUP BY 1"""

MARGIN_SCORED = """both_scores AS (SELECT *, 'a' AS model FROM score_a UNION ALL SELECT *, 'b' AS model FROM score_b),
scored AS (SELECT s.model, 1.0 / (1.0 + exp(-(round((s.prediction - 0.5) * 40) / 4))) AS p, CASE WHEN l.product_id IS NULL THEN 0 ELSE 1 END AS y
  FROM both_scores s JOIN r_orders o ON s.order_id = o.order_id AND o.eval_set = 'train'
  LEFT JOIN (SELECT DISTINCT order_id, product_id FROM train_l) l ON l.order_id = s.order_id AND l.product_id = s.product_id)"""

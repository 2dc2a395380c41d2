"""SQL that repeats the fits of the churn models: the same equations, iterated by recursive queries.

Sums are over whole numbers and draws come from hashes, so both engines grow the same trees.
"""

from shoplens.operators.churn_features import FEATURES
from shoplens.operators.churn_models import (
    BOOST_DEPTH, BOOST_ROUNDS, BOOST_STEP, FOREST_DEPTH, FOREST_TREES, SEED,
)
from shoplens.operators.clustering import CLUSTERS, K_RANGE, RESTARTS
from shoplens.operators.clustering import SEED as KMEANS_SEED
from shoplens.operators.kmeans import GOLDEN as KMEANS_GOLDEN
from shoplens.operators.kmeans import STEPS as KMEANS_STEPS
from shoplens.operators.kmeans import STRIDE
from shoplens.operators.kmeans import TOLERANCE as KMEANS_TOLERANCE
from shoplens.operators.kmeans import UNIT as KMEANS_UNIT
from shoplens.operators.trees import BINS, LIMITS, MASK, UNIT

WIDTH = len(FEATURES)
VALUES = "[" + ", ".join(f"{c}::DOUBLE" for c in FEATURES) + "]"


def rows_cte(train: str, scored: str) -> str:
    """model_rows: (id, y, part, bins) with part 0 for training rows and 1 for rows to score; the bins of all
    features stand in one number, six bits each. ``train``: (CustomerID, Churned, features)."""
    return f"""model_train AS MATERIALIZED (SELECT CustomerID AS id, Churned AS y, {VALUES} AS x FROM {train}),
model_scored AS MATERIALIZED (SELECT CustomerID AS id, {VALUES} AS x FROM {scored}),
placed AS (
  SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) - 1 AS pos, count(*) OVER (PARTITION BY f) AS n
  FROM (SELECT unnest(range({WIDTH})) AS f, unnest(x) AS v FROM model_train)),
cuts AS MATERIALIZED (
  SELECT f, list(DISTINCT v) AS c FROM placed, range(1, {BINS}) AS k(k) WHERE pos = (k * n + {BINS - 1}) // {BINS} - 1 GROUP BY f),
model_rows AS MATERIALIZED (
  SELECT id, y, part, sum((len(list_filter(c, lambda e : e < v)))::BIGINT << (6 * f))::BIGINT AS bins
  FROM (SELECT id, y, 0 AS part, unnest(range({WIDTH})) AS f, unnest(x) AS v FROM model_train
        UNION ALL SELECT id, 0, 1, unnest(range({WIDTH})), unnest(x) FROM model_scored) JOIN cuts USING (f)
  GROUP BY id, y, part)"""


def boost_cte(rounds: int = BOOST_ROUNDS, depth: int = BOOST_DEPTH) -> str:
    """boosted: the rows of model_rows after all rounds, and the splits. A step of the recursion is one level of
    one tree; at ``depth`` the leaves are added to the margins."""
    return f"""boost_weight AS MATERIALIZED (
  SELECT count(*) FILTER (y = 0)::DOUBLE / count(*) FILTER (y = 1) AS positive FROM model_rows WHERE part = 0),
boosted(kind, id, y, part, bins, margin, node, level, round, gain) AS (
  SELECT 0, id, y, part, bins, 0::DOUBLE, 1, 0, 0, 0::DOUBLE FROM model_rows
  UNION ALL (
    WITH own AS (SELECT * FROM boosted WHERE kind = 0 AND round < {rounds}),
    stepped AS (
      SELECT node, level, bins, floor(w * (p - y) * {UNIT} + 0.5)::BIGINT AS g, floor(w * (p * (1 - p)) * {UNIT} + 0.5)::BIGINT AS h
      FROM (SELECT *, CASE WHEN y = 1 THEN positive ELSE 1::DOUBLE END AS w, 1 / (1 + exp(-margin)) AS p
            FROM own, boost_weight WHERE part = 0)),
    cells AS (
      SELECT node, f, (bins >> (6 * f)) & 63 AS bin, sum(g) AS g, sum(h) AS h
      FROM stepped, range({WIDTH}) AS r(f) WHERE level < {depth} AND node >= (1 << level) GROUP BY ALL),
    lefts AS (
      SELECT node, f, bin, (sum(g) OVER o)::DOUBLE / {UNIT} AS g, (sum(h) OVER o)::DOUBLE / {UNIT} AS h,
        (sum(g) OVER (PARTITION BY node, f))::DOUBLE / {UNIT} AS ag, (sum(h) OVER (PARTITION BY node, f))::DOUBLE / {UNIT} AS ah
      FROM cells WINDOW o AS (PARTITION BY node, f ORDER BY bin)),
    gains AS (
      SELECT node, f, bin, g * g / (h + 1) + (ag - g) * (ag - g) / (ah - h + 1) - ag * ag / (ah + 1) AS gain
      FROM lefts WHERE h >= 1 AND ah - h >= 1),
    splits AS (
      SELECT node, max((gain, -f, -bin)) AS best FROM gains WHERE gain > 1e-6 GROUP BY node),
    leaves AS (
      SELECT node, (-{BOOST_STEP}::DOUBLE * (sum(g)::DOUBLE / {UNIT})) / (sum(h)::DOUBLE / {UNIT} + 1) AS leaf
      FROM stepped WHERE level = {depth} GROUP BY node)
    SELECT 0, id, y, part, bins,
      CASE WHEN level = {depth} THEN margin + leaf ELSE margin END,
      CASE WHEN level = {depth} THEN 1 WHEN best IS NULL THEN own.node
        ELSE 2 * own.node + (((bins >> (6 * -best[2])::INT) & 63) > -best[3])::INT END,
      CASE WHEN level = {depth} THEN 0 ELSE level + 1 END,
      CASE WHEN level = {depth} THEN round + 1 ELSE round END, 0
    FROM own LEFT JOIN splits ON own.node = splits.node LEFT JOIN leaves ON own.node = leaves.node
    UNION ALL
    SELECT 1, 0, 0, 0, -best[2], 0, node, 0, 0, best[1] FROM splits))"""


BOOSTED_SCORE = "1 / (1 + exp(-margin))"
BOOSTED_ROWS = f"(SELECT * FROM boosted WHERE kind = 0 AND round = {BOOST_ROUNDS} AND level = 0 AND part = 1)"


def mixed(x: str) -> str:
    """The 32-bit mixing of a whole number."""
    out = f"[({x}) & {MASK}]"
    for _ in range(2):
        out = f"list_transform({out}, lambda v : (xor(v, v >> 16) * {0x45D9F3B}) & {MASK})"
    return f"list_transform({out}, lambda v : xor(v, v >> 16))[1]"


GOLDEN = 0x9E3779B1


def forest_cte(trees: int = FOREST_TREES, depth: int = FOREST_DEPTH, seed: int = SEED) -> str:
    """forest_scores: (id, p) of the rows to score. A step of the recursion is one level of all trees."""
    limits = "[" + ", ".join(str(int(v)) for v in LIMITS) + "]"
    return f"""class_weight AS MATERIALIZED (
  SELECT count(*)::DOUBLE / (2 * count(*) FILTER (y = 0)) AS w0, count(*)::DOUBLE / (2 * count(*) FILTER (y = 1)) AS w1
  FROM model_rows WHERE part = 0),
drawn AS MATERIALIZED (
  SELECT tree, id, y, part, bins, CASE WHEN part = 1 THEN 0 ELSE
    len(list_filter({limits}::BIGINT[], lambda e : e <= {mixed(f"own + ((tree * {GOLDEN}) & {MASK})")})) END AS times
  FROM (SELECT *, {mixed(f"xor(id, id >> 32) + {seed}")} AS own FROM model_rows), range({trees}) AS t(tree)),
forest(tree, id, y, part, bins, times, node, level) AS (
  SELECT tree, id, y, part, bins, times, 1, 0 FROM drawn WHERE part = 1 OR times > 0
  UNION ALL (
    WITH own AS (SELECT * FROM forest WHERE level < {depth}),
    cells AS (
      SELECT tree, node, f, (bins >> (6 * f)) & 63 AS bin, sum(times) FILTER (y = 0) AS zero, sum(times) FILTER (y = 1) AS one
      FROM own, range({WIDTH}) AS r(f) WHERE part = 0 AND node >= (1 << level) GROUP BY ALL),
    lefts AS (
      SELECT tree, node, f, bin, coalesce(sum(zero) OVER o, 0) AS l0, coalesce(sum(one) OVER o, 0) AS l1,
        coalesce(sum(zero) OVER a, 0) AS a0, coalesce(sum(one) OVER a, 0) AS a1
      FROM cells WINDOW o AS (PARTITION BY tree, node, f ORDER BY bin), a AS (PARTITION BY tree, node, f)),
    valued AS (
      SELECT tree, node, f, bin,
        (l0 * w0 * (l0 * w0) + l1 * w1 * (l1 * w1)) / (l0 * w0 + l1 * w1)
        + ((a0 - l0) * w0 * ((a0 - l0) * w0) + (a1 - l1) * w1 * ((a1 - l1) * w1)) / ((a0 - l0) * w0 + (a1 - l1) * w1) AS val
      FROM lefts, class_weight WHERE a0 > 0 AND a1 > 0 AND a0 + a1 > l0 + l1),
    looked AS (
      SELECT tree, node, f, row_number() OVER (PARTITION BY tree, node ORDER BY draw, f) AS place FROM (
        SELECT tree, node, f, {mixed(f"{mixed(f'((tree * {GOLDEN} + {seed + 1}) & {MASK}) + node')} + f * {0x85EBCA6B}")} AS draw
        FROM (SELECT DISTINCT tree, node, f FROM valued))),
    splits AS (
      SELECT tree, node, max((val, -place, -bin, f)) AS best FROM valued JOIN looked USING (tree, node, f)
      WHERE place <= {max(int(WIDTH**0.5), 1)} GROUP BY tree, node)
    SELECT own.tree, id, y, part, bins, times, CASE WHEN best IS NULL THEN own.node
      ELSE 2 * own.node + (((bins >> (6 * best[4])::INT) & 63) > -best[3])::INT END, level + 1
    FROM own LEFT JOIN splits ON own.tree = splits.tree AND own.node = splits.node)),
forest_leaves AS (
  SELECT tree, node, coalesce(sum(times) FILTER (y = 1), 0) * any_value(w1)
    / (coalesce(sum(times) FILTER (y = 0), 0) * any_value(w0) + coalesce(sum(times) FILTER (y = 1), 0) * any_value(w1)) AS share
  FROM forest, class_weight WHERE level = {depth} AND part = 0 GROUP BY tree, node),
forest_scores AS (
  SELECT id, sum(share) / {trees} AS p FROM forest JOIN forest_leaves USING (tree, node) WHERE level = {depth} AND part = 1 GROUP BY id)"""


# ---- logistic regression ---------------------------------------------------------------------------


def logistic_cte(train: str, steps: int = 25) -> str:
    """logistic_fit: one row with ``beta`` (the constant last) and the scaler. Newton steps; each solves its
    equations by elimination, which needs no pivots since the matrix is positive definite."""
    size = WIDTH + 1
    means = ", ".join(f"avg({c}::DOUBLE)" for c in FEATURES)
    spreads = ", ".join(f"coalesce(nullif(stddev_pop({c}::DOUBLE), 0), 1)" for c in FEATURES)
    solved = "SELECT step, beta, m AS m0 FROM system"
    for k in range(1, size + 1):
        solved = f"""SELECT step, beta, list_transform(m{k - 1}, lambda r, i : CASE WHEN i = {k}
            THEN list_transform(r, lambda v : v / m{k - 1}[{k}][{k}])
            ELSE list_transform(r, lambda v, j : v - r[{k}] / m{k - 1}[{k}][{k}] * m{k - 1}[{k}][j]) END) AS m{k} FROM ({solved})"""
    return f"""scales AS MATERIALIZED (
  SELECT [{means}] AS mean, [{spreads}] AS spread, count(*)::DOUBLE / (2 * count(*) FILTER (Churned = 0)) AS w0,
    count(*)::DOUBLE / (2 * count(*) FILTER (Churned = 1)) AS w1 FROM {train}),
points AS MATERIALIZED (
  SELECT Churned AS y, CASE WHEN Churned = 1 THEN w1 ELSE w0 END AS w,
    list_append(list_transform({VALUES}, lambda v, i : (v - mean[i]) / spread[i]), 1::DOUBLE) AS x FROM {train}, scales),
newton(step, beta) AS (
  SELECT 0, list_transform(range({size}), lambda i : 0::DOUBLE)
  UNION ALL (
    WITH here AS (
      SELECT step, beta, x, w, y, 1 / (1 + exp(-list_dot_product(x, beta))) AS p
      FROM newton, points WHERE step < {steps}),
    cells AS (
      SELECT step, beta, i, j, sum(CASE WHEN j > {size} THEN -w * (p - y) * x[i] ELSE w * p * (1 - p) * x[i] * x[j] END)
        + CASE WHEN i = {size} THEN 0 WHEN i = j THEN 1 WHEN j > {size} THEN -beta[i] ELSE 0 END AS v
      FROM here, range(1, {size + 1}) AS a(i), range(1, {size + 2}) AS b(j) GROUP BY step, beta, i, j),
    lines AS (SELECT step, beta, i, list(v ORDER BY j) AS r FROM cells GROUP BY step, beta, i),
    system AS (SELECT step, beta, list(r ORDER BY i) AS m FROM lines GROUP BY step, beta)
    SELECT step + 1, list_transform(beta, lambda b, i : b + m{size}[i][{size + 1}]) FROM ({solved}))),
logistic_fit AS MATERIALIZED (SELECT beta, mean, spread FROM newton, scales WHERE step = {steps})"""


LOGISTIC_SCORE = f"""1 / (1 + exp(-list_dot_product(
  list_append(list_transform({VALUES}, lambda v, i : (v - mean[i]) / spread[i]), 1::DOUBLE), beta)))"""


# ---- k-means ---------------------------------------------------------------------------------------


def kmeans_cte(ks: range, restarts: int = RESTARTS, seed: int = KMEANS_SEED) -> str:
    """best_centers: (k, Cluster, c, cost), the centers of the best restart of each k, c a list. Two recursions:
    the races for the starts, then the Lloyd steps of all fits that move."""
    def square(x: str, c: str) -> str:
        parts = [f"({x}[{d}] - {c}[{d}]) * ({x}[{d}] - {c}[{d}])" for d in (1, 2, 3)]
        return f"({parts[0]} + {parts[1]} + {parts[2]})"

    race = mixed(f"own + ((r * {KMEANS_GOLDEN} + step * {STRIDE}) & {MASK})")
    return f"""unit_points AS MATERIALIZED (
  SELECT *, list_transform(q, lambda v : v::DOUBLE / {KMEANS_UNIT}) AS x, {mixed(f"xor(CustomerID, CustomerID >> 32) + {seed}")} AS own
  FROM (SELECT CustomerID, list_transform([Recency, Frequency, Monetary], lambda v : floor(v * {KMEANS_UNIT} + 0.5)::BIGINT) AS q FROM scaled)),
races(r, step, centers) AS (
  SELECT range, 0, []::DOUBLE[][] FROM range({restarts})
  UNION ALL (
    WITH weighed AS (
      SELECT r, step, centers, CustomerID, own, x, CASE WHEN step = 0 THEN 1::DOUBLE
        ELSE list_min(list_transform(centers, lambda c : {square("x", "c")})) END AS weight
      FROM races, unit_points WHERE step < {max(ks)}),
    run AS (
      SELECT r, step, centers, x, weight, CustomerID, -ln(({race}::DOUBLE + 0.5) / 4294967296) / weight AS race
      FROM weighed WHERE weight > 0)
    SELECT r, any_value(step) + 1, list_append(any_value(centers), arg_min(x, (race, CustomerID))) FROM run GROUP BY r)),
lloyd(k, r, j, c, step, moved) AS (
  SELECT k, r, j, centers[j], 0, 1::DOUBLE FROM races, range({min(ks)}, {max(ks) + 1}) AS a(k), range(1, {max(ks) + 1}) AS b(j)
  WHERE races.step = {max(ks)} AND j <= k
  UNION ALL (
    WITH moving AS (SELECT * FROM lloyd WHERE moved > {KMEANS_TOLERANCE} AND step < {KMEANS_STEPS}),
    near AS (
      SELECT k, r, q, min(({square("x", "c")}, j))[2] AS j FROM moving, unit_points GROUP BY k, r, CustomerID, q),
    sums AS (
      SELECT k, r, j, count(*) AS n, [sum(q[1]), sum(q[2]), sum(q[3])] AS s FROM near GROUP BY k, r, j),
    moves AS (
      SELECT m.k, m.r, m.j, m.step, m.c AS old,
        CASE WHEN n IS NULL THEN m.c ELSE list_transform(s, lambda v : v::DOUBLE / n / {KMEANS_UNIT}) END AS new
      FROM moving m LEFT JOIN sums ON m.k = sums.k AND m.r = sums.r AND m.j = sums.j)
    SELECT k, r, j, new, step + 1, sum({square("new", "old")}) OVER (PARTITION BY k, r) FROM moves)),
ended AS MATERIALIZED (SELECT * FROM lloyd QUALIFY step = max(step) OVER (PARTITION BY k, r)),
costs AS (
  SELECT k, r, sum(floor(d2 * {KMEANS_UNIT} + 0.5)::BIGINT) AS cost
  FROM (SELECT k, r, CustomerID, min({square("x", "c")}) AS d2 FROM ended, unit_points GROUP BY ALL) GROUP BY k, r),
best_centers AS MATERIALIZED (
  SELECT k, row_number() OVER (PARTITION BY k ORDER BY c) - 1 AS Cluster, c, cost
  FROM ended JOIN (SELECT k, min((cost, r)) AS best FROM costs GROUP BY k) USING (k), LATERAL (SELECT best[1] AS cost) WHERE r = best[2]),
labelled_points AS MATERIALIZED (
  SELECT k, CustomerID, v, min(({square("v", "c")}, Cluster))[2] AS Cluster
  FROM (SELECT CustomerID, [Recency, Frequency, Monetary] AS v FROM scaled), best_centers GROUP BY k, CustomerID, v)"""


SWEEP = """moments AS (
  SELECT k, Cluster, count(*) AS n, [avg(v[1]), avg(v[2]), avg(v[3])] AS mean, avg(list_dot_product(v, v)) AS spread
  FROM labelled_points GROUP BY k, Cluster),
distances AS (
  SELECT p.k, CustomerID, p.Cluster AS own, m.Cluster, n, list_dot_product(v, v) - 2 * list_dot_product(v, mean) + spread AS d
  FROM labelled_points p JOIN moments m ON p.k = m.k),
widths AS (
  SELECT k, CustomerID, max(CASE WHEN own = Cluster THEN n END) AS n,
    max(CASE WHEN own = Cluster AND n > 1 THEN n * d / (n - 1) END) AS a, min(CASE WHEN own <> Cluster THEN d END) AS b
  FROM distances GROUP BY k, CustomerID)
SELECT k::INT AS K, any_value(Inertia) AS Inertia,
  round(avg(CASE WHEN n = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS Silhouette
FROM widths JOIN (SELECT k, round(any_value(cost)::DOUBLE / {unit}, 4) AS Inertia FROM best_centers GROUP BY k) USING (k) GROUP BY k"""


# ---- queries ---------------------------------------------------------------------------------------

PARTS = """parted AS MATERIALIZED ({split}),
train_part AS MATERIALIZED (SELECT l.* FROM labelled l JOIN parted USING (CustomerID) WHERE IsTest = 0),
test_part AS MATERIALIZED (SELECT l.* FROM labelled l JOIN parted USING (CustomerID) WHERE IsTest = 1)"""
PLACES = 6  # digits of probabilities


def selects(split: str, feature_columns: str, pca_points: str) -> dict[str, str]:
    """The queries of the fits; ``split``: who is in the test part, ``pca_points``: the plane of all customers."""
    sweep = f"WITH RECURSIVE {kmeans_cte(K_RANGE)}, {SWEEP.format(unit=KMEANS_UNIT)}"
    one = kmeans_cte(range(CLUSTERS, CLUSTERS + 1))
    parts = PARTS.format(split=split)
    tested = rows_cte("train_part", "test_part")
    comparison = f"""fitted AS MATERIALIZED (
  SELECT 'Logistic Regression' AS Model, Churned, round({LOGISTIC_SCORE}, 10) AS p FROM test_part, logistic_fit
  UNION ALL SELECT 'Random Forest', Churned, round(p, 10) FROM forest_scores JOIN test_part ON id = CustomerID
  UNION ALL SELECT 'Boosted Trees', Churned, round({BOOSTED_SCORE}, 10) FROM {BOOSTED_ROWS} JOIN test_part ON id = CustomerID),
fitted_auc AS (
  SELECT Model, sum(plus * (below + minus / 2.0::DOUBLE)) / (sum(plus) * sum(minus)) AS auc FROM (
    SELECT *, coalesce(sum(minus) OVER (PARTITION BY Model ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
    FROM (SELECT Model, p, sum(Churned) AS plus, sum(1 - Churned) AS minus FROM fitted GROUP BY Model, p)) GROUP BY Model)
SELECT Model, round_even((tp + tn) / total, 4) AS Accuracy,
  round_even(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 4) AS "Precision",
  round_even(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 4) AS Recall,
  round_even(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 4) AS F1, round_even(auc, 4) AS "ROC-AUC"
FROM (SELECT Model, count(*)::DOUBLE AS total, count(*) FILTER (Churned = 0 AND p <= 0.5)::DOUBLE AS tn,
        count(*) FILTER (Churned = 0 AND p > 0.5)::DOUBLE AS fp, count(*) FILTER (Churned = 1 AND p <= 0.5)::DOUBLE AS fn,
        count(*) FILTER (Churned = 1 AND p > 0.5)::DOUBLE AS tp FROM fitted GROUP BY Model) JOIN fitted_auc USING (Model)"""
    whole = rows_cte("labelled", "live")
    names = ", ".join(f"'{c}'" for c in FEATURES)
    return {
        "kmeans_k_sweep": sweep,
        "chart_k_selection": sweep,
        "kmeans_assign": f"WITH RECURSIVE {one} SELECT CustomerID, Cluster FROM labelled_points",
        "chart_pca_points": f"""WITH RECURSIVE {one}
SELECT CustomerID, PCA1, PCA2, Cluster FROM ({pca_points}) JOIN labelled_points USING (CustomerID)""",
        "logreg_churn": f"""WITH RECURSIVE {parts}, {logistic_cte("train_part")}
SELECT CustomerID, Churned, round({LOGISTIC_SCORE}, {PLACES}) AS ChurnProbability FROM test_part, logistic_fit""",
        "random_forest_churn": f"""WITH RECURSIVE {parts}, {tested}, {forest_cte()}
SELECT CustomerID, Churned, round(p, {PLACES}) AS ChurnProbability FROM forest_scores JOIN test_part ON id = CustomerID""",
        "boosted_trees_churn": f"""WITH RECURSIVE {parts}, {tested}, {boost_cte()}
SELECT CustomerID, Churned, round({BOOSTED_SCORE}, {PLACES}) AS ChurnProbability
FROM {BOOSTED_ROWS} JOIN test_part ON id = CustomerID""",
        "score_live_customers": f"""WITH RECURSIVE {whole}, {forest_cte()}
SELECT id AS CustomerID, round(p, {PLACES}) AS ChurnProbability FROM forest_scores""",
        "score_all_observed": f"""WITH RECURSIVE {parts}, {rows_cte("train_part", "labelled")}, {boost_cte()}
SELECT {feature_columns}, Churned, round({BOOSTED_SCORE}, {PLACES}) AS ChurnProbability_Boosted
FROM {BOOSTED_ROWS} JOIN (SELECT {feature_columns}, Churned FROM labelled) ON id = CustomerID""",
        "feature_importance": f"""WITH RECURSIVE {parts}, {tested}, {boost_cte()}
SELECT Feature, round(mean / sum(mean) OVER (), {PLACES}) AS Importance FROM (
  SELECT [{names}][f + 1] AS Feature, coalesce(avg(gain), 0) AS mean
  FROM range({WIDTH}) AS r(f) LEFT JOIN (SELECT bins, gain FROM boosted WHERE kind = 1) ON bins = f GROUP BY f)""",
        "churn_model_comparison": f"""WITH RECURSIVE {parts}, {tested}, {logistic_cte("train_part")}, {forest_cte()}, {boost_cte()},
{comparison}""",
    }

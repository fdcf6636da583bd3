"""DuckDB SQL of the model queries: splits, trees, boosted stumps, ridge lines and metrics.

Everything is computed from the model table's rows: gains from running sums
over sorted feature values, lines from covariances.
"""

from __future__ import annotations

from collections.abc import Sequence

from aqarlens.catalog import oracles as sql


def rows(features: Sequence[str]) -> str:
    """CTEs up to ``m`` (listing_id, split, y, x list) and ``tr``, its training rows."""
    values = ", ".join(f"CAST({name} AS DOUBLE)" for name in features)
    return (
        sql.pipeline("model_table")
        + f",\nm AS MATERIALIZED (SELECT listing_id, split, label AS y, [{values}] AS x FROM model_table)"
        + ",\ntr AS MATERIALIZED (SELECT * FROM m WHERE split = 'train')"
    )


def split(name: str, source: str, features: int, min_rows: int) -> str:
    """CTE ``name``: the best split of ``source`` (y, x) as one row, or none."""
    return f""",
{name}_v AS MATERIALIZED (SELECT k, value, count(*) AS n, sum(y) AS s, sum(y * y) AS q FROM
  (SELECT y, unnest(x) AS value, unnest(range({features})) AS k FROM {source}) GROUP BY k, value),
{name}_r AS (SELECT k, value, lead(value) OVER w AS after, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(q) OVER w AS ql,
  sum(n) OVER (PARTITION BY k) AS n, sum(s) OVER (PARTITION BY k) AS s, sum(q) OVER (PARTITION BY k) AS q
  FROM {name}_v WINDOW w AS (PARTITION BY k ORDER BY value)),
{name} AS MATERIALIZED (SELECT * FROM (SELECT k, (value + after) / 2 AS threshold, n, s / n AS mean, sl / nl AS left_mean,
  (s - sl) / (n - nl) AS right_mean, (q / n - (s / n) ** 2) - (nl / n) * (ql / nl - (sl / nl) ** 2)
  - ((n - nl) / n) * ((q - ql) / (n - nl) - ((s - sl) / (n - nl)) ** 2) AS gain
  FROM {name}_r WHERE after IS NOT NULL AND nl >= {min_rows} AND n - nl >= {min_rows})
  WHERE gain > 0 ORDER BY gain DESC, k, threshold LIMIT 1)"""


def tree(name: str, features: int, min_rows: int) -> str:
    """CTEs of a tree of depth two on ``tr``: inner nodes ``{name}_inner`` and all nodes ``{name}_nodes``."""
    below = f"(SELECT tr.* FROM tr, {name}1 WHERE tr.x[{name}1.k + 1] <= {name}1.threshold)"
    above = f"(SELECT tr.* FROM tr, {name}1 WHERE tr.x[{name}1.k + 1] > {name}1.threshold)"
    return (
        split(f"{name}1", "tr", features, min_rows)
        + split(f"{name}2", below, features, min_rows)
        + split(f"{name}3", above, features, min_rows)
        + f""",
{name}_inner AS (SELECT 1 AS node, * FROM {name}1 UNION ALL SELECT 2, * FROM {name}2 UNION ALL SELECT 3, * FROM {name}3),
{name}_ends AS (SELECT 2 * node AS node, left_mean AS mean FROM {name}_inner UNION ALL SELECT 2 * node + 1, right_mean FROM {name}_inner),
{name}_nodes AS (SELECT node, k, threshold, gain, mean FROM {name}_inner
  UNION ALL SELECT node, NULL, NULL, NULL, mean FROM {name}_ends WHERE node NOT IN (SELECT node FROM {name}_inner))"""
    )


def stump_value(name: str, row: str = "m") -> str:
    return f"(SELECT CASE WHEN {row}.x[k + 1] <= threshold THEN left_mean ELSE right_mean END FROM {name})"


def boosted(name: str, features: int, step: float = 0.1, min_rows: int = 1) -> str:
    """CTEs of two boosted stumps, ``{name}1`` and ``{name}2``."""
    left_over = f"(SELECT 2 * (tr.y - {stump_value(name + '1', 'tr')}) AS y, x FROM tr)"
    return split(f"{name}1", "tr", features, min_rows) + split(f"{name}2", left_over, features, min_rows)


def line(name: str, source: str, penalty: float) -> str:
    """CTE ``name`` (w1, w2, b): the ridge line of two features."""
    return f""",
{name}_c AS (SELECT avg(x[1]) AS m1, avg(x[2]) AS m2, avg(y) AS my, var_pop(x[1]) AS v1, var_pop(x[2]) AS v2,
  covar_pop(x[1], x[2]) AS v12, covar_pop(x[1], y) AS c1, covar_pop(x[2], y) AS c2, {penalty} / sqrt(var_pop(y)) AS p FROM {source}),
{name}_w AS (SELECT *, v1 * (1 + p) AS a, v2 * (1 + p) AS d FROM {name}_c),
{name} AS MATERIALIZED (SELECT (c1 * d - c2 * v12) / (a * d - v12 * v12) AS w1, (c2 * a - c1 * v12) / (a * d - v12 * v12) AS w2,
  my - m1 * (c1 * d - c2 * v12) / (a * d - v12 * v12) - m2 * (c2 * a - c1 * v12) / (a * d - v12 * v12) AS b FROM {name}_w)"""


METRICS = {
    "R2": "1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))",
    "RMSE_log": "sqrt(avg((y - p) * (y - p)))",
    "MAE_log": "avg(abs(y - p))",
    "RMSE_EGP": "sqrt(avg((exp(y) - exp(p)) * (exp(y) - exp(p))))",
}
DIGITS = {"R2": 6, "RMSE_log": 6, "MAE_log": 6, "RMSE_EGP": 3}


def compared(min_rows: int, penalty: float) -> str:
    """CTE ``compared``: the fifteen result columns of four models on two features."""
    scored = f""",
scored AS MATERIALIZED (
  SELECT 'Spark Linear Regression' AS model, split, y, w1 * x[1] + w2 * x[2] + b AS p FROM m, lr
  UNION ALL SELECT 'Spark Random Forest', split, y, {stump_value('dt1')} FROM m
  UNION ALL SELECT 'Spark Gradient-Boosted Trees', split, y, {stump_value('gb1')} + 0.1E0 * {stump_value('gb2')} FROM m
  UNION ALL SELECT 'Spark Decision Tree', split, y, dt_ends.mean FROM
    (SELECT s.*, coalesce(CASE WHEN x[i.k + 1] <= i.threshold THEN 2 * s.at ELSE 2 * s.at + 1 END, s.at) AS leaf FROM
      (SELECT m.*, CASE WHEN x[dt1.k + 1] <= dt1.threshold THEN 2 ELSE 3 END AS at FROM m, dt1) s LEFT JOIN dt_inner i ON i.node = s.at)
    JOIN dt_ends ON dt_ends.node = leaf),
per_split AS MATERIALIZED (SELECT model, split, {', '.join(f'{e} AS {c}' for c, e in METRICS.items())} FROM scored GROUP BY model, split)"""

    def of(part: str, metric: str, prefix: str) -> str:
        return f"round(max({metric}) FILTER (split = '{part}'), {DIGITS[metric]}) AS {prefix}{metric}"

    columns = [of(part, metric, prefix) for part, prefix in (("train", "Train_"), ("validation", "Validation_"), ("test", "")) for metric in METRICS]
    return (
        tree("dt", 2, min_rows)
        + boosted("gb", 2)
        + line("lr", "tr", penalty)
        + scored
        + f""",
compared AS (SELECT model AS Model, {', '.join(columns)}, CAST(NULL AS DOUBLE) AS Tuning_Validation_R2, '{{}}' AS Best_Params FROM per_split GROUP BY model)
"""
    )

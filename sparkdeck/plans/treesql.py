"""Exact regression trees, boosting and logistic fits in DuckDB SQL, for the oracles.

The features of the regression table take few values, and a tree sees a row
only through them: rows are summed per combination of feature values
(``cells``), and every split is searched over sums of cells.

A split of a node puts the values up to some value of a feature on the left; its
gain is the drop in the variance of the label, weighted by rows.  Of equal
gains the first feature and the smallest value win.  A node without a gain
stays a leaf.  Boosting adds the first tree as it is and ``step`` times each
later one, fitted on twice the residuals (the negative gradient of the squared
error).

One recursion does it all: a step of it either splits all nodes of a level or,
at the bottom, moves each cell's prediction by its leaf's mean and starts the
next tree at the root.  Many fits (``fit``: folds and parameters) run side by side.
"""

from __future__ import annotations

from collections.abc import Sequence

_INF = "'-inf'::DOUBLE"


def cells_sql(rows: str, features: Sequence[str], by: Sequence[str] = ()) -> str:
    """Sums of the labels of ``rows`` per combination of feature values."""
    keys = ", ".join([*by, *features])
    return (f"SELECT {keys}, COUNT(*)::DOUBLE AS n, SUM(label)::DOUBLE AS y, SUM(label * label)::DOUBLE AS yy "
            f"FROM ({rows}) r GROUP BY {keys}")


def boosting_sql(start: str, features: Sequence[str]) -> str:
    """A recursive CTE ``boosted``.  ``start`` gives fit, depth, step, rounds,
    a cell number, the features, and n, y of the training rows of each cell
    (n = 0: scored only).  Its rows at level 0 and tree k hold each cell's
    prediction ``p`` after k trees, and ``leaf`` the last tree's leaf."""
    f = list(features)
    cols = ", ".join(f)
    node = "PARTITION BY fit, node"
    # the labels a tree is fitted on, summed per cell
    target = "CASE WHEN tree = 0 THEN y ELSE 2 * (y - n * p) END"
    left = ", ".join(
        f"SUM(n) OVER ({node} ORDER BY {c} RANGE UNBOUNDED PRECEDING) AS n{i}, "
        f"SUM(t) OVER ({node} ORDER BY {c} RANGE UNBOUNDED PRECEDING) AS t{i}" for i, c in enumerate(f))
    # the gain times the node's rows, up to the node's own share (the same for all splits)
    gain = ", ".join(
        f"CASE WHEN n > 0 AND n{i} > 0 AND n{i} < na THEN t{i} * t{i} / n{i} + (ta - t{i}) * (ta - t{i}) / (na - n{i}) "
        f"- ta * ta / na ELSE {_INF} END AS g{i}" for i in range(len(f)))
    best = ", ".join(f"MAX(g{i}) OVER ({node}) AS b{i}, FIRST_VALUE({c}) OVER ({node} ORDER BY g{i} DESC, {c}) AS v{i}"
                     for i, c in enumerate(f))
    chosen = "CASE " + " ".join(
        f"WHEN {' AND '.join([f'b{i} > b{j}' for j in range(i)] + [f'b{i} >= b{j}' for j in range(i + 1, len(f))]) or 'true'} "
        f"THEN CASE WHEN {c} <= v{i} THEN 2 * node ELSE 2 * node + 1 END" for i, c in enumerate(f)) + " END"
    most = f"GREATEST({', '.join(f'b{i}' for i in range(len(f)))})"
    return f"""
boosted(fit, depth, step, rounds, cell, {cols}, n, y, p, tree, level, node, leaf) AS (
  SELECT fit, depth, step, rounds, cell, {cols}, n, y, 0.0::DOUBLE, 0, 0, 1::BIGINT, 0::BIGINT FROM ({start}) s
  UNION ALL
  SELECT fit, depth, step, rounds, cell, {cols}, n, y,
    CASE WHEN level < depth THEN p ELSE p + CASE WHEN tree = 0 THEN 1 ELSE step END * ta / na END,
    CASE WHEN level < depth THEN tree ELSE tree + 1 END,
    CASE WHEN level < depth THEN level + 1 ELSE 0 END,
    CASE WHEN level = depth THEN 1 WHEN {most} > 0 THEN {chosen} ELSE 2 * node END,
    CASE WHEN level < depth THEN leaf ELSE node END
  FROM (SELECT *, {best} FROM (SELECT *, {gain} FROM (
    SELECT *, SUM(n) OVER ({node}) AS na, SUM(t) OVER ({node}) AS ta, {left}
    FROM (SELECT *, {target} AS t FROM boosted WHERE tree < rounds) b1) b2) b3) b4)"""


def newton_sql(rows: str, features: Sequence[str], steps: int = 30) -> str:
    """A recursive CTE ``newton`` of the logistic fit of ``rows`` (label and
    features): intercept and coefficients b0, b1, ... after each Newton step,
    the normal equations solved by elimination."""
    k = len(features) + 1
    x = ["1.0", *(f"r.{c}" for c in features)]
    score = " + ".join(f"s.b{i} * {x[i]}" for i in range(k))
    b = ", ".join(f"b{i}" for i in range(k))
    sums = ", ".join([f"SUM(w * x{i} * x{j}) AS a{i}_{j}" for i in range(k) for j in range(k)]
                     + [f"SUM((label - q) * x{i}) AS a{i}_{k}" for i in range(k)])
    inner = (f"SELECT step, {b}, {sums} FROM (SELECT *, q * (1 - q) AS w FROM (SELECT s.step, {', '.join(f's.b{i}' for i in range(k))}, "
             f"r.label, {', '.join(f'{c}::DOUBLE AS x{i}' for i, c in enumerate(x))}, 1 / (1 + exp(-({score}))) AS q "
             f"FROM newton s, ({rows}) r WHERE s.step < {steps}) e1) e2 GROUP BY step, {b}")
    for i in range(k):  # clear column i from every other row
        kept = [f"a{r}_{c}" for r in range(k) for c in range(i + 1, k + 1) if r == i]
        cleared = [f"a{r}_{c} - a{r}_{i} / a{i}_{i} * a{i}_{c} AS a{r}_{c}" for r in range(k) if r != i for c in range(i + 1, k + 1)]
        diagonal = [f"a{r}_{r}" for r in range(i + 1)]
        inner = f"SELECT step, {b}, {', '.join([*diagonal, *kept, *cleared])} FROM ({inner}) g{i}"
    moved = ", ".join(f"b{i} + a{i}_{k} / a{i}_{i}" for i in range(k))
    return f"""
newton(step, {b}) AS (
  SELECT 0, {', '.join(['0.0::DOUBLE'] * k)}
  UNION ALL SELECT step + 1, {moved} FROM ({inner}) solved)"""

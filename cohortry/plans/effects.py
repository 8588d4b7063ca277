"""Queries on the cross-fitted effect; with learners that are shares of cells, SQL can state all of it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..stats import crossfit
from .registry import query
from .statistics import rounded
from .views import Views

FOLDS, STEPS = 5, 12

_BOTH = ("n1", "s1", "n0", "s0")
ROWS_SQL = f"""SELECT CAST(o_totalprice > 250000 AS INTEGER) AS y, CAST(o_orderstatus = 'F' AS INTEGER) AS a, o_orderpriority AS w, quarter(o_orderdate) AS s,
    CAST(('0x' || substr(md5(CAST(o_custkey AS VARCHAR)), 1, 7)) AS BIGINT) % {FOLDS} AS fold FROM orders"""
PATTERNS = """SELECT fold, y, a, w, s, CAST(count(*) AS DOUBLE) AS n FROM effect_rows
    WHERE y IS NOT NULL AND a IS NOT NULL AND w IS NOT NULL AND s IS NOT NULL GROUP BY 1, 2, 3, 4, 5"""
CELLS = "SELECT fold, w, s, sum(n * a) AS n1, sum(n * a * y) AS s1, sum(n * (1 - a)) AS n0, sum(n * (1 - a) * y) AS s0 FROM patterns GROUP BY 1, 2, 3"
OTHERS = "SELECT f.fold, " + ", ".join(f"t.{c} - f.{c} AS {c}" for c in _BOTH) + f"""
    FROM (SELECT fold, {', '.join(f'sum({c}) AS {c}' for c in _BOTH)} FROM cells GROUP BY 1) f, (SELECT {', '.join(f'sum({c}) AS {c}' for c in _BOTH)} FROM cells) t"""
GUESSES = f"""SELECT c.fold, c.w, c.s, o.s1 / o.n1 AS m1, o.s0 / o.n0 AS m0, o.n1 / (o.n1 + o.n0) AS mg,
    (t.s1 - c.s1 + o.s1 / o.n1) / (t.n1 - c.n1 + 1) AS c1, (t.s0 - c.s0 + o.s0 / o.n0) / (t.n0 - c.n0 + 1) AS c0,
    (t.n1 - c.n1 + o.n1 / (o.n1 + o.n0)) / (t.n1 - c.n1 + t.n0 - c.n0 + 1) AS cg
    FROM cells c JOIN others o ON o.fold = c.fold JOIN (SELECT w, s, {', '.join(f'sum({c}) AS {c}' for c in _BOTH)} FROM cells GROUP BY 1, 2) t ON t.w = c.w AND t.s = c.s"""
GUESSED = """SELECT y, a, n, m1, m0, mg, c1, c0, cg, CASE WHEN a = 1 THEN m1 ELSE m0 END AS mq, CASE WHEN a = 1 THEN c1 ELSE c0 END AS cq
    FROM patterns p JOIN guesses g ON g.fold = p.fold AND g.w = p.w AND g.s = p.s"""
# Of two learners the weight that gives the least squared error is a ratio of sums, kept between 0 and 1.
STACKED = """SELECT least(1.0, greatest(0.0, sum(n * (cq - mq) * (y - mq)) / sum(n * (cq - mq) * (cq - mq)))) AS vq,
    least(1.0, greatest(0.0, sum(n * (cg - mg) * (a - mg)) / sum(n * (cg - mg) * (cg - mg)))) AS vg FROM guessed"""
START = """SELECT y, a, n, ln(q1 / (1 - q1)) AS l1, ln(q0 / (1 - q0)) AS l0, g FROM (SELECT y, a, n, least(greatest(vq * c1 + (1 - vq) * m1, 0.001), 0.999) AS q1,
    least(greatest(vq * c0 + (1 - vq) * m0, 0.001), 0.999) AS q0, least(greatest(vg * cg + (1 - vg) * mg, 0.025), 0.975) AS g FROM guessed, stacked)"""


def _newton(k: int) -> str:
    """Step k of the two moves that make the weighted residuals of either arm sum to zero."""
    return f"""SELECT any_value(e1) + sum(a * n / g * (y - p1)) / sum(a * n / (g * g) * p1 * (1 - p1)) AS e1,
        any_value(e0) + sum((1 - a) * n / (1 - g) * (y - p0)) / sum((1 - a) * n / ((1 - g) * (1 - g)) * p0 * (1 - p0)) AS e0
        FROM (SELECT y, a, n, g, e1, e0, 1 / (1 + exp(-(l1 + e1 / g))) AS p1, 1 / (1 + exp(-(l0 + e0 / (1 - g)))) AS p0 FROM start_at, move{k})"""


MOVES = {"move0": "SELECT CAST(0 AS DOUBLE) AS e1, CAST(0 AS DOUBLE) AS e0", **{f"move{k + 1}": _newton(k) for k in range(STEPS)}}
CURVE = f"""SELECT n, q1, q0, a / g * (y - q1) + q1 AS u1, (1 - a) / (1 - g) * (y - q0) + q0 AS u0
    FROM (SELECT y, a, n, g, 1 / (1 + exp(-(l1 + e1 / g))) AS q1, 1 / (1 + exp(-(l0 + e0 / (1 - g)))) AS q0 FROM start_at, move{STEPS})"""
MEANS = "SELECT sum(n) AS n, sum(n * q1) / sum(n) AS p1, sum(n * q0) / sum(n) AS p0, sum(n * u1) / sum(n) AS a1, sum(n * u0) / sum(n) AS a0 FROM curve"
SPREAD = """SELECT any_value(m.n) AS n, any_value(p1) AS p1, any_value(p0) AS p0, sum(c.n * (u1 - a1) * (u1 - a1)) / (any_value(m.n) - 1) AS v1,
    sum(c.n * (u0 - a0) * (u0 - a0)) / (any_value(m.n) - 1) AS v0, sum(c.n * (u1 - a1) * (u0 - a0)) / (any_value(m.n) - 1) AS v10 FROM curve c, means m"""
EFFECTS = """SELECT 'risk difference' AS estimand, p1 - p0 AS estimate, sqrt((v1 + v0 - 2 * v10) / n) AS se, n, FALSE AS ratio FROM spread
    UNION ALL SELECT 'relative risk', p1 / p0, sqrt((v1 / (p1 * p1) + v0 / (p0 * p0) - 2 * v10 / (p1 * p0)) / n), n, TRUE FROM spread
    UNION ALL SELECT 'odds ratio', p1 * (1 - p0) / (p0 * (1 - p1)), sqrt((v1 / (p1 * (1 - p1)) ** 2 + v0 / (p0 * (1 - p0)) ** 2 - 2 * v10 / (p1 * (1 - p1) * p0 * (1 - p0))) / n), n, TRUE FROM spread"""
ESTIMATES = """SELECT estimand, round(estimate, 5) AS estimate, round(se, 5) AS std_error,
    round(CASE WHEN ratio THEN estimate * exp(-1.959963984540054 * se) ELSE estimate - 1.959963984540054 * se END, 5) AS ci_low,
    round(CASE WHEN ratio THEN estimate * exp(1.959963984540054 * se) ELSE estimate + 1.959963984540054 * se END, 5) AS ci_high, CAST(n AS BIGINT) AS n FROM effects"""
WEIGHTS = """SELECT 'outcome' AS target, 'cells' AS learner, round(vq, 5) AS weight, (SELECT round(sum(n * (y - cq) ** 2) / sum(n), 6) FROM guessed) AS loss FROM stacked
    UNION ALL SELECT 'outcome', 'mean', round(1 - vq, 5), (SELECT round(sum(n * (y - mq) ** 2) / sum(n), 6) FROM guessed) FROM stacked
    UNION ALL SELECT 'treatment', 'cells', round(vg, 5), (SELECT round(sum(n * (a - cg) ** 2) / sum(n), 6) FROM guessed) FROM stacked
    UNION ALL SELECT 'treatment', 'mean', round(1 - vg, 5), (SELECT round(sum(n * (a - mg) ** 2) / sum(n), 6) FROM guessed) FROM stacked"""
GUESSING = {"effect_rows": ROWS_SQL, "patterns": PATTERNS, "cells": CELLS, "others": OTHERS, "guesses": GUESSES, "guessed": GUESSED, "stacked": STACKED}
TARGETING = {**GUESSING, "start_at": START, **MOVES, "curve": CURVE, "means": MEANS, "spread": SPREAD, "effects": EFFECTS}
SHARES = {"categorical": ("w", "s"), "folds": FOLDS, "learners": ("mean", "cells")}


def effect_rows(v: Views) -> DataFrame:
    """High price by order status, with the priority and the quarter as covariates; orders of a customer are in one fold."""
    return v.table("orders").selectExpr(
        "CAST(o_totalprice > 250000 AS INT) AS y", "CAST(o_orderstatus = 'F' AS INT) AS a", "o_orderpriority AS w", "quarter(o_orderdate) AS s", "o_custkey"
    )


@query("tmle_crossfit", ESTIMATES, **TARGETING)
def _(v: Views):
    """Every column is compared: estimates, errors and limits."""
    return rounded(crossfit.tmle_crossfit(effect_rows(v), "y", "a", "o_custkey", **SHARES), "estimate", "std_error", "ci_low", "ci_high", digits=5)


@query("tmle_crossfit_weights", WEIGHTS, **GUESSING)
def _(v: Views):
    return rounded(rounded(crossfit.learner_weights(effect_rows(v), "y", "a", "o_custkey", **SHARES), "weight", digits=5), "loss")

"""Queries on balance, association, description and the treatment effect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..stats import association, balance, describe, tmle
from .registry import query
from .views import Views

CUSTOMER_CATEGORIES, CUSTOMER_NUMBERS = ("sex", "area", "nation"), ("c_acctbal", "age")
ORDER_CATEGORIES, ORDER_NUMBERS = ("o_orderpriority", "season"), ("o_totalprice",)
CUSTOMERS = """SELECT c_mktsegment AS grp, c_acctbal, CASE WHEN c_custkey % 9 <> 0 THEN CAST(CAST(c_custkey % 70 AS INTEGER) + 20 AS DOUBLE) END AS age,
    CAST(c_custkey % 2 AS VARCHAR) AS sex, CASE WHEN c_custkey % 17 <> 0 THEN CAST(c_nationkey % 4 AS VARCHAR) END AS area,
    CAST(c_nationkey AS VARCHAR) AS nation FROM customer"""
ORDERS = "SELECT o_orderstatus AS grp, o_orderpriority, CAST(month(o_orderdate) % 4 AS VARCHAR) AS season, o_totalprice FROM orders"


def customers(v: Views) -> DataFrame:
    return v.table("customer").selectExpr(
        "c_mktsegment AS grp", "c_acctbal", "CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_custkey % 70 + 20 AS DOUBLE) END AS age",
        "CAST(c_custkey % 2 AS STRING) AS sex", "CASE WHEN c_custkey % 17 <> 0 THEN CAST(c_nationkey % 4 AS STRING) END AS area",
        "CAST(c_nationkey AS STRING) AS nation",
    )


def orders(v: Views) -> DataFrame:
    return v.table("orders").selectExpr(
        "o_orderstatus AS grp", "o_orderpriority", "CAST(month(o_orderdate) % 4 AS STRING) AS season", "o_totalprice"
    )


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def _long(source: str, names, kind: str) -> str:
    return " UNION ALL ".join(f"SELECT grp, '{n}' AS variable, CAST({n} AS {kind}) AS x FROM {source} WHERE {n} IS NOT NULL" for n in names)


SPREAD = "SELECT variable, grp, count(*) AS n, avg(x) AS m, var_samp(x) AS s FROM numbers GROUP BY 1, 2"
PAIRED = "SELECT a.variable, a.grp AS group1, b.grp AS group2, a.n AS n1, b.n AS n2, a.m AS m1, b.m AS m2, a.s AS s1, b.s AS s2 FROM spread a JOIN spread b ON a.variable = b.variable AND a.grp < b.grp"
COUNTS = "SELECT variable, x AS level, grp, count(*) AS n FROM levels GROUP BY 1, 2, 3"
SHARES = """SELECT a.variable, a.level, g1.grp AS group1, g2.grp AS group2, coalesce(c1.n, 0) * 1.0 / t1.n AS p1, coalesce(c2.n, 0) * 1.0 / t2.n AS p2
    FROM (SELECT DISTINCT variable, level FROM counts) a JOIN (SELECT DISTINCT grp FROM counts) g1 ON TRUE JOIN (SELECT DISTINCT grp FROM counts) g2 ON g1.grp < g2.grp
    JOIN (SELECT variable, grp, sum(n) AS n FROM counts GROUP BY 1, 2) t1 ON t1.variable = a.variable AND t1.grp = g1.grp
    JOIN (SELECT variable, grp, sum(n) AS n FROM counts GROUP BY 1, 2) t2 ON t2.variable = a.variable AND t2.grp = g2.grp
    LEFT JOIN counts c1 ON c1.variable = a.variable AND c1.level = a.level AND c1.grp = g1.grp
    LEFT JOIN counts c2 ON c2.variable = a.variable AND c2.level = a.level AND c2.grp = g2.grp"""
C = {"customers": CUSTOMERS, "numbers": _long("customers", CUSTOMER_NUMBERS, "DOUBLE"), "spread": SPREAD, "paired": PAIRED,
     "levels": _long("customers", CUSTOMER_CATEGORIES, "VARCHAR"), "counts": COUNTS, "shares": SHARES}
O = {"orders_view": ORDERS, "numbers": _long("orders_view", ORDER_NUMBERS, "DOUBLE"), "spread": SPREAD, "paired": PAIRED,
     "levels": _long("orders_view", ORDER_CATEGORIES, "VARCHAR"), "counts": COUNTS, "shares": SHARES}

_SIMPSON = "CASE WHEN i = 0 OR i = {n} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"


def chi2_p_sql(stat: str, dof: str, n: int = 4000) -> str:
    """Upper tail by Simpson's rule, after a substitution that removes the pole at 0."""
    weight = _SIMPSON.format(n=n)
    inner = f"SELECT sum(({weight}) * 2 * pow(i * sqrt({stat}) / {n}, {dof} - 1) * exp(-pow(i * sqrt({stat}) / {n}, 2) / 2)) * sqrt({stat}) / {n} / 3 FROM range({n + 1}) r(i)"
    return f"round(1 - ({inner}) / (pow(2, {dof} / 2.0) * gamma({dof} / 2.0)), 6)"


def t_p_sql(stat: str, dof: str, n: int = 4000) -> str:
    weight, top = _SIMPSON.format(n=n), f"atan(abs({stat}) / sqrt({dof}))"
    inner = f"SELECT sum(({weight}) * pow(cos(i * {top} / {n}), {dof} - 1)) * {top} / {n} / 3 FROM range({n + 1}) r(i)"
    return f"round(1 - 2 * ({inner}) * exp(lgamma(({dof} + 1) / 2.0) - lgamma({dof} / 2.0)) / sqrt(pi()), 6)"


def f_p_sql(stat: str, dof1: str, dof2: str, n: int = 4000) -> str:
    """Upper tail as an incomplete beta integral, cut where the integrand has fallen by a factor of e^60."""
    weight, low = _SIMPSON.format(n=n), f"({dof1} * {stat} / ({dof2} + {dof1} * {stat}))"
    step = f"(least(1 - {low}, 120.0 / {dof2}) / {n})"
    at = f"({low} + i * {step})"
    inner = f"SELECT sum(({weight}) * pow(1 - {at}, {dof2} / 2.0 - 1) * pow({at}, {dof1} / 2.0 - 1)) * {step} / 3 FROM range({n + 1}) r(i)"
    return f"round(({inner}) * exp(lgamma(({dof1} + {dof2}) / 2.0) - lgamma({dof1} / 2.0) - lgamma({dof2} / 2.0)), 6)"


@query("smd_numeric", "SELECT variable, group1, group2, round(abs(m1 - m2) / sqrt((s1 + s2) / 2), 6) AS smd FROM paired", **C)
def _(v: Views):
    return rounded(balance.smd_numeric(customers(v), "grp", CUSTOMER_NUMBERS), "smd")


LEVEL_SMD = "SELECT variable, level, group1, group2, CASE WHEN p1 * (1 - p1) + p2 * (1 - p2) > 0 THEN round(abs(p1 - p2) / sqrt((p1 * (1 - p1) + p2 * (1 - p2)) / 2), 6) END AS smd FROM shares"


@query("smd_binary", f"{LEVEL_SMD} WHERE variable = 'sex'", **C)
def _(v: Views):
    return rounded(balance.smd_binary(customers(v), "grp", ["sex"]), "smd")


@query("smd_categorical", LEVEL_SMD, **C)
def _(v: Views):
    return rounded(balance.smd_categorical(customers(v), "grp", CUSTOMER_CATEGORIES), "smd")


# Gaussian elimination for up to three free levels, written out: the distance of the area column.
AREA_SMD = """SELECT 'area' AS variable, group1, group2, round(sqrt(d1 * d1 / a + f2 * f2 / b2 + g3 * g3 / c3), 6) AS smd FROM (
    SELECT *, d3 - e / a * d1 - (c2 / b2) * f2 AS g3, s33 - e * e / a - c2 * c2 / b2 AS c3 FROM (
    SELECT *, s11 AS a, s13 AS e, s22 - s12 * s12 / s11 AS b2, s23 - s12 * s13 / s11 AS c2, d2 - s12 / s11 * d1 AS f2 FROM (
    SELECT group1, group2, q1 - p1 AS d1, q2 - p2 AS d2, q3 - p3 AS d3,
        (p1 * (1 - p1) + q1 * (1 - q1)) / 2 AS s11, (p2 * (1 - p2) + q2 * (1 - q2)) / 2 AS s22, (p3 * (1 - p3) + q3 * (1 - q3)) / 2 AS s33,
        -(p1 * p2 + q1 * q2) / 2 AS s12, -(p1 * p3 + q1 * q3) / 2 AS s13, -(p2 * p3 + q2 * q3) / 2 AS s23 FROM (
    SELECT group1, group2, max(CASE WHEN level = '1' THEN p1 END) AS p1, max(CASE WHEN level = '2' THEN p1 END) AS p2, max(CASE WHEN level = '3' THEN p1 END) AS p3,
        max(CASE WHEN level = '1' THEN p2 END) AS q1, max(CASE WHEN level = '2' THEN p2 END) AS q2, max(CASE WHEN level = '3' THEN p2 END) AS q3
    FROM shares WHERE variable = 'area' GROUP BY 1, 2))))"""


@query("smd_pairs", f"SELECT variable, group1, group2, round((m2 - m1) / sqrt((s1 + s2) / 2), 6) AS smd FROM paired UNION ALL {AREA_SMD}", **C)
def _(v: Views):
    return rounded(balance.smd_pairs(customers(v), "grp", CUSTOMER_NUMBERS, ["area"]), "smd")


TABLE_ONE = """SELECT t.*, CAST(m.missing AS BIGINT) AS missing FROM (
    SELECT variable, level, grp, overall, CAST(n AS BIGINT) AS n, round(n * 100.0 / sum(n) OVER (PARTITION BY variable, grp, overall), 6) AS percent, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS sd
    FROM (SELECT variable, level, grp, n, FALSE AS overall FROM counts UNION ALL SELECT variable, level, 'Overall', sum(n), TRUE FROM counts GROUP BY 1, 2)
    UNION ALL SELECT variable, NULL, grp, overall, count(*), NULL, round(avg(x), 6), round(stddev_samp(x), 6) FROM (SELECT grp, variable, x, FALSE AS overall FROM numbers UNION ALL SELECT 'Overall', variable, x, TRUE FROM numbers) GROUP BY 1, 3, 4) t
    JOIN (SELECT 'age' AS variable, count(*) - count(age) AS missing FROM customers UNION ALL SELECT 'c_acctbal', count(*) - count(c_acctbal) FROM customers
    UNION ALL SELECT 'sex', count(*) - count(sex) FROM customers UNION ALL SELECT 'area', count(*) - count(area) FROM customers UNION ALL SELECT 'nation', count(*) - count(nation) FROM customers) m
    ON t.variable = m.variable"""


@query("table_one", TABLE_ONE, **C)
def _(v: Views):
    return rounded(balance.table_one(customers(v), "grp", CUSTOMER_CATEGORIES, CUSTOMER_NUMBERS), "percent", "mean", "sd")


def _chi_sql(counts: str, keys: str) -> str:
    """Statistic and degrees of freedom over a full grid of levels and groups."""
    same = " AND ".join(f"r.{k} = c.{k}" for k in keys.split(", "))
    at = " AND ".join(f"o.{k} = r.{k}" for k in keys.split(", "))
    named = ", ".join(f"r.{k}" for k in keys.split(", "))
    return f"""SELECT {named}, sum(pow(coalesce(o.n, 0) - r.n * c.n * 1.0 / r.t, 2) / (r.n * c.n * 1.0 / r.t)) AS statistic,
        CAST((count(DISTINCT r.level) - 1) * (count(DISTINCT c.grp) - 1) AS BIGINT) AS dof
        FROM (SELECT {keys}, level, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY {keys}) AS t FROM {counts} GROUP BY {keys}, level) r
        JOIN (SELECT {keys}, grp, sum(n) AS n FROM {counts} GROUP BY {keys}, grp) c ON {same}
        LEFT JOIN {counts} o ON {at} AND o.level = r.level AND o.grp = c.grp GROUP BY {named}"""


PAIR_COUNTS = """SELECT variable, level, grp, n, group1, group2 FROM counts
    JOIN (SELECT a.grp AS group1, b.grp AS group2 FROM (SELECT DISTINCT grp FROM counts) a JOIN (SELECT DISTINCT grp FROM counts) b ON a.grp < b.grp)
    ON grp = group1 OR grp = group2"""


@query(
    "chi_square_pairs", f"SELECT variable, group1, group2, round(statistic, 6) AS statistic, dof, {chi2_p_sql('statistic', 'dof')} AS p_value FROM tested",
    **O, pair_counts=PAIR_COUNTS, tested=_chi_sql("pair_counts", "variable, group1, group2"),
)
def _(v: Views):
    return rounded(association.chi_square_pairs(orders(v), "grp", ORDER_CATEGORIES), "statistic", "p_value")


STRATUM = """SELECT s.level AS stratum, a.grp AS group1, b.grp AS group2, sum(CASE WHEN c.level = s.level AND c.grp = a.grp THEN n ELSE 0 END) AS a,
    sum(CASE WHEN c.level = s.level AND c.grp = b.grp THEN n ELSE 0 END) AS b, sum(CASE WHEN c.level <> s.level AND c.grp = a.grp THEN n ELSE 0 END) AS c,
    sum(CASE WHEN c.level <> s.level AND c.grp = b.grp THEN n ELSE 0 END) AS d
    FROM counts c JOIN (SELECT DISTINCT level FROM counts WHERE variable = 'o_orderpriority') s ON TRUE
    JOIN (SELECT DISTINCT grp FROM counts) a ON TRUE JOIN (SELECT DISTINCT grp FROM counts) b ON a.grp < b.grp
    WHERE c.variable = 'o_orderpriority' GROUP BY 1, 2, 3"""
STRATA = """SELECT stratum, group1, group2, (a + b + c + d) * pow(a * d * 1.0 - b * c * 1.0, 2) / ((a + b) * 1.0 * (c + d) * (a + c) * (b + d)) AS statistic,
    CAST(1 AS BIGINT) AS dof FROM stratum"""


@query(
    "chi_square_by_stratum", f"SELECT stratum, group1, group2, round(statistic, 6) AS statistic, dof, {chi2_p_sql('statistic', 'dof')} AS p_value FROM strata",
    **O, stratum=STRATUM, strata=STRATA,
)
def _(v: Views):
    return rounded(association.chi_square_by_stratum(orders(v), "o_orderpriority", "grp"), "statistic", "p_value")


WELCH = "SELECT variable, group1, group2, (m1 - m2) / sqrt(s1 / n1 + s2 / n2) AS statistic, pow(s1 / n1 + s2 / n2, 2) / (pow(s1 / n1, 2) / (n1 - 1) + pow(s2 / n2, 2) / (n2 - 1)) AS dof FROM paired"


@query("welch_t_pairs", f"SELECT variable, group1, group2, round(statistic, 6) AS statistic, round(dof, 4) AS dof, {t_p_sql('statistic', 'dof')} AS p_value FROM welch", **C, welch=WELCH)
def _(v: Views):
    return rounded(rounded(association.welch_t_pairs(customers(v), "grp", CUSTOMER_NUMBERS), "statistic", "p_value"), "dof", digits=4)


ANOVA = """SELECT s.variable, (sum(s.n * pow(s.m - g.m, 2)) / (count(*) - 1)) / (sum((s.n - 1) * s.s) / (sum(s.n) - count(*))) AS statistic,
    count(*) - 1 AS dof1, sum(s.n) - count(*) AS dof2 FROM spread s JOIN (SELECT variable, avg(x) AS m FROM numbers GROUP BY 1) g ON s.variable = g.variable GROUP BY 1"""


@query(
    "table_one_tests",
    f"""SELECT variable, 'chi-square' AS test, round(statistic, 6) AS statistic, dof AS dof1, CAST(NULL AS BIGINT) AS dof2, {chi2_p_sql('statistic', 'dof')} AS p_value FROM tested
    UNION ALL SELECT variable, 'one-way F', round(statistic, 6), CAST(dof1 AS BIGINT), CAST(dof2 AS BIGINT), {f_p_sql('statistic', 'dof1', 'dof2')} FROM f_test""",
    **C, tested=_chi_sql("counts", "variable"), f_test=ANOVA,
)
def _(v: Views):
    return rounded(balance.table_one_tests(customers(v), "grp", CUSTOMER_CATEGORIES, CUSTOMER_NUMBERS), "statistic", "p_value")


@query("category_counts", "SELECT variable, coalesce(x, 'NA') AS level, x IS NULL AS missing, count(*) AS n FROM (SELECT 'sex' AS variable, sex AS x FROM customers UNION ALL SELECT 'area', area FROM customers UNION ALL SELECT 'nation', nation FROM customers) GROUP BY 1, 2, 3", **C)
def _(v: Views):
    return describe.category_counts(customers(v), CUSTOMER_CATEGORIES)


BINS = "SELECT variable, x, min(x) OVER w AS lo, (max(x) OVER w - min(x) OVER w) / 30 AS width FROM numbers WINDOW w AS (PARTITION BY variable)"


@query("histogram", "SELECT variable, bin, round(min(lo) + bin * min(width), 6) AS low, round(min(lo) + (bin + 1) * min(width), 6) AS high, count(*) AS n FROM (SELECT variable, CAST(least(floor((x - lo) / width), 29) AS INTEGER) AS bin, lo, width FROM bins) GROUP BY 1, 2", **C, bins=BINS)
def _(v: Views):
    return rounded(describe.histogram(customers(v), CUSTOMER_NUMBERS), "low", "high")


def _quantiles_sql(by: str) -> str:
    ends = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}
    return f"SELECT variable, {by} AS grp, " + ", ".join(f"round(quantile_cont(x, {p}), 6) AS {c}" for c, p in ends.items()) + " FROM numbers GROUP BY 1, 2"


@query("box_summary", _quantiles_sql("grp"), **C)
def _(v: Views):
    return rounded(describe.box_summary(customers(v), CUSTOMER_NUMBERS, "grp"), "low", "q1", "median", "q3", "high")


@query("exact_quantiles", "SELECT '' AS grp, variable, CAST(prob AS DOUBLE) AS prob, round(CASE prob WHEN 0.01 THEN a ELSE b END, 6) AS value FROM (SELECT variable, quantile_cont(x, 0.01) AS a, quantile_cont(x, 0.9) AS b FROM (SELECT 'l_extendedprice' AS variable, l_extendedprice AS x FROM lineitem UNION ALL SELECT 'l_quantity', l_quantity FROM lineitem) GROUP BY 1) JOIN (SELECT unnest([0.01, 0.9]) AS prob) ON TRUE")
def _(v: Views):
    rows = v.table("lineitem").select("l_extendedprice", "l_quantity")
    return rounded(describe.exact_quantiles(rows, ["l_extendedprice", "l_quantity"], (0.01, 0.9), accuracy=1000), "value")


PROFILED = "SELECT grp, c_acctbal, age, sex, area FROM customers"
_P = {"grp": "VARCHAR", "c_acctbal": "DOUBLE", "age": "DOUBLE", "sex": "VARCHAR", "area": "VARCHAR"}
PROFILE_LONG = " UNION ALL ".join(f"SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS level FROM customers" for c in _P)
PROFILE_COUNTS = "SELECT variable, level, count(*) AS n FROM profile_long GROUP BY 1, 2"
PROFILE = """SELECT b.variable, CASE WHEN b.variable IN ('c_acctbal', 'age') THEN 'double' ELSE 'factor' END AS kind, CAST(rows AS BIGINT) AS rows, CAST(missing AS BIGINT) AS missing,
    round(missing * 100.0 / rows, 6) AS missing_percent, distinct_values, mode_count, rare_levels, minimum, q1, median, q3, maximum,
    CAST(coalesce(outliers, 0) AS BIGINT) AS outliers, CAST(coalesce(outlier_values, 0) AS BIGINT) AS outlier_values
    FROM (SELECT variable, sum(n) AS rows, sum(CASE WHEN level IS NULL THEN n ELSE 0 END) AS missing, count(level) AS distinct_values, max(CASE WHEN level IS NOT NULL THEN n END) AS mode_count,
        coalesce(string_agg(CASE WHEN level IS NOT NULL AND n < 250 AND variable NOT IN ('c_acctbal', 'age') THEN level END, ',' ORDER BY level), '') AS rare_levels FROM profile_counts GROUP BY 1) b
    LEFT JOIN five ON b.variable = five.variable
    LEFT JOIN (SELECT n.variable, count(*) AS outliers, count(DISTINCT x) AS outlier_values FROM numbers n JOIN five USING (variable) WHERE x < raw1 - 1.5 * (raw3 - raw1) OR x > raw3 + 1.5 * (raw3 - raw1) GROUP BY 1) o ON b.variable = o.variable"""
FIVE = "SELECT variable, min(x) AS minimum, round(quantile_cont(x, 0.25), 6) AS q1, round(quantile_cont(x, 0.5), 6) AS median, round(quantile_cont(x, 0.75), 6) AS q3, max(x) AS maximum, quantile_cont(x, 0.25) AS raw1, quantile_cont(x, 0.75) AS raw3 FROM numbers GROUP BY 1"


@query("profile_columns", PROFILE, **C, profile_long=PROFILE_LONG, profile_counts=PROFILE_COUNTS, five=FIVE)
def _(v: Views):
    rows = describe.profile_columns(customers(v).drop("nation"), rare=250).drop("mode")
    return rounded(rows, "missing_percent", "minimum", "q1", "median", "q3", "maximum")


PROFILE_MODES = PROFILE.replace("distinct_values, mode_count,", "distinct_values, mode, mode_count,").replace(
    "coalesce(string_agg(", "first(level ORDER BY n DESC, level DESC) FILTER (WHERE level IS NOT NULL) AS mode, coalesce(string_agg(")
# The 25 nations are too many for a factor.
PROFILE_MODES = PROFILE_MODES.replace("ELSE 'factor' END", "WHEN b.variable = 'nation' THEN 'string' ELSE 'factor' END").replace("NOT IN ('c_acctbal', 'age')", "NOT IN ('c_acctbal', 'age', 'nation')")
PROFILE_LONG_ALL = PROFILE_LONG + " UNION ALL SELECT 'nation', nation FROM customers"


@query("profile_columns_modes", PROFILE_MODES, **C, profile_long=PROFILE_LONG_ALL, profile_counts=PROFILE_COUNTS, five=FIVE)
def _(v: Views):
    """Every column, and the mode: the level with most rows, the last by text among equals."""
    return rounded(describe.profile_columns(customers(v), rare=250), "missing_percent", "minimum", "q1", "median", "q3", "maximum")


def _effect_rows(v: Views) -> DataFrame:
    """High price by order status, with the priority as the only covariate."""
    return v.table("orders").selectExpr(
        "CAST(o_totalprice > 250000 AS INT) AS y", "CAST(o_orderstatus = 'F' AS INT) AS a", "o_orderpriority AS w"
    )


# With one categorical covariate the targeted estimate equals the standardised share, whatever the first models.
def _standardised(cell: str) -> str:
    return f"""SELECT sum(n * p1) / sum(n) AS p1, sum(n * p0) / sum(n) AS p0, CAST(sum(n) AS BIGINT) AS n FROM (SELECT {cell} AS cell, count(*) AS n,
    avg(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice > 250000 AS INTEGER) END) AS p1, avg(CASE WHEN o_orderstatus <> 'F' THEN CAST(o_totalprice > 250000 AS INTEGER) END) AS p0
    FROM orders GROUP BY 1)"""


EFFECTS = """SELECT 'risk difference' AS estimand, round(p1 - p0, 5) AS estimate, n FROM standardised UNION ALL SELECT 'relative risk', round(p1 / p0, 5), n FROM standardised
    UNION ALL SELECT 'odds ratio', round(p1 * (1 - p0) / (p0 * (1 - p1)), 5), n FROM standardised"""


@query("tmle_binary", EFFECTS, standardised=_standardised("o_orderpriority"))
def _(v: Views):
    result = tmle.tmle_binary(_effect_rows(v), "y", "a", categorical=["w"])
    return rounded(result.select("estimand", "estimate", "n"), "estimate", digits=5)


@query("tmle_binary_covariates", EFFECTS, standardised=_standardised("o_orderpriority || ':' || CAST(o_custkey % 2 AS VARCHAR)"))
def _(v: Views):
    """Two covariates crossed into one factor, and the treatments given by name."""
    rows = v.table("orders").selectExpr(
        "CAST(o_totalprice > 250000 AS INT) AS y", "CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS a",
        "concat(o_orderpriority, ':', o_custkey % 2) AS w",
    )
    result = tmle.tmle_binary(rows, "y", "a", categorical=["w"], treatments=("open", "closed"))
    return rounded(result.select("estimand", "estimate", "n"), "estimate", digits=5)

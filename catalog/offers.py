"""Price ladder, profit and bundle queries.

Demand parameters come from the daily series by rules simple enough to repeat in SQL.
"""

from __future__ import annotations

from datetime import timedelta
from functools import partial, reduce

from pyspark.sql import DataFrame, functions as F

from catalog.demand import EDGES, coarse_edges
from catalog.elasticity import coarse_series
from catalog.registry import query, r
from catalog.views import PAIRS, item_flags, with_views
from comboscope.functions.storage import written
from comboscope.operators import combos, correlation, pricing, series
from comboscope.operators.demand import demand_model
from comboscope.plans.offers import plan_offers

START, END = "2025-04-01", "2025-10-01"

PARAMS = EDGES + """
    , par AS (SELECT product_desc, AVG(quantity_sold) AS q, ROUND(AVG(price), 2) AS retail, ROUND(0.80 * ROUND(AVG(price), 2), 2) AS cost
        FROM series_coarse GROUP BY 1),
    past AS (SELECT product_desc, price, ROW_NUMBER() OVER (PARTITION BY product_desc ORDER BY business_date DESC) AS back FROM series_coarse),
    steps AS (SELECT product_desc, cost, retail, CAST(g.range AS INTEGER) AS k, round_even(retail * pow(0.98, g.range) * 100, 0) / 100 AS price
        FROM par, range(0, 100) g WHERE retail * pow(0.98, g.range) > cost),
    ladder AS (SELECT product_desc, cost, k, price FROM (SELECT *, MAX(k) OVER (PARTITION BY product_desc) AS top FROM steps)
        WHERE NOT (k = top AND price <= cost)),
    reg AS (SELECT product_desc, price AS regular FROM ladder WHERE k = 0),
    crossed AS (SELECT e.product_desc, SUM(0.01 * p.q / o.retail * g.regular) AS c FROM edges e JOIN par p ON p.product_desc = e.product_desc
        JOIN par o ON o.product_desc = e.other JOIN reg g ON g.product_desc = e.other GROUP BY 1),
    season AS (SELECT product_desc, MONTH(business_date) AS m, AVG(quantity_sold) AS qm FROM series_coarse GROUP BY 1, 2),
    days AS (SELECT CAST(g.generate_series AS DATE) AS ds, datediff('day', DATE '2025-04-01', CAST(g.generate_series AS DATE)) AS t
        FROM generate_series(DATE '2025-04-01', DATE '2025-10-01', INTERVAL 1 DAY) g),
    base AS (SELECT p.product_desc, ds, t, 1.5 * q + 0.01 * q * MONTH(ds) + 0.1 * q / retail * COALESCE(CASE WHEN t < 3 THEN past.price END, regular)
            + COALESCE(c, 0) + (qm - q) AS base, -0.5 * q / retail AS slope
        FROM par p JOIN reg USING (product_desc) LEFT JOIN crossed USING (product_desc) CROSS JOIN days
        JOIN season ON season.product_desc = p.product_desc AND season.m = MONTH(ds)
        LEFT JOIN past ON past.product_desc = p.product_desc AND past.back = 3 - t),
    daily AS (SELECT b.product_desc, ds, t, k, price, base + slope * price AS sales, (price - cost) * (base + slope * price) AS profit
        FROM base b JOIN ladder USING (product_desc))"""


def parameters(sales):
    stats = sales.groupBy("product_desc").agg(F.avg("quantity_sold").alias("q"), F.round(F.avg("price"), 2).alias("retail_price"))
    costs = stats.withColumn("product_cost", F.round(F.col("retail_price") * 0.80, 2))
    return stats, pricing.product_parameters(sales, costs)


def demand_tables(sales, stats, edges):
    """Coefficients and time component standing in for a fitted demand model."""
    q, p = F.col("q"), F.col("retail_price")
    own = stats.select("product_desc", F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), v.alias("coef")) for f, v in (
            ("const", 1.5 * q), ("price", -0.5 * q / p), ("month", 0.01 * q), ("price_lag_3", 0.1 * q / p))])))
    other = stats.select(F.col("product_desc").alias("other"), F.col("retail_price").alias("_other"))
    cross = edges.join(stats, "product_desc").join(other, "other").select(
        "product_desc", F.concat("other", F.lit("_price")).alias("feature"), (0.01 * q / F.col("_other")).alias("coef"))
    by_month = sales.groupBy("product_desc", F.month("business_date").alias("m")).agg(F.avg("quantity_sold").alias("qm"))
    days = series.calendar(sales.sparkSession, START, END).withColumn("m", F.month("ds"))
    time = by_month.join(stats, "product_desc").join(days, "m").select("product_desc", "ds", (F.col("qm") - q).alias("yhat"))
    return own.unionByName(cross), time


def offer_inputs(spark, sf):
    sales = written(coarse_series(spark, sf), "sales")
    stats, params = parameters(sales)
    stats, params = written(stats, "stats"), written(params, "params")
    ladder = written(pricing.price_ladder(params), "ladder")
    pairs, cut = correlation.strongest_quantity_pairs(sales, 0.75, min_abs=0.04)
    coefs, time = demand_tables(sales, stats, correlation.correlated_products(pairs, 0.04))
    base = pricing.base_sales(params, ladder, coefs, time, START, END)
    return sales, params, ladder, (pairs, cut), base


@query("product_parameters", with_views("items series_coarse", PARAMS + """
    SELECT product_desc, ROUND(cost, 2) AS cost, ROUND(retail, 2) AS retail_price, ROUND(a.price, 6) AS past_1, ROUND(b.price, 6) AS past_2,
        ROUND(c.price, 6) AS past_3 FROM par JOIN past a USING (product_desc) JOIN past b USING (product_desc) JOIN past c USING (product_desc)
    WHERE a.back = 3 AND b.back = 2 AND c.back = 1"""))
def product_parameters(spark, sf):
    _, params = parameters(coarse_series(spark, sf))
    return params.select("product_desc", r("cost", 2), r("retail_price", 2),
                         *[r(F.col("past_price")[i]).alias(f"past_{i + 1}") for i in range(3)])


@query("price_ladder", with_views("items series_coarse", PARAMS + "SELECT product_desc, k, price FROM ladder"))
def price_ladder(spark, sf):
    return pricing.price_ladder(parameters(coarse_series(spark, sf))[1])


@query("profit_daily", with_views("items series_coarse", PARAMS + """
    SELECT product_desc, ds, k, price, ROUND(sales, 5) AS sales, ROUND(profit, 3) AS profit FROM daily"""))
def profit_daily(spark, sf):
    _, _, ladder, _, base = offer_inputs(spark, sf)
    return pricing.daily_profit(base, ladder).withColumn("sales", r("sales", 5)).withColumn("profit", r("profit", 3))


MONTHLY = PARAMS + """
    , profits AS (SELECT product_desc, MONTH(ds) AS period, k, ANY_VALUE(price) AS price, SUM(profit) AS profit FROM daily GROUP BY 1, 2, 3)"""
BLOCKS = PARAMS + """
    , profits AS (SELECT product_desc, t // 30 AS period, k, ANY_VALUE(price) AS price, SUM(profit) AS profit FROM daily GROUP BY 1, 2, 3)"""
DAYS = PARAMS + """
    , profits AS (SELECT product_desc, t AS period, k, price, profit FROM daily)"""


@query("profit_monthly", with_views("items series_coarse", MONTHLY + """
    SELECT product_desc, period, k, price, ROUND(profit, 2) AS profit FROM profits"""))
def profit_monthly(spark, sf):
    _, _, ladder, _, base = offer_inputs(spark, sf)
    return pricing.monthly_profit(base, ladder).withColumn("profit", r("profit", 2))


FLAGS = """
    , flags AS (SELECT product_desc, CAST(b % 3 = 0 AS INTEGER) AS food, CAST(b % 3 = 1 AS INTEGER) AS bev, b % 5 AS cat, 'M' || (b % 6) AS man
        FROM (SELECT product_desc, CAST(split_part(product_desc, '#', 2) AS INTEGER) AS b FROM par)),
    valid AS (SELECT CASE WHEN a.food = 1 THEN item_a ELSE item_b END AS food, CASE WHEN a.food = 1 THEN item_b ELSE item_a END AS other, corr
        FROM pairs JOIN flags a ON a.product_desc = item_a JOIN flags b ON b.product_desc = item_b
        WHERE corr >= (SELECT quantile_cont(corr, 0.75) FROM pairs) AND a.food <> b.food)"""


@query("valid_pairs", with_views("items series_coarse", PARAMS + FLAGS + """
    SELECT food, other, ROUND(corr, 9) AS corr FROM valid"""))
def valid_pairs(spark, sf):
    sales = coarse_series(spark, sf)
    flags = item_flags(sales.select("product_desc").distinct())
    pairs, cut = correlation.strongest_quantity_pairs(sales)
    return combos.valid_pairs(pairs, flags, cut=cut).withColumn("corr", r("corr", 9))


def _clash(a: str, b: str) -> str:
    return " OR ".join(f"({a}.man IN ('{m}', '{n}') AND {b}.man IN ('{m}', '{n}'))" for m, n in PAIRS)


def bundle_sql(low: int, high: int, any_food: bool = False, used: str | None = None, tag: str = "") -> str:
    """Enumerates every bundle of every period over the two price choices of each item."""
    reuse = f"CAST(product_desc IN (SELECT product_desc FROM {used}) AS INTEGER)" if used else "0"
    out = f"""
    , scale{tag} AS (SELECT (SELECT SUM(b) FROM (SELECT MAX(profit) AS b FROM profits GROUP BY product_desc, period))
        / ((SELECT COUNT(DISTINCT period) FROM profits) * {high * (high - 1) / 2} * (SELECT MAX(corr) FROM pairs)) AS s),
    opt{tag} AS (SELECT period, product_desc AS item, food, bev, cat, man, k, price, profit, CAST(k > 0 AS INTEGER) AS flag, {reuse} AS reused
        FROM profits JOIN flags USING (product_desc)
        QUALIFY ROW_NUMBER() OVER (PARTITION BY period, product_desc, k > 0 ORDER BY profit DESC, k) = 1)"""
    tables = []
    for size in range(2, high + 1):
        al = ["f"] + [f"n{i}" for i in range(1, size)]
        if any_food:
            joins = f"FROM opt{tag} f JOIN opt{tag} n1 ON n1.period = f.period AND f.item < n1.item AND f.food + n1.food >= 1 AND f.cat <> n1.cat"
            pairs_on = " LEFT JOIN valid v1 ON (v1.food = f.item AND v1.other = n1.item) OR (v1.food = n1.item AND v1.other = f.item)"
            where = "WHERE f.flag + n1.flag >= 1"
        else:
            joins = f"FROM opt{tag} f"
            for i in range(1, size):
                me, before = f"n{i}", al[:i]
                cond = [f"{me}.period = f.period", f"{me}.food = 0"]
                cond += [f"{me}.cat <> {b}.cat AND NOT ({_clash(me, b)})" for b in before]
                if i > 1:
                    cond.append(f"{me}.item > n{i - 1}.item")
                joins += f" JOIN opt{tag} {me} ON " + " AND ".join(cond)
            pairs_on = "".join(f" LEFT JOIN valid v{i} ON v{i}.food = f.item AND v{i}.other = n{i}.item" for i in range(1, size))
            where = (f"WHERE f.food = 1 AND {' + '.join(a + '.flag' for a in al)} >= 1 AND {' + '.join(a + '.bev' for a in al)} <= 2 "
                     f"AND {' + '.join(a + '.reused' for a in al)} <= 1")
        corr = " + ".join(f"COALESCE(v{i}.corr, 0)" for i in range(1, size))
        n = " + ".join(f"CAST(v{i}.corr IS NOT NULL AS INTEGER)" for i in range(1, size))
        members = ", ".join(f"{{'item': {a}.item, 'k': {a}.k, 'price': {a}.price}}" for a in al)
        if size >= low:
            tables.append(f"""SELECT f.period, {' + '.join(a + '.profit' for a in al)} AS profit, {corr} AS corr, {n} AS n,
            [{members}] AS members {joins} {pairs_on} {where}""")
    return out + f""",
    cand{tag} AS ({' UNION ALL '.join(tables)}),
    win{tag} AS (SELECT *, 0.6 * profit + 0.4 * s * corr AS score FROM cand{tag}, scale{tag} QUALIFY
        ROW_NUMBER() OVER (PARTITION BY period ORDER BY 0.6 * profit + 0.4 * s * corr DESC) = 1),
    sol{tag} AS (SELECT period, score, m.item AS product_desc, m.k AS price_level_index, m.price AS price_selected
        FROM (SELECT period, score, unnest(members) AS m FROM win{tag} WHERE score >= 0))"""


SOLUTION = "SELECT CAST(period AS INTEGER) AS period, product_desc, price_selected, price_level_index, ROUND(score, 1) AS score FROM sol"


def monthly_inputs(spark, sf, profit="month"):
    sales, params, ladder, pairs, base = offer_inputs(spark, sf)
    if profit == "month":
        profits = pricing.monthly_profit(base, ladder)
    elif profit == "block30":
        profits = pricing.block_profit(base, ladder, START)
    else:
        daily = pricing.daily_profit(base, ladder)
        profits = daily.select("product_desc", F.datediff("ds", F.lit(START)).alias("period"), "k", "price", "profit")
    flags = item_flags(params.select("product_desc"))
    return params, written(profits, "profits"), pairs, flags


def solve(inputs, rules, used=None):
    _, profits, (pairs, cut), flags = inputs
    table = combos.item_table(flags, flags.select("product_desc", "category_desc"), rules, used)
    scale = pricing.objective_scale(profits, pairs, rules.max_size)
    return written(combos.best_bundles(profits, table, combos.valid_pairs(pairs, flags, cut=cut), scale, rules), "bundles")


def solution(bundles):
    score = bundles.select("period", F.round("score", 1).alias("score"))
    return combos.in_offer_order(combos.solution_table(bundles).join(score, "period").select(
        "period", "product_desc", "price_selected", "price_level_index", "score"))


def rules_for(low, high):
    return combos.Rules(min_size=low, max_size=high, competing=PAIRS)


DAY_RULES = combos.Rules(one_food=False, max_beverages=None, competing=[])


def combo(spark, sf, low, high):
    return solution(solve(monthly_inputs(spark, sf), rules_for(low, high)))


for _name, _low, _high in (("combo_2", 2, 2), ("combo_3", 2, 3), ("combo_4", 2, 4)):
    query(_name, with_views("items series_coarse", MONTHLY + FLAGS + bundle_sql(_low, _high) + SOLUTION))(
        partial(combo, low=_low, high=_high))


@query("combo_2_alt", with_views("items series_coarse", MONTHLY + FLAGS + bundle_sql(2, 2) + bundle_sql(2, 2, used="sol", tag="2")
       + SOLUTION.replace("FROM sol", "FROM sol2")))
def combo_2_alt(spark, sf):
    inputs = monthly_inputs(spark, sf)
    first = combos.solution_table(solve(inputs, rules_for(2, 2)))
    return solution(solve(inputs, rules_for(2, 2), first))


@query("combo_day", with_views("items series_coarse", DAYS + FLAGS + bundle_sql(2, 2, any_food=True) + SOLUTION))
def combo_day(spark, sf):
    return solution(solve(monthly_inputs(spark, sf, "day"), DAY_RULES))


@query("combo_block30", with_views("items series_coarse", BLOCKS + FLAGS + bundle_sql(2, 2, any_food=True) + """
    SELECT ds, product_desc, price_selected, price_level_index FROM sol JOIN days ON days.t // 30 = period"""))
def combo_block30(spark, sf):
    bundles = solve(monthly_inputs(spark, sf, "block30"), DAY_RULES)
    out = combos.expand_blocks(combos.solution_table(bundles), START, END)
    return out.select("ds", "product_desc", "price_selected", "price_level_index")


@query("combo_metrics", with_views("items series_coarse", MONTHLY + FLAGS + bundle_sql(2, 3) + """
    SELECT ROUND(SUM(profit) / 3, 1) AS realized_profit, ROUND(SUM(corr) / SUM(n), 8) AS average_corr, ROUND(SUM(score), 1) AS objective
    FROM win WHERE score >= 0"""))
def combo_metrics(spark, sf):
    out = combos.bundle_metrics(solve(monthly_inputs(spark, sf), rules_for(2, 3)), 3)
    return out.select(r("realized_profit", 1), r("average_corr", 8), r("objective", 1))


@query("combo_blocks", with_views("items series_coarse", MONTHLY + FLAGS + bundle_sql(2, 3) + """
    , runs AS (SELECT *, period - ROW_NUMBER() OVER (PARTITION BY product_desc ORDER BY period) AS run FROM sol)
    SELECT product_desc, monthname(make_date(2025, MIN(period), 1)) || ' - ' || monthname(make_date(2025, MAX(period), 1)) AS time_frame,
        """ + ", ".join(f'COALESCE(MAX(CASE WHEN period = {m} THEN price_selected END), 0) AS "{n}"' for m, n in zip(
            range(4, 11), ["April", "May", "June", "July", "August", "September", "October"])) + """
    FROM runs GROUP BY product_desc, run"""))
def combo_blocks(spark, sf):
    return combos.offer_blocks(combos.solution_table(solve(monthly_inputs(spark, sf), rules_for(2, 3))))


@query("combo_report", with_views("items series_coarse", MONTHLY + FLAGS + bundle_sql(2, 4) + """
    , o AS (SELECT period, string_agg(product_desc, ';' ORDER BY product_desc) AS combo_items,
        string_agg(CAST(CAST(price_selected AS DECIMAL(18, 2)) AS VARCHAR), ';' ORDER BY product_desc) AS combo_prices,
        string_agg(CAST(CAST(cost AS DECIMAL(18, 2)) AS VARCHAR), ';' ORDER BY product_desc) AS costs
        FROM sol JOIN par USING (product_desc) GROUP BY 1)
    SELECT monthname(make_date(2025, CAST(g.range AS INTEGER), 1)) AS month, COALESCE(combo_items, '') AS combo_items,
        COALESCE(combo_prices, '') AS combo_prices, COALESCE(costs, '') AS costs FROM range(4, 11) g LEFT JOIN o ON o.period = g.range"""))
def combo_report(spark, sf):
    inputs = monthly_inputs(spark, sf)
    blocks = combos.offer_blocks(combos.solution_table(solve(inputs, rules_for(2, 4))))
    out = combos.monthly_offers(blocks, inputs[0])

    def joined(name):
        return F.array_join(F.transform(name, lambda v: v.cast("decimal(18,2)").cast("string")), ";").alias(name)

    return out.select("month", F.array_join("combo_items", ";").alias("combo_items"), joined("combo_prices"), joined("costs"))


RUNS = {"two_items_combo1": "sol", "two_items_combo2": "sol2", "three_items_combo": "sol3", "four_items_combo": "sol4"}


def runs_of(plan):
    """The four runs' solutions as one table."""
    parts = [plan[f"{name}_raw"].select(F.lit(name).alias("run"), "period", "product_desc", "price_selected", "price_level_index") for name in RUNS]
    return reduce(DataFrame.unionByName, parts)


@query("offer_runs", with_views("items series_coarse", MONTHLY + FLAGS + bundle_sql(2, 2) + bundle_sql(2, 2, used="sol", tag="2") + bundle_sql(2, 3, tag="3")
       + bundle_sql(2, 4, tag="4") + " UNION ALL ".join(
           f"SELECT '{run}' AS run, CAST(period AS INTEGER) AS period, product_desc, price_selected, price_level_index FROM {sol}" for run, sol in RUNS.items())))
def offer_runs(spark, sf):
    sales = written(coarse_series(spark, sf), "sales")
    stats, params = parameters(sales)
    stats, params = written(stats, "stats"), written(params, "params")
    pairs, cut = correlation.strongest_quantity_pairs(sales, 0.75, min_abs=0.04)
    coefs, time = demand_tables(sales, stats, correlation.correlated_products(pairs, 0.04))
    flags = item_flags(params.select("product_desc"))
    return runs_of(plan_offers(params, coefs, time, pairs, flags, flags.select("product_desc", "category_desc"), combos.Rules(competing=PAIRS), START, END, cut=cut))


def fitted_offers(sales, days: int = 184):
    """Sales to offers: the demand fitted to ``sales`` gives the profits of the ``days`` after the last day."""
    sales = written(sales, "sales")
    _, params = parameters(sales)
    params = written(params, "params")
    pairs, cut = correlation.strongest_quantity_pairs(sales, 0.75, min_abs=0.04)
    last, earliest = sales.groupBy("product_desc").agg(F.max("business_date").alias("end")).agg(F.max("end"), F.min("end")).first()
    fitted = demand_model(sales, correlation.correlated_products(pairs, 0.04), steps=days + (last - earliest).days)
    coefs, time = written(fitted["coefs"].select("product_desc", "feature", "coef"), "coefs"), fitted["time"].where("future")
    flags = item_flags(params.select("product_desc"))
    window = [str(last + timedelta(days=d)) for d in (1, days)]
    plan = plan_offers(params, coefs, time, pairs, flags, flags.select("product_desc", "category_desc"), combos.Rules(competing=PAIRS), *window, cut=cut)
    return plan, params, coefs, time


@query("fitted_offer_runs")
def fitted_offer_runs(spark, sf):
    return runs_of(fitted_offers(coarse_series(spark, sf))[0])

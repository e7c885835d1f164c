import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from comboscope.operators import combos, pricing


def _params(spark, rows):
    return spark.createDataFrame(rows, "product_desc string, cost double, retail_price double, past_price array<double>")


def test_ladders(spark):
    params = _params(spark, [("nine", 9.0, 10.0, [1.0, 2.0, 3.0]), ("dear", 10.0, 10.0, []), ("none", None, 5.0, []), ("milk", 1.0, 4.0, [])])
    ladder = pricing.price_ladder(params, floors={"milk": 3.7}).orderBy("product_desc", "k").collect()
    got = {}
    for r in ladder:
        got.setdefault(r.product_desc, []).append(r.price)
    assert got["nine"] == [10.0, 9.8, 9.6, 9.41, 9.22, 9.04]
    # the floor only removes one last price
    want = [round(4 * 0.98**k, 2) for k in range(200) if 4 * 0.98**k > 1]
    assert got["milk"] == want[:-1]
    assert set(got) == {"nine", "milk"}
    assert sorted(r.product_desc for r in pricing.without_ladder(params, pricing.price_ladder(params)).collect()) == ["dear", "none"]


def test_parameter_fallbacks(spark, rows):
    sales = spark.createDataFrame([(p, dt.date(2024, 1, d), float(d)) for p in ("a", "b", "c") for d in range(1, 6)], "product_desc string, business_date date, price double")
    costs = spark.createDataFrame([("a", 1.0, 9.0), ("b", 2.0, 8.0)], "product_desc string, product_cost double, retail_price double")
    over = spark.createDataFrame([("b", 2.5), ("c", 3.5)], "product_desc string, product_cost double")
    got = pricing.product_parameters(sales, costs, over, {"a": 10.99})
    assert rows(got, "product_desc", "cost", "retail_price") == [("a", 1.0, 10.99), ("b", 2.5, 8.0), ("c", 3.5, 5.0)]
    assert got.first().past_price == [3.0, 4.0, 5.0]


def test_profit_by_hand_and_monthly_shortcut(spark):
    params = _params(spark, [("a", 9.0, 10.0, [7.0, 8.0, 9.0]), ("b", 4.0, 5.0, [1.0])])
    ladder = pricing.price_ladder(params)
    coefs = spark.createDataFrame([("a", "const", 50.0), ("a", "price", -2.0), ("a", "price_lag_3", 1.0), ("a", "b_price", 3.0), ("a", "month", 0.5),
                                   ("a", "gone_price", 99.0), ("b", "const", 7.0)], "product_desc string, feature string, coef double")
    days = [dt.date(2025, 4, 1) + dt.timedelta(days=i) for i in range(40)]
    time = spark.createDataFrame([(p, d, float(i)) for p in "ab" for i, d in enumerate(days)], "product_desc string, ds date, yhat double")
    base = pricing.base_sales(params, ladder, coefs, time, "2025-04-01", "2025-05-05")
    daily = pricing.daily_profit(base, ladder)
    r = daily.where("product_desc = 'a' and ds = '2025-04-02' and k = 1").first()
    assert r.sales == pytest.approx(50 - 2 * 9.8 + 8.0 + 3 * 5.0 + 0.5 * 4 + 1) and r.profit == pytest.approx(0.8 * r.sales)
    r = daily.where("product_desc = 'a' and ds = '2025-04-04' and k = 0").first()
    assert r.sales == pytest.approx(50 - 20 + 10 + 15 + 2 + 3)
    assert daily.where("ds > '2025-05-05'").count() == 0
    slow = {(r.product_desc, r.m, r.k): r.p for r in daily.groupBy("product_desc", F.month("ds").alias("m"), "k").agg(F.sum("profit").alias("p")).collect()}
    fast = {(r.product_desc, r.period, r.k): r.profit for r in pricing.monthly_profit(base, ladder).collect()}
    assert fast == pytest.approx(slow) and len(fast) == len(slow) > 0


def _instance(seed, n=8, periods=2, levels=3, negative=False, multi=False):
    rng = np.random.default_rng(seed)
    names = [f"p{i}" for i in range(n)]
    food = [int(i % 3 == 0) for i in range(n)]
    bev = [int(i % 3 == 1) for i in range(n)]
    man = [["X", "Y", "Z", "W", None][rng.integers(5)] for _ in range(n)]
    cats = []
    for _ in range(n):
        c = {f"c{rng.integers(5)}"}
        if multi and rng.random() < 0.4:
            c.add(f"c{rng.integers(5)}")
        if rng.random() < 0.15:
            c = set()
        cats.append(c)
    shift = -150 if seed % 5 == 4 else 20
    profit = {(i, t, k): float(rng.normal(shift, 60)) for i in range(n) for t in range(periods) for k in range(1 + rng.integers(levels))}
    lo, hi = (-0.9, 0.2) if negative else (-0.3, 0.9)
    corr = {(i, j): float(rng.uniform(lo, hi)) for i in range(n) for j in range(i + 1, n)}
    return names, food, bev, man, cats, profit, corr, periods


PAIRS = [("X", "Y"), ("Z", "X")]


def _frames(spark, inst):
    names, food, bev, man, cats, profit, corr, _ = inst
    profits = spark.createDataFrame([(names[i], t, k, 10.0 - k, v) for (i, t, k), v in profit.items()], "product_desc string, period int, k int, price double, profit double")
    pairs = spark.createDataFrame([(names[i], names[j], c) for (i, j), c in corr.items()], "item_a string, item_b string, corr double")
    flags = spark.createDataFrame([(names[i], food[i], bev[i], man[i]) for i in range(len(names))], "product_desc string, is_food int, is_beverage int, manufacturer string")
    categories = spark.createDataFrame([(names[i], c) for i in range(len(names)) for c in (cats[i] or {None})], "product_desc string, category_desc string")
    return profits, pairs, flags, categories


def _brute(inst, low, high, scale, used=(), alpha=0.6, day=False):
    names, food, bev, man, cats, profit, corr, periods = inst
    cut = np.percentile(list(corr.values()), 75)
    out = {}
    for t in range(periods):
        best = None
        for size in range(low, high + 1):
            for s in itertools.combinations(range(len(names)), size):
                foods = sum(food[i] for i in s)
                if (foods < 1) if day else (foods != 1 or sum(bev[i] for i in s) > 2):
                    continue
                if any(cats[i] & cats[j] for i, j in itertools.combinations(s, 2)):
                    continue
                if not day and any(sum(man[i] in p for i in s) > 1 for p in PAIRS):
                    continue
                if sum(names[i] in used for i in s) > 1:
                    continue
                aff = sum(corr[i, j] for i, j in itertools.combinations(s, 2) if corr[i, j] >= cut and food[i] != food[j])
                for ks in itertools.product(*[[k for k in range(9) if (i, t, k) in profit] for i in s]):
                    if max(ks) == 0:
                        continue
                    score = alpha * sum(profit[i, t, k] for i, k in zip(s, ks)) + (1 - alpha) * scale * aff
                    if best is None or score > best[0]:
                        best = (score, [names[i] for i in s])
        if best and best[0] >= 0:
            out[t] = best
    return out


def _check(got, want):
    assert sorted(got) == sorted(want)
    for t, (score, items) in want.items():
        assert got[t].score == pytest.approx(score) and got[t]["items"] == items


@pytest.mark.parametrize("seed,low,high,negative,multi", [
    (2, 2, 4, False, False), (4, 2, 3, False, False), (3, 2, 4, True, True), (8, 3, 4, False, True)])
def test_best_bundles_match_exhaustive_search(spark, seed, low, high, negative, multi):
    inst = _instance(seed, n=10, negative=negative, multi=multi)
    profits, pairs, flags, categories = _frames(spark, inst)
    rules = combos.Rules(min_size=low, max_size=high, competing=PAIRS)
    valid = combos.valid_pairs(pairs, flags)
    got = {r.period: r for r in combos.best_bundles(profits, combos.item_table(flags, categories, rules), valid, 30.0, rules).collect()}
    want = _brute(inst, low, high, 30.0)
    _check(got, want)
    if seed == 2 and want:
        used = spark.createDataFrame([(n,) for r in got.values() for n in r["items"]], "product_desc string")
        again = combos.best_bundles(profits, combos.item_table(flags, categories, rules, used), valid, 30.0, rules).collect()
        _check({r.period: r for r in again}, _brute(inst, low, high, 30.0, used={n for r in got.values() for n in r["items"]}))


def test_day_rules_allow_two_foods(spark):
    inst = _instance(21, n=9)
    profits, pairs, flags, categories = _frames(spark, inst)
    rules = combos.Rules(one_food=False, max_beverages=None, competing=[])
    got = combos.best_bundles(profits, combos.item_table(flags, categories, rules), combos.valid_pairs(pairs, flags), 30.0, rules)
    _check({r.period: r for r in got.collect()}, _brute(inst, 2, 2, 30.0, day=True))


def test_rule_arguments():
    with pytest.raises(ValueError):
        combos.Rules(min_size=3, max_size=2)
    with pytest.raises(ValueError):
        combos.Rules(max_size=3, one_food=False)


def test_month_gaps_and_offers(spark, rows):
    sol = spark.createDataFrame([("a", m, float(m)) for m in (4, 5, 7, 8, 10)] + [("b", 4, 1.5)], "product_desc string, period int, price_selected double")
    blocks = combos.offer_blocks(sol)
    assert rows(blocks, "product_desc", "time_frame", "April", "May", "August") == [
        ("a", "April - May", 4.0, 5.0, 0.0), ("a", "July - August", 0.0, 0.0, 8.0), ("a", "October - October", 0.0, 0.0, 0.0),
        ("b", "April - April", 1.5, 0.0, 0.0)]
    costs = spark.createDataFrame([("a", 0.5)], "product_desc string, cost double")
    offers = {r.month: r for r in combos.monthly_offers(blocks, costs).collect()}
    assert len(offers) == 7 and offers["April"].combo_items == ["a", "b"] and offers["April"].costs == [0.5, None]
    assert offers["June"].combo_items == [] and offers["October"].combo_prices == [10.0]


def test_blocks_expand_to_days(spark):
    sol = spark.createDataFrame([("a", 0), ("b", 1)], "product_desc string, period int")
    days = combos.expand_blocks(sol, "2025-04-01", "2025-05-10", 30)
    assert {r[0]: r[1] for r in days.groupBy("product_desc").count().collect()} == {"a": 30, "b": 10}


def test_scale_and_zero_fill(spark):
    profits = spark.createDataFrame([("a", 4, 0, -5.0), ("b", 4, 0, 10.0), ("b", 4, 1, 20.0)], "product_desc string, period int, k int, profit double")
    pairs = spark.createDataFrame([("a", "b", 0.5)], "item_a string, item_b string, corr double")
    assert pricing.objective_scale(profits, pairs, 2) == pytest.approx(15 / 0.5)
    assert pricing.objective_scale(profits, pairs, 3, zero_fill=True) == pytest.approx(20 / (3 * 0.5))

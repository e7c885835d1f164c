"""The five analyses end to end on the smallest test tables."""

import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from catalog import views
from catalog.elasticity import labelled
from catalog.offers import demand_tables, fitted_offers, parameters, runs_of
from comboscope.operators import combos, series
from comboscope.plans import basket_mining, demand, elasticity, offers, survey
from comboscope.sources.sinks import write_report

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_basket_mining(spark):
    out = basket_mining.mine_baskets(
        views.headers(spark, SF), views.items(spark, SF), views.product(spark, SF), views.promotion(spark), views.site(spark, SF),
        key=["transaction_uid"], n_sites=20, min_support=0.01, min_threshold=1.0, excluded_categories=["CAT 0-C"], non_food=["ECONOMY"], dropped=["Brand#3"])
    assert out["sampled_sites"].count() == 20
    names = {r[0] for r in out["items"].collect()}
    assert names and "Brand#3" not in names and "Brand#5" not in names  # dropped item, excluded category
    assert out["rules"].where("lift < 1").count() == 0 and out["rules"].count() == out["rule_edges"].count() > 0


def test_demand_to_offers(spark, tmp_path):
    coarse, fine = (series.daily_series(views.items(spark, SF, d)) for d in ("coarse", "fine"))
    out = demand.plan_demand(coarse, fine, steps=30, corr_threshold=0.1, prefix="PROMO", names=["Brand#3"], jump_date="2001-08-01")
    products = {r[0] for r in out["series"].select("product_desc").distinct().collect()}
    assert "Brand#1" in products and "Brand#3" not in products
    assert out["time"].where("future").groupBy("product_desc").count().where("count != 30").count() == 0
    assert {r[0] for r in out["metrics"].select("product_desc").collect()} <= products

    brands = coarse.where(F.col("product_desc").startswith("Brand"))
    stats, params = parameters(brands)
    coefs, time = demand_tables(brands, stats, spark.createDataFrame([], "product_desc string, other string"))
    flags = views.item_flags(params.select("product_desc"))
    pairs = out["pairs"].where(F.col("item_a").startswith("Brand") & F.col("item_b").startswith("Brand"))
    plan = offers.plan_offers(params, coefs, time, pairs, flags, flags.select("product_desc", "category_desc"),
                              combos.Rules(competing=views.PAIRS))
    first, second = ({r[0] for r in plan[f"two_items_combo{i}_raw"].select("product_desc").collect()} for i in (1, 2))
    assert first and second
    for period, items in plan["two_items_combo2_raw"].groupBy("period").agg(F.collect_set("product_desc")).collect():
        assert len(set(items) & first) <= 1
    best = [plan[f"{n}_metrics"].first().objective for n in ("two_items_combo1", "two_items_combo2")]
    assert best[0] >= best[1]
    paths = write_report({k: plan[k] for k in ("two_items_combo1", "two_items_combo2", "three_items_combo", "four_items_combo")}, str(tmp_path / "r"))
    assert all(spark.read.parquet(p).count() == 7 for p in paths)


def test_fitted_demand_reaches_the_bundles(spark):
    sales = series.daily_series(views.items(spark, SF, "coarse"))
    plan, params, coefs, time = fitted_offers(sales, days=60)
    coef = {(r.product_desc, r.feature): r.coef for r in coefs.collect()}
    ladder = {}
    for r in plan["ladder"].collect():
        ladder.setdefault(r.product_desc, {})[r.k] = r.price
    par, days = {r.product_desc: r for r in params.collect()}, {}
    for r in time.orderBy("ds").collect():
        days.setdefault(r.product_desc, []).append((r.ds, r.yhat))
    want, last = {}, sales.agg(F.max("business_date")).first()[0]
    for p, prices in ladder.items():  # day by day and step by step, from the fitted coefficients
        b = lambda f: coef.get((p, f), 0.0)  # noqa: E731, B023
        cross = sum(b(f"{o}_price") * steps[0] for o, steps in ladder.items())
        window = [d for d in days[p] if d[0] > last]
        assert len(window) >= 60 and window[0][0] == last + timedelta(days=1)
        for t, (ds, yhat) in enumerate(window[:60]):
            lag = par[p].past_price[t] if t < 3 else prices[0]
            for k, price in prices.items():
                units = b("const") + b("year") * ds.year + b("month") * ds.month + b("price_lag_3") * lag + cross + yhat + b("price") * price
                want[p, ds.month, k] = want.get((p, ds.month, k), 0) + (price - par[p].cost) * units
    got = {(r.product_desc, r.period, r.k): r.profit for r in plan["profits"].collect()}
    assert got == pytest.approx(want, rel=1e-6, abs=1e-4) and len({p for p, f in coef if f == "price"}) > 20
    runs = runs_of(plan).collect()
    assert {r.run for r in runs} <= {"two_items_combo1", "two_items_combo2", "three_items_combo", "four_items_combo"}
    assert all(ladder[r.product_desc][r.price_level_index] == r.price_selected for r in runs)


def test_elasticity(spark):
    sales = labelled(spark, SF).drop("brand", "label", "category_desc")
    sheet = views.product(spark, SF).select(F.col("brand").alias("item_id"), F.col("item_desc").alias("product_desc"), "brand", "category_desc", "sub_category_desc")
    out = elasticity.plan_elasticity(sales, sheet, views.product(spark, SF), ["Brand#4"], [], ["CAT 1-C"], years=None, presence=0, threshold=0.1)
    got = out["categories"].collect()
    assert got and {r.label for r in got} == {"private", "national"} and "CAT_1" not in {r.category for r in got}


def test_survey(spark, tmp_path):
    raw = spark.createDataFrame(
        [(i, "Somewhat satisfied", "x" if i % 2 else None, "x", i % 11, (i * 3) % 11, "5-10", "Other text: vegan wraps please" if i % 3 else None) for i in range(40)],
        "ID int, Attention string, `R.GRILL` string, `LAY'S` string, `Rate 1.` int, rate2 int, band string, `Other, say` string")
    out = survey.plan_survey(raw, ["R.GRILL", "LAY'S"], ["Rate 1.", "rate2"], "band", ["Other, say"], drop=["ID"],
                             combos={"combo1_size2": ["R.GRILL", "LAY'S"], "combo2_size2": ["R.GRILL", "none"]}, stop_words=["please"])
    assert len(out) == 9
    assert {r.rating_column: r.total_responses for r in out["overall_nps"].collect()} == {"Rate 1.": 40, "rate2": 40}
    assert out["nlp_phrase_count"].agg(F.sum("total_count")).first()[0] == 52
    assert len(write_report(out, str(tmp_path / "survey"))) == 9

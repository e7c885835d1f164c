import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from comboscope.operators import demand, elasticity, linreg
from comboscope.operators.linreg import t_two_sided

FIRST = dt.date(2023, 1, 2)


def _frame(spark, x, y, group="g"):
    rows = [(group, *map(float, r), float(v)) for r, v in zip(x, y)]
    names = [f"x{i}" for i in range(x.shape[1])]
    return spark.createDataFrame(rows, f"g string, {', '.join(n + ' double' for n in names)}, y double"), names


def _coefs(df, names, **kw):
    fit = linreg.grouped_fit(df, ["g"], "y", names, **kw).first().fit
    return fit


def test_ols_is_exact_and_residuals_orthogonal(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(2000, 3, (40, 2))
    df, names = _frame(spark, x, 3 + 2 * x[:, 0] - x[:, 1])
    fit = _coefs(df, names)
    assert fit.intercept == pytest.approx(3, abs=1e-6) and fit.coef == pytest.approx([2, -1])
    noisy, names = _frame(spark, x, 3 + 2 * x[:, 0] - x[:, 1] + rng.normal(0, 1, 40))
    res = linreg.with_residuals(noisy, ["g"], "y", names).agg(
        F.sum("residuals"), F.sum(F.col("residuals") * F.col("x0")), F.sum(F.col("residuals") * F.col("x1"))).first()
    assert all(abs(v) < 1e-6 for v in res)


def test_statistics_against_direct_formula(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (25, 3))
    y = x @ [0.5, 0, -1] + rng.normal(0, 1, 25)
    df, names = _frame(spark, x, y)
    fit = _coefs(df, names)
    design = np.column_stack([np.ones(25), x])
    beta = np.linalg.lstsq(design, y, rcond=None)[0]
    rss = ((y - design @ beta) ** 2).sum()
    se = np.sqrt(rss / 21 * np.linalg.inv(design.T @ design).diagonal())
    assert [fit.intercept, *fit.coef] == pytest.approx(list(beta))
    assert fit.se == pytest.approx(list(se[1:])) and fit.rss == pytest.approx(rss) and fit["rank"] == 4


def test_t_probabilities():
    assert t_two_sided(0.0, 5) == pytest.approx(1.0)
    assert t_two_sided(2.0, 2) == pytest.approx(1 - 2 / math.sqrt(6))          # closed form, 2 degrees
    assert t_two_sided(1.0, 1) == pytest.approx(0.5)                            # Cauchy
    assert t_two_sided(-12.706204736432095, 1) == pytest.approx(0.05)
    assert t_two_sided(1.959963984540054, 10**7) == pytest.approx(0.05, abs=1e-6)
    assert math.isnan(t_two_sided(math.nan, 3))


@pytest.mark.parametrize("case", ["constant", "two_constants", "collinear", "zero"])
def test_degenerate_designs_match_pseudo_inverse(spark, case):
    rng = np.random.default_rng(4)
    a = rng.normal(5, 2, 30)
    extra = {"constant": [np.full(30, 2023.0), rng.normal(3, 1, 30), rng.normal(0, 9, 30)], "two_constants": [np.full(30, 4.0), np.full(30, -3.0)],
             "collinear": [2 * a + 1], "zero": [np.zeros(30)]}[case]
    x = np.column_stack([a, *extra])
    y = 1 + 0.5 * a + rng.normal(0, 1, 30)
    df, names = _frame(spark, x, y)
    fit = _coefs(df, names)
    adds = case in ("collinear", "zero")
    design = np.column_stack([np.ones(30), x]) if adds else x
    want = np.linalg.pinv(design, rcond=1e-10) @ y
    got = [fit.intercept, *fit.coef] if adds else list(fit.coef)
    assert fit.has_const == adds and got == pytest.approx(list(want), abs=1e-6)
    assert fit["rank"] == np.linalg.matrix_rank(design)


def test_ridge_limits(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (30, 2))
    y = 4 + x @ [1, -2] + rng.normal(0, 0.1, 30)
    df, names = _frame(spark, x, y)
    ols = _coefs(df, names)
    assert _coefs(df, names, method="ridge", lam=1e-9).coef == pytest.approx(list(ols.coef))
    far = _coefs(df, names, method="ridge", lam=1e12)
    assert far.coef == pytest.approx([0, 0], abs=1e-6) and far.intercept == pytest.approx(y.mean(), abs=1e-6)


def test_groups_with_infinite_values_turn_to_ridge(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(0, 1, (60, 2))
    y = 1 + x @ [2, -1] + rng.normal(0, 0.1, 60)
    x[3, 1], y[25] = math.inf, -math.inf
    rows = [("abc"[i // 20], *map(float, x[i]), float(y[i])) for i in range(60)] + [("none", math.inf, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, x0 double, x1 double, y double")
    arrays = df.select("g", "y", F.array("x0", "x1").alias("x"))
    for fits in (linreg.grouped_fit(df, ["g"], "y", ["x0", "x1"], "auto", lam=3.0), linreg.array_fit(arrays, ["g"], "y", "x", "auto", lam=3.0)):
        got = {r.g: r for r in fits.collect()}
        assert {g: r.method for g, r in got.items()} == {"a": "ridge", "b": "ridge", "c": "ols"}
        for g, first in (("a", 0), ("b", 20), ("c", 40)):
            keep = [i for i in range(first, first + 20) if np.isfinite([*x[i], y[i]]).all()]
            xc, yc = x[keep] - x[keep].mean(0), y[keep] - y[keep].mean()
            want = np.linalg.solve(xc.T @ xc + (0 if g == "c" else 3) * np.eye(2), xc.T @ yc)
            assert got[g].n == len(keep) and got[g].fit.coef == pytest.approx(list(want))


def test_array_moments_equal_column_moments(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(0, 1, (50, 3))
    df, names = _frame(spark, x, rng.normal(0, 1, 50))
    a = linreg.moments(df, ["g"], "y", names).first()
    b = linreg.array_moments(df.repartition(5).withColumn("x", F.array(*names)), ["g"], "y", "x").first()
    for f in linreg.MOMENTS:
        assert b[f] == pytest.approx(a[f])


def test_ridge_cv_against_explicit_folds(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(3, 2, (40, 2))
    y = x @ [0.3, 0.1] + rng.normal(0, 1, 40)
    df, names = _frame(spark, x, y)
    df = df.withColumn("k", F.monotonically_increasing_id())
    lambdas = [0.01, 1.0, 30.0]
    got = linreg.ridge_cv(df, ["g"], "y", names, ["k"], lambdas).first()
    deal = df.select("*", F.xxhash64(F.lit(42), "k").alias("h")).orderBy("h").collect()
    fold, xs, ys = np.arange(40) % 5, np.array([[r.x0, r.x1] for r in deal]), np.array([r.y for r in deal])
    z = (xs - xs.mean(0)) / xs.std(0)

    def fit(zz, yy, lam):
        zc, yc = zz - zz.mean(0), yy - yy.mean()
        b = np.linalg.solve(zc.T @ zc + lam * np.eye(2), zc.T @ yc)
        return b, yy.mean() - zz.mean(0) @ b

    def score(lam):
        out = []
        for f in range(5):
            b, a = fit(z[fold != f], ys[fold != f], lam)
            e = ys[fold == f] - a - z[fold == f] @ b
            t = ys[fold == f] - ys[fold == f].mean()
            out.append(1 - (e @ e) / (t @ t))
        return np.mean(out)

    best = max(lambdas, key=score)
    b, _ = fit(z, ys, best)
    deb = b + best * np.linalg.solve(z.T @ z + best * np.eye(2), b)
    assert got.lam == best
    assert got.slope == pytest.approx(b[0] / xs.std(0)[0]) and got.slope_debiased == pytest.approx(deb[0] / xs.std(0)[0])


@pytest.mark.parametrize("n,clipped", [(20, 2), (19, 0)])
def test_winsorize_counts(spark, n, clipped):
    df = spark.createDataFrame([("c", "p", float(i)) for i in range(n)], "category string, product_desc string, v double")
    got = sorted(r.v for r in elasticity.winsorize(df, ["v"], 0.05).collect())
    assert sum(a != b for a, b in zip(got, range(n))) == clipped
    if clipped:
        assert got[0] == 1 and got[-1] == 18


def test_monthly_coverage_counts_from_january(spark, rows):
    days = [(dt.date(2022, m, d), "a") for m in (1, 2, 3) for d in (1, 2)] + [(dt.date(2022, 4, 1), "b"), (dt.date(2022, 4, 2), "b")]
    df = spark.createDataFrame(days, "business_date date, item_id string").withColumn("year", F.year("business_date")).withColumn("month", F.month("business_date"))
    assert rows(elasticity.coverage(df, 1, "M")) == [("a", 3, 0.75), ("b", 1, 0.25)]


def test_residual_columns_are_checked(spark):
    df = spark.createDataFrame([("c", "p", 1.0)], "category string, product_desc string, log_qty double")
    with pytest.raises(ValueError):
        elasticity.seasonal_residuals(df, "W")
    with pytest.raises(ValueError):
        elasticity.seasonal_residuals(df, "D")


def test_known_elasticity_is_found(spark):
    rng = np.random.default_rng(9)
    data = []
    for p, slope in (("a", -2.0), ("b", -0.5)):
        for w in range(150):
            day = FIRST + dt.timedelta(weeks=w)
            price = math.exp(rng.normal(1, 0.2))
            qty = math.exp(8 + slope * math.log1p(price) + rng.normal(0, 0.02))
            data.append((day, p, "B" + p, "CAT-C", "private" if p == "a" else "national", qty, price))
    df = spark.createDataFrame(data, "business_date date, product_desc string, brand string, category_desc string, label string, quantity_sold double, price double")
    df = df.withColumn("item_id", F.col("product_desc"))
    each, summary = elasticity.elasticity_tables(df, None, 0, 0.5, winsor=None)
    got = {r.product_desc: r for r in each.collect()}
    assert got["a"].elasticity == pytest.approx(-2, abs=0.05) and got["b"].elasticity == pytest.approx(-0.5, abs=0.05)
    assert got["a"].significant and got["a"].p_value < 1e-10
    assert {r.label: (round(r.weighted_elasticity, 1), r.products) for r in summary.collect()} == {"private": (-2.0, 1), "national": (-0.5, 1)}
    ridge = elasticity.elasticity_tables(df, None, 0, 0.5, winsor=None, method="ridge_debias")[0].collect()
    assert {r.product_desc: round(r.elasticity) for r in ridge} == {"a": -2, "b": 0} or all(r.alpha > 0 for r in ridge)


def _demand_series(spark, n=400, bad=None):
    rng = np.random.default_rng(11)
    pa, pb = rng.uniform(2, 4, n), rng.uniform(5, 6, n)
    data = []
    for i in range(n):
        day = FIRST + dt.timedelta(days=i)
        qa = 200 - 20 * pa[i] + 8 * pb[i] + 5 * math.sin(2 * math.pi * day.toordinal() / 7)
        data.append((day, "a", float(qa), float(pa[i]) if i != bad else math.inf))
        data.append((day, "b", float(100 - 3 * pb[i]), float(pb[i])))
    return spark.createDataFrame(data, "business_date date, product_desc string, quantity_sold double, price double")


def _edge(spark):
    return spark.createDataFrame([("a", "b", 0.9)], "product_desc string, other string, corr double")


def test_demand_model_finds_prices_and_season(spark):
    out = demand.demand_model(_demand_series(spark), _edge(spark), steps=14, mode="additive")
    coefs = {(r.product_desc, r.feature): r.coef for r in out["coefs"].collect()}
    assert coefs["a", "price"] == pytest.approx(-20, abs=1) and coefs["a", "b_price"] == pytest.approx(8, abs=1.5)
    assert ("b", "a_price") not in coefs
    ahead = out["time"].where("future and product_desc = 'a'").orderBy("ds").collect()
    assert len(ahead) == 14 and ahead[0].ds == FIRST + dt.timedelta(days=400)
    wave = [5 * math.sin(2 * math.pi * r.ds.toordinal() / 7) for r in ahead]
    assert np.corrcoef(wave, [r.yhat for r in ahead])[0, 1] > 0.95
    assert {r.product_desc: r.rmse < 1 for r in out["metrics"].collect()} == {"a": True, "b": True}


def test_infinite_price_removes_only_that_products_price(spark):
    table, names = demand.demand_features(_demand_series(spark, 60, bad=30), _edge(spark))
    got = {r.product_desc: r.names for r in names.collect()}
    assert got["a"] == ["year", "month", "b_price"]
    assert got["b"] == ["price", "year", "month", "price_lag_3"]
    assert {r.product_desc: r.n for r in table.groupBy("product_desc", F.size("x").alias("n")).count().collect()} == {"a": 3, "b": 4}


@pytest.mark.parametrize("block", [2, 128])
def test_packed_prices_equal_a_join_by_day(spark, rows, block):
    rng = np.random.default_rng(13)
    days = {p: sorted(rng.choice(30, rng.integers(1, 30), replace=False).tolist()) for p in "abcdefg"} | {"all": list(range(30))}
    data = [(FIRST + dt.timedelta(days=d), p, 1.0, None if rng.random() < 0.05 and p != "all" else float(d)) for p, ds in days.items() for d in ds]
    data[0] = (*data[0][:3], math.inf)
    sales = spark.createDataFrame(data, "business_date date, product_desc string, quantity_sold double, price double")
    edges = [(a, b) for a in days for b in days if a != b and rng.random() < 0.5] + [("a", "all"), ("b", "unknown"), ("unknown", "a")]
    edges = spark.createDataFrame(sorted(set(edges)), "product_desc string, other string")
    prices = {(p, d): v for d, p, _, v in data}
    want = [(e.product_desc, e.other, tuple(prices.get((e.other, FIRST + dt.timedelta(days=d))) for d in days[e.product_desc])) for e in edges.collect() if e.product_desc in days]
    packed = demand.packed_cross_prices(sales, sales, edges, block=block)
    assert sorted(((r.product_desc, r.other, tuple(r.prices)) for r in packed.collect()), key=repr) == sorted(want, key=repr)
    whole = [w for w in want if None not in w[2] and math.inf not in w[2]]
    got = demand.packed_cross_prices(sales, sales, edges, complete=True, block=block).collect()
    assert sorted(((r.product_desc, r.other, tuple(r.prices)) for r in got), key=repr) == sorted(whole, key=repr) and whole
    long = demand.cross_prices(sales, sales, edges)
    assert rows(long, "product_desc", "other", "business_date", "other_price") == sorted(
        ((p, o, FIRST + dt.timedelta(days=d), v) for p, o, vs in want for d, v in zip(days[p], vs)), key=repr)


def test_demo_split_and_variants(spark):
    sales = _demand_series(spark, 120)
    for kw in ({"mode": "additive"}, {"link": "log", "time": "ar"}, {"method": "ridge"}):
        m = demand.demand_model(sales, _edge(spark), purpose="demo", **kw)["metrics"].collect()
        assert sorted((r.product_desc, r.split) for r in m) == [("a", "test"), ("a", "train"), ("b", "test"), ("b", "train")]
        assert all(r.mape < 8 for r in m)
    for kw in ({"purpose": "guess"}, {"time": "none"}, {"link": "cubic"}, {"mode": "other"}):
        with pytest.raises(ValueError):
            demand.demand_model(sales, _edge(spark), steps=1, **kw)


def test_autoregression_continues_a_weekly_pattern(spark):
    data = [("p", FIRST + dt.timedelta(days=i), float([0, 1, 4, 2, -3, -2, -2][i % 7])) for i in range(140)]
    df = spark.createDataFrame(data, "product_desc string, business_date date, residual double")
    ahead = demand.ar_component(df, 14).where("future").orderBy("ds").collect()
    assert [round(r.yhat, 6) for r in ahead] == pytest.approx([0, 1, 4, 2, -3, -2, -2] * 2, abs=1e-5)
    assert ahead[0].ds == FIRST + dt.timedelta(days=140)


def test_error_metrics(spark):
    df = spark.createDataFrame([("a", 2.0, 1.0), ("a", 4.0, 5.0), ("b", 0.0, 1.0)], "product_desc string, y double, f double")
    got = {r.product_desc: (r.mse, r.rmse, r.mape) for r in demand.error_metrics(df, "y", "f").collect()}
    assert got["a"] == pytest.approx((1, 1, 37.5)) and got["b"] == (1, 1, math.inf)
    many = spark.createDataFrame([(f"p{i}", float(i), float(i), float(20 - i)) for i in range(20)], "product_desc string, mse double, rmse double, mape double")
    assert {r[0] for r in demand.best_products(many).select("product_desc").collect()} == {f"p{i}" for i in [*range(6), *range(14, 20)]}


def test_weighted_elasticity_takes_the_first_category(spark):
    weights = spark.createDataFrame([("A", "l", "p", 0.5), ("B", "l", "p", 1.0), ("A", "l", "q", 0.5)], "category string, label string, product_desc string, weight double")
    each = spark.createDataFrame([("B", "p", -3.0), ("A", "p", -1.0), ("A", "q", -2.0)], "category string, product_desc string, elasticity double")
    got = {r.category: (r.weighted_elasticity, r.products) for r in elasticity.weighted_elasticity(weights, each).collect()}
    assert got == {"A": (-1.5, 2), "B": (-1.0, 1)}


def test_choice_of_method_reads_the_rows_once(spark):
    data = [("a", 1.0, 1.0), ("a", 2.0, 2.5), ("a", 3.0, 2.0), ("b", 1.0, 1.0), ("b", 2.0, math.inf), ("b", 4.0, 3.0), ("c", 1.0, math.inf), ("d", 1.0, None), (None, 1.0, 1.0)]
    out = linreg.grouped_fit(spark.createDataFrame(data, "g string, y double, x double"), ["g"], "y", ["x"], "auto", lam=2.0)
    got = {r.g: (r.method, r.n, r.fit.coef[0]) for r in out.collect()}
    assert got == {"a": ("ols", 3, pytest.approx(6 / 7)), "b": ("ridge", 2, pytest.approx(3 / 4))}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and "Join" not in plan and "Union" not in plan

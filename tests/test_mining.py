import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from comboscope.operators import baskets, correlation, rules


def _carts(spark, carts):
    return spark.createDataFrame([(f"t{i}", list(c)) for i, c in enumerate(carts)], "transaction_uid string, items array<string>")


def test_itemsets_match_brute_force_and_are_anti_monotone(spark):
    rng = np.random.default_rng(1)
    carts = [[x for x in "abcdef" if rng.random() < 0.5] or ["a"] for _ in range(60)]
    found = {tuple(r["items"]): r.support for r in baskets.frequent_itemsets(_carts(spark, carts), 0.1).collect()}
    want = {}
    for k in range(1, 7):
        for s in itertools.combinations("abcdef", k):
            share = sum(set(s) <= set(c) for c in carts) / 60
            if share >= 0.1:
                want[s] = share
    assert found == pytest.approx(want)
    for s in found:
        for t in itertools.combinations(s, len(s) - 1):
            assert not t or found[t] >= found[s]


def test_only_baskets_of_three_frequent_partners_reach_the_tree(spark, monkeypatch):
    seen = []

    class Watched(baskets.FPGrowth):
        def fit(self, carts):
            seen.append(sorted(tuple(r["items"]) for r in carts.collect()))
            return super().fit(carts)

    monkeypatch.setattr(baskets, "FPGrowth", Watched)
    rare = [[f"r{i}", f"r{i + 1}", f"s{i}"] for i in range(0, 40, 2)]
    found = {tuple(r["items"]): r.freq for r in baskets.frequent_itemsets(_carts(spark, rare + [["a", "b"]] * 4), 0.01).collect()}
    assert len(found) == 20 * 7 + 3 and found["a", "b"] == 4 and len(seen) == 1 and ("a", "b") not in seen[0]
    seen.clear()
    carts = rare + [["a", "b", "c", "z"]] * 3 + [["a", "b"]] * 2
    found = {tuple(r["items"]): r.freq for r in baskets.frequent_itemsets(_carts(spark, carts), 0.1).collect()}
    assert found == {("a",): 5, ("b",): 5, ("c",): 3, ("z",): 3, ("a", "b"): 5, **{x: 3 for k in (2, 3, 4) for x in itertools.combinations("abcz", k) if x != ("a", "b")}}
    assert seen == [[("a", "b", "c", "z")] * 3]
    seen.clear()
    assert baskets.frequent_itemsets(_carts(spark, rare), 0.05).count() == 20 * 7 and baskets.frequent_itemsets(_carts(spark, rare), 0.06).count() == 0
    assert len(seen) == 1
    with pytest.raises(Exception, match="must be unique"):
        baskets.frequent_itemsets(_carts(spark, [["a", "a"]]), 0.1)


def test_rules_by_hand(spark):
    found = baskets.frequent_itemsets(_carts(spark, [["a", "b", "c"], ["a", "b", "c"], ["a", "d"]]), 0.3)
    got = {(tuple(r.antecedents), tuple(r.consequents)): r for r in rules.association_rules(found, "support", 0.0).collect()}
    assert len(got) == 3 * 2 + 6 + 2  # pairs ab, ac, bc, the triple abc, and ad
    r = got[("a",), ("b", "c")]
    assert (r.support, r.confidence, r.lift) == pytest.approx((2 / 3, 2 / 3, 1.0))
    r = got[("b",), ("a", "c")]
    assert r.confidence == 1 and r.conviction == math.inf and r.lift == pytest.approx(1.5)
    assert r.leverage == pytest.approx(2 / 3 - 4 / 9)
    assert r.zhang == pytest.approx((2 / 9) / max(2 / 3 * (1 / 3), 0.0))
    r = got[("d",), ("a",)]
    assert r.lift == pytest.approx(1.0) and r.zhang == 0
    only = rules.association_rules(found, "lift", 1.3)
    assert {tuple(x) for x in only.select("lift").collect()} == {(1.5,)}
    with pytest.raises(ValueError):
        rules.association_rules(found, "novelty")


def test_long_itemset_gives_every_split(spark):
    items = list("abcdefghijklmn")
    sets = [(list(c), 0.5) for k in range(1, 15) for c in itertools.combinations(items, k)]
    df = spark.createDataFrame(sets, "items array<string>, support double")
    top = rules.association_rules(df, "support", 0.0).where(F.size("antecedents") + F.size("consequents") == 14)
    assert top.count() == 2**14 - 2
    assert top.distinct().count() == 2**14 - 2


@pytest.mark.parametrize("metric", ["support", "confidence", "lift"])
def test_large_sets_split_into_their_frequent_subsets(spark, metric):
    names = [f"i{k:02d}" for k in range(70)]
    sets = {tuple(names): 0.2, tuple(names[:35]): 0.4, tuple(names[35:]): 0.3, tuple(names[:20]): 0.5, tuple(names[1:]): 0.3, (names[0],): 0.7, ("zz",): 0.9, (names[5], "zz"): 0.1,
            tuple(names[:11]): 0.5, tuple(names[:10]): 0.6, (names[10],): 0.7}
    df = spark.createDataFrame([(list(k), v) for k, v in sets.items()], "items array<string>, support double")
    got = {(tuple(r.antecedents), tuple(r.consequents)): r[metric] for r in rules.association_rules(df, metric, 0.5 if metric == "confidence" else 0.0).collect()}
    want = {}
    for whole, s in sets.items():
        for a, sa in sets.items():
            rest = tuple(x for x in whole if x not in a)
            if set(a) < set(whole) and rest in sets:
                value = {"support": s, "confidence": s / sa, "lift": s / sa / sets[rest]}[metric]
                if metric != "confidence" or value >= 0.5:
                    want[a, rest] = value
    assert got == pytest.approx(want) and len(want) >= 4


def test_names_with_apostrophe_survive(spark):
    found = baskets.frequent_itemsets(_carts(spark, [["LAY'S CLASSIC 66g", "PEPSI 591ML"]] * 2), 0.5)
    assert {r[0] for r in baskets.items_of(found).collect()} == {"LAY'S CLASSIC 66g", "PEPSI 591ML"}


def test_chunks_are_stable_and_cover_everything(spark):
    carts = _carts(spark, [["a"], ["a", "b"], ["b"]] * 20)
    out = baskets.frequent_itemsets_by_chunk(carts, 0.01, key=["transaction_uid"])
    singles = out.where(F.size("items") == 1).groupBy("items").agg(F.sum("freq")).collect()
    assert {r[0][0]: r[1] for r in singles} == {"a": 40, "b": 40}
    per = rules.association_rules(out, "support", 0.0, group=["chunk"])
    assert set(r.chunk for r in per.select("chunk").distinct().collect()) == {0, 1}


def test_basket_pivot_is_one_aggregate(spark, rows):
    df = spark.createDataFrame([(1, "a#1", 2.0), (1, "a#1", 3.0), (1, "z", 1.0), (2, "z", 4.0), (3, "b", None), (3, None, 1.0)], "uid long, item string, quantity double")
    out = baskets.basket_pivot(df, ["a#1", "b"], ["uid"])
    assert rows(out) == [(1, 5.0, 0.0), (2, 0.0, 0.0), (3, 0.0, 0.0)] and out.columns == ["uid", "a#1", "b"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1


def test_edges_and_pivot(spark, rows):
    df = spark.createDataFrame([(["b", "a"], ["c"], 0.5), (["a"], ["c"], 0.25)],
                               "antecedents array<string>, consequents array<string>, confidence double")
    assert rows(rules.rule_edges(df), "antecedent", "consequent") == [("a", "c"), ("a", "c")]
    assert rows(rules.confidence_table(df, ["a", "b,a", "z"])) == [("c", 0.25, 0.5, None)]


def test_blocked_correlation_matches_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(100, 1, (12, 30))
    x[3] = 7.0
    seen = rng.random((12, 30)) < 0.8
    data = [(f"i{i:02d}", t, float(x[i, t])) for i in range(12) for t in range(30) if seen[i, t]]
    df = spark.createDataFrame(data, "item string, at int, v double")
    got = {(r.item_a, r.item_b): (r.corr, r.n) for r in correlation.pairwise_correlations(df, "item", "at", "v", block=4).collect()}
    assert len(got) == 66
    for (a, b), (c, n) in got.items():
        i, j = int(a[1:]), int(b[1:])
        both = seen[i] & seen[j]
        assert i < j and n == both.sum()
        if 3 in (i, j):
            assert c is None
        else:
            assert c == pytest.approx(np.corrcoef(x[i, both], x[j, both])[0, 1], abs=1e-10)
    strong = correlation.pairwise_correlations(df, "item", "at", "v", block=4, min_abs=0.2).collect()
    assert {(r.item_a, r.item_b) for r in strong} == {k for k, (c, _) in got.items() if c is not None and abs(c) > 0.2}


def test_groups_of_different_size_do_not_mix(spark):
    data = [(g, f"{g}{i}", t, float((i + 1) * t % 5)) for g, n in (("x", 9), ("y", 2)) for i in range(n) for t in range(8)]
    df = spark.createDataFrame(data, "g string, item string, at int, v double")
    got = correlation.pairwise_correlations(df, "item", "at", "v", group=["g"], block=3).groupBy("g").count().collect()
    assert {r.g: r["count"] for r in got} == {"x": 36, "y": 1}


def test_ordinal_alignment_is_capped_by_first_product(spark):
    import datetime as dt
    first = dt.date(2024, 1, 1)
    data = [("a", first + dt.timedelta(days=i), float(i * i % 7)) for i in range(6)]
    data += [("b", first + dt.timedelta(days=2 * i + 1), float(i * 3 % 5)) for i in range(10)]
    df = spark.createDataFrame(data, "product_desc string, business_date date, quantity_sold double")
    r = correlation.quantity_correlations(df, "ordinal").first()
    assert r.n == 6
    assert r["corr"] == pytest.approx(np.corrcoef([i * i % 7 for i in range(6)], [i * 3 % 5 for i in range(6)])[0, 1])
    assert correlation.quantity_correlations(df).first().n == 3


def test_weak_pairs_are_cut_inside_the_task(spark):
    rng = np.random.default_rng(3)
    data = [(f"i{i}", t, float(v)) for i, series in enumerate(rng.normal(size=(9, 12))) for t, v in enumerate(series)]
    df = spark.createDataFrame(data, "item string, at int, v double")
    every = {(r.item_a, r.item_b): r["corr"] for r in correlation.pairwise_correlations(df, "item", "at", "v", block=4).collect()}
    some = {(r.item_a, r.item_b) for r in correlation.pairwise_correlations(df, "item", "at", "v", block=4, at_least=0.2).collect()}
    assert len(every) == 36 and some == {k for k, v in every.items() if v >= 0.2}


def test_competitors_are_greedy(spark, rows):
    pairs = [("a", "b", .9), ("a", "c", .8), ("a", "d", .7), ("a", "e", .6), ("a", "f", -.9), ("a", "g", .5),
             ("b", "c", .95), ("b", "d", .1), ("d", "e", .2)]
    df = spark.createDataFrame([("k", *p) for p in pairs], "category string, item_a string, item_b string, corr double")
    got = correlation.choose_competitors(df).where("item = 'a'")
    assert rows(got, "slot", "competitor") == [(1, "b"), (2, "d"), (3, "e")]  # c is too close to b; f is negative
    wide = correlation.choose_competitors(df, max_inter_corr=0.99).where("item = 'a'")
    assert rows(wide, "slot", "competitor") == [(1, "b"), (2, "c"), (3, "d")]


@pytest.mark.parametrize("block,quantile", [(4, 0.75), (256, 0.4), (256, 1.0)])
def test_strongest_pairs_reach_the_exact_quantile(spark, block, quantile):
    rng = np.random.default_rng(21)
    x = rng.normal(0, 1, (25, 12))
    x[5], x[9], x[11] = x[2], x[2], 1.0  # ties at 1, and a constant series without correlations
    values = spark.createDataFrame([(f"p{i}", k, float(v)) for i, r in enumerate(x) for k, v in enumerate(r)], "p string, at long, v double").repartition(3)
    with np.errstate(divide="ignore", invalid="ignore"):
        full = np.corrcoef(x)
    corr = {(f"p{i}", f"p{j}"): full[i, j] for i in range(25) for j in range(25) if f"p{i}" < f"p{j}" and np.isfinite(full[i, j])}
    want = np.quantile(list(corr.values()), quantile)
    pairs, cut = correlation.strongest_pairs(values, "p", "at", "v", quantile, block=block)
    assert cut == pytest.approx(want, abs=1e-12)
    assert {(r.item_a, r.item_b) for r in pairs.collect()} == {k for k, v in corr.items() if v >= want - 1e-12}
    both, _ = correlation.strongest_pairs(values, "p", "at", "v", quantile, min_abs=0.5, block=block)
    assert {(r.item_a, r.item_b) for r in both.collect()} == {k for k, v in corr.items() if v >= want - 1e-12 or abs(v) > 0.5}


def test_no_correlations_have_no_cut(spark):
    values = spark.createDataFrame([("a", 0, 1.0), ("b", 0, 2.0)], "p string, at long, v double")
    pairs, cut = correlation.strongest_pairs(values, "p", "at", "v", 0.75)
    assert cut is None and pairs.collect() == []

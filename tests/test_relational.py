import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from comboscope import schemas
from comboscope.functions import expr
from comboscope.functions.ids import dense_ids
from comboscope.functions import quantiles
from comboscope.operators import baskets, cleaning, series, transactions
from comboscope.sources import sinks, tables

D = dt.date


def test_zero_quantity_and_half_even_rounding(spark):
    df = spark.createDataFrame([(5.0, 0.0), (0.0, 0.0), (-5.0, 0.0), (1.0, 8.0), (0.375, 1.0)], "s double, q double")
    got = [tuple(r) for r in df.select(expr.unit_price("s", "q"), expr.unit_price("s", "q", "inf")).collect()]
    assert got[0] == (None, math.inf)
    assert got[1] == (None, None)
    assert got[2] == (None, -math.inf)
    assert got[3] == (0.12, 0.12)
    assert got[4] == (0.38, 0.38)
    with pytest.raises(ValueError):
        expr.unit_price("s", "q", "zero")


def test_exclusion_keeps_null(spark, rows):
    df = spark.createDataFrame([(None,), ("COUPONS",), ("kept",)], "category_desc string")
    assert rows(cleaning.exclude_values(df, "category_desc", ["COUPONS"])) == [("kept",), (None,)]


def test_items_outside_counts_missing_group(spark, rows):
    df = spark.createDataFrame([("a", "Fuel"), ("b", None), ("c", "FOOD")], "item_desc string, department_desc string")
    assert rows(cleaning.items_outside(df, "department_desc", ["Fuel"])) == [("b",), ("c",)]


def test_week_edges(spark):
    days = [D(2020, 12, 28), D(2021, 1, 1), D(2021, 1, 3), D(2021, 1, 4), D(2024, 12, 30)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select("d", expr.monday_week("d"), F.weekofyear("d"), expr.week_start("d")).collect()
    for d, w, iso, start in got:
        assert w == int(d.strftime("%W"))
        assert iso == d.isocalendar().week
        assert start == d - dt.timedelta(days=d.weekday())


def test_category_key_and_labels(spark, rows):
    df = spark.createDataFrame([("BREUVAGES FROIDS-C", "CK/CT"), ("A-B/C*D", None)], "c string, b string")
    assert rows(df.select(expr.category_key("c"), expr.brand_label("b", ["CK/CT"]))) == [
        ("A_B_C_D", "national"), ("BOISSONS_GAZEUSES", "private")]


def test_engagement_bins(spark):
    values = [0.0, 1.0, 25.0, 100 / 3, 50.0, 55.0, 66.7, 100.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, p double")
    got = [r[0] for r in df.orderBy("i").select(expr.engagement_level("p")).collect()]
    assert got == ["None", "None", "Low", "Medium", "Medium", "Medium", "High", "High"]


def test_safe_date(spark, rows):
    df = spark.createDataFrame([("2024-01-02",), ("nonsense",), (None,)], "s string")
    assert {r[0] for r in rows(df.select(expr.safe_date("s")))} == {D(2024, 1, 2), None}


ITEMS = ("transaction_uid string, product_id string, product_desc string, site_number string, business_date date, "
         "quantity_sold string, sales_amount double")


def sale(uid, desc, qty, amount, day=D(2024, 1, 1), site="s", pid="1|x"):
    return (uid, pid, desc, site, day, qty, amount)


def test_series_drops_null_keys_and_sums(spark, rows):
    df = spark.createDataFrame([sale("t1", "a", "2", 4.0), sale("t2", "a", "1", 3.0), sale("t3", None, "1", 1.0),
                                sale("t4", "a", "-1", 9.0), sale("t5", "a", None, 9.0)], ITEMS)
    assert rows(series.daily_series(df), "product_desc", "quantity_sold", "price") == [("a", 3.0, 2.5)]


def test_dedupe_on_pruned_columns_collapses(spark, rows):
    df = spark.createDataFrame([sale("t1", "a", "2", 4.0), sale("t2", "a", "2", 4.0)], ITEMS)
    six = ["business_date", "product_desc", "product_id", "site_number", "quantity_sold", "sales_amount"]
    assert rows(series.daily_series(df, dedupe_columns=six), "quantity_sold") == [(2.0,)]
    assert rows(series.daily_series(df), "quantity_sold") == [(4.0,)]


def test_keep_first_date_within_partition(spark, rows):
    df = spark.createDataFrame([sale("t1", "a", "1", 4.0, D(2024, 1, 2)), sale("t2", "a", "5", 4.0, D(2024, 1, 1))], ITEMS)
    df = df.withColumn("transaction_date", F.lit("2024-01-02").cast("date"))
    got = series.daily_series(df, partition_date="transaction_date")
    assert rows(got, "business_date", "quantity_sold") == [(D(2024, 1, 1), 5.0)]


def test_first_per_key_orders_and_ties(spark, rows):
    df = spark.createDataFrame([("k", 2, "x"), ("k", 1, "z"), ("k", 1, "y"), ("j", 5, None)], "k string, o int, v string")
    assert rows(cleaning.first_per_key(df, ["k"], ["o"])) == [("j", 5, None), ("k", 1, "y")]


def _transaction_inputs(spark):
    headers = spark.createDataFrame([("t1", "s1", D(2024, 1, 1)), ("t2", "s1", D(2024, 1, 1)), ("t3", "s2", D(2024, 1, 1))],
                                    "transaction_uid string, site_number string, business_date date")
    items = spark.createDataFrame(
        [("t1", 1, 0, "2", 4.0, 2), ("t1", 2, 1, "1", 3.0, 1), ("t1", 3, 0, "1", 1.0, 3), ("t3", 1, 0, "1", 2.0, 1)],
        "transaction_uid string, product_key long, promotion_key long, quantity_sold string, sales_amount double, line_seq int")
    product = spark.createDataFrame([(1, "a", "cat", "sub"), (2, "b", None, "sub"), (3, "c", "COUPONS", "sub")],
                                    "product_key long, item_desc string, category_desc string, sub_category_desc string")
    promo = spark.createDataFrame([(1, "deal", "PCT")], "promotion_key long, promotion_description string, promotion_type string")
    return headers, items, product, promo


def test_transaction_documents(spark):
    lines = transactions.transaction_lines(*_transaction_inputs(spark), sites=["s1"], key=["transaction_uid"])
    docs = transactions.transaction_documents(lines, ["transaction_uid"]).collect()
    assert [d.transaction_uid for d in docs] == ["t1"]          # t2 has no items, t3 is another site
    assert [x.item_desc for x in docs[0].lines] == ["b", "a"]   # line order; the coupon is excluded, null category kept
    assert [x.promotion_type for x in docs[0].lines] == ["PCT", None]
    assert docs[0].sales_vol == 3.0 and docs[0].week == 1


def test_long_transaction_is_one_ordered_row(spark):
    n = 200_000
    headers = spark.createDataFrame([("big", "s", D(2024, 1, 1)), ("small", "s", D(2024, 1, 1))],
                                    "transaction_uid string, site_number string, business_date date")
    items = spark.range(n).selectExpr("'big' AS transaction_uid", "id % 1000 AS product_key", "0L AS promotion_key", "'1' AS quantity_sold",
                                      "1.0D AS sales_amount", "cast(id AS int) AS line_seq")
    items = items.unionByName(items.limit(2).withColumn("transaction_uid", F.lit("small")))
    _, _, _, promo = _transaction_inputs(spark)
    product = spark.range(1000).selectExpr("id AS product_key", "concat('i', id) AS item_desc", "'c' AS category_desc", "'s' AS sub_category_desc")
    key = ["transaction_uid"]
    docs = transactions.transaction_documents(transactions.transaction_lines(headers, items, product, promo, key=key), key)
    got = {r.transaction_uid: r for r in docs.select("transaction_uid", "sales_vol", F.col("lines.line_seq").alias("at")).collect()}
    assert len(got) == 2 and got["big"].sales_vol == n and got["big"].at == list(range(n)) and got["small"].sales_vol == 2.0


def test_same_uid_on_two_days_is_two_documents(spark):
    schema = "transaction_date date, transaction_uid string"
    headers = spark.createDataFrame([(D(2024, 1, d), "u", "s", D(2024, 1, d)) for d in (1, 2)], schema + ", site_number string, business_date date")
    items = spark.createDataFrame([(D(2024, 1, d), "u", 1, 0, q, 1.0, 1) for d, q in ((1, "1"), (2, "5"))],
                                  schema + ", product_key long, promotion_key long, quantity_sold string, sales_amount double, line_seq int")
    _, _, _, promo = _transaction_inputs(spark)
    product = spark.createDataFrame([(1, "i", "c", "s")], "product_key long, item_desc string, category_desc string, sub_category_desc string")
    docs = transactions.transaction_documents(transactions.transaction_lines(headers, items, product, promo)).collect()
    assert sorted((d.business_date.day, d.sales_vol, len(d.lines)) for d in docs) == [(1, 1.0, 1), (2, 5.0, 1)]


def test_first_per_key_takes_nulls_last(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "CK", 2), ("b", None, 3)], "item_id string, brand string, n int")
    assert sorted(map(tuple, cleaning.first_per_key(df, ["item_id"], ["brand"]).collect())) == [("a", "CK", 2), ("b", None, 3)]


def test_same_uid_on_two_days_stays_apart(spark, rows):
    df = spark.createDataFrame([(D(2024, 1, 1), "t", "a", 1.0), (D(2024, 1, 2), "t", "b", 1.0)],
                               "transaction_date date, transaction_uid string, item string, quantity double")
    assert baskets.baskets(baskets.basket_rows(df)).count() == 2


def test_quantile_cascade_survivors(spark, rows):
    df = spark.createDataFrame([(f"p{i:02d}", float(i)) for i in range(1, 17)], "product_desc string, quantity_sold double")
    left = np.arange(1.0, 17.0)
    for p in (0.75, 0.25, 0.75):
        left = left[left >= np.quantile(left, p)]
    assert [r[0] for r in rows(series.quantile_cascade(df), "total_qty")] == list(left)


def test_exact_quantiles_of_extreme_values(spark):
    values = [-1.6e308, -1.0, 5e-324, 0.0, 1.6e308]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert quantiles.exact_quantiles(df, "x", [0.0, 0.25, 0.5, 0.75, 1.0]) == sorted(values)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.exponential(1e3, 3000), np.full(2000, 7.25), [-1e9, 1e12]])
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    assert quantiles.exact_quantiles(df, "v", probs) == pytest.approx(list(np.quantile(x, probs)), rel=1e-12)
    assert quantiles.exact_quantiles(df.where("v is null"), "v", [0.5]) == [None]


@pytest.mark.parametrize(("size", "margin"), [(16, 0.3), (64, 0.05), (64, 0.0)])
def test_exact_quantiles_when_a_sketch_is_too_small(spark, monkeypatch, size, margin):
    """Brackets around ties, adjacent values and positions that a sketch without margin misses."""
    monkeypatch.setattr(quantiles, "SKETCH", size)
    monkeypatch.setattr(quantiles, "MARGIN", margin)
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=4000), np.full(3000, 0.5), np.full(3000, 0.25)])
    df = spark.createDataFrame([(float(v),) for v in rng.permutation(x)], "v double").repartition(5)
    probs = [0.0, 0.01, 0.3, 0.5, 0.55, 0.9, 1.0]
    assert quantiles.exact_quantiles(df, "v", probs) == pytest.approx(list(np.quantile(x, probs)), rel=1e-12)
    places = [0, 1, 4999, 5000, 9999]
    assert quantiles.values_at(df, "v", places) == [float(v) for v in np.sort(x)[places]]
    two = spark.createDataFrame([(1.0,)] * 500 + [(2.0,)] * 500, "v double")
    assert quantiles.exact_quantiles(two, "v", [0.25, 0.5, 0.75]) == [1.0, 1.5, 2.0]


def test_dense_ids(spark, rows):
    df = spark.createDataFrame([(f"k{i % 500:04d}",) for i in range(2000)], "k string").repartition(7)
    assert rows(dense_ids(df, ["k"], "id")) == [(f"k{i:04d}", i) for i in range(500)]


def _series(spark, data):
    return spark.createDataFrame([(p, D(2024, 1, 1) + dt.timedelta(days=i), float(q), float(pr)) for p, i, q, pr in data],
                                 "product_desc string, business_date date, quantity_sold double, price double")


def test_jump_products(spark, rows):
    data = [("before", 0, 1, 1), ("after", 5, 9, 1), ("twice", 0, 2, 1), ("twice", 5, 4, 1), ("more", 0, 2, 1), ("more", 5, 4.02, 1)]
    df = _series(spark, data)
    jumped = series.jump_products(df, "2024-01-03").where("jump")
    assert rows(jumped, "product_desc") == [("more",)]
    assert rows(series.cut_after_jump(df, "2024-01-03").groupBy("product_desc").count()) == [
        ("after", 1), ("before", 1), ("more", 1), ("twice", 2)]


def test_lags_split_and_last_prices(spark, rows):
    df = _series(spark, [("a", i, 1, i) for i in range(10)])
    assert rows(series.with_price_lags(df), "price", "price_lag_3", "price_lag_8") == [(8.0, 5.0, 0.0), (9.0, 6.0, 1.0)]
    assert series.with_split(df).where("split = 'train'").count() == 8
    assert series.last_prices(df).first().past_price == [7.0, 8.0, 9.0]


def test_histogram_closed_last_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "x double")
    got = baskets.histogram(df, "x").orderBy("bin").collect()
    want, edges = np.histogram(np.arange(101.0), bins=50)
    assert [r.n for r in got] == list(want) and [r.bin_start for r in got] == pytest.approx(list(edges[:-1]))


def test_dated_facts_tolerate_gaps_and_empty_files(spark, tmp_path):
    root = str(tmp_path / "facts")
    df = spark.createDataFrame([("t1", D(2024, 1, 1)), ("t2", D(2024, 1, 3)), ("t3", D(2024, 2, 1))], "transaction_uid string, transaction_date date")
    sinks.write_table(df, root, partition_by="transaction_date")
    (tmp_path / "facts" / "transaction_date=2024-01-03" / "zero.parquet").touch()
    (tmp_path / "facts" / "transaction_date=2024-01-05").mkdir()
    got = tables.dated_facts(spark, root, schemas.T.StructType(schemas.HEADERS.fields), "2024-01-01", "2024-01-31", ["transaction_uid"])
    assert sorted(r[0] for r in got.collect()) == ["t1", "t2"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_date" in plan


def test_reloaded_days_replace_only_themselves(spark, rows, tmp_path):
    root = str(tmp_path / "facts")
    schema = "transaction_uid string, transaction_date date"
    sinks.replace_days(spark.createDataFrame([("a", D(2024, 1, 1)), ("b", D(2024, 1, 2)), ("c", D(2024, 1, 2)), ("n", None)], schema), root)
    sinks.replace_days(spark.createDataFrame([("d", D(2024, 1, 2)), ("e", D(2024, 1, 3))], schema), root)
    got = tables.dated_facts(spark, root, schemas.T.StructType(schemas.HEADERS.fields), "2024-01-01", "2024-01-02", ["transaction_uid"])
    assert rows(got) == [("a",), ("d",)]
    assert "PartitionFilters: [isnotnull(transaction_date" in got._jdf.queryExecution().executedPlan().toString()


def test_csv_matrix_and_report_round_trip(spark, rows, tmp_path):
    costs = spark.createDataFrame([("LAY'S CLASSIC 66g", 1.5, 2.5)], schemas.COST_TABLE)
    sinks.write_table(costs, str(tmp_path / "costs"), "csv")
    assert rows(tables.sheet(spark, str(tmp_path / "costs"), schemas.COST_TABLE)) == rows(costs)
    long = spark.createDataFrame([("t1", "a", 2.0), ("t2", "b", 1.0), ("t2", "a", 0.0)], "transaction_uid string, item string, quantity double")
    cells, items, txns = baskets.basket_matrix(long, ["transaction_uid"])
    sinks.write_basket_matrix(cells, items, txns, str(tmp_path / "matrix"))
    back = tables.basket_matrix(spark, str(tmp_path / "matrix"))
    assert rows(back, "transaction_uid", "item", "quantity") == [("t1", "a", 2.0), ("t2", "b", 1.0)]
    paths = sinks.write_report({"one": costs, "two": long}, str(tmp_path / "report"))
    assert rows(spark.read.parquet(paths[1])) == rows(long)


def test_label_sales_drops_incomplete_rows(spark, rows):
    sheet = spark.createDataFrame([("1", "x", "CK/CT", "c", "s"), ("1", "x", "ZED", "c", "s"), ("2", "y", "PEPSI", None, "s")], schemas.BRAND_SHEET)
    labels = cleaning.label_brands(sheet, ["CK/CT"])
    sales = spark.createDataFrame([(1, 5.0), (2, 6.0), (3, 7.0)], "item_id long, quantity_sold double")
    assert rows(cleaning.label_sales(sales, labels), "item_id", "label", "quantity_sold") == [("1", "private", 5.0)]
    assert cleaning.label_sales(sales, labels, spark.createDataFrame([("zzz",)], "category_desc string")).count() == 0


def test_sampled_keys_do_not_depend_on_partitioning(spark, rows):
    df = spark.range(1000).selectExpr("cast(id as string) as site_number")
    one = rows(cleaning.sample_keys(df, "site_number", 20))
    assert len(one) == 20 and one == rows(cleaning.sample_keys(df.repartition(13), "site_number", 20))


def test_distinct_union_keeps_each_row_once(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k int, v string")
    assert rows(cleaning.distinct_union([a, b]), "k", "v") == [(1, "x"), (2, None), (3, "y")]
    assert cleaning.distinct_union([a.limit(0), b.limit(0)]).count() == 0

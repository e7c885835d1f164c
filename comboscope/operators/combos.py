"""Best bundle per period under category, food, beverage, manufacturer, size and discount rules.

Every rule concerns one period, and the objective adds up over periods, so periods are solved apart.
An item enters a bundle at its regular price or at its best reduced price; a bundle's score is the
weighted profit of its members plus the weighted correlation of its valid pairs. Since exactly one
member is a food and valid pairs join a food with a non-food, the score is a sum over members once
the food is known. The search is exact.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from comboscope.constants import COMPETING_MANUFACTURERS, MONTH_NAMES, OFFER_MONTHS
from comboscope.functions.quantiles import exact_quantiles
from comboscope.functions.storage import written


@dataclass(frozen=True)
class Rules:
    """Sizes, weights and limits of a bundle. ``one_food`` False asks for at least one food."""

    min_size: int = 2
    max_size: int = 2
    alpha: float = 0.6
    one_food: bool = True
    max_beverages: int | None = 2
    competing: list[tuple[str, str]] = field(default_factory=lambda: COMPETING_MANUFACTURERS)
    max_reused: int = 1

    def __post_init__(self):
        if not 2 <= self.min_size <= self.max_size:
            raise ValueError("sizes must satisfy 2 <= min_size <= max_size")
        if not self.one_food and self.max_size > 2:
            raise ValueError("bundles with several foods are supported for size 2")


def valid_pairs(pairs: DataFrame, items: DataFrame, quantile: float = 0.75, cut: float | None = None) -> DataFrame:
    """(food, other, corr) for pairs of one food and one non-food at or above the quantile of all
    pair correlations, or at or above a ``cut`` known already (``correlation.strongest_pairs``)."""
    if cut is None:
        cut = exact_quantiles(pairs, "corr", [quantile])[0]
    kind = items.select("product_desc", "is_food")
    out = (pairs.where(F.col("corr") >= F.lit(cut))
           .join(kind.select(F.col("product_desc").alias("item_a"), F.col("is_food").alias("_fa")), "item_a")
           .join(kind.select(F.col("product_desc").alias("item_b"), F.col("is_food").alias("_fb")), "item_b")
           .where(F.col("_fa") != F.col("_fb")))
    a_food = F.col("_fa") == 1
    return out.select(F.when(a_food, F.col("item_a")).otherwise(F.col("item_b")).alias("food"),
                      F.when(a_food, F.col("item_b")).otherwise(F.col("item_a")).alias("other"), "corr")


def item_table(flags: DataFrame, categories: DataFrame, rules: Rules, used: DataFrame | None = None) -> DataFrame:
    """Per item what the rules look at: categories, food and beverage flags, the competing pairs
    its manufacturer is in, and whether it was used before. An item without category is a category
    of its own."""
    cats = categories.where(F.col("category_desc").isNotNull()).groupBy("product_desc").agg(
        F.array_sort(F.collect_set("category_desc")).alias("cats"))
    empty = F.array().cast("array<int>")
    groups = F.concat(empty, *[F.when(F.col("manufacturer").isin(list(p)), F.array(F.lit(i))).otherwise(empty)
                               for i, p in enumerate(rules.competing)])
    out = flags.join(cats, "product_desc", "left").select(
        F.col("product_desc").alias("item"), F.coalesce("cats", F.array(F.concat(F.lit("item:"), "product_desc"))).alias("cats"),
        F.col("is_food").cast("int").alias("food"), F.col("is_beverage").cast("int").alias("bev"),
        F.coalesce(groups, empty).alias("groups"))
    if used is None:
        return out.withColumn("reused", F.lit(0))
    marks = used.select(F.col("product_desc").alias("item")).distinct().withColumn("reused", F.lit(1))
    return out.join(marks, "item", "left").na.fill(0, ["reused"])


def price_options(profits: DataFrame, items: DataFrame, rules: Rules) -> DataFrame:
    """Two choices per item and period: the regular price (flag 0) and the best reduced one (flag 1)."""
    flag = (F.col("k") > 0).cast("int")
    best = profits.groupBy("period", F.col("product_desc").alias("item"), flag.alias("flag")).agg(
        F.min(F.struct((-F.col("profit")).alias("loss"), "k", "price")).alias("b"))
    profit = -F.col("b.loss")
    return best.select("period", "item", "flag", (F.lit(rules.alpha) * profit).alias("value"), profit.alias("profit"),
                       F.col("b.k").alias("k"), F.col("b.price").alias("price")).join(items, "item")


KIND = ["food", "bev", "groups", "flag", "reused"]  # options alike in these differ only in value and category
CHOICE = ["item", "k", "price", "profit"]


def _best_of_kind(options: DataFrame, within: list[str], blocked: int, spare: int = 0) -> DataFrame:
    """The options of each kind that some best bundle may need.

    The other members of a bundle rule out at most ``blocked`` categories, and at most ``spare``
    options may be worth less than listed. Within a category set only the first ``1 + spare``
    matter, and an option behind more than ``blocked + spare`` better single-category sets can
    always be exchanged for one of those. So nothing optimal is lost.
    """
    key = [*within, *KIND]
    order = [F.col("value").desc(), "item"]
    place = F.row_number().over(Window.partitionBy(*key, "cats").orderBy(*order))
    tops = options.withColumn("_place", place).where(F.col("_place") <= 1 + spare)
    heads = tops.where((F.col("_place") == 1) & (F.size("cats") == 1))
    keep = blocked + spare + 1
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    last = heads.withColumn("_rank", rank).where(F.col("_rank") <= keep).where(F.col("_rank") == keep)
    floor = last.select(*key, F.col("value").alias("_floor"))
    return (tops.join(floor, key, "left").where(F.col("_floor").isNull() | (F.col("value") >= F.col("_floor")))
            .drop("_place", "_floor"))


def _partners(options: DataFrame, valid: DataFrame, rules: Rules, weight: float) -> DataFrame:
    """Per period and food the options that may accompany it, with the pair's affinity in the value.

    Partners without affinity to the food come from one short list per period; those with affinity
    come from the valid pairs. No food meets every item.
    """
    eligible = options.where(F.col("food") == 0) if rules.one_food else options
    blocked = (rules.max_size - 1) * (options.agg(F.max(F.size("cats"))).first()[0] or 1)
    demoted = valid.where(F.col("corr") < 0).groupBy("food").count().agg(F.max("count")).first()[0] or 0
    shared = written(_best_of_kind(eligible, ["period"], blocked, demoted), "shared-partners")
    foods = options.where(F.col("food") == 1).select("period", F.col("item").alias("anchor")).distinct()
    edges = valid.select(F.col("food").alias("anchor"), F.col("other").alias("item"), "corr")
    apart = (foods.join(shared, "period").where(F.col("anchor") != F.col("item"))
             .join(edges.drop("corr"), ["anchor", "item"], "left_anti"))
    affine = edges.join(eligible, "item").join(foods, ["period", "anchor"], "left_semi")
    affine = affine.withColumn("value", F.col("value") + F.lit(weight) * F.col("corr"))
    both = apart.withColumn("corr", F.lit(None).cast("double")).unionByName(affine)
    return _best_of_kind(both, ["period", "anchor"], blocked)


def _extend(sets: DataFrame, partners: DataFrame, rules: Rules, first: bool) -> DataFrame:
    """Sets with one more member, where the rules on members still hold."""
    p = partners.select(
        "period", "anchor", F.col("item").alias("_item"), F.col("cats").alias("_cats"), F.col("groups").alias("_groups"),
        F.col("bev").alias("_bev"), F.col("reused").alias("_reused"), F.col("flag").alias("_flag"),
        F.col("value").alias("_value"), F.col("corr").alias("_corr"), F.struct(*CHOICE).alias("_choice"))
    joined = sets.join(p, ["period", "anchor"])
    if not first:  # members after the food in name order, so each set is built once
        joined = joined.where(F.col("_item") > F.col("last"))
    ok = ~F.arrays_overlap("cats", "_cats") & ~F.arrays_overlap("groups", "_groups")
    ok = ok & (F.col("reused") + F.col("_reused") <= rules.max_reused)
    if rules.max_beverages is not None:
        ok = ok & (F.col("bev") + F.col("_bev") <= rules.max_beverages)
    return joined.where(ok).select(
        "period", "anchor", F.col("_item").alias("last"), F.concat("cats", "_cats").alias("cats"),
        F.concat("groups", "_groups").alias("groups"), (F.col("bev") + F.col("_bev")).alias("bev"),
        (F.col("reused") + F.col("_reused")).alias("reused"), F.greatest("flag", "_flag").alias("flag"),
        (F.col("score") + F.col("_value")).alias("score"),
        F.concat("members", F.array("_choice")).alias("members"),
        F.concat("affinity", F.when(F.col("_corr").isNull(), F.array().cast("array<double>"))
                 .otherwise(F.array("_corr"))).alias("affinity"))


def _best_sets(sets: DataFrame) -> DataFrame:
    """The best finished set per period; equal scores go by item names."""
    names = F.array_sort(F.transform("members", lambda m: m["item"]))
    return sets.where(F.col("flag") == 1).groupBy("period").agg(
        F.min(F.struct((-F.col("score")).alias("loss"), names.alias("items"), "members", "affinity")).alias("b"))


def best_bundles(profits: DataFrame, items: DataFrame, valid: DataFrame, scale: float, rules: Rules = Rules()) -> DataFrame:
    """One row per period with a bundle: score, items, members (item, k, price, profit) and the
    correlations of its valid pairs. A period whose best score is negative has no bundle."""
    weight = (1 - rules.alpha) * scale
    options = written(price_options(profits, items, rules), "price-options")
    partners = written(_partners(options, valid, rules, weight), "partners")
    sets = options.where((F.col("food") == 1) & (F.col("reused") <= rules.max_reused)).select(
        "period", F.col("item").alias("anchor"), F.col("item").alias("last"), "cats", "groups", "bev", "reused", "flag",
        F.col("value").alias("score"), F.array(F.struct(*CHOICE)).alias("members"),
        F.array().cast("array<double>").alias("affinity"))
    top = partners.groupBy("period", "anchor").agg(F.greatest(F.max("value"), F.lit(0.0)).alias("_top"))
    found: list[DataFrame] = []
    for size in range(2, rules.max_size + 1):
        sets = _extend(sets, partners, rules, first=size == 2)
        if size < rules.max_size:
            sets = written(sets, "bundle-sets")
        if size >= rules.min_size:
            best = written(_best_sets(sets), "best-sets")
            found.append(best)
        if size < rules.max_size and found:
            # A set that cannot reach the best finished one even with the best partners is dropped.
            reached = reduce(DataFrame.unionByName, found).groupBy("period").agg((-F.min("b.loss")).alias("_reached"))
            hope = F.col("score") + F.lit(rules.max_size - size) * F.col("_top")
            sets = (sets.join(top, ["period", "anchor"]).join(reached, "period", "left")
                    .where(hope >= F.greatest(F.coalesce("_reached", F.lit(0.0)), F.lit(0.0)) - F.lit(1e-9))
                    .drop("_top", "_reached"))
    winner = reduce(DataFrame.unionByName, found).groupBy("period").agg(F.min("b").alias("b"))
    return winner.where(F.col("b.loss") <= 0).select(
        "period", (-F.col("b.loss")).alias("score"), "b.items", "b.members", "b.affinity")


def solution_table(bundles: DataFrame) -> DataFrame:
    """One row per period and chosen product."""
    m = F.explode("members").alias("m")
    return bundles.select("period", m).select(
        F.col("m.item").alias("product_desc"), "period", F.col("m.price").alias("price_selected"),
        F.col("m.k").alias("price_level_index"), F.lit(1).alias("included"), F.lit(1).alias("gamma"), F.lit(1).alias("bundle_active"))


def bundle_metrics(bundles: DataFrame, max_size: int) -> DataFrame:
    """Realised profit per product slot, mean correlation of the chosen valid pairs, objective."""
    rows = bundles.select(
        F.aggregate("members", F.lit(0.0), lambda s, m: s + m["profit"]).alias("profit"),
        F.aggregate("affinity", F.lit(0.0), lambda s, c: s + c).alias("corr"), F.size("affinity").alias("n"), "score")
    return rows.agg((F.coalesce(F.sum("profit"), F.lit(0.0)) / max_size).alias("realized_profit"),
                    F.coalesce(F.try_divide(F.sum("corr"), F.sum("n")), F.lit(0.0)).alias("average_corr"),
                    F.coalesce(F.sum("score"), F.lit(0.0)).alias("objective"))


def _month_label(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), number)


def in_offer_order(solution: DataFrame) -> DataFrame:
    """A solution by product and month."""
    return solution.orderBy("product_desc", "period")


def offer_blocks(solution: DataFrame, months: list[int] = OFFER_MONTHS) -> DataFrame:
    """Runs of consecutive months per product, prices in month columns (0 when not offered)."""
    w = Window.partitionBy("product_desc").orderBy("period")
    runs = solution.withColumn("_run", F.col("period") - F.row_number().over(w))
    spans = runs.groupBy("product_desc", "_run").agg(F.concat_ws(
        " - ", _month_label(F.min("period")), _month_label(F.max("period"))).alias("time_frame"), *[
        F.coalesce(F.max(F.when(F.col("period") == m, F.col("price_selected"))), F.lit(0.0)).alias(MONTH_NAMES[m - 1])
        for m in months])
    return spans.drop("_run")


def monthly_offers(blocks: DataFrame, costs: DataFrame, months: list[int] = OFFER_MONTHS) -> DataFrame:
    """Per month the offered items with prices and costs, in item order; every month has a row."""
    cells = F.array(*[F.struct(F.lit(m).alias("period"), F.col(MONTH_NAMES[m - 1]).alias("price")) for m in months])
    long = blocks.select("product_desc", F.inline(cells)).where(F.col("price") > 0).join(
        costs.select("product_desc", "cost"), "product_desc", "left")
    lists = long.groupBy("period").agg(F.array_sort(F.collect_list(F.struct("product_desc", "price", "cost"))).alias("o"))
    every = blocks.sparkSession.range(1).select(F.explode(F.array(*[F.lit(m) for m in months])).alias("period"))
    pick = lambda f: F.coalesce(F.transform("o", lambda x: x[f]), F.array())
    return every.join(lists, "period", "left").select(
        "period", _month_label(F.col("period")).alias("month"), pick("product_desc").alias("combo_items"),
        pick("price").alias("combo_prices"), pick("cost").alias("costs"))


def expand_blocks(solution: DataFrame, start: str, end: str, days: int = 30) -> DataFrame:
    """A solution per block of days as one row per day up to ``end``."""
    first = F.date_add(F.lit(start).cast("date"), F.col("period") * days)
    last = F.least(F.date_add(first, days - 1), F.lit(end).cast("date"))
    return solution.withColumn("ds", F.explode(F.sequence(first, last)))

"""Fitted demand to price ladders, profits and the monthly bundles."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from comboscope.constants import OFFER_END, OFFER_START
from comboscope.functions.storage import written
from comboscope.operators import combos, pricing


def plan_offers(params: DataFrame, coefs: DataFrame, time: DataFrame, pairs: DataFrame, flags: DataFrame,
                categories: DataFrame, rules: combos.Rules = combos.Rules(), start: str = OFFER_START,
                end: str = OFFER_END, quantile: float = 0.75, cut: float | None = None) -> dict[str, DataFrame]:
    """Four monthly bundle runs: two items, two items that differ from the first run's, up to three
    and up to four items. Each gives a solution, its metrics and its report. With the ``cut`` of
    ``correlation.strongest_pairs``, ``pairs`` need only hold the pairs from there on."""
    ladder = written(pricing.price_ladder(params), "ladder")
    profits = written(pricing.monthly_profit(pricing.base_sales(params, ladder, coefs, time, start, end), ladder), "profits")
    valid = written(combos.valid_pairs(pairs, flags, quantile, cut), "valid-pairs")
    out = {"ladder": ladder, "without_ladder": pricing.without_ladder(params, ladder), "profits": profits}

    def run(name: str, size: int, used: DataFrame | None = None) -> DataFrame:
        these = replace(rules, min_size=2, max_size=size)
        scale = pricing.objective_scale(profits, pairs, size)
        items = combos.item_table(flags, categories, these, used)
        bundles = written(combos.best_bundles(profits, items, valid, scale, these), "bundles")
        solution = combos.solution_table(bundles)
        out[name] = combos.monthly_offers(combos.offer_blocks(solution), params)
        out[f"{name}_raw"] = solution
        out[f"{name}_metrics"] = combos.bundle_metrics(bundles, size)
        return solution

    first = run("two_items_combo1", 2)
    run("two_items_combo2", 2, first)
    run("three_items_combo", 3)
    run("four_items_combo", 4)
    return out

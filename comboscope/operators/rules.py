"""Association rules with item sets on both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

METRICS = ["support", "confidence", "lift", "leverage", "conviction", "zhang"]
LOW_BITS = 10  # sets of up to so many items list their splits; larger ones look their frequent subsets up


def association_rules(itemsets: DataFrame, metric: str = "lift", min_threshold: float = 1.3,
                      group: list[str] = []) -> DataFrame:
    """Every split of every frequent itemset into antecedent and consequent, kept by a metric.

    Both sides must be in the table. So a large set is joined to the sets of the table inside it, and the
    work follows their number, not the 2^n splits of the set. ``group`` holds columns that separate independent minings (for instance the chunk).
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    def side(name: str, support: str) -> DataFrame:
        return itemsets.select(*group, F.col("items").alias(name), F.col("support").alias(support))

    few = itemsets.where(F.size("items").between(2, LOW_BITS))
    masks = (few.select(*group, "items", "support", F.expr("explode(sequence(1, cast(shiftleft(1, size(items)) - 2 as int))) as _mask"))
             .select(*group, "support",
                     F.expr("filter(items, (x, i) -> (shiftright(_mask, i) & 1) = 1)").alias("antecedents"),
                     F.expr("filter(items, (x, i) -> (shiftright(_mask, i) & 1) = 0)").alias("consequents"))
             .join(side("antecedents", "antecedent_support"), [*group, "antecedents"]))
    # a larger set meets the frequent sets whose least item it has; those inside it are its antecedents
    inner = side("antecedents", "antecedent_support").withColumn("_key", F.array_min("antecedents"))
    many = itemsets.where(F.size("items") > LOW_BITS).select(*group, "items", "support", F.explode("items").alias("_key"))
    met = many.join(inner, [*group, "_key"]).where((F.size("antecedents") < F.size("items")) & (F.size(F.array_except("antecedents", "items")) == 0))
    if metric == "confidence":  # known before the consequent's own support
        met = met.where(F.col("support") >= F.col("antecedent_support") * F.lit(float(min_threshold)) * (1 - 1e-9))
    subsets = met.select(*group, "support", "antecedents", F.array_except("items", "antecedents").alias("consequents"), "antecedent_support")
    both = masks.unionByName(subsets).join(side("consequents", "consequent_support"), [*group, "consequents"])
    s, a, c = F.col("support"), F.col("antecedent_support"), F.col("consequent_support")
    confidence, leverage = s / a, s - a * c
    spread = F.greatest(s * (1 - a), a * (c - s))
    rules = (both.withColumn("confidence", confidence).withColumn("lift", confidence / c)
             .withColumn("leverage", leverage)
             .withColumn("conviction", F.when(confidence >= 1, F.lit(float("inf")))
                         .otherwise(F.try_divide(1 - c, 1 - confidence)))
             .withColumn("zhang", F.when(spread == 0, F.lit(0.0)).otherwise(F.try_divide(leverage, spread))))
    return rules.where(F.col(metric) >= F.lit(float(min_threshold))).select(
        *group, "antecedents", "consequents", "antecedent_support", "consequent_support", *METRICS)


def rule_edges(rules: DataFrame) -> DataFrame:
    """First antecedent and first consequent (by name) of each rule, with a stable rule id."""
    first = [F.element_at(F.array_sort(c), 1).alias(c[:-1]) for c in ("antecedents", "consequents")]
    return rules.select(*first, F.sha2(F.to_json(F.struct("antecedents", "consequents")), 256).alias("rule"))


def confidence_table(rules: DataFrame, antecedents: list[str]) -> DataFrame:
    """Consequents by the given antecedents (names joined with ','), confidence in the cells."""
    named = rules.select(F.array_join("consequents", ",").alias("consequents"),
                         F.array_join("antecedents", ",").alias("antecedents"), "confidence")
    return named.groupBy("consequents").pivot("antecedents", antecedents).agg(F.first("confidence"))

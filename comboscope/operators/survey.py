"""Survey cleaning, bundle match and Net Promoter Scores."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from comboscope.constants import SURVEY_COMBOS
from comboscope.functions.expr import engagement_level, named

SEGMENT = ["rating_column", "spending", "engagement", "is_vege"]
ROLLUPS = [
    ["rating_column"], ["rating_column", "engagement"], ["rating_column", "spending"],
    ["rating_column", "engagement", "is_vege"], ["rating_column", "spending", "is_vege"],
]


def checkbox(c: str) -> Column:
    """'x' is 1 and empty is 0; numbers stay."""
    return F.when(named(c) == "x", 1).when(named(c).isNull(), 0).otherwise(named(c).try_cast("int"))


def clean_survey(raw: DataFrame, item_columns: list[str], drop: list[str] = [], rename: dict[str, str] = {},
                 attention_column: str = "Attention", attention_answer: str = "Somewhat satisfied") -> DataFrame:
    """Attentive responses with the ticked items as one array."""
    kept = raw.drop(*drop).where(named(attention_column) == attention_answer).withColumnsRenamed(rename)
    names = [rename.get(c, c) for c in item_columns]
    ticked = F.array(*[F.when(checkbox(n) == 1, F.lit(n)) for n in names])
    return kept.withColumn("chosen_items", F.filter(ticked, lambda x: x.isNotNull())).drop(*names, attention_column)


def combo_size(name: str) -> int:
    """Size stated in a bundle's name, as in 'combo3_size4'."""
    return int(re.fullmatch(r".*_size(\d+)", name).group(1))


def match_percent(matched: Column, size: Column | int) -> Column:
    return matched / size * 100


def with_matches(survey: DataFrame, combos: dict[str, list[str]] = SURVEY_COMBOS) -> DataFrame:
    """Per bundle how many of its items were chosen, in percent of its size, and the level."""
    for name, items in combos.items():
        short = name.rsplit("_size", 1)[0]
        matched = F.size(F.array_intersect("chosen_items", F.array(*[F.lit(i) for i in items])))
        survey = (survey.withColumn(name, matched)
                  .withColumn(f"{short}_percent", match_percent(F.col(name), combo_size(name)))
                  .withColumn(f"{short}_engagement", engagement_level(f"{short}_percent")))
    return survey


def rating_rows(survey: DataFrame, ratings: dict[str, str], spending: str, vege: str) -> DataFrame:
    """Long ratings: ``ratings`` maps each rating column to its bundle's engagement column."""
    cells = F.array(*[F.struct(F.lit(c).alias("rating_column"), named(c).cast("int").alias("rating"), named(e).alias("engagement"))
                      for c, e in ratings.items()])
    return survey.select(named(spending).alias("spending"), named(vege).alias("is_vege"), F.inline(cells))


def nps_counts(rating: str = "rating") -> list[Column]:
    """Promoters (9-10), passives (7-8), detractors (0-6) and the score; null without answers."""
    x = F.col(rating)
    promoters, detractors = F.count_if(x >= 9), F.count_if(x <= 6)
    return [promoters.alias("promoters"), F.count_if(x.between(7, 8)).alias("passives"), detractors.alias("detractors"),
            F.try_divide((promoters - detractors) * 100.0, F.count(x)).alias("nps")]


def nps_segments(rows: DataFrame, segment: list[str] = SEGMENT) -> DataFrame:
    """Scores per segment over responses where everything is present."""
    return rows.na.drop(subset=[*segment, "rating"]).groupBy(*segment).agg(*nps_counts())


def nps_rollups(segments: DataFrame, rollups: list[list[str]] = ROLLUPS, segment: list[str] = SEGMENT) -> DataFrame:
    """All roll-ups of the segments in one pass; ``rollup`` names the grouping of each row."""
    p, d = F.sum("promoters"), F.sum("detractors")
    total = p + F.sum("passives") + d
    rollup = F.concat_ws(",", *[F.when(F.grouping(c) == 0, F.lit(c)) for c in segment])
    return segments.groupingSets([tuple(g) for g in rollups], *segment).agg(
        rollup.alias("rollup"), p.alias("promoters"), F.sum("passives").alias("passives"), d.alias("detractors"),
        total.alias("total_responses"), F.try_divide((p - d) * 100.0, total).alias("overall_nps"))


def promising(rollups: DataFrame, threshold: float = -20.0) -> DataFrame:
    return rollups.where(F.col("overall_nps") >= threshold)


def definitions(spark) -> dict[str, DataFrame]:
    """The two explanatory tables of the report."""
    levels = [("<= 1%", "None"), ("2% to 33%", "Low"), ("34% to 55%", "Medium"), ("56% to 100%", "High")]
    ratings = [("Rating 9-10", "Promoters"), ("Rating 7-8", "Passives"), ("Rating 0-6", "Detractors")]
    return {"engagement_label_definition": spark.createDataFrame(levels, "Threshold string, Category string"),
            "nps_definition": spark.createDataFrame(ratings, "Range string, Category string")}

"""Survey responses to the report's nine tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from comboscope.constants import SURVEY_COMBOS, VEGE_KEYWORDS
from comboscope.functions.storage import written
from comboscope.operators import comments, survey


def plan_survey(raw: DataFrame, item_columns: list[str], rating_columns: list[str], spending: str, text_columns: list[str],
                drop: list[str] = [], rename: dict[str, str] = {}, combos: dict[str, list[str]] = SURVEY_COMBOS,
                keywords: list[str] = VEGE_KEYWORDS, stop_words: list[str] | None = None, min_count: int = 2,
                distance: float = 0.4) -> dict[str, DataFrame]:
    """Segmented scores, their roll-ups and the grouped comments; ratings are in bundle order."""
    matched = survey.with_matches(survey.clean_survey(raw, item_columns, drop, rename), combos)
    noted = written(comments.annotate(matched, text_columns, keywords, stop_words), "survey")
    levels = [f"{name.rsplit('_size', 1)[0]}_engagement" for name in combos]
    rows = survey.rating_rows(noted, dict(zip(rating_columns, levels)), spending, "is_vege_any")
    segments = written(survey.nps_segments(rows), "segments")
    rolled = written(survey.nps_rollups(segments), "rollups")
    counts = comments.phrase_counts(noted, [f"{c}_phrases" for c in text_columns], min_count)
    names = {"overall_nps": ["rating_column"], "engagement_level": ["rating_column", "engagement"],
             "spending_level": ["rating_column", "spending"], "is_vege_engagement_level": ["rating_column", "engagement", "is_vege"],
             "is_vege_spending_level": ["rating_column", "spending", "is_vege"]}
    report = {"nlp_phrase_count": comments.cluster_summary(comments.cluster_phrases(counts, distance)), "raw_segmented_nps": segments}
    for name, grouping in names.items():
        key = ",".join(c for c in survey.SEGMENT if c in grouping)
        report[name] = rolled.where(rolled["rollup"] == key).select(
            *[c for c in survey.SEGMENT if c in grouping], "promoters", "passives", "detractors", "total_responses", "overall_nps")
    return {**report, **survey.definitions(raw.sparkSession)}

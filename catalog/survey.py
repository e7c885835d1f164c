"""Survey and comment queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, r
from catalog.views import table
from comboscope.functions import expr
from comboscope.functions.storage import written
from comboscope.operators import comments, survey

STOP = ["the", "of", "and", "is", "it", "in", "that", "to", "for", "on", "as", "with", "was", "are", "this", "an", "at", "be",
        "le", "la", "de", "les", "un", "en", "et", "du"]
WORDS = ["the of", "re", "hon", "esen", "for and", "la"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
COMBOS = {"combo1_size2": ["ECONOMY", "PROMO"], "combo2_size3": ["LARGE", "SMALL", "STANDARD"]}


def rating_rows(spark, sf):
    """Events as long ratings: five rating columns, four spending bands, a match level and a flag."""
    e = table(spark, sf, "events")
    match = F.get_json_object("props", "$.k").cast("int") % 5
    return e.select(
        F.col("event_type").alias("rating_column"), F.least(F.floor(F.col("value") / 10), F.lit(10)).cast("int").alias("rating"),
        F.concat(F.lit("S"), (F.col("user_id") % 4).cast("string")).alias("spending"),
        expr.engagement_level(survey.match_percent(match, 4)).alias("engagement"), (F.col("user_id") % 2).cast("int").alias("is_vege"))


RATINGS = """
    WITH m AS (SELECT event_type AS rating_column, CAST(LEAST(floor(value / 10), 10) AS INTEGER) AS rating, 'S' || (user_id % 4) AS spending,
        (CAST(json_extract_string(props, '$.k') AS INTEGER) % 5) / 4 * 100 AS pct, CAST(user_id % 2 AS INTEGER) AS is_vege FROM events),
    rows AS (SELECT *, CASE WHEN pct <= 1 THEN 'None' WHEN pct <= 33 THEN 'Low' WHEN pct <= 55 THEN 'Medium' WHEN pct <= 100 THEN 'High' END
        AS engagement FROM m),
    seg AS (SELECT rating_column, spending, engagement, is_vege, COUNT(*) FILTER (rating >= 9) AS promoters,
        COUNT(*) FILTER (rating BETWEEN 7 AND 8) AS passives, COUNT(*) FILTER (rating <= 6) AS detractors, COUNT(rating) AS n FROM rows
        WHERE rating IS NOT NULL AND engagement IS NOT NULL GROUP BY 1, 2, 3, 4)"""


@query("survey_engagement", RATINGS + " SELECT engagement, is_vege, COUNT(*) AS n FROM rows GROUP BY 1, 2")
def survey_engagement(spark, sf):
    return rating_rows(spark, sf).groupBy("engagement", "is_vege").agg(F.count("*").alias("n"))


@query("nps_overall", RATINGS + """
    SELECT rating_column, COUNT(*) FILTER (rating >= 9) AS promoters, COUNT(*) FILTER (rating BETWEEN 7 AND 8) AS passives,
        COUNT(*) FILTER (rating <= 6) AS detractors, ROUND((COUNT(*) FILTER (rating >= 9) - COUNT(*) FILTER (rating <= 6)) * 100.0 / COUNT(rating), 6)::DOUBLE AS nps
    FROM rows GROUP BY 1""")
def nps_overall(spark, sf):
    return rating_rows(spark, sf).groupBy("rating_column").agg(*survey.nps_counts()).withColumn("nps", r("nps"))


@query("nps_segments", RATINGS + """
    SELECT rating_column, spending, engagement, is_vege, promoters, passives, detractors,
        ROUND((promoters - detractors) * 100 / n, 6) AS nps FROM seg""")
def nps_segments(spark, sf):
    return survey.nps_segments(rating_rows(spark, sf)).withColumn("nps", r("nps"))


ROLLUP = RATINGS + """,
    roll AS (SELECT rating_column, spending, engagement, is_vege, concat_ws(',', 'rating_column', CASE WHEN GROUPING(spending) = 0 THEN 'spending' END,
        CASE WHEN GROUPING(engagement) = 0 THEN 'engagement' END, CASE WHEN GROUPING(is_vege) = 0 THEN 'is_vege' END) AS rollup,
        CAST(SUM(promoters) AS BIGINT) AS promoters, CAST(SUM(passives) AS BIGINT) AS passives, CAST(SUM(detractors) AS BIGINT) AS detractors,
        CAST(SUM(promoters + passives + detractors) AS BIGINT) AS total_responses,
        ROUND((SUM(promoters) - SUM(detractors)) * 100 / SUM(promoters + passives + detractors), 6)::DOUBLE AS overall_nps FROM seg
        GROUP BY GROUPING SETS ((rating_column), (rating_column, engagement), (rating_column, spending),
            (rating_column, engagement, is_vege), (rating_column, spending, is_vege)))"""


def rollups(spark, sf):
    return survey.nps_rollups(survey.nps_segments(rating_rows(spark, sf)))


@query("nps_rollups", ROLLUP + " SELECT * FROM roll")
def nps_rollups(spark, sf):
    return rollups(spark, sf).withColumn("overall_nps", r("overall_nps"))


@query("nps_promising", ROLLUP + " SELECT * FROM roll WHERE overall_nps >= -58")
def nps_promising(spark, sf):
    return survey.promising(rollups(spark, sf), -58).withColumn("overall_nps", r("overall_nps"))


@query("survey_clean", """
    WITH bought AS (SELECT DISTINCT o_custkey, p_type FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey),
    c AS (SELECT c_custkey AS respondent, list_sort(list(p_type) FILTER (p_type IS NOT NULL)) AS chosen FROM customer
        LEFT JOIN bought ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING' GROUP BY 1),
    m AS (SELECT *, COALESCE(len(list_intersect(chosen, ['ECONOMY', 'PROMO'])), 0) AS combo1_size2,
        COALESCE(len(list_intersect(chosen, ['LARGE', 'SMALL', 'STANDARD'])), 0) AS combo2_size3 FROM c)
    SELECT respondent, COALESCE(array_to_string(chosen, ';'), '') AS chosen_items, combo1_size2, combo2_size3,
        combo1_size2 / 2 * 100 AS combo1_percent, ROUND(combo2_size3 / 3 * 100, 6) AS combo2_percent,
        CASE WHEN combo1_size2 = 0 THEN 'None' WHEN combo1_size2 = 1 THEN 'Medium' ELSE 'High' END AS combo1_engagement,
        CASE WHEN combo2_size3 = 0 THEN 'None' WHEN combo2_size3 = 1 THEN 'Medium' ELSE 'High' END AS combo2_engagement FROM m""")
def survey_clean(spark, sf):
    bought = (table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
              .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")))
    ticks = bought.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        *[F.max(F.when(F.col("p_type") == t, "x")).alias(f"item {t}") for t in TYPES])
    raw = table(spark, sf, "customer").join(ticks, "c_custkey", "left").withColumnRenamed("c_mktsegment", "Attention")
    clean = survey.clean_survey(raw, [f"item {t}" for t in TYPES], drop=["c_name", "IP address"],
                                rename={f"item {t}": t for t in TYPES}, attention_answer="BUILDING")
    out = survey.with_matches(clean, COMBOS)
    return out.select(
        F.col("c_custkey").alias("respondent"), F.array_join(F.sort_array("chosen_items"), ";").alias("chosen_items"),
        "combo1_size2", "combo2_size3", "combo1_percent", r("combo2_percent"), "combo1_engagement", "combo2_engagement")


def texts(spark, sf):
    """Comments: all documents and all that was said."""
    docs = table(spark, sf, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("id"), "text")
    said = table(spark, sf, "conversations").select(
        F.concat(F.lit("c"), F.col("conv_id"), F.lit("-"), F.col("turn")).alias("id"), "text")
    return docs.unionByName(said)


TEXTS = """
    texts AS (SELECT 'd' || doc_id AS id, text FROM documents UNION ALL
        SELECT 'c' || conv_id || '-' || turn, text FROM conversations)"""
STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP) + "]"
PHRASES = f"""
    parts AS (SELECT id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_''-]+|[^\\p{{L}}\\p{{N}}_''\\s-]') AS p FROM texts),
    runs AS (SELECT id, string_split(array_to_string(list_transform(p, lambda x: CASE WHEN list_contains({STOP_SQL}, x)
        OR NOT regexp_matches(x, '[\\p{{L}}\\p{{N}}_''-]') THEN chr(10) ELSE x END), ' '), chr(10)) AS r FROM parts),
    phrases AS (SELECT id, list_filter(list_transform(r, lambda x: trim(x)), lambda x: x <> '') AS phrases FROM runs),
    counts AS (SELECT phrase, COUNT(*) AS count FROM (SELECT unnest(phrases) AS phrase FROM phrases) GROUP BY 1)"""


@query("keyword_flags", f"""
    WITH f AS (SELECT doc_id, CAST(regexp_matches(text, '(?i)(^|[^\\p{{L}}\\p{{N}}_])({'|'.join(WORDS)})([^\\p{{L}}\\p{{N}}_]|$)') AS INTEGER) AS a,
        CAST(regexp_matches(source, '(?i)(^|[^\\p{{L}}\\p{{N}}_])({'|'.join(WORDS)})([^\\p{{L}}\\p{{N}}_]|$)') AS INTEGER) AS b FROM documents)
    SELECT doc_id, greatest(COALESCE(a, 0), COALESCE(b, 0)) AS is_vege_any FROM f""")
def keyword_flags(spark, sf):
    docs = comments.annotate(table(spark, sf, "documents"), ["text", "source"], WORDS, STOP)
    return docs.select("doc_id", "is_vege_any")


@query("tokens", f"""
    SELECT doc_id, array_to_string(list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'),
        lambda w: regexp_matches(w, '^\\p{{L}}+$') AND NOT list_contains({STOP_SQL}, w)), ' ') AS cleaned FROM documents""")
def tokens(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(comments.tokens("text", STOP), " ").alias("cleaned"))


@query("phrase_lists", f"WITH {TEXTS}, {PHRASES} SELECT id, array_to_string(phrases, '|') AS phrases FROM phrases")
def phrase_lists(spark, sf):
    return texts(spark, sf).select("id", F.array_join(comments.phrases("text", STOP), "|").alias("phrases"))


def counted(spark, sf, min_count):
    listed = texts(spark, sf).select(comments.phrases("text", STOP).alias("text_phrases"))
    return comments.phrase_counts(listed, ["text_phrases"], min_count)


@query("phrase_counts", f"WITH {TEXTS}, {PHRASES} SELECT * FROM counts WHERE count >= 2")
def phrase_counts(spark, sf):
    return comments.by_count(counted(spark, sf, 2))


CLUSTERS = f"""
    WITH RECURSIVE {TEXTS}, {PHRASES},
    kept AS MATERIALIZED (SELECT * FROM counts WHERE count >= 2),
    grams AS (SELECT phrase, substr(' ' || phrase || ' ', CAST(i AS BIGINT), 3) AS gram FROM (SELECT phrase, unnest(range(1, greatest(len(phrase), 1) + 1)) AS i FROM kept)),
    tf AS (SELECT phrase, gram, COUNT(*) AS tf FROM grams GROUP BY 1, 2),
    idf AS (SELECT gram, ln(((SELECT COUNT(*) FROM kept) + 1.0) / (COUNT(*) + 1.0)) + 1 AS idf FROM tf GROUP BY 1),
    raw AS (SELECT phrase, gram, tf * idf AS w FROM tf JOIN idf USING (gram)),
    vec AS MATERIALIZED (SELECT phrase, gram, w / sqrt(SUM(w * w) OVER (PARTITION BY phrase)) AS w FROM raw),
    near AS MATERIALIZED (SELECT a.phrase AS x, b.phrase AS y FROM vec a JOIN vec b ON a.gram = b.gram AND a.phrase <> b.phrase
        GROUP BY 1, 2 HAVING SUM(a.w * b.w) >= 0.92),
    reach AS (SELECT phrase AS x, phrase AS y FROM kept UNION SELECT reach.x, near.y FROM reach JOIN near ON near.x = reach.y),
    labels AS (SELECT x AS phrase, MIN(y) AS cluster FROM reach GROUP BY 1)"""


@query("phrase_clusters", CLUSTERS + " SELECT phrase, count, cluster FROM kept JOIN labels USING (phrase)")
def phrase_clusters(spark, sf):
    return comments.cluster_phrases(counted(spark, sf, 2))


@query("cluster_summary", CLUSTERS + """
    SELECT cluster, COUNT(*) AS phrases_in_cluster, CAST(SUM(count) AS BIGINT) AS total_count,
        string_agg(phrase, '|' ORDER BY phrase) AS phrases FROM kept JOIN labels USING (phrase) GROUP BY 1""")
def cluster_summary(spark, sf):
    out = comments.cluster_summary(comments.cluster_phrases(counted(spark, sf, 2)))
    return out.withColumn("phrases", F.array_join("phrases", "|"))


@query("cluster_totals", CLUSTERS + """
    SELECT cluster, COUNT(*) AS phrases_in_cluster, CAST(SUM(count) AS BIGINT) AS total_count FROM kept JOIN labels USING (phrase) GROUP BY 1""")
def cluster_totals(spark, sf):
    return comments.cluster_totals(comments.cluster_phrases(counted(spark, sf, 2)))


@query("cluster_members", CLUSTERS + " SELECT cluster, phrase, count FROM kept JOIN labels USING (phrase)")
def cluster_members(spark, sf):
    return comments.cluster_members(written(comments.cluster_phrases(counted(spark, sf, 2)), "clusters"))


def vector_sql(distance: float) -> str:
    return f"""
    WITH RECURSIVE e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
    near AS MATERIALIZED (SELECT a.vec_id AS x, b.vec_id AS y FROM e a JOIN e b ON a.vec_id <> b.vec_id
        AND 2 - 2 * list_cosine_similarity(a.v, b.v) <= {distance} * {distance}),
    reach AS (SELECT vec_id AS x, vec_id AS y FROM e UNION SELECT reach.x, near.y FROM reach JOIN near ON near.x = reach.y)
    SELECT x AS id, MIN(y) AS cluster FROM reach GROUP BY 1"""


def vectors_of(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


@query("vector_clusters", vector_sql(1.1))
def vector_clusters(spark, sf):
    return comments.cluster_vectors(vectors_of(spark, sf), 1.1)


@query("vector_clusters_near", vector_sql(0.4))
def vector_clusters_near(spark, sf):
    return comments.cluster_vectors(vectors_of(spark, sf), 0.4)

"""Registered queries of this subpackage: each operator over its whole table, and the pipeline."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import functions as F

from catalog.registry import query
from catalog.views import table
from comboscope.functions.storage import shared_folder
from comboscope.llm import alignment, decontamination, embeddings, html, jaccard, lm, packing, pii, quality, substrings, tokenfiles, tokens, trie

#: Key of the pseudonyms in these queries; a deployment sets its own.
KEY = "example key"


@query("op1_best_fit_packing")
def op1(spark, sf):
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, limit=2048)


#: All pairs of a label, and what their links reach.
_VECTORS_SQL = """WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
        AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
    links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
        AND CASE WHEN len(a.x) = len(b.x) THEN list_cosine_similarity(a.x, b.x) END >= 0.98),
    reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
    component AS (SELECT a, min(b) AS c FROM reach GROUP BY a), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(c, vec_id) AS component_id, vec_id = coalesce(c, vec_id) AS kept
    FROM embeddings LEFT JOIN counts ON counts.a = vec_id LEFT JOIN component ON component.a = vec_id"""


@query("op2_embedding_near_dedup", _VECTORS_SQL)
def op2(spark, sf):
    return embeddings.near_vectors(table(spark, sf, "embeddings"), threshold=0.98)


#: Documents that share a shingle, the sizes of what they share, and what their links reach.
_JACCARD_SQL = r"""WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
    s AS MATERIALIZED (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS shingles FROM w),
    e AS MATERIALIZED (SELECT doc_id, len(shingles) AS size, unnest(shingles) AS shingle FROM s),
    links AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
        AND 100 * least(a.size, b.size) >= 90 * greatest(a.size, b.size)
        GROUP BY a.doc_id, b.doc_id, a.size, b.size HAVING 100 * count(*) >= 90 * (a.size + b.size - count(*))),
    reach(a, b) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
    component AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
    SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, c AS component_id FROM s JOIN component ON a = doc_id"""


@query("op3_ngram_jaccard_join", _JACCARD_SQL)
def op3(spark, sf):
    return jaccard.near_documents(table(spark, sf, "documents"), k=3, percent=90)


@query("op4_html_extraction")
def op4(spark, sf):
    return html.extract(table(spark, sf, "pages"))


@query("op5_token_counts")
def op5(spark, sf):
    return tokens.token_counts(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


@query("op6_quality_classifier")
def op6(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scorer, rate = quality.train(docs, table(spark, sf, "labels").where(quality.fold("doc_id") != 0))
    held_out = F.coalesce(quality.fold("doc_id") == 0, F.lit(False)).alias("held_out")
    return quality.quality_scores(docs, scorer, rate, threshold=0.3).select("doc_id", held_out, "score", "predicted")


@query("op7_lm_scoring")
def op7(spark, sf):
    return lm.score_documents(table(spark, sf, "documents"), quality.fold("doc_id") == 1, public_tokenizers.path("piece_bpe_32k.model"))


@query("op8_benchmark_decontamination")
def op8(spark, sf):
    return decontamination.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("text_hash")


@query("op9_pii")
def op9(spark, sf):
    return pii.replace_personal(table(spark, sf, "documents"), KEY).select("doc_id", "text", "n_replaced")


#: Every window of 50 words, the first document of each, and the words that later ones cover.
_REPEATS_SQL = r"""WITH w AS MATERIALIZED (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
    win AS MATERIALIZED (SELECT doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS h
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
    earliest AS (SELECT h, min(doc_id) AS d FROM win GROUP BY h),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN earliest USING (h) WHERE doc_id > d),
    words AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w)
    SELECT w.doc_id, any_value(len(ws)) AS n_words, count(gone.p) AS n_removed,
        sha256(coalesce(string_agg(x, ' ' ORDER BY words.p) FILTER (gone.p IS NULL AND x IS NOT NULL), '')) AS kept_sha256
    FROM w LEFT JOIN words ON words.doc_id = w.doc_id LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.p = words.p GROUP BY w.doc_id"""


@query("op10_substring_dedup", _REPEATS_SQL)
def op10(spark, sf):
    out = substrings.remove_repeats(table(spark, sf, "documents"), length=50)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op11_token_files")
def op11(spark, sf):
    docs, path = table(spark, sf, "documents"), f"{shared_folder(spark)}/comboscope/token-files-{uuid.uuid4().hex}"
    tokenfiles.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return tokenfiles.read(spark, path, docs.schema["doc_id"].dataType.simpleString())


#: The trie of op12 from lists of turns: every prefix is a list, hashed; totals by joining each node's prefixes.
_TRIE_SQL = """WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos FROM conversations WHERE conv_id IS NOT NULL),
    own AS (SELECT c, list({'r': r, 'x': x} ORDER BY pos) AS turns FROM t GROUP BY c),
    h AS (SELECT c, turns, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
        lambda a, b: list_reduce(list_concat([xor(a, b)], list_transform(range(8), lambda z: CAST(z AS BIGINT))),
            lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS BIGINT)) ELSE v >> 1 END)), CAST(4294967295 AS BIGINT)) % 6 AS h FROM own),
    s AS (SELECT h.c, list_concat(coalesce(list_slice(head.turns, 1, h.h), []), list_slice(h.turns, h.h + 1, len(h.turns))) AS turns
        FROM h LEFT JOIN own AS head ON head.c = h.c - h.c % 100),
    p AS (SELECT c, d, md5(CAST(list_slice(turns, 1, d) AS VARCHAR)) AS k, md5(CAST(list_slice(turns, 1, d - 1) AS VARCHAR)) AS parent,
        CASE WHEN d > 0 THEN length(turns[d].x) ELSE 0 END AS size, d = len(turns) AS last
        FROM (SELECT c, turns, unnest(range(len(turns) + 1)) AS d FROM s)),
    n AS (SELECT d, k, any_value(CASE WHEN d > 0 THEN parent END) AS parent, min(c) AS conv_id, count(*) AS n_convs, max(size) * (count(*) - 1) AS saved,
        sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '')) AS ends_sha256 FROM p GROUP BY d, k),
    kids AS (SELECT d - 1 AS d, parent AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
    full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (d, k)),
    totals AS (SELECT up.d, up.k, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(f.saved) AS saved_tokens
        FROM full_nodes f JOIN p up ON up.c = f.conv_id AND up.d <= f.d GROUP BY 1, 2)
    SELECT f.conv_id, f.d AS depth, par.conv_id AS parent_conv_id, f.n_convs, f.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
        CAST(saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
    FROM full_nodes f JOIN totals USING (d, k) LEFT JOIN n par ON par.d = f.d - 1 AND par.k = f.parent"""


@query("op12_conversation_trie", _TRIE_SQL)
def op12(spark, sf):
    return trie.prefix_trie(*trie.forked(trie.ordered_turns(table(spark, sf, "conversations"))))


@query("op13_tokenizer_alignment")
def op13(spark, sf):
    return alignment.align(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN,
                           public_tokenizers.path("piece_bpe_32k.model"))


@query("pipeline")
def pipeline(spark, sf):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)

import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from comboscope.functions.storage import written
from comboscope.operators import clusters, comments, survey

STOP = ["the", "a", "and", "of", "is"]


def test_survey_clean_and_match(spark, rows):
    raw = spark.createDataFrame([
        (1, "Somewhat satisfied", "x", None, "x"), (2, "Somewhat satisfied", None, None, None), (3, "Neutral", "x", "x", "x")],
        "ID int, Attention string, `hot dogImage 12` string, `PEPSI 591ML` string, `ESKA 500ML` string")
    clean = survey.clean_survey(raw, ["hot dogImage 12", "PEPSI 591ML", "ESKA 500ML"], ["IP address"], {"hot dogImage 12": "R.GRILL HOT DOG"})
    assert rows(clean) == [(1, ["R.GRILL HOT DOG", "ESKA 500ML"]), (2, [])]
    got = survey.with_matches(clean)
    assert rows(got, "ID", "combo1_size2", "combo1_percent", "combo1_engagement", "combo4_size4", "combo4_engagement") == [
        (1, 1, 50.0, "Medium", 1, "Low"), (2, 0, 0.0, "None", 0, "None")]


def test_nps(spark):
    df = spark.createDataFrame([(v,) for v in (None, 0, 6, 7, 8, 9, 10)], "rating int")
    r = df.agg(*survey.nps_counts()).first()
    assert (r.promoters, r.passives, r.detractors, r.nps) == (2, 2, 2, 0.0)
    assert df.where("rating is null").agg(*survey.nps_counts()).first().nps is None


def test_rollups_add_up(spark):
    rng = np.random.default_rng(0)
    data = [(f"r{rng.integers(3)}", int(rng.integers(11)) if rng.random() > .1 else None, f"S{rng.integers(2)}",
             ["None", "High", None][rng.integers(3)], int(rng.integers(2))) for _ in range(400)]
    df = spark.createDataFrame(data, "rating_column string, rating int, spending string, engagement string, is_vege int")
    seg = survey.nps_segments(df)
    complete = sum(all(v is not None for v in row) for row in data)
    got = survey.nps_rollups(seg).groupBy("rollup").agg(F.sum("total_responses").alias("n"), F.count("*").alias("rows")).collect()
    assert {r.rollup: r.n for r in got} == {",".join(c for c in survey.SEGMENT if c in g): complete for g in survey.ROLLUPS}
    assert survey.promising(survey.nps_rollups(seg), 101).count() == 0
    assert {r.Category for r in survey.definitions(spark)["nps_definition"].collect()} == {"Promoters", "Passives", "Detractors"}


def test_long_ratings(spark, rows):
    df = spark.createDataFrame([(9, 3, "High", "Low", "10-15", 1)], "r1 int, r2 int, e1 string, e2 string, band string, vege int")
    assert rows(survey.rating_rows(df, {"r1": "e1", "r2": "e2"}, "band", "vege")) == [
        ("10-15", 1, "r1", 9, "High"), ("10-15", 1, "r2", 3, "Low")]


def test_keywords(spark):
    texts = ["Vegan!", "veggies", "no meat", None, "plant-based", "Végé vegan", "trustworthy"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(comments.keyword_flag("t")).collect()] == [1, 0, 1, 0, 1, 1, 0]


def test_tokens_phrases_and_flags(spark):
    df = spark.createDataFrame([("The quick-brown Fox, and a 2nd dog of war", None), (None, "meat")], "other1 string, other2 string")
    got = comments.annotate(df, ["other1", "other2"], stop_words=STOP).collect()
    assert got[0].other1_cleaned == "quick brown fox dog war"
    assert got[0].other1_phrases == ["quick-brown fox", "2nd dog", "war"]
    assert [r.is_vege_any for r in got] == [0, 1]
    assert got[1].other1_phrases == [] and got[1].other1_cleaned == ""


def test_phrase_counts(spark, rows):
    df = spark.createDataFrame([(["x", "y"], ["x"]), (None, ["x"])], "p1 array<string>, p2 array<string>")
    assert rows(comments.phrase_counts(df, ["p1", "p2"])) == [("x", 3), ("y", 1)]
    assert rows(comments.phrase_counts(df, ["p1", "p2"], 2)) == [("x", 3)]


def _components(n, edges):
    label = list(range(n))
    for _ in range(n):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_components_of_chains_stars_and_loners(spark, rows):
    edges = [(i, i + 1) for i in range(0, 40)] + [(50, j) for j in range(51, 70)] + [(80, 80)]
    nodes = spark.range(90)
    got = rows(clusters.components(nodes, spark.createDataFrame(edges, "a long, b long")))
    assert got == sorted(((i, c) for i, c in enumerate(_components(90, edges))), key=repr)


@pytest.mark.parametrize("block", [4, 256])
def test_near_vectors_match_brute_force(spark, rows, monkeypatch, block):
    monkeypatch.setattr(clusters, "BLOCK", block)
    monkeypatch.setattr(clusters.near_edges, "__defaults__", (block,))
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (80, 5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vector array<double>")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    want = _components(80, [(i, j) for i in range(80) for j in range(i) if d[i, j] <= 0.4])
    assert rows(comments.cluster_vectors(df, 0.4)) == sorted(((i, c) for i, c in enumerate(want)), key=repr)
    assert 1 < len(set(want)) < 80


@pytest.mark.parametrize("pivots", [7, None])
def test_cells_compare_few_pairs_of_grouped_vectors(spark, rows, pivots):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1, (40, 24))
    x = np.concatenate([np.repeat(centres, 20, axis=0) + rng.normal(0, 0.06, (800, 24)), np.repeat(centres[:1], 300, axis=0), rng.normal(0, 1, (100, 24))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    n = len(x)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vector array<double>")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    want = _components(n, [(i, j) for i, j in zip(*np.nonzero(d <= 0.4)) if j < i])
    assert rows(comments.cluster_vectors(df, 0.4, pivots=pivots)) == sorted(((i, c) for i, c in enumerate(want)), key=repr)
    assert 40 <= len(set(want)) <= 140
    cells, links = comments.vector_cells(df, 0.4, pivots)
    sizes = np.zeros((n, 4))
    for r in cells.groupBy("key", "kind").count().collect():
        sizes[r.key, r.kind] = r["count"]
    compared = comments.compared_pairs(sizes).sum()
    assert compared < (0.6 if pivots else 0.05) * n * n and all(d[r.a, r.b] <= 0.4 for r in links.collect())


@pytest.mark.parametrize("block", [8, 8192])
def test_members_of_the_largest_group_do_not_meet_again(spark, rows, monkeypatch, block):
    monkeypatch.setattr(comments, "VECTOR_BLOCK", block)
    met = []
    monkeypatch.setattr(comments, "near_edges", lambda rows_, *a, **k: met.append((rows_, k.get("meets"))) or clusters.near_edges(rows_, *a, **k))
    x = np.random.default_rng(4).normal(0, 1, (150, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vector array<double>")
    want = _components(150, [(int(i), int(j)) for i, j in np.argwhere(np.linalg.norm(x[:, None] - x[None], axis=2) <= 0.8) if j < i])
    assert rows(comments.cluster_vectors(df, 0.8)) == sorted(((i, c) for i, c in enumerate(want)), key=repr)
    assert 1 < len(set(want)) < 100
    kinds, meets = dict(met[-1][0].groupBy("kind").count().collect()), met[-1][1]
    assert sum(n for k, n in kinds.items() if k >= 4) > 1 and all(j < 4 for k in range(4, 8) for j in meets[k])


def test_blocks_of_vectors_meet_without_their_whole_matrix(spark, monkeypatch):
    monkeypatch.setattr(comments, "CELL_PART", 1 << 14, raising=False)
    met = []
    monkeypatch.setattr(comments, "near_edges", lambda rows_, key, near, *a, **k: met.append(near) or clusters.near_edges(rows_, key, near, *a, **k))
    x = np.random.default_rng(5).normal(0, 1, (4000, 3))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    comments.cluster_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:50])], "id long, vector array<double>"), 0.05)
    pdf = pd.DataFrame({"vector": list(x), "_lo": 0, "_hi": 1, "_own": np.arange(4000) % 2})
    tracemalloc.start()
    found = met[0](pdf)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4000 * 4000 / 2
    close = (((x[:, None] - x[None]) ** 2).sum(-1) <= 0.05**2) & (np.arange(4000)[:, None] % 2 != np.arange(4000)[None] % 2)
    assert _components(4000, found) == _components(4000, clusters._forest(close)) and len(found) < 4000


def test_no_vectors_give_no_clusters(spark):
    none = spark.createDataFrame([], "id long, vector array<double>")
    assert comments.cluster_vectors(none, 0.4).collect() == []


def test_distance_boundary(spark, rows):
    angles = [0.0, 0.1, 0.1 + 0.39, 0.1 + 0.39 + 0.43]
    df = spark.createDataFrame([(i, [float(np.cos(a)), float(np.sin(a))]) for i, a in enumerate(angles)], "id long, vector array<double>")
    assert rows(comments.cluster_vectors(df, 0.4)) == [(0, 0), (1, 0), (2, 0), (3, 3)]


def test_similar_phrases_match_brute_force(spark, rows):
    words = ["chicken wrap", "chicken wraps", "a chicken wrap", "hot dog", "hot dogs", "hotdog", "iced coffee", "iced coffees",
             "ice coffee", "cold iced coffee", "x", "fresh fruit salad bowl", "fresh fruit salad bowls"]
    words += [f"sandwich number {i}" for i in range(30)]
    df = spark.createDataFrame([(w, 2) for w in words], "phrase string, count long")
    got = {r.phrase: r.cluster for r in comments.cluster_phrases(df, 0.6).collect()}
    grams = [{g: (" " + w + " ").count(g) for g in {(" " + w + " ")[i:i + 3] for i in range(len(w))}} for w in words]
    for w, g in zip(words, grams):
        p = " " + w + " "
        for k in g:
            g[k] = sum(p[i:i + 3] == k for i in range(len(w)))
    vocab = sorted(set().union(*grams))
    df_ = np.array([sum(v in g for g in grams) for v in vocab])
    x = np.array([[g.get(v, 0) for v in vocab] for g in grams]) * (np.log((len(words) + 1) / (df_ + 1)) + 1)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cos = x @ x.T
    near = [(i, j) for i in range(len(words)) for j in range(i) if cos[i, j] >= 1 - 0.18]
    label = _components(len(words), near)
    groups = {}
    for i, c in enumerate(label):
        groups.setdefault(c, []).append(words[i])
    want = {w: min(g) for g in groups.values() for w in g}
    assert got == want and len(groups) < len(words)


def _brute_clusters(words, distance):
    """Cluster name by phrase from all pairs of TF-IDF vectors over three characters."""
    grams = [[(" " + w + " ")[i:i + 3] for i in range(max(len(w), 1))] for w in words]
    vocab = {g: k for k, g in enumerate(sorted(set().union(*grams)))}
    x = np.zeros((len(words), len(vocab)))
    for i, gs in enumerate(grams):
        for g in gs:
            x[i, vocab[g]] += 1
    x *= np.log((len(words) + 1) / ((x > 0).sum(0) + 1)) + 1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = np.argwhere(np.tril(x @ x.T >= 1 - distance * distance / 2, -1))
    groups = {}
    for i, c in enumerate(_components(len(words), [(int(i), int(j)) for i, j in near])):
        groups.setdefault(c, []).append(words[i])
    return {w: min(g) for g in groups.values() for w in g}


#: limits as they are; every key extended; keys of more than two rows in blocks; every longer phrase under single grams
LIMITS = [{}, {"CROWD": 1e-9}, {"CROWD": 1e9, "TOGETHER": 2}, {"CROWD": 1e-9, "MOST_KEYS": 20}, {"BUCKETS": 1}]


@pytest.mark.parametrize("limits", LIMITS)
def test_phrases_meet_under_any_limits(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(comments, name, value)
    rng = np.random.default_rng(11)
    parts = ["an", "or", "th", "ing", "ou", "e", "s", "le"]
    words = {"".join(rng.choice(parts, rng.integers(2, 9))) + (" " + "".join(rng.choice(parts, 4)) if k % 2 else "") for k in range(150)}
    words = sorted(words | {w + "s" for w in sorted(words)[::2]} | {"ha" * 9, "ha" * 12, "haha", "x", "xxxx", "xxxxxx", "xxxxxxxxx", ""})
    df = spark.createDataFrame([(w, 2) for w in words], "phrase string, count long")
    want = _brute_clusters(words, 0.6)
    got = comments.cluster_phrases(df, 0.6).collect()
    assert len(got) == len(words) and {r.phrase: r.cluster for r in got} == want
    assert 1 < len(set(want.values())) < 0.8 * len(words)


def test_alike_phrases_stand_under_few_keys(spark, monkeypatch):
    """Phrases of the same common grams: the rarest single gram, under which whole vectors met, is shared by hundreds."""
    seen = []
    monkeypatch.setattr(comments, "written", lambda df, name: seen.append((name, kept := written(df, name))) or kept)
    rng = np.random.default_rng(2)
    words = sorted({" ".join("".join(rng.choice(["an", "or", "th", "ou"], 3)) for _ in range(4)) for _ in range(1500)})
    df = spark.createDataFrame([(w, 2) for w in words], "phrase string, count long")
    got = {r.phrase: r.cluster for r in comments.cluster_phrases(df, 0.4).collect()}
    assert got == _brute_clusters(words, 0.4)
    met = dict(seen)["phrase-pairs"]
    assert met.columns == ["a", "b", "key"] and met.count() < 20 * len(words)


@pytest.mark.parametrize("limits", [{}, {"PIECE": 3}, {"PIECE": 3, "CROWD": 1e-9, "MOST_KEYS": 6}, {"FEW_GRAMS": 0}])
def test_long_phrases_meet_in_pieces(spark, monkeypatch, limits):
    """Whole long phrases had too many choices of first common grams, so they met all others under single grams."""
    single, called = comments._single_grams, []
    monkeypatch.setattr(comments, "_single_grams", lambda *a: called.append(1) or single(*a))
    for name, value in ({"CROWD": 1e-9} | limits).items():
        monkeypatch.setattr(comments, name, value, raising=False)
    rng = np.random.default_rng(12)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 5))
    words = set()
    for k in range(40):
        base = [word() for _ in range(int(rng.integers(3, 40)))]
        words |= {" ".join(base), " ".join([*base[:-1], word()]), " ".join([*base, word()]), " ".join(base[::-1]), " ".join(base[: len(base) * 3 // 4])}
    words = sorted(words)
    df = spark.createDataFrame([(w, 2) for w in words], "phrase string, count long")
    got = {r.phrase: r.cluster for r in comments.cluster_phrases(df, 0.4).collect()}
    assert got == _brute_clusters(words, 0.4) and 40 < len(set(got.values())) < 0.9 * len(words)
    assert bool(called) == ("MOST_KEYS" in limits)


def test_cluster_summary_has_one_row_per_cluster(spark):
    df = spark.createDataFrame([(f"p{i}", 2, "c") for i in range(50)] + [("q", 3, "q")], "phrase string, count long, cluster string")
    got = {r.cluster: r for r in comments.cluster_summary(df).collect()}
    assert len(got) == 2 and (got["c"].phrases_in_cluster, got["c"].total_count) == (50, 100)
    assert got["c"].phrases == sorted(f"p{i}" for i in range(50))


def test_members_come_by_cluster_total(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("b", 5, "x"), ("c", 9, "y"), ("d", 1, "w"), ("e", 5, "w")], "phrase string, count long, cluster string")
    assert [tuple(r) for r in comments.cluster_members(df).collect()] == [("y", "c", 9), ("w", "e", 5), ("w", "d", 1), ("x", "b", 5), ("x", "a", 1)]
    assert {tuple(r) for r in comments.cluster_totals(df).collect()} == {("x", 2, 6), ("y", 1, 9), ("w", 2, 6)}


def test_phrases_come_by_count_then_name(spark):
    df = spark.createDataFrame([("b", 2), ("c", 5), ("a", 2)], "phrase string, count long")
    assert [r.phrase for r in comments.by_count(df).collect()] == ["c", "a", "b"]

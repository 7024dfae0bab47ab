import itertools
import math
import re
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import clustering as K
from basketry.operators import evaluation as E
from basketry.operators import isotonic as IS
from basketry.operators import metrics as M
from basketry.operators import scoring as SC
from basketry.operators import vectors as V
from basketry.operators.lookup import lookup

# Held-out losses of a run that stopped after 28 epochs with its best at 22.
CURVE = [26.8717, 16.2280, 13.1910, 11.5126, 9.8579, 9.7779, 8.4620, 8.1324, 7.4953, 7.4950, 6.6832, 6.6248, 6.2616, 6.5211,
         5.8940, 5.9295, 5.8370, 5.7044, 5.6117, 5.5825, 5.3175, 5.1822, 5.3028, 5.2816, 5.2047, 5.2737, 5.2268, 5.2357]


def test_early_stop_and_summary(spark):
    rows = [("a", i + 1, v) for i, v in enumerate(CURVE + [1.0])] + [("b", 1, float("inf"))]
    df = spark.createDataFrame(rows, "run string, epoch int, metric double")
    got = {r["run"]: r for r in M.early_stop(df).collect()}
    assert (got["a"]["best_epoch"], got["a"]["best_value"], got["a"]["epochs_run"]) == (22, 5.1822, 28)
    assert got["b"]["best_epoch"] == -1
    assert M.run_summary(df.filter("run = 'a'"), ["metric"]).first()["metric_final"] == 1.0


def test_auc_with_ties_against_pairs(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = random.Random(1)
    rows = [("g%d" % (i % 2), float(rng.randrange(8)), float(rng.random() < 0.4)) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, score double, label double")
    for r in M.roc_auc(df, group=["g"]).collect():
        pos = [s for g, s, y in rows if g == r["g"] and y == 1]
        neg = [s for g, s, y in rows if g == r["g"] and y == 0]
        want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
        assert abs(r["auc"] - want) < 1e-12
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label")
    assert abs(M.roc_auc(df).first()["auc"] - ev.evaluate(df)) < 1e-9
    assert math.isnan(M.roc_auc(df.filter("label = 1")).first()["auc"])


def test_losses(spark):
    df = spark.createDataFrame([(0.0, 1.0), (800.0, 1.0), (-800.0, 1.0)], "logit double, label double")
    row = M.bce_accuracy(df).first()
    assert abs(row["bce"] - (math.log(2) + 0 + 800) / 3) < 1e-9 and abs(row["accuracy"] - 2 / 3) < 1e-12
    z, t = [1.0, 2.0, -3.0], [0.5, 0.5, 0.0]
    p = np.exp(z) / np.exp(z).sum()
    rows = spark.createDataFrame([(1, a, b) for a, b in zip(z, t)], "e int, logit double, target double")
    got = M.soft_ce_entropy(rows, ["e"], 0.05).first()
    ce, h = -(np.array(t) * np.log(p)).sum(), -(p * np.log(p)).sum()
    assert abs(got["ce"] - ce) < 1e-12 and abs(got["entropy"] - h) < 1e-12 and abs(got["total"] - (ce - 0.05 * h)) < 1e-12
    logits = spark.createDataFrame([(1, i, v, 1) for i, v in enumerate(z)] + [(2, i, v, -100) for i, v in enumerate(z)],
                                   "pos int, token int, logit double, label int")
    assert abs(M.masked_ce_from_logits(logits, ["pos"]).first()["mlm"] + math.log(p[1])) < 1e-12
    cal = spark.createDataFrame([(0.95, 1.0), (1.0, 0.0), (0.1, 0.0)], "prob double, label double")
    assert abs(M.expected_calibration_error(cal).first()["ece"] - (2 * abs(0.975 - 0.5) + 0.1) / 3) < 1e-12


def test_basket_vectors_and_pool(spark):
    lines = spark.createDataFrame([(1, 1, 3), (1, 2, 1), (2, 0, 5)], "basket long, item_idx long, qty long")
    vectors = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "item_idx long, vec array<double>")
    got = {r["basket"]: r["vec"] for r in V.basket_vectors(lines, vectors, 2).collect()}
    assert np.allclose(got[1], np.array([3, 1]) / math.sqrt(10)) and got[2] == [0.0, 0.0]
    pool = {r["basket"]: r for r in V.mean_max_pool(lines, vectors, 2).collect()}
    assert pool[1]["pool_mean"] == [0.75, 0.25] and pool[1]["pool_max"] == [1.0, 1.0] and pool[2]["pool_max"] == [0.0, 0.0]


def test_vectors_are_not_shuffled(spark):
    """Lines come together by basket before they get their vector, whose sums then need no exchange."""
    lines = spark.createDataFrame([(i % 9, i % 5, 1) for i in range(99)], "basket long, item_idx long, qty long")
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], "item_idx long, vec array<double>")
    for pooled in (V.basket_vectors(lines, vectors, 2), V.mean_max_pool(lines, vectors, 2)):
        plan = pooled._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*(HashAggregate|Project)[^\n]*(sum|vec)", plan), plan
        assert pooled.count() == 9


def test_training_pairs_shuffle_no_vectors(spark):
    """Vectors of candidates go to the examples' tasks, and what joins baskets of several draws is small."""
    lines = spark.createDataFrame([(i % 9, 0, i % 4 + 1, 1) for i in range(99)], "basket long, draw int, item_idx long, qty long")
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], "item_idx long, vec array<double>")
    keys = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(9)], "basket long, facet_key string")
    examples = spark.createDataFrame([(i, 0, j, 1.0, "p") for i in range(9) for j in (1, 4)],
                                     "basket long, draw int, candidate long, label double, phase string")
    priors = SC.Priors(spark.createDataFrame([(i, 0.2, 0.0) for i in range(5)], "item_idx long, q double, all_p double"),
                       spark.createDataFrame([("a", 1, 3.0, 1.0)], "facet_key string, item_idx long, qty double, p double"),
                       spark.createDataFrame([("a", 3.0)], "facet_key string, key_total double"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        baskets = SC.partial_baskets(lines, vectors, keys, priors, 2, ("basket", "draw"))
        pairs = SC.pair_features(examples, baskets, vectors, priors, ("basket", "draw"), ("phase",))
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*Project[^\n]*(mean#|AS mean|, mean)", plan), plan
        assert "Exchange hashpartitioning(candidate" not in plan
        rows = {(r["basket"], r["candidate"]): r for r in pairs.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(rows) == 18 and {r["phase"] for r in rows.values()} == {"p"}
    for (basket, candidate), r in rows.items():
        held = [x for i in range(99) if i % 9 == basket for x in [i % 4 + 1]]
        mean, vec = np.array([np.mean(held), 1.0]), np.array([float(candidate), 1.0])
        played, total = (3.0 if candidate == 1 else 0.0, 3.0) if basket % 2 == 0 else (0.0, 0.0)
        assert abs(r["distance"] - np.linalg.norm(mean - vec)) < 1e-12 and abs(r["cosine"] - mean @ vec / np.linalg.norm(mean)) < 1e-12
        assert abs(r["log_prior"] - math.log((played + 100 * 0.2) / (total + 100))) < 1e-12


def test_kmeans_on_tight_clusters(spark):
    rng = np.random.default_rng(0)
    rows = [(i, (np.eye(4)[i % 3] + rng.normal(0, 0.01, 4)).tolist()) for i in range(90)]
    points = spark.createDataFrame(rows, "id long, vec array<double>")
    fit = K.kmeans_fit(points, 3, "s")
    assert sorted(fit.sizes) == [30, 30, 30] and np.allclose(np.linalg.norm(fit.centroids, axis=1), 1)
    assert np.allclose(K.kmeans_fit(points, 3, "s").centroids, fit.centroids)
    assert len(K.kmeans_fit(points.limit(2), 5, "s").sizes) == 2
    same = K.kmeans_fit(spark.createDataFrame([(i, [1.0, 0.0]) for i in range(9)], "id long, vec array<double>"), 4, "s")
    assert sum(same.sizes) == 9 and len(same.sizes) == 4


def test_seeding_and_loop_equal_plain_ones(spark):
    """Seeds come from all clusters in a few passes, and the loop from given centres is that of numpy."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(20, 6)) * 4
    x = np.vstack([c + rng.normal(0, 0.05, (15, 6)) for c in centres])
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    seeds = K._seed_centroids(points, 20, "s", "id", "vec")
    nearest = np.square(seeds[:, None] - centres[None]).sum(-1).argmin(1)
    assert len(set(nearest.tolist())) >= 18
    start = x[:5]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(start)], "cluster int, centroid array<double>")
    got = {r["cluster"]: (r["size"], r["centroid"]) for r in K.lloyd(points, frame, 6, 3).collect()}
    plain = start
    for _ in range(3):
        d = np.square(x[:, None] - plain[None]).sum(-1)
        label = d.argmin(1)
        far = x[np.sqrt(d.min(1)).argmax()]
        plain = np.array([x[label == c].mean(0) if (label == c).any() else far for c in range(5)])
    for c in range(5):
        assert got[c][0] == (label == c).sum() and np.allclose(got[c][1], plain[c])
    with pytest.raises(ValueError):
        K.kmeans_fit(points.limit(0), 3)


def test_empty_cluster_moves_to_the_farthest_point(spark, monkeypatch):
    points = spark.createDataFrame([(1, [0.0]), (2, [1.0]), (3, [9.0])], "id long, vec array<double>")
    centres = spark.createDataFrame([(0, [0.0]), (1, [100.0]), (2, [0.0])], "cluster int, centroid array<double>")
    for block in (1 << 22, 1):  # one block, and one centre per block
        monkeypatch.setattr(K, "BLOCK_NUMBERS", block)
        got = {r["cluster"]: (r["size"], r["centroid"]) for r in K.kmeans_step(points, centres, 1).collect()}
        assert got[0] == (3, [10 / 3]) and got[1] == got[2] == (0, [9.0])


@pytest.mark.parametrize("most", [7, 40])
def test_jaccard_against_all_pairs(spark, most):
    rng = random.Random(5)
    sets = {b: set(rng.sample(range(2 * most), rng.randrange(1, most))) for b in range(30)}
    sets[30] = set(sets[0])
    lines = spark.createDataFrame([(b, i) for b, s in sets.items() for i in s], "basket long, item_idx long")
    pairs = [1 - len(a & c) / len(a | c) for a, c in itertools.combinations(sets.values(), 2)]
    row = E.jaccard_diversity(lines, 256).first()
    assert row["baskets"] == 31 and abs(row["diversity"] - sum(pairs) / len(pairs)) < 5 * row["std_error"] < 0.1
    assert E.jaccard_diversity(lines.limit(1)).first()["diversity"] is None


def test_compliance_supply_and_gates(spark):
    items = spark.createDataFrame([(1, "Your Hero characters get +1.", ["Hero"]), (2, "", ["hero"]), (3, "", ["Villain"])],
                                  "item_idx long, text string, classes array<string>")
    lines = spark.createDataFrame([(1, 1, 1), (1, 2, 1), (2, 1, 4), (2, 3, 1)], "basket long, item_idx long, qty long")
    row = E.reference_compliance(lines, items).first()
    assert (row["cases"], row["compliant"]) == (2, 1)
    named = spark.createDataFrame([(1, "Elsa"), (2, "Elsa"), (3, "Anna"), (4, "Elsa Spirit")], "item_idx long, name string")
    texts = spark.createDataFrame([(1, "Shift onto Elsa."), (2, None), (3, "Elsa Spirit, Elsa"), (4, "")], "item_idx long, text string")
    assert sorted(map(tuple, E.base_references(named, texts).collect())) == [(3, "Elsa"), (3, "Elsa Spirit")]
    played = spark.createDataFrame([(1, 3, 1), (1, 1, 1), (2, 3, 1), (2, 2, 2), (2, 1, 1), (3, 3, 9)], "basket long, item_idx long, qty long")
    row = E.base_compliance(played, named, texts).first()
    assert (row["cases"], row["compliant"]) == (6, 2)
    row = E.base_compliance(played, named, texts, needed=2).first()
    assert (row["cases"], row["compliant"]) == (6, 1)
    songs = spark.createDataFrame([(1, 3, "singer", 1), (1, 2, "song", 1), (2, 5, "song", 1), (2, 4, "singer", 9)],
                                  "basket long, bucket int, kind string, qty long")
    covered = {r["basket"]: r["covered"] for r in E.supply_demand(songs, F.col("kind") == "singer", F.col("kind") == "song").collect()}
    assert covered == {1: True, 2: False}
    metrics = spark.createDataFrame([("legality_rate", 1.0), ("evaluator_auroc", 0.9), ("held_out_nll", 5.0)], "metric string, value double")
    gates = E.gate_table(spark, list(E.GATES) + [("share", "soft", 0.5, None)])
    got = {r["metric"]: r["status"] for r in E.quality_gates(metrics, gates).collect()}
    hard = {"legality_rate": "pass", "evaluator_auroc": "pass", "held_out_nll": "fail", "diversity": "fail"}
    assert got == {m: "prerelease" for m, kind, *_ in gates.collect() if kind != "hard"} | hard
    band = spark.createDataFrame([("archetype_distance", 0.2), ("coverage", 0.1), ("curve_kl", 0.05)], "metric string, value double")
    seen = {r["metric"]: r["status"] for r in E.quality_gates(band, gates).collect()}
    assert (seen["archetype_distance"], seen["coverage"], seen["curve_kl"]) == ("pass", "prerelease", "pass")
    assert E.overall_status(E.quality_gates(metrics, gates)).first()["overall"] == "fail"


def test_chi_square_p_value(spark):
    corpus = spark.createDataFrame([("a", 50), ("b", 50)], "facet string, qty long")
    sample = spark.createDataFrame([("a", 60), ("b", 40)], "facet string, qty long")
    assert E.type_chi2(sample, corpus).first()["chi2"] == 4.0
    assert abs(E.type_chi2_pvalue(sample, corpus) - math.erfc(math.sqrt(2.0))) < 1e-9


def scene(spark, n=23, dim=4, baskets=9):
    rng = np.random.default_rng(2)
    items = [(i + 1, rng.normal(size=dim).tolist(), None if i % 4 else 2.0) for i in range(n)]
    items[7] = (8, items[6][1], items[6][2])  # equal scores but for the prior
    counts = [(k, i + 1, float((i * j) % 7)) for j, k in enumerate("xy", 2) for i in range(n) if (i * j) % 7]
    legal = [(k, i + 1) for j, k in enumerate("xy", 2) for i in range(n) if i % 5 != j]
    people = [(b, "xyz"[b % 3], rng.normal(size=dim).tolist(), [2, 5, 9], [1.0, 2.0, 1.0]) for b in range(baskets)]
    overall = {i: sum(q for _, j, q in counts if j == i) for i in range(1, n + 1)}
    total = sum(overall.values())
    base = [(i, (overall[i] + 1) / (total + n), overall[i] / total) for i in overall]
    totals = {k: sum((q for key, _, q in counts if key == k), 0.0) for k in "xyz"}
    priors = SC.Priors(
        spark.createDataFrame(base, "item_idx long, q double, all_p double"),
        spark.createDataFrame([(k, i, q, q / totals[k]) for k, i, q in counts], "facet_key string, item_idx long, qty double, p double"),
        spark.createDataFrame([(k, t) for k, t in totals.items() if t], "facet_key string, key_total double"))
    vectors = spark.createDataFrame(items, "item_idx long, vec array<double>, cap double")
    centres = spark.createDataFrame([(0, [1.0] * dim), (1, [-1.0] * dim)], "cluster int, centroid array<double>")
    table = SC.candidate_table(vectors, priors, spark.createDataFrame(legal, "facet_key string, item_idx long"), dim, centres)
    frame = spark.createDataFrame([(b, k, totals[k], m, o, q) for b, k, m, o, q in people],
                                  "basket long, facet_key string, key_total double, mean array<double>, own_items array<long>, own_qty array<double>")
    return items, dict(((k, i), q) for k, i, q in counts), set(legal), people, {i: (q, p) for i, q, p in base}, totals, table, frame


@pytest.mark.parametrize("exclude_own,novelty,use_log_p", [(True, "basket", True), (False, "archetype", True), (False, "basket", False)])
def test_candidates_equal_plain_scores(spark, monkeypatch, exclude_own, novelty, use_log_p):
    """Every block size gives the scores of a plain double loop, in order, ties by item."""
    items, counts, legal, people, base, totals, table, frame = scene(spark)
    scorer = SC.Scorer(0.7, SC.Weights(0.1, 1.5, -0.4, 0.2), (SC.Preset("p", 1.0, 0.5, 2.0), SC.Preset("q")), use_log_p, novelty)
    expected = []
    for b, key, mean, own, qty in people:
        mean = np.array(mean)
        logits, scores = [], {"p": [], "q": []}
        for i, vec, cap in items:
            vec = np.array(vec)
            q, all_p = base[i]
            count = counts.get((key, i), 0.0)
            prior = math.log((count + 100 * q) / (totals[key] + 100))
            cosine, distance = vec @ mean / np.linalg.norm(mean), np.linalg.norm(vec - mean)
            far = min(np.linalg.norm(vec - 1), np.linalg.norm(vec + 1)) if novelty == "archetype" else distance
            logits.append(prior + 0.7 * cosine)
            value = 1 / (1 + math.exp(-(0.1 + 1.5 * cosine - 0.4 * distance + 0.2 * prior)))
            meta = count / totals[key] if count else all_p
            held = dict(zip(own, qty)).get(i, 0)
            if (key, i) in legal and not (held if exclude_own else held >= (math.inf if cap is None else cap)):
                part = logits[-1] if use_log_p else 0.0
                scores["p"].append((-(part + value + 0.5 * far - 2 * meta), i))
                scores["q"].append((-part, i))
        lse = math.log(sum(map(math.exp, logits))) if use_log_p else 0.0
        for name, found in scores.items():
            expected += [(b, name, n, i, round(-s - lse, 9)) for n, (s, i) in enumerate(sorted(found)[:4], 1)]
    for block in (1 << 21, 50, 8):
        monkeypatch.setattr(SC, "BLOCK_NUMBERS", block)
        SC._SINGLE.clear()
        out = SC.top_candidates(frame, table, scorer, 4, exclude_own).collect()
        assert sorted((r["basket"], r["preset"], r["position"], r["item_idx"], round(r["score"], 9)) for r in out) == sorted(expected)


def test_best_columns_break_ties_by_place():
    rng = np.random.default_rng(1)
    total = rng.integers(0, 4, size=(200, 9)).astype(float)
    total[total == 0] = -np.inf
    for k in (1, 4, 9, 20):
        got = SC.best_columns(total, k)
        plain = np.sort(np.argsort(-total, axis=1, kind="stable")[:, :k], axis=1)
        assert (got == plain).all()


def test_lookup_is_the_same_for_small_and_large_tables(spark):
    rows = spark.createDataFrame([(i, None if i % 9 == 0 else "hot" if i % 3 else f"k{i}") for i in range(60)], "i long, key string")
    table = spark.createDataFrame([("hot", 1), ("hot", 2), ("k3", 3), ("none", 4)], "key string, v int")
    for how in ("left", "inner"):
        small = lookup(rows, table, ["key"], how)
        large = lookup(rows, table, ["key"], how, small=2, salts=3)
        assert Counter(map(tuple, small.collect())) == Counter(map(tuple, large.collect())) and small.columns == large.columns


def plain_isotonic(pairs):
    """Max-min formula over all score ranges."""
    by = {}
    for x, y in pairs:
        by.setdefault(x, []).append(y)
    xs = sorted(by)
    sums, counts = [sum(by[x]) for x in xs], [len(by[x]) for x in xs]
    mean = lambda i, j: sum(sums[i:j + 1]) / sum(counts[i:j + 1])
    return {x: max(min(mean(i, j) for j in range(at, len(xs))) for i in range(at + 1)) for at, x in enumerate(xs)}


@pytest.mark.parametrize("shape,blocks", [("noise", 1 << 17), ("noise", 3), ("rising", 4), ("falling", 2), ("saw", 3), ("swallow", 2)])
def test_isotonic_equals_the_max_min_formula(spark, monkeypatch, shape, blocks):
    """Any size of ranges gives the plain fit, whether blocks pool within ranges, across them, or all in one."""
    monkeypatch.setattr(IS, "RANGE_BLOCKS", blocks)
    rng = random.Random(4)
    n = 60
    y = {"noise": lambda i: float(rng.random() < i / n), "rising": lambda i: i / n, "falling": lambda i: 1 - i / n,
         "saw": lambda i: (i % 7) / 7, "swallow": lambda i: 1.0 if i < 3 else i / 1000}[shape]
    pairs = [(float(i // (2 if shape == "noise" else 1)), y(i)) for i in range(n)]
    df = spark.createDataFrame(pairs + [(None, 1.0), (1.0, None)], "score double, label double")
    points = {r["score"]: r["prob"] for r in IS.isotonic_breakpoints(df).collect()}
    fit = plain_isotonic(pairs)
    assert all(abs(points[x] - fit[x]) < 1e-9 for x in points) and {min(fit), max(fit)} <= set(points)
    held = sorted(points)
    for x, f in fit.items():  # every other score lies in a step
        left, right = max(h for h in held if h <= x), min(h for h in held if h >= x)
        assert abs(points[left] - f) < 1e-9 and abs(points[right] - f) < 1e-9
    assert IS.isotonic_breakpoints(df.limit(0)).collect() == []


def test_own_items_and_means_share_an_exchange(spark):
    """Lines are dealt out by basket once, for the lists of own items and the means; lists are not dealt out again."""
    lines = spark.createDataFrame([(i % 9, i % 4 + 1, 1) for i in range(99)] + [(3, None, 2), (20, None, 1)], "basket long, item_idx long, qty long")
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], "item_idx long, vec array<double>")
    keys = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(30)], "basket long, facet_key string")
    priors = SC.Priors(None, None, spark.createDataFrame([("a", 3.0)], "facet_key string, key_total double"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        baskets = SC.partial_baskets(lines, vectors, keys, priors, 2)
        plan = baskets._jdf.queryExecution().executedPlan().toString()
        assert "ReusedExchange" in plan and plan.count("- Exchange hashpartitioning(basket") == 2, plan  # lines, keys
        rows = {r["basket"]: r for r in baskets.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert set(rows) == set(range(9))
    for basket, r in rows.items():
        own = Counter(i % 4 + 1 for i in range(99) if i % 9 == basket)
        assert len(r["own_items"]) == 11 and Counter(r["own_items"]) == own and sum(r["own_qty"]) == 11
        assert np.allclose(r["mean"], [sum(i * n for i, n in own.items()) / 11, 1.0])


def test_lines_are_judged_where_they_meet(spark):
    """Hashes and references reach lines that lie together by basket: no exchange carries them."""
    lines = spark.createDataFrame([(i % 9, i % 5) for i in range(45)], "basket long, item_idx long")
    named = spark.createDataFrame([(i, r) for i in range(3) for r in ("a", "b")] + [(1, "nobody")], "item_idx long, ref string")
    carried = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(5)] + [(i, "unnamed") for i in range(5)], "item_idx long, ref string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        judged = E.compliance(lines, named, carried)
        for out, what in ((E.jaccard_diversity(lines), "min\\(h0"), (judged, "sum\\((carried|named)")):
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning(item_idx") == 0, plan
            assert not re.search(r"Exchange hashpartitioning\(basket[^\n]*\n[^\n]*" + what, plan), plan
        got = judged.first()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sets = {b: {i % 5 for i in range(45) if i % 9 == b} for b in range(9)}
    texts = {(r["item_idx"], r["ref"]) for r in named.collect()}
    bears = {(r["item_idx"], r["ref"]) for r in carried.collect()}
    cases = [(any((m, ref) in bears for m in s - {i})) for s in sets.values() for i, ref in texts if i in s]
    assert (got["cases"], got["compliant"]) == (len(cases), sum(cases))


def test_nearest_centres_by_product_equal_plain_ones(monkeypatch):
    """Only points between centres meet them one by one, and labels and distances are the plain ones to the bit."""
    rng = np.random.default_rng(2)
    centres = np.vstack([rng.normal(size=(9, 16)), np.zeros((1, 16))])
    centres = np.vstack([centres, centres[3], centres[0] + 1e-15])
    x = np.vstack([rng.normal(size=(500, 16)), centres, (centres[1:5] + centres[2:6]) / 2, 1e6 + centres, np.full((1, 16), np.nan)])
    clusters = np.arange(12, dtype=np.int32) * 2
    plain, met = K._plain_distances, []
    monkeypatch.setattr(K, "_plain_distances", lambda x, *rest: met.append(len(x)) or plain(x, *rest))
    monkeypatch.setattr(K, "PRODUCT_NUMBERS", 1200)
    label, best = K._distances(x, clusters, centres)
    want, far = plain(x, clusters, centres)
    assert (label == want).all() and (best == far).all() and sum(met) < 200

import math
import random

import numpy as np
import pytest

from quillstone.llm import weak_quality as wq

from .conftest import WORDS, prose


def junk(k):
    rnd = random.Random(k)
    w = prose(k, 8).split()
    if k % 4 == 0:
        return " ".join(x + rnd.choice(("***", "%%%", "&&&")) for x in w)
    if k % 4 == 1:
        return " ".join(x.upper() + "!!" for x in w)
    if k % 4 == 2:
        return " ".join(" ".join([f"{x}{rnd.choice(WORDS)}{rnd.choice(WORDS)}"] * 15) for x in w[:20])
    return " | ".join(f"{rnd.choice(WORDS)}{rnd.choice(WORDS)}{rnd.choice(WORDS)}" for _ in range(90))


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(k, junk(k) if k % 5 == 0 else prose(k, 4 + k % 9), k % 5 != 0) for k in range(700)]
    return spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string").repartition(4), {k: g for k, _, g in rows}


def test_held_out_accuracy(spark, labelled):
    docs, good = labelled
    model = wq.train(spark, docs.where("doc_id < 400"))
    out = wq.classify(spark, docs.where("doc_id >= 400"), model).collect()
    right = [r["kept"] == good[r["doc_id"]] for r in out]
    assert np.mean(right) > 0.97 and all(r["kept"] for r in out if good[r["doc_id"]])
    assert all(model.learned.accuracy(k) > 0.8 for k, h in enumerate(wq.HEURISTICS) if h in ("symbols", "repeats", "marks", "common"))


def test_em_recovers_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.8
    acc, speaks = [0.95, 0.8, 0.7, 0.9], [0.9, 0.8, 1.0, 0.6]
    counts: dict[str, int] = {}
    for good in truth:
        p = "".join(str(int(good if rng.random() < a else not good)) if rng.random() < s else "2" for a, s in zip(acc, speaks, strict=True))
        counts[p] = counts.get(p, 0) + 1
    learned = wq.Accuracies(counts)
    assert abs(learned.prior - 0.8) < 0.02
    assert all(abs(learned.accuracy(k) - a) < 0.03 for k, a in enumerate(acc))
    assert learned.posterior["1111"] > 0.95 > 0.2 > learned.posterior["0000"]


def test_rows_of_all_kinds(spark, docs, rows):
    out = wq.kept(spark, docs)
    assert out.columns == docs.columns and out.exceptAll(docs).count() == 0
    got = wq.classify(spark, docs.select("doc_id", "text")).collect()
    assert len(got) == len(rows) and not any(r["kept"] for r in got if not (r["text"] or "").strip()) and all(0 <= r["score"] <= 1 for r in got)


def test_reruns_agree(spark, labelled):
    docs, _ = labelled
    a, b = (sorted(map(tuple, wq.classify(spark, d).select("doc_id", "score").collect())) for d in (docs, docs.repartition(7)))
    assert a == b


def test_empty(spark, none):
    assert wq.classify(spark, none).count() == 0


def test_an_id_that_repeats_reaches_the_driver_once(spark, monkeypatch):
    seen = []
    was = wq.fit
    monkeypatch.setattr(wq, "fit", lambda at, weight, target: seen.append(len(target)) or was(at, weight, target))
    rows = [(7, f"{prose(k % 5, 6)} {k}") for k in range(300)] + [(k, prose(k, 8)) for k in range(20, 60)]
    wq.train(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert seen == [41]


def plain_em(votes):
    """The same model, a document and a heuristic at a time."""
    odds = lambda p: math.log(p / (1 - p))
    sure = lambda x: 1 / (1 + math.exp(-x))
    good = [sure(odds(wq.PRIOR) + sum(v == wq.GOOD for v in own) - 3 * sum(v == wq.BAD for v in own)) for own in votes]
    for _ in range(wq.ROUNDS):
        prior = (sum(good) + wq.PSEUDO) / (len(votes) + 2 * wq.PSEUDO)
        new, tables = [], []
        for k in range(len(wq.HEURISTICS)):
            kinds = (wq.BAD, wq.GOOD) if k in wq.NEED_LENGTH else (wq.BAD, wq.GOOD, wq.NONE)
            on_good = {v: wq.PSEUDO + sum(g for own, g in zip(votes, good, strict=True) if own[k] == v) for v in kinds}
            on_bad = {v: wq.PSEUDO + sum(1 - g for own, g in zip(votes, good, strict=True) if own[k] == v) for v in kinds}
            tables.append({v: math.log(on_good[v] / sum(on_good.values()) / (on_bad[v] / sum(on_bad.values()))) for v in kinds})
        new = [sure(odds(prior) + sum(t.get(own[k], 0.0) for k, t in enumerate(tables))) for own in votes]
        if max(abs(a - b) for a, b in zip(new, good, strict=True)) < 1e-9:
            break
        good = new
    return good


def plain_scorer(features, targets, steps):
    """Logistic regression by full passes of a moment method, with dictionaries."""
    w, mean, square = {}, {}, {}
    bias = -1
    for step in range(1, steps + 1):
        g = {k: wq.PENALTY * x for k, x in w.items() if k != bias}
        for f, t in zip(features, targets, strict=True):
            e = (1 / (1 + math.exp(-(sum(x * w.get(k, 0.0) for k, x in f) + w.get(bias, 0.0)))) - t) / len(targets)
            for k, x in [*f, (bias, 1.0)]:
                g[k] = g.get(k, 0.0) + e * x
        for k in g:
            mean[k] = 0.9 * mean.get(k, 0.0) + 0.1 * g[k]
            square[k] = 0.999 * square.get(k, 0.0) + 0.001 * g[k] ** 2
            w[k] = w.get(k, 0.0) - 0.05 * (mean[k] / (1 - 0.9**step)) / (math.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return lambda f: 1 / (1 + math.exp(-(sum(x * w.get(k, 0.0) for k, x in f) + w.get(bias, 0.0))))


def test_against_brute_force(spark, monkeypatch):
    """Votes, posteriors, scorer and decisions of a small table, each by plain loops."""
    monkeypatch.setattr(wq, "PASSES", 25)
    texts = {k: junk(k) if k % 4 == 0 else prose(k, 3 + k % 6) for k in range(60)} | {60: "", 61: "two words", 62: " \n "}
    out = {r["doc_id"]: r for r in wq.classify(spark, spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)).collect()}
    votes = {k: wq.votes(t) for k, t in texts.items()}
    posterior = dict(zip(votes, plain_em(list(votes.values())), strict=True))
    features = {k: list(zip(*(x.tolist() for x in wq.features(t)), strict=True)) for k, t in texts.items()}
    score = plain_scorer(list(features.values()), list(posterior.values()), 25)
    for k, t in texts.items():
        assert abs(out[k]["score"] - score(features[k])) < 1e-6
        assert out[k]["kept"] == (bool(t.strip()) and score(features[k]) >= wq.KEEP)
    assert {r["kept"] for r in out.values()} == {True, False}

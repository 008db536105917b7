import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quillstone.llm import apportion, common


def highest(votes, seats, most):
    out = [0] * len(votes)
    for _ in range(min(seats, sum(m for v, m in zip(votes, most, strict=True) if v > 0))):
        k = max((k for k in range(len(votes)) if votes[k] > 0 and out[k] < most[k]), key=lambda k: (votes[k] / (2 * out[k] + 1), -k))
        out[k] += 1
    return out


@pytest.mark.parametrize(("votes", "seats", "most"), [([53, 24, 23], 7, [9, 9, 9]), ([10, 10, 10], 4, [9] * 3), ([5, 0, 3], 6, [2, 9, 9]), ([1, 1000], 50, [99, 3]), ([7, 3, 1, 1], 100, [99] * 4), ([1], 0, [5])])
def test_seats_go_to_the_highest_quotients(votes, seats, most):
    assert apportion.sainte_lague(votes, seats, most) == highest(votes, seats, most)


def test_targets():
    assert apportion.water_fill([10, 10, 100], [5, 2, 1], 180) == [20, 20, 140]
    assert apportion.water_fill([100, 100, 100], [5, 2, 1], 80) == [50, 20, 10]
    assert apportion.water_fill([0, 4], [5, 2], 6) == [0, 6] and apportion.water_fill([], [], 0) == []


def brute_targets(sizes, names):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        share = {s: (left - sum(fixed.values())) * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s] + 1e-9]
        if not over:
            return fixed | share
        fixed |= {s: 2.0 * sizes[s] for s in over}


def test_mix(spark, docs, rows):
    words = lambda t: len(re.findall(apportion.WORD, t or ""))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += words(r[1])
    want = brute_targets(sizes, sizes)
    out = apportion.mix(spark, apportion.sized(docs)).collect()
    again = apportion.mix(spark, apportion.sized(docs.repartition(2))).collect()
    key = lambda rs: sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in rs)
    assert key(out) == key(again) and sorted((str(r["doc_id"]), r["size"]) for r in out) == sorted((str(r[0]), words(r[1])) for r in rows)
    taken = defaultdict(int)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6 and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(0.01 * t, apportion.BLOCK)


def test_hot_source_over_shards(spark):
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(0).cast("string").alias("source"), (F.col("id") % 300).alias("size"))
    got = apportion.mix(spark, docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r["taken"] / r["target"] - 1) < 0.005 for r in got)


def test_many_sources(spark, monkeypatch):
    monkeypatch.setattr(apportion, "SENT", 100)
    monkeypatch.setattr(apportion, "SHARD_ROWS", 20)
    monkeypatch.setattr(common, "SPLIT_ROWS", 10)
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), (F.col("id") % 300).cast("string").alias("source"), (200 + F.col("id") % 7).alias("size"))
    got = apportion.mix(spark, docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.count("*").alias("n")).collect()
    assert len(got) == 300 and all(r["n"] == 20 and abs(r["taken"] / r["target"] - 1) < 0.01 for r in got)


def test_shards_of_many_sources(spark, monkeypatch):
    """A thousand sources in several shards each, one of them hot and held to fewer shards than its rows ask for: no driver row for a shard, and quotas that add up."""
    monkeypatch.setattr(apportion, "SENT", 100)
    monkeypatch.setattr(apportion, "SHARD_ROWS", 8)
    monkeypatch.setattr(apportion, "MOST_SHARDS", 64)
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 1000).cast("string")).alias("source"), (300 + F.col("id") % 11).alias("size"))
    got = apportion.mix(spark, docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.count("*").alias("n")).collect()
    assert len(got) == 1001 and sum(r["n"] for r in got) == 60_000
    assert all(abs(r["taken"] - r["target"]) <= min(64, r["n"] // 8) * apportion.BLOCK for r in got)  # the last block of a shard may be short


def test_whole_documents(spark, unique):
    docs, _ = unique
    out = apportion.mixed(spark, docs)
    assert out.columns == docs.columns and out.exceptAll(docs).exceptAll(docs).count() == 0


def test_whole_documents_meet_targets(spark):
    lengths = {"a": [30 + k % 20 for k in range(500)], "b": [3], "c": [30 + k % 20 for k in range(420)] + [2000], "d": [30 + k % 20 for k in range(500)]}
    rows = [(1000 * n + k, " ".join(f"w{n}x{k}" for _ in range(w)), s) for n, (s, own) in enumerate(lengths.items()) for k, w in enumerate(own)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = brute_targets({s: sum(own) for s, own in lengths.items()}, lengths)
    assert want["c"] < 0.5 * sum(lengths["c"]) and want["b"] == 6
    got = apportion.mixed(spark, docs).collect()
    drawn, times = defaultdict(int), defaultdict(int)
    for r in got:
        drawn[r["source"]] += len(r["text"].split(" "))
        times[r["doc_id"]] += 1
    assert max(times.values()) <= 2 and all(abs(drawn[s] - t) <= 50 for s, t in want.items())
    again = apportion.mixed(spark, docs.repartition(7)).collect()
    assert sorted(r["doc_id"] for r in again) == sorted(r["doc_id"] for r in got)


def test_null_ids_are_mixed(spark):
    rows = [(None if k % 2 else k, f"text number {k} " * (1 + k % 9), f"s{k % 3}" if k % 5 else None) for k in range(400)]
    got = apportion.mixed(spark, spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    sizes, drawn = defaultdict(int), defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(t.split())
    for r in got:
        drawn[r["source"]] += len(r["text"].split())
    assert all(abs(drawn[s] - t) <= 27 for s, t in brute_targets(sizes, sizes).items())
    nulls = {r["text"] for r in got if r["doc_id"] is None}
    assert len(nulls) > 100 and nulls <= {t for k, t, _ in rows if k is None}


def test_every_document_at_the_rate():
    rnd, sizes = random.Random(3), [3000, 700, *[60 - k // 4 for k in range(200)]]
    for quota in (4000, 9000, 16000, 2 * sum(sizes)):
        many = [apportion.copies(sizes, quota, [rnd.random() for _ in sizes]) for _ in range(2000)]
        rate = quota / sum(sizes)
        assert all(abs(sum(c * s for c, s in zip(m, sizes, strict=True)) - quota) <= 60 for m in many)
        assert all(abs(sum(m[k] for m in many) / 2000 - rate) < 0.06 for k in (0, 1, 2, 100))


def test_empty(spark, none):
    assert apportion.mix(spark, apportion.sized(none)).count() == 0 and apportion.mixed(spark, none).count() == 0

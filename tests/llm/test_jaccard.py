import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstone.llm import common, jaccard
from quillstone.llm import components as graph
from quillstone.llm.components import components

LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingled(text):
    w = words(text)
    return frozenset() if not w else frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))


def brute(texts):
    sets, root = {k: shingled(t) for k, t in texts.items()}, {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    inverted = defaultdict(list)
    for k, s in sets.items():
        common = Counter(j for x in s for j in inverted[x])
        for j, n in common.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = find(k), find(j)
                root[max(a, b)] = min(a, b)
        for x in s:
            inverted[x].append(k)
    return {k: (len(sets[k]), find(k)) for k in texts}


def test_against_brute_force(spark, unique):
    docs, texts = unique
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(spark, docs).collect()}
    assert got == brute(texts)
    assert max(Counter(c for _, c in got.values()).values()) > 20


@pytest.mark.parametrize("dealt", [3, 200])
def test_any_number_of_parts(spark, unique, dealt, monkeypatch):
    """Few and many parts, and groups that are compared in several blocks and pieces, with hot keys split off."""
    docs, texts = unique
    for module, name, value in ((jaccard, "BLOCK", 7), (jaccard, "PIECE", 5), (jaccard, "GATHER", 400), (common, "SPLIT_ROWS", 6), (graph, "MANY", 4)):
        monkeypatch.setattr(module, name, value)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", dealt)
    try:
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(spark, docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert got == brute(texts)


def test_one_id_with_several_texts(spark):
    """Rows that repeat an id are one node, which links whatever any of its texts links with."""
    a = [f"w{k}" for k in range(400)]
    b = [f"v{k}" for k in range(24)]
    rows = [(7, " ".join(a)), (7, " ".join(b)), (9, " ".join([*b, "more"])), (11, " ".join([*a[:260], *(f"u{k}" for k in range(140))])), (13, " ".join([*a, "x"])), (2, " ".join([*b, "x"])), (40, ""), (40, " ".join([*a, "y"]))]
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        got = jaccard.join(spark, spark.createDataFrame(order, "doc_id long, text string").repartition(3)).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == {7: 2, 9: 2, 13: 2, 2: 2, 40: 2, 11: 11}
        assert sorted(r["n_shingles"] for r in got if r["doc_id"] == 7) == [20, 396]


def test_near_copies_that_do_not_link(spark):
    """Many documents about as far from each other as the threshold, of which few link: each pair counts."""
    rng = np.random.default_rng(8)
    base = [f"w{k}" for k in range(150)]
    texts = {}
    for k in range(160):
        own = list(base)
        for at in rng.choice(150, 3 + k % 4, replace=False):
            own[at] = f"e{k}x{at}" if rng.random() < 0.7 else f"e{at}"
        texts[k] = " ".join(own)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(spark, docs).collect()}
    assert got == brute(texts) and 1 < len({c for _, c in got.values()}) < 160


def test_thresholds_are_exact(spark):
    """Pairs just at and just below the similarity, of many sizes."""
    texts, k = {}, 0
    for n in (4, 7, 12, 28, 70, 140):
        for cut in range(n // 5 + 2):
            one = [f"w{k}_{i}" for i in range(n + 4)]
            texts[2 * k], texts[2 * k + 1] = " ".join(one), " ".join([*one[: n + 4 - cut], *(f"v{k}_{i}" for i in range(cut))])
            k += 1
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(spark, docs).collect()} == brute(texts)


def test_rows_of_all_kinds(spark, docs, rows):
    got = jaccard.join(spark, docs).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    assert all(r["component_id"] is None for r in got if r["doc_id"] is None)
    assert all(r["component_id"] == r["doc_id"] for r in got if r["n_shingles"] == 0 and r["doc_id"] is not None)
    kept = jaccard.deduplicated(spark, docs)
    want = {r["doc_id"] for r in got if r["doc_id"] is not None and r["doc_id"] == r["component_id"]}
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == docs.columns and sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 2


def test_empty(spark, none):
    assert jaccard.join(spark, none).count() == 0 and jaccard.deduplicated(spark, none).count() == 0


def test_shingles_in_batches():
    texts = ["A b  C\td e f", "", None, "x", " a b c d ", "é É ẞ", "same same same same same same same"]
    for t, h in zip(texts, jaccard.shingle_sets(texts), strict=True):
        assert len(h) == len(shingled(t)) and np.array_equal(h, jaccard.shingle_sets([t])[0])
    assert np.array_equal(*jaccard.shingle_sets(["Ab CD e f g", "aB\x0bcd E F\n G "]))
    assert not np.array_equal(*jaccard.shingle_sets(["é b c d e", "É b c d e"]))


def test_prefixes_hold_what_a_pair_shares():
    """Any two linked sets share a token of their prefixes, in any common order."""
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(1, 120))
        a = rng.permutation(400)[:n]
        b = np.unique(np.r_[a[rng.random(n) > 0.12], rng.integers(400, 440, int(rng.integers(0, n // 5 + 1)))])
        a = np.sort(a)
        common = len(np.intersect1d(a, b))
        if len(b) and 100 * common >= 75 * (len(a) + len(b) - common):
            assert common >= max(jaccard.need(len(a)), jaccard.need(len(b)))
            assert len(np.intersect1d(a[: jaccard.prefix_length(len(a))], b[: jaccard.prefix_length(len(b))]))


def test_parity_bounds_the_difference():
    rng = np.random.default_rng(6)
    for size in (20, 200, 900) * 20:
        a, b = (np.unique(rng.integers(0, 1 << 60, size).astype(np.uint64)) for _ in range(2))
        b = np.union1d(a[: size // 4 * 3], b[: size * int(rng.integers(1, 5))])
        x, y = (np.frombuffer(jaccard.parity(s), np.uint64)[None, :] for s in (a, b))
        words = min(x.shape[1], y.shape[1])
        assert np.bitwise_count(jaccard.folded(x, words) ^ jaccard.folded(y, words)).sum() <= len(np.setxor1d(a, b))


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(500, 500), (7, 3), (7, 3), (300, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)} | {300: 200, 200: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_no_pairs_of_a_group_of_copies(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("one text that all of these documents share word for word").alias("text"))
    assert {r["component_id"] for r in jaccard.join(spark, docs).collect()} == {0}

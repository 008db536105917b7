import hashlib

import numpy as np

from quillstone.llm import sketch


def test_whole_table(spark, unique):
    docs, texts = unique
    ids = sorted(texts)
    got = {r["doc_id"]: r for r in sketch.fingerprints(spark, docs).collect()}
    assert sorted(got) == ids
    for k, i in enumerate(ids):
        t, after = texts[i], texts[ids[(k + 1) % len(ids)]]
        e, r = sketch.edited(t, after), got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        mine, other, new = (sketch.fingerprint(x, sketch.sketch(x)) for x in (t, after, e))
        assert r["fingerprint"] == mine and r["edited_fingerprint"] == new
        assert r["near_edited"] == sketch.likeness((mine, sketch.sketch(t)), (new, sketch.sketch(e))) and 0 <= r["near_next"] <= 1
        assert r["near_next"] == sketch.likeness((mine, sketch.sketch(t)), (other, sketch.sketch(after)))


def test_nulls_and_repeated_rows(spark, docs, rows):
    got = sketch.fingerprints(spark, docs).collect()
    assert len(got) == len(rows) and sum(r["doc_id"] is None for r in got) == 2


def shingles(text):
    return {text[k : k + sketch.SHINGLE] for k in range(max(1, len(text) - sketch.SHINGLE + 1))} if text else set()


def same(a, b):
    return a.one_in == b.one_in and np.array_equal(a.hashes, b.hashes)


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    a = "".join(map(chr, rng.integers(97, 123, 60_000)))
    b = a[:3000] + "".join(map(chr, rng.integers(97, 123, 1000)))
    assert same(sketch.merge(sketch.sketch(a[:30_000]), sketch.sketch(a[30_000 - sketch.SHINGLE + 1 :])), sketch.sketch(a))
    assert abs(sketch.containment(sketch.sketch(b), sketch.sketch(a)) - 0.75) < 0.08
    assert abs(sketch.containment(sketch.sketch(a), sketch.sketch(b)) - 0.05) < 0.02
    assert abs(len(sketch.sketch(a).hashes) - 60_000 / sketch.ONE_IN) < 250
    assert same(sketch.sketched(sketch.fingerprint(b, sketch.sketch(b))), sketch.sketch(b))
    parts = [sketch.sketch(a[max(0, k - sketch.SHINGLE + 1) : k + 100]) for k in range(0, 2000, 100)]  # short ones, and what they make
    whole = parts[0]
    for p in parts[1:]:
        whole = sketch.merge(whole, p)
    assert whole.one_in == 1 and same(whole.at(sketch.ONE_IN), sketch.sketch(a[:2000])) and same(sketch.merge(parts[0], sketch.sketch(a[:2000])), sketch.sketch(a[:2000]))


def test_estimates_against_sets_of_shingles(spark, unique):
    """Short texts are compared exactly, long ones within a few standard errors of exact sets."""
    docs, texts = unique
    extra = {5000 + k: t for k, t in enumerate(["hello", "world", "ab", "zz", "yes", "no!", "This.", "Edrere.", "so this is a short text", "so this is a short test", "x" * 100, "y" * 300, "y" * 30])}
    texts = texts | extra
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(extra.items()), "doc_id long, text string"))
    got = {r["doc_id"]: r for r in sketch.fingerprints(spark, both).collect()}
    ids, prints, short = sorted(texts), {}, 0
    for k, i in enumerate(ids):
        t, after = texts[i], texts[ids[(k + 1) % len(ids)]]
        mine, e = shingles(t), sketch.edited(t, after)
        prints.setdefault(got[i]["fingerprint"], set()).add(frozenset(mine))
        for other, near in ((e, got[i]["near_edited"]), (after, got[i]["near_next"])):
            exact = len(mine & shingles(other)) / len(mine) if mine else float(not other)
            if max(len(t), len(other)) < sketch.SHORT + sketch.SHINGLE and t:
                assert near == exact
                short += 1
            elif len(mine) > sketch.SHORT:
                assert abs(near - exact) <= 5 * (max(exact * (1 - exact), 0.02) * sketch.ONE_IN / len(mine)) ** 0.5
    assert short > 30 and all(len(sets) == 1 for sets in prints.values())


def test_short_and_empty():
    assert sketch.sketch("").hashes.size == 0 and sketch.fingerprint("", sketch.sketch("")) == "0:1:"
    assert sketch.fingerprint("abc", sketch.sketch("abc")).startswith("1:1:")
    print_ = lambda t: (sketch.fingerprint(t, sketch.sketch(t)), sketch.sketch(t))
    assert print_("hello")[0] != print_("world")[0] and sketch.likeness(print_("hello"), print_("world")) == 0 and sketch.likeness(print_("hello"), print_("hello")) == 1
    assert sketch.likeness(print_(""), print_("")) == 1 and sketch.likeness(print_(""), print_("a")) == 0
    assert sketch.edited("abcd", "") == "abc" and sketch.edited("abcdefgh", "XYZ") == "abcdefXY" and sketch.edited("abc", "Z") == "abc"


def test_empty_and_single(spark, none, docs):
    assert sketch.fingerprints(spark, none).count() == 0
    one = sketch.fingerprints(spark, docs.where("doc_id = 7")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0

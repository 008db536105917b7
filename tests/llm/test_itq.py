from collections import Counter

import numpy as np
import pytest

from quillstone.llm import itq

D = 24
SCHEMA = "vec_id long, embedding array<float>, label int, rep string, links string"


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    out = []

    def add(v, label):
        out.append((len(out), None if v is None else [None if x is None else float(np.float32(x)) for x in v], label, "clash", "clash"))

    for k in range(400):
        add(rng.standard_normal(D), k % 3)
    for k in range(0, 60, 2):
        base = np.array(out[k][1])
        for s in (0.05, 0.2, 0.35, 0.5):
            add(base + s * np.linalg.norm(base) / np.sqrt(D) * rng.standard_normal(D), out[k][2] if k % 4 else None)
    hot = rng.standard_normal(D)
    for _ in range(60):
        add(hot, 1)
    for _ in range(120):
        add(hot + 0.25 * rng.standard_normal(D), 1)
    add(hot, 2)
    for bad in (None, [], [0.0] * D, [float("nan")] + [1.0] * (D - 1), [float("inf")] + [1.0] * (D - 1), [None] + [1.0] * (D - 1), [1.0] * (D + 1), hot * 3):
        add(bad, 1)
    return out


def brute(rows, threshold=0.93):
    good = [r for r in rows if r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    wide = max(len(r[1]) for r in good)
    x = np.array([[*r[1], *[0.0] * (wide - len(r[1]))] for r in good])
    x /= np.linalg.norm(x, axis=1)[:, None]
    of = np.array([(r[2], len(r[1])) for r in good])
    hit = (x @ x.T >= threshold) & (of[:, None] == of[None, :]).all(axis=2)
    np.fill_diagonal(hit, False)
    ids, links, root = [r[0] for r in good], {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, j in zip(*np.nonzero(hit), strict=True):
        links[ids[i]] += 1
        a, b = find(ids[i]), find(ids[j])
        root[max(a, b)] = min(a, b)
    return links, {k: find(k) for k in root}


@pytest.mark.parametrize("block", [itq.BLOCK, 32])
def test_against_brute_force(spark, vectors, block, monkeypatch):
    monkeypatch.setattr(itq, "BLOCK", block)
    got = {r["vec_id"]: r for r in itq.near_duplicates(spark, spark.createDataFrame(vectors, SCHEMA)).collect()}
    links, root = brute(vectors)
    assert sorted(got) == sorted(links)
    assert all(got[k]["n_links"] <= links[k] for k in links)
    assert sum(r["n_links"] for r in got.values()) >= 0.98 * sum(links.values())
    same = sum(got[k]["component_id"] == root[k] for k in root)
    assert same >= 0.98 * len(root) and all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_blocks_change_nothing(spark, vectors, monkeypatch):
    df = spark.createDataFrame(vectors, SCHEMA)
    one = sorted(map(tuple, itq.near_duplicates(spark, df).collect()))
    monkeypatch.setattr(itq, "BLOCK", 16)
    assert sorted(map(tuple, itq.near_duplicates(spark, df).collect())) == one


def test_planted_pairs(spark, monkeypatch):
    """Pairs at known cosines about the threshold, in several labels and widths, some of them rare: none below it links, and few above it are missed."""
    monkeypatch.setattr(itq, "WIDTHS", 2)
    rng, rows, want = np.random.default_rng(9), [], []
    for width, per in ((64, 900), (32, 300), (7, 24), (3, 5)):
        for label in (0, 1):
            for k in range(per):
                a = rng.standard_normal(width)
                a /= np.linalg.norm(a)
                rows.append((len(rows), a.astype(np.float32).tolist(), label))
                if k % 3 == 0:
                    c = (0.90, 0.925, 0.9299, 0.9301, 0.935, 0.95, 0.98, 0.999)[k // 3 % 8]
                    b = rng.standard_normal(width)
                    b -= (b @ a) * a
                    b = c * a + (1 - c * c) ** 0.5 * b / np.linalg.norm(b)
                    rows.append((len(rows), (7 * b).astype(np.float32).tolist(), label if k % 9 else 1 - label))
                    want.append((len(rows) - 1, c))
    rows += [(len(rows), [1.0, 2.0], 5), (len(rows) + 1, [1.0, 2.0], 5), (len(rows) + 2, [1.0, 2.0], 6)]
    got = {r["vec_id"]: r for r in itq.near_duplicates(spark, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)).collect()}
    links, root = brute(rows)
    assert all(got[k]["n_links"] <= links[k] for k in links)
    for c in (0.9301, 0.935, 0.95, 0.98, 0.999):
        of = [k for k, at in want if at == c]
        assert sum(got[k]["n_links"] > 0 for k in of) >= 0.9 * sum(links[k] > 0 for k in of) > 10
    for k, r in got.items():
        if len(rows[k][1]) in (7, 3, 2):  # compared in whole
            assert (r["n_links"], r["component_id"]) == (links[k], root[k])
    assert sum(r["n_links"] for r in got.values()) >= 0.97 * sum(links.values())
    assert (got[len(rows) - 3]["n_links"], got[len(rows) - 2]["component_id"], got[len(rows) - 1]["n_links"]) == (1, len(rows) - 3, 0)


def test_codes_that_differ_little_share_a_key():
    """Of a code in so many substrings, fewer wrong bits than that leave one whole."""
    rng = np.random.default_rng(3)
    bits, count = itq.tables(5000)
    mean, projection = itq.learn(rng.standard_normal((2000, D)), bits, count)
    code = rng.random((50, bits * count)) < 0.5
    for c in code:
        other = c.copy()
        other[rng.choice(bits * count, count - 1, replace=False)] ^= True
        weigh = 1 << np.arange(bits)
        assert (c.reshape(-1, bits) @ weigh == other.reshape(-1, bits) @ weigh).any()
    assert projection.shape[1] == bits * count


def test_rotations_balance_and_keep_neighbours():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, D)) * np.linspace(0.2, 3, D)
    x /= np.linalg.norm(x, axis=1)[:, None]
    mean, projection = itq.learn(x, 8, 9)
    assert projection.shape == (D, 72)
    on = ((x - mean) @ projection >= 0).mean(axis=0)
    assert np.all((on > 0.3) & (on < 0.7))
    one = projection[:, :D]
    assert np.allclose(np.abs(np.linalg.svd(one)[1]), 1)


def test_more_vectors_ask_for_longer_keys_and_more_tables():
    sizes = [itq.tables(n) for n in (10, 1000, 100_000, 10_000_000)]
    assert sizes == sorted(sizes) and all(1 - (1 - itq.AGREE**b) ** t >= 1 - itq.MISSED for b, t in sizes)


def test_repeated_rows_and_empty(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1), (None, [1.0, 0.0], 1)]
    got = Counter(map(tuple, itq.near_duplicates(spark, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()))
    assert got == Counter({(1, 1, 1, True): 2, (2, 0, 2, True): 1, (None, 0, None, False): 1})
    assert itq.near_duplicates(spark, spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0

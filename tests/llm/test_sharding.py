import zlib
from collections import Counter, defaultdict

from quillstone.llm.sharding import Boundaries, histogram_sort, shard_documents
from pyspark.sql import functions as F


def test_shards(spark, docs, rows):
    out = shard_documents(spark, docs).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    by = defaultdict(list)
    for r in out:
        by[r["shard"]].append(r)
        assert r["law"] == "bytes" and r["grown_shard"] is None
    total, longest = sum(r["size"] for r in out), max(r["size"] for r in out)
    assert set(by) <= set(range(8))
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert sum(r["size"] for r in own) <= total / 8 + longest


def test_even_shards_and_whole_groups(spark):
    rows = spark.range(4000).select((F.col("id") * 7919 % 1009).alias("k1"), F.col("id").alias("k2"), (F.col("id") % 90 + 10).alias("size"))
    out = histogram_sort(rows, 8).groupBy("shard").agg(F.sum("size").alias("size")).collect()
    mean = sum(r["size"] for r in out) / 8
    assert len(out) == 8 and all(abs(r["size"] - mean) <= 0.02 * mean + 100 for r in out)
    split = histogram_sort(rows, 8).groupBy("k1").agg(F.count_distinct("shard").alias("n")).where("n > 1").count()
    assert split == 0


def test_a_hot_group_is_cut_in_order(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 2000, 5).otherwise(F.col("id")).alias("k1"), F.col("id").alias("k2"), F.lit(10).cast("long").alias("size"))
    out = histogram_sort(rows, 8).orderBy("k1", "k2").collect()
    assert [r["shard"] for r in out] == sorted(r["shard"] for r in out)
    assert max(Counter(r["shard"] for r in out).values()) <= 1.02 * 3000 / 8


def test_counts_below_probes_are_exact(spark):
    keys = spark.range(1000).select((F.col("id") % 10 - 5).alias("k1"), F.col("id").alias("k2"), F.lit(0).cast("long").alias("k3"), F.lit(3).cast("long").alias("size"))
    known = Boundaries(keys)
    at = ((2 + (1 << 63)) << 128) + ((500 + (1 << 63)) << 64)
    known.count([at])
    below = [k for k in range(1000) if (k % 10 - 5, k) < (2, 500)]
    assert known.below[known.at.index(at)] == 3 * len(below) and known.rows[known.at.index(at)] == len(below)


def test_rows_that_repeat_are_cut(spark):
    """One row thousands of times, and rows without id or text."""
    rows = [(1, "one row that repeats, again and again")] * 3000 + [(k, f"text {k}") for k in range(1000)] + [(None, None)] * 3000 + [(None, "said without an id")] * 2000
    out = shard_documents(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((i, len(t or "") + 1) for i, t in rows)
    sizes, mean = Counter(), sum(r["size"] for r in out) / 8
    for r in out:
        sizes[r["shard"]] += r["size"]
    assert len(sizes) == 8 and all(abs(s - mean) <= 0.011 * mean + 40 for s in sizes.values())
    for shard in range(8):
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in out)))


def test_empty(spark, none):
    assert shard_documents(spark, none).count() == 0

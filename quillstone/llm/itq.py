"""Near duplicates of embeddings by iterative quantisation.

A learned rotation gives balanced binary codes whose bits agree for near vectors; where a code needs more bits than the vectors have dimensions, further learned
rotations give them. A multi-index Hamming table holds each substring of the code: codes that differ in fewer bits than there are substrings share one of
them, and most of those that differ in somewhat more do. Vectors that share a substring in any table are compared in full, in double precision.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.common import bounded, partitions, small_batches, split_join, stored, working
from quillstone.llm.components import components

#: Vectors that the rotations are learned from, at most; rounds of learning.
SAMPLE, ROUNDS = 20_000, 40
#: Chance that a bit agrees at the threshold; share of pairs just at it that the tables may miss.
AGREE, MISSED = 0.86, 0.01
#: Vectors of a label that share a key, about, and the most that are compared in one block.
PER_KEY, BLOCK = 24, 1024
#: Widths of vectors that get codes of their own, the commonest ones; vectors of others are compared in whole, in blocks.
WIDTHS = 8


def tables(vectors: int) -> tuple[int, int]:
    """Bits of a key and number of tables for a label of so many vectors: longer keys keep buckets small, more tables keep the recall."""
    bits = min(24, max(4, round(math.log2(max(vectors, 1) / PER_KEY))))
    return bits, math.ceil(math.log(MISSED) / math.log(1 - AGREE**bits))


def learn(sample: np.ndarray, bits: int, count: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Mean, and a projection whose signs are the bits of ``count`` keys: principal axes, rotated so that quantising loses least.

    A rotation gives as many bits as the vectors have dimensions; more start from other rotations.
    """
    mean = sample.mean(axis=0) if len(sample) else np.zeros(sample.shape[1])
    x = sample - mean
    _, axes = np.linalg.eigh(x.T @ x + 1e-9 * np.eye(x.shape[1]))
    v, d, rng, out = x @ axes, x.shape[1], np.random.default_rng(seed), []
    while sum(p.shape[1] for p in out) < bits * count:
        r, _ = np.linalg.qr(rng.standard_normal((d, d)))
        for _ in range(ROUNDS):
            u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = (u @ w).T
        out.append((axes @ r)[:, rng.permutation(d)])
    return mean, np.concatenate(out, axis=1)[:, : bits * count]


def keys(x: np.ndarray, mean: np.ndarray, projection: np.ndarray, bits: int) -> np.ndarray:
    """The key of each vector in each table."""
    on = ((x - mean) @ projection >= 0).reshape(len(x), -1, bits)
    return (on * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)


def _units(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


Codes = dict[int, tuple[np.ndarray, np.ndarray, int]]


def _of(codes: Codes, width: int, x: np.ndarray) -> np.ndarray:
    """The keys of unit vectors of one width in each table; 0 where the width has no code."""
    return keys(x, *codes[width]) if width in codes else np.zeros((len(x), 1), np.int32)


def _classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the width of each vector and a digest that tells vectors apart."""
    for batch in bounded(batches, 2):
        e = batch.column(2)
        ends, raw = e.offsets.to_numpy(), e.values.to_numpy(zero_copy_only=False).astype(np.float32) + np.float32(0)  # one zero
        digest = [hashlib.blake2b(raw[a:b].tobytes(), digest_size=16).digest() for a, b in zip(ends, ends[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.diff(ends), pa.int32()), pa.array(digest, pa.binary())], [*batch.schema.names, "width", "digest"])


def _keyed(codes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The key of each vector in each table of its width."""
        for batch in bounded(batches, 3):
            wide = batch.column(2).to_numpy(zero_copy_only=False)
            for w in np.unique(wide).tolist():
                own = batch.filter(pa.array(wide == w))
                k = _of(codes.value, w, _units(own.column(3)))
                at = np.repeat(np.arange(len(k)), k.shape[1])
                yield pa.RecordBatch.from_arrays([own.column(0).take(pa.array(at)), own.column(1).take(pa.array(at)), own.column(2).take(pa.array(at)), pa.array(np.tile(np.arange(k.shape[1], dtype=np.int32), len(k))), pa.array(k.reshape(-1))], ["rep", "label", "width", "table", "key"])

    return run


def _compare(threshold: float, codes):
    big = np.iinfo(np.int64).max

    def block(rows: list[pa.RecordBatch]) -> list[tuple[int, int, int]]:
        t = pa.Table.from_batches(rows)
        table_no = t.column("table")[0].as_py()
        a, b = t.column("a")[0].as_py(), t.column("b")[0].as_py()
        chunk, rep, copies = (t.column(c).to_numpy() for c in ("chunk", "rep", "copies"))
        x = _units(t.column("embedding").combine_chunks())
        left, right = np.flatnonzero(chunk == a), np.flatnonzero(chunk == b)
        hit = x[left] @ x[right].T >= threshold
        if a == b:
            np.fill_diagonal(hit, False)
        i, j = np.nonzero(hit)
        if not len(i):
            return []
        # a pair counts in the first table where its keys meet
        k = _of(codes.value, x.shape[1], x)
        first = np.ones(len(i), bool)
        for e in range(table_no):
            first &= k[left[i], e] != k[right[j], e]
        links = np.zeros(len(rep), np.int64)
        np.add.at(links, left[i[first]], copies[right[j[first]]])
        if a != b:
            np.add.at(links, right[j[first]], copies[left[i[first]]])
        label = rep.copy()  # the least vector that hits of this block reach
        while True:
            was = label.copy()
            label[left] = np.minimum(label[left], np.where(hit, label[right][None, :], big).min(axis=1))
            label[right] = np.minimum(label[right], np.where(hit, label[left][:, None], big).min(axis=0))
            if (label == was).all():
                break
        return [(int(rep[n]), int(links[n]), int(label[n])) for n in np.flatnonzero((links > 0) | (label != rep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        out: list[tuple[int, int, int]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            of = [batch.column(n).to_numpy(zero_copy_only=False) for n in range(6)]
            edge = np.zeros(batch.num_rows, bool)
            for c in of:
                edge[1:] |= c[1:] != c[:-1]
            starts = [0, *np.flatnonzero(edge).tolist(), batch.num_rows]
            for s, e in zip(starts, starts[1:], strict=False):
                if s == e:
                    continue
                now = tuple(c[s] for c in of)
                if now != key and held:
                    out += block(held)
                    held = []
                key = now
                held.append(batch.slice(s, e - s))
            if out:
                yield _links(out)
                out = []
        if held:
            out += block(held)
        yield _links(out)

    return run


def _links(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["rep", "links", "reach"])


def near_duplicates(spark: SparkSession, vectors: DataFrame, threshold: float = 0.93, label: str = "label", seed: int = 5) -> DataFrame:
    """vec_id, n_links, component_id and kept of each vector; links join vectors of equal label whose cosine is ``threshold`` or more.

    Equal vectors of a label form a class that is compared once. Codes are learned for each of the WIDTHS commonest widths, from at most SAMPLE classes in all (those of the least
    hashed id); every class is indexed. Vectors of further widths are compared with all of their label and width. Buckets of any size are compared whole: large ones in
    blocks, dealt to separate tasks. A pair that meets in several tables counts in the first. Only counts and spanning links leave a block, so groups of near copies give rows in
    proportion to their vectors. Vectors of different widths do not link. Labels that are null, and vectors that are null, empty, zero or not finite, link
    with nothing. Repeated rows are vectors of their own. Extra columns are ignored.
    """
    small_batches(spark)
    with working(spark) as keep:
        return _near_duplicates(spark, vectors, threshold, label, seed, keep)


def _near_duplicates(spark: SparkSession, vectors: DataFrame, threshold: float, label: str, seed: int, keep) -> DataFrame:
    v = F.col("embedding")
    total = F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    good = F.coalesce(F.col(label).isNotNull() & v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & (total > 0) & F.col("vec_id").isNotNull(), F.lit(False))
    rows = vectors.select("vec_id", F.col(label).alias("label"), v.cast("array<float>").alias("embedding"), good.alias("good"))
    alone = rows.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    kind = dict(rows.dtypes)["label"]
    usable = rows.where("good").select("vec_id", "label", "embedding").mapInArrow(_classed, f"vec_id {dict(rows.dtypes)['vec_id']}, label {kind}, embedding array<float>, width int, digest binary")
    classes = stored(usable.groupBy("label", "width", "digest").agg(F.min("vec_id").cast("long").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")).withColumn("class", F.monotonically_increasing_id()), "vector-classes")

    # codes of the commonest widths
    sizes = classes.groupBy("width", "label").count().groupBy("width").agg(F.sum("count").alias("n"), F.max("count").alias("largest")).orderBy(F.desc("n"), "width").limit(WIDTHS).collect()
    codes: Codes = {}
    for s in sizes:
        bits, count = tables(s["largest"])
        own = classes.where(F.col("width") == s["width"]).orderBy(F.xxhash64(F.lit(seed), "rep"), "rep", "class").limit(SAMPLE // len(sizes)).select("embedding").collect()
        sample = np.array([r[0] for r in own], np.float64)
        sample /= np.sqrt((sample * sample).sum(axis=1))[:, None]
        codes[s["width"]] = (*learn(sample, bits, count, seed), bits)
    shared = spark.sparkContext.broadcast(codes)

    # a row for each class and table, without the vector
    entry = stored(classes.select(F.col("class").alias("rep"), "label", "width", "embedding").mapInArrow(_keyed(shared), f"rep long, label {kind}, width int, table int, key int"), "vector-keys")
    bucket = ["width", "table", "key", "label"]
    sizes = entry.groupBy(*bucket).agg(F.count("*").alias("m")).where("m > 1")  # whoever is alone in a bucket goes
    sizes = stored(sizes.withColumn("chunks", F.ceil(F.col("m") / BLOCK).cast("int")), "buckets")
    placed = split_join(entry, sizes, bucket, "m").withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(*bucket, F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"), "chunk", "rep")
    dealt = dealt.join(classes.select(F.col("class").alias("rep"), "copies", "embedding"), "rep").select(*bucket, "a", "b", "chunk", "rep", "copies", "embedding")
    block = [*bucket, "a", "b"]
    found = dealt.repartition(partitions(spark), *block).sortWithinPartitions(*block).mapInArrow(_compare(threshold, shared), "rep long, links long, reach long")
    links = stored(found, "vector-links")
    counts = links.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(links.where("rep <> reach").select(F.col("rep").alias("u"), F.col("reach").alias("v")))
    each = classes.select("label", "width", "digest", "copies", "class", F.col("rep").alias("least")).join(counts, F.col("class") == counts["rep"], "left").join(groups, F.col("class") == F.col("node"), "left").select("label", "width", "digest", "copies", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "class").alias("component"))
    each = stored(each, "vector-groups")
    least = stored(each.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("m")), "vector-components")
    each = keep(stored(split_join(each, least, ["component"], "m").select("label", "width", "digest", "copies", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id"), "vector-answers"))
    linked = split_join(usable.select("vec_id", "label", "width", "digest"), each, ["label", "width", "digest"], "copies")
    return linked.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")).unionByName(alone)
